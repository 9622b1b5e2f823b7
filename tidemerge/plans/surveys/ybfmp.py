"""Yolo Bypass: a zooplankton and a fish feed of partly the same visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemerge.functions.clock import add_local_stamp, parse, parse_date
from tidemerge.functions.nulls import drop_all_null, if_else, strict_min
from tidemerge.functions.text import recode
from tidemerge.functions.units import metres_to_centimetres, specific_conductance
from tidemerge.operators.dedup import ROW
from tidemerge.operators.joins import lookup
from tidemerge.operators.merge import Alike, mean, merge_feeds, whole_mean
from tidemerge.sources.registry import Feeds

_STATIONS = {"StationCode": "string", "Latitude": "double", "Longitude": "double"}
FEEDS = {
    "zoop": {
        "Date": "string", "Datetime": "string", "StationCode": "string", "Tide": "string",
        "WaterTemperature": "double", "Secchi": "double", "Conductivity": "double", "SpCnd": "double",
        "MicrocystisVisualRank": "double", "DO": "double", "pH": "double", "FieldComments": "string",
    },
    "fish": {
        "Datetime": "string", "SampleDate": "string", "StationCode": "string", "WaterTemp": "double",
        "Secchi": "double", "Conductivity": "double", "SpecificConductance": "double", "Tide": "string",
        "MicrocystisRank": "double", "DO": "double", "pH": "double", "FieldComments": "string",
    },
    "zoop_stations": _STATIONS,
    "fish_stations": _STATIONS,
}

# Tide words; a visit that repeats the measures of another; two visits that are repeats.
TIDES = {"High": "High Slack", "Low": "Low Slack"}
REPEATED_MEASURES = ("STTD", "2017-01-23 13:30:00")
REPEATED_VISITS = (("STTD", "2017-01-20 12:05:00"), ("STTD", "2017-01-31 13:20:00"))

WATER = ["Temperature", "Secchi", "Conductivity", "DissolvedOxygen", "pH"]
MEASURES = ["Temperature", "Secchi", "Conductivity", "Microcystis", "DissolvedOxygen", "pH"]
VISIT = ["Station", "Datetime"]
BUT_NOTES = ["Date", "Datetime", "Station", "Tide", *MEASURES]


def _feed(df: DataFrame, day: Column, time: Column, temperature: str, conductance: str, microcystis: str) -> DataFrame:
    """A feed under shared names, without empty and fully repeated records."""
    shaped = add_local_stamp(df.withColumn("_day", day), time).select(
        F.col("_day").alias("Date"),
        "Datetime",
        F.col("StationCode").alias("Station"),
        recode(F.col("Tide"), TIDES).alias("Tide"),
        F.col(temperature).alias("Temperature"),
        metres_to_centimetres(F.col("Secchi")).alias("Secchi"),
        specific_conductance(F.col(conductance), F.col("Conductivity"), F.col(temperature)).alias("Conductivity"),
        F.col(microcystis).alias("Microcystis"),
        F.col("DO").alias("DissolvedOxygen"),
        "pH",
        F.col("FieldComments").alias("Notes"),
        ROW,
    )
    return _distinct(drop_all_null(shaped, MEASURES))


def _distinct(df: DataFrame) -> DataFrame:
    """Distinct records, each at its first position."""
    columns = [c for c in df.columns if c != ROW]
    return df.groupBy(*columns).agg(F.min(ROW).alias(ROW))


def _is_visit(station: str, time: str) -> Column:
    return (F.col("Station") == station) & (F.col("Datetime") == F.lit(time).cast("timestamp_ntz"))


def _fish(fish: DataFrame) -> DataFrame:
    """Repair repeated visits; of records with the same measures on one day keep the earliest.

    Both steps are aggregations, so the feed is read once and a visit or day
    with many records is combined before each shuffle.
    """
    # records and visits in one aggregation: a single visit stays, of others the records with a Secchi depth
    whole = F.struct(*[F.col(c).alias(c) for c in fish.columns])
    grouped = fish.groupingSets([BUT_NOTES, VISIT], *BUT_NOTES).agg(
        F.grouping("Date").alias("_visit"), F.count(F.lit(1)).alias("_n"), F.min_by(whole, ROW).alias("_first")
    )
    known = F.col("_first.Secchi").isNotNull()
    kept = F.when(F.col("_visit") == 0, known).otherwise((F.col("_n") == 1) & ~known)
    repaired = grouped.filter(kept).select("_first.*")

    # same measures under one tide word differ by their time; few tide words are left to compare
    alike = ["Date", "Station", *MEASURES]
    by_tide = repaired.groupBy(*alike, "Tide").agg(
        strict_min(F.col("Datetime")).alias("Datetime"),
        F.min_by(F.struct("Notes", ROW), "Datetime").alias("_kept"),
    )
    day = Window.partitionBy(*alike)
    untimed = F.count_if(F.col("Datetime").isNull()).over(day)
    ranked = by_tide.withColumns({"_untimed": untimed, "_best": F.min("Datetime").over(day)})
    fish = ranked.filter((F.col("_untimed") == 0) & (F.col("Datetime") == F.col("_best"))).select(*BUT_NOTES, "_kept.*")
    repeated = _is_visit(*REPEATED_MEASURES)
    nothing = F.lit(None).cast("double")
    fish = fish.withColumns({c: if_else(repeated, nothing, F.col(c)) for c in WATER})
    for visit in REPEATED_VISITS:
        fish = fish.filter(~_is_visit(*visit))
    return fish


def _merge_visits(zoop: DataFrame, fish: DataFrame) -> DataFrame:
    """One row per visit: known Microcystis first, then the mean of what the feeds still differ in."""
    known_first = [F.col("Microcystis").isNull(), F.col("Microcystis")]
    same_water = [c for c in BUT_NOTES if c not in ("Date", "Microcystis")]
    return merge_feeds(
        [zoop, fish], VISIT, {c: whole_mean if c == "Secchi" else mean for c in WATER},
        alike=[Alike(BUT_NOTES), Alike(same_water, known_first)], first=known_first,
    )


def clean(feeds: Feeds) -> DataFrame:
    zoop = _feed(
        feeds["zoop"], parse_date(F.col("Date"), "yyyy-MM-dd"), parse(F.col("Datetime"), "yyyy-MM-dd H:mm:ss"),
        "WaterTemperature", "SpCnd", "MicrocystisVisualRank",
    )
    fish = _feed(
        feeds["fish"], parse_date(F.col("SampleDate"), "M/d/yyyy"), parse(F.col("Datetime"), "M/d/yyyy H:mm"),
        "WaterTemp", "SpecificConductance", "MicrocystisRank",
    )
    visits = _merge_visits(zoop, _fish(fish))
    stations = feeds["zoop_stations"].drop(ROW).unionByName(feeds["fish_stations"].drop(ROW)).distinct()
    return lookup(visits, stations.withColumnRenamed("StationCode", "Station"), ["Station"]).select(
        F.lit("YBFMP").alias("Source"), "Station", "Latitude", "Longitude", "Date", "Datetime", "Tide", "Microcystis",
        "Secchi", "Temperature", "Conductivity", "DissolvedOxygen", "pH", "Notes",
    )
