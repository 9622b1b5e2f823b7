"""Suisun Marsh fish study: copied measurements of neighbouring samples become one visit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import (
    add_local_time, exact_sum, from_micros, micros, parse, whole_ratio,
)
from tidemerge.functions.nulls import drop_any_null
from tidemerge.functions.text import number_text, paste, recode
from tidemerge.functions.units import specific_conductance
from tidemerge.operators.dedup import ROW, keep_first
from tidemerge.operators.joins import lookup
from tidemerge.operators.spread import spread_join
from tidemerge.sources.registry import Feeds

FEEDS = {
    "sample": {
        "SampleRowID": "string", "StationCode": "string", "SampleDate": "string", "SampleTime": "string",
        "WaterTemperature": "double", "Secchi": "double", "SpecificConductance": "double", "ElecCond": "double",
        "TideCode": "string", "DO": "double", "PctSaturation": "double", "Salinity": "double",
    },
    "depth": {"SampleRowID": "string", "Depth": "double"},
    "stations": {"StationCode": "string", "x_WGS84": "double", "y_WGS84": "double"},
}
STAMP = "M/d/yyyy H:mm:ss"

# Tide words.
TIDES = {
    "flood": "Flood", "ebb": "Ebb", "low": "Low Slack", "high": "High Slack", "outgoing": "Ebb", "incoming": "Flood",
}
MEASURES = ("Temperature", "Salinity", "DissolvedOxygen", "DissolvedOxygenPercent", "Secchi", "Conductivity")


def collapse_visits(samples: DataFrame, *, drop_empty_mode: bool = True) -> DataFrame:
    """One row per date, station and identical measurements.

    Depth and time are averaged, the tide is the most frequent one, the first
    seen among equals. Visits without any tide vanish when ``drop_empty_mode``.
    """
    visit = ["Date", "Station", "ID"]
    named = samples.withColumn(
        "ID", paste(F.col("Date"), F.col("Station"), *[number_text(F.col(m)) for m in MEASURES])
    )
    # one partial row per tide, then the visit: totals add up, the modal tide is picked among them
    when = micros(F.col("Datetime"))
    by_tide = named.groupBy(*visit, "Tide").agg(
        *[F.min(m).alias(m) for m in MEASURES],
        F.count(F.lit(1)).alias("_n"),
        F.min(ROW).alias("_first"),
        F.sum("Depth").alias("_depth"),
        F.count("Depth").alias("_depths"),
        exact_sum(when).alias("_time"),
        F.count("Datetime").alias("_times"),
    )
    rank = F.when(F.col("Tide").isNotNull(), F.struct((-F.col("_n")).alias("n"), F.col("_first")))
    merged = by_tide.groupBy(*visit).agg(
        *[F.min(m).alias(m) for m in MEASURES],
        F.try_divide(F.sum("_depth"), F.sum("_depths")).alias("Depth"),
        from_micros(whole_ratio(F.sum("_time"), F.sum("_times"))).alias("Datetime"),
        F.min_by("Tide", rank).alias("Tide"),
    )
    return merged.filter(F.col("Tide").isNotNull()) if drop_empty_mode else merged


def clean(feeds: Feeds) -> DataFrame:
    depths = feeds["depth"].groupBy("SampleRowID").agg(F.avg("Depth").alias("Depth"))
    day, clock = parse(F.col("SampleDate"), STAMP), parse(F.col("SampleTime"), STAMP)
    conductivity = specific_conductance(
        F.col("SpecificConductance"), F.col("ElecCond"), F.col("WaterTemperature")
    )
    samples = add_local_time(spread_join(feeds["sample"], depths, ["SampleRowID"]), day, clock).select(
        F.col("StationCode").alias("Station"),
        "Date",
        "Datetime",
        recode(F.col("TideCode"), TIDES).alias("Tide"),
        F.col("WaterTemperature").alias("Temperature"),
        "Salinity",
        F.col("DO").alias("DissolvedOxygen"),
        F.col("PctSaturation").alias("DissolvedOxygenPercent"),
        "Secchi",
        conductivity.alias("Conductivity"),
        "Depth",
        ROW,
    )
    stations = drop_any_null(
        feeds["stations"].select(
            F.col("StationCode").alias("Station"), F.col("y_WGS84").alias("Latitude"), F.col("x_WGS84").alias("Longitude")
        )
    )
    visits = lookup(collapse_visits(samples), stations, ["Station"])
    return keep_first(visits, ["Station", "Date", "Datetime"], ["ID"]).select(
        F.lit("Suisun").alias("Source"), "Station", "Latitude", "Longitude", "Date", "Datetime", "Depth", "Tide",
        "Secchi", "Temperature", "Conductivity", "DissolvedOxygen", "DissolvedOxygenPercent",
    )
