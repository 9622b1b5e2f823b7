"""North central region laboratory and field results: long text feed, times in PST."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.censor import SIGNS, split_censored
from tidemerge.functions.clock import PST, add_hours, parse, parse_date, to_local
from tidemerge.functions.codes import microcystis_index
from tidemerge.functions.nulls import drop_all_null, drop_any_null
from tidemerge.functions.units import metres_to_centimetres, ug_to_mg_per_l
from tidemerge.operators.dedup import ROW, resolve_replicates
from tidemerge.operators.joins import by_change_date, drop_listed, literal_table, lookup
from tidemerge.operators.repair import assign_ids, overlay_corrections
from tidemerge.operators.reshape import long_to_wide, stack, strip_spaces
from tidemerge.sources.registry import Feeds

_RESULTS = {
    "SampleType": "string", "Analyte": "string", "LongStationName": "string", "StationNumber": "string",
    "SampleCode": "string", "CollectionDate": "string", "Result": "string", "RptLimit": "string",
    "Units": "string", "Notes": "string",
}
FEEDS = {
    "requested": _RESULTS,
    "recent": _RESULTS,
    "laboratory": _RESULTS,
    "extra_field": _RESULTS,
    "secchi": {
        "StationCode": "string", "FldObsWaterHabs": "string", "FldObsSecchi": "double",
        "DeploymentEnd": "timestamp_ntz",
    },
    "stations": {
        "StationNumber": "string", "StationName": "string", "Latitude": "double", "Longitude": "double",
        "WQES_StationCode": "string", "LastDate_NTU": "string", "FirstDate_FNU": "string",
    },
    "portal_stations": {"station_number": "string", "latitude": "double", "longitude": "double"},
    "same_day": {"SampleCode": "string", "KeepRecord": "string"},
    "questionable": {
        "SampleCode": "string", "Analyte": "string", "MeasVerified": "string", "ResultVerified": "double",
    },
}

# Headers of the raw corrections; results are exported with spaces in their headers.
HEADERS = {
    "questionable": {
        "Measurement Verified (Yes, No, or Unknown)": "MeasVerified", "Verified Result": "ResultVerified",
    },
}
SHAPES = {"requested": strip_spaces, "recent": strip_spaces}

# Analytes that are kept, and their shared names.
ANALYTES = (
    ("Chlorophyll a", "Chlorophyll"),
    ("Dissolved Ammonia", "DissAmmonia"),
    ("Dissolved Bromide", "DissBromide"),
    ("Dissolved Calcium", "DissCalcium"),
    ("Dissolved Chloride", "DissChloride"),
    ("Dissolved Nitrate + Nitrite", "DissNitrateNitrite"),
    ("Dissolved Organic Carbon", "DOC"),
    ("Dissolved Organic Nitrogen", "DON"),
    ("Dissolved ortho-Phosphate", "DissOrthophos"),
    ("Field (Bottom) Dissolved Oxygen", "DissolvedOxygen_bottom"),
    ("Field Dissolved Oxygen", "DissolvedOxygen"),
    ("Field Specific Conductance", "Conductivity"),
    ("Field Turbidity", "Turbidity"),
    ("Field Water Temperature", "Temperature"),
    ("Field pH", "pH"),
    ("Pheophytin a", "Pheophytin"),
    ("Total Alkalinity", "TotAlkalinity"),
    ("Total Dissolved Solids", "TDS"),
    ("Total Kjeldahl Nitrogen", "TKN"),
    ("Total Organic Carbon", "TOC"),
    ("Total Phosphorus", "TotPhos"),
    ("Total Suspended Solids", "TSS"),
    ("Volatile Suspended Solids", "VSS"),
)
# Placeholder station numbers, and the real ones by station name.
PLACEHOLDERS = ("(UserDefined)", "(NONE)")
STATION_IDS = (
    ("Holland Cut at Holland Marina", None, "B9D75841349"),
    ("Middle River @ Undine Road", None, "B9D75011230"),
    ("Middle River near Tracy Road", None, "B9D75291280"),
    ("Old River at Bacon Island", None, "B9D75811344"),
    ("Old River near Bacon Island @ USGS Pile", "(UserDefined)", "B9D75811344"),
    ("Old River near Bacon Island @ USGS Pile", "(NONE)", "B9D75821343A"),
    ("Rock Slough @ CCWD", None, "B9522200"),
    ("Rock Slough @ Contra Costa WD Fish Screen", None, "B9522200"),
    ("San Joaquin River at Blind Point", None, "B9D80201431"),
)
# A visit of another agency, and a visit recorded twelve hours early at three o'clock.
FOREIGN_VISIT = ("Old River near Head", "2018-09-20")
EARLY_VISIT = ("Holland Cut at Holland Marina", "2007-06-05 03:00:00")
# Reported columns.
UNSIGNED = (
    "Temperature", "Conductivity", "DissolvedOxygen", "DissolvedOxygen_bottom", "pH", "TurbidityNTU", "TurbidityFNU",
)
SIGNED = (
    "TotAlkalinity", "DissAmmonia", "DissBromide", "DissCalcium", "DissChloride", "Chlorophyll", "Pheophytin",
    "DissNitrateNitrite", "DOC", "TOC", "DON", "DissOrthophos", "TotPhos", "TSS", "VSS", "TKN", "TDS",
)


def station_table(feeds: Feeds) -> DataFrame:
    """Stations with change dates parsed; those without a latitude take the portal's position."""
    portal = feeds["portal_stations"].select(
        "station_number", F.lit(True).alias("_gap"), F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon")
    )
    stations = feeds["stations"].drop(ROW).withColumn("_gap", F.col("Latitude").isNull())
    joined = lookup(stations, portal, [("StationNumber", "station_number"), "_gap"])
    dates = {c: parse_date(F.col(c), "M/d/yyyy") for c in ("LastDate_NTU", "FirstDate_FNU")}
    position = {"Latitude": F.coalesce("Latitude", "_lat"), "Longitude": F.coalesce("Longitude", "_lon")}
    return joined.withColumns({**dates, **position}).drop("_gap", "_lat", "_lon")


def observations(feeds: Feeds) -> DataFrame:
    """Typed long observations of the kept analytes."""
    results = stack([feeds[n] for n in ("requested", "recent", "laboratory", "extra_field")])
    analytes = literal_table(results, ["Analyte", "AnalyteStd"], ANALYTES)
    normal = results.filter((F.col("SampleType") == "Normal Sample") & ~F.col("LongStationName").rlike(r"^\("))
    clock = parse(F.col("CollectionDate"), "M/d/yyyy H:m", "yyyy-M-d H:m:s")
    # filters and renames at once: an analyte outside the table is not kept
    long = normal.join(analytes, "Analyte").select(
        F.col("LongStationName").alias("StationName"),
        "StationNumber",
        "SampleCode",
        clock.alias("PstTime"),
        F.col("AnalyteStd").alias("Analyte"),
        "Result",
        F.col("RptLimit").alias("RL"),
        "Units",
        "Notes",
        ROW,
    )
    long = long.withColumn("Datetime", to_local(F.col("PstTime"), PST)).withColumn("Date", F.col("Datetime").cast("date"))
    calcium = ug_to_mg_per_l(F.col("Result"), F.col("Units"))
    value = F.when(F.col("Analyte") == "DissCalcium", calcium).otherwise(F.col("Result"))
    return split_censored(long).withColumn("Result", value).drop("RL", "Units")


def repaired_time(station: Column, time: Column) -> Column:
    """Times written on a twelve-hour clock, and others known to be off."""
    early = (station == EARLY_VISIT[0]) & (time == F.lit(EARLY_VISIT[1]).cast("timestamp_ntz"))
    return (
        F.when(F.hour(time).between(0, 2), add_hours(time, 12))
        .when(early, add_hours(time, 12))
        .when(F.hour(time) == 3, add_hours(time, 4))
        .otherwise(time)
    )


def visit_observations(feeds: Feeds, stations: DataFrame) -> DataFrame:
    """Secchi depth and Microcystis per station and day."""
    visits = feeds["secchi"].select(
        "StationCode",
        F.col("DeploymentEnd").cast("date").alias("Date"),
        metres_to_centimetres(F.col("FldObsSecchi")).alias("Secchi"),
        microcystis_index(F.col("FldObsWaterHabs")).alias("Microcystis"),
    )
    named = stations.select("WQES_StationCode", "StationNumber", "StationName")
    placed = lookup(visits, named, [("StationCode", "WQES_StationCode")]).drop("StationCode")
    placed = drop_all_null(drop_any_null(placed, ["StationName", "Date"]), ["Secchi", "Microcystis"])
    return placed.distinct()


def clean(feeds: Feeds) -> DataFrame:
    stations = station_table(feeds)
    long = assign_ids(observations(feeds), "StationNumber", "StationName", PLACEHOLDERS, STATION_IDS)
    names = stations.select("StationNumber", "StationName", "LastDate_NTU", "FirstDate_FNU")
    long = lookup(long.drop("StationName"), names, ["StationNumber"])
    long = long.filter(
        F.col("StationName").isNotNull()
        & ~((F.col("StationName") == FOREIGN_VISIT[0]) & (F.col("Date") == F.lit(FOREIGN_VISIT[1]).cast("date")))
    )
    analyte = F.col("Analyte")
    method = by_change_date(
        F.col("Date"), F.col("LastDate_NTU"), F.col("FirstDate_FNU"),
        F.lit("TurbidityNTU"), F.lit("TurbidityFNU"), analyte,
    )
    long = long.withColumn("Analyte", F.when(analyte == "Turbidity", method).otherwise(analyte))

    # the recorded clock tells apart the two passes through the hour that autumn repeats
    long = resolve_replicates(
        long, ["StationName", "PstTime", "Analyte"], F.col("Notes").rlike("(?i)duplicate"),
        [F.col("SampleCode").asc_nulls_last(), ROW],
    )
    long = drop_listed(long, feeds["same_day"].filter(F.col("KeepRecord") == "no"), ["SampleCode"])
    long = long.withColumn("Datetime", repaired_time(F.col("StationName"), F.col("Datetime")))
    long = overlay_corrections(
        long, feeds["questionable"], ["SampleCode", "Analyte"], "Result", "ResultVerified",
        F.col("MeasVerified").rlike("(?i)unknown"), "SampleCode",
    )
    event = ["StationName", "StationNumber", "Datetime", "Date"]
    wide = long_to_wide(
        long, event, "Analyte", [*UNSIGNED, *SIGNED], {"Result": "{name}", "Sign": "{name}_Sign"}, levels={"Sign": SIGNS}
    )
    # the pivot left one row per moment, so a station and day hold few rows: a plain join
    wide = lookup(wide, visit_observations(feeds, stations), ["StationName", "StationNumber", "Date"])
    places = stations.select("StationNumber", "StationName", "Latitude", "Longitude")
    return lookup(wide, places, ["StationName", "StationNumber"]).select(
        F.lit("NCRO").alias("Source"),
        F.col("StationName").alias("Station"),
        "Latitude",
        "Longitude",
        "Date",
        "Datetime",
        "Secchi",
        "Microcystis",
        *UNSIGNED,
        *[c for a in SIGNED for c in (F.coalesce(f"{a}_Sign", F.lit("=")).alias(f"{a}_Sign"), F.col(a))],
    )
