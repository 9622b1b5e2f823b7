"""20-mm survey: stations visited, their survey dates and first tows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import add_hours, add_local_time, parse
from tidemerge.functions.codes import trawl_tide
from tidemerge.functions.coords import prefer_station_coords
from tidemerge.functions.units import feet_to_metres
from tidemerge.operators.dedup import keep_extreme
from tidemerge.operators.joins import lookup
from tidemerge.operators.spread import spread_join
from tidemerge.plans.surveys.stations import DMS_COLUMNS, dms_stations, with_dms
from tidemerge.sources.registry import Feeds

_PARTS = ("LatDeg", "LatMin", "LatSec", "LonDeg", "LonMin", "LonSec")
FEEDS = {
    "stations": {"Station": "string", **DMS_COLUMNS},
    "visit": {
        "StationID": "string", "SurveyID": "string", "Station": "string", **{p: "double" for p in _PARTS},
        "Temp": "double", "TopEC": "double", "BottomEC": "double", "Secchi": "double", "Comments": "string",
    },
    "survey": {"SurveyID": "string", "SampleDate": "string"},
    "tow": {
        "StationID": "string", "TowTime": "string", "Tide": "double", "BottomDepth": "double", "TowNum": "double",
    },
}
STAMP = "M/d/yyyy H:mm:ss"

# Hours written on a twelve-hour clock.
AFTERNOON_HOURS = (1, 2)


def first_tows(tows: DataFrame) -> DataFrame:
    """Earliest tow of each visit; at equal times the lowest tow number."""
    clock = parse(F.col("TowTime"), STAMP)
    timed = tows.select("StationID", clock.alias("Time"), "Tide", "BottomDepth", "TowNum")
    time = F.col("Time")
    timed = timed.withColumn("Time", F.when(F.hour(time).isin(*AFTERNOON_HOURS), add_hours(time, 12)).otherwise(time))
    return keep_extreme(timed, ["StationID"], "Time", "TowNum", few_ties=True).drop("TowNum")


def clean(feeds: Feeds) -> DataFrame:
    dates = feeds["survey"].select("SurveyID", parse(F.col("SampleDate"), STAMP).cast("date").alias("Date"))
    visits = with_dms(feeds["visit"], _PARTS).drop(*_PARTS)
    visits = lookup(spread_join(visits, first_tows(feeds["tow"]), ["StationID"]), dates, ["SurveyID"])
    visits = add_local_time(visits, F.col("Date"), F.col("Time")).select(
        F.lit("20mm").alias("Source"),
        "Station",
        "Latitude",
        "Longitude",
        "Date",
        "Datetime",
        feet_to_metres(F.col("BottomDepth")).alias("Depth"),
        trawl_tide(F.col("Tide")).alias("Tide"),
        "Secchi",
        F.col("Temp").alias("Temperature"),
        F.col("TopEC").alias("Conductivity"),
        F.col("BottomEC").alias("Conductivity_bottom"),
        F.col("Comments").alias("Notes"),
    )
    stations = dms_stations(feeds["stations"])
    return prefer_station_coords(lookup(visits, stations, ["Station"], suffix="_field")).select(
        "Source", "Station", "Latitude", "Longitude", "Field_coords", "Date", "Datetime", "Depth", "Tide", "Secchi",
        "Temperature", "Conductivity", "Conductivity_bottom", "Notes",
    )
