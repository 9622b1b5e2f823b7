"""Smelt larva survey."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import add_local_time, parse
from tidemerge.functions.codes import trawl_tide
from tidemerge.functions.units import feet_to_metres
from tidemerge.operators.joins import lookup
from tidemerge.operators.repair import null_when_noted
from tidemerge.operators.spread import spread_join
from tidemerge.plans.surveys.stations import DMS_COLUMNS, dms_stations
from tidemerge.sources.registry import Feeds

FEEDS = {
    "water_info": {
        "Date": "string", "Station": "string", "Temp": "double", "TopEC": "double", "Secchi": "double",
        "Comments": "string",
    },
    "tow_info": {
        "Date": "string", "Station": "string", "Time": "string", "Tide": "double", "BottomDepth": "double",
    },
    "stations": {"Station": "string", **DMS_COLUMNS},
}
STAMP = "M/d/yyyy H:mm:ss"


def clean(feeds: Feeds) -> DataFrame:
    tows = feeds["tow_info"].drop("_row")
    visits = spread_join(feeds["water_info"], tows, ["Date", "Station"])
    day, clock = parse(F.col("Date"), STAMP), parse(F.col("Time"), STAMP)
    timed = add_local_time(visits, day, clock)
    return lookup(timed, dms_stations(feeds["stations"]), ["Station"]).select(
        F.lit("SLS").alias("Source"),
        "Station",
        "Latitude",
        "Longitude",
        "Date",
        "Datetime",
        feet_to_metres(F.col("BottomDepth")).alias("Depth"),
        trawl_tide(F.col("Tide")).alias("Tide"),
        "Secchi",
        F.col("Temp").alias("Temperature"),
        # visits without notes lose their conductivity too, as in the published data
        null_when_noted(F.col("Comments"), "CDEC", F.col("TopEC")).alias("Conductivity"),
        F.col("Comments").alias("Notes"),
    )
