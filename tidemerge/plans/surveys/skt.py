"""Spring Kodiak trawl: positions typed by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import add_local_time, parse
from tidemerge.functions.codes import TRAWL_TIDES
from tidemerge.functions.coords import dirty_dms, prefer_station_coords
from tidemerge.functions.text import recode
from tidemerge.functions.units import feet_to_metres
from tidemerge.operators.joins import lookup
from tidemerge.operators.repair import null_when_noted
from tidemerge.plans.surveys.stations import dms_stations
from tidemerge.sources.registry import Feeds

_PARTS = ("LatDeg", "LatMin", "LatSec", "LongDec", "LongMin", "LongSec")
FEEDS = {
    "sample": {
        "SampleDate": "string", "StationCode": "string", "SampleTimeStart": "string", "Secchi": "double",
        "ConductivityTop": "double", "WaterTemperature": "double", "DepthBottom": "double", "TideCode": "int",
        "SampleComments": "string", "Latitude": "string", "Longitude": "string",
    },
    "stations": {"Station": "string", **{p: "double" for p in _PARTS}},
}
STAMP = "M/d/yyyy H:mm:ss"

# A mistyped longitude, a visit recorded at midnight instead of noon, the missing tide code.
LONGITUDE_TYPOS = {"121-29.41.7": "121-29-41.7"}
NOON_VISITS = (("2018-03-06", "519"),)
TIDES = {**TRAWL_TIDES, "0": None}


def clean(feeds: Feeds) -> DataFrame:
    # a column of its own, as the noon visits ask for the day too
    dated = feeds["sample"].withColumn("_day", parse(F.col("SampleDate"), STAMP))
    day, clock = F.col("_day"), parse(F.col("SampleTimeStart"), STAMP)
    noon = F.lit("1899-12-30 12:00:00").cast("timestamp_ntz")
    for visit_day, station in NOON_VISITS:
        at_noon = (day.cast("date") == F.lit(visit_day).cast("date")) & (F.col("StationCode") == station)
        clock = F.when(at_noon, noon).when(~at_noon, clock)
    longitude = recode(F.nullif(F.col("Longitude"), F.lit("0")), LONGITUDE_TYPOS)

    def unless_cdec(name):
        return null_when_noted(F.col("SampleComments"), "from CDEC", F.col(name), missing_notes_too=False)

    samples = add_local_time(dated, day, clock).select(
        F.lit("SKT").alias("Source"),
        F.col("StationCode").alias("Station"),
        dirty_dms(F.nullif(F.col("Latitude"), F.lit("0"))).alias("Latitude"),
        dirty_dms(longitude, -1).alias("Longitude"),
        "Date",
        "Datetime",
        feet_to_metres(F.col("DepthBottom")).alias("Depth"),
        recode(F.col("TideCode").cast("string"), TIDES).alias("Tide"),
        "Secchi",
        unless_cdec("WaterTemperature").alias("Temperature"),
        unless_cdec("ConductivityTop").alias("Conductivity"),
        F.col("SampleComments").alias("Notes"),
    )
    stations = dms_stations(feeds["stations"], _PARTS)
    return prefer_station_coords(lookup(samples, stations, ["Station"], suffix="_field")).select(
        "Source", "Station", "Latitude", "Longitude", "Field_coords", "Date", "Datetime", "Depth", "Tide", "Secchi",
        "Temperature", "Conductivity", "Notes",
    )
