"""Summer townet survey."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import add_local_time, parse
from tidemerge.functions.codes import trawl_tide
from tidemerge.functions.nulls import drop_all_null, drop_any_null
from tidemerge.functions.units import feet_to_metres
from tidemerge.operators.joins import lookup
from tidemerge.operators.spread import spread_join
from tidemerge.plans.surveys.stations import DMS_COLUMNS, dms_stations
from tidemerge.sources.registry import Feeds

FEEDS = {
    "sample": {
        "SampleRowID": "int", "SampleDate": "string", "StationCode": "string", "TemperatureTop": "double",
        "TemperatureBottom": "double", "Secchi": "double", "ConductivityTop": "double", "ConductivityBottom": "double",
        "TideCode": "int", "DepthBottom": "double", "SampleComments": "string", "Microcystis": "double",
        "TurbidityTop": "double",
    },
    "tow_effort": {"SampleRowID": "int", "TimeStart": "string"},
    "stations": {"StationCodeSTN": "string", **DMS_COLUMNS},
}
STAMP = "M/d/yyyy H:mm:ss"
MEASURES = (
    "Microcystis", "Secchi", "Temperature", "Temperature_bottom", "Conductivity", "Conductivity_bottom", "TurbidityNTU",
)


def clean(feeds: Feeds) -> DataFrame:
    tows = feeds["tow_effort"].select("SampleRowID", parse(F.col("TimeStart"), STAMP).alias("Time"))
    # the least time passes over missing ones; a filter before it would read each text twice
    first_tow = drop_any_null(tows.groupBy("SampleRowID").agg(F.min("Time").alias("Time")))
    day = parse(F.col("SampleDate"), STAMP)
    timed = add_local_time(spread_join(feeds["sample"], first_tow, ["SampleRowID"]), day, F.col("Time"))
    samples = timed.select(
        F.lit("STN").alias("Source"),
        F.col("StationCode").alias("Station"),
        "Date",
        "Datetime",
        feet_to_metres(F.col("DepthBottom")).alias("Depth"),
        trawl_tide(F.col("TideCode")).alias("Tide"),
        "Microcystis",
        "Secchi",
        F.col("TemperatureTop").alias("Temperature"),
        F.col("TemperatureBottom").alias("Temperature_bottom"),
        F.col("ConductivityTop").alias("Conductivity"),
        F.col("ConductivityBottom").alias("Conductivity_bottom"),
        F.col("TurbidityTop").alias("TurbidityNTU"),
        F.col("SampleComments").alias("Notes"),
    )
    stations = dms_stations(feeds["stations"].withColumnRenamed("StationCodeSTN", "Station"))
    return lookup(drop_all_null(samples, MEASURES), stations, ["Station"]).select(
        "Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Depth", "Tide", "Microcystis", "Secchi",
        "Temperature", "Temperature_bottom", "Conductivity", "Conductivity_bottom", "TurbidityNTU", "Notes",
    )
