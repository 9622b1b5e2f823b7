"""Fall midwater trawl."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import add_local_time, parse
from tidemerge.functions.codes import trawl_tide
from tidemerge.functions.nulls import drop_all_null, drop_any_null, if_else
from tidemerge.functions.units import feet_to_metres, metres_to_centimetres
from tidemerge.operators.dedup import keep_first
from tidemerge.operators.joins import lookup
from tidemerge.operators.repair import null_above
from tidemerge.sources.registry import Feeds

FEEDS = {
    "sample": {
        "StationCode": "string", "SampleDate": "string", "SampleTimeStart": "string", "WaterTemperature": "double",
        "Turbidity": "double", "Secchi": "double", "SecchiEstimated": "boolean", "ConductivityTop": "double",
        "ConductivityBottom": "double", "TideCode": "int", "DepthBottom": "double", "Microcystis": "double",
        "BottomTemperature": "double",
    },
    "stations": {"StationCode": "string", "DD_Latitude": "double", "DD_Longitude": "double"},
}
STAMP = "M/d/yyyy H:mm:ss"
MEASURES = (
    "Microcystis", "Secchi", "Temperature", "Temperature_bottom", "Conductivity", "Conductivity_bottom", "TurbidityNTU",
)
# Fixed value: bottom temperatures above this many degrees were read in Fahrenheit.
HOTTEST_BOTTOM = 40.0


def clean(feeds: Feeds) -> DataFrame:
    day, clock = parse(F.col("SampleDate"), STAMP), parse(F.col("SampleTimeStart"), STAMP)
    zero = F.lit(0.0)
    # midnight stands for an unknown time
    timed = feeds["sample"].withColumn("Clock", clock)
    samples = add_local_time(timed, day, F.when(F.hour("Clock") != 0, F.col("Clock"))).select(
        F.lit("FMWT").alias("Source"),
        F.col("StationCode").alias("Station"),
        "Date",
        "Datetime",
        feet_to_metres(F.col("DepthBottom")).alias("Depth"),
        trawl_tide(F.col("TideCode"), keep_unmatched=False).alias("Tide"),
        if_else(F.col("Microcystis") == 6, F.lit(2.0), F.col("Microcystis")).alias("Microcystis"),
        metres_to_centimetres(F.col("Secchi")).alias("Secchi"),
        F.col("SecchiEstimated").alias("Secchi_estimated"),
        F.col("WaterTemperature").alias("Temperature"),
        null_above(F.nullif(F.col("BottomTemperature"), zero), HOTTEST_BOTTOM).alias("Temperature_bottom"),
        F.col("ConductivityTop").alias("Conductivity"),
        F.nullif(F.col("ConductivityBottom"), zero).alias("Conductivity_bottom"),
        F.col("Turbidity").alias("TurbidityNTU"),
        "_row",
    )
    stations = drop_any_null(
        feeds["stations"].select(
            F.col("StationCode").alias("Station"),
            F.col("DD_Latitude").alias("Latitude"),
            F.col("DD_Longitude").alias("Longitude"),
        )
    )
    placed = lookup(drop_all_null(samples, MEASURES), stations, ["Station"])
    return keep_first(placed, ["Source", "Station", "Date", "Datetime"]).select(
        "Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Depth", "Tide", "Microcystis", "Secchi",
        "Secchi_estimated", "Temperature", "Temperature_bottom", "Conductivity", "Conductivity_bottom", "TurbidityNTU",
    )
