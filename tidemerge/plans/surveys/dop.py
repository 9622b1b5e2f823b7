"""Directed outflow project tows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import add_local_stamp, parse, parse_date
from tidemerge.functions.nulls import not_in
from tidemerge.functions.text import paste
from tidemerge.functions.units import feet_to_metres
from tidemerge.operators.dedup import ROW, keep_first
from tidemerge.sources.registry import Feeds

FEEDS = {
    "tow": {
        "Date": "string", "Latitude": "double", "Longitude": "double", "Station_Code": "string",
        "Habitat": "string", "Conductivity": "double", "Temperature": "double", "Secchi": "double",
        "Start_Time": "string", "pH": "double", "Chl_a": "double", "Start_Depth": "double",
        "Salinity": "double", "Turbidity": "double", "DO": "double",
    }
}

# Habitats whose depth compares with no other survey.
LEFT_OUT = ("Channel Deep", "Oblique")

MEASURES = (
    "Secchi", "Temperature", "Salinity", "Conductivity", "DissolvedOxygen", "pH", "TurbidityFNU", "Chlorophyll",
)


def clean(feeds: Feeds) -> DataFrame:
    time = parse(F.concat_ws(" ", "Date", "Start_Time"), "yyyy-MM-dd H:mm:ss")
    included = feeds["tow"].filter(not_in(F.col("Habitat"), LEFT_OUT))
    tows = add_local_stamp(included, time).select(
        F.lit("DOP").alias("Source"),
        paste(F.col("Station_Code"), F.col("Habitat")).alias("Station"),
        "Latitude",
        "Longitude",
        F.lit(True).alias("Field_coords"),
        parse_date(F.col("Date"), "yyyy-MM-dd").alias("Date"),
        "Datetime",
        feet_to_metres(F.col("Start_Depth")).alias("Depth"),
        "Secchi",
        "Temperature",
        "Salinity",
        "Conductivity",
        F.col("DO").alias("DissolvedOxygen"),
        "pH",
        F.col("Turbidity").alias("TurbidityFNU"),
        F.col("Chl_a").alias("Chlorophyll"),
        ROW,
    )
    earliest = [F.col("Datetime").asc_nulls_last(), ROW]
    return keep_first(tows, ["Station", "Date", *MEASURES], earliest).drop(ROW)
