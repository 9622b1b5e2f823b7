"""San Francisco Bay study: the tow drives, the station visit fills in."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import add_local_time, parse
from tidemerge.functions.coords import degree_minute_text, packed_degrees, prefer_station_coords
from tidemerge.functions.text import number_text, recode
from tidemerge.operators.dedup import keep_extreme, keep_first
from tidemerge.operators.joins import lookup
from tidemerge.operators.spread import spread_join
from tidemerge.sources.registry import Feeds

FEEDS = {
    "stations": {"Station": "string", "Latitude": "string", "Longitude": "string"},
    "tide_codes": {"Tide": "int", "Description": "string"},
    "boat_station": {
        "Year": "int", "Survey": "int", "Station": "string", "Date": "string", "Depth": "double",
        "Secchi": "double", "Tide": "int",
    },
    "salin_temp": {
        "Year": "int", "Survey": "int", "Station": "string", "ECSurf": "double", "ECBott": "double",
        "TempSurf": "double", "TempBott": "double",
    },
    "boat_tow": {
        "Year": "int", "Survey": "int", "Station": "string", "Time": "string", "Tide": "int",
        "StartLat": "double", "StartLong": "double",
    },
}
STAMP = "M/d/yyyy H:mm:ss"
VISIT = ["Year", "Survey", "Station"]

# The first day of decimal minutes, a station that is left out, one under its plain name.
FIRST_DECIMAL_DAY = datetime.date(1990, 5, 1)
LEFT_OUT = "211E"
STATION_NAMES = {"211W": "211"}


def _with_tide(df: DataFrame, codes: DataFrame, name: str) -> DataFrame:
    return lookup(df, codes, ["Tide"]).drop("Tide").withColumnRenamed("Description", name)


def clean(feeds: Feeds) -> DataFrame:
    codes = feeds["tide_codes"].select("Tide", "Description")
    stations = feeds["stations"].filter(F.col("Station") != LEFT_OUT).select(
        recode(F.col("Station"), STATION_NAMES).alias("Station"),
        degree_minute_text(F.col("Latitude")).alias("Latitude"),
        degree_minute_text(F.col("Longitude"), west=True).alias("Longitude"),
    )
    boat_stations = feeds["boat_station"].drop("_row").withColumn("Date", parse(F.col("Date"), STAMP).cast("date"))
    visits = spread_join(boat_stations, feeds["salin_temp"].drop("_row"), VISIT)
    visits = _with_tide(visits, codes, "Tidestation")
    tows = feeds["boat_tow"].withColumn("Time", parse(F.col("Time"), STAMP))
    tows = _with_tide(keep_extreme(tows, VISIT, "Time", few_ties=True), codes, "Tidetow")

    decimal = F.col("Date") >= F.lit(FIRST_DECIMAL_DAY)
    towed = spread_join(tows, visits, VISIT, counted=feeds["boat_tow"])
    towed = towed.withColumns({"_lat": number_text(F.col("StartLat")), "_long": number_text(F.col("StartLong"))})
    towed = add_local_time(towed, F.col("Date"), F.col("Time")).select(
        F.lit("Baystudy").alias("Source"),
        "Station",
        packed_degrees(F.col("_lat"), 2, decimal).alias("Latitude"),
        packed_degrees(F.col("_long"), 3, decimal, -1).alias("Longitude"),
        "Date",
        "Datetime",
        "Depth",
        F.coalesce("Tidetow", "Tidestation").alias("Tide"),
        "Secchi",
        F.col("TempSurf").alias("Temperature"),
        F.col("TempBott").alias("Temperature_bottom"),
        F.col("ECSurf").alias("Conductivity"),
        F.col("ECBott").alias("Conductivity_bottom"),
        "_row",
    )
    placed = prefer_station_coords(lookup(towed, stations, ["Station"], suffix="_field"))
    return keep_first(placed, ["Source", "Station", "Date", "Datetime"]).select(
        "Source", "Station", "Latitude", "Longitude", "Field_coords", "Date", "Datetime", "Depth", "Tide", "Secchi",
        "Temperature", "Temperature_bottom", "Conductivity", "Conductivity_bottom",
    )
