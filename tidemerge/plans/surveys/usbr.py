"""Ship channel profiles: surface and bottom of each day's profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import add_local_stamp, parse, parse_date
from tidemerge.functions.text import recode, remove_first
from tidemerge.functions.units import feet_to_metres
from tidemerge.operators.depth import BIN, bin_daily
from tidemerge.operators.joins import lookup
from tidemerge.operators.reshape import long_to_wide
from tidemerge.sources.registry import Feeds

FEEDS = {
    "profiles": {
        "Station": "string", "Datetime": "string", "Depth_feet": "double", "Temperature": "double",
        "Conductivity": "double", "Chlorophyll": "double", "Date": "string",
    },
    "sites": {"Station": "string", "Latitude": "double", "Longitude": "double", "Depth_m": "double"},
}

# Headers of the raw files.
HEADERS = {
    "profiles": {
        "DateTime.PT": "Datetime", "Depth.feet": "Depth_feet", "Temp.C": "Temperature",
        "SpCond.uS": "Conductivity", "Chl.ug.L": "Chlorophyll",
    },
    "sites": {"Lat": "Latitude", "Long": "Longitude", "Depth (m)": "Depth_m"},
}

# The boundary between surface and bottom samples in feet, and a station's other name.
SURFACE_FEET = 3
STATION_NAMES = {"PS": "Pro"}


def clean(feeds: Feeds) -> DataFrame:
    timed = add_local_stamp(feeds["profiles"], parse(F.col("Datetime"), "yyyy-MM-dd H:mm:ss"))
    profiles = timed.select(
        "Station",
        parse_date(F.col("Date"), "yyyy-MM-dd").alias("Date"),
        "Datetime",
        F.col("Depth_feet").alias("Sample_depth"),
        "Temperature",
        "Conductivity",
        "Chlorophyll",
    )
    ends = bin_daily(profiles, ["Station", "Date"], "Sample_depth", SURFACE_FEET, "Datetime")
    values = {v: v + "_{name}" for v in ("Sample_depth", "Conductivity", "Chlorophyll", "Temperature")}
    wide = long_to_wide(ends, ["Station", "Date", "Datetime"], BIN, ["surface", "bottom"], values, how="mean")
    sites = feeds["sites"].select(
        recode(remove_first(F.col("Station"), "NL "), STATION_NAMES).alias("Station"),
        "Latitude",
        "Longitude",
        F.col("Depth_m").alias("Depth"),
    )
    return lookup(wide, sites, ["Station"]).select(
        F.lit("USBR").alias("Source"),
        "Station",
        "Latitude",
        "Longitude",
        "Date",
        "Datetime",
        "Depth",
        feet_to_metres(F.col("Sample_depth_surface")).alias("Sample_depth_surface"),
        feet_to_metres(F.col("Sample_depth_bottom")).alias("Sample_depth_bottom"),
        F.col("Chlorophyll_surface").alias("Chlorophyll"),
        F.col("Temperature_surface").alias("Temperature"),
        "Temperature_bottom",
        F.col("Conductivity_surface").alias("Conductivity"),
    )
