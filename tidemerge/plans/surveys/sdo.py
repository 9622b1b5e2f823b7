"""Ship channel dissolved oxygen runs: a wide table, then a year recorded by depth. Times in PST."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import PST, at, parse, parse_date, to_local
from tidemerge.functions.codes import rounded_index
from tidemerge.functions.nulls import drop_all_null, number
from tidemerge.functions.text import number_text, pad_left, recode
from tidemerge.operators.joins import lookup
from tidemerge.operators.reshape import long_to_wide, strip_suffix
from tidemerge.sources.registry import Feeds

FEEDS = {
    "wide": {
        "Date": "string", "Time": "string", "StationID": "string", "WTSurface": "double", "WTBottom": "double",
        "SpCndSurface": "double", "SpCndBottom": "double", "Secchi": "double", "Microcystis": "string",
        "DOSurface": "double", "DOBottom": "double", "pHSurface": "double", "pHBottom": "double",
    },
    "by_depth": {
        "Description": "string", "Date": "date", "Time_PST": "timestamp_ntz", "Depth_m": "double",
        "MC_Score": "double", "Secchi_cm": "double", "Temperature": "double", "Conductivity": "double",
        "DissolvedOxygen": "double", "pH": "double",
    },
    "sites": {"StationID": "string", "Latitude": "double", "Longitude": "double"},
}

# Headers of the raw file.
HEADERS = {
    "by_depth": {
        "Time (PST)": "Time_PST", "Depth (m)": "Depth_m", "MC Score": "MC_Score", "Secchi (cm)": "Secchi_cm",
        "Water Temp (°C)": "Temperature", "Sp Cond (µS/cm)": "Conductivity", "DO (mg/L)": "DissolvedOxygen",
    },
}

# A time missing a digit, words that are no index, station names, coded depths.
TIME_TYPOS = {"111": "1111"}
NOT_AN_INDEX = {"present": None, "absent": None}
STATION_NAMES = {"Turning Basin": "tb", "P8": "lt40", "Light 41": "lt41", "Light 43": "lt43", "Light 48": "lt48"}
DEPTH_NAMES = {"1": "top", "3": "mid", "6": "bottom"}


def _wide(feeds: Feeds, sites: DataFrame) -> DataFrame:
    clock_text = pad_left(recode(F.col("Time"), TIME_TYPOS), 4)
    clock = parse(F.concat_ws(" ", F.col("Date"), clock_text), "M/d/yyyy HHmm")
    index = recode(F.col("Microcystis"), NOT_AN_INDEX)
    runs = feeds["wide"].select(
        F.lit("SDO").alias("Source"),
        F.col("StationID").alias("Station"),
        parse_date(F.col("Date"), "M/d/yyyy").alias("Date"),
        to_local(clock, PST).alias("Datetime"),
        rounded_index(number(index)).alias("Microcystis"),
        "Secchi",
        F.col("WTSurface").alias("Temperature"),
        F.col("WTBottom").alias("Temperature_bottom"),
        F.col("SpCndSurface").alias("Conductivity"),
        F.col("SpCndBottom").alias("Conductivity_bottom"),
        F.col("DOSurface").alias("DissolvedOxygen"),
        F.col("DOBottom").alias("DissolvedOxygen_bottom"),
        F.col("pHSurface").alias("pH"),
        F.col("pHBottom").alias("pH_bottom"),
    )
    measures = [f.name for f in runs.schema.fields if f.dataType.simpleString() == "double"]
    return lookup(drop_all_null(runs, measures), sites, ["Station"])


def _by_depth(feeds: Feeds, sites: DataFrame) -> DataFrame:
    depth_name = recode(number_text(F.col("Depth_m")), DEPTH_NAMES, keep_unmatched=False)
    samples = feeds["by_depth"].select(
        F.lit("SDO").alias("Source"),
        recode(F.col("Description"), STATION_NAMES).alias("Station"),
        to_local(at(F.col("Date"), F.col("Time_PST")), PST).alias("Datetime"),
        "Date",
        depth_name.alias("DepthBin"),
        F.col("MC_Score").alias("Microcystis"),
        F.col("Secchi_cm").alias("Secchi"),
        "Temperature",
        "Conductivity",
        "DissolvedOxygen",
        "pH",
        "_row",
    ).filter(F.col("DepthBin") != "mid")
    event = ["Source", "Station", "Datetime", "Date", "Microcystis", "Secchi"]
    values = {v: v + "_{name}" for v in ("Temperature", "Conductivity", "DissolvedOxygen", "pH")}
    wide = long_to_wide(samples, event, "DepthBin", ["top", "bottom"], values)
    return lookup(strip_suffix(wide, "_top"), sites, ["Station"])


def clean(feeds: Feeds) -> DataFrame:
    sites = feeds["sites"].select(F.col("StationID").alias("Station"), "Latitude", "Longitude")
    return _wide(feeds, sites).unionByName(_by_depth(feeds, sites)).select(
        "Source", "Station", "Latitude", "Longitude", "Date", "Datetime", "Microcystis", "Secchi", "Temperature",
        "Temperature_bottom", "Conductivity", "Conductivity_bottom", "DissolvedOxygen", "DissolvedOxygen_bottom",
        "pH", "pH_bottom",
    )
