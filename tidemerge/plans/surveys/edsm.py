"""Enhanced delta smelt monitoring: two gears with different columns."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import add_local_stamp, parse, parse_date
from tidemerge.functions.text import paste, recode
from tidemerge.functions.units import feet_to_metres, metres_to_centimetres
from tidemerge.operators.dedup import keep_first
from tidemerge.operators.repair import null_before
from tidemerge.operators.reshape import stack
from tidemerge.sources.registry import Feeds

_SHARED = {
    "SampleDate": "string", "LatitudeStart": "double", "LongitudeStart": "double", "StationCode": "string",
    "Secchi": "double", "SampleTime": "string", "Tide": "string", "BottomDepth": "double", "Comments": "string",
}
FEEDS = {
    "20mm": {
        **_SHARED, "SpecificConductanceTop": "double", "WaterTempTop": "double", "WaterTempBottom": "double",
        "DOTop": "double", "DOBottom": "double",
    },
    "KDTR": {**_SHARED, "SpecificConductance": "double", "WaterTemp": "double", "DO": "double"},
}

# Tide codes, and the first day of standardised conductivity.
TIDES = {"HS": "High Slack", "LS": "Low Slack"}
FIRST_STANDARD_DAY = datetime.date(2019, 6, 1)


def clean(feeds: Feeds) -> DataFrame:
    by_feet = feeds["20mm"].withColumnsRenamed(
        {
            "SpecificConductanceTop": "Conductivity", "WaterTempTop": "Temperature",
            "WaterTempBottom": "Temperature_bottom", "DOTop": "DissolvedOxygen", "DOBottom": "DissolvedOxygen_bottom",
        }
    ).withColumn("Depth", feet_to_metres(F.col("BottomDepth")))
    by_metres = feeds["KDTR"].withColumnsRenamed(
        {"SpecificConductance": "Conductivity", "WaterTemp": "Temperature", "DO": "DissolvedOxygen"}
    ).withColumn("Depth", F.col("BottomDepth"))
    time = parse(F.concat_ws(" ", "Date", "SampleTime"), "yyyy-MM-dd H:mm:ss")
    tows = (
        stack([by_feet, by_metres])
        .withColumns(
            {
                "Station": paste(F.col("StationCode"), F.col("SampleDate")),
                "Date": parse_date(F.col("SampleDate"), "yyyy-MM-dd", "M/d/yyyy"),
            }
        )
        .withColumns(
            {
                "Source": F.lit("EDSM"),
                "Latitude": F.col("LatitudeStart"),
                "Longitude": F.col("LongitudeStart"),
                "Field_coords": F.lit(True),
                "Tide": recode(F.col("Tide"), TIDES),
                "Secchi": metres_to_centimetres(F.col("Secchi")),
                "Conductivity": null_before(F.col("Date"), FIRST_STANDARD_DAY, F.col("Conductivity")),
                "Notes": F.col("Comments"),
            }
        )
    )
    tows = add_local_stamp(tows, time)
    place_and_time = ["Source", "Station", "Latitude", "Longitude", "Date", "Datetime"]
    return keep_first(tows, place_and_time).select(
        "Source", "Station", "Latitude", "Longitude", "Field_coords", "Date", "Datetime", "Depth", "Tide", "Secchi",
        "Temperature", "Temperature_bottom", "Conductivity", "DissolvedOxygen", "DissolvedOxygen_bottom", "Notes",
    )
