"""Delta juvenile fish trawls."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import add_local_stamp, parse, parse_date
from tidemerge.functions.units import metres_to_centimetres
from tidemerge.operators.dedup import keep_first
from tidemerge.operators.joins import lookup
from tidemerge.operators.repair import null_before
from tidemerge.operators.reshape import stack
from tidemerge.sources.registry import Feeds

_TRAWL = {
    "StationCode": "string", "SampleDate": "string", "SampleTime": "string",
    "SpecificConductance": "double", "WaterTemp": "double", "Secchi": "double", "DO": "double",
}
FEEDS = {
    "trawl_early": _TRAWL,
    "trawl_late": _TRAWL,
    "sites": {"StationCode": "string", "Latitude": "double", "Longitude": "double"},
}

# Fixed value: conductivity was not standardised before this day.
FIRST_STANDARD_DAY = datetime.date(2019, 6, 1)


def clean(feeds: Feeds) -> DataFrame:
    day = parse_date(F.col("SampleDate"), "yyyy-MM-dd")
    time = parse(F.concat_ws(" ", F.col("Date"), F.col("SampleTime")), "yyyy-MM-dd H:mm:ss")
    trawls = (
        stack([feeds["trawl_early"], feeds["trawl_late"]])
        .withColumn("Date", day)
        .withColumns(
            {
                "Station": F.col("StationCode"),
                "Secchi": metres_to_centimetres(F.col("Secchi")),
                "Conductivity": null_before(F.col("Date"), FIRST_STANDARD_DAY, F.col("SpecificConductance")),
            }
        )
    )
    sites = feeds["sites"].select(F.col("StationCode").alias("Station"), "Latitude", "Longitude")
    trawls = add_local_stamp(trawls, time)
    return lookup(keep_first(trawls, ["Station", "Datetime"]), sites, ["Station"]).select(
        F.lit("DJFMP").alias("Source"), "Station", "Latitude", "Longitude", "Date", "Datetime", "Secchi",
        F.col("WaterTemp").alias("Temperature"), "Conductivity", F.col("DO").alias("DissolvedOxygen"),
    )
