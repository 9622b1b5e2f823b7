"""Environmental monitoring program: wide table with signed analytes, times in PST."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import PST, parse, parse_date, to_local
from tidemerge.functions.codes import rounded_index
from tidemerge.functions.coords import prefer_station_coords
from tidemerge.functions.nulls import drop_any_null
from tidemerge.functions.units import feet_to_metres
from tidemerge.operators.joins import lookup
from tidemerge.sources.registry import Feeds

# Raw name of each measure.
RENAMES = {
    "FieldNotes": "Notes", "Chla": "Chlorophyll", "Chla_Sign": "Chlorophyll_Sign",
    "SpCndSurface": "Conductivity", "SpCndBottom": "Conductivity_bottom",
    "WTSurface": "Temperature", "WTBottom": "Temperature_bottom",
    "DOSurface": "DissolvedOxygen", "DOBottom": "DissolvedOxygen_bottom",
    "DOpercentSurface": "DissolvedOxygenPercent", "DOpercentBottom": "DissolvedOxygenPercent_bottom",
    "TurbiditySurface_FNU": "TurbidityFNU", "TurbidityBottom_FNU": "TurbidityFNU_bottom",
    "TurbiditySurface_NTU": "TurbidityNTU", "TurbidityBottom_NTU": "TurbidityNTU_bottom",
    "pHSurface": "pH", "pHBottom": "pH_bottom", "NorthLat": "Latitude", "WestLong": "Longitude",
}
# Signed analytes after chlorophyll, in the order they are reported.
SIGNED = (
    "Pheophytin", "TotAlkalinity", "TotAmmonia", "DissAmmonia", "DissBromide", "DissCalcium", "TotChloride",
    "DissChloride", "DissNitrateNitrite", "DOC", "TOC", "DON", "TON", "DissOrthophos", "TotPhos", "DissSilica",
    "TDS", "TSS", "VSS", "TKN",
)
_SIGNED_COLUMNS = [c for a in SIGNED for c in (f"{a}_Sign", a)]
_TEXT = {"FieldNotes", "Chla_Sign"}
FEEDS = {
    "measures": {
        "Station": "string", "Date": "string", "Time": "string", "Depth": "double", "Secchi": "double",
        "Microcystis": "double",
        **{c: "string" if c in _TEXT else "double" for c in RENAMES},
        **{c: "string" if c.endswith("_Sign") else "double" for c in _SIGNED_COLUMNS},
    },
    "stations": {"Station": "string", "Latitude": "double", "Longitude": "double"},
}


def clean(feeds: Feeds) -> DataFrame:
    clock = parse(F.concat_ws(" ", "Date", "Time"), "yyyy-MM-dd H:mm:ss")
    # midnight stands for an unknown time
    timed = F.when(F.hour("_clock") != 0, to_local(F.col("_clock"), PST))
    visits = feeds["measures"].withColumnsRenamed(RENAMES).withColumn("_clock", clock).withColumns(
        {
            "Source": F.lit("EMP"),
            "Datetime": timed,
            "Date": parse_date(F.col("Date"), "yyyy-MM-dd"),
            "Microcystis": rounded_index(F.col("Microcystis")),
            "Tide": F.lit("High Slack"),
            "Depth": feet_to_metres(F.col("Depth")),
        }
    )
    stations = drop_any_null(feeds["stations"], ["Station", "Latitude", "Longitude"])
    placed = prefer_station_coords(
        lookup(visits, stations.select("Station", "Latitude", "Longitude"), ["Station"], suffix="_field")
    )
    return placed.select(
        "Source", "Station", "Latitude", "Longitude", "Field_coords", "Date", "Datetime", "Notes", "Depth", "Tide",
        "Microcystis", "Chlorophyll_Sign", "Chlorophyll", "Secchi", "Temperature", "Temperature_bottom",
        "Conductivity", "Conductivity_bottom", "DissolvedOxygen", "DissolvedOxygen_bottom",
        "DissolvedOxygenPercent", "DissolvedOxygenPercent_bottom", "pH", "pH_bottom",
        "TurbidityNTU", "TurbidityNTU_bottom", "TurbidityFNU", "TurbidityFNU_bottom", *_SIGNED_COLUMNS,
    )
