"""Station tables in degrees, minutes and seconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.coords import dms
from tidemerge.functions.nulls import drop_any_null

DMS_COLUMNS = {c: "double" for c in ("LatD", "LatM", "LatS", "LonD", "LonM", "LonS")}


def with_dms(df: DataFrame, parts: Sequence[str] = tuple(DMS_COLUMNS)) -> DataFrame:
    """Add Latitude and (western) Longitude from six part columns."""
    cols = [F.col(p) for p in parts]
    return df.withColumns({"Latitude": dms(*cols[:3]), "Longitude": dms(*cols[3:], -1)})


def dms_stations(df: DataFrame, parts: Sequence[str] = tuple(DMS_COLUMNS)) -> DataFrame:
    """Stations with a known position."""
    return drop_any_null(with_dms(df, parts).select("Station", "Latitude", "Longitude"))
