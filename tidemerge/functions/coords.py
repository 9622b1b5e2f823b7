"""Coordinates: degrees-minutes-seconds, packed numbers, dirty text, fallback rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.nulls import if_else, number
from tidemerge.functions.text import remove_first


def dms(degrees: Column, minutes: Column, seconds: Column, sign: int = 1) -> Column:
    """Decimal degrees; NULL if any part is NULL."""
    return (degrees + minutes / 60 + seconds / 3600) * sign


def degree_minute_text(col: Column, *, west: bool = False) -> Column:
    """Decimal degrees of text such as ``37°54.1``; western degrees carry their own minus."""
    parts = F.split(col, "°")
    degrees, minutes = number(F.get(parts, F.lit(0))), number(F.get(parts, F.lit(1)))
    return degrees - minutes / 60 if west else degrees + minutes / 60


def dirty_dms(col: Column, sign: int = 1) -> Column:
    """Decimal degrees of ``d-m-s`` text that may trail quote marks or hold a stray letter."""
    clean = F.substring_index(F.substring_index(col, '"', 1), "'", 1)
    clean = remove_first(clean, "[a-zA-Z]")
    parts = F.split(clean, "-")
    d, m, s = (number(F.get(parts, F.lit(i))) for i in range(3))
    return dms(d, m, s, sign)


def packed_degrees(digits: Column, degree_digits: int, decimal_minutes: Column, sign: int = 1) -> Column:
    """Decimal degrees of a packed number.

    The number reads degrees, two digits of minutes, then seconds; where
    ``decimal_minutes`` is true the tail is the decimal part of the minutes.
    """
    first = degree_digits + 1
    degrees = number(F.substring(digits, 1, degree_digits))
    whole_minutes = F.substring(digits, first, 2)
    tail = F.substring(digits, first + 2, 20)
    by_seconds = degrees + number(whole_minutes) / 60 + number(tail) / 3600
    by_minutes = degrees + number(F.concat(whole_minutes, F.lit("."), tail)) / 60
    return if_else(decimal_minutes, by_minutes, by_seconds) * sign


def prefer_station_coords(df: DataFrame, field: str = "_field") -> DataFrame:
    """Fill missing station coordinates from the field ones and flag the rows that used them."""
    lat, lon = F.col("Latitude"), F.col("Longitude")
    flat, flon = F.col("Latitude" + field), F.col("Longitude" + field)
    from_field = (lat.isNull() & flat.isNotNull()) | (lon.isNull() & flon.isNotNull())
    return df.withColumns(
        {
            "Field_coords": from_field,
            "Latitude": F.coalesce(lat, flat),
            "Longitude": F.coalesce(lon, flon),
        }
    ).drop("Latitude" + field, "Longitude" + field)
