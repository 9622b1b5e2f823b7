"""Checks on cleaned tables. Each returns the violations as a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.text import number_text
from tidemerge.operators.dedup import duplicate_keys
from tidemerge.sources.vocabulary import DOMAINS

IDENTITY = ("Source", "Station", "Date", "Datetime", "Latitude", "Longitude")


def row_conservation(parts: Mapping[str, DataFrame], whole: DataFrame, by: str = "Source") -> DataFrame:
    """Sources whose row count differs between their own table and the integrated one."""
    counts = None
    for name, part in parts.items():
        one = part.select(F.lit(name).alias(by), F.lit(1).alias("side"))
        counts = one if counts is None else counts.unionByName(one)
    counts = counts.unionByName(whole.select(F.col(by), F.lit(2).alias("side")))
    return (
        counts.groupBy(by)
        .agg(F.count_if(F.col("side") == 1).alias("rows_in"), F.count_if(F.col("side") == 2).alias("rows_out"))
        .filter("rows_in <> rows_out")
    )


def not_unique(df: DataFrame, keys: Sequence[str] = IDENTITY) -> DataFrame:
    return duplicate_keys(df, keys)


def out_of_bounds(
    df: DataFrame, latitude=(37.0, 39.0), longitude=(-123.0, -121.0), lat: str = "Latitude", lon: str = "Longitude"
) -> DataFrame:
    """Rows placed on or outside the strict bounds; rows without a position pass."""
    inside_lat = (F.col(lat) > latitude[0]) & (F.col(lat) < latitude[1])
    inside_lon = (F.col(lon) > longitude[0]) & (F.col(lon) < longitude[1])
    return df.filter(~inside_lat | ~inside_lon)


def forbidden_zeros(df: DataFrame, columns: Sequence[str] = ("Temperature", "Conductivity")) -> DataFrame:
    zero = F.lit(False)
    for c in columns:
        zero = zero | F.coalesce(F.col(c) == 0, F.lit(False))
    return df.filter(zero)


def off_domain(df: DataFrame, domains: Mapping[str, Sequence[str]] = DOMAINS) -> DataFrame:
    """Codes outside their list, with the rows that hold them."""
    checked = [c for c in domains if c in df.columns]
    as_text = [
        (number_text(F.col(c)) if dict(df.dtypes)[c] == "double" else F.col(c).cast("string")).alias(c)
        for c in checked
    ]
    long = df.select(*as_text).unpivot([], checked, "Column", "Code").filter("Code IS NOT NULL")
    admitted = F.lit(False)
    for c in checked:
        admitted = admitted | ((F.col("Column") == c) & F.col("Code").isin(*domains[c]))
    return long.filter(~admitted).groupBy("Column", "Code").agg(F.count(F.lit(1)).alias("n"))


def wrong_clock(df: DataFrame, column: str = "Datetime", day: str = "Date") -> DataFrame:
    """Rows whose local time lies more than a day from their date: a zone was not converted."""
    apart = F.abs(F.date_diff(F.col(column).cast("date"), F.col(day)))
    return df.filter(apart > 1)


def column_inventory(tables: Mapping[str, DataFrame]) -> list[tuple[str, str, str, bool]]:
    """(table, column, type, is a sign column), from the schemas alone."""
    return [
        (name, f.name, f.dataType.simpleString(), f.name.endswith("_Sign"))
        for name, table in tables.items()
        for f in table.schema.fields
    ]


def documented_difference(df: DataFrame, documented: Sequence[str]) -> dict[str, list[str]]:
    """Columns only documented, and columns only present."""
    return {
        "missing": [c for c in documented if c not in df.columns],
        "undocumented": [c for c in df.columns if c not in documented],
    }


def summary(df: DataFrame) -> DataFrame:
    """All checks that need no grouping, in one pass over an integrated table: each true when it holds."""
    def within(name, low, high):
        return F.bool_and((F.col(name) > low) & (F.col(name) < high))

    def no_zero(name):
        return ~F.bool_or(F.col(name) == 0)

    near = F.abs(F.date_diff(F.col("Datetime").cast("date"), F.col("Date"))) <= 1
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.coalesce(check, F.lit(True)).alias(name)
            for name, check in {
                "latitudes_inside": within("Latitude", 37, 39),
                "longitudes_inside": within("Longitude", -123, -121),
                "temperature_without_zero": no_zero("Temperature"),
                "conductivity_without_zero": no_zero("Conductivity"),
                "times_near_dates": F.bool_and(near),
            }.items()
        ],
    )
