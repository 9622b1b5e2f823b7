"""Profiles of a feed and comparison of two feeds of the same samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.text import paste
from tidemerge.operators.dedup import duplicate_keys
from tidemerge.operators.spread import grid_join, spread_join


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, one row each, from one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "Column", "NumNA")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column by itself, as text."""
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        as_text.unpivot([], list(columns), "Column", "Value")
        .groupBy("Column", "Value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def cross_tab(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def count_of_counts(df: DataFrame, *keys: str) -> DataFrame:
    """How many keys occur how often."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("NumRecords"))
        .groupBy("NumRecords").agg(F.count(F.lit(1)).alias("n"))
    )


def sign_profile(df: DataFrame) -> DataFrame:
    """Rows per sign and presence of a value, for every column that has a sign column."""
    names = [c.removesuffix("_Sign") for c in df.columns if c.endswith("_Sign")]
    names = [c for c in names if c in df.columns]
    pairs = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("Parameter"),
                        F.col(f"{n}_Sign").alias("Sign"),
                        F.col(n).isNotNull().alias("HasValue"),
                    )
                    for n in names
                ]
            )
        ).alias("p")
    ).select("p.*")
    return cross_tab(pairs, "Parameter", "Sign", "HasValue")


def sampling_effort(df: DataFrame, station: Sequence[str], time: str) -> DataFrame:
    """Distinct sampling events per station and year."""
    return (
        df.select(*station, time).distinct()
        .groupBy(*station, F.year(time).alias("Year"))
        .agg(F.count(F.lit(1)).alias("NumSamples"))
    )


def effort_matrix(df: DataFrame, station: Sequence[str], time: str, years: Sequence[int], sep: str = " - ") -> DataFrame:
    """Sampling effort with one row per station, one column per listed year and one, ``Other``, for all else."""
    effort = sampling_effort(df, station, time)
    return effort.groupBy(paste(*[F.col(c) for c in station], sep=sep).alias("Station")).agg(
        *[F.sum(F.when(F.col("Year") == y, F.col("NumSamples"))).alias(str(y)) for y in years],
        F.sum(F.when(~F.coalesce(F.col("Year").isin(*years), F.lit(False)), F.col("NumSamples"))).alias("Other"),
    )


def record_period(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("NumSamples"), F.min(day).alias("MinDate"), F.max(day).alias("MaxDate")
    )


def many_per_day(df: DataFrame, keys: Sequence[str], *, hot_rows: int | None = None) -> DataFrame:
    """All rows of the station-day-analyte keys sampled more than once."""
    return spread_join(df, duplicate_keys(df, keys).drop("n"), keys, "left_semi", hot_rows=hot_rows)


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each distinct key with where it occurs: both, left or right. NULL keys match."""
    tagged = left.select(*keys, F.lit(1).alias("_side")).unionByName(
        right.select(*keys, F.lit(2).alias("_side"))
    )
    sides = tagged.groupBy(*keys).agg(F.min("_side").alias("_first"), F.max("_side").alias("_last"))
    found = (
        F.when(F.col("_first") != F.col("_last"), "both")
        .when(F.col("_first") == 1, "left")
        .otherwise("right")
    )
    return sides.select(*keys, found.alias("found_in"))


def field_equivalence(left: DataFrame, right: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Per field, the matched record pairs and how many of them differ or cannot be compared.

    Pairs of a key are all its left records with all its right ones. They are
    counted from the value counts of either side and never built, so a key with
    many records costs no more than its distinct values. Two texts differ when
    both are there and unequal.
    """
    def long(df, l, r):
        """A row per field, known by its number, which takes less of an aggregate's memory than its name."""
        texts = [F.struct(F.lit(i).alias("Field"), F.col(f).cast("string").alias("Value")) for i, f in enumerate(fields)]
        return df.select(*keys, F.inline(F.array(*texts)), F.lit(l).alias("_l"), F.lit(r).alias("_r"))

    # both sides meet in one aggregation, so a task holds each value of its keys once
    per_value = (
        long(left, 1, 0).unionByName(long(right, 0, 1))
        .groupBy(*keys, "Field", "Value").agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    )
    there = F.col("Value").isNotNull()
    per_key = per_value.groupBy(*keys, "Field").agg(
        F.sum("_l").alias("_all_l"),
        F.sum("_r").alias("_all_r"),
        F.sum(F.when(there, F.col("_l")).otherwise(0)).alias("_l"),
        F.sum(F.when(there, F.col("_r")).otherwise(0)).alias("_r"),
        F.sum(F.when(there, F.col("_l") * F.col("_r")).otherwise(0)).alias("_equal"),
    )
    pairs = F.col("_all_l") * F.col("_all_r")
    known = F.col("_l") * F.col("_r")
    per_field = per_key.filter("_all_l > 0 AND _all_r > 0").groupBy("Field").agg(
        F.sum(pairs).alias("pairs"),
        F.sum(known - F.col("_equal")).alias("different"),
        F.sum(pairs - known).alias("unknown"),
    )
    name = F.element_at(F.array(*[F.lit(f) for f in fields]), F.col("Field") + 1)
    return per_field.withColumn("Field", name)


def differing_values(
    left: DataFrame, right: DataFrame, keys: Sequence[str], field: str, *, hot_rows: int | None = None
) -> DataFrame:
    """Matched pairs whose field differs, per pair of values; records are counted before they meet.

    A key with many values on either side is split on both, so its pairs meet in many tasks.
    """
    l = left.filter(F.col(field).isNotNull()).groupBy(*keys, F.col(field).alias("left_value")).agg(
        F.count(F.lit(1)).alias("_l")
    )
    r = right.filter(F.col(field).isNotNull()).groupBy(*keys, F.col(field).alias("right_value")).agg(
        F.count(F.lit(1)).alias("_r")
    )
    met = grid_join(l, r, keys, hot_rows=hot_rows)
    return met.filter("left_value <> right_value").groupBy("left_value", "right_value").agg(
        F.sum(F.col("_l") * F.col("_r")).alias("n")
    )


def zero_as_censored(df: DataFrame, value: str, limit: str, sign: str = "ResultSign") -> DataFrame:
    """Negative values leave; zero means below the limit, which becomes the value."""
    zero = F.col(value) == 0
    return df.filter(F.col(value) >= 0).withColumns(
        {
            sign: F.when(zero, F.lit("<")).otherwise(F.lit("=")),
            value: F.when(zero, F.col(limit)).otherwise(F.col(value)),
        }
    )


def excluded(df: DataFrame, condition: Column, *keys: str) -> DataFrame:
    """Rows per key among those a rule leaves out."""
    return cross_tab(df.filter(condition), *keys)
