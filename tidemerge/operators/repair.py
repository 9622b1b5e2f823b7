"""Corrections from verified records, station ids from names, and rules that void values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.nulls import if_else
from tidemerge.operators.joins import drop_listed
from tidemerge.operators.spread import null_safe_join


def overlay_corrections(
    df: DataFrame, corrections: DataFrame, on: Sequence[str], value: str, verified: str, drop_sample: Column, sample: str
) -> DataFrame:
    """Apply verified values.

    Samples that ``drop_sample`` marks in the corrections leave whole. A listed
    record takes the verified value, and leaves if there is none. The rest stays.
    """
    df = drop_listed(df, corrections.filter(drop_sample), [sample])
    listed = corrections.select(*on, F.col(verified).alias("_verified"), F.lit(True).alias("_listed"))
    return (
        null_safe_join(df, listed, on, "left")
        .withColumn(value, F.when(F.col("_listed"), F.col("_verified")).otherwise(F.col(value)))
        .filter(F.col("_listed").isNull() | F.col(value).isNotNull())
        .drop("_verified", "_listed")
    )


def assign_ids(
    df: DataFrame, station_id: str, name: str, unknown: Sequence[str], rules: Sequence[tuple[str, str | None, str]]
) -> DataFrame:
    """Give stations with a placeholder id their real one by name; drop those that stay unknown.

    A rule is (name, placeholder or None for any, id).
    """
    current = F.col(station_id)
    fixed = None
    for rule_name, placeholder, new_id in rules:
        fits = F.col(name) == rule_name
        if placeholder is not None:
            fits = fits & (current == placeholder)
        fixed = F.when(fits, new_id) if fixed is None else fixed.when(fits, new_id)
    repaired = F.when(current.isin(*unknown), fixed).otherwise(current)
    placeholder_left = current.isin(*unknown) & F.col("_id").isNull()
    return (
        df.withColumn("_id", repaired)
        .filter(~F.coalesce(placeholder_left, F.lit(False)))
        .withColumn(station_id, F.col("_id"))
        .drop("_id")
    )


def null_before(day: Column, first_day, value: Column) -> Column:
    """NULL before the first valid day, and where the day itself is NULL."""
    return if_else(day < F.lit(first_day), F.lit(None).cast("double"), value)


def null_above(value: Column, limit: float) -> Column:
    return F.when(value <= limit, value)


def null_when_noted(notes: Column, pattern: str, value: Column, *, missing_notes_too: bool = True) -> Column:
    """NULL where the notes match; by default also where there are no notes."""
    noted = notes.rlike(pattern)
    if not missing_notes_too:
        noted = F.coalesce(noted, F.lit(False))
    return if_else(noted, F.lit(None).cast("double"), value)

