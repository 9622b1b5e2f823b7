"""Censored results: a sign column beside each value that may lie below its reporting limit."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.nulls import if_else, number


# Signs of a result that is below its limit, measured, estimated.
SIGNS = ("<", "=", "~")


def text_sign(result: Column) -> Column:
    """``<`` for text that starts with it, else ``=``; NULL for NULL."""
    return if_else(result.rlike("^<"), F.lit("<"), F.lit("="))


def text_value(result: Column, limit: Column) -> Column:
    """The reporting limit of a censored result, the number of a plain one, NULL for words."""
    return number(
        F.when(text_sign(result) == "<", limit)
        .when(result.rlike(r"\p{Alpha}"), F.lit(None).cast("string"))
        .otherwise(result)
    )


def split_censored(df: DataFrame, result: str = "Result", limit: str = "RL", sign: str = "Sign") -> DataFrame:
    """Split text results into value and sign and drop those without a value."""
    return df.withColumns(
        {
            sign: text_sign(F.col(result)),
            result: text_value(F.col(result), F.col(limit)),
        }
    ).filter(F.col(result).isNotNull())


def status_sign(detection: Column, value_type: Column) -> Column:
    return (
        F.when(detection == "Not Detected", "<").when(value_type == "Estimated", "~").otherwise("=")
    )


@dataclass(frozen=True)
class LimitRule:
    """Reporting limit of an analyte, optionally for one method or one span of days."""

    analyte: str
    limit: float
    method: str | None = None
    first_day: date | None = None
    last_day: date | None = None


def fill_limit(value: Column, analyte: Column, method: Column, day: Column, rules: Iterable[LimitRule]) -> Column:
    """Fill missing values from the first rule that fits."""
    out = F.when(value.isNotNull(), value)
    for rule in rules:
        fits = analyte == rule.analyte
        if rule.method is not None:
            fits = fits & (method == rule.method)
        if rule.first_day is not None:
            fits = fits & (day >= F.lit(rule.first_day))
        if rule.last_day is not None:
            fits = fits & (day <= F.lit(rule.last_day))
        out = out.when(fits, F.lit(rule.limit))
    return out
