"""Merging feeds that record partly the same visits and disagree."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.operators.dedup import ROW
from tidemerge.operators.reshape import stack

#: Distinct records that a merged row stands for.
RECORDS = "_records"

Rule = Callable[[Column, Column], Column]


def mean(value: Column, records: Column) -> Column:
    """Mean of the known values."""
    return F.avg(value)


def whole_mean(value: Column, records: Column) -> Column:
    """Mean of the known values, rounded half to even where several records went into it."""
    return F.when(records > 1, F.bround(F.avg(value))).otherwise(F.avg(value))


def smallest(value: Column, records: Column) -> Column:
    return F.min(value)


def largest(value: Column, records: Column) -> Column:
    return F.max(value)


@dataclass(frozen=True)
class Alike:
    """Records of one key that agree in ``same`` are one: the first by ``first``, then by feed and position."""

    same: Sequence[str]
    first: Sequence[Column] = ()


def merge_feeds(
    feeds: Sequence[DataFrame],
    key: Sequence[str],
    rules: Mapping[str, Rule],
    *,
    alike: Sequence[Alike] = (),
    first: Sequence[Column] = (),
) -> DataFrame:
    """One row per ``key`` from feeds in order of preference; all hold the same columns, missing ones are NULL.

    Records equal in all columns count once, wherever they stand. ``alike`` then merges
    records from fine to coarse, as far as they agree. In the last step a column of
    ``rules`` comes from all records left of the key, every other column from the first
    of them by ``first``, then by feed and position. A key recorded once passes through.

    Each step is one aggregation, combined before its shuffle, so a key that makes up a
    large part of all feeds meets as one row per task. NULL keys are one key.
    """
    both = stack([f if ROW in f.columns else f.withColumn(ROW, F.monotonically_increasing_id()) for f in feeds])
    columns = [c for c in both.columns if c != ROW]
    records = both.groupBy(*columns).agg(F.min(ROW).alias(ROW)).withColumn(RECORDS, F.lit(1).cast("long"))

    def survivors(df: DataFrame, same: Sequence[str], order: Sequence[Column], values: Mapping[str, Rule]) -> DataFrame:
        rest = [c for c in columns if c not in same and c not in values]
        n = F.sum(RECORDS)
        rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col(ROW))
        merged = df.groupBy(*same).agg(
            n.alias(RECORDS),
            F.min_by(F.struct(*[F.col(c) for c in rest], F.col(ROW)), rank).alias("_first"),
            *[rule(F.col(c), n).alias(c) for c, rule in values.items()],
        )
        return merged.select(*same, *values, "_first.*", RECORDS)

    for step in alike:
        records = survivors(records, list(dict.fromkeys([*key, *step.same])), step.first, {})
    return survivors(records, list(key), first, rules).select(*columns, RECORDS)
