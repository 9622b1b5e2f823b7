"""Lookups, filters by another table, and joins on shared columns. NULL keys match NULL keys.

Lookups carry no broadcast hint: Spark broadcasts the lookup when its measured
size is under the session's threshold and otherwise shuffles, with adaptive
execution splitting hot partitions. Tables of the survey's own size join with
``spread_join``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.nulls import strict_max, strict_min
from tidemerge.operators.spread import full_join, null_safe_join, on_pairs, spread_join


def lookup(df: DataFrame, table: DataFrame, on: Sequence, *, suffix: str | None = None) -> DataFrame:
    """Left join of a lookup table.

    ``on`` holds names or (left, right) pairs. With ``suffix``, columns of ``df``
    that the lookup brings too are renamed with it first.
    """
    if suffix is not None:
        keys = {r for _, r in on_pairs(on)}
        clash = [c for c in table.columns if c not in keys and c in df.columns]
        df = df.withColumnsRenamed({c: c + suffix for c in clash})
    return null_safe_join(df, table, on, "left")


def literal_table(df: DataFrame, columns: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    """A small table written in code, marked for broadcast: its size is that of the source text."""
    schema = ", ".join(f"{c} string" for c in columns)
    return F.broadcast(df.sparkSession.createDataFrame([tuple(r) for r in rows], schema))


def keep_listed(df: DataFrame, listed: DataFrame, on: Sequence) -> DataFrame:
    """Rows whose key is in the list."""
    return null_safe_join(df, listed.select(*[r for _, r in on_pairs(on)]).distinct(), on, "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, on: Sequence) -> DataFrame:
    """Rows whose key is not in the list; a NULL key stays unless the list holds NULL."""
    return null_safe_join(df, listed.select(*[r for _, r in on_pairs(on)]).distinct(), on, "left_anti")


def natural_join(left: DataFrame, right: DataFrame, how: str = "left", **options) -> DataFrame:
    """Join on all shared column names (left, inner, left_semi, left_anti or full)."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column")
    if how == "full":
        return full_join(left, right, shared, **options)
    return spread_join(left, right, shared, how, **options)


def merge_unique(tables: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Full join of tables that each hold a key at most once and share only the key columns."""
    rows = None
    for table in tables:
        rows = table if rows is None else rows.unionByName(table, allowMissingColumns=True)
    return rows.groupBy(*on).agg(
        *[F.any_value(c, True).alias(c) for c in rows.columns if c not in on]
    )


def fill_from(df: DataFrame, table: DataFrame, on: Sequence, columns: Sequence[str]) -> DataFrame:
    """Fill missing values of ``columns`` from a second table."""
    pairs = on_pairs(on)
    other = table.select(*[r for _, r in pairs], *[F.col(c).alias(f"_fill_{c}") for c in columns])
    joined = null_safe_join(df, other, on, "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"_fill_{c}")) for c in columns}
    return joined.withColumns(filled).drop(*[f"_fill_{c}" for c in columns])


def by_change_date(day: Column, last_old: Column, first_new: Column, old, new, between: Column) -> Column:
    """``old`` up to a last day, ``new`` from a first day on, ``between`` otherwise."""
    return F.when(day <= last_old, old).when(day >= first_new, new).otherwise(between)


def within_period_of(df: DataFrame, reference: DataFrame, column: str) -> DataFrame:
    """Rows between the first and last value the reference table holds; none where one of its values is missing.

    Both bounds come from one aggregate, so the reference is read once.
    """
    col = F.col(column)
    bounds = F.struct(strict_min(col).alias("first"), strict_max(col).alias("last")).alias("_bounds")
    period = reference.agg(bounds).scalar()
    return df.filter((col >= period.getField("first")) & (col <= period.getField("last")))


def presence(df: DataFrame, keys: Sequence[str], kinds: Mapping[str, Column]) -> DataFrame:
    """Rows of each kind per key, in one pass; stands in for self-joins on the key."""
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in kinds.items()])


def co_occurrence(df: DataFrame, keys: Sequence[str], first: Column, second: Column) -> DataFrame:
    """How many ``first`` rows pair with a ``second`` row of the same key, and how many find none."""
    per_key = presence(df, keys, {"n_first": first, "n_second": second})
    return per_key.agg(
        F.coalesce(F.sum(F.col("n_first") * F.col("n_second")), F.lit(0)).alias("paired_rows"),
        F.coalesce(F.sum(F.when(F.col("n_second") == 0, F.col("n_first"))), F.lit(0)).alias(
            "unpaired_rows"
        ),
    )
