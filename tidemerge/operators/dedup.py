"""Which record of a group survives: first, extreme, repaired, modal or averaged."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemerge.functions.nulls import strict_max, strict_min
from tidemerge.operators.spread import attach_group

ROW = "_row"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence | None = None) -> DataFrame:
    """One whole row per key, the first in ``order`` (the scan order by default).

    The rank filter is pushed below the shuffle, so each map task sends at most
    one row per key.
    """
    ranked = Window.partitionBy(*keys).orderBy(*(order or [ROW]))
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def keep_extreme(
    df: DataFrame, keys: Sequence[str], *columns: str, largest: bool = False, few_ties: bool = False, hot_rows: int | None = None
) -> DataFrame:
    """Rows at the group's extreme value, ties included.

    A group with a missing value among its candidates has no extreme and is
    dropped whole. Several columns compare one after the other.

    Where any number of rows may tie, the extremes are aggregated and attached, which reads
    ``df`` twice and spreads hot keys. ``few_ties`` says that few rows of a key share its
    extreme, as few tows of a visit start at one time: rows are then ranked, in one read and
    one shuffle, and a map task sends its own extremes only. One row with a missing value is
    enough to drop a group, so a task sends one of these at most.
    """
    if largest and len(columns) > 1:
        raise ValueError("several columns are only compared for the smallest")
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    if few_ties:
        order = [F.col(c).desc_nulls_first() if largest else F.col(c).asc_nulls_first() for c in columns]
        apart = F.when(~known, F.monotonically_increasing_id())
        ranked = df.withColumn("_apart", apart).withColumn("_rank", F.rank().over(Window.partitionBy(*keys).orderBy(*order, "_apart")))
        return ranked.filter("_rank = 1").filter(known).drop("_rank", "_apart")
    if len(columns) == 1:
        col = F.col(columns[0])
        best = strict_max(col) if largest else strict_min(col)
        return attach_group(df, keys, hot_rows=hot_rows, _best=best).filter(col == F.col("_best")).drop("_best")
    key = F.struct(*columns)
    return attach_group(df, keys, hot_rows=hot_rows, _best=F.min(key)).filter(key.eqNullSafe(F.col("_best")) & known).drop("_best")


def group_size(df: DataFrame, keys: Sequence[str], name: str = "n", *, hot_rows: int | None = None) -> DataFrame:
    return attach_group(df, keys, hot_rows=hot_rows, **{name: F.count(F.lit(1))})


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def duplicate_rows(df: DataFrame, keys: Sequence[str], *, hot_rows: int | None = None) -> DataFrame:
    """All rows of the keys held by more than one row."""
    return group_size(df, keys, "_size", hot_rows=hot_rows).filter("_size > 1").drop("_size")


def split_repair(
    df: DataFrame,
    keys: Sequence[str],
    repair: Callable[[DataFrame], DataFrame],
    *,
    hot_rows: int | None = None,
) -> DataFrame:
    """Set the duplicated keys aside, repair them by any plan, and put them back with the rest.

    Both branches read ``df``. Where the repair leaves one row per key, ``repair_repeated`` reads it once.
    """
    sized = group_size(df, keys, "_size", hot_rows=hot_rows)
    single = sized.filter("_size = 1").drop("_size")
    return single.unionByName(repair(sized.filter("_size > 1").drop("_size")))


def resolve_replicates(
    df: DataFrame, keys: Sequence[str], rejected: Column, order: Sequence
) -> DataFrame:
    """One row per key: single rows stay, replicates lose the rejected ones and keep the first.

    A key whose replicates are all rejected disappears. Two rows per key are
    enough to tell these cases apart, so no more than two leave a map task.
    """
    keyed = df.withColumn("_rejected", F.coalesce(rejected, F.lit(False)))
    ranked = Window.partitionBy(*keys).orderBy("_rejected", *order)
    top = keyed.withColumn("_rank", F.row_number().over(ranked)).filter("_rank <= 2")
    top = top.withColumn("_single", F.lead("_rank").over(ranked).isNull())
    return top.filter("_rank = 1 AND (_single OR NOT _rejected)").drop("_rank", "_single", "_rejected")


def repair_repeated(
    df: DataFrame, keys: Sequence[str], stays: Column, order: Sequence, values: Mapping[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """One row per key: single rows stay as they are, of repeated ones those that fail ``stays`` leave.

    Of what is left the first row in ``order`` stays. ``values`` names columns that are then
    combined from all rows left, such as their mean. A key whose rows all leave is gone.

    One read and one shuffle. Without ``values`` two rows per key leave a map task at most,
    with them one.
    """
    stays = F.coalesce(stays, F.lit(False))
    if not values:
        return resolve_replicates(df, keys, ~stays, order)
    rank = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    rest = [c for c in df.columns if c not in keys]
    whole = F.struct(*[F.col(f"`{c}`") for c in rest])
    found = df.withColumn("_stays", stays).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(whole, rank).alias("_any"),
        F.min_by(F.when(F.col("_stays"), whole), F.when(F.col("_stays"), rank)).alias("_left"),
        *[combine(F.when(F.col("_stays"), F.col(c))).alias(f"_of_{c}") for c, combine in values.items()],
    )
    single = F.col("_n") == 1
    kept = found.filter(single | F.col("_left").isNotNull())
    columns = {c: F.when(single, F.col(f"_any.{c}")).otherwise(F.col(f"_of_{c}" if c in values else f"_left.{c}")) for c in rest}
    return kept.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in df.columns])


def modal_value(df: DataFrame, keys: Sequence[str], column: str, order: Column, name: str | None = None) -> DataFrame:
    """Most frequent non-NULL value per key; of equally frequent ones the first seen."""
    counted = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*keys, column)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
    )
    best = F.min_by(column, F.struct((-F.col("_n")).alias("n"), F.col("_first")))
    return counted.groupBy(*keys).agg(best.alias(name or column))
