"""Group values and joins that survive a key holding a large share of all rows.

All operators here find the keys with more than ``hot_rows`` rows by a partial
aggregation. The ``HOT_KEYS`` largest of them are broadcast, a list of bounded
size however large the table is, and their rows are spread over several join
partitions instead of landing in one. Any key beyond these has less than
``1 / HOT_KEYS`` of all rows and joins like the others, so the bound changes the
way of some rows, never the result.

The spreading number is a hash of the partition a row is read in and of the row itself,
so rows of one key are spread even where they lie in one partition already. Both are the
same when a lost task runs again, in whatever order its rows come then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
HOT_KEYS = 10_000

_SALT = "_spread"
_COPIES = "_copies"
_ROWS = "_rows"


def on_pairs(on: Sequence) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def null_safe_join(
    left: DataFrame, right: DataFrame, on: Sequence, how: str = "left", *, plain: Sequence[str] = ()
) -> DataFrame:
    """Equi-join in which NULL keys match each other; the left key columns survive.

    ``plain`` names further keys that are never NULL.
    """
    pairs = on_pairs(on) + on_pairs(plain)
    renamed = {r: f"_key_{i}" for i, (_, r) in enumerate(pairs)}
    right = right.withColumnsRenamed(renamed)
    condition = None
    for i, (l, _) in enumerate(pairs):
        key = F.col(f"_key_{i}")
        match = F.col(l) == key if l in plain else F.col(l).eqNullSafe(key)
        condition = match if condition is None else condition & match
    return left.join(right, condition, how).drop(*renamed.values())


def largest(counts: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """The keys of more than ``hot_rows`` rows, ``HOT_KEYS`` of the largest at most; ties go by key, so every use sees the same list."""
    return counts.filter(F.col(_ROWS) > hot_rows).orderBy(F.desc(_ROWS), *[F.col(k) for k in keys]).limit(HOT_KEYS)


def row_hash(df: DataFrame, columns: Sequence[str] = ()) -> Column:
    """A hash of the partition a row is read in and of ``columns``, by default all that the row holds, maps aside."""
    columns = columns or [c for c, t in df.dtypes if "map<" not in t and t != "variant"]
    return F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in columns])


def _spread_number(copies: Column, df: DataFrame, columns: Sequence[str] = ()) -> Column:
    return F.pmod(row_hash(df, columns), copies)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence,
    how: str = "left",
    *,
    hot_rows: int | None = None,
    spread_by: Sequence[str] = (),
    counted: DataFrame | None = None,
) -> DataFrame:
    """Null-safe join of two large tables (left, inner, left_semi or left_anti).

    Only the right rows of hot keys are repeated, once per share of that key. Rows are
    dealt by ``spread_by``, columns that tell them apart, or by all they hold.
    ``counted`` may name a table with the same key columns that holds no fewer
    rows per key than ``left`` and is cheaper to count, such as the raw feed.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"spread_join cannot run a {how} join")
    pairs = on_pairs(on)
    names = [l for l, _ in pairs]
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    counts = (left if counted is None else counted).groupBy(*names).agg(F.count(F.lit(1)).alias(_ROWS))
    hot = largest(counts, names, hot_rows).select(*names, F.ceil(F.col(_ROWS) / hot_rows).alias(_COPIES))
    spread = null_safe_join(left, F.broadcast(hot), names).withColumn(
        _SALT,
        F.when(F.col(_COPIES).isNull(), 0).otherwise(_spread_number(F.col(_COPIES), left, spread_by)),
    )
    repeated = null_safe_join(right, F.broadcast(hot), [(r, l) for l, r in pairs]).withColumn(
        _SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(_COPIES), F.lit(1)) - 1))
    )
    return null_safe_join(
        spread.drop(_COPIES), repeated.drop(_COPIES), pairs, how, plain=[_SALT]
    ).drop(_SALT)


def _two_sided(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], hot_rows: int) -> DataFrame:
    """The largest keys by rows of both sides together, with the shares that each side is split into; from the key columns alone."""
    names = [l for l, _ in pairs]
    sides = left.select(*names, F.lit(1).alias("_side")).unionByName(
        right.select(*[F.col(r).alias(l) for l, r in pairs], F.lit(2).alias("_side"))
    )
    counts = sides.groupBy(*names).agg(
        F.count_if(F.col("_side") == 1).alias("_left_rows"), F.count_if(F.col("_side") == 2).alias("_right_rows"),
        F.count(F.lit(1)).alias(_ROWS),
    )
    hot = largest(counts, names, hot_rows)
    share = {s: F.greatest(F.ceil(F.col(f"_{s}_rows") / hot_rows), F.lit(1)) for s in ("left", "right")}
    return hot.select(*names, "_left_rows", "_right_rows", *[share[s].cast("long").alias(f"_{s}_shares") for s in share])


def _numbers(shares: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), shares - 1))


def full_join(left: DataFrame, right: DataFrame, on: Sequence[str], *, hot_rows: int | None = None) -> DataFrame:
    """Null-safe full join on same-named keys, one join that reads each side's rows once.

    Keys with many rows on both sides together are found from the key columns first. Where
    such a key is on both sides, all its rows have partners: both sides are split and meet in
    a grid, and no row of it is unmatched. Where it is on one side only, nothing meets it and
    its rows are spread.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    hot = F.broadcast(_two_sided(left, right, on_pairs(on), hot_rows))
    both = (F.col("_left_rows") > 0) & (F.col("_right_rows") > 0)

    def dealt(df: DataFrame, side: str, other: str) -> DataFrame:
        """A share of its own for each row; against keys on both sides, once for every share of the other side."""
        marked = null_safe_join(df, hot, on)
        mine, theirs = F.col(f"_{side}_shares"), F.col(f"_{other}_shares")
        number = F.when(mine.isNull(), 0).otherwise(_spread_number(mine, df))
        marked = marked.withColumn(f"_{side}_share", number).withColumn("_met", F.coalesce(both, F.lit(False)))
        marked = marked.withColumn(f"_{other}_share", _numbers(F.when(F.col("_met"), theirs).otherwise(1)))
        return marked.drop("_left_rows", "_right_rows", "_left_shares", "_right_shares")

    shares = ["_left_share", "_right_share"]
    renamed = {c: f"_key_{i}" for i, c in enumerate([*on, *shares, "_met"])}
    l = dealt(left, "left", "right").withColumn("_left", F.lit(True))
    r = dealt(right, "right", "left").withColumn("_right", F.lit(True)).withColumnsRenamed(renamed)
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(renamed[c]))
    for c in shares:
        condition = condition & (F.col(c) == F.col(renamed[c]))
    joined = l.join(r, condition, "full")
    # rows of a key on both sides that find a cell of the grid empty have their partners in other cells
    matched = F.col("_left").isNotNull() & F.col("_right").isNotNull()
    joined = joined.filter(matched | ~F.coalesce(F.col("_met"), F.col(renamed["_met"])))
    key = {c: F.when(F.col("_left").isNotNull(), F.col(c)).otherwise(F.col(renamed[c])).alias(c) for c in on}
    brought = [c for c in right.columns if c not in left.columns]
    return joined.select(*[key.get(c, F.col(f"`{c}`")) for c in left.columns], *[F.col(f"`{c}`") for c in brought])


def grid_join(left: DataFrame, right: DataFrame, on: Sequence, *, hot_rows: int | None = None) -> DataFrame:
    """Null-safe inner join in which both sides of a hot key are split: its pairs form a grid of join partitions.

    A row takes a share of its side and is repeated once for each share of the other side.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    pairs = on_pairs(on)
    hot = F.broadcast(_two_sided(left, right, pairs, hot_rows).drop("_left_rows", "_right_rows"))

    def dealt(df: DataFrame, keys: Sequence, side: str, other: str) -> DataFrame:
        marked = null_safe_join(df, hot, keys)
        mine = F.coalesce(F.col(f"_{side}_shares"), F.lit(1))
        marked = marked.withColumn(f"_{side}_share", _spread_number(mine, df))
        marked = marked.withColumn(f"_{other}_share", _numbers(F.coalesce(F.col(f"_{other}_shares"), F.lit(1))))
        return marked.drop("_left_shares", "_right_shares")

    shares = ["_left_share", "_right_share"]
    l = dealt(left, [l for l, _ in pairs], "left", "right")
    r = dealt(right, [(r, l) for l, r in pairs], "right", "left")
    return null_safe_join(l, r, pairs, "inner", plain=shares).drop(*shares)


def attach_group(
    df: DataFrame, keys: Sequence[str], *, hot_rows: int | None = None, only: Column | None = None, without: Sequence[str] = (),
    **values: Column,
) -> DataFrame:
    """Add group aggregates to every row of the group.

    Groups are aggregated map-side first. Rows of hot keys take the values from
    a broadcast of the hot groups and are spread; the others join on the key.
    Where the groups turn out few, adaptive execution broadcasts them all and
    the rows are not shuffled.

    All rows count for the aggregates. ``only`` says which of them are returned, and
    ``without`` names columns that are not, so that neither travels for nothing.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    names = list(values)
    stats = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(_ROWS), *[v.alias(f"_of_{n}") for n, v in values.items()]
    )
    df = (df if only is None else df.filter(only)).drop(*without)
    hot = largest(stats, keys, hot_rows).withColumnsRenamed({f"_of_{n}": f"_hot_{n}" for n in names})
    is_hot = F.col("_hot_rows").isNotNull()
    share = 1 + _spread_number(F.ceil(F.col("_hot_rows") / hot_rows), df)
    marked = null_safe_join(df, F.broadcast(hot.withColumnRenamed(_ROWS, "_hot_rows")), keys)
    marked = marked.withColumn(_SALT, F.when(is_hot, share).otherwise(0))
    # the rows of hot keys have no partner here: their numbers start at 1
    others = stats.withColumn(_SALT, F.lit(0).cast("bigint")).drop(_ROWS)
    joined = null_safe_join(marked, others, keys, plain=[_SALT])
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in names],
        *[F.when(is_hot, F.col(f"_hot_{n}")).otherwise(F.col(f"_of_{n}")).alias(n) for n in names],
    )
