"""Long to wide, wide to long, and header repairs."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemerge.functions.text import paste
from tidemerge.operators.dedup import ROW


def long_to_wide(
    df: DataFrame,
    ids: Sequence[str],
    name: str,
    names: Sequence[str],
    values: Mapping[str, str],
    *,
    how: str = "first",
    order: Column | None = None,
    levels: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per ``ids`` with one column per (name, value).

    ``values`` maps a value column to the template of its wide names, such as
    ``{"Result": "{name}", "Sign": "{name}_Sign"}``. ``how`` resolves duplicates:
    ``first`` in ``order`` (scan order by default), or ``mean``, which is NULL
    where any member is. All columns come from one aggregation.

    Numbers are kept beside a numeric order in buffers of fixed size, so first values are
    hashed and never sorted. ``levels`` lists all texts that a text column may hold; it then
    travels as a number too, and any other text is an error.
    """
    order = F.col(ROW) if order is None else order
    levels = levels or {}
    aggregates = []
    for v, template in values.items():
        coded = _level(F.col(v), levels[v]) if v in levels else F.col(v)
        for n in names:
            mine, out = F.col(name) == n, template.format(name=n)
            if how == "first":
                aggregates.append(F.min_by(F.when(mine, coded), F.when(mine, order)).alias(out))
            elif how == "mean":
                # the mean over the name's own rows, NULL when one of them is missing
                held, total = F.count_if(mine & F.col(v).isNotNull()), F.count_if(mine)
                aggregates.append(F.when(held == total, F.avg(F.when(mine, F.col(v)))).alias(out))
            else:
                raise ValueError(f"unknown rule for duplicates: {how}")
    wide = df.groupBy(*ids).agg(*aggregates)
    texts = {t.format(name=n): F.array(*[F.lit(x) for x in levels[v]]) for v, t in values.items() if v in levels for n in names}
    return wide.withColumns({c: F.get(of, F.col(c)) for c, of in texts.items()})


def _level(text: Column, levels: Sequence[str]) -> Column:
    """The place of a text in its list, from 0; NULL for NULL."""
    place = F.array_position(F.array(*[F.lit(x) for x in levels]), text).cast("int") - 1
    unknown = F.raise_error(F.concat(F.lit(f"not among {', '.join(levels)}: "), text)).cast("int")
    return F.when(place >= 0, place).when(text.isNotNull(), unknown)


@dataclass(frozen=True)
class Part:
    """One of several wide tables made from a long one.

    ``rows`` says which rows it takes. ``values`` maps a template of wide names, such as
    ``"{name}_bottom"``, to the value column that rows whose ``name`` column holds one of
    ``names`` bring, combined by ``rule``. ``ids`` are columns of the part itself: each is an
    aggregate, built from ``mine``, which hides the rows of other parts. ``after`` converts
    finished columns.
    """

    rows: Column
    name: str | None = None
    names: Sequence[str] = ()
    values: Mapping[str, str] = field(default_factory=dict)
    rule: Callable[[Column], Column] = F.max
    ids: Mapping[str, Callable[[Callable[[str], Column]], Column]] = field(default_factory=dict)
    after: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)


def pivot_parts(df: DataFrame, keys: Sequence[str], parts: Sequence[Part], **shared: Column) -> DataFrame:
    """Rows of several kinds pivoted apart, each by its own names, ids and rules, and joined back on ``keys``.

    A key is there if any part has rows of it; what a part lacks is NULL. ``shared`` are
    aggregates over the rows of all parts. Everything comes from one read and one
    aggregation, combined before its shuffle; NULL keys are one key.
    """
    made, after = [], {}
    for part in parts:
        for out, build in part.ids.items():
            made.append(build(lambda c, part=part: F.when(part.rows, F.col(c))).alias(out))
        for template, value in part.values.items():
            for n in part.names:
                one = part.rows & (F.col(part.name) == n)
                made.append(part.rule(F.when(one, F.col(value))).alias(template.format(name=n)))
        after.update({out: change(F.col(out)) for out, change in part.after.items()})
    taken = reduce(lambda a, b: a | b, [F.coalesce(part.rows, F.lit(False)) for part in parts])
    wide = df.filter(taken).groupBy(*keys).agg(*[c.alias(n) for n, c in shared.items()], *made)
    return wide.withColumns(after)


def wide_to_long(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "Parameter", value: str = "Value"
) -> DataFrame:
    """One row per id and column that holds a value."""
    return df.unpivot(list(ids), list(columns), name, value).filter(F.col(value).isNotNull())


def split_columns(df: DataFrame, column: str, into: Sequence[str], pattern: str, as_type: str = "double") -> DataFrame:
    """Split text into typed columns; missing and unreadable pieces are NULL."""
    parts = F.split(F.col(column), pattern)
    pieces = {n: F.get(parts, F.lit(i)).try_cast(as_type) for i, n in enumerate(into)}
    return df.withColumns(pieces).drop(column)


def unite(df: DataFrame, name: str, columns: Sequence[str], sep: str) -> DataFrame:
    """Paste columns into one."""
    return df.withColumn(name, paste(*[F.col(c) for c in columns], sep=sep)).drop(
        *[c for c in columns if c != name]
    )


def columns_like(df: DataFrame, pattern: str = "", *, types: Sequence[str] = ()) -> list[str]:
    """Names that match a pattern and, if given, hold one of the types."""
    return [
        f.name
        for f in df.schema.fields
        if re.search(pattern, f.name) and (not types or f.dataType.simpleString() in types)
    ]


def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c.removesuffix(suffix) for c in df.columns if c.endswith(suffix)})


def strip_spaces(df: DataFrame) -> DataFrame:
    """Remove the spaces from all headers."""
    return df.toDF(*[c.replace(" ", "") for c in df.columns])


def pick_header(df: DataFrame, pattern: str) -> str:
    """The one header that matches; files that offer none or several are an error."""
    found = columns_like(df, pattern)
    if len(found) != 1:
        raise ValueError(f"expected one header like {pattern}, found {found}")
    return found[0]


def move_after(df: DataFrame, moved: Sequence[str], after: str) -> DataFrame:
    rest = [c for c in df.columns if c not in moved]
    at = rest.index(after) + 1
    return df.select(*[F.col(f"`{c}`") for c in [*rest[:at], *moved, *rest[at:]]])


def move_first(df: DataFrame, moved: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in [*moved, *[c for c in df.columns if c not in moved]]])


#: Positions of one feed lie below this, so that feeds and positions make one number.
_POSITIONS = 10**32


def _whole_number(df: DataFrame) -> bool:
    kind = df.schema[ROW].dataType
    return isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and (kind.precision, kind.scale) <= (32, 0)


def stack(feeds: Sequence[DataFrame]) -> DataFrame:
    """Union by name, missing columns NULL; the scan order follows the order of the feeds.

    Positions stay one number. Where they cannot, as in a stack of stacks, they are paired with the feed.
    """
    numeric = all(_whole_number(f) for f in feeds if ROW in f.columns)
    out = None
    for i, feed in enumerate(feeds):
        if ROW in feed.columns and numeric:
            place = F.lit(Decimal(i * _POSITIONS)) + F.col(ROW).cast("decimal(32,0)")
            feed = feed.withColumn(ROW, place.cast("decimal(38,0)"))
        elif ROW in feed.columns:
            feed = feed.withColumn(ROW, F.struct(F.lit(i).alias("feed"), F.col(ROW).alias("row")))
        out = feed if out is None else out.unionByName(feed, allowMissingColumns=True)
    return out
