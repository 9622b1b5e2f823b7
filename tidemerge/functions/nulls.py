"""Missing-value rules: three-valued conditions, sets that keep NULL, strict aggregates."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def if_else(condition: Column, yes, no) -> Column:
    """``yes`` where true, ``no`` where false, NULL where the condition is NULL."""
    return F.when(condition, yes).when(~condition, no)


def not_in(col: Column, values: Iterable) -> Column:
    """Outside the set; a NULL value is outside every set and is kept."""
    return col.isNull() | ~col.isin(list(values))


def number(col: Column, as_type: str = "double") -> Column:
    """Text to number; text that is no number becomes NULL. NaN becomes NULL too."""
    value = col.try_cast(as_type)
    return F.nanvl(value, F.lit(None).cast(as_type)) if as_type in ("double", "float") else value


def all_null(*names: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNull() for n in names])


def drop_all_null(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop rows in which every one of the named columns is NULL."""
    return df.dropna(how="all", subset=list(names))


def drop_any_null(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Drop rows in which any of the named columns (all, if none named) is NULL."""
    return df.dropna(how="any", subset=None if names is None else list(names))


def _strict(col: Column, value: Column) -> Column:
    return F.when(F.count(F.lit(1)) == F.count(col), value)


def strict_min(col: Column) -> Column:
    """Minimum of the group, NULL if any member is NULL."""
    return _strict(col, F.min(col))


def strict_max(col: Column) -> Column:
    return _strict(col, F.max(col))


def strict_mean(col: Column) -> Column:
    return _strict(col, F.avg(col))
