"""Text helpers with the missing-value and first-match rules surveys rely on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_text(col: Column) -> Column:
    """A double as text without a trailing ``.0`` and without an exponent for whole numbers."""
    whole = (col == F.floor(col)) & (F.abs(col) < 1e15)
    return F.when(whole, col.cast("bigint").cast("string")).otherwise(col.cast("string"))


def paste(*cols: Column, sep: str = " ") -> Column:
    """Join as text; a missing part reads ``NA`` instead of removing the whole."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("NA")) for c in cols])


def remove_first(col: Column, pattern: str) -> Column:
    """Remove only the first match of ``pattern``."""
    return F.regexp_replace(col, rf"^(?s)(.*?)(?:{pattern})", "$1")


def pad_left(col: Column, width: int, fill: str = "0") -> Column:
    """Pad on the left; longer text is kept whole."""
    return F.when(F.length(col) >= width, col).otherwise(F.lpad(col, width, fill))


def recode(col: Column, mapping: Mapping, *, keep_unmatched: bool = True) -> Column:
    """Replace listed values; others stay, or become NULL when ``keep_unmatched`` is false."""
    out = None
    for old, new in mapping.items():
        value = F.lit(new) if new is not None else F.lit(None).cast("string")
        out = F.when(col == old, value) if out is None else out.when(col == old, value)
    return out.otherwise(col) if keep_unmatched else out
