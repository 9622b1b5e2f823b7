"""Code lists and code-to-word maps shared by the surveys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemerge.functions.text import number_text, recode

# Tide codes of the trawl surveys.
TRAWL_TIDES = {"1": "High Slack", "2": "Ebb", "3": "Low Slack", "4": "Flood"}

# Visual Microcystis words and their index.
MICROCYSTIS_WORDS = {"Not Visible": 1, "Absent": 1, "Low": 2, "Medium": 3, "High": 4, "Extreme": 5}


def trawl_tide(code: Column, *, keep_unmatched: bool = True) -> Column:
    """Word of a numeric tide code."""
    return recode(number_text(code.cast("double")), TRAWL_TIDES, keep_unmatched=keep_unmatched)


def microcystis_index(words: Column) -> Column:
    return recode(words, MICROCYSTIS_WORDS, keep_unmatched=False).cast("double")


def rounded_index(value: Column) -> Column:
    """Whole index, halves to the even neighbour."""
    return F.bround(value)
