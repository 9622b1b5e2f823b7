"""The integrated table: any subset of the sources, one vocabulary, calendar keys, salinity."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemerge.functions.clock import month_start, season
from tidemerge.functions.text import paste
from tidemerge.functions.units import add_practical_salinity
from tidemerge.sources.registry import stored

# The sources, in the order they are combined.
SOURCES = (
    "20mm", "Baystudy", "DJFMP", "DOP", "EDSM", "EMP", "FMWT", "NCRO", "SDO", "SKT", "SLS", "STN",
    "Suisun", "USBR", "USGS_CAWSC", "USGS_SFBS", "YBFMP",
)
RENAMED = {
    "USGS": 'The "USGS" data source has been renamed to "USGS_SFBS" because of the inclusion of '
    'an additional USGS dataset, "USGS_CAWSC".'
}

Table = DataFrame | Callable[[], DataFrame]


def check_sources(sources: Iterable[str] | None, known: Iterable[str] = SOURCES) -> list[str]:
    """The chosen sources in combining order, or an error that lists the choices."""
    chosen = [sources] if isinstance(sources, str) else list(sources or ())
    for old, message in RENAMED.items():
        if old in chosen:
            raise ValueError(message)
    known = list(known)
    if not chosen or any(s not in known for s in chosen):
        raise ValueError(
            "You must specify the data sources you wish to include. Choices include:\n "
            + ", ".join(known)
        )
    return [s for s in known if s in chosen]


def combine(tables: Iterable[DataFrame]) -> DataFrame:
    """Union by name; a column a table lacks is NULL there.

    Every table is projected once to all columns, so the plan stays flat however many there are.
    """
    tables = list(tables)
    types = {}
    for table in tables:
        for name, as_type in table.dtypes:
            types.setdefault(name, as_type)
    whole = [
        table.selectExpr(*[f"`{n}`" if n in have else f"CAST(NULL AS {t}) AS `{n}`" for n, t in types.items()])
        for table, have in ((t, set(t.columns)) for t in tables)
    ]
    return reduce(DataFrame.union, whole)


def add_calendar(df: DataFrame) -> DataFrame:
    month = F.month("Date")
    return df.withColumns(
        {
            "MonthYear": month_start(F.col("Date")),
            "Year": F.year("Date"),
            "StationID": paste(F.col("Source"), F.col("Station")),
            "Month": month,
            "Season": season(month),
        }
    )


def between_years(df: DataFrame, first: int, last: int) -> DataFrame:
    """Rows dated within the years; the bounds are on ``Date`` itself, so scans can skip by it."""
    first, last = max(first, 1), min(last, 9999)
    if first > last:
        return df.filter(F.lit(False))
    return df.filter(
        (F.col("Date") >= F.lit(f"{first:04d}-01-01").cast("date"))
        & (F.col("Date") <= F.lit(f"{last:04d}-12-31").cast("date"))
    )


def fill_salinity(df: DataFrame, suffix: str = "") -> DataFrame:
    """Salinity from conductivity at 25 degrees where missing; the column always exists afterwards."""
    salinity, conductivity = "Salinity" + suffix, "Conductivity" + suffix
    if conductivity not in df.columns:
        return df if salinity in df.columns else df.withColumn(salinity, F.lit(None).cast("double"))
    made = "_made" + suffix
    df = add_practical_salinity(df, F.col(conductivity) / 1000, made)
    have = F.coalesce(salinity, made) if salinity in df.columns else F.col(made)
    return df.withColumn(salinity, have).drop(made)


def integrate(
    tables: Mapping[str, Table],
    sources: Iterable[str] | None = None,
    start_year: int | None = None,
    end_year: int | None = None,
    *,
    known: Iterable[str] = SOURCES,
) -> DataFrame:
    """Combine cleaned source tables.

    ``tables`` maps source names to DataFrames, or to functions that open them;
    only the chosen ones are opened. Years are inclusive, and rows without a date
    are left out. The end year defaults to the current one.
    """
    chosen = check_sources(sources, known)
    opened = [tables[s]() if callable(tables[s]) else tables[s] for s in chosen]
    last = datetime.date.today().year if end_year is None else end_year
    first = 0 if start_year is None else start_year
    df = add_calendar(between_years(combine(opened), first, last))
    if "Field_coords" in df.columns:
        df = df.withColumn("Field_coords", F.coalesce("Field_coords", F.lit(False)))
    return fill_salinity(fill_salinity(df), "_bottom")


def integrated(
    spark: SparkSession, cleaned: str, sources: Iterable[str] | None = None, start_year: int | None = None, end_year: int | None = None,
    *, as_of: int | None = None,
) -> DataFrame:
    """The integrated table straight from the stored tables in ``cleaned``, their latest versions or those of ``as_of``.

    Nothing is cleaned, so the first task starts as soon as the manifest is read.
    """
    chosen = check_sources(sources)
    return integrate(stored(spark, cleaned, chosen, as_of), chosen, start_year, end_year)
