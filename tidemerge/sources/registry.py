"""Where each survey's raw feeds lie, and the cleaned tables built from them."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemerge.sources.scan import scan_by_header, scan_table, together, typed
from tidemerge.sources.versions import fingerprints, open_tables, store_tables

Feeds = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Survey:
    """A source: its name, the raw feeds with their columns, and the plan that cleans them.

    ``headers`` maps, per feed, headers of the raw files to the names of the
    columns. ``shapes`` holds, per feed, a step that files of one header go
    through before that. Both leave feeds that already have the library's names.
    """

    name: str
    feeds: Mapping[str, Mapping[str, str]]
    clean: Callable[[Feeds], DataFrame]
    headers: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    shapes: Mapping[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    def build(self, feeds: Feeds) -> DataFrame:
        """The cleaned table of already opened feeds."""
        missing = [n for n in self.feeds if n not in feeds]
        if missing:
            raise ValueError(f"{self.name} needs the feeds {missing}")
        return self.clean({n: typed(feeds[n], columns, self.headers.get(n)) for n, columns in self.feeds.items()})

    def read(
        self, spark: SparkSession, folder: str, fmt: str = "csv", *, line_breaks: Collection[str] = ()
    ) -> DataFrame:
        """The cleaned table of feeds staged as ``folder/<source>/<feed>.<fmt>``, each a file or a folder of files.

        Files of a feed may differ in their headers. CSV files are split among
        tasks by lines; feeds listed in ``line_breaks`` have quoted text over
        several lines and are read one task per file.
        """
        unknown = [n for n in line_breaks if n not in self.feeds]
        if unknown:
            raise ValueError(f"{self.name} has no feeds {unknown}")
        opened = {}
        for feed in self.feeds:
            path = f"{folder}/{self.name}/{feed}.{fmt}"
            if fmt == "csv":
                scans = scan_by_header(spark, path, line_breaks=feed in line_breaks)
            else:
                scans = [scan_table(spark, path)]
            shape = self.shapes.get(feed)
            opened[feed] = together([shape(s) for s in scans] if shape else scans)
        return self.build(opened)


#: Raise this when a cleaning plan changes, so that stored tables are made again.
RULES = 1


def store(
    spark: SparkSession, surveys: Mapping[str, Survey], raw: str, cleaned: str, fmt: str = "csv",
    *, line_breaks: Mapping[str, Collection[str]] | None = None,
) -> list[str]:
    """Clean the surveys staged in ``raw`` whose files have changed and write their tables to ``cleaned``; their names.

    ``line_breaks`` names, per survey, the feeds with quoted text over several lines.
    """
    breaks = line_breaks or {}
    staged = {n: [f"{raw}/{n}/{feed}.{fmt}" for feed in s.feeds] for n, s in surveys.items()}
    files = fingerprints(spark, staged)
    made_from = {n: f"{files.get(n)} {fmt} {sorted(breaks.get(n, ()))} {RULES}" for n in surveys}

    def cleaner(survey: Survey) -> Callable[[], DataFrame]:
        return lambda: survey.read(spark, raw, fmt, line_breaks=breaks.get(survey.name, ()))

    return store_tables(spark, cleaned, {n: cleaner(s) for n, s in surveys.items()}, made_from)


def stored(spark: SparkSession, cleaned: str, names: Iterable[str], as_of: int | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Openers of the cleaned tables in their latest whole versions, or those of ``as_of``; a table is only looked at when it is opened."""
    return open_tables(spark, cleaned, names, as_of)
