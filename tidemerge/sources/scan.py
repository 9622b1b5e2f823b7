"""Readers for staged raw files: typed projection, scan order, ragged headers."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemerge.functions.nulls import number
from tidemerge.operators.dedup import ROW


#: A position counts lines within a block, blocks within a file, and files in order of their paths.
_LINES, _BLOCKS = 2**33, 2**43


def _with_row(df: DataFrame, files: Sequence[str] | None = None) -> DataFrame:
    """Attach the position in the files as one number: file, block, line in reading order.

    ``files`` are all files of the feed where ``df`` scans only some of them. A single file
    has rank 0; the ranks of several come from a small table of their paths.
    """
    files = sorted(files or df.inputFiles())
    line = F.monotonically_increasing_id().bitwiseAND(_LINES - 1)
    block = F.col("_metadata.file_block_start").cast("decimal(19,0)")
    within = block * F.lit(Decimal(_LINES)) + line.cast("decimal(10,0)")
    if len(files) < 2:
        return df.withColumn(ROW, within.cast("decimal(32,0)"))
    # listed files write an empty authority, file:///a, rows do not, file:/a
    ranks = df.sparkSession.createDataFrame([(re.sub(r"^(\w+):///", r"\1:/", f), i) for i, f in enumerate(files)], "_path string, _rank int")
    placed = df.withColumns({"_within": within, "_file": F.regexp_replace("_metadata.file_path", r"^(\w+):///", "$1:/")})
    placed = placed.join(ranks, F.col("_file") == F.col("_path"), "left")
    rank = F.coalesce(F.col("_rank"), F.raise_error(F.concat(F.lit("not among the feed's files: "), F.col("_file"))).cast("int"))
    row = rank.cast("decimal(10,0)") * F.lit(Decimal(_LINES * _BLOCKS)) + F.col("_within")
    return placed.withColumn(ROW, row.cast("decimal(32,0)")).drop("_within", "_file", "_path", "_rank")


def typed(df: DataFrame, columns: Mapping[str, str], headers: Mapping[str, str] | None = None) -> DataFrame:
    """Project the named columns and read them as the given types; unreadable values are NULL.

    ``headers`` maps headers of raw files to these names; a feed that has such a
    header is read from it, any other from the name itself.
    """
    have = dict(df.dtypes)
    raw = {new: old for old, new in (headers or {}).items() if old in have}

    def read(name, as_type):
        name = raw.get(name, name)
        col = F.col(f"`{name}`")
        if have[name] == as_type:
            return F.nanvl(col, F.lit(None).cast(as_type)) if as_type == "double" else col
        if as_type == "string":
            return col.cast("string")
        if as_type == "boolean":
            return F.upper(col.cast("string")).try_cast("boolean")
        return number(col, as_type)

    keep = [ROW] if ROW in df.columns else []
    return df.select(*[read(n, t).alias(n) for n, t in columns.items()], *keep)


def scan_csv(
    spark: SparkSession, paths: str | Sequence[str], columns: Mapping[str, str] | None = None, *,
    keep_order: bool = True, line_breaks: bool = False, files: Sequence[str] | None = None,
) -> DataFrame:
    """Read CSV files that share a header.

    Values are read as text, empty and ``NA`` are NULL, and the columns are
    projected by name. Without ``columns`` everything stays text. Files with
    ``line_breaks`` inside quoted text are read whole, others are split.
    ``files`` lists all files of the feed where these are only some of them.
    """
    df = spark.read.csv(
        paths, header=True, nullValue="NA", emptyValue="", enforceSchema=False, multiLine=line_breaks, escape='"'
    )
    texts = [F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns]
    df = df.select(*texts, "_metadata")
    if keep_order:
        df = _with_row(df, files)
    return df if columns is None else typed(df, columns)


def scan_by_header(spark: SparkSession, paths: str | Sequence[str], *, line_breaks: bool = False) -> list[DataFrame]:
    """One scan per distinct header of the CSV files at ``paths`` (files, folders or patterns).

    A single file needs no look at its header. Otherwise one pass over the text
    brings the first line of each file together, and the driver receives each
    distinct header with its file names. A header is one line.
    """
    text = spark.read.text(paths)
    files = text.inputFiles()
    if len(files) < 2:
        return [scan_csv(spark, paths, line_breaks=line_breaks)]
    lines = text.select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    first = F.min_by("value", "line").alias("header")
    heads = lines.filter("file_block_start = 0").groupBy(F.col("file_path").alias("file")).agg(first)
    groups = heads.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    # the scan names files as URIs, the reader takes plain paths
    found = sorted([unquote(f) for f in g.files] for g in groups)
    return [scan_csv(spark, some, line_breaks=line_breaks, files=files) for some in found]


def together(scans: Sequence[DataFrame]) -> DataFrame:
    """Union of scans by name, missing columns NULL; scan positions rank all files of the feed, so rows keep the order of paths."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def scan_ragged_csv(spark: SparkSession, paths: str | Sequence[str], *, line_breaks: bool = False) -> DataFrame:
    """Read CSV files whose headers differ, as text, and union them by name: one scan per distinct header."""
    return together(scan_by_header(spark, paths, line_breaks=line_breaks))


def scan_json(spark: SparkSession, path: str, renames: Mapping[str, str], schema: str) -> DataFrame:
    """Read staged JSON records with a given schema under the library's names."""
    df = _with_row(spark.read.schema(schema).json(path))
    return df.select(*[F.col(old).alias(new) for old, new in renames.items()], ROW)


def scan_table(spark: SparkSession, path: str, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Read a staged Parquet table."""
    df = _with_row(spark.read.parquet(path))
    return df if columns is None else typed(df, columns)


def with_file_name(df: DataFrame, name: str = "File") -> DataFrame:
    """Name the file each row of a file scan comes from."""
    # names come with blanks and the like encoded, but a plus is a plus
    return df.withColumn(name, F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))))
