"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, LongType, StructField, StructType

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it; in a local session without one, a new folder."""
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getConf().get(SETTING) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError(f"{SETTING} is not set: name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemerge-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def keep(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder, its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batches_of(spark: SparkSession, rows: int = 1000) -> None:
    """At most so many rows at once in a Python worker: whole texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def map_rows(df: DataFrame, schema: str, function: Callable[..., list[tuple]], *columns: str) -> DataFrame:
    """``function(*columns as lists)`` batch by batch; it returns one list of values per column of ``schema``."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x) for x in function(*(batch.column(i) for i in range(len(columns))))],
                    names,
                )

    return df.select(*columns).mapInArrow(run, schema)


def written_with(documents: DataFrame, name: str, kind: DataType, function: Callable[[list[str | None]], list]) -> DataFrame:
    """(doc, place, ``name``): each row of ``documents`` as a struct, whatever its columns are called, its number, and what ``function`` computes from its text.

    Written once as Parquet in the shared folder and read again, so that later steps read the
    columns they need, compute nothing twice and can name a row by its number.
    """
    schema = StructType([StructField("doc", documents.schema), StructField("place", LongType()), StructField(name, kind)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).field("text").to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(function(texts), arrow.field(name).type)], names=["doc", "place", name])

    path = f"{shared_folder(documents.sparkSession).rstrip('/')}/rows-{uuid.uuid4()}"
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc"), F.monotonically_increasing_id().alias("place"))
    rows.mapInArrow(run, schema).write.parquet(path)
    return documents.sparkSession.read.parquet(path)


def held_out(column: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def apart_from(added: list[tuple], base: list[tuple]) -> list[tuple]:
    """The spans (start, end, kind) of ``added`` that meet no span of ``base``, which is in order of start."""
    starts = [b[0] for b in base]
    reach = list(accumulate((b[1] for b in base), max, initial=-1))  # of the spans before each
    return [s for s in added if reach[bisect_left(starts, s[1])] <= s[0]]
