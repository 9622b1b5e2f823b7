"""Scans over rows sorted across partitions, in which one key may hold any share of the rows.

Rows lie in order over range partitions, so a key that is large goes on from one
partition into the next. What a scan carries over is small: each partition gives a
summary of its first and of its last key's rows, the driver adds these up (two a
partition, however large the table is), and each partition starts with what the
ones before hold of its first key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemerge.llm.common import keep

#: Rows and weight (characters, mostly) of a batch that leaves a worker.
OUT_ROWS = 5_000
OUT_WEIGHT = 4_000_000
#: A row's number holds its partition above these bits.
_IN_PARTITION = 33


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


class Batches:
    """Rows put out as record batches of a bounded size."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.rows, self.weight = schema, [], 0

    def add(self, row: tuple, weight: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.weight += weight
        if len(self.rows) >= OUT_ROWS or self.weight >= OUT_WEIGHT:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows, strict=True), self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
        self.rows, self.weight = [], 0


def in_order(df: DataFrame, *order: str | Column) -> DataFrame:
    """``df`` sorted over range partitions, with ``pos`` numbering its rows in that order."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    return df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())


def sorted_rows(df: DataFrame, *order: str | Column) -> DataFrame:
    """``in_order``, computed once. Rows equal in ``order`` are not told apart: name enough columns, or a row number, to split them."""
    return keep(in_order(df, *order))


class Carried:
    """What a scan of sorted rows starts with in each partition.

    ``into``: by partition, the sum over the earlier rows of its first key. ``total``: the sum
    over all rows of each key that begins or ends a partition.
    """

    def __init__(self, into: dict[int, Any], total: dict[Any, Any]) -> None:
        self.into, self.total = into, total


def carried(rows: DataFrame, columns: list[str], summary: Callable[[Iterator[tuple]], list[int]], add: Callable[[list[int], list[int]], list[int]]) -> Carried:
    """Sums over the keys that begin or end a partition of ``rows``, which are in order of ``pos``.

    ``columns`` starts with the key, which is never null. ``summary`` takes the rows (key,
    other columns) of one key in order, ``add`` joins the summaries of two neighbouring runs.
    """

    schema = "part long, key string, sums array<string>, last boolean"
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, part = [], None
        for key, group in groupby(rows_of(batches), key=lambda r: r[0]):
            first = next(group)
            part = first[-1] >> _IN_PARTITION
            found[1:] = [(key, [str(x) for x in summary(chain([first], group))])]
        if found:
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "key": str(k), "sums": s, "last": i > 0 or len(found) == 1} for i, (k, s) in enumerate(found)],
                schema=arrow,
            )

    edges = rows.select(*columns, "pos").mapInArrow(run, schema)
    into, total, open_key, held = {}, {}, None, None
    for part, key, sums, last in sorted(map(tuple, edges.collect()), key=lambda e: (e[0], e[3])):
        sums = [int(x) for x in sums]
        if key == open_key:
            into[part] = held
            sums = add(held, sums)
        total[key] = sums
        open_key, held = (key, sums) if last else (None, None)
    return Carried(into, total)
