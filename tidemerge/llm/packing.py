"""Packing of documents into training sequences of several permitted lengths.

Pieces of documents are dealt evenly over groups of a bounded number of pieces,
whatever their document, and each group is packed on its own: best fit in
falling order of length, over bins of all permitted lengths at once. A piece
that fits no open bin opens the length of least cost for each token it will
hold. A group is packed once for every shortest length it may open, the
cheapest packing stays, and each bin shrinks to the shortest permitted length
that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.llm.common import keep

#: Permitted sequence lengths, in tokens; the tokens that a sequence costs besides its length; the length at which attention costs as much as the rest.
CAPACITIES = (2048, 4096, 8192, 16384, 32768)
OVERHEAD, QUADRATIC = 64, 65536
#: Pieces packed together by one task.
GROUP = 100_000


def cost(capacity: int) -> float:
    return OVERHEAD + capacity * (1 + capacity / QUADRATIC)


def best_fit(lengths: list[int], capacities: tuple[int, ...]) -> tuple[list[int], list[int]]:
    """The bin of every piece, and each bin's capacity as opened. ``lengths`` fall; none exceeds the largest capacity."""
    left: list[int] = []  # different residual rooms of open bins, rising
    bins: dict[int, list[int]] = {}  # by room
    place, opened, rest = [], [], sum(lengths)
    price = {c: cost(c) for c in capacities}
    for length in lengths:
        at = bisect_left(left, length)
        if at < len(left):
            room = left[at]
            b = bins[room].pop()
            if not bins[room]:
                del bins[room]
                del left[at]
        else:
            room = min((c for c in capacities if c >= length), key=lambda c: (price[c] / max(1, min(c, rest)), c))
            b = len(opened)
            opened.append(room)
        rest -= length
        place.append(b)
        room -= length
        if room:
            if room not in bins:
                bins[room] = []
                insort(left, room)
            bins[room].append(b)
    return place, opened


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES) -> tuple[list[int], list[int], list[int]]:
    """(bin of every piece, used tokens, capacity) of the cheapest of the packings that open no length below the k-th, each bin shrunk at the end."""
    best = None
    for k in range(len(capacities)):
        place, opened = best_fit(lengths, capacities[k:])
        used = [0] * len(opened)
        for b, length in zip(place, lengths, strict=True):
            used[b] += length
        shrunk = [capacities[bisect_left(capacities, u)] for u in used]
        total = sum(map(cost, shrunk))
        if best is None or total < best[0]:
            best = (total, place, used, shrunk)
    return best[1:]


def pieces_of(lengths: DataFrame, largest: int) -> DataFrame:
    """(doc_id, part, start, length): documents longer than ``largest`` are cut into full pieces and a rest; none is left out."""
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / largest) - 1))
    cut = lengths.select("doc_id", "n", parts.alias("part"))
    return cut.select("doc_id", "part", (F.col("part") * largest).alias("start"), F.least(F.lit(largest).cast("long"), F.col("n") - F.col("part") * largest).alias("length"))


def pack_documents(documents: DataFrame, capacities: tuple[int, ...] = CAPACITIES, group: int = GROUP, tokens: F.Column | None = None) -> DataFrame:
    """(doc_id, part, start, length, bin_id, position, bin_used, capacity): every token of every row in one bin.

    ``tokens`` counts a row's tokens, from one on; by default those of a
    byte-level vocabulary, the bytes of the text and one end mark, so null and
    empty texts are one token. Repeated rows and null ids are packed as they
    are. ``bin_id`` is unique; ties of length go by id and part. Other columns
    are not looked at. An empty table gives an empty one.
    """
    capacities = tuple(sorted(set(capacities)))
    count = F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))) + 1 if tokens is None else tokens
    pieces = keep(pieces_of(documents.select(F.col("doc_id").cast("long").alias("doc_id"), count.cast("long").alias("n")), capacities[-1]))
    groups = max(1, -(-pieces.count() // group))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("part", "ascending"), ("start", "ascending")])
        place, used, capacity = pack(rows["length"].to_pylist(), capacities)
        place = np.array(place)
        lengths = rows["length"].to_numpy()
        order = np.argsort(place, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.r_[True, place[order][1:] != place[order][:-1]]
        position = np.empty(len(place), np.int64)
        position[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        task = TaskContext.get().partitionId() << 32
        for name, values in (("bin_id", place + task), ("position", position), ("bin_used", np.array(used)[place]), ("capacity", np.array(capacity)[place])):
            rows = rows.append_column(name, pa.array(values.astype(np.int64)))
        yield from rows.combine_chunks().to_batches()

    schema = "doc_id long, part long, start long, length long, bin_id long, position long, bin_used long, capacity long"
    return pieces.repartition(groups).mapInArrow(run, schema)
