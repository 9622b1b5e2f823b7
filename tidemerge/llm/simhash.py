"""Near copies of texts by SimHash fingerprints, found with BK-trees.

Two fingerprints that differ in at most two bits agree on two of four 16-bit
quarters at least. So every distinct fingerprint goes to the six shards of its
pairs of quarters, a shard becomes a BK-tree, and the shard's fingerprints
search it along edges within the radius. A shard beyond ``SHARD`` fingerprints
is cut into parts; the tree of each part is sent to the tasks that hold the
queries of each other part, so a task holds two parts at most and no pair of
parts is left out. A task returns a spanning forest of the links it found,
never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemerge.llm.common import batches_of, keep, map_rows, written_with
from tidemerge.llm.components import Forest, components, links_batch
from tidemerge.operators.spread import spread_join

SEED = 42
RADIUS = 2
SHINGLE = 3
#: Fingerprints in one tree.
SHARD = 4096
QUARTERS = tuple(combinations(range(4), 2))


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words, repeats included; fewer words: of all; none: nothing."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, SEED)], np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    first, last = (end - length)[: 1 - shingle].tolist(), end[shingle - 1 :].tolist()
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, len(first))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if it is set in over half the hashes; as a signed 64-bit number."""
    hashes = shingle_hashes(text, shingle)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        block = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


class BKTree:
    """Children by their integer Hamming distance to the parent."""

    def __init__(self) -> None:
        self.top: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.top is None:
            self.top = (value, {})
            return
        node = self.top
        while True:
            d = (node[0] ^ value).bit_count()
            if d == 0:
                return
            child = node[1].get(d)
            if child is None:
                node[1][d] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> Iterator[int]:
        """The values at most ``radius`` bits away: only edges from d - radius to d + radius can lead to one."""
        stack = [self.top] if self.top else []
        while stack:
            held, children = stack.pop()
            d = (held ^ value).bit_count()
            if d <= radius:
                yield held
            for edge, child in children.items():
                if d - radius <= edge <= d + radius:
                    stack.append(child)


def _search(values: list[int], parts: list[int], a: int, b: int, radius: int, forest: Forest) -> None:
    """Links of one pair of parts: the tree holds part a, part b asks; a part with itself asks before it adds."""
    mask = (1 << 64) - 1
    tree = BKTree()
    if a != b:
        for value, part in zip(values, parts, strict=True):
            if part == a:
                tree.add(value & mask)
    for value, part in zip(values, parts, strict=True):
        if part == b:
            for other in tree.within(value & mask, radius):
                forest.join(value, other - (1 << 64) if other >> 63 else other)
            if a == b:
                tree.add(value & mask)


def _shards(radius: int):
    """Sorted rows (key, a, b, part, fp) to links, shard by shard."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy() for i in range(5)])
            rows = rows if left is None else np.concatenate([left, rows])
            cuts = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
            forest = Forest()
            for block in np.split(rows, cuts)[:-1]:
                _search(block[:, 4].tolist(), block[:, 3].tolist(), int(block[0, 1]), int(block[0, 2]), radius, forest)
            left = rows[cuts[-1] :] if len(cuts) else rows
            yield links_batch(forest)
        if left is not None and len(left):
            forest = Forest()
            _search(left[:, 4].tolist(), left[:, 3].tolist(), int(left[0, 1]), int(left[0, 2]), radius, forest)
            yield links_batch(forest)

    return run


def link_fingerprints(fingerprints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links (u, v) between the distinct fingerprints of column ``fp``: enough of them to join all that chains of at most ``radius`` (two or less) bits join."""
    if radius > 2:
        raise ValueError("two of four quarters agree only up to two bits")
    quarter = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF) for i in range(4)]
    keys = [F.lit(k << 32) + quarter[i] * 65536 + quarter[j] for k, (i, j) in enumerate(QUARTERS)]
    keyed = fingerprints.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / shard)
    held = keyed.join(sizes, "key").select("key", "fp", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts).alias("part"))
    met = held.select("key", "fp", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
    met = met.select("key", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "fp")
    return met.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "fp").mapInArrow(_shards(radius), "u long, v long")


def simhash_groups(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(doc_id, fp, component_id) for every row of (doc_id, text).

    A null or empty text has fingerprint zero and links like any other. Repeated
    rows come back as often. A null doc_id takes part but names no component:
    its component_id is null where all members have none. Other columns are not
    looked at. An empty table gives an empty one.
    """
    batches_of(documents.sparkSession)
    rows = keep(
        map_rows(
            documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
            "doc_id long, fp long",
            lambda ids, texts: [ids, pa.array([fingerprint(t, shingle) for t in texts.to_pylist()], pa.int64())],
            "doc_id", "text",
        )
    )
    found = groups_of(rows, radius, shard)
    return spread_join(rows, found, ["fp"], "inner").select("doc_id", "fp", "component_id")


def groups_of(rows: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(fp, component, component_id) for every distinct fingerprint of rows (doc_id, fp): the group's smallest fingerprint and smallest id."""
    held = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    groups = components(link_fingerprints(held.select("fp"), radius, shard))
    named = held.join(groups, held.fp == groups.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    first = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return spread_join(named, first, ["component"], "inner").select("fp", "component", "component_id")


def keep_one(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """One row of ``documents``, all columns, of each group of near copies: the one of smallest id.

    A row counts by its own text, so rows that repeat an id with other texts are told apart; of
    rows of one id in one group the first by fingerprint, then by a hash of the row, stays. A row
    without id stays only where no row of its group has one. Null and empty texts are one group.
    An empty table gives an empty one.
    """
    rows = written_with(documents, "fp", LongType(), lambda texts: [fingerprint(t, shingle) for t in texts])
    whole = F.xxhash64(*[F.col(f"doc.`{c}`") for c, t in documents.dtypes if "map<" not in t and t != "variant"])
    light = rows.select("place", "fp", F.col("doc.doc_id").cast("long").alias("doc_id"), whole.alias("whole"))
    found = groups_of(light.select("doc_id", "fp"), radius, shard).select("fp", "component")
    grouped = spread_join(light, found, ["fp"], "inner", spread_by=["place"])
    # the rank filter is pushed below the shuffle: a map task sends one row of a group at most
    order = Window.partitionBy("component").orderBy(F.col("doc_id").asc_nulls_last(), "fp", "whole", "place")
    first = grouped.withColumn("rank", F.row_number().over(order)).where("rank = 1").select("place")
    return rows.join(first, "place", "left_semi").select("doc.*")


def hexadecimal(column: str = "fp") -> F.Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")
