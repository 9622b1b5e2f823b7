"""Connected components of a graph held as a table of links.

Alternating star contraction: a round hangs larger neighbours of every node on
its smallest one, then smaller neighbours likewise, until each component is a
star around its smallest node. Each round is a few aggregations and joins over
the links that are left; the driver sees a count and a checksum only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.llm.common import keep
from tidemerge.operators.spread import spread_join


class Forest:
    """Union by smallest root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (y := up.get(top, top)) != top:
            top = y
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def links(self) -> tuple[list[int], list[int]]:
        """Every node below a root, with its root."""
        nodes = [x for x in self.up if self.root(x) != x]
        return nodes, [self.root(x) for x in nodes]


def links_batch(forest: Forest) -> pa.RecordBatch:
    u, v = forest.links()
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of each block of links: the same components from fewer links. A block is a bounded number of rows."""
    forest, n = Forest(), 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
        n += batch.num_rows
        if n >= 1_000_000:
            yield links_batch(forest)
            forest, n = Forest(), 0
    yield links_batch(forest)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (u, v): the smallest node that links reach.

    Self-links and links with a null end count for nothing; an empty table gives an empty one.
    """
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), F.col("u").isNotNull().alias("a"), F.col("v").isNotNull().alias("b"))
    links = links.where("a AND b AND u != v").select("u", "v").distinct().mapInArrow(_contract, "u long, v long")
    links, before = keep(links.distinct()), None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0] or state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select("v", "v").distinct())
        before = state
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # the hub of a large component holds a link of every node: such keys are spread
        large = spread_join(both, least, ["u"], "inner").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = spread_join(large, least, ["u"], "inner").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
        links = keep(small.distinct())
