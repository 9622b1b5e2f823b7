"""Nearest neighbours by a forest of random-projection trees.

The trees are split at medians of a bounded sample and are bounded themselves;
every vector is then dealt to its leaf of each tree. A query takes leaves of all
trees from one priority queue, ordered by the smallest margin on the way, and
the vectors of these leaves are ranked by exact cosine. How many leaves it takes
follows from sampled queries whose neighbours brute force gives, so that the
wanted recall is reached at any size. A leaf beyond ``LEAF_ROWS`` vectors, or
with as many queries, is searched in parts that together cover it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemerge.llm.common import keep
from tidemerge.llm.vectors import cosine, lengths, matrix, packed, sample, unit, unpacked, usable

#: Trees, vectors aimed at for each leaf, the depth at most, rows that the splits are fitted on: so many, or eight for each leaf of a tree.
TREES, LEAF, DEPTH, FIT_ROWS = 4, 1024, 14, 16384
#: Rows of a leaf, or queries, that a task holds at once; sampled queries; the recall that these must reach.
LEAF_ROWS, AUDIT, RECALL = 8192, 128, 0.97
SEED = 17


@dataclass
class Forest:
    """Full binary trees, nodes numbered from the top: direction and cut of each. At most TREES * 2^DEPTH directions."""

    turn: np.ndarray  # (tree, node, dimension)
    cut: np.ndarray  # (tree, node)
    depth: int

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        out = np.zeros((len(x), len(self.cut)), np.int64)
        for t in range(len(self.cut)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                right = np.einsum("ij,ij->i", x, self.turn[t, node]) > self.cut[t, node]
                node = 2 * node + 1 + right
            out[:, t] = node - (2**self.depth - 1)
        return out

    def visits(self, x: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
        """(tree, leaf) by falling priority, from one queue over all trees."""
        margin = self.turn @ x - self.cut
        inner = self.cut.shape[1]
        queue = [(-np.inf, t, 0) for t in range(len(self.cut))]
        while queue and most:
            far, t, node = heapq.heappop(queue)
            if node >= inner:
                most -= 1
                yield t, node - inner
                continue
            m = float(margin[t, node])
            heapq.heappush(queue, (max(far, m), t, 2 * node + 1))
            heapq.heappush(queue, (max(far, -m), t, 2 * node + 2))


def fit(rows: DataFrame, n: int, trees: int = TREES, leaf: int = LEAF) -> Forest:
    """Directions between two sampled vectors of a node, cut at the median of its sample."""
    depth = int(np.clip(np.ceil(np.log2(max(1, n) / leaf)), 0, DEPTH))
    _, x = sample(rows, max(FIT_ROWS, 8 << depth))
    x = unit(x)
    depth = min(depth, int(np.log2(max(1, len(x) / 8))))
    draw = np.random.default_rng(SEED)
    inner = 2**depth - 1
    turn, cut = np.zeros((trees, inner, x.shape[1])), np.zeros((trees, inner))
    for t in range(trees):
        held = {0: np.arange(len(x))}
        for node in range(inner):
            own = held.pop(node)
            pair = x[draw.choice(own, 2, replace=len(own) < 2)] if len(own) else np.zeros((2, x.shape[1]))
            turn[t, node] = pair[0] - pair[1]
            if not turn[t, node].any():
                turn[t, node] = draw.normal(size=x.shape[1])
            along = x[own] @ turn[t, node]
            cut[t, node] = np.median(along) if len(own) else 0.0
            held[2 * node + 1], held[2 * node + 2] = own[along <= cut[t, node]], own[along > cut[t, node]]
    return Forest(turn, cut, depth)


def best(ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` nearest ids of ``x`` to each query but its own, each by its nearest row, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    ux, uq = unit(x), unit(q)
    out = []
    for at in range(0, len(q), 256):
        near = uq[at : at + 256] @ ux.T
        near[q_ids[at : at + 256, None] == ids[None, :]] = -9
        once = near if len(starts) == len(ids) else np.maximum.reduceat(near, starts, axis=1)
        at_k = max(0, len(starts) - k)
        floor = np.partition(once, at_k, axis=1)[:, at_k] - 1e-9
        for i, row in enumerate(near):
            c = np.flatnonzero((row >= floor[i]) & (row > -5))
            exact = cosine(x[c], np.broadcast_to(q[at + i], (len(c), q.shape[1])))
            order = np.lexsort((ids[c], -exact))
            _, first = np.unique(ids[c][order], return_index=True)  # an id counts once
            order = order[np.sort(first)][:k]
            out.append((np.full(len(order), q_ids[at + i]), ids[c][order], exact[order]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]
    return pd.DataFrame({"query_id": np.array(columns[0], np.int64), "vec_id": np.array(columns[1], np.int64), "score": np.array(columns[2], np.float64)})


FOUND = "query_id long, vec_id long, score double"


def merged(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def brute_force(rows: DataFrame, q_ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """Neighbours of a bounded number of queries among all rows, each block of rows ranked where it lies."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pandas(best(b.column(0).to_numpy(), matrix(b.column(1)), q_ids, q, k), preserve_index=False)

    return merged(rows.select("vec_id", "x").mapInArrow(run, FOUND), k)


def leaves_needed(forest: Forest, rows: DataFrame, queries: DataFrame, k: int, recall: float = RECALL) -> int:
    """Leaves that each query must take so that sampled queries find their share of true neighbours."""
    q_ids, q = sample(queries, AUDIT)
    every = forest.cut.shape[0] * 2**forest.depth
    if not len(q_ids) or not forest.depth:
        return every
    true = brute_force(rows, q_ids, q, k).select("query_id", "vec_id").distinct().collect()
    wanted = sorted({r["vec_id"] for r in true})
    held = rows.where(F.col("vec_id").isin(wanted)).groupBy("vec_id").agg(F.min("x").alias("x")).select("vec_id", "x").toArrow()
    at = dict(zip(held["vec_id"].to_pylist(), forest.leaves(unit(matrix(held["x"].combine_chunks()))).tolist(), strict=True))
    ranks = []
    for i, query in zip(q_ids.tolist(), unit(q), strict=True):
        order = {leaf: n for n, leaf in enumerate(forest.visits(query, every), 1)}
        ranks += [min(order[leaf] for leaf in enumerate(at[r["vec_id"]])) for r in true if r["query_id"] == i]
    ranks.sort()
    return ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)] if ranks else 1


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, trees: int = TREES, leaf: int = LEAF, leaf_rows: int = LEAF_ROWS, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query by cosine, nearest first.

    Every usable row of ``vectors`` (vec_id, embedding) is indexed and is a
    candidate for all queries but that of its own id. Rows that are not usable
    (``vectors.usable``) take no part, as queries neither. Rows that repeat an
    id count once, with the higher cosine; queries that repeat an id ask once.
    With fewer candidates than ``k`` all come back; without queries or vectors,
    none. Only vectors of the query's length are candidates; each length has a
    forest of its own. Other columns are not looked at.
    """
    rows = keep(usable(vectors).distinct())
    asked = keep(usable(queries).groupBy("vec_id").agg(F.min("x").alias("x")))
    held, wanted = lengths(rows), lengths(asked)
    found = [
        _nearest(rows.where(F.size("x") == d), asked.where(F.size("x") == d), n, k, trees if n > leaf else 1, leaf, leaf_rows, recall)
        for d, n in held.items() if d in wanted
    ]
    if not found:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.union, found)


def _nearest(rows: DataFrame, asked: DataFrame, n: int, k: int, trees: int, leaf: int, leaf_rows: int, recall: float) -> DataFrame:
    """Neighbours among ``n`` vectors of one length. So few that they are one leaf have one tree."""
    forest = fit(rows, n, trees, leaf)
    most = leaves_needed(forest, rows, asked, k, recall)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1))
            at = forest.leaves(unit(x)) if b.num_rows else np.empty((0, trees), np.int64)
            ids, held = b.column(0), packed(x)
            for t in range(trees):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, t)), pa.array(at[:, t]), ids, held], ["tree", "leaf", "id", "x"])

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                x = matrix(b.column(1).slice(lo, 256))
                taken = [(i, t, leaf) for i, u in enumerate(unit(x)) for t, leaf in forest.visits(u, most)]
                i, t, leaf = (pa.array(np.array(c, np.int64)) for c in zip(*taken, strict=True))
                yield pa.RecordBatch.from_arrays([t, leaf, b.column(0).slice(lo, 256).take(i), packed(x).take(i)], ["tree", "leaf", "id", "x"])

    place = "tree long, leaf long, id long, x binary"
    dealt = rows.select("vec_id", "x").mapInArrow(deal, place)
    routed = asked.select("vec_id", "x").mapInArrow(route, place)
    both = keep(dealt.withColumn("asks", F.lit(False)).union(routed.withColumn("asks", F.lit(True))))
    parts = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n") / leaf_rows))
    sizes = both.groupBy("tree", "leaf").agg(F.sum((~F.col("asks")).cast("long")).alias("n"), F.sum(F.col("asks").cast("long")).alias("m"))
    sizes = sizes.select("tree", "leaf", parts.alias("parts"), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("m") / leaf_rows)).alias("turns"))
    # at most TREES * 2^DEPTH leaves, whatever the table
    held = both.join(F.broadcast(sizes), ["tree", "leaf"])
    own = F.xxhash64("id", "x")
    rows_to = F.transform(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1), lambda turn: F.struct(F.pmod(own, "parts").alias("part"), turn.alias("turn")))
    asks_to = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda part: F.struct(part.alias("part"), F.pmod(own, "turns").alias("turn")))
    met = held.withColumn("to", F.explode(F.when(F.col("asks"), asks_to).otherwise(rows_to))).select("tree", "leaf", "to.part", "to.turn", "asks", "id", "x")

    def rank(block: pd.DataFrame) -> pd.DataFrame:
        asks = block.asks.to_numpy(bool)
        if asks.all() or not asks.any():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        a, b = block[~asks], block[asks]
        return best(a.id.to_numpy(), unpacked(a.x), b.id.to_numpy(), unpacked(b.x), k)

    return merged(met.groupBy("tree", "leaf", "part", "turn").applyInPandas(rank, FOUND), k)
