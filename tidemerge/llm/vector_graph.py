"""Near copies among embeddings by a flat graph with robust pruning.

Vectors go to the shards of their closest clusters, several each, so shards
overlap. Every shard builds a graph: neighbours pruned so that none is closer to
a kept one than to the vector by a factor, links both ways, a few far links. The
lists of a vector from all its shards are united. Then every vector searches the
shards it lies in: greedily from the medoid until it meets itself, with a beam
that widens as long as it does not, and from there through all vectors in range.
Pairs found are verified in double precision. Brute force on sampled vectors
audits the recall of vectors, groups of every size apart; below the wanted one, the
search runs again with more overlap, and at last compares all pairs.

A cluster beyond ``SHARD`` vectors is cut into parts; each part's vectors search
every part, two parts to a task. A pair that shares one cluster only can be found
in one task, which counts it. Pairs that share several come back packed by vector
and are made distinct by a shuffle, so a link found in any cluster counts once and
none is lost. For the groups a task returns a spanning forest of what it linked.

Clusters grow with the table: beyond ``CLUSTERS`` of them, each of a first level is
cut into clusters of a second one, fitted on a bounded sample of its own vectors.
Vectors of different lengths never link; each length is searched apart.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemerge.llm.common import keep
from tidemerge.llm.components import Forest, components
from tidemerge.llm.sorted_rows import rows_of, sorted_rows
from tidemerge.llm.vectors import cosine, lengths, matrix, packed, sample, unit, unpacked, usable
from tidemerge.operators.spread import spread_join

THRESHOLD = 0.95
#: Vectors of a shard, shards of a vector, clusters of a level at most, rows that the clusters of a level, or within one, are fitted on.
SHARD, OVERLAP, CLUSTERS, FIT_ROWS = 2048, 3, 2048, 8192
#: First-level clusters of a vector where there are two levels; shares that the links of one vector are packed in.
OUTER, BUCKETS = 2, 256
#: Neighbours, candidates for them, far links of a vector; the factor of the pruning; beams; how far below the threshold the search still goes on.
NEAR, CANDIDATES, FAR, ALPHA, BEAMS, SLACK = 16, 64, 4, 1.2, (8, 32, 128), 0.03
#: Vectors that search together; sampled vectors of the audit, and the recall it wants.
TOGETHER, AUDIT, RECALL = 256, 1000, 0.98


def fit_clusters(x: np.ndarray, k: int, rounds: int = 6, seed: int = 23) -> np.ndarray:
    """Unit centres by spherical k-means."""
    draw = np.random.default_rng(seed)
    centres = x[np.sort(draw.choice(len(x), k, replace=False))]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, total / np.maximum(size, 1e-300), centres)
    return centres


def pruned(near: np.ndarray, candidates: np.ndarray, room: int) -> np.ndarray:
    """For every row, up to ``room`` of its candidates (by falling nearness, -1: none): each kept one strikes those it is closer to by ``ALPHA``. -1 fills."""
    m = len(candidates)
    rows = np.arange(m)[:, None]
    alive = candidates >= 0
    away = np.sqrt(np.maximum(2 - 2 * near[rows, candidates], 0))
    out = np.full((m, room), -1, np.int64)
    for k in range(room):
        first = alive.argmax(axis=1)
        some = alive[rows[:, 0], first]
        if not some.any():
            break
        pick = candidates[rows[:, 0], first]
        out[some, k] = pick[some]
        between = np.sqrt(np.maximum(2 - 2 * near[pick[:, None], candidates], 0))
        alive &= (ALPHA * between > away) & some[:, None]
        alive[rows[:, 0], first] = False
    return out


def build(x: np.ndarray, seed: int = 29) -> tuple[list[np.ndarray], int]:
    """Neighbours of every vector of a shard, and the medoid: the vector closest to the mean."""
    m = len(x)
    x = x.astype(np.float32)
    near = x @ x.T
    medoid = int((x @ x.mean(axis=0)).argmax())
    if m == 1:
        return [np.empty(0, np.int64)], medoid
    np.fill_diagonal(near, -9)
    k = min(CANDIDATES, m - 1)
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    top = np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, axis=1), axis=1, kind="stable"), axis=1)
    np.fill_diagonal(near, 1)
    first = pruned(near, top, NEAR)
    # both ways: a vector that many link back to prunes again
    a, b = np.nonzero(first >= 0)
    linked = np.zeros((m, m), bool)
    linked[a, first[a, b]] = linked[first[a, b], a] = True
    degree = linked.sum(axis=1)
    out = [np.flatnonzero(row) for row in linked]
    many = np.flatnonzero(degree > 2 * NEAR)
    if len(many):
        wide = int(degree.max())
        lists = np.full((m, wide), -1, np.int64)
        for i in many:
            lists[i, : degree[i]] = out[i][np.argsort(-near[i, out[i]], kind="stable")]
        cut = pruned(near, lists, 2 * NEAR)
        for i in many:
            out[i] = cut[i][cut[i] >= 0]
    far = np.random.default_rng(seed).integers(0, m, (m, FAR))
    return [np.setdiff1d(np.append(o, f), [i]) for i, (o, f) in enumerate(zip(out, far, strict=True))], medoid


class Searcher:
    """The graph of one shard, asked by many vectors in step."""

    def __init__(self, x: np.ndarray, lists: list[np.ndarray], medoid: int) -> None:
        self.x, self.single, self.medoid = x, x.astype(np.float32), medoid
        self.lists = np.full((len(x), max(1, max(map(len, lists), default=1))), -1, np.int64)
        for row, held in zip(self.lists, lists, strict=True):
            row[: len(held)] = held

    def greedy(self, q: np.ndarray, own: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vectors, nearness, met itself): the beam of every query once it met itself, or has nothing left to open."""
        n, beam = len(q), min(beam, len(self.x))
        rows = np.arange(n)
        seen = np.zeros((n, len(self.x)), bool)
        ids, near, shut = np.full((n, beam), -1, np.int64), np.full((n, beam), -9, np.float32), np.ones((n, beam), bool)
        ids[:, 0], near[:, 0], shut[:, 0], seen[:, self.medoid] = self.medoid, q @ self.single[self.medoid], False, True
        met = own == self.medoid
        while True:
            pick = np.where(shut, -10, near).argmax(axis=1)
            r = rows[~shut[rows, pick] & ~met]
            if not len(r):
                return ids, near, met
            node = ids[r, pick[r]]
            shut[r, pick[r]] = True
            ahead = self.lists[node]
            fresh = (ahead >= 0) & ~seen[r[:, None], ahead]
            i, j = np.nonzero(fresh)
            v = ahead[i, j]
            seen[r[i], v] = True
            got = np.full(ahead.shape, -9, np.float32)
            got[i, j] = np.einsum("ij,ij->i", q[r[i]], self.single[v])
            every, who, done = np.concatenate([near[r], got], axis=1), np.concatenate([ids[r], ahead], axis=1), np.concatenate([shut[r], ~fresh], axis=1)
            top = np.argpartition(-every, beam - 1, axis=1)[:, :beam]
            near[r], ids[r], shut[r] = (np.take_along_axis(c, top, axis=1) for c in (every, who, done))
            met[r] |= (own[r] >= 0) & seen[r, own[r]]

    def within(self, q: np.ndarray, own: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, vector) pairs of at least ``threshold``, verified; ``own``: the query's place in this shard, or -1."""
        single = q.astype(np.float32)
        found_q, found_v = [], []
        todo = np.arange(len(q))
        for beam in BEAMS:
            # a query that is not in the shard cannot meet itself: it takes the widest beam at once
            now = todo[own[todo] >= 0] if beam != BEAMS[-1] else todo
            if len(now):
                ids, near, met = self.greedy(single[now], own[now], beam)
                a, b = np.nonzero((ids >= 0) & (near >= threshold - SLACK))
                found_q.append(now[a])
                found_v.append(ids[a, b])
                todo = np.setdiff1d(todo, now[met | (own[now] < 0)])
        inside = own >= 0
        found_q.append(np.flatnonzero(inside))
        found_v.append(own[inside])
        m = len(self.x)
        ahead = np.unique(np.concatenate(found_q) * m + np.concatenate(found_v))
        seen = np.zeros(len(q) * m, bool)
        seen[ahead] = True
        pairs = []
        while len(ahead):
            pairs.append(ahead)
            fresh = []
            for at in range(0, len(ahead), 2048):
                block = ahead[at : at + 2048]
                lists = self.lists[block % m]
                code = ((block // m) * m)[:, None] + lists
                code = np.unique(code[(lists >= 0) & ~seen[np.where(lists >= 0, code, 0)]])
                seen[code] = True
                near = np.einsum("ij,ij->i", single[code // m], self.single[code % m])
                fresh.append(code[near >= threshold - SLACK])
            ahead = np.concatenate(fresh)
        code = np.concatenate(pairs) if pairs else np.empty(0, np.int64)
        keep_ = np.concatenate([cosine(q[c // m], self.x[c % m]) >= threshold for c in np.array_split(code, len(code) // 50_000 + 1)])
        return code[keep_] // m, code[keep_] % m


def _closest(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` closest centres of each row, by number."""
    near = x @ centres.T
    return np.sort(np.argpartition(-near, k - 1, axis=1)[:, :k], axis=1).astype(np.int64)


PLACED = "c long, cls long, n long, shards array<long>, x binary"


def _assign(classes: DataFrame, centres: np.ndarray, overlap: int) -> DataFrame:
    """(c, cls, n, shards, x): a row for each of the closest clusters of a class, with the list of these."""
    k = min(overlap, len(centres))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = unit(matrix(b.column(2)))
                top = _closest(x, centres, k)
                lists, held = pa.array(list(top), pa.list_(pa.int64())), packed(x)
                for j in range(k):
                    yield pa.RecordBatch.from_arrays([pa.array(top[:, j]), b.column(0), b.column(1), lists, held], ["c", "cls", "n", "shards", "x"])

    return classes.select("cls", "n", "x").mapInArrow(run, PLACED)


def _fit_inner(shard: int, overlap: int):
    """The centres within one first-level cluster, from a sample of its vectors and their number."""

    def run(sampled: pd.DataFrame) -> pd.DataFrame:
        x = unpacked(sampled.sort_values("cls").x)
        k = int(np.clip(np.ceil(sampled.size_.iloc[0] * overlap / shard), 1, min(CLUSTERS, len(x))))
        return pd.DataFrame({"c": sampled.c.iloc[0], "x": [v.tobytes() for v in fit_clusters(x, k)]})

    return run


def _assign_inner(overlap: int):
    """Sorted rows (c, share, place, cls, n, x), of each share the centres first, by place: vectors go to the closest of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (c, _), rows in groupby(rows_of(batches), key=lambda r: r[:2]):
            centres, held = [], []

            def flush() -> Iterator[pa.RecordBatch]:
                if held:
                    x = np.frombuffer(b"".join(r[5] for r in held)).reshape(len(held), -1)
                    top = _closest(x, at, min(overlap, len(at))) + c * CLUSTERS
                    for j in range(top.shape[1]):
                        columns = [top[:, j], [r[3] for r in held], [r[4] for r in held], [r[5] for r in held]]
                        yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], ["c", "cls", "n", "x"])
                    held.clear()

            at = None
            for row in rows:
                if row[2] is not None:
                    centres.append(np.frombuffer(row[5]))
                    continue
                at = np.array(centres) if at is None else at
                held.append(row)
                if len(held) == 1024:
                    yield from flush()
            yield from flush()

    return run


def _assign_two_levels(classes: DataFrame, centres: np.ndarray, overlap: int, shard: int) -> DataFrame:
    """As ``_assign``, with clusters fitted within those of ``centres``; a vector lies in clusters of ``OUTER`` of these."""
    outer = keep(_assign(classes, centres, OUTER).select("c", "cls", "n", "x"))
    sizes = outer.groupBy("c").agg(F.count("*").alias("size_")).withColumn("shares", F.ceil(F.col("size_") / (64 * shard)))  # a row for each of ``centres``
    first = F.row_number().over(Window.partitionBy("c").orderBy(F.xxhash64("x"), "cls"))
    sampled = outer.withColumn("rank", first).where(F.col("rank") <= FIT_ROWS).join(F.broadcast(sizes), "c")
    inner = sampled.groupBy("c").applyInPandas(_fit_inner(shard, overlap), "c long, x binary")
    inner = inner.join(F.broadcast(sizes), "c").withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
    none = F.lit(None).cast("long")
    inner = inner.select("c", "share", F.xxhash64("x").alias("place"), none.alias("cls"), none.alias("n"), "x")
    vectors = outer.join(F.broadcast(sizes), "c").select("c", F.pmod(F.xxhash64("cls"), "shares").alias("share"), none.alias("place"), "cls", "n", "x")
    dealt = inner.unionByName(vectors).repartition("c", "share").sortWithinPartitions("c", "share", F.col("place").asc_nulls_last(), "x")
    placed = keep(dealt.mapInArrow(_assign_inner(overlap), "c long, cls long, n long, x binary"))
    lists = placed.groupBy("cls").agg(F.sort_array(F.collect_list("c")).alias("shards"))  # OUTER * overlap of them
    return placed.join(lists, "cls").select("c", "cls", "n", "shards", "x")


def _build_shard(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values("cls")
    cls = shard.cls.to_numpy()
    lists, medoid = build(unpacked(shard.x))
    return pd.DataFrame({"c": shard.c.to_numpy(), "part": shard.part.to_numpy(), "cls": cls, "near": [cls[o] for o in lists], "medoid": np.arange(len(cls)) == medoid})


def _all_close(x: np.ndarray, rows: np.ndarray, asks: np.ndarray, threshold: float) -> np.ndarray:
    """Codes of all close pairs (rows, asks), compared without a graph."""
    m, single, codes = len(x), x.astype(np.float32), [np.empty(0, np.int64)]
    for lo in range(0, len(asks), TOGETHER):
        some = asks[lo : lo + TOGETHER]
        i, v = np.nonzero(single[some] @ single[rows].T >= threshold - 1e-4)
        i, v = some[i], rows[v]
        for at in range(0, len(i), 50_000):
            p, q = i[at : at + 50_000], v[at : at + 50_000]
            close = (p != q) & (cosine(x[p], x[q]) >= threshold)
            codes.append((np.minimum(p, q) * m + np.maximum(p, q))[close])
    return np.unique(np.concatenate(codes))


FOUND = "cls long, links long, other long, bucket long, partners array<long>, weights array<long>"


def _packs(cls: np.ndarray, n: np.ndarray, i: np.ndarray, v: np.ndarray) -> pd.DataFrame:
    """Links both ways, packed by class and bucket of the partner."""
    own, other = np.concatenate([i, v]), np.concatenate([v, i])
    bucket = cls[other] % BUCKETS
    order = np.lexsort((bucket, own))
    own, other, bucket = own[order], other[order], bucket[order]
    cut = np.flatnonzero((own[1:] != own[:-1]) | (bucket[1:] != bucket[:-1])) + 1
    at = np.append(0, cut) if len(own) else cut
    return pd.DataFrame({
        "cls": cls[own[at]], "links": pd.array([None] * len(at), "Int64"), "other": pd.array([None] * len(at), "Int64"), "bucket": pd.array(bucket[at], "Int64"),
        "partners": np.split(cls[other], cut) if len(at) else [], "weights": np.split(n[other], cut) if len(at) else [],
    })


def _search_block(threshold: float, exact: bool = False):
    """Two parts of a cluster, or one with itself: rows of ``FOUND``.

    Each part's vectors search the other part's graph; a pair is linked if
    either of its two finds the other. Pairs that lie in this cluster only are
    counted in ``links``, others come back as ``partners`` of each. ``other`` names
    the forest's links. ``exact``: all pairs are compared instead.
    """

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("cls")
        cls, n, x = block.cls.to_numpy(), block.n.to_numpy(), unpacked(block.x)
        a, b, m = int(block.a.iloc[0]), int(block.b.iloc[0]), len(block)
        place = {p: np.flatnonzero(block.part == p) for p in (a, b)}
        codes = [np.empty(0, np.int64)]
        if exact:
            codes.append(_all_close(x, place[a], place[b], threshold))
        medoid, near = (None, None) if exact else (block.medoid.to_numpy(bool), block.near.tolist())
        for p, asking in () if exact else ((a, b), (b, a))[: 1 + (a != b)]:
            rows, asks = place[p], place[asking]
            if not len(rows) or not len(asks):
                continue
            lists = []
            for r in rows:
                held = np.asarray(near[r], np.int64)
                at = np.minimum(np.searchsorted(cls[rows], held), len(rows) - 1)
                lists.append(at[cls[rows][at] == held])
            graph = Searcher(x[rows], lists, int(medoid[rows].argmax()))
            own = np.arange(len(rows)) if p == asking else np.full(len(asks), -1)
            for lo in range(0, len(asks), TOGETHER):
                i, v = graph.within(x[asks[lo : lo + TOGETHER]], own[lo : lo + TOGETHER], threshold)
                i, v = asks[lo + i], rows[v]
                codes.append((np.minimum(i, v) * m + np.maximum(i, v))[i != v])
        shards = np.stack(block.shards.tolist())
        code = np.unique(np.concatenate(codes))
        i, v = code // m, code % m
        links, forest, packs = np.zeros(m, np.int64), Forest(), []
        for lo in range(0, len(code), 100_000):
            p, q = i[lo : lo + 100_000], v[lo : lo + 100_000]
            alone = (shards[p][:, :, None] == shards[q][:, None, :]).sum(axis=(1, 2)) == 1
            links += np.bincount(p[alone], n[q[alone]], m).astype(np.int64) + np.bincount(q[alone], n[p[alone]], m).astype(np.int64)
            packs.append(_packs(cls, n, p[~alone], q[~alone]))
            for one, other in zip(cls[p].tolist(), cls[q].tolist(), strict=True):
                forest.join(one, other)
        u, w = forest.links()
        some = links > 0
        none = [None]
        rest = pd.DataFrame({
            "cls": np.array([*cls[some].tolist(), *u], np.int64),
            "links": pd.array([*links[some].tolist(), *none * len(u)], "Int64"), "other": pd.array([*none * int(some.sum()), *w], "Int64"),
            "bucket": pd.array(none * (int(some.sum()) + len(u)), "Int64"), "partners": none * (int(some.sum()) + len(u)), "weights": none * (int(some.sum()) + len(u)),
        })
        whole = pd.concat([rest, *[p for p in packs if len(p)]], ignore_index=True)
        return whole.astype({"partners": object, "weights": object})

    return run


def search(classes: DataFrame, centres: np.ndarray, overlap: int, threshold: float, shard: int, exact: bool = False, levels: int = 1) -> DataFrame:
    """Rows of ``FOUND`` of all blocks; ``exact``: without graphs, of all pairs that share a cluster."""
    placed = keep(_assign(classes, centres, overlap) if levels == 1 else _assign_two_levels(classes, centres, overlap, shard))
    sizes = placed.groupBy("c").agg(F.ceil(F.count("*") / shard).alias("parts"))
    placed = keep(spread_join(placed, sizes, ["c"], "inner").withColumn("part", F.pmod(F.xxhash64("cls"), "parts")))
    to = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    if exact:
        met = placed.withColumn("other", to).select("c", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "cls", "n", "shards", "x")
        return met.groupBy("c", "a", "b").applyInPandas(_search_block(threshold, exact), FOUND)
    graph = keep(placed.select("c", "part", "cls", "x").groupBy("c", "part").applyInPandas(_build_shard, "c long, part long, cls long, near array<long>, medoid boolean"))
    united = graph.groupBy("cls").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    medoids = graph.where("medoid").select("c", "part", "cls", "medoid")
    nodes = placed.join(united, "cls").join(medoids, ["c", "part", "cls"], "left")
    nodes = nodes.withColumn("medoid", F.coalesce("medoid", F.lit(False)))
    met = nodes.withColumn("other", to)
    met = met.select("c", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "cls", "n", "shards", "x", "near", "medoid")
    return met.groupBy("c", "a", "b").applyInPandas(_search_block(threshold), FOUND)


def counted(found: DataFrame) -> DataFrame:
    """(cls, links, other) from rows of ``FOUND``: links that several blocks found count once."""
    packs = found.where("partners IS NOT NULL").repartition("cls", "bucket")
    pairs = packs.select("cls", "bucket", F.explode(F.arrays_zip("partners", "weights")).alias("p")).select("cls", "bucket", "p.partners", "p.weights")
    once = pairs.groupBy("cls", "bucket", "partners").agg(F.max("weights").alias("links")).select("cls", "links")
    links = once.union(found.where("links IS NOT NULL").select("cls", "links")).groupBy("cls").agg(F.sum("links").alias("links"))
    none = F.lit(None).cast("long")
    return links.select("cls", "links", none.alias("other")).union(found.where("other IS NOT NULL").select("cls", none, "other"))


def audit(classes: DataFrame, found: DataFrame, threshold: float, n: int = AUDIT) -> float:
    """The mean share that sampled classes find of their links, by brute force over all classes; 1 where there are none.

    Every class weighs the same, and the least mean counts: of all, and of those
    with as many links, by powers of two. So large groups do not hide small ones.
    """
    ids, x = sample(classes, n, "cls")
    u = unit(x)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids))
        for b in batches:
            if b.num_rows:
                close = u @ unit(matrix(b.column(2))).T >= threshold
                close &= ids[:, None] != b.column(0).to_numpy()[None, :]
                total += close @ b.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total.astype(np.int64))], ["cls", "there"])

    there = classes.select("cls", "n", "x").mapInArrow(run, "cls long, there long").groupBy("cls").agg(F.sum("there").alias("there"))
    both = there.join(found.groupBy("cls").agg(F.sum("links").alias("links")), "cls", "left")
    both = both.where("there > 0").select(F.floor(F.log2("there")).alias("size"), (F.least("there", F.coalesce("links", F.lit(0))) / F.col("there")).alias("share"))
    row = both.rollup("size").agg(F.avg("share").alias("share")).agg(F.min("share").alias("share")).first()
    return 1.0 if row["share"] is None else row["share"]


def linked(classes: DataFrame, n: int, threshold: float = THRESHOLD, shard: int = SHARD, overlap: int = OVERLAP) -> DataFrame:
    """(cls, links, other): links of each of ``n`` classes (cls, n, x) of one length, and a forest that joins what they link."""
    _, x = sample(classes, FIT_ROWS, "cls")
    wanted = int(np.ceil(n * overlap / shard))
    levels = 1 + (wanted > CLUSTERS)
    k = int(np.clip(np.ceil(np.sqrt(wanted)) if levels == 2 else wanted, 1, min(CLUSTERS, len(x))))
    centres = fit_clusters(unit(x), k)
    widest = min(4 * OVERLAP, max(k, overlap)) if levels == 1 else 4 * OVERLAP
    while audit(classes, found := keep(counted(keep(search(classes, centres, overlap, threshold, shard, levels=levels)))), threshold) < RECALL:
        if overlap >= widest:
            # one cluster: every part meets every other, which grows with the square of the classes
            return keep(counted(keep(search(classes, centres[:1], 1, threshold, shard, exact=True))))
        overlap += OVERLAP
    return found


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD, overlap: int = OVERLAP) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding).

    Rows with the same components are one class, searched once; each links with
    the others. Rows that are not usable (``vectors.usable``) link with nothing, and
    vectors of different lengths do not link with each other.
    A row with a null id links with nothing, has no component and is kept.
    Repeated rows come back as often and count as vectors. Other columns are not
    looked at. An empty table gives an empty one.
    """
    named = [F.xxhash64("x").alias("_x"), F.xxhash64(F.lit(1), "x").alias("_y")]  # 128 bits stand for a vector
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    every = every.select("vec_id", *[F.when(F.col("x").isNotNull(), h).alias(c) for h, c in zip(named, ("_x", "_y"), strict=True)])
    classes = usable(vectors).groupBy("x").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    # numbers in the order of ids: what is drawn and fitted does not depend on partitions
    classes = sorted_rows(classes, "first", "x").withColumnRenamed("pos", "cls")
    held = lengths(classes)
    alone = every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not held:
        return alone
    found = reduce(DataFrame.union, [linked(classes.where(F.size("x") == d), n, threshold, shard, overlap) for d, n in held.items()])
    links = found.where("links IS NOT NULL").groupBy("cls").agg(F.sum("links").alias("links"))
    groups = components(found.where("other IS NOT NULL").select(F.col("cls").alias("u"), F.col("other").alias("v")))
    joined = classes.select("cls", "n", "first", *named).join(links, "cls", "left").join(groups, F.col("cls") == F.col("node"), "left")
    joined = joined.select("_x", "_y", "n", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "cls").alias("component"))
    smallest = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = spread_join(joined, smallest, ["component"], "inner").select("_x", "_y", (F.col("links") + F.col("n") - 1).alias("more"), "component_id")
    rows = spread_join(every, of_class, ["_x", "_y"])
    in_group = F.col("component_id").isNotNull() & F.col("vec_id").isNotNull()
    own = F.when(in_group, F.col("component_id")).otherwise(F.col("vec_id"))
    return rows.select(
        "vec_id", F.when(in_group, F.col("more")).otherwise(0).cast("long").alias("n_links"), own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"),
    )
