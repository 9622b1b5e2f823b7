"""A quality score for texts, learnt from labelled rows.

Statistics of a whole text go through random Fourier features, whose inner
products approximate a Gaussian kernel. Each partition of the labelled rows
sums its share of the normal equations; the ridge solution of the sums gives a
raw score, and an isotonic fit on labelled rows kept apart turns it into a
probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidemerge.llm.common import batches_of, held_out, keep, map_rows, written_with

SYMBOLS = rb"!#$%&*+/<=>?@[\]^_`{|}~"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
#: Random features, the width of the kernel in standardised statistics, the ridge and the steps of the calibration.
FEATURES, WIDTH, RIDGE, STEPS, SEED = 256, 4.0, 1e-4, 400, 7
THRESHOLD = 0.7


def statistics(text: str | None) -> list[float]:
    """Numbers about a whole text; all zero for a null, an empty or a blank one."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * 18
    raw = text.encode("utf-8", "surrogatepass")
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    digits = len(raw) - len(raw.translate(None, DIGITS))
    counts = Counter(words)
    most = [c for _, c in counts.most_common(3)]
    pairs = list(zip(words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, words))
    ends = sum(w[-1] in ".!?" for w in words)
    marked = sum(not w[-1].isalnum() and w[-1] not in ".,;:?)\"'" for w in words)
    return [
        np.log1p(n),
        np.log1p(len(text)),
        letters / n,
        np.log1p(max(map(len, counts))),
        len(counts) / n,
        most[0] / n,
        sum(most) / n,
        sum(a == b for a, b in pairs) / n,
        len(set(pairs)) / max(1, len(pairs)),
        symbols / len(raw),
        capitals / len(raw),
        digits / len(raw),
        ends / n,
        marked / n,
        sum(map(str.isupper, words)) / n,
        sum(len(w) == 1 and not w.isalnum() for w in words) / n,
        len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))),
    ]


def statistics_of(documents: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every row."""
    batches_of(documents.sparkSession)
    return map_rows(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
        "doc_id long, x array<double>",
        lambda ids, texts: [ids, pa.array([statistics(t) for t in texts.to_pylist()], pa.list_(pa.float64()))],
        "doc_id", "text",
    )


@dataclass
class Model:
    """All that a task needs to score a text: a few hundred kilobytes at most."""

    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    shift: np.ndarray
    weight: np.ndarray
    at: np.ndarray
    chance: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / len(self.shift)) * np.cos(z @ self.turn + self.shift)
        return np.column_stack([waves, np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        return np.interp(self.raw(x), self.at, self.chance)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def isotonic(value: np.ndarray, good: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nondecreasing step values closest to the shares good / n, by pooling neighbours that fall."""
    pools: list[list[float]] = []
    for v, g, k in sorted(zip(value.tolist(), good.tolist(), n.tolist(), strict=True)):
        pools.append([g, k, v, v])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            g, k, _, last = pools.pop()
            pools[-1][0] += g
            pools[-1][1] += k
            pools[-1][3] = last
    at = np.array([x for p in pools for x in (p[2], p[3] + 1e-9)])
    return at, np.array([x for p in pools for x in [p[0] / p[1]] * 2])


def fit(rows: DataFrame, labels: DataFrame) -> Model:
    """A model from (doc_id, x) and (doc_id, quality), without the rows held out.

    Rows without label, or with a null in doc_id, teach nothing. Of a
    document's differing labels the lowest counts. One labelled row in four, by
    another checksum of its id, calibrates and does not enter the ridge. With
    no row to learn from, every score is one half; with labels of one kind, all
    scores are that kind.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min((F.col("quality") > 0).cast("double")).alias("y"))
    apart = F.crc32(F.concat(F.lit("calibrate "), F.col("doc_id").cast("string")).cast("binary")) % 4 == 0
    known = keep(rows.join(known, "doc_id").select("x", "y", apart.alias("apart")))
    width = 18
    moments = known.agg(F.count("*").alias("n"), *(F.avg(F.col("x")[i]) for i in range(width)), *(F.stddev_pop(F.col("x")[i]) for i in range(width))).first()
    draw = np.random.default_rng(SEED)
    turn, shift = draw.normal(size=(width, FEATURES)) / WIDTH, draw.uniform(0, 2 * np.pi, FEATURES)
    nothing = Model(np.zeros(width), np.ones(width), turn, shift, np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    if not moments["n"]:
        return nothing
    mean, scale = np.array(moments[1 : 1 + width], float), np.array(moments[1 + width :], float)
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), turn, shift, nothing.weight, nothing.at, nothing.chance)
    model.weight = _ridge(known.where("NOT apart"), model)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.round(model.raw(matrix(b.column(0))) * STEPS) / STEPS), b.column(1)], ["raw", "y"])

    bins = known.where("apart").select("x", "y").mapInArrow(scored, "raw double, y double")
    bins = bins.withColumn("raw", F.greatest(F.lit(-2.0), F.least(F.lit(3.0), "raw"))).groupBy("raw").agg(F.sum("y"), F.count("*")).collect()  # 5 * STEPS + 1 rows at most
    if bins:
        model.at, model.chance = isotonic(*(np.array(c, float) for c in zip(*bins, strict=True)))
    else:
        model.at, model.chance = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def _ridge(rows: DataFrame, model: Model) -> np.ndarray:
    """Weights from normal equations that each partition sums; the driver gets the total, a fixed number of values."""
    side = FEATURES + 1

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((side, side + 1))
        for b in batches:
            if b.num_rows:
                z = model.features(matrix(b.column(0)))
                total += z.T @ np.column_stack([z, b.column(1).to_numpy()])
        yield pa.RecordBatch.from_arrays([pa.array(range(side), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": rows.i[:1], "row": [np.sum(np.stack(rows.row.tolist()), axis=0)]})

    total = rows.select("x", "y").mapInArrow(sums, "i int, row array<double>").groupBy("i").applyInPandas(add, "i int, row array<double>").collect()
    if not total:
        return np.zeros(side)
    both = np.array([r["row"] for r in sorted(total, key=lambda r: r["i"])])
    n = max(both[-1, -2], 1.0)
    return np.linalg.solve(both[:, :-1] + RIDGE * n * np.eye(side), both[:, -1])


def score_rows(rows: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) from (doc_id, x)."""
    return map_rows(rows, "doc_id long, score double", lambda ids, x: [ids, pa.array(model.score(matrix(x)), pa.float64())], "doc_id", "x")


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of (doc_id, text).

    Null and empty texts have statistics of zero and the score these get. A null
    doc_id is not held out. Repeated rows come back as often. Other columns,
    such as ``score``, are not looked at. An empty table gives an empty one.
    """
    rows = keep(statistics_of(documents))
    scored = score_rows(rows, fit(rows, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, all columns of any names, whose text scores at least ``threshold``.

    Null and empty texts have statistics of zero and the score these get; repeated rows have one
    score. The statistics are computed once and written beside the rows. With no row to learn
    from, every score is one half. An empty table gives an empty one.
    """
    rows = written_with(documents, "x", ArrayType(DoubleType()), lambda texts: [statistics(t) for t in texts])
    model = fit(rows.select(F.col("doc.doc_id").cast("long").alias("doc_id"), "x"), labels)
    schema = rows.schema

    def good(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(model.score(matrix(b.column(2))) >= threshold))

    return rows.mapInArrow(good, schema).select("doc.*")
