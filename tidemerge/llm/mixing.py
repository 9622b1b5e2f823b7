"""Rates for documents so that the expected tokens of each domain meet target weights.

A softmax classifier over hashed pairs of bytes, fitted on a labelled table,
gives every document a probability for each domain. Rates minimise the squares of
the gaps between expected domain tokens and targets, weighted by the inverse of the
domains' shares, by projected gradient. The gradient of a document follows from its
probabilities and the gaps of the step, one number per domain. A pass over the
documents tries several step lengths at once, each projected to permitted rates; the
best average of all rates tried so far, a small problem over domains, is where the next
step starts. Averages of permitted rates are permitted, and few of them suffice. The
documents replay the steps before, so no state is kept between passes but the gaps and
the weights of the averages.

Each step also bounds how far the rates of the step before are from the best ones:
a gradient at any rates gives a lower bound for the squares that rates can reach, and
the difference bounds what is left to gain. Steps end by that bound.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.llm.common import batches_of, keep, map_rows

#: Hashed pairs of bytes; labelled rows that the classifier is fitted on at most, and those that each domain has besides; its steps.
WIDTH, FIT_ROWS, DOMAIN_ROWS, FIT_STEPS = 1024, 2000, 20, 150
#: Passes over the documents at most; what the squares may lie above the least ones at the end, as a share of those at first, or the domain tokens from the best ones, as a share of all tokens.
STEPS, GAP, CLOSE = 20, 1e-4, 1e-4
#: Below the gap, steps go on as long as each takes so much off the squares.
SLOW = 0.95
#: Step lengths that a pass tries.
LENGTHS = (1, 2, 4, 16, 64, 256, 1024, 4096, 1e5, 1e7)


def byte_pairs(raw: bytes) -> np.ndarray:
    """Roots of the shares of hashed pairs of neighbouring bytes; zeros for less than two bytes."""
    b = np.frombuffer(raw.lower(), np.uint8)
    if len(b) < 2:
        return np.zeros(WIDTH, np.float32)
    pairs = b[:-1].astype(np.uint16) * np.uint16(37) + b[1:]
    return np.sqrt(np.bincount(pairs % WIDTH, minlength=WIDTH) / len(pairs)).astype(np.float32)


@dataclass
class Mixture:
    """Classifier, and the gaps of each step once solved."""

    domains: list[str]
    weight: np.ndarray
    least: float = 0.0
    most: float = float("inf")
    gaps: list[np.ndarray] = field(default_factory=list)
    averages: list[dict[tuple[int, int], float]] = field(default_factory=list)  # after each step: weights of (step, length) tried, of the start (-1, 0); a length of one, where the list is shorter
    excess: float = 0.0  # proven bound of what the squares of the gaps lie above the least ones, in shares of those at first
    distance: float = 0.0  # and of the domain tokens from the best ones, in shares of all tokens

    def posteriors(self, raws: list[bytes]) -> np.ndarray:
        if not raws:
            return np.empty((0, len(self.domains)))
        x = np.stack([byte_pairs(r) for r in raws])
        z = x @ self.weight[:-1] + self.weight[-1]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def rates(self, posterior: np.ndarray) -> np.ndarray:
        """The rates after all steps: each goes down its gradient and back into the permitted range."""
        rate = np.full(len(posterior), min(max(1.0, self.least), self.most))
        tried = {(-1, 0): rate}
        wanted = {key for weights in self.averages for key in weights}
        for step, (gap, weights) in enumerate(zip_longest(self.gaps, self.averages)):
            along, weights = posterior @ gap, weights or {(step, 0): 1.0}
            for at, length in enumerate(LENGTHS):
                if (step, at) in wanted or (step, at) in weights:
                    tried[step, at] = self._projected(rate, along, length)
            rate = sum(w * tried[key] for key, w in weights.items())
        return rate

    def _projected(self, rate: np.ndarray, along: np.ndarray, length: float) -> np.ndarray:
        return np.clip(rate - length * along, self.least, self.most)


def fit_classifier(documents: DataFrame, labelled: DataFrame, rows: int = FIT_ROWS) -> Mixture:
    """A softmax regression from texts of ``labelled`` (doc_id, domain).

    Every domain of the table takes part. The texts are ``rows`` at most, the
    first by a hash of the id, and the first ``DOMAIN_ROWS`` of each domain,
    weighted so that domains weigh as in the whole table.
    Rows with a null in either column teach nothing; of a document's differing
    domains the smallest counts. Without labels there is one domain, ''.
    """
    known = labelled.where("doc_id IS NOT NULL AND domain IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("domain").cast("string")).alias("domain"))
    known = keep(known)
    sizes = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    domains = sorted(sizes) or [""]
    if len(domains) == 1:
        return Mixture(domains, np.zeros((WIDTH + 1, 1)))
    drawn = _drawn(known, sizes, rows)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # so many ids as the driver holds already: FIT_ROWS and DOMAIN_ROWS of each domain
    texts = texts.join(F.broadcast(known.sparkSession.createDataFrame([(i,) for i in drawn], "doc_id long")), "doc_id", "left_semi")
    known = drawn
    seen = map_rows(
        texts, "doc_id long, x array<float>",
        lambda ids, held: [ids, pa.array([byte_pairs((t or "").encode("utf-8", "surrogatepass")) for t in held.to_pylist()], pa.list_(pa.float32()))],
        "doc_id", "text",
    ).dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow()
    x = np.column_stack([seen["x"].combine_chunks().flatten().to_numpy().reshape(seen.num_rows, -1), np.ones(seen.num_rows, np.float32)])
    y = np.zeros((seen.num_rows, len(domains)), np.float32)
    y[np.arange(seen.num_rows), [domains.index(known[i]) for i in seen["doc_id"].to_pylist()]] = 1
    total = np.array([sizes[d] for d in domains], np.float32)
    return Mixture(domains, _softmax_regression(x, y, y @ (total / np.maximum(1, y.sum(axis=0)))))


def _drawn(known: DataFrame, sizes: dict[str, int], rows: int) -> dict[int, str]:
    """The domain of the first ``rows`` labelled rows by a hash of the id, and of the first ``DOMAIN_ROWS`` of each domain.

    The hash has to lie below a bound that some four times as many rows pass, so no domain,
    however common, sends more to the driver. That fewer pass than wanted does not happen in
    practice, and would cost the sample a few rows.
    """
    place = F.xxhash64("doc_id").cast("double") / 2.0**64 + 0.5
    bounds = [(d, max(4.0 * DOMAIN_ROWS / n, 4.0 * rows / sum(sizes.values()))) for d, n in sizes.items()]
    limits = F.broadcast(known.sparkSession.createDataFrame(bounds, "domain string, bound double"))  # a row for each domain
    passed = known.join(limits, "domain").withColumn("h", F.xxhash64("doc_id")).where(place <= F.col("bound"))
    by_hash = sorted((r["h"], r["doc_id"], r["domain"]) for r in passed.select("h", "doc_id", "domain").collect())
    out = {i: d for _, i, d in by_hash[:rows]}
    held = dict.fromkeys(sizes, 0)
    for _, i, d in by_hash:
        held[d] += 1
        if held[d] <= DOMAIN_ROWS:
            out[i] = d
    return out


def _softmax_regression(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, rate: float = 0.3) -> np.ndarray:
    weight = (weight / max(1.0, weight.sum()))[:, None].astype(np.float32)
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, FIT_STEPS + 1):
        z = x @ w
        e = np.exp(z - z.max(axis=1, keepdims=True))
        g = x.T @ ((e / e.sum(axis=1, keepdims=True) - y) * weight) + penalty * w
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        w -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return w


def raw_of(texts: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts.to_pylist()]


def soft_membership(documents: DataFrame, model: Mixture) -> DataFrame:
    """(doc_id, n_tokens, p): tokens are the bytes of the text and an end mark, p the probability of each domain."""
    batches_of(documents.sparkSession)

    def score(ids: pa.Array, texts: pa.Array) -> list:
        raws = raw_of(texts)
        return [ids, pa.array([len(r) + 1 for r in raws], pa.int64()), pa.array(list(model.posteriors(raws)), pa.list_(pa.float64()))]

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, "doc_id long, n_tokens long, p array<double>", score, "doc_id", "text")


def _posterior(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def solve(rows: DataFrame, model: Mixture, targets: dict[str, float] | None = None, power: float = 0.7, least: float = 0.0, most: float = float("inf")) -> np.ndarray:
    """Fill ``model.gaps``; the expected domain tokens reached, as shares of all tokens of ``rows`` (doc_id, n_tokens, p).

    ``targets`` are tokens by domain; a domain of the labelled table without
    target gets none, a target for an unknown domain is an error. Without them
    the targets are the domains' expected tokens to the ``power``, scaled to all
    tokens where rates may fall below one, else up until no domain has to fall.
    """
    k = len(model.domains)
    model.least, model.most, model.gaps, model.averages, model.excess, model.distance = least, most, [], [], 0.0, 0.0
    tokens, tried, _ = _reached(rows, model, np.zeros(k), 0.0)
    if not tokens:
        return np.zeros(k)
    reached = tried[0]
    share = reached / min(max(1.0, least), most)  # of the documents as they are
    if targets is None:
        goal = np.where(share > 0, share, 0.0) ** power
        goal /= goal.sum()
        if least >= 1:
            goal /= (goal[share > 0] / share[share > 0]).min()
    else:
        if unknown := set(targets) - set(model.domains):
            raise ValueError(f"targets for domains without labels: {sorted(unknown)}")
        goal = np.array([targets.get(d, 0.0) for d in model.domains]) / tokens
    # probabilities of a document sum to one, so with these weights a gradient step of length one is safe
    weight = 1 / np.maximum(share, 1e-12)
    points = [((-1, 0), reached)]
    at_first, last = None, np.inf
    for _ in range(STEPS):
        gap = reached - goal
        slope, value = weight * gap, gap @ (weight * gap) / 2
        if np.abs(gap).max() <= CLOSE / 100:
            model.excess, model.distance = 0.0, float(np.sqrt((gap * gap).sum()))
            return reached
        _, tried, low = _reached(rows, model, slope, goal.sum() + np.sqrt(2 * value))
        # the squares cannot fall by more than the slope falls at most, nor below zero: that bounds the distance from the best, too
        excess = min(max(0.0, slope @ reached - low), value)
        at_first = value if at_first is None else at_first
        model.excess, model.distance = float(excess / at_first), float(np.sqrt(2 * excess * share.max()))
        if model.distance <= CLOSE or model.excess <= GAP and value > SLOW * last:
            return reached
        last = value
        points += [((len(model.gaps), at), tokens_of) for at, tokens_of in enumerate(tried[1:])]
        weights = _closest_average(np.array([(p - goal) * np.sqrt(weight) for _, p in points]))
        model.gaps.append(slope)
        model.averages.append({points[i][0]: float(w) for i, w in weights.items()})
        reached = sum(w * points[i][1] for i, w in weights.items())
    warnings.warn(f"the squares of the gaps may be {model.excess:.1e} of what they were too large after {STEPS} passes", stacklevel=2)
    return reached


def _closest_average(points: np.ndarray) -> dict[int, float]:
    """Weights, of sum one, of the few rows whose average is closest to zero: Wolfe's algorithm for the nearest point of a hull."""
    held = [int((points * points).sum(axis=1).argmin())]
    weight = np.ones(1)
    for _ in range(1000):
        now = weight @ points[held]
        along = points @ now
        best = int(along.argmin())
        if along[best] >= (1 - 1e-9) * (now @ now) or best in held:
            break
        held, weight = [*held, best], np.append(weight, 0.0)
        while True:
            # the closest point of the affine hull; where it lies outside, the row that leaves first goes
            rows = points[held]
            wanted = np.linalg.lstsq(np.vstack([np.ones(len(held)), rows @ rows.T - (rows @ rows.T)[:1]]), np.r_[1.0, np.zeros(len(held))], rcond=None)[0]
            if wanted.min() > 1e-12:
                weight = wanted / wanted.sum()
                break
            falls = wanted <= 1e-12
            ratio = np.min(weight[falls] / np.maximum(weight[falls] - wanted[falls], 1e-300))
            weight = weight + min(1.0, ratio) * (wanted - weight)
            stays = weight > 1e-12
            held, weight = [h for h, s in zip(held, stays, strict=True) if s], weight[stays] / weight[stays].sum()
    return dict(zip(held, weight.tolist(), strict=True))


def _reached(rows: DataFrame, model: Mixture, slope: np.ndarray, most_tokens: float) -> tuple[float, np.ndarray, float]:
    """Tokens, expected domain tokens under the rates so far and under a step of each length along ``slope``, and the least that ``slope`` can give, in shares of the tokens.

    The least is over all permitted rates with ``most_tokens`` of all tokens at most; without
    that bound rates without upper limit could make it as small as one likes. One pass, sums
    by partition, a few numbers per domain.
    """
    k, ways = len(model.domains), 1 + len(LENGTHS)
    least, most = model.least, model.most

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, low = np.zeros(ways * k + 2), 0.0
        for b in batches:
            p, n = _posterior(b.column(1), k), b.column(0).to_numpy()
            along, rate = p @ slope, model.rates(p)
            tried = np.stack([rate, *(model._projected(rate, along, length) for length in LENGTHS)])
            total[:-2] += ((tried * n) @ p).ravel()
            total[-2] += n.sum()
            total[-1] += n @ (along * np.where((along < 0) & np.isfinite(most), min(most, 1e300), least))
            low = min(low, along.min(initial=0.0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total), pa.array(np.full(len(total), low))], ["j", "total", "low"])

    got = rows.select("n_tokens", "p").mapInArrow(sums, "j long, total double, low double").groupBy("j").agg(F.sum("total").alias("total"), F.min("low").alias("low"))
    held = sorted(map(tuple, got.collect()))
    if not held or not held[-2][1]:
        return 0.0, np.zeros((ways, k)), 0.0
    tokens, low = held[-2][1], held[-1][1] / held[-2][1]
    if not np.isfinite(most):
        low += max(0.0, most_tokens - least) * held[-1][2]
    return tokens, np.array([t for _, t, _ in held[:-2]]).reshape(ways, k) / tokens, low


def chance_of(ids: list[int | None], salt: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A number in [0, 1) from each id, for rounding a rate to copies; the same wherever it is computed. A null id counts as -1."""
    x = np.array([-1 if i is None else i for i in ids], np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        x = (x + np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(11)) / 2.0**53


def copies_of(rate: np.ndarray, ids: list[int | None]) -> np.ndarray:
    whole = np.floor(rate + 1e-9)
    return (whole + (chance_of(ids) < rate - whole)).astype(np.int64)


def mixing_rates(documents: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, **bounds: float) -> DataFrame:
    """(doc_id, domain, posterior, n_tokens, rate, copies) for every row of (doc_id, text).

    ``domain`` is the likeliest one, the first by name of equally likely ones;
    ``copies`` is the rate rounded up or down by a hash of the id. Null and empty
    texts are one token with the classifier's bias as probabilities. Repeated
    rows come back as often, with the same rate; null ids keep null. Other
    columns are not looked at; an empty table gives an empty one.
    """
    model = fit_classifier(documents, labelled)
    rows = keep(soft_membership(documents, model))
    solve(rows, model, targets, **bounds)
    k = len(model.domains)

    def rate(ids: pa.Array, tokens: pa.Array, p: pa.Array) -> list:
        p = _posterior(p, k)
        rates, top = model.rates(p), p.argmax(axis=1)
        return [ids, pa.array([model.domains[i] for i in top], pa.string()), pa.array(p[np.arange(len(p)), top]), tokens, pa.array(rates), pa.array(copies_of(rates, ids.to_pylist()))]

    return map_rows(rows, "doc_id long, domain string, posterior double, n_tokens long, rate double, copies long", rate, "doc_id", "n_tokens", "p")


def mix(documents: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, **bounds: float) -> DataFrame:
    """``documents``, all columns, each row as often as its rate says; texts are read, never shuffled.

    Null and empty texts are one token with the classifier's bias as probabilities. Rows that
    repeat have the same rate each; a null id rounds like the id -1. Without documents, or
    without labels, rows come back as they are, but for the bounds of their rates. Columns of
    any name pass through.
    """
    model = fit_classifier(documents, labelled)
    solve(keep(soft_membership(documents, model).select("n_tokens", "p")), model, targets, **bounds)
    columns, types = documents.columns, documents.schema

    def repeat(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                rates = model.rates(model.posteriors(raw_of(b.column(columns.index("text")))))
                copies = copies_of(rates, b.column(columns.index("doc_id")).cast(pa.int64()).to_pylist())
                for k in range(int(copies.max())):  # a block at a time: no more rows at once than came in
                    yield b.filter(pa.array(copies > k))

    batches_of(documents.sparkSession)
    return documents.mapInArrow(repeat, types)
