"""Secrets in texts: patterns, and random strings that character Markov models add.

Two second-order character models, one of random strings and one of ordinary
identifiers, are counted from labelled samples. A token is a secret where the
random model explains it better by a margin.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.llm.common import apart_from, batches_of, map_rows

KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
#: Tokens that the models judge: runs of key characters of a certain length with a digit, or with both cases mixed within.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
MIXED = re.compile(r"[0-9]|[a-z][A-Z]+[a-z]")
#: The log-likelihood ratio that a token must reach, in all and for each character. Random strings are rare, so the whole must outweigh odds of ten thousand.
MARGIN, EACH = float(np.log(1e4)), 0.35
#: Documents whose words teach the ordinary model, at most; strings drawn for the random one.
FIT_ROWS, FIT_STRINGS = 500, 20_000
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SIZE = len(ALPHABET) + 1  # and the start

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """What the patterns find, leftmost and disjoint within a kind; matches that are too short go."""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return ordered(spans + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)])


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def codes(token: str) -> list[int]:
    return [ALPHABET.index(c) for c in token]


def counted(tokens: list[str]) -> np.ndarray:
    """How often each character follows each pair."""
    n = np.zeros((SIZE, SIZE, SIZE))
    for token in tokens:
        c = [SIZE - 1, SIZE - 1, *codes(token)]
        np.add.at(n, (c[:-2], c[1:-1], c[2:]), 1)
    return n


def chances(n: np.ndarray) -> np.ndarray:
    """Log-chances of a character after two, each order smoothed by the one below."""
    k = SIZE - 1
    one = (n.sum(axis=(0, 1)) + 0.5) / (n.sum() + 0.5 * k)
    two = (n.sum(axis=0) + 5 * one) / (n.sum(axis=(0, 2)) + 5)[:, None]
    return np.log((n + 5 * two) / (n.sum(axis=2) + 5)[:, :, None])


@dataclass
class Models:
    """The log-likelihood ratio of each character after two: random against ordinary. Two megabytes."""

    ratio: np.ndarray

    def score(self, token: str) -> float:
        c = [SIZE - 1, SIZE - 1, *codes(token)]
        return float(self.ratio[c[:-2], c[1:-1], c[2:]].sum())

    def secret(self, token: str) -> bool:
        return bool(MIXED.search(token)) and self.score(token) >= max(MARGIN, EACH * len(token))


def random_strings(n: int = FIT_STRINGS, seed: int = 5) -> list[str]:
    """Labelled random: hexadecimal, base 32, base 62 and base 64 strings of key lengths."""
    draw = np.random.default_rng(seed)
    kinds = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", ALPHABET[:62], ALPHABET[:64])
    return ["".join(kind[i] for i in draw.integers(0, len(kind), int(draw.integers(16, 49)))) for kind in kinds for _ in range(n // 4)]


def identifiers(words: list[str], seed: int = 6) -> list[str]:
    """Labelled ordinary: words, and names made of words the ways code and addresses join them, with numbers as these have them."""
    draw = np.random.default_rng(seed)
    words = [w for w in words if w] or ["name"]
    out = list(words)
    for _ in range(max(2000, len(words) // 2)):
        some = [words[i] for i in draw.integers(0, len(words), int(draw.integers(2, 5)))]
        number = str(draw.integers(0, 10 ** int(draw.integers(1, 9))))
        join = int(draw.integers(6))
        out.append(("_".join(some), "-".join(some), "".join(w.capitalize() for w in some), "/".join(some), "_".join(some).upper(), "_".join([*some, number]))[join])
    return out


def fit(documents: DataFrame, rows: int = FIT_ROWS) -> Models:
    """Models from random strings drawn here and from words of at most ``rows`` documents, the first by a hash of the id.

    Their words count as ordinary but for spans that the patterns find. The
    counts of the sample are added up by Spark; the driver gets one number for
    each three characters that occur.
    """
    ids = documents.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    ids = [r[0] for r in ids.collect()]

    def words(texts: pa.Array) -> list:
        seen = []
        for t in texts.to_pylist():
            for a, b, _ in reversed(base_spans(t or "")):
                t = t[:a] + " " + t[b:]
            seen += re.findall(r"[A-Za-z0-9+/_=-]{3,}", t or "")
        return [pa.array(seen, pa.string())]

    texts = documents.where(F.col("doc_id").isin(ids)).select(F.col("text").cast("string").alias("text"))
    seen = map_rows(texts, "word string", words, "text").where("length(word) <= 64").groupBy("word").count()
    # a word is a few characters and the sample is bounded, so is the list; ties and order do not matter to counts
    ordinary = [(r["word"], r["count"]) for r in seen.orderBy(F.desc("count"), "word").limit(50_000).collect()]
    n = counted(identifiers([w for w, _ in ordinary]))
    for word, count in ordinary:
        c = [SIZE - 1, SIZE - 1, *codes(word)]
        np.add.at(n, (c[:-2], c[1:-1], c[2:]), min(count, 100) - 1)
    return Models((chances(counted(random_strings())) - chances(n)).astype(np.float32))


def all_spans(text: str, models: Models) -> tuple[list[Span], list[Span]]:
    """(base spans, base and added spans); an added span meets no base span."""
    base = base_spans(text)
    added = [(m.start(), m.end(), "random") for m in TOKEN.finditer(text) if models.secret(m[0])]
    return base, ordered(base + apart_from(added, base))


def secrets(documents: DataFrame, models: Models | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of (doc_id, text).

    The counts and the checksum are those of the base patterns; ``spans`` holds
    the added ones too, of kind ``random``. A null text counts as empty: no
    spans, the checksum of nothing. Repeated rows and null ids come back as they
    are; other columns are not looked at; an empty table gives an empty one.
    """
    batches_of(documents.sparkSession)
    models = models or fit(documents)

    def find(ids: pa.Array, texts: pa.Array) -> list:
        spans = [all_spans(t or "", models) for t in texts.to_pylist()]
        counts = [pa.array([sum(s[2] == kind for s in base) for base, _ in spans], pa.int64()) for kind in BASE]
        sums = pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in spans], pa.string())
        return [ids, *counts, sums, pa.array([written(every) for _, every in spans], pa.string())]

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = ", ".join(f"n_{kind} long" for kind in BASE)
    return map_rows(rows, f"doc_id long, {counts}, base_sha256 string, spans string", find, "doc_id", "text")
