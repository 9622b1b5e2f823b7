"""Personal data in texts: patterns, and what a character tagger adds to them.

The tagger is a bidirectional LSTM over characters whose tag scores go through
a CRF, trained here in numpy on labelled spans. It reads overlapping windows
around every character that one of its spans must hold. A span that a window cuts
and none holds whole is read again in a wider one, which holds every span up to
``LONGEST`` characters around it. Spans that windows propose are
reconciled over the whole text: the disjoint set with the greatest total score.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.llm.common import apart_from, batches_of, map_rows

KINDS = ("email", "ip", "card", "phone")
#: Base patterns; possessive, as no shorter run could match where the longest one does not.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NAME = re.compile(r"[A-Za-z0-9._%+-]++")
HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
NAME_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Every span of the tagger holds one of these.
ANCHOR = re.compile(r"[0-9@]|[(\[]at[)\]]")
WINDOW, STRIDE = 64, 32
#: The longest span: a name of 64 characters and a host of 255, as mail permits, and " (at) " between. A longer one is no address.
LONGEST = 64 + 255 + 6
#: Second readings: lengths are multiples of this, cut spans close together share one up to so many characters, and so many characters are read at once.
STEP, SHARED, AT_ONCE = 128, 2048, 1 << 16

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From the start of the run of name characters before each @, or the end of the match before."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in NAME_CHARACTERS:
            start -= 1
        found = HOST.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_byte(digits: str) -> bool:
    """At most 255; of however many digits, as zeros may lead."""
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or "0") < 256


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by start, then kind. Leftmost and disjoint within a kind; matches that fail their check go."""
    spans = [(a, b, "email") for a, b in emails(text)]
    if re.search("[0-9]", text):
        spans += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(map(is_byte, m.groups()))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(digits := digits_of(m[0])) <= 19 and luhn(digits):
                spans.append((m.start(), m.end(), "card"))
        spans += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return ordered(spans)


def ordered(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def written(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


# ---------------------------------------------------------------- the tagger

#: One code per character class: letters one by one, digits as one, the marks that matter, the rest.
SYMBOLS = "abcdefghijklmnopqrstuvwxyz" + "@.-+()[]_%/:=, \n"
OTHER_LETTER, DIGIT, OTHER = len(SYMBOLS), len(SYMBOLS) + 1, len(SYMBOLS) + 2
CODES = len(SYMBOLS) + 3
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


def codes(text: str) -> np.ndarray:
    at = {c: i for i, c in enumerate(SYMBOLS)}
    return np.array([at.get(c) if c in at else DIGIT if "0" <= c <= "9" else at.get(c.lower(), OTHER_LETTER) if c.isalpha() else OTHER for c in text], np.int64)


def labelled_windows(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``n`` windows with the tag of every character: invented prose, spans of each kind in several spellings, and numbers that are none of them."""
    draw = np.random.default_rng(seed)
    pick = lambda options: options[int(draw.integers(len(options)))]
    number = lambda k: "".join(map(str, draw.integers(0, 10, k)))
    word = lambda low=2, high=9: "".join("abcdefghijklmnopqrstuvwxyz"[i] for i in draw.integers(0, 26, int(draw.integers(low, high))))

    def email() -> str:
        name = pick([word(), f"{word()}.{number(2)}", f"{word()}_{word()}", f"{word()}.{word()}"])
        host = pick([f"{word()}.com", f"{word()}{number(1)}.{word()}.org", f"mail{number(1)}.{word()}.com"])
        return name + pick(["@", "@", " (at) ", "(at)", " [at] "]) + host

    def card() -> str:
        digits = number(int(draw.integers(12, 18)))
        digits += next(d for d in "0123456789" if luhn(digits + d))
        gap = pick(["", "", " ", "-"])
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))

    def phone() -> str:
        return pick([f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}", f"({number(3)}) {number(3)}-{number(4)}", f"+{number(2)} {number(3)} {number(3)} {number(3)}", f"{number(3)}-{number(3)}-{number(4)}", f"{number(3)}.{number(3)}.{number(4)}"])

    def address() -> str:
        return ".".join(str(x) for x in draw.integers(0, 256, 4))

    def plain() -> str:
        return pick([number(1) + "." + number(1) + ".", number(1), number(4), f"{number(1)}.{number(1)}.{number(2)}", f"{number(2)}/{number(2)}/{number(4)}", f"{number(4)}-{number(2)}-{number(2)}", f"{number(2)}:{number(2)}", f"${number(3)}.{number(2)}", f"@{word()}", f"token={number(2)}a{number(3)}f{number(4)}b{number(3)}", f"{number(1)},{number(3)},{number(3)}", f"AKIA{number(3)}XW{number(5)}", f"{word()} @ {word()}"])

    makers = dict(zip(KINDS, (email, address, card, phone), strict=True))
    x, y = np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), np.int64)
    for k in range(n):
        text, tags = "", []
        while len(text) < WINDOW:
            if draw.random() < 0.35:
                kind = pick(KINDS)
                piece, tag = makers[kind](), 1 + 2 * KINDS.index(kind)
                tags += [tag] + [tag + 1] * (len(piece) - 1)
            else:
                piece = plain() if draw.random() < 0.3 else " ".join(word() for _ in range(int(draw.integers(1, 6))))
                tags += [0] * len(piece)
            gap = pick([" ", " ", ", ", ". ", "\n", ": "])
            text, tags = text + piece + gap, tags + [0] * len(gap)
        x[k], y[k] = codes(text[:WINDOW]), tags[:WINDOW]
    return x, y


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tagger:
    """Weights: per direction the gates from code and state, then tag scores and transitions. Some twenty kilobytes."""

    weights: dict[str, np.ndarray]

    def _run(self, x: np.ndarray, way: str, cache: list | None = None) -> np.ndarray:
        """States (time, window, unit) of one direction."""
        w, u = self.weights["x" + way], self.weights["h" + way]
        size = u.shape[0]
        h, c = np.zeros((len(x), size), u.dtype), np.zeros((len(x), size), u.dtype)
        out = np.zeros((x.shape[1], len(x), size), u.dtype)
        for t in range(x.shape[1]) if way == "f" else range(x.shape[1] - 1, -1, -1):
            gates = w[x[:, t]] + h @ u
            ifo, g = _sigmoid(gates[:, : 3 * size]), np.tanh(gates[:, 3 * size :])
            i, f, o = ifo[:, :size], ifo[:, size : 2 * size], ifo[:, 2 * size :]
            before_h, before_c = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if cache is not None:
                cache.append((t, i, f, o, g, tc, before_h, before_c))
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (time, window, tag)."""
        both = np.concatenate([self._run(x, "f"), self._run(x, "b")], axis=2)
        return both @ self.weights["out"] + self.weights["bias"]

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tags (window, time) by Viterbi, and the tag scores."""
        scores, step = self.scores(x), self.weights["step"] + FORBIDDEN
        best, back = scores[0], []
        for t in range(1, len(scores)):
            options = best[:, :, None] + step
            back.append(options.argmax(axis=1))
            best = options.max(axis=1) + scores[t]
        tag = best.argmax(axis=1)
        tags = [tag]
        for b in reversed(back):
            tag = b[np.arange(len(tag)), tag]
            tags.append(tag)
        return np.stack(tags[::-1], axis=1), scores.transpose(1, 0, 2)


#: An inside tag follows the begin or inside tag of its kind only; a window may start within a span.
FORBIDDEN = np.zeros((TAGS, TAGS), np.float32)
for _k in range(2, TAGS, 2):
    FORBIDDEN[:, _k] = -1e4
    FORBIDDEN[[_k - 1, _k], _k] = 0


def _crf(scores: np.ndarray, step: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, and its gradients by tag scores and transitions."""
    n_times, n, k = scores.shape
    top = lambda a, axis: (m := a.max(axis=axis, keepdims=True), np.log(np.exp(a - m).sum(axis=axis)) + m.squeeze(axis))[1]
    full = step + FORBIDDEN
    alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
    alpha[0] = scores[0]
    for t in range(1, n_times):
        alpha[t] = top(alpha[t - 1][:, :, None] + full, 1) + scores[t]
    for t in range(n_times - 2, -1, -1):
        beta[t] = top(full + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
    total = top(alpha[-1], 1)
    by_score, by_step = np.exp(alpha + beta - total[:, None]), np.zeros_like(step)
    rows = np.arange(n)
    loss = total.sum()
    for t in range(n_times):
        by_score[t, rows, y[:, t]] -= 1
        loss -= scores[t, rows, y[:, t]].sum()
        if t:
            both = alpha[t - 1][:, :, None] + full + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
            by_step += np.exp(both).sum(axis=0)
            np.add.at(by_step, (y[:, t - 1], y[:, t]), -1)
            loss -= full[y[:, t - 1], y[:, t]].sum()
    return loss / n, by_score / n, by_step / n


def train(steps: int = 260, batch: int = 40, units: int = 16, rate: float = 0.02, seed: int = 11) -> Tagger:
    """A tagger fitted by Adam on labelled windows drawn anew for every step; the same on every machine with the same numpy."""
    draw = np.random.default_rng(seed)
    w = {k + way: draw.normal(0, 0.2, shape) for way in "fb" for k, shape in (("x", (CODES, 4 * units)), ("h", (units, 4 * units)))}
    w |= {"out": draw.normal(0, 0.2, (2 * units, TAGS)), "bias": np.zeros(TAGS), "step": np.zeros((TAGS, TAGS))}
    for way in "fb":
        w["x" + way][:, units : 2 * units] += 1.0  # remember at first
    w = {k: v.astype(np.float32) for k, v in w.items()}
    model = Tagger(w)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    xs, ys = labelled_windows(3000, seed)
    for at in range(1, steps + 1):
        rows = draw.integers(0, len(xs), batch)
        x, y = xs[rows], ys[rows]
        caches = {"f": [], "b": []}
        states = np.concatenate([model._run(x, way, caches[way]) for way in "fb"], axis=2)
        _, by_score, by_step = _crf(states @ w["out"] + w["bias"], w["step"], y)
        by_score = by_score.astype(np.float32)
        slope = {"step": by_step, "bias": by_score.sum(axis=(0, 1)), "out": np.einsum("tnh,tnk->hk", states, by_score)}
        by_state = by_score @ w["out"].T
        for way, part in (("f", slice(0, units)), ("b", slice(units, None))):
            gh, dh, dc, by_gate = np.zeros_like(w["h" + way]), np.float32(0), np.float32(0), []
            for t, i, f, o, g, tc, before_h, before_c in reversed(caches[way]):
                dh = dh + by_state[t][:, part]
                dc = dc + dh * o * (1 - tc * tc)
                gates = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                by_gate.append((x[:, t], gates))
                gh += before_h.T @ gates
                dh, dc = gates @ w["h" + way].T, dc * f
            at_code = np.eye(CODES, dtype=np.float32)[np.concatenate([c for c, _ in by_gate])]
            slope["x" + way], slope["h" + way] = at_code.T @ np.concatenate([g for _, g in by_gate]), gh
        size = np.sqrt(sum((g * g).sum() for g in slope.values()))
        now = rate * (1 - 0.9 * at / steps)
        for k, g in slope.items():
            g = g * min(1.0, 5.0 / (size + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] -= (now * (first[k] / (1 - 0.9**at)) / (np.sqrt(second[k] / (1 - 0.999**at)) + 1e-8)).astype(np.float32)
    return model


def windows(text: str) -> list[int]:
    """Starts of the windows that hold an anchor: multiples of the stride, each anchor in two windows."""
    starts: set[int] = set()
    last = -1
    for m in ANCHOR.finditer(text):
        block = m.start() // STRIDE
        if block != last:
            starts.update((max(0, block - 1) * STRIDE, block * STRIDE))
            last = block
    return sorted(starts)


def proposals(tags: np.ndarray, scores: np.ndarray, start: int, length: int) -> Iterator[tuple[float, Span]]:
    """Spans within one window with their score: the mean lead of their tags over outside. A span that touches an inner border of the window is left to the next window."""
    t, n = 0, len(tags)
    while t < n:
        if tags[t] % 2 == 1:
            end = t + 1
            while end < n and tags[end] == tags[t] + 1:
                end += 1
            if (t > 0 or start == 0) and (end < n or start + n >= length):
                at = np.arange(t, end)
                yield float((scores[at, tags[at]] - scores[at, 0]).mean()), (start + t, min(start + end, length), KINDS[tags[t] // 2])
            t = end
        else:
            t += 1


def sound(kind: str, piece: str) -> bool:
    """The check that an added span of a kind must pass."""
    digits = digits_of(piece)
    if kind == "email":
        m = re.fullmatch(r"([A-Za-z0-9._%+-]+) ?(?:\(at\)|\[at\]|@) ?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)", piece)
        return bool(m) and len(m[1]) <= 64 and len(m[2]) <= 255
    if kind == "ip":
        return bool(m := IP.fullmatch(piece)) and all(len(p) < 4 and is_byte(p) for p in m.groups())
    if kind == "card":
        return bool(CARD.fullmatch(piece)) and 13 <= len(digits) <= 19 and luhn(digits)
    return bool(re.fullmatch(r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])(?:[0-9]{2,4}[ .-]){1,3}[0-9]{2,4}", piece)) and 10 <= len(digits) <= 15


def reconcile(found: list[tuple[float, Span]]) -> list[Span]:
    """Of proposals from all windows of a text, the disjoint ones of greatest total score."""
    best: dict[Span, float] = {}
    for score, span in found:
        if score > 0:
            best[span] = max(score, best.get(span, 0.0))
    spans = sorted(best, key=lambda s: (s[1], s[0], KINDS.index(s[2])))
    ends = [s[1] for s in spans]
    total, take = [0.0], []
    for i, s in enumerate(spans):
        before = bisect_right(ends, s[0], 0, i)
        with_it = total[before] + best[s]
        take.append(before if with_it > total[-1] else None)
        total.append(max(with_it, total[-1]))
    out, i = [], len(spans)
    while i:
        if take[i - 1] is None:
            i -= 1
        else:
            out.append(spans[i - 1])
            i = take[i - 1]
    return out[::-1]


def cut_spans(tags: np.ndarray, start: int, length: int) -> Iterator[tuple[int, int]]:
    """What one window holds of spans that touch its inner borders."""
    n = len(tags)
    outside = np.flatnonzero((tags == 0) | (tags % 2 == 1))  # where a span ends before, or begins
    if start > 0 and tags[0]:
        end = outside[outside > 0]
        yield start, start + (int(end[0]) if len(end) else n)
    if start + n < length and tags[-1]:
        yield start + (int(outside[-1]) if len(outside) and tags[outside[-1]] else 0), start + n


def _decoded(texts: list[str], where: list[tuple[int, int, int]], model: Tagger) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, tags, scores) of the windows (text, start, end) that hold a tag.

    Windows of many texts run together, a bounded number of characters at a time, those of one
    length only: what a window reads past its text depends on nothing but itself.
    """
    by_length: dict[int, list[int]] = {}
    for row, (_, start, end) in enumerate(where):
        by_length.setdefault(end - start, []).append(row)
    for length, rows in sorted(by_length.items()):
        few = max(1, AT_ONCE // length)
        for at in range(0, len(rows), few):
            part = rows[at : at + few]
            x = np.full((len(part), length), SYMBOLS.index(" "), np.int64)
            for i, row in enumerate(part):
                k, start, end = where[row]
                piece = codes(texts[k][start:end])
                x[i, : len(piece)] = piece
            tags, scores = model.decode(x)
            for i in np.flatnonzero(tags.any(axis=1)):
                yield part[i], tags[i], scores[i]


def wider(cut: list[tuple[int, int]]) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Windows (start, end, spans) around cut spans, which hold any span up to ``LONGEST`` characters that meets them."""
    out: list[tuple[int, int, list[tuple[int, int]]]] = []
    for a, b in sorted(cut):
        start, end = max(0, a - LONGEST), b + LONGEST
        if out and end - out[-1][0] <= SHARED:
            first, last, held = out.pop()
            start, end, held = first, max(last, end), [*held, (a, b)]
        else:
            held = [(a, b)]
        out.append((start, end, held))
    return [(start, start - (start - end) // STEP * STEP, held) for start, end, held in out]


def tagged(texts: list[str], model: Tagger) -> list[list[Span]]:
    """The tagger's spans of each text. Each is the same whatever texts it is read with."""
    found: list[list[tuple[float, Span]]] = [[] for _ in texts]
    sounds = lambda k, p: sound(p[1][2], texts[k][p[1][0] : p[1][1]])
    where = [(k, start, start + WINDOW) for k, text in enumerate(texts) for start in windows(text)]
    cut: list[set[tuple[int, int]]] = [set() for _ in texts]
    for row, tags, scores in _decoded(texts, where, model):
        k, start, _ = where[row]
        found[k] += [p for p in proposals(tags, scores, start, len(texts[k])) if sounds(k, p)]
        cut[k].update(cut_spans(tags, start, len(texts[k])))
    where, around = [], []
    for k, pieces in enumerate(cut):
        whole = sorted((s[0], s[1]) for _, s in found[k])
        starts, reach = [s[0] for s in whole], list(accumulate((s[1] for s in whole), max, initial=-1))
        for start, end, held in wider([(a, b) for a, b in pieces if reach[bisect_right(starts, a)] < b]):
            where.append((k, start, end))
            around.append(held)
    for row, tags, scores in _decoded(texts, where, model):
        k, start, _ = where[row]
        near = [p for p in proposals(tags, scores, start, len(texts[k])) if sounds(k, p)]
        found[k] += [p for p in near if any(p[1][0] < b and a < p[1][1] for a, b in around[row])]
    return [reconcile(f) for f in found]


def all_spans(texts: list[str], model: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, base and added spans) of each text; an added span meets no base span."""
    out = []
    for text, added in zip(texts, tagged(texts, model), strict=True):
        base = base_spans(text)
        out.append((base, ordered(base + apart_from(added, base))))
    return out


def personal_data(documents: DataFrame, model: Tagger | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of (doc_id, text).

    The counts and the checksum are those of the base patterns; ``spans`` holds
    the added ones too. A null text counts as empty: no spans, the checksum of
    nothing. Repeated rows and null ids come back as they are; other columns are
    not looked at; an empty table gives an empty one.
    """
    model = model or train()

    def find(ids: pa.Array, texts: pa.Array) -> list:
        spans = all_spans([t or "" for t in texts.to_pylist()], model)
        counts = [pa.array([sum(s[2] == kind for s in base) for base, _ in spans], pa.int64()) for kind in KINDS]
        sums = pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in spans], pa.string())
        return [ids, *counts, sums, pa.array([written(every) for _, every in spans], pa.string())]

    batches_of(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return map_rows(rows, f"doc_id long, {counts}, base_sha256 string, spans string", find, "doc_id", "text")


def masked(text: str, spans: list[Span]) -> str:
    """The text with a mark such as [EMAIL] for every span; spans that overlap share the mark of the first."""
    out, done = [], 0
    for a, b, kind in spans:
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def mask_personal_data(documents: DataFrame, model: Tagger | None = None) -> DataFrame:
    """``documents`` with personal data masked in ``text`` and ``n_chars``, where there is such a column, counted anew. Null texts stay null."""
    model = model or train()
    columns, types = documents.columns, documents.schema

    def mask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = b.column(columns.index("text")).to_pylist()
            spans = all_spans([t or "" for t in held], model)
            texts = [t if t is None else masked(t, every) for t, (_, every) in zip(held, spans, strict=True)]
            new = {"text": pa.array(texts, b.schema.field("text").type)}
            if "n_chars" in columns:
                kind = b.schema.field("n_chars").type
                old = b.column(columns.index("n_chars")).to_pylist()
                new["n_chars"] = pa.array([n if t is None else len(t) for t, n in zip(texts, old, strict=True)], kind)
            yield pa.RecordBatch.from_arrays([new.get(c, b.column(i)) for i, c in enumerate(columns)], schema=b.schema)

    batches_of(documents.sparkSession)
    return documents.mapInArrow(mask, types)
