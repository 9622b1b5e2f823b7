"""Token counts of whole texts by the vocabulary of a public tokenizer.

A text of many chunks is never encoded in one piece. Its chunks overlap, each is
encoded alone with offsets, and neighbours are spliced at a boundary that both
show inside their overlap and that is proven stable:

* The byte-level pattern cuts words from left to right and never looks behind, so
  from a true word start on, a scan of a chunk is the scan of the text. It looks
  ahead by two characters at most. Merges never cross a word.
* An added token is found before words are cut. No occurrence can hold a boundary
  that lies further from the end of the left chunk and from the start of the right
  one than the longest added token is long.

So a word start that the left chunk shows further than ``margin`` before its end is
true (its own scan started at a true one), and the right chunk, starting a word
there too, goes on like the text. Where an overlap holds none, as within one word
longer than it, both chunks are encoded again with twice the overlap.

Most word starts need no encoding to be seen: a space, tab or line end before a
character that is none and that begins no added token starts a word, alone or with
that character, as a run of white space leaves its last character to what follows. Cut
there, a text's tokens are those of its runs, each encoded alone. A run that recurs is
encoded once and its count kept; where most runs are new, their texts are encoded. Only
what holds no such start for longer than a chunk and its overlap is spliced.

The proof needs a ``tokenizers`` file without normalizer whose words the byte-level
pattern cuts, and no white space in its added tokens for the latter. Texts for other
files (``.json``, or ``.model`` for ``sentencepiece``) are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a chunk, and those it shares at first with the next.
CHUNK = 1 << 16
OVERLAP = 1 << 10
#: Characters encoded in one call: an encoding takes some hundred bytes a token.
AT_ONCE = 1 << 20
#: Runs whose counts a worker keeps, some hundred bytes each, before it starts afresh, and the characters of the longest kept.
KNOWN = 1 << 18
LONGEST = 64


class Tokens:
    """A ``tokenizers`` file: counts without truncation, padding or tokens put around the text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        added = [a for a in made.get("added_tokens") or []]
        cutter = made.get("pre_tokenizer") or {}
        self.stable = (
            made.get("normalizer") is None
            and cutter.get("type") == "ByteLevel"
            and cutter.get("use_regex", True)
            and not cutter.get("add_prefix_space", False)
            and not any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added)
        )
        self.margin = 2 + max([len(a["content"]) for a in added], default=0)
        first = "".join(sorted({re.escape(a["content"][:1]) for a in added}))
        #: Where a run starts. White space as ``re`` has it includes all that the byte-level pattern has.
        self.starts = re.compile(rf"(?=[ \t\r\n][^\s{first}])") if self.stable and not any(re.search(r"\s", a["content"]) for a in added) else None
        self.known: dict[str, int] = {}

    def encoded(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def parts(self, text: str, chunk: int) -> Iterator[str]:
        """``text`` in order, cut at the first start of a run after each ``chunk`` characters."""
        start = 0
        while start < len(text):
            found = self.starts.search(text, start + chunk) if self.starts else None
            end = found.start() if found else len(text)
            yield text[start:end]
            start = end

    def counts_by_run(self, texts: list[str]) -> list[int]:
        """``counts(texts)``, of each run that is not known once."""
        if self.starts is None:
            return self.counts(texts)
        if len(self.known) > KNOWN:
            self.known.clear()
        runs = [self.starts.split(text) for text in texts]
        new = [run for run in set(chain.from_iterable(runs)) if run not in self.known]
        if 2 * len(new) > sum(map(len, runs)):
            return self.counts(texts)  # an encoding alone takes up to twice the time
        self.known.update(zip(new, self.counts(new), strict=True))
        counts = [sum(map(self.known.__getitem__, r)) for r in runs]
        for run in new:
            if len(run) > LONGEST:
                del self.known[run]
        return counts


class Pieces:
    """A ``sentencepiece`` file."""

    stable = False

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    counts_by_run = counts

    def parts(self, text: str, chunk: int) -> Iterator[str]:
        if text:
            yield text


@lru_cache(maxsize=4)
def tokens_of(path: str) -> Tokens | Pieces:
    """The file's tokenizer, loaded once in a worker."""
    return Pieces(path) if path.endswith(".model") else Tokens(path)


class Chunk:
    """``text[start:end]`` encoded alone."""

    def __init__(self, tokens: Tokens, text: str, start: int, end: int, encoding=None) -> None:
        self.start, self.end = start, min(end, len(text))
        self.encoding = tokens.encoded([text[self.start : self.end]])[0] if encoding is None else encoding

    def word_starts(self, low: int, high: int) -> dict[int, int]:
        """Places in ``low <= place <= high`` of the text where a word starts, with the number of tokens before."""
        offsets, words = self.encoding.offsets, self.encoding.word_ids
        found = {}
        for i in range(len(offsets) - 1, -1, -1):
            place = self.start + offsets[i][0]
            if place < low:
                break
            if place <= high and (i == 0 or words[i] != words[i - 1]):
                found[place] = i
        return found


def chunks(tokens: Tokens, text: str, chunk: int, overlap: int) -> Iterator[Chunk]:
    """All chunks of the text in order, a bounded number of characters encoded in one call."""
    spans = [(s, min(s + chunk + overlap, len(text))) for s in range(0, len(text), chunk)]
    few = max(1, AT_ONCE // (chunk + overlap))
    for k in range(0, len(spans), few):
        part = spans[k : k + few]
        for (s, e), encoding in zip(part, tokens.encoded([text[s:e] for s, e in part]), strict=True):
            yield Chunk(tokens, text, s, e, encoding)


def spliced_count(tokens: Tokens, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The tokens of ``text``, from overlapping chunks."""
    total, left, place = 0, None, 0  # ``left`` is right from ``place`` on
    index = 0  # tokens of ``left`` before ``place``
    for right in chunks(tokens, text, chunk, overlap):
        if left is None:
            left = right
        elif left.end < len(text):
            wider = overlap
            while True:
                low, high = max(place, right.start + tokens.margin), min(left.end, right.end) - tokens.margin
                before = left.word_starts(low, high)
                shared = before.keys() & right.word_starts(low, high).keys() if before else ()
                if shared:
                    cut = min(shared)
                    total += before[cut] - index
                    index = right.word_starts(cut, cut)[cut]
                    left, place = right, cut
                    break
                wider *= 2
                end = max(left.end, right.end, right.start) + wider
                left = Chunk(tokens, text, left.start, end)
                if left.end == len(text):
                    break
                right = Chunk(tokens, text, right.start, end)
        if left.end == len(text):
            break
    return total + (len(left.encoding) - index if left else 0)


def count_tokens(tokens: Tokens | Pieces, texts: list[str], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """The tokens of each text: long ones part by part, short parts several in one call."""
    counts = [0] * len(texts)
    held, size = [], 0
    for i, text in enumerate(texts):
        for part in tokens.parts(text, chunk):
            if tokens.stable and len(part) > chunk + overlap:
                counts[i] += spliced_count(tokens, part, chunk, overlap)
                continue
            if held and size + len(part) > AT_ONCE:
                _add_counts(counts, tokens, held)
                held, size = [], 0
            held.append((i, part))
            size += len(part)
    _add_counts(counts, tokens, held)
    return counts


def _add_counts(counts: list[int], tokens: Tokens | Pieces, held: list[tuple[int, str]]) -> None:
    for (i, _), n in zip(held, tokens.counts_by_run([part for _, part in held]) if held else (), strict=True):
        counts[i] += n


def token_counter(path: str, chunk: int, overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path)
        for batch in batches:
            counts = count_tokens(tokens, [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()], chunk, overlap)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts, pa.int64())], [*batch.schema.names[:-1], "n_tokens"]
            )

    return run


def token_counts(docs: DataFrame, path: str, limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text).

    ``path`` names the tokenizer's file, at the same place on every executor. Special
    strings inside a text are tokens or not as the library's default has it. Nothing is
    put around a text, cut off or padded.

    Every row is counted by itself, so rows that repeat, tie or have no id all stay. A null
    text counts as empty: 0 bytes, 0 tokens. An empty table gives an empty one. Other
    columns, of whatever name, are ignored.
    """
    ids = docs.schema["doc_id"].dataType.simpleString()
    text = docs.select(F.col("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.col("text"))
    counted = text.mapInArrow(token_counter(path, chunk, overlap), f"doc_id {ids}, n_bytes long, n_tokens long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
