"""Token counts of texts, run by run and chunk by chunk, against whole encodings."""

import json
from pathlib import Path

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemerge.llm import token_counts
from tidemerge.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", " ", "  ", "\n", "'", "'s", "'re", "1", "22", ".", "!", "é", "日", "😀", "<|endoftext|>", "<|endof", "text|>", "the ", "  \n ", "\t", "\x1c", "　"]


def whole(text):
    return len(token_counts.tokens_of(PATH).encoded([text])[0])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), min_size=1, max_size=300).map("".join), st.sampled_from([1, 3, 10, 50]), st.sampled_from([1, 4, 16, 40]))
def test_splices_are_right(text, chunk, overlap):
    assert token_counts.spliced_count(token_counts.tokens_of(PATH), text, chunk, overlap) == whole(text)


@pytest.mark.parametrize("text", ["a" * 9000, " " * 9000, "x " * 4500, "\n" * 100 + "a" * 4000 + " b" * 3000, "<|endoftext|>" * 700], ids=["word", "blank", "pairs", "long word", "special"])
def test_overlaps_widen(text):
    """Words and runs of blanks far longer than the overlap."""
    tokens = token_counts.tokens_of(PATH)
    assert token_counts.spliced_count(tokens, text, 1000, 20) == whole(text)
    assert token_counts.count_tokens(tokens, [text, "", text], 1000, 20) == [whole(text), 0, whole(text)]


def test_query_counts_every_row(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    want = sorted((d["doc_id"], len((d["text"] or "").encode()), whole(d["text"] or "")) for d in docs)
    got = sorted(map(tuple, QUERIES["op12_token_counts"](spark, small).collect()))
    assert got == [(i, b, n, n > 512) for i, b, n in want]


def test_odd_rows(spark):
    rows = [(1, None, "x"), (1, "", "y"), (None, "two words", None), (1, "two words", "z"), (1, "two words", "z"), (2, "é " * 60_000, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = token_counts.token_counts(df, PATH).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, len((t or "").encode()), whole(t or ""), whole(t or "") > 512) for i, t, _ in rows), key=str)
    assert token_counts.token_counts(df.limit(0), PATH).collect() == []
    named = spark.createDataFrame([("a", "two words")], "doc_id string, text string")
    assert token_counts.token_counts(named, PATH).first() == ("a", 9, whole("two words"), False)


@pytest.mark.parametrize("file", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_files_without_proof_are_read_whole(file):
    tokens = token_counts.tokens_of(public_tokenizers.path(file))
    text = "Some  Ünproven words. " * 300
    assert not tokens.stable
    assert token_counts.count_tokens(tokens, [text, ""], 100, 10) == [tokens.counts([text])[0], 0]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=100).map("".join), min_size=1, max_size=4), st.sampled_from([1, 10, 50, 1000]))
def test_counts_by_run_are_right(texts, chunk):
    """Four of each text, so that most of their runs recur."""
    assert token_counts.count_tokens(token_counts.tokens_of(PATH), texts * 4, chunk, 10) == [whole(t) for t in texts] * 4


def test_runs_start_where_the_library_cuts():
    """Before every character up to the ideographic space, white space or not."""
    texts = [f"a  {c}b\n {c}{c}\t\t<|endoftext|>  {c}'s" for c in map(chr, range(0x3001))]
    tokens = token_counts.Tokens(PATH)
    assert tokens.starts is not None
    assert token_counts.count_tokens(tokens, [*texts, *texts]) == [len(e) for e in tokens.encoded(texts)] * 2
    assert tokens.known


def test_runs_that_recur_are_encoded_once(monkeypatch):
    tokens = token_counts.Tokens(PATH)
    given_texts, counts = [], tokens.counts
    monkeypatch.setattr(tokens, "counts", lambda texts: given_texts.extend(texts) or counts(texts))
    text = "The same few words,\nagain and again. " * 5000
    assert token_counts.count_tokens(tokens, [text, text, text[:999]]) == [whole(text), whole(text), whole(text[:999])]
    assert sum(map(len, given_texts)) < 200


def test_kept_counts_are_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "KNOWN", 100)
    tokens = token_counts.Tokens(PATH)
    for k in range(30):
        text = "".join(f" w{k}x{i}" for i in range(40)) * 3 + " " + "long" * 50
        assert token_counts.count_tokens(tokens, [text]) == [whole(text)]
        assert 0 < len(tokens.known) <= 140 and max(map(len, tokens.known)) <= token_counts.LONGEST
    monkeypatch.setattr(token_counts, "KNOWN", 1000)
    known = dict(tokens.known)
    new = "".join(f" n{i}" for i in range(1000))
    assert token_counts.count_tokens(tokens, [new]) == [whole(new)]
    assert tokens.known == known  # most runs are new: nothing is gained by keeping them


@pytest.mark.parametrize("content", ["two words", "\n\n", " x"])
def test_added_tokens_of_white_space(tmp_path, content):
    """Texts are cut at no run where an added token may hold the cut."""
    made = json.loads(Path(PATH).read_text(encoding="utf-8"))
    made["added_tokens"].append({**made["added_tokens"][0], "id": 50257, "content": content})
    file = tmp_path / "made.json"
    file.write_text(json.dumps(made), encoding="utf-8")
    tokens = token_counts.Tokens(str(file))
    text = f"some two words x\n\ny {content}{content} z" * 50
    assert tokens.stable and tokens.starts is None
    assert token_counts.count_tokens(tokens, [text] * 4, 100, 10) == [len(tokens.encoded([text])[0])] * 4
