"""Conversation structure: what is wrong with the turns, and the cheapest edits that mend it.

Rows are sorted over range partitions by conversation and turn, so one conversation
may hold any share of them. Conversations that lie within one partition and are not
large are judged and edited there, in one pass. The others, at most two a partition
beside the large ones, are left open and go on as rows:

* the first of equal turns is the least place of a digest, an aggregation, and comes
  back by a join on the place, which is unique;
* each partition chains the edits of its rows into one small table (``edit_lattice``),
  and a conversation's tables, one a partition, are chained in order;
* its text is written out, or hashed, in one streaming pass over its sorted rows: a
  SHA-256 can only be computed from front to back. That pass holds one batch of rows
  and the audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.llm import edit_lattice
from tidemerge.llm.common import keep
from tidemerge.llm.sorted_rows import Batches, arrow_schema, in_order, rows_of

#: A conversation of more rows or characters is not held in a worker, it is left open.
HELD_ROWS = 10_000
HELD_CHARACTERS = 8_000_000

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL = {"su", "ua", "au"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
SUMMARY = [*COUNTS, "audit"]
#: Blanks as the operator sees them: space, tab to carriage return.
HAS_TEXT = r"[^\x20\x09-\x0D]"
ENDS_WELL = r"[.!?][\x20\x09-\x0D]*\z"


def damage(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with planted damage, decided by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row (role and text become null, so its conversation stays known), 1 empties
    the text, 2 removes its ``.!?``, 3 repeats the row, 4 makes its role ``user``. Nulls count
    as one space, but a null turn stays null.
    """
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("kind"),
    )
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn",
        F.when(kind != 0, F.when(kind == 4, "user").otherwise(F.col("role"))).alias("role"),
        F.when(kind != 0, text).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


class Facts:
    """What is counted over sorted rows, so that two neighbouring runs add up."""

    def __init__(self) -> None:
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None  # initials

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        self.join(turn, turn, int(turn is not None), fault == BLANK, fault == DUPLICATE, fault == TRUNCATED, 0, initial, initial)

    def join(self, low, high, turns, blank, duplicate, truncated, illegal, first, last) -> None:
        if turns:
            self.turns += turns - (self.high == low)
            self.low = low if self.low is None else self.low
            self.high = high
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.illegal += illegal + (self.last is not None and self.last + first not in LEGAL)
        self.first = first if self.first is None else self.first
        self.last = last

    def state(self) -> tuple:
        return self.low, self.high, self.turns, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last

    def counts(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


def editable(initial: str, fault: int) -> edit_lattice.Row:
    return initial, fault in (BLANK, DUPLICATE), edit_lattice.TRUNCATED if fault == TRUNCATED else 0


def hashed(turns: Iterable[tuple[str, str]]) -> str:
    """SHA-256 of the turns as lines ``role:text``."""
    sha, mark = hashlib.sha256(), b""
    for role, text in turns:
        sha.update(mark + f"{role}:{text}".encode())
        mark = b"\n"
    return sha.hexdigest()


def judged(rows: list[tuple]) -> tuple:
    """The summary of a whole conversation from its rows (turn, role, text, fault)."""
    facts, seen, lattice = Facts(), set(), []
    for turn, role, text, fault in rows:
        if fault != BLANK and (role, text) in seen:
            fault = DUPLICATE
        seen.add((role, text))
        facts.add(turn, role[:1], fault)
        lattice.append(editable(role[:1], fault))
    if len(lattice) <= edit_lattice.ROWS:
        cost, audit = edit_lattice.cheapest(lattice)
    else:
        way = edit_lattice.Chain()
        for k in range(0, len(lattice), edit_lattice.ROWS):
            way.add(edit_lattice.table(lattice[k : k + edit_lattice.ROWS]))
        cost, audit = way.best()
    return (*facts.counts(), cost, audit)


def output(conv, summary: tuple, turns: Iterator[tuple[str, str]], texts: bool) -> Iterator[tuple[tuple, int]]:
    """Rows of the result: the conversation's edited turns, or its summary."""
    edited = edit_lattice.repaired(summary[-1], turns)
    if texts:
        for place, (role, text) in enumerate(edited):
            yield (conv, None, place, role, text, None, *[None] * len(SUMMARY), None), len(text)
    else:
        yield (conv, None, None, None, None, None, *summary, hashed(edited)), 0


def _judge(schema: pa.Schema, texts: bool):
    """Whole conversations are finished; rows of those that may go on in another partition, or are large, pass through."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(schema)

        def leave_open(conv, rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
            for _, pos, turn, role, text, fault in rows:
                yield from out.add((conv, pos, turn, role, text, fault, *[None] * len(SUMMARY), None), len(text or ""))

        held, conv = None, None  # the first conversation is not held
        for n, (conv, rows) in enumerate(groupby(rows_of(batches), key=lambda r: r[0])):
            if held:
                yield from _finish(out, held, texts)
            if not n:
                yield from leave_open(conv, rows)
                continue
            held, size = [], 0
            for row in rows:
                held.append(row)
                size += len(row[4] or "")
                if len(held) > HELD_ROWS or size > HELD_CHARACTERS:
                    yield from leave_open(conv, chain(held, rows))
                    held = None
                    break
        if held:
            yield from leave_open(conv, held)
        yield from out.rest()

    return run


def _finish(out: Batches, rows: list[tuple], texts: bool) -> Iterator[pa.RecordBatch]:
    turns = [r[2:] for r in rows if r[3] is not None]
    summary = judged(turns) if turns else (0, 0, 0, 0, 0, 0, "")
    for row, size in output(rows[0][0], summary, iter([t[1:3] for t in turns]), texts):
        yield from out.add(row, size)


PIECE = "low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string"


def _pieces(schema: pa.Schema):
    """Sorted rows (conv_id, pos, turn, initial, fault) of open conversations: one row for each run of them, with the table of its edits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(schema)
        for conv, rows in groupby(rows_of(batches), key=lambda r: r[0]):
            facts, lattice, start = Facts(), [], None
            for _, pos, turn, initial, fault in rows:
                start = pos if start is None else start
                facts.add(turn, initial, fault)
                lattice.append(editable(initial, fault))
            found = [w for ways in edit_lattice.table(lattice) for w in ways]
            size = sum(len(w[1]) for w in found if w)
            yield from out.add((conv, start, *facts.state(), [w and w[0] for w in found], [w and w[1] for w in found]), size)
        yield from out.rest()

    return run


def _chain(schema: pa.Schema):
    """Pieces of a conversation in order: its summary, as a row that sorts before its turns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(schema)
        for conv, pieces in groupby(rows_of(batches), key=lambda r: r[0]):
            facts, way = Facts(), edit_lattice.Chain()
            for _, _, *state, costs, audits in pieces:
                facts.join(*state)
                found = [None if c is None else (c, a) for c, a in zip(costs, audits, strict=True)]
                way.add([found[s : s + 4] for s in range(0, 16, 4)])
            cost, audit = way.best()
            yield from out.add((conv, -1, None, None, None, None, *facts.counts(), cost, audit, None), len(audit))
        yield from out.rest()

    return run


def _apply(schema: pa.Schema, texts: bool):
    """The summary row of each open conversation, then its turns in order: the result's rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(schema)
        for conv, rows in groupby(rows_of(batches), key=lambda r: r[0]):
            head = next(rows)
            summary = head[6 : 6 + len(SUMMARY)] if head[1] == -1 else (0, 0, 0, 0, 0, 0, "")
            for row, size in output(conv, summary, ((r[3], r[4]) for r in rows if r[3] is not None), texts):
                yield from out.add(row, size)
        yield from out.rest()

    return run


def repairs(turns: DataFrame, texts: bool = False) -> DataFrame:
    """What is wrong with each conversation of ``turns`` (conv_id, turn, role, text), and its cheapest repair.

    Returns a row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256; with ``texts`` the repaired turns: conv_id, place, role, text.

    Rows are read by turn, null first, ties by role and text. A row without role stands for
    one that was taken away: it only makes its conversation known. A conversation without
    other rows gets zeros, an empty audit and the hash of an empty text, and no repaired turns.
    Rows without conv_id are one conversation of that name. Repeated rows are duplicates. A
    null text is empty. An empty table gives an empty one. Other columns are ignored.
    """
    given = F.col("role").isNotNull()
    text = F.when(given, F.coalesce("text", F.lit("")))
    fault = F.when(~F.col("text").rlike(HAS_TEXT), BLANK).when(~F.col("text").rlike(ENDS_WELL), TRUNCATED).otherwise(SOUND)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", text.alias("text"), F.monotonically_increasing_id().alias("tie"))
    rows = in_order(rows, "conv_id", "turn", "role", "text", "tie")
    rows = rows.select("conv_id", "pos", "turn", "role", "text", F.when(given, fault).cast("int").alias("fault"))
    key = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}"
    schema = f"{key}, pos long, turn long, role string, text string, fault int, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"
    arrow = arrow_schema(schema)
    passed = keep(rows.mapInArrow(_judge(arrow, texts), schema))

    opened = passed.where("pos IS NOT NULL")
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    facts = opened.where("role IS NOT NULL").select("conv_id", "pos", "turn", F.substring("role", 1, 1).alias("initial"), "fault", digest.alias("digest"))
    fresh = facts.groupBy("conv_id", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("fresh"))
    again = F.col("fresh").isNull() & (F.col("fault") != BLANK)
    facts = facts.join(fresh, "pos", "left").select("conv_id", "pos", "turn", "initial", F.when(again, DUPLICATE).otherwise(F.col("fault")).alias("fault"))
    facts = facts.repartitionByRange("pos").sortWithinPartitions("pos")
    piece = f"{key}, pos long, {PIECE}, costs array<long>, audits array<string>"
    pieces = facts.mapInArrow(_pieces(arrow_schema(piece)), piece)
    heads = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(_chain(arrow), schema)
    rest = heads.unionByName(opened).repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(_apply(arrow, texts), schema)

    found = passed.where("pos IS NULL").unionByName(rest)
    if texts:
        return found.select("conv_id", F.col("turn").alias("place"), "role", "text")
    return found.select("conv_id", *SUMMARY, "repaired_sha256")
