"""Prefix trie of conversations, as a burst trie.

A node is a prefix of a conversation's turns, named by a hash that grows turn by
turn. Under the trie heads lie containers, each with the suffixes of the
conversations that pass its head. A container of more than ``LIMIT`` turns bursts by
next turn id: its head becomes a node of the upper trie and its suffixes move one turn
on into the containers of its children. The sizes of all containers that may arise
are known from one aggregation by prefix, so all bursts are decided at once and not
level by level. The containers that remain are dealt over shards, their suffixes are
sorted there and swept into nodes with one stack.

The upper trie is never held in one place. What a head counts is a sum over the rows
that pass it. For what its subtree counts, each container and each head gives its
share to the conversation of smallest id below it; a sum from the end of each
conversation's heads to each head, added up by head, then is the sum over the subtree.

Conversations lie sorted over range partitions and scans carry on from one into the
next (``sorted_rows``), so neither a conversation nor a first turn that holds a third
of all rows meets in one task. A digest of very many ids streams through one, as a
SHA-256 can only be computed from front to back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.llm.common import keep
from tidemerge.llm.sorted_rows import Batches, Carried, arrow_schema, carried, rows_of, sorted_rows
from tidemerge.operators.spread import spread_join

#: Turns below the head of a container.
LIMIT = 2_000
WORDS = r"[^\x20\x09-\x0D]+"
#: Prefixes are polynomials of their turn ids at POINT, modulo a prime: what two runs of turns give can be joined.
PRIME = 2**127 - 1
POINT = int.from_bytes(hashlib.sha256(b"prefixes of conversations").digest()[:15], "big")
ROOT = bytes(16)


def turn_id(role: str | Column = "role", text: str | Column = "text") -> Column:
    """16 bytes of the SHA-256 of the role's length, role and text."""
    role, text = (F.col(c) if isinstance(c, str) else c for c in (role, text))
    return F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32))


# ------------------------------------------------------------ rebuilt turns


def _count(rows: Iterator[tuple]) -> list[int]:
    return [sum(1 for _ in rows)]


def _plus(a: list[int], b: list[int]) -> list[int]:
    return [x + y for x, y in zip(a, b, strict=True)]


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, i, tid, words) of turns (conv_id, turn, tid, words): ``i`` from 1 by turn, null first, ties by turn id."""
    rows = sorted_rows(turns.withColumn("tie", F.monotonically_increasing_id()), "conv_id", "turn", "tid", "tie").select("conv_id", "tid", "words", "pos")
    before = carried(rows, ["conv_id"], _count, _plus)
    schema = "conv_id long, i long, tid binary, words long"
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, first = Batches(arrow), True
        for conv, group in groupby(rows_of(batches), key=lambda r: r[0]):
            i = None
            for _, tid, words, pos in group:
                if i is None:
                    i = before.into.get(pos >> 33, [0])[0] if first else 0
                i += 1
                yield from out.add((conv, i, tid, words))
            first = False
        yield from out.rest()

    return rows.mapInArrow(run, schema)


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """(conv_id, seq, tid, words): each conversation opens with the first turns of the one that leads its ``every`` ids.

    So many turns, crc32 of the id modulo ``most``, are taken from the leader (all if it has
    fewer, none if it is not there) in place of its own first. ``seq`` orders them; 0 is a row
    without turn, so a conversation that is left without turns stays known.
    """
    given = numbered(turns)
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = turns.select("conv_id").distinct().withColumn("leader", F.col("conv_id") - F.col("conv_id") % every)
    opening = given.where((F.col("i") < most) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "leader")
    opening = convs.join(opening, "leader").where(F.col("i") <= shared)
    own = given.where(F.col("i") > shared)
    return (
        convs.select("conv_id", F.lit(0).cast("long").alias("seq"), F.lit(None).cast("binary").alias("tid"), F.lit(0).cast("long").alias("words"))
        .unionByName(opening.select("conv_id", F.col("i").alias("seq"), "tid", "words"))
        .unionByName(own.select("conv_id", (F.col("i") + most).alias("seq"), "tid", "words"))
    )


# ----------------------------------------------------------------- prefixes


def _step(value: int, tid: bytes | None) -> int:
    return (value * POINT + (int.from_bytes(tid, "big") + 1 if tid else 0)) % PRIME


def _prefix(rows: Iterator[tuple]) -> list[int]:
    """Rows and polynomial of a run (conv_id, tid, pos)."""
    n = value = 0
    for row in rows:
        n, value = n + 1, _step(value, row[1])
    return [n, value]


def _prefix_plus(a: list[int], b: list[int]) -> list[int]:
    return [a[0] + b[0], (a[1] * pow(POINT, b[0], PRIME) + b[1]) % PRIME]


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, words, left) of turns (conv_id, seq, tid, words).

    A row for each prefix of each conversation, from the one without turns; ``left`` counts
    the conversation's rows from this one on.
    """
    rows = sorted_rows(turns, "conv_id", "seq").select("conv_id", "tid", "words", "pos")
    before: Carried = carried(rows, ["conv_id", "tid"], _prefix, _prefix_plus)
    schema = "conv_id long, depth long, node binary, parent binary, words long, left long"
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, first = Batches(arrow), True
        for conv, group in groupby(rows_of(batches), key=lambda r: r[0]):
            known = before.total.get(str(conv))
            if known is None:  # it lies within this partition
                group = list(group)
            size = known[0] if known else len(group)
            n, value, parent = None, 0, None
            for _, tid, words, pos in group:
                if n is None:
                    n, value = before.into.get(pos >> 33, (0, 0)) if first else (0, 0)
                    parent = value.to_bytes(16, "big") if n else None
                value = _step(value, tid)
                node = value.to_bytes(16, "big")
                yield from out.add((conv, n, node, parent, words, size - n))
                n, parent = n + 1, node
            first = False
        yield from out.rest()

    return rows.mapInArrow(run, schema)


# --------------------------------------------------------------- containers


def digest_of(ids: Iterable[int]) -> str:
    """SHA-256 of the ids as decimals, joined by commas."""
    sha, mark = hashlib.sha256(), ""
    for x in ids:
        sha.update(f"{mark}{x}".encode())
        mark = ","
    return sha.hexdigest()


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


class Node:
    """A node on the stack, until all below it is known."""

    def __init__(self, depth: int, name: bytes, words: int) -> None:
        self.depth, self.name, self.words = depth, name, words
        self.least, self.n, self.leaves, self.saved = None, 0, 0, 0
        self.ends: list[int] = []
        self.children: list[list] = []

    def member(self, conv: int, n: int) -> None:
        self.least = conv if self.least is None else min(self.least, conv)
        self.n += n

    def close(self, above: Node | None) -> list:
        """The node's row; its own parent is filled in when that is closed."""
        for child in self.children:
            child[2] = self.least
        leaves = self.leaves or 1
        saved = self.saved + (self.n - 1) * self.words
        row = [self.least, self.depth, None, self.n, len(self.children), leaves, saved, digest_of(sorted(self.ends))]
        if above:
            above.member(self.least, self.n)
            above.leaves += leaves
            above.saved += saved
            above.children.append(row)
        return row


def sweep(suffixes: list[tuple]) -> list[list]:
    """Nodes of a container from its suffixes (conv_id, [(depth, node, words)]), the head's child first."""
    stack: list[Node] = []
    closed = []

    def cut(size: int) -> None:
        while len(stack) > size:
            closed.append(stack.pop().close(stack[-1] if stack else None))

    for conv, path in sorted(suffixes, key=lambda s: ([p[1] for p in s[1]], s[0])):
        shared = 0
        while shared < min(len(stack), len(path)) and stack[shared].name == path[shared][1]:
            shared += 1
        cut(shared)
        stack.extend(Node(depth, name, words) for depth, name, words in path[shared:])
        stack[-1].ends.append(conv)
        stack[-1].member(conv, 1)
    cut(0)
    return closed


def swept(suffixes: DataFrame) -> DataFrame:
    """Nodes of all containers from suffixes (top, head, conv_id, path); a container's top names the head above."""
    schema = f"{NODE}, head binary"
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(arrow)
        for _, rows in groupby(rows_of(batches), key=lambda r: r[0]):
            held, head = [], None
            for _, head, conv, path in rows:
                held.append((conv, [(p["depth"], p["node"], p["words"]) for p in path]))
            nodes = sweep(held)
            for row in nodes:
                yield from out.add((*row, head if row is nodes[-1] else None))
        yield from out.rest()

    return suffixes.repartition("top").sortWithinPartitions("top").mapInArrow(run, schema)


# -------------------------------------------------------------- upper trie


def _sums(rows: Iterator[tuple]) -> list[int]:
    leaves = saved = 0
    for row in rows:
        leaves, saved = leaves + row[1], saved + row[2]
    return [leaves, saved]


def _from_the_end(rows: DataFrame) -> DataFrame:
    """(node, leaves, saved): sums over rows (conv_id, depth, node, leaves, saved) of a conversation from its end to each of them."""
    rows = sorted_rows(rows, F.col("conv_id"), F.desc("depth")).select("conv_id", "leaves", "saved", "node", "pos")
    before = carried(rows, ["conv_id", "leaves", "saved"], _sums, _plus)
    schema = "node binary, leaves long, saved long"
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, first = Batches(arrow), True
        for _, group in groupby(rows_of(batches), key=lambda r: r[0]):
            sums = None
            for _, leaves, saved, node, pos in group:
                if sums is None:
                    sums = before.into.get(pos >> 33, (0, 0)) if first else (0, 0)
                sums = (sums[0] + leaves, sums[1] + saved)
                yield from out.add((node, *sums))
            first = False
        yield from out.rest()

    return rows.mapInArrow(run, schema)


def _digests(rows: DataFrame) -> DataFrame:
    """A digest for each node of rows (node, conv_id). Sorted ids stream through, none are held."""
    schema = "node binary, ends_sha256 string"
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(arrow)
        for node, group in groupby(rows_of(batches), key=lambda r: r[0]):
            yield from out.add((node, digest_of(r[1] for r in group)))
        yield from out.rest()

    return rows.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(run, schema)


def prefix_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie of rebuilt ``conversations`` (conv_id, turn, role, text).

    conv_id (smallest member), depth, parent_conv_id (root: null), n_convs, n_children,
    n_leaves and saved_tokens (over the subtree), ends_sha256.

    Turns are read by turn, null first; turns that tie go by their turn id, repeated rows are
    turns of their own. A null role or text is empty. Rows without conv_id belong to no
    conversation and are left out. An empty table has no conversation and gives no root.
    Other columns are ignored.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = rows.select("conv_id", "turn", turn_id().alias("tid"), F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"))
    paths = keep(prefixes(rebuilt(turns)))

    sizes = paths.groupBy("node").agg(F.sum("left").alias("size"))
    heads = sizes.where((F.col("size") > limit) | (F.col("node") == F.lit(ROOT))).select("node", F.lit(True).alias("head"))
    paths = keep(spread_join(paths, heads, ["node"]))
    upper, lower = paths.where("head"), paths.where("head IS NULL").drop("head")

    suffixes = lower.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("depth", "node", "words", "parent"))).alias("path"))
    suffixes = suffixes.select(F.col("path")[0]["node"].alias("top"), F.col("path")[0]["parent"].alias("head"), "conv_id", F.expr("transform(path, p -> struct(p.depth, p.node, p.words))").alias("path"))
    contained = keep(swept(suffixes))
    tops = contained.where("head IS NOT NULL")

    named = upper.groupBy("node").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), F.max("depth").alias("depth"), F.max("parent").alias("parent"))
    children = named.where("parent IS NOT NULL").select(F.col("parent").alias("node")).unionByName(tops.select(F.col("head").alias("node")))
    children = children.groupBy("node").agg(F.count("*").alias("n_children"))
    named = keep(named.join(children, "node", "left").fillna(0, ["n_children"]))

    own = named.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    below = tops.select("conv_id", (F.col("depth") - 1).alias("depth"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    shares = own.unionByName(below).groupBy("conv_id", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    shared = upper.select("conv_id", "depth", "node").join(shares, ["conv_id", "depth"], "left").fillna(0, ["leaves", "saved"])
    sums = _from_the_end(shared).groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    ends = _digests(upper.where("left = 1").select("node", "conv_id"))
    above = named.select(F.col("node").alias("head"), F.col("conv_id").alias("above"))
    whole = named.join(sums, "node").join(ends, "node", "left").fillna(hashlib.sha256().hexdigest(), ["ends_sha256"])
    whole = whole.join(above, F.col("parent") == F.col("head"), "left").withColumn("parent_conv_id", F.col("above"))
    below_heads = spread_join(tops, above, ["head"]).withColumn("parent_conv_id", F.col("above"))
    columns = [part.split()[0] for part in NODE.split(", ")]
    return whole.select(*columns).unionByName(below_heads.select(*columns)).unionByName(contained.where("head IS NULL").select(*columns))
