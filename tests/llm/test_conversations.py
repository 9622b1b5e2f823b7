"""Repair and prefix tries of conversations against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemerge.llm import conversation_repair as cr
from tidemerge.llm import edit_lattice as lattice
from tidemerge.llm import prefix_trie
from tidemerge.llm.queries import ORACLE, QUERIES

# ------------------------------------------------------------------- lattice

VALID = re.compile(r"(s?(ua)+)?")


def every_way(rows, most):
    """All audits with at most ``most`` inserted turns, by brute force: (cost, audit)."""
    found = []

    def go(i, roles, cost, audit, inserted):
        if i == len(rows) and VALID.fullmatch(roles):
            found.append((cost, audit))
        if inserted < most:
            for r in "ua":
                go(i, roles + r, cost + 3, audit + "I", inserted + 1)
        if i < len(rows):
            initial, must_go, extra = rows[i]
            go(i + 1, roles, cost + 4, audit + "D", inserted)
            if not must_go:
                go(i + 1, roles + (initial or "?"), cost + extra, audit + "K", inserted)
                for r in "ua":
                    go(i + 1, roles + r, cost + extra + 3, audit + "R", inserted)

    go(0, "", 0, "", 0)
    return min(found)


def by_rows(rows):
    """The same by one table row after another, for longer conversations."""
    due = {0: 2, 1: 2, 2: 3, 3: 2}
    best = {0: (0, "")}

    def insert(best):
        for _ in range(4):
            for s, (c, a) in list(best.items()):
                best[due[s]] = min(best.get(due[s], (10**9, "")), (c + 3, a + "I"))
        return best

    insert(best)
    for initial, must_go, extra in rows:
        new = {}
        for s, (c, a) in best.items():
            steps = [(s, 4, "D")]
            if not must_go:
                steps.append((due[s], 3 + extra, "R"))
                steps += [(t, extra, "K") for r, f, t in (("s", 0, 1), ("u", 0, 2), ("u", 1, 2), ("u", 3, 2), ("a", 2, 3)) if (r, f) == (initial, s)]
            for t, more, letter in steps:
                new[t] = min(new.get(t, (10**9, "")), (c + more, a + letter))
        best = insert(new)
    return min(best[s] for s in (0, 3) if s in best)


row = st.tuples(st.sampled_from(["s", "u", "a", "t", "", " "]), st.booleans(), st.sampled_from([0, 3]))


@settings(max_examples=150, deadline=None)
@given(st.lists(row, max_size=4))
def test_cheapest_of_all_ways(rows):
    assert lattice.cheapest(rows) == every_way(rows, 3)


@settings(max_examples=300, deadline=None)
@given(st.lists(row, max_size=40), st.data())
def test_cheapest_and_chained(rows, data):
    want = by_rows(rows)
    assert lattice.cheapest(rows) == want
    chain, k = lattice.Chain(), 0
    while k < len(rows):
        n = data.draw(st.integers(1, 9))
        chain.add(lattice.table(rows[k : k + n]))
        k += n
    assert chain.best() == want


def test_long_parts(monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice("suaut"), rng.random() < 0.1, rng.choice([0, 0, 3])) for _ in range(700)]
    want = by_rows(rows)
    assert lattice.cheapest(rows) == want
    monkeypatch.setattr(lattice, "ROWS", 64)
    chain = lattice.Chain()
    chain.add(lattice.table(rows))
    assert chain.best() == want


# -------------------------------------------------------------------- repair


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def expected(convs, rows):
    """Rows of the contract, conversation by conversation; also the repaired turns."""
    out, turns = [], []
    for conv in convs:
        mine = [r[1:] for r in rows if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        numbers = {t for t, _, _ in mine if t is not None}
        faults, seen = [], set()
        for _, role, text in mine:
            core = text.strip(" \t\n\v\f\r")
            faults.append("b" if not core else "d" if (role, text) in seen else "t" if core[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit = by_rows([(i, f in ("b", "d"), 3 if f == "t" else 0) for i, f in zip(initials, faults, strict=True)])
        left, kept = iter(mine), []
        for letter in audit:
            _, role, text = next(left) if letter != "I" else (None, None, "")
            if letter != "D":
                kept.append((role if letter == "K" else "assistant" if kept and kept[-1][0][0] == "u" else "user", text))
        assert VALID.fullmatch("".join(r[0] for r, _ in kept))
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, sha))
        turns += [(conv, i, r, t) for i, (r, t) in enumerate(kept)]
    return sorted(out, key=str), sorted(turns, key=str)


def odd_conversations(seed, convs=30):
    """Few different texts, so turns repeat; nulls, ties, gaps and one conversation with a third of the rows."""
    rng = random.Random(seed)
    texts = ["One.", "Two?", "cut", "cut.  \n", "", " \t", None, "end .\x0b", "é!", "x ", "No. 5"]
    rows = []
    for conv in [*range(-5, convs), None]:
        for turn in range(rng.choice([0, 1, 4, 9, 400 if conv == 7 else 2])):
            number = rng.choice([turn, turn, turn, turn + rng.choice([0, 3]), None])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            rows.append((conv, number, role, rng.choice(texts) if rng.random() < 0.4 else f"Text {rng.randrange(200)}."))
    rng.shuffle(rows)
    return rows


CONVERSATIONS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("held", [10_000, 3])
def test_repairs(spark, monkeypatch, seed, held):
    monkeypatch.setattr(cr, "HELD_ROWS", held)
    rows = odd_conversations(seed)
    want, turns = expected({r[0] for r in rows}, damaged(rows))
    df = cr.damage(spark.createDataFrame(rows, CONVERSATIONS).repartition(3))
    assert sorted(map(tuple, cr.repairs(df).collect()), key=str) == want
    assert sorted(map(tuple, cr.repairs(df, texts=True).collect()), key=str) == turns


def test_repair_query(spark, small, monkeypatch):
    import oracle

    monkeypatch.setitem(oracle.ORACLE, "op11_conversation_repair", ORACLE["op11_conversation_repair"])
    assert oracle.difference(spark, oracle.connect(small), small, "op11_conversation_repair", QUERIES["op11_conversation_repair"](spark, small)) is None
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want, _ = expected({r[0] for r in rows}, damaged(rows))
    assert sorted(map(tuple, QUERIES["op11_conversation_repair"](spark, small).collect()), key=str) == want


def test_one_large_conversation(spark):
    """A conversation over many partitions equals the same one read in one piece."""
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"Said {rng.randrange(900)}.") for t in range(2500)] + [(c, 0, "user", "Alone.") for c in (0, 2)]
    df = spark.createDataFrame(rows, CONVERSATIONS)
    want, _ = expected({0, 1, 2}, rows)
    assert sorted(map(tuple, cr.repairs(df).collect()), key=str) == want


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], CONVERSATIONS)
    assert cr.repairs(cr.damage(df)).collect() == [] == cr.repairs(df, texts=True).collect()
    gone = spark.createDataFrame([(1, 2, None, None, 9), (1, 2, None, None, 9)], CONVERSATIONS + ", audit int")
    assert list(map(tuple, cr.repairs(gone).collect())) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# ---------------------------------------------------------------------- trie


def plain_trie(rows):
    """Nodes of the contract from a dictionary of prefixes."""
    given = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tid = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            given.setdefault(conv, []).append((turn is not None, turn or 0, tid, role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in given.items()}
    members, ends, words = {}, {}, {(): 0}
    for c in turns:
        shared = zlib.crc32(str(c).encode()) % 4
        leader = c - int(abs(c) % 20) * (1 if c >= 0 else -1)
        path = turns.get(leader, [])[:shared] + turns[c][shared:]
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
            words[tuple(path[:d])] = len(re.findall(r"[^\x20\x09-\x0D]+", path[d - 1][1])) if d else 0
        ends.setdefault(tuple(path), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
            saved[node[:d]] = saved.get(node[:d], 0) + (len(members[node]) - 1) * words[node]
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        ((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children.get(n, 0), leaves[n], saved[n], sha(ends.get(n, []))) for n, m in members.items()),
        key=str,
    )


def shared_openings(seed):
    """Conversations that share turns, one with a third of the rows, many equal ones, some that lose all turns."""
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", None, " d  e\tf", ""])) for c in range(-30, 70) for t in range(rng.choice([1, 2, 5]))]
    rows += [(c, t, "user", f"same {t}") for c in range(100, 160) for t in range(6)]
    rows += [(41, t, "user", f"long {t % 7}") for t in range(5, 250)]
    rows += [(c, None, "user", "late") for c in (3, 3, 60, None)] + [(5, 0, "user", "tie"), (5, 0, "assistant", "tie")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("limit", [0, 40, 10**6])
def test_trie(spark, seed, limit):
    rows = shared_openings(seed)
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(3)
    assert sorted(map(tuple, prefix_trie.prefix_trie(df, limit).collect()), key=str) == plain_trie(rows)


def test_trie_query(spark, small, monkeypatch):
    import oracle

    monkeypatch.setitem(oracle.ORACLE, "op13_prefix_trie", ORACLE["op13_prefix_trie"])
    assert oracle.difference(spark, oracle.connect(small), small, "op13_prefix_trie", QUERIES["op13_prefix_trie"](spark, small)) is None
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_prefix_trie"](spark, small).collect()), key=str) == plain_trie(rows)


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([], CONVERSATIONS + ", node int")
    assert prefix_trie.prefix_trie(df).collect() == []
    alone = spark.createDataFrame([(7, None, None, None, 1), (None, 1, "user", "x", 1)], CONVERSATIONS + ", node int")
    assert sorted(map(tuple, prefix_trie.prefix_trie(alone).collect()), key=str) == plain_trie([(7, None, None, None)])
