"""Cheapest edits that bring the roles of a conversation into order, by bidirectional Dijkstra.

A node of the lattice is (rows read, state): the state tells what the edited roles
so far end in, so that a whole conversation reads ``(s?(ua)+)?`` by role initials.
Edges are the edits: Keep, Rerole and Delete read a row, Insert adds one. A forward
heap starts at the first row, a reverse heap at the ends that are allowed. They go
on while their tops together do not exceed the cheapest crossing, so every crossing
of that cost is finished, and the least audit of prefix and suffix is picked.

Each node keeps the least of its cheapest audits. That suffices: two cheapest audits
of one node read the same rows, and a further Insert costs, so neither is the start
of the other and what is appended does not change their order.

A part of a conversation gives a table of the cheapest audits from each state to
each other; such tables chain, so a conversation of any length is read in parts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from heapq import heappop, heappush

#: Costs of the edits; a truncated row that stays costs that much more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: What the edited roles end in: nothing yet, a leading system turn, a user turn, an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The state after a user or assistant turn, whichever is due.
DUE = (USER, USER, ASSISTANT, USER)
#: The states that a turn of that initial may follow.
AFTER = {"s": (EMPTY,), "u": (EMPTY, SYSTEM, ASSISTANT), "a": (USER,)}
REACHED = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Ends of a whole conversation.
ENDS = (EMPTY, ASSISTANT)
#: Rows searched at once: a node keeps an audit about as long.
ROWS = 1024

#: A row to be edited: its role's initial, whether it must go, what it costs to stay.
Row = tuple[str, bool, int]
Found = tuple[int, str] | None


def _forward(rows: Sequence[Row], i: int, s: int) -> Iterator[tuple[str, int, int, int]]:
    """Edits at a node: (letter, cost, rows read, state)."""
    if i < len(rows):
        initial, must_go, extra = rows[i]
        yield "D", DELETE, i + 1, s
        if not must_go:
            if s in AFTER.get(initial, ()):
                yield "K", extra, i + 1, REACHED[initial]
            yield "R", REROLE + extra, i + 1, DUE[s]
    yield "I", INSERT, i, DUE[s]


def _backward(rows: Sequence[Row], i: int, s: int) -> Iterator[tuple[str, int, int, int]]:
    """Edits that lead to a node: (letter, cost, rows read, state) where they start."""
    before = [b for b in STATES if DUE[b] == s]
    if i:
        initial, must_go, extra = rows[i - 1]
        yield "D", DELETE, i - 1, s
        if not must_go:
            if REACHED.get(initial) == s:
                for b in AFTER[initial]:
                    yield "K", extra, i - 1, b
            for b in before:
                yield "R", REROLE + extra, i - 1, b
    for b in before:
        yield "I", INSERT, i, b


class _Side:
    """One of the two searches. Heap order is cost, then the direction of reading, so edits without cost come in order."""

    def __init__(self, starts: Iterable[tuple[int, int]], step: int) -> None:
        self.step = step
        self.seen = {node: (0, "") for node in starts}
        self.done: dict[tuple[int, int], tuple[int, str]] = {}
        self.heap: list[tuple[int, int, int]] = []
        for i, s in self.seen:
            heappush(self.heap, (0, step * i, s))

    def top(self) -> float:
        heap = self.heap
        while heap and (self.step * heap[0][1], heap[0][2]) in self.done:
            heappop(heap)
        return heap[0][0] if heap else float("inf")

    def settle(self, rows: Sequence[Row], other: _Side, best: float) -> float:
        """Takes the nearest open node; the cost of the cheapest crossing known then."""
        _, i, s = heappop(self.heap)
        node = (self.step * i, s)
        cost, audit = self.done[node] = self.seen[node]
        if node in other.seen:
            best = min(best, cost + other.seen[node][0])
        forward = self.step > 0
        for letter, c, j, t in (_forward if forward else _backward)(rows, *node):
            there = (j, t)
            if there in self.done:
                continue
            new = (cost + c, audit + letter if forward else letter + audit)
            old = self.seen.get(there)
            if old is None or new < old:
                self.seen[there] = new
                if old is None or new[0] < old[0]:
                    heappush(self.heap, (new[0], self.step * j, t))
            if there in other.seen:
                best = min(best, new[0] + other.seen[there][0])
        return best


def cheapest(rows: Sequence[Row], start: int = EMPTY, ends: Sequence[int] = ENDS) -> Found:
    """The least cost and, of its audits, the least; None where no edits lead from ``start`` to one of ``ends``."""
    ahead = _Side([(0, start)], 1)
    back = _Side([(len(rows), e) for e in ends], -1)
    best = float("inf")
    for side, other in ((ahead, back), (back, ahead)):
        for _ in range(len(side.seen)):  # the starts
            best = side.settle(rows, other, best)
    while True:
        a, b = ahead.top(), back.top()
        if a + b > best or a + b == float("inf"):
            break
        best = ahead.settle(rows, back, best) if (a, len(ahead.heap)) <= (b, len(back.heap)) else back.settle(rows, ahead, best)
    if best == float("inf"):
        return None
    found = []
    for node, (cost, audit) in ahead.done.items():
        if cost > best:
            continue
        if node in back.done and cost + back.done[node][0] == best:
            found.append(audit + back.done[node][1])
        for letter, c, j, t in _forward(rows, *node):
            rest = back.done.get((j, t))
            if rest and cost + c + rest[0] == best:
                found.append(audit + letter + rest[1])
    return int(best), min(found)


#: Cheapest audits of a part, by state before and state after.
Table = list[list[Found]]


def table(rows: Sequence[Row]) -> Table:
    """All ways through a part of a conversation."""
    parts = [[[cheapest(rows[k : k + ROWS], s, (t,)) for t in STATES] for s in STATES] for k in range(0, len(rows), ROWS)]
    while len(parts) > 1:  # neighbours by pairs: audits are copied a few times only
        parts = [chained(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


def _through(ways: Sequence[Found], part: Table) -> list[Found]:
    out = []
    for t in STATES:
        found = [(w[0] + part[s][t][0], w[1] + part[s][t][1]) for s, w in enumerate(ways) if w and part[s][t]]
        out.append(min(found, default=None))
    return out


def chained(a: Table, b: Table) -> Table:
    return [_through(ways, b) for ways in a]


class Chain:
    """A conversation read part by part: of each state, the least of the cheapest audits so far."""

    def __init__(self) -> None:
        self.ways: list[Found] = [(0, ""), None, None, None]

    def add(self, part: Table) -> None:
        self.ways = _through(self.ways, part)

    def best(self) -> tuple[int, str]:
        return min(self.ways[e] for e in ENDS if self.ways[e])


def repaired(audit: Iterable[str], turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) after the edits; ``turns`` are read as the audit asks."""
    state = EMPTY
    for letter in audit:
        role, text = next(turns) if letter != "I" else (None, "")
        if letter == "D":
            continue
        state = REACHED[role[:1]] if letter == "K" else DUE[state]
        yield role if letter == "K" else NAMES[state], text
