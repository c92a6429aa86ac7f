"""The lattice of edits that turn a list of conversation rows into legal turns, and its cheapest path.

A row is one code: its role's initial, ``s`` (system), ``u`` (user), ``a`` (assistant) or ``x``
(any other), in upper case where its text is cut off, or ``d`` where it must go. A node of the
lattice is (rows read, state of the grammar ``(s?(ua)+)?``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

#: What may follow in each state: at the start, after a system turn, a user turn, an assistant turn.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
BEFORE = tuple([(g, role) for g, after in enumerate(NEXT) for role, h in after.items() if h == state] for state in range(4))
START, ENDS, STATES = 0, (0, 3), range(4)
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1

Path = tuple[int, str]
#: The cheapest (cost, audit) from each state before some rows to each state after them.
Table = list[list[Path | None]]


def _row_edits(code: str, role: str) -> Iterator[tuple[int, str]]:
    """(cost, initial) of what makes a row of ``code`` a turn of ``role``."""
    if code == "d":
        return
    worse = CUT_OFF * code.isupper()
    if code.lower() == role:
        yield KEEP + worse, "K"
    if role != "s":
        yield REROLE + worse, "R"


def _forward(codes: str, i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    for role, after in NEXT[state].items():
        if role != "s":
            yield INSERT, "I", i, after
        if i < len(codes):
            for cost, edit in _row_edits(codes[i], role):
                yield cost, edit, i + 1, after
    if i < len(codes):
        yield DELETE, "D", i + 1, state


def _backward(codes: str, i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    for before, role in BEFORE[state]:
        if role != "s":
            yield INSERT, "I", i, before
        if i:
            for cost, edit in _row_edits(codes[i - 1], role):
                yield cost, edit, i - 1, before
    if i:
        yield DELETE, "D", i - 1, state


def cheapest(codes: str, entry: int, exits: tuple[int, ...]) -> Path | None:
    """Cost and audit of the cheapest path from (0, ``entry``) to a state of ``exits`` after all rows.

    Of equally cheap paths it is the one whose audit, the initials of its edits, is least. Two
    searches run towards each other, the one with the lower front first. They stop only once
    their fronts together cost more than the best meeting: then every cheapest path has an edge
    from a node that the forward search has settled to one that the reverse search has, so all
    such edges of the best cost are compared by their whole audit. Free edits lead one row on,
    so rows settle in order at equal cost and a node has its least audit when it is settled. Two
    audits of one cost that lead to one node are never the start of one another, since what the
    longer one has more would be paid insertions; so least parts make the least whole.
    """
    n = len(codes)
    ahead: dict[tuple[int, int], Path] = {}
    behind: dict[tuple[int, int], Path] = {}
    front: list[tuple] = [(0, 0, "", entry)]
    rear: list[tuple] = [(0, -n, "", g) for g in exits]
    best = None
    while front and rear and (best is None or front[0][0] + rear[0][0] <= best):
        if front[0][0] <= rear[0][0]:
            cost, i, audit, state = heappop(front)
            if (i, state) in ahead:
                continue
            ahead[i, state] = cost, audit
            other = behind.get((i, state))
            for step, edit, j, after in _forward(codes, i, state):
                if (j, after) not in ahead:
                    heappush(front, (cost + step, j, audit + edit, after))
        else:
            cost, i, audit, state = heappop(rear)
            i = -i
            if (i, state) in behind:
                continue
            behind[i, state] = cost, audit
            other = ahead.get((i, state))
            for step, edit, j, before in _backward(codes, i, state):
                if (j, before) not in behind:
                    heappush(rear, (cost + step, -j, edit + audit, before))
        if other is not None and (best is None or cost + other[0] < best):
            best = cost + other[0]
    found = [(cost + behind[u][0], audit + behind[u][1]) for u, (cost, audit) in ahead.items() if u in behind]
    for (i, state), (cost, audit) in ahead.items():
        for step, edit, j, after in _forward(codes, i, state):
            if (j, after) in behind:
                found.append((cost + step + behind[j, after][0], audit + edit + behind[j, after][1]))
    return min(found) if found else None


#: Rows that one search covers; the audits that it keeps at its nodes grow with their square.
BLOCK = 512


def table(codes: str) -> Table:
    """The cheapest paths through some rows in the middle of a conversation."""
    return [[cheapest(codes, g, (h,)) for h in STATES] for g in STATES]


def joined(tables: list[Table]) -> Path:
    """Cost and audit of the cheapest repair of a conversation that is cut into ``tables``."""
    rest: list[Path | None] = [(0, "") if g in ENDS else None for g in STATES]
    for t in reversed(tables):
        rest = [
            min(((p[0] + q[0], p[1] + q[1]) for p, q in zip(row, rest) if p is not None and q is not None), default=None)
            for row in t
        ]
    return rest[START]


@lru_cache(maxsize=50_000)
def _short(codes: str) -> Path:
    return cheapest(codes, START, ENDS)


def repaired(codes: str) -> Path:
    """Cost and audit of the cheapest repair of a whole conversation."""
    if len(codes) <= BLOCK // 8:
        return _short(codes)
    if len(codes) <= BLOCK:
        return cheapest(codes, START, ENDS)
    return joined([table(codes[at : at + BLOCK]) for at in range(0, len(codes), BLOCK)])


class Turns:
    """Applies an audit to rows that come one by one; gives ``role:text`` of the repaired turns."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _turn(self, role: str, text: str) -> str:
        self.state = NEXT[self.state][role[0]]
        return f"{role}:{text}"

    def _due(self) -> str:
        return "assistant" if self.state == 2 else "user"

    def inserted(self) -> Iterator[str]:
        """The empty turns that stand before the next row, or at the end."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._turn(self._due(), "")

    def row(self, role: str, text: str) -> Iterator[str]:
        """What stands up to and with the next row."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._turn(role if edit == "K" else self._due(), text)
