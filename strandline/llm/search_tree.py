"""A ternary search tree over sequences of numbers, and what its nodes hold together."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

#: Hash of an empty list of ids.
NOTHING = hashlib.sha256(b"").hexdigest()


@dataclass
class Spine:
    """A path from the root with what is known at each of its depths, 0 to its length, apart from deeper spines.

    ``own`` are members, ``first`` the least of their ids (None: none), ``kids`` children,
    ``leaves`` and ``saved`` what stands below these children, ``ends`` the digest of the members
    that end here ('': none does).
    """

    ids: list[int]
    words: list[int]
    own: list[int]
    first: list[int | None]
    kids: list[int]
    leaves: list[int]
    saved: list[int]
    ends: list[str]


def sequence(ids: list[int], words: list[int], first: int, members: int, ends: str) -> Spine:
    """The spine of a whole sequence: everything it knows stands at its end."""
    n = len(ids)
    zero = [0] * n
    return Spine(ids, words, [*zero, members], [*([None] * n), first], [0] * (n + 1), [0] * (n + 1), [0] * (n + 1), [*([""] * n), ends])


@dataclass
class Tree:
    """Nodes by number, 0 the root; ``low``, ``down`` and ``high`` are links to nodes, 0 where there is none."""

    ids: list[int] = field(default_factory=lambda: [0])
    words: list[int] = field(default_factory=lambda: [0])
    low: list[int] = field(default_factory=lambda: [0])
    down: list[int] = field(default_factory=lambda: [0])
    high: list[int] = field(default_factory=lambda: [0])
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    own: list[int] = field(default_factory=lambda: [0])
    first: list[int | None] = field(default_factory=lambda: [None])
    kids: list[int] = field(default_factory=lambda: [0])
    leaves: list[int] = field(default_factory=lambda: [0])
    saved: list[int] = field(default_factory=lambda: [0])
    ends: list[str] = field(default_factory=lambda: [""])

    def _below(self, at: int, number: int, words: int) -> int:
        """The child of ``at`` that stands for ``number``, made where there is none."""
        link, now = self.down, at
        while link[now]:
            now = link[now]
            if number == self.ids[now]:
                return now
            link = self.low if number < self.ids[now] else self.high
        new = link[now] = len(self.ids)
        for column, value in (
            (self.ids, number), (self.words, words), (self.low, 0), (self.down, 0), (self.high, 0), (self.parent, at), (self.depth, self.depth[at] + 1),
            (self.own, 0), (self.first, None), (self.kids, 0), (self.leaves, 0), (self.saved, 0), (self.ends, ""),
        ):
            column.append(value)
        return new

    def insert(self, s: Spine) -> list[int]:
        """Add a spine; returns its nodes, from the root on."""
        path, at = [0], 0
        for number, words in zip(s.ids, s.words):
            at = self._below(at, number, words)
            path.append(at)
        for node, own, first, kids, leaves, saved, ends in zip(path, s.own, s.first, s.kids, s.leaves, s.saved, s.ends):
            self.own[node] += own
            self.kids[node] += kids
            self.leaves[node] += leaves
            self.saved[node] += saved
            self.ends[node] = self.ends[node] or ends
            if first is not None and (self.first[node] is None or first < self.first[node]):
                self.first[node] = first
        return path

    def in_order(self) -> Iterator[int]:
        """All nodes, each before those below it, children by number; with a stack of its own and no recursion."""
        stack = [(0, True)]
        while stack:
            node, whole = stack.pop()
            if whole and node:  # the nodes beside it with larger numbers, itself, those with smaller ones
                if self.high[node]:
                    stack.append((self.high[node], True))
                stack.append((node, False))
                if self.low[node]:
                    stack.append((self.low[node], True))
            else:
                yield node
                if self.down[node]:
                    stack.append((self.down[node], True))


def balanced(spines: list[Spine]) -> Iterator[int]:
    """Places of a sorted list, the median of each part first, so that no branch of the tree grows long."""
    stack = [(0, len(spines))]
    while stack:
        low, high = stack.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            stack.append((middle + 1, high))
            stack.append((low, middle))


@dataclass
class Node:
    """A finished node; ``parent`` is None where the parent is still open and ``above`` names it."""

    conv: int
    depth: int
    parent: int | None
    members: int
    children: int
    leaves: int
    saved: int
    ends: str
    name: str | None
    above: str | None


def grown(spines: list[Spine], last: bool, merged: bool = False) -> tuple[list[Node], list[Spine]]:
    """Finished nodes of one range of sorted spines, and two spines of those that other ranges may share.

    Neighbouring ranges share only nodes on the path of a first or last spine; these stay open
    unless this is the ``last`` range, and everything below them is summed up at them. ``name``
    is the digest of the path of a node that is or was open (all of ``merged`` spines), so that
    what hangs below it finds it.
    """
    if not spines:
        return [], []
    tree, paths = Tree(), {}
    for at in balanced(spines):
        path = tree.insert(spines[at])
        if merged or at in (0, len(spines) - 1):
            paths[at] = path
    outer = [paths[at] for at in sorted({0, len(spines) - 1})]
    n = len(tree.ids)
    # a node's outer spines: it may be shared with another range
    edge = np.zeros(n, bool)
    for path in outer:
        edge[path] = True
    members, first = list(tree.own), list(tree.first)
    children, leaves, saved = list(tree.kids), list(tree.leaves), list(tree.saved)
    inner = {v: [tree.own[v], tree.first[v], tree.kids[v], tree.leaves[v], tree.saved[v]] for v in np.flatnonzero(edge).tolist()}
    order = list(tree.in_order())
    for v in reversed(order):
        if not children[v]:
            leaves[v] = 1
        saved[v] += (members[v] - 1) * tree.words[v]
        p = tree.parent[v]
        if p < 0:
            continue
        members[p] += members[v]
        children[p] += 1
        leaves[p] += leaves[v]
        saved[p] += saved[v]
        first[p] = first[v] if first[p] is None else min(first[p], first[v])
        if p in inner and not edge[v]:
            i = inner[p]
            i[0], i[1], i[2], i[3], i[4] = i[0] + members[v], first[v] if i[1] is None else min(i[1], first[v]), i[2] + 1, i[3] + leaves[v], i[4] + saved[v]
    names: dict[int, str] = {}
    for path in paths.values():
        sha = hashlib.sha1()
        for v in path:
            if v:
                sha.update(tree.ids[v].to_bytes(8, "little", signed=True))
            names[v] = f"{tree.depth[v]}:{sha.hexdigest()}"
    done = []
    for v in order:
        if edge[v] and not last:
            continue
        p = tree.parent[v]
        open_ = p >= 0 and edge[p] and not last
        done.append(Node(first[v], tree.depth[v], None if p < 0 or open_ else first[p], members[v], children[v], leaves[v], saved[v], tree.ends[v] or NOTHING, names.get(v), names[p] if open_ else None))
    if last:
        return done, []
    left, seen = [], set()
    for path in outer:
        mine = [v if v not in seen else None for v in path]
        seen.update(path)
        row = [inner[v] if v is not None else [0, None, 0, 0, 0] for v in mine]
        own, firsts, kids, leaf, save = map(list, zip(*row))
        left.append(Spine([tree.ids[v] for v in path[1:]], [tree.words[v] for v in path[1:]], own, firsts, kids, leaf, save, [tree.ends[v] if v is not None else "" for v in mine]))
    return done, left
