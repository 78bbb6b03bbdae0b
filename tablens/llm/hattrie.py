"""A HAT-trie over word ids: burstable hash containers below a shallow trie, counted in batches.

A phrase is one to four word ids, packed into two unsigned 64-bit numbers (two ids each, first
id highest, 0 behind its end), so that numeric order is prefix order. Containers are hash tables
of phrases with counts. One covers a range of ids at its depth (hybrid); at ``burst`` phrases it
is split at the median id, and one that holds a single id (pure) becomes a trie node whose child
covers all next ids. Above ``room`` phrases in all, the largest subtrees leave as sorted runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .textbatch import mix

BURST = 1 << 15
ROOM = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)

Run = tuple[np.ndarray, np.ndarray, np.ndarray]


def word_at(high: np.ndarray, low: np.ndarray, depth: int) -> np.ndarray:
    """The ids at a depth (0 to 3)."""
    part = high if depth < 2 else low
    return part >> np.uint64(32) if depth % 2 == 0 else part & _LOW


class Container:
    """Phrases and counts in an open-addressing table, for the ids [first, last] at ``depth``."""

    def __init__(self, depth: int, first: int, last: int):
        self.depth, self.first, self.last, self.size = depth, first, last, 0
        self._table(256)

    def _table(self, room: int) -> None:
        self.mask = room - 1
        self.high, self.low = np.zeros(room, np.uint64), np.zeros(room, np.uint64)
        self.count = np.zeros(room, np.int64)

    def add(self, high: np.ndarray, low: np.ndarray, count: np.ndarray) -> None:
        """Adds counts of phrases that differ from one another."""
        room = self.mask + 1
        if (self.size + len(high)) * 2 > room:
            held = self.count > 0
            old = self.high[held], self.low[held], self.count[held]
            while (self.size + len(high)) * 2 > room:
                room *= 2
            self._table(room)
            self.size = 0
            self._put(*old)
        self._put(high, low, count)

    def _put(self, high: np.ndarray, low: np.ndarray, count: np.ndarray) -> None:
        slot = (mix(high ^ mix(low + _ODD)) & np.uint64(self.mask)).astype(np.int64)
        at = np.arange(len(high))
        while len(at):
            free = self.count[slot[at]] == 0
            # Of several phrases at one free slot the last one written has it; the others go on.
            self.high[slot[at[free]]], self.low[slot[at[free]]] = high[at[free]], low[at[free]]
            same = (self.high[slot[at]] == high[at]) & (self.low[slot[at]] == low[at])
            self.size += int((same & free).sum())
            self.count[slot[at[same]]] += count[at[same]]
            at = at[~same]
            slot[at] = (slot[at] + 1) & self.mask

    def run(self) -> Run:
        """Its phrases in order."""
        held = np.flatnonzero(self.count)
        order = held[np.lexsort((self.low[held], self.high[held]))]
        return self.high[order], self.low[order], self.count[order]

    def burst(self) -> list:
        """What takes its place: of a single id a node a depth below, else two containers or more."""
        run = self.run()
        if self.first == self.last:
            node = Node(self.depth + 1, [Container(self.depth + 1, 0, int(_LOW))])
            node.add(*run)
            node.first, node.last = self.first, self.last
            return [node]
        word = word_at(run[0], run[1], self.depth)
        middle, least = int(word[len(word) // 2]), int(word[0])
        # The median id begins the right half, unless nothing would be left of it.
        middle = middle if middle > least else least + 1 if least < self.last else self.last
        node = Node(self.depth, [Container(self.depth, self.first, middle - 1), Container(self.depth, middle, self.last)])
        node.add(*run)
        return node.children


class Node:
    """Children side by side, each for a range of ids at ``depth``."""

    def __init__(self, depth: int, children: list):
        self.depth, self.children = depth, children
        self.first, self.last = children[0].first, children[-1].last

    @property
    def size(self) -> int:
        return sum(c.size for c in self.children)

    def add(self, high: np.ndarray, low: np.ndarray, count: np.ndarray) -> None:
        """Adds counts of different phrases in ascending order."""
        cuts = np.searchsorted(word_at(high, low, self.depth), [c.first for c in self.children[1:]])
        cuts = [0, *cuts.tolist(), len(high)]
        grown: list = []
        for child, i, j in zip(self.children, cuts, cuts[1:], strict=False):
            if i < j:
                child.add(high[i:j], low[i:j], count[i:j])
            if isinstance(child, Container) and child.size > BURST:
                grown += child.burst()
            else:
                grown.append(child)
        self.children = grown

    def runs(self) -> Iterator[Run]:
        for c in self.children:
            yield from c.runs() if isinstance(c, Node) else [c.run()] if c.size else []


class HatTrie:
    """Counts batches of packed phrases; ``add`` returns the sorted runs that had to leave."""

    def __init__(self, room: int = ROOM):
        self.room = room
        self.root = Node(0, [Container(0, 0, int(_LOW))])

    def add(self, high: np.ndarray, low: np.ndarray) -> list[Run]:
        """Counts every given occurrence."""
        if not len(high):
            return []
        if low.any():
            order = np.lexsort((low, high))
            high, low = high[order], low[order]
            new = np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
        else:
            high = np.sort(high)
            new = np.concatenate([[True], high[1:] != high[:-1]])
        first = np.flatnonzero(new)
        self.root.add(high[first], low[first], np.diff(np.append(first, len(high))))
        return self._spill() if self.root.size > self.room else []

    def _spill(self) -> list[Run]:
        """The largest subtrees below the root leave until half of the room is free."""
        left, runs, kept = self.root.size, [], []
        for child in sorted(self.root.children, key=lambda c: -c.size):
            if left * 2 > self.room and child.size:
                left -= child.size
                runs += child.runs() if isinstance(child, Node) else [child.run()]
                child = Container(0, child.first, child.last)
            kept.append(child)
        self.root.children = sorted(kept, key=lambda c: c.first)
        return runs

    def drain(self) -> list[Run]:
        """All that is left, as sorted runs."""
        runs = list(self.root.runs())
        self.root = Node(0, [Container(0, 0, int(_LOW))])
        return runs
