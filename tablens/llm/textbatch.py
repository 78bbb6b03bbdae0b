"""Vectorised views over Arrow text columns, used inside ``mapInArrow`` tasks.

Spark partitions, shuffles and aggregates; these helpers only work on the bytes of one
Arrow batch, cut into slices of bounded size (a single longer text is one slice).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The white space of the word pattern [^\x20\x09-\x0D]+.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

SLICE_BYTES = 4 << 20
PAD = 16

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def text_column(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets (n + 1) of an Arrow string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + n + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf, offs


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of documents of about ``limit`` bytes; one longer document stands alone."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def cut(buf: np.ndarray, offs: np.ndarray, i: int, j: int, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A zero-padded copy of documents [i, j) and their offsets from 0; ``fold`` lower-cases A-Z."""
    lo, hi = int(offs[i]), int(offs[j])
    out = np.zeros(hi - lo + PAD, dtype=np.uint8)
    out[:hi - lo] = LOWER[buf[lo:hi]] if fold else buf[lo:hi]
    return out, (offs[i:j + 1] - lo).astype(np.int64)


def runs(member: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``member`` bytes that don't cross a document border."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inner = offs[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    begin = member.copy()
    begin[1:] &= ~member[:-1]
    begin[inner] = member[inner]
    stop = member.copy()
    stop[:-1] &= ~member[1:]
    stop[inner - 1] = member[inner - 1]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


def words(chunk: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, ends and, per document, the index of its first word (n + 1 entries)."""
    starts, ends = runs(~WHITE[chunk[:offs[-1]]], offs)
    return starts, ends, np.searchsorted(starts, offs)


def hash_spans(chunk: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span of a padded chunk, eight bytes at a time."""
    lanes = np.ndarray((len(chunk) - 8,), "<u8", chunk, 0, (1,))
    size = ends - starts
    h = (size.astype(np.uint64) + np.uint64(seed & 0xFFFFFFFF)) * _M1 + _M1
    v = lanes[starts] & _KEEP[np.minimum(size, 8)]
    h = mix(h ^ v)
    at = np.flatnonzero(size > 8)
    k = 8
    while len(at):
        v = lanes[starts[at] + k] & _KEEP[np.minimum(size[at] - k, 8)]
        h[at] = mix((h[at] * _M1) ^ v)
        k += 8
        at = at[size[at] > k]
    return h


def chars_before(chunk: np.ndarray, size: int) -> np.ndarray:
    """For each byte position 0..size the number of code points that begin before it."""
    out = np.zeros(size + 1, dtype=np.int64)
    np.cumsum((chunk[:size] & 0xC0) != 0x80, out=out[1:])
    return out


class HashIndex:
    """An open-addressing table from non-zero uint64 keys to 0, 1, 2, ... in order of arrival."""

    def __init__(self, room: int = 1 << 16):
        self.size = 0
        self._alloc(room)

    def _alloc(self, room: int) -> None:
        self.mask = np.uint64(room - 1)
        self.keys = np.zeros(room, dtype=np.uint64)
        self.vals = np.full(room, -1, dtype=np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it is unknown."""
        slot = (mix(keys) & self.mask).astype(np.int64)
        found = self.keys[slot]
        out = np.where(found == keys, self.vals[slot], -1)
        at = np.flatnonzero((found != keys) & (found != 0))
        step = 0
        while len(at):
            step += 1
            s = (slot[at] + step) & int(self.mask)
            found = self.keys[s]
            hit = found == keys[at]
            out[at[hit]] = self.vals[s[hit]]
            at = at[~hit & (found != 0)]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Adds distinct keys that the table doesn't hold yet."""
        if (self.size + len(keys)) * 2 > len(self.keys):
            old, vals = self.keys, self.vals
            room = len(old)
            while (self.size + len(keys)) * 2 > room:
                room *= 2
            self._alloc(room)
            held = old != 0
            self._put(old[held], vals[held])
        self._put(keys, np.arange(self.size, self.size + len(keys)))
        self.size += len(keys)

    def _put(self, keys: np.ndarray, vals: np.ndarray) -> None:
        slot = (mix(keys) & self.mask).astype(np.int64)
        at = np.arange(len(keys))
        while len(at):
            free = self.keys[slot[at]] == 0
            self.keys[slot[at[free]]] = keys[at[free]]
            won = free & (self.keys[slot[at]] == keys[at])
            self.vals[slot[at[won]]] = vals[at[won]]
            at = at[~won]
            slot[at] = (slot[at] + 1) & int(self.mask)
