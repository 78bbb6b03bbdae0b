"""Batch tokenisation: exact ids of a public byte-level BPE file, one lookup per distinct piece.

The pre-tokeniser of such a file never joins characters across white space, so a text's ids are
those of its white-space pieces one after the other. Pieces are hashed to 64 bits and looked up
in a table of bounded size that each Python worker keeps, the used ones longest; unknown pieces
go through the tokeniser itself. Texts with unusual white space or special-token strings go to it whole.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .textbatch import WHITE, HashIndex, hash_spans, words

ROOM = 800_000
_SPECIAL = np.frombuffer(b"<|", np.uint8)


class PieceEncoder:
    """ids of whole texts by one tokeniser file; at most ``room`` pieces are remembered.

    When there are more, those that were used once since the last time are forgotten, and
    beyond half of the room the least used.
    """

    def __init__(self, path: str, room: int = ROOM):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = len(token)  # byte-level: one character per byte
        self.room = room
        self._forget()

    def _forget(self) -> None:
        self.index = HashIndex(1 << 18)
        self.flat = np.zeros(1 << 20, dtype=np.int32)
        self.start = np.zeros((1 << 17) + 1, dtype=np.int64)
        self.hits = np.zeros(1 << 17, dtype=np.int32)

    def _keep_used(self) -> None:
        n = self.index.size
        hits = self.hits[:n]
        keep = np.flatnonzero(hits > 1)
        if len(keep) * 2 > self.room:
            keep = np.sort(np.argpartition(hits, n - self.room // 2)[n - self.room // 2:])
        held = self.index.keys != 0
        keys = np.zeros(n, dtype=np.uint64)
        keys[self.index.vals[held]] = self.index.keys[held]
        flat, start = self.flat, self.start
        self._forget()
        size = start[keep + 1] - start[keep]
        ends = np.cumsum(size)
        self._store(keys[keep], size, flat[np.repeat(start[keep] - (ends - size), size) + np.arange(size.sum())])

    def _store(self, keys: np.ndarray, size: np.ndarray, flat: np.ndarray) -> None:
        n, used = self.index.size, self.start[self.index.size]
        while used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(keys) >= len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        if n + len(keys) > len(self.hits):
            self.hits = np.concatenate([self.hits, np.zeros(max(len(self.hits), len(keys)), np.int32)])
        self.flat[used:used + len(flat)] = flat
        self.start[n + 1:n + len(keys) + 1] = used + np.cumsum(size)
        self.index.add(keys)

    def _ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        """Encodes distinct pieces, all words in one call, each behind its own white space."""
        ids: list[np.ndarray | None] = [None] * len(pieces)
        plain = [k for k, p in enumerate(pieces) if p.strip()]
        for k in (k for k, p in enumerate(pieces) if not p.strip()):
            ids[k] = np.array(self._ids(pieces[k].decode()), dtype=np.int32)
        for at in range(0, len(plain), 2000):
            part = plain[at:at + 2000]
            joined = [p if p[0] == 32 else b"\n" + p for p in (pieces[k] for k in part)]
            got = np.array(self._ids(b"".join(joined).decode()), dtype=np.int32)
            ends = np.searchsorted(np.cumsum(self.bytes_of[got]), np.cumsum([len(p) for p in joined])) + 1
            begins = np.concatenate([[0], ends[:-1]]) + np.array([p[0] == 10 for p in joined])
            for k, a, b in zip(part, begins, ends, strict=True):
                ids[k] = got[a:b]
        size = np.array([len(x) for x in ids], dtype=np.int64)
        self._store(keys, size, np.concatenate(ids))

    @staticmethod
    def _pieces(chunk: np.ndarray, offs: np.ndarray):
        """Starts, ends (in order) and document of each piece."""
        starts, ends, first = words(chunk, offs)
        n = int(offs[-1])
        docs = np.arange(len(offs) - 1)
        # Gaps: before each word, and after a document's last word (or the whole of a blank one).
        left = np.concatenate([[0], ends[:-1]]) if len(starts) else np.zeros(0, np.int64)
        word_doc = np.repeat(docs, np.diff(first))
        left = np.maximum(left, offs[word_doc])
        blank = WHITE[chunk[:n]]
        wide = starts > left
        last = np.where(wide, chunk[np.maximum(starts - 1, 0)], 0)
        word_start = starts - (wide & (last == 32))
        tail = np.where(np.diff(first) > 0, ends[np.maximum(first[1:] - 1, 0)] if len(ends) else 0, offs[:-1])
        s, e = [word_start, left, starts - 1, tail], [ends, starts - 1, starts, offs[1:]]
        d = [word_doc, word_doc, word_doc, docs]
        keep = [np.ones(len(starts), bool), wide & (starts - left > 1), wide & (last != 32), tail < offs[1:]]
        s, e, d = (np.concatenate([x[k] for x, k in zip(y, keep, strict=True)]) for y in (s, e, d))
        order = np.argsort(s, kind="stable")
        del blank
        return s[order], e[order], d[order]

    def _odd(self, chunk: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Documents whose white space or special strings the piece rule doesn't cover."""
        a, b, c = chunk[:-2], chunk[1:-1], chunk[2:]
        bad = (a >= 0x1C) & (a <= 0x1F) | (a == 0x3C) & (b == 0x7C)
        high = np.flatnonzero((a == 0xC2) | (a >= 0xE1) & (a <= 0xE3))
        x, y, z = a[high], b[high], c[high]
        bad[high] |= ((x == 0xC2) & ((y == 0x85) | (y == 0xA0)) | (x == 0xE1) & ((y == 0x9A) | (y == 0xA0))
                      | (x == 0xE2) & ((y == 0x80) & ((z <= 0x8F) | (z >= 0xA8)) | (y == 0x81))
                      | (x == 0xE3) & (y == 0x80) & (z == 0x80))
        at = np.flatnonzero(bad)
        return np.unique(np.searchsorted(offs, at[at < offs[-1]], side="right") - 1)

    def encode(self, chunk: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of all documents of a padded chunk, one after the other, and their borders (n + 1)."""
        odd = self._odd(chunk, offs)
        s, e, d = self._pieces(chunk, offs)
        if len(odd):
            keep = ~np.isin(d, odd)
            s, e, d = s[keep], e[keep], d[keep]
        keys = hash_spans(chunk, s, e, 5) | np.uint64(1)
        known = self.index.get(keys)
        if (known < 0).any():
            if self.index.size + int((known < 0).sum()) > self.room:
                self._keep_used()
                known = self.index.get(keys)
            new, at = np.unique(keys[known < 0], return_index=True)
            where = np.flatnonzero(known < 0)[at]
            raw = chunk.tobytes()
            self._learn(new, [raw[a:b] for a, b in zip(s[where].tolist(), e[where].tolist(), strict=True)])
            known = self.index.get(keys)
        self.hits[:self.index.size] += np.bincount(known, minlength=self.index.size).astype(np.int32)
        size = self.start[known + 1] - self.start[known]
        per_doc = np.bincount(d, weights=size, minlength=len(offs) - 1).astype(np.int64)
        ends = np.cumsum(size)
        flat = self.flat[np.repeat(self.start[known] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        if not len(odd):
            return flat, np.concatenate([[0], np.cumsum(per_doc)])
        cuts = np.concatenate([[0], np.cumsum(per_doc)])
        parts = [flat[cuts[i]:cuts[i + 1]] for i in range(len(per_doc))]
        for i in odd:
            parts[i] = np.array(self._ids(chunk[offs[i]:offs[i + 1]].tobytes().decode()), dtype=np.int32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a file."""
    return PieceEncoder(path)
