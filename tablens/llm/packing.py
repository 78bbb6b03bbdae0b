"""Best-fit packing with large-item matching.

Documents become token pieces of at most ``capacity``; only longer ones are cut. Which lengths
share a sequence is decided on the histogram of piece lengths alone (at most ``capacity``
numbers, whatever the corpus): pieces above a third of the capacity come first, at most two a
sequence, the longest with the longest that still fits; smaller pieces, longest first, go to the
sequence with the least room that holds them. Equal lengths are interchangeable, so the plan is a
list of runs of equally filled sequences; every piece then finds its place from its rank among
the pieces of its length, which comes from counts per task, without moving all pieces of a length
to one place.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .textbatch import cut, slices, text_column
from .tokens import encoder

CAPACITY = 1024
TOKEN_SLICE = 1 << 19
END_ID = 2


def cut_points(n: int, capacity: int) -> list[int]:
    """Starts of a document's pieces: whole if it fits, else full pieces behind a shorter first one."""
    if n <= capacity:
        return [0]
    return sorted({0, *range(n % capacity, n, capacity)})


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, ids_crc32`` and the task and rank that made it.

    Null text counts as empty: such a document is its end id alone. ``with_ids`` adds the ids.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            buf, offs = text_column(batch.column(1))
            for i, j in slices(offs, TOKEN_SLICE):
                flat, borders = encoder(tokenizer).encode(*cut(buf, offs, i, j))
                row, piece, start, length, crc, nth, kept = [], [], [], [], [], [], []
                for k in range(j - i):
                    ids = np.append(flat[borders[k]:borders[k + 1]], end_id).astype("<u4")
                    cuts = cut_points(len(ids), capacity)
                    for p, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)], strict=True)):
                        row.append(i + k)
                        piece.append(p)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b].tobytes()))
                        nth.append(made[b - a])
                        made[b - a] += 1
                        if with_ids:
                            kept.append(ids[a:b].astype(np.int32))
                cols = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(row), pa.int32()),
                        pa.array(nth, pa.int64())]
                if with_ids:
                    cols.append(pa.array(kept, pa.list_(pa.int32())))
                names = [id_col, "piece", "start", "length", "ids_crc32", "task", "nth", *["ids"] * with_ids]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


class Plan:
    """Runs of equally filled sequences, built from a histogram of lengths."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.left = capacity, {k: v for k, v in counts.items() if v}
        self.sequences = 0
        self.placed = dict.fromkeys(self.left, 0)
        #: (length, first rank, first sequence, offset) of each run of pieces.
        self.slots: list[tuple[int, int, int, int]] = []
        self.open: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, how many)
        self.rooms: list[int] = []
        self._large()
        self._small()

    def _put(self, length: int, first: int, n: int, offset: int) -> None:
        self.slots.append((length, self.placed[length], first, offset))
        self.placed[length] += n
        self.left[length] -= n

    def _free(self, room: int, first: int, n: int) -> None:
        if room and n > 0:
            if room not in self.open:
                self.open[room] = []
                bisect.insort(self.rooms, room)
            self.open[room].append((first, n))

    def _new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _large(self) -> None:
        large = sorted((x for x in self.left if 3 * x > self.capacity), reverse=True)
        for a in large:
            while self.left[a]:
                b = next((b for b in large if b <= self.capacity - a and self.left[b] and (b != a or self.left[a] > 1)), None)
                if b is None:
                    n = self.left[a]
                    first = self._new(n)
                    self._put(a, first, n, 0)
                    self._free(self.capacity - a, first, n)
                    break
                n = self.left[a] // 2 if a == b else min(self.left[a], self.left[b])
                first = self._new(n)
                self._put(a, first, n, 0)
                self._put(b, first, n, a)
                self._free(self.capacity - a - b, first, n)

    def _fill(self, length: int, room: int, first: int, n: int) -> None:
        """Puts pieces into ``n`` sequences with ``room`` left, one sequence full before the next."""
        each = room // length
        full = min(n, self.left[length] // each)
        at = self.capacity - room
        for k in range(each if full else 0):
            self._put(length, first, full, at + k * length)
        self._free(room - each * length, first, full)
        rest = min(self.left[length], each) if full < n else 0
        for k in range(rest):
            self._put(length, first + full, 1, at + k * length)
        self._free(room - rest * length, first + full, min(1, n - full))
        self._free(room, first + full + 1, n - full - 1)

    def _small(self) -> None:
        for length in sorted((x for x in self.left if 3 * x <= self.capacity), reverse=True):
            while self.left[length]:
                i = bisect.bisect_left(self.rooms, length)
                if i < len(self.rooms):
                    room = self.rooms[i]
                    first, n = self.open[room].pop()
                    if not self.open[room]:
                        del self.open[room]
                        del self.rooms[i]
                else:
                    room, n = self.capacity, -(-self.left[length] // (self.capacity // length))
                    first = self._new(n)
                self._fill(length, room, first, n)


def pack(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Every piece of every row of ``docs`` with its ``sequence_id`` and its ``offset`` there.

    Sequences are gapless from 0 and hold at most ``capacity`` tokens. Null and empty texts give
    one piece (their end id), repeated rows each their own pieces, null ids stay null; extra
    columns don't matter; an empty table gives an empty result. ``with_ids`` keeps the ids.
    """
    pieces = written(token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, with_ids), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(histogram, capacity)
    slots = np.array(sorted(plan.slots), dtype=np.int64).reshape(-1, 4)
    # The plan's runs: their number depends on the lengths from 1 to capacity, not on the pieces.
    held = docs.sparkSession.sparkContext.broadcast(slots)
    keep = [id_col, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, first, offset = held.value.T
        keys = (length << 48) + rank
        for batch in batches:
            mine = (batch.column("length").to_numpy() << 48) + batch.column("rank").to_numpy()
            at = np.searchsorted(keys, mine, side="right") - 1
            seq = first[at] + (mine - keys[at])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(seq), pa.array(offset[at])],
                                             names=[*keep, "sequence_id", "offset"])

    ranked = pieces.join(bases, ["task", "length"]).select(*keep, (F.col("before") + F.col("nth")).alias("rank"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*keep).schema.fields)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the token sequences of ``pack(..., with_ids=True)``, each of bounded length."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda x: x["ids"])).alias("ids"))
