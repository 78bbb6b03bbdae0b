"""Language-model scores by context-tree weighting over bytes.

Every byte is coded as eight binary decisions, each with its own context tree over the DEPTH bytes
before it. A node estimates its bit with the Krichevsky-Trofimov rule from the training counts; the
estimates of all depths along a context's path are mixed with the weights that context-tree
weighting gives them: half a node's own block probability against the product of its children's.
A text is its lower-cased (A-Z) UTF-8 bytes and one end symbol, its first bytes see padding.

The counts of all byte strings of length DEPTH + 1 determine every tree. They are gathered in
Spark: each task sends the distinct strings and words of its blocks of documents, with their counts,
to the parts their hash or their two latest context bytes name. A part merges its counts, weighs
all its trees from DEPTH up to 2, and answers every block with the log probability of each string
it asked for. Trees above depth 2 have at most 65,280 nodes, whatever the corpus; these alone are
put together on the driver. The documents travel once, compressed, to where their block's answers are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .textbatch import HashIndex, cut, hash_spans, slices, text_column, words

DEPTH = 5
BLOCK = 64 << 20
_SLICE = 1 << 20
_END = 0xFF
_U = np.uint64
WORD, GRAM, BUNDLE = 0, 1, 2


def grams(chunk: np.ndarray, offs: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """One key per coded symbol of all documents (bytes and end), and each document's first.

    A key holds the context, latest byte first, then the symbol.
    """
    n = np.diff(offs)
    first = np.concatenate([[0], np.cumsum(n + 1)])
    wide = first[:-1] + np.arange(len(n)) * depth
    stream = np.full(int(first[-1]) + len(n) * depth + 8, _END, dtype=np.uint8)
    place = np.repeat(wide + depth - offs[:-1], n) + np.arange(offs[-1])
    stream[place] = chunk[:offs[-1]]
    at = np.repeat(wide - first[:-1], n + 1) + np.arange(first[-1])
    lanes = np.ndarray((len(stream) - 7,), "<u8", stream, 0, (1,))
    low = lanes[at] & _U((1 << (8 * depth)) - 1)
    return (low << _U(8)) | stream[at + depth].astype(np.uint64), first


def _count(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their summed counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    lead = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[lead], np.diff(np.append(lead, len(keys))) if counts is None else np.add.reduceat(counts, lead)


class Tally:
    """Counts of keys in training texts; keys of other texts are kept with count 0."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray, train: np.ndarray) -> None:
        for rows, unit in ((keys[train], 1), (keys[~train], 0)):
            k, n = _count(rows)
            self.put(k, n * unit)

    def put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > 2_000_000 and len(self.keys) > 8:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if self.keys:
            got = _count(np.concatenate(self.keys), np.concatenate(self.counts))
            self.keys, self.counts, self.held = [got[0]], [got[1]], 0
            return got
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)


def word_keys(chunk: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word and each document's first word."""
    starts, ends, first = words(chunk, offs)
    return hash_spans(chunk, starts, ends, 17) | _U(1), first


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln gamma for x >= 0.5, by Stirling's series after moving x up by 8."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    s = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - s * (1 / 360 - s * (1 / 1260 - s / 1680))) / y - shift


def _block_log(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a block with n0 zeros and n1 ones."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


class Level:
    """One bit's nodes at one depth: their ids (context, bits so far), counts and weights."""

    def __init__(self, ids: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None):
        self.ids, self.ones = ids, (n1 + 0.5) / (n0 + n1 + 1.0)
        own = _block_log(n0, n1)
        if below is None:  # the deepest: its own estimate alone
            self.log, self.weight = own, np.ones(len(ids))
        else:
            self.log = np.logaddexp(own, below) - np.log(2.0)
            self.weight = np.exp(own - np.log(2.0) - self.log)


def _parents(ids: np.ndarray, bit: int) -> np.ndarray:
    """A node's id without its oldest context byte."""
    k = _U(bit)
    return ((ids >> _U(bit + 8)) << k) | (ids & _U((1 << bit) - 1))


def _bit_counts(keys: np.ndarray, counts: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of one bit over sorted keys (context, symbol): ids, zeros, ones, first key of each."""
    ids = keys >> _U(8 - bit)
    lead = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    on = ((keys >> _U(7 - bit)) & _U(1)).astype(np.int64)
    n1 = np.add.reduceat(counts * on, lead)
    return ids[lead], (np.add.reduceat(counts, lead) - n1).astype(np.float64), n1.astype(np.float64), lead


class Forest:
    """The trees of some two-byte contexts, from ``depth`` up to depth 2."""

    TOP = 2

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int = DEPTH):
        self.keys, self.depth = keys, depth
        self.levels: dict[tuple[int, int], Level] = {}
        for d in range(depth, self.TOP - 1, -1):
            for bit in range(8):
                ids, n0, n1, lead = _bit_counts(keys, counts, bit)
                if d == depth:
                    below = None
                    if bit == 0:
                        self.leads = []
                    self.leads.append(lead)
                else:
                    under = self.levels[d + 1, bit]
                    below = np.bincount(np.searchsorted(ids, _parents(under.ids, bit)), weights=under.log, minlength=len(ids))
                self.levels[d, bit] = Level(ids, n0, n1, below)
                if d == self.TOP:
                    self.levels[d, bit].n = (n0, n1)
            keys, counts = _count(((keys >> _U(16)) << _U(8)) | (keys & _U(255)), counts)

    def roots(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(bit, depth-1 ids, zeros, ones, summed log) of what lies below each depth-1 node."""
        for bit in range(8):
            top = self.levels[self.TOP, bit]
            ids, back = np.unique(_parents(top.ids, bit), return_inverse=True)
            yield bit, ids, *(np.bincount(back, weights=w, minlength=len(ids)) for w in (*top.n, top.log))

    def log10(self, crown: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """log10 probability of each key's symbol; ``crown``: per bit depth-1 ids, mixed so far, weight left."""
        total = np.zeros(len(self.keys))
        for bit in range(8):
            ids, mixed, left = crown[bit]
            for d in range(self.TOP, self.depth + 1):
                level = self.levels[d, bit]
                at = np.searchsorted(ids, _parents(level.ids, bit))
                mixed = mixed[at] + left[at] * level.weight * level.ones
                left = left[at] * (1 - level.weight)
                ids = level.ids
            size = np.diff(np.append(self.leads[bit], len(self.keys)))
            p = np.repeat(mixed, size)
            total += np.log10(np.where((self.keys >> _U(7 - bit)) & _U(1), p, 1 - p))
        return total


def crown(rows: list[tuple[int, int, float, float, float]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Weighs depths 1 and 0 from (bit, depth-1 id, zeros, ones, summed log), at most 65,280 rows."""
    out = {}
    for bit in range(8):
        mine = sorted(r[1:] for r in rows if r[0] == bit)
        ids = np.array([r[0] for r in mine], dtype=np.uint64)
        n0, n1, below = np.array([r[1:] for r in mine], dtype=np.float64).reshape(-1, 3).T
        one = Level(ids, n0, n1, below)
        roots, back = np.unique(_parents(ids, bit), return_inverse=True)
        top = Level(roots, *(np.bincount(back, weights=w, minlength=len(roots)) for w in (n0, n1, one.log)))
        left = 1 - top.weight[back]
        out[bit] = (ids, top.weight[back] * top.ones[back] + left * one.weight * one.ones, left * (1 - one.weight))
    return out


def part_of(keys: np.ndarray, parts: int, kind: int, depth: int = DEPTH) -> np.ndarray:
    """The part of each key: words by hash, strings by their two latest context bytes."""
    h = keys >> _U(8 * (depth - 1)) if kind == GRAM else keys
    return (((h * _U(0x9E3779B97F4A7C15)) >> _U(33)) % _U(parts)).astype(np.int32)


_STORE = "kind int, block long, part int, keys binary, vals binary, ids array<long>"


def _store(docs: DataFrame, train: Column, id_col: str, text_col: str, parts: int, depth: int) -> DataFrame:
    """Blocks of documents, compressed, with the distinct words and strings each of them asks for."""
    names = [f.split()[0] for f in _STORE.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())]

    def record(*row) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, tally = TaskContext.get().partitionId() << 24, 0, {WORD: Tally(), GRAM: Tally()}
        pack = zstandard.ZstdCompressor(level=1)

        def asked() -> Iterator[pa.RecordBatch]:
            for kind, t in tally.items():
                keys, counts = t.total()
                part = part_of(keys, parts, kind, depth)
                order = np.argsort(part, kind="stable")
                keys, counts, part = keys[order], counts[order], part[order]
                cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
                for a, b in zip(cuts, [*cuts[1:], len(part)], strict=True):
                    yield record(kind, block, int(part[a]), keys[a:b].tobytes(), counts[a:b].astype("<i8").tobytes(), None)

        for batch in batches:
            buf, offs = text_column(batch.column(1))
            flags = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for i, j in slices(offs, _SLICE):
                chunk, rel = cut(buf, offs, i, j, fold=True)
                for kind, (keys, first) in ((WORD, word_keys(chunk, rel)), (GRAM, grams(chunk, rel, depth))):
                    tally[kind].add(keys, np.repeat(flags[i:j], np.diff(first)))
                yield record(BUNDLE, block, 0, pack.compress(chunk[:rel[-1]].tobytes()), rel.tobytes() + flags[i:j].tobytes(),
                             batch.column(0)[i:j].to_pylist())
                held += int(rel[-1]) + 64 * (j - i)
                if held >= BLOCK:
                    yield from asked()
                    block, held, tally = block + 1, 0, {WORD: Tally(), GRAM: Tally()}
        if held:
            yield from asked()

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col), F.coalesce(train, F.lit(False)))
    return written(rows.mapInArrow(run, _STORE), "ctw-store", ["kind"])


def _arrays(keys: bytes, vals: bytes, kind: str) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(keys, np.uint64), np.frombuffer(vals, kind)


def _merged(store: DataFrame, kind: int) -> DataFrame:
    """``part, keys, vals``: each part's distinct keys, in order, with their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tally = None, Tally()

        def done():
            keys, counts = tally.total()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([keys.tobytes()], pa.binary()), pa.array([counts.astype("<i8").tobytes()], pa.binary()),
                 pa.array([int(counts.sum())]), pa.array([int((counts > 0).sum())])], names=["part", "keys", "vals", "total", "known"])

        for batch in batches:
            for p, k, v in zip(*(batch.column(c) for c in range(3)), strict=True):
                if part is not None and p.as_py() != part:
                    yield done()
                    tally = Tally()
                part = p.as_py()
                tally.put(*_arrays(k.as_py(), v.as_py(), "<i8"))
        if part is not None:
            yield done()

    asked = store.where(F.col("kind") == kind).select("part", "keys", "vals")
    return written(asked.repartition("part").sortWithinPartitions("part").mapInArrow(run, "part int, keys binary, vals binary, total long, known long"),
                   f"ctw-{('words', 'grams')[kind]}")


def _answers(store: DataFrame, merged: DataFrame, kind: int, tree: tuple | None, depth: int) -> DataFrame:
    """``block, kind, keys, vals``: for each block's keys their counts (words) or log10 values (strings)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = vals = None
        for batch in batches:
            for b, k, v in zip(*(batch.column(c) for c in ("block", "keys", "vals")), strict=True):
                if b.as_py() is None:  # the part's own row comes first
                    keys, vals = _arrays(k.as_py(), v.as_py(), "<i8")
                    if kind == GRAM:
                        vals = Forest(keys, vals, depth).log10(tree)
                    vals = vals.astype("<f8")
                else:
                    mine = np.frombuffer(k.as_py(), np.uint64)
                    got = vals[np.searchsorted(keys, mine)]
                    got = got.astype("<i4") if kind == WORD and got.max(initial=0) < 2**31 else got.astype("<f8" if kind == WORD else "<f4")
                    yield pa.RecordBatch.from_arrays([pa.array([b.as_py()]), pa.array([kind], pa.int32()), pa.array([k.as_py()], pa.binary()),
                                                      pa.array([got.tobytes()], pa.binary())], names=["block", "kind", "keys", "vals"])

    asked = store.where(F.col("kind") == kind).select("part", "block", "keys", F.lit(None).cast("binary").alias("vals"))
    own = merged.select("part", F.lit(None).cast("long").alias("block"), "keys", "vals")
    return (own.unionByName(asked).repartition("part").sortWithinPartitions("part", F.col("block").asc_nulls_first())
            .mapInArrow(run, "block long, kind int, keys binary, vals binary"))


class _Block:
    """A block's answers, ready to be looked up."""

    def __init__(self, rows: dict[int, list[tuple[bytes, bytes]]]):
        self.index, self.vals = {}, {}
        for kind in (WORD, GRAM):
            index, vals = HashIndex(), []
            for k, v in rows.get(kind, []):
                keys = np.frombuffer(k, np.uint64)
                size = len(v) // max(1, len(keys))
                vals.append(np.frombuffer(v, "<i4" if kind == WORD and size == 4 else "<f4" if size == 4 else "<f8").astype(np.float64))
                index.add(keys + _U(1))
            self.index[kind], self.vals[kind] = index, np.concatenate(vals) if vals else np.zeros(0)

    def __call__(self, kind: int, keys: np.ndarray) -> np.ndarray:
        at = self.index[kind].get(keys + _U(1))
        if len(at) and at.min() < 0:
            raise RuntimeError("a key has no answer")
        return self.vals[kind][at]


def _sums(vals: np.ndarray, first: np.ndarray) -> np.ndarray:
    n = len(first) - 1
    return np.bincount(np.repeat(np.arange(n), np.diff(first)), weights=vals, minlength=n)


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """``id_col, trained, n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    The model learns from the rows for which ``train`` holds (null: no) and scores every whole
    text. Tokens are words and one end; the base score is the add-one unigram score of the
    tokens, ``score`` the model's log10 probability of the text with its end, and
    ``bits_per_byte`` its code length over all coded symbols. Null texts count as empty, ids must
    cast to long (null ids stay), repeated rows count and are scored as often as they occur,
    extra columns don't matter, an empty table gives an empty result; without any training row
    the model is uniform.
    """
    # Parts follow the input's partitions, and so its size; a part is read as a stream.
    parts = max(8, min(16_384, docs.rdd.getNumPartitions()))
    store = _store(docs, train, id_col, text_col, parts, depth)
    word_counts, gram_counts = _merged(store, WORD), _merged(store, GRAM)
    ends = docs.where(train).count()
    seen = word_counts.agg(F.sum("total"), F.sum("known")).first()
    tokens, kinds = (seen[0] or 0) + ends, (seen[1] or 0) + (ends > 0)

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, v in zip(batch.column(0), batch.column(1), strict=True):
                for bit, ids, n0, n1, log in Forest(*_arrays(k.as_py(), v.as_py(), "<i8"), depth).roots():
                    yield pa.RecordBatch.from_arrays([pa.array([bit] * len(ids), pa.int32()), pa.array(ids.astype(np.int64)), pa.array(n0), pa.array(n1), pa.array(log)],
                                                     names=["bit", "id", "n0", "n1", "log"])

    top = (gram_counts.select("keys", "vals").mapInArrow(tops, "bit int, id long, n0 double, n1 double, log double")
           .groupBy("bit", "id").agg(F.sum("n0"), F.sum("n1"), F.sum("log")).collect())  # at most 256 x 255 rows
    tree = crown([tuple(r) for r in top])
    answers = _answers(store, word_counts, WORD, None, depth).unionByName(_answers(store, gram_counts, GRAM, tree, depth))
    bundles = store.where(F.col("kind") == BUNDLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, ready = None, {}, None
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                b, kind, keys, vals = (batch.column(c)[i].as_py() for c in ("block", "kind", "keys", "vals"))
                if b != block:
                    block, rows, ready = b, {}, None
                if kind != BUNDLE:
                    rows.setdefault(kind, []).append((keys, vals))
                    continue
                if ready is None:
                    ready, rows = _Block(rows), {}
                ids = batch.column("ids")[i].as_py()
                n = len(ids)
                offs = np.frombuffer(vals[:8 * (n + 1)], np.int64)
                raw = np.frombuffer(unpack.decompress(keys, max_output_size=int(offs[-1])) if offs[-1] else b"", np.uint8)
                chunk, offs = cut(raw, offs, 0, n)
                k, first = word_keys(chunk, offs)
                c = ready(WORD, k)
                base = _sums(np.log10((c + 1) / (tokens + kinds + 1)), first) + np.log10((ends + 1) / (tokens + kinds + 1))
                known = _sums((c > 0).astype(np.float64), first) + (ends > 0)
                k, symbols = grams(chunk, offs, depth)
                total = _sums(ready(GRAM, k), symbols)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(np.frombuffer(vals[8 * (n + 1):], bool)), pa.array(np.diff(offs)), pa.array(np.diff(first) + 1),
                     pa.array(np.rint(known).astype(np.int64)), pa.array(np.full(n, tokens, np.int64)), pa.array(base), pa.array(total),
                     pa.array(-total * np.log2(10.0) / np.diff(symbols))],
                    names=[id_col, "trained", "n_bytes", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    both = (answers.withColumn("ids", F.lit(None).cast("array<long>")).unionByName(bundles.select("block", "kind", "keys", "vals", "ids")))
    return (both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(
        run, f"`{id_col}` long, trained boolean, n_bytes long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"))
