"""One-permutation MinHash fingerprints of whole texts.

Every word shingle is hashed once; the high part of the hash names a bin, the rest is its value,
and each bin keeps its least value. Empty bins borrow from a non-empty one that an own cyclic
probe sequence of the bin reaches first (optimal densification: the choice depends on the bin and
on which bins are filled, never on a neighbour). The low ``BITS`` bits of every bin are packed into the
fingerprint; the share of equal bins is corrected for the chance agreement of 2^-BITS.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import cut, hash_spans, mix, slices, text_column, words

BINS, BITS, SHINGLE_WORDS = 256, 4, 5
#: Bounds the one row per range that is broadcast; a range is read as a stream, however long.
MAX_RANGES = 50_000
_A = np.uint64(0x9E3779B97F4A7C15)
_VALUE = np.uint64((1 << 36) - 1)


def _probes(bins: int) -> np.ndarray:
    """Row i: a full cycle through all bins, by an odd stride, that belongs to bin i."""
    seeds = mix(np.arange(bins, dtype=np.uint64) + _A)
    stride, shift = (seeds >> np.uint64(20)) | np.uint64(1), seeds >> np.uint64(40)
    return ((stride[:, None] * np.arange(bins, dtype=np.uint64) + shift[:, None]) % np.uint64(bins)).astype(np.int64)


PROBES = _probes(BINS)


def sketch(chunk: np.ndarray, offs: np.ndarray, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """(documents, BINS) low-bit values. Fewer words than a shingle: all of them; none: one fixed shingle."""
    starts, ends, first = words(chunk, offs)
    n, k = np.diff(first), shingle_words
    word = hash_spans(chunk, starts, ends, 3)
    doc = np.repeat(np.arange(len(n)), n)
    gram = word
    for i in range(1, k):
        gram = mix(gram[:-1] * _A + word[i:]) if len(gram) else gram
    inside = doc[k - 1:] == doc[:len(doc) - k + 1] if len(doc) >= k else np.zeros(0, bool)
    out, owner = [gram[:len(inside)][inside]], [doc[k - 1:][inside] if len(inside) else np.zeros(0, np.int64)]
    for d in np.flatnonzero(n < k):
        h = np.uint64(n[d] + 1)
        for w in word[first[d]:first[d + 1]]:
            h = mix(np.array([h * _A + w], dtype=np.uint64))[0]
        out.append(np.array([h], dtype=np.uint64))
        owner.append(np.array([d]))
    h, owner = mix(np.concatenate(out)), np.concatenate(owner)
    slot = owner.astype(np.uint64) * np.uint64(BINS) + (h >> np.uint64(56))
    # One sort brings each bin's least value first; 28 bits are left for document and bin.
    rows = np.full((len(n), BINS), -1, dtype=np.int64)
    both = np.sort((slot << np.uint64(36)) | (h & _VALUE))
    slot = (both >> np.uint64(36)).astype(np.int64)
    lead = np.ones(len(slot), dtype=bool)
    lead[1:] = slot[1:] != slot[:-1]
    rows.reshape(-1)[slot[lead]] = (both[lead] & _VALUE).astype(np.int64)
    d, b = np.nonzero(rows < 0)
    filled = rows.copy()
    step = 0
    while len(d):
        got = rows[d, PROBES[b, step]]
        filled[d, b] = got
        left = got < 0
        d, b, step = d[left], b[left], step + 1
    return (filled & ((1 << BITS) - 1)).astype(np.uint8)


def sketches(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    parts = [np.zeros((0, BINS), np.uint8)]
    for i, j in slices(offs):
        for a in range(i, j, 1 << 14):  # keeps document and bin within 28 bits
            parts.append(sketch(*cut(buf, offs, a, min(j, a + (1 << 14)))))
    return np.concatenate(parts)


def packed_hex(rows: np.ndarray) -> list[str]:
    """Each document's packed low-order bits (BITS = 4: one hex digit a bin)."""
    return [x.tobytes().hex() for x in (rows[:, ::2] << 4) | rows[:, 1::2]]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The bias-corrected share of equal bins, 0 to 1."""
    chance = 2.0 ** -BITS
    return np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0.0, 1.0)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fingerprint`` of every row; null counts as empty, empty texts share one fingerprint."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed_hex(sketches(*text_column(batch.column(1)))), pa.string())],
                                             names=[id_col, "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fingerprint string")


def _as_buffer(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offs = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offs[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offs


def with_next(docs: DataFrame, id_col: str, text_col: str, rows_per_range: int = 4_000) -> tuple[DataFrame, int]:
    """Rows dealt by ranges of descending id, each range with the row that follows it.

    Returns ``id, text, range, extra`` (extra 1: the following range's first row, only to be
    read) and the number of ranges. Ranges come from quantiles of the ids alone; equal ids share
    a range and follow each other by text, null ids come last; the first row follows the last.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    n, lowest = base.agg(F.count("*"), F.min("id")).first()
    parts = min(MAX_RANGES, max(1, -(-n // rows_per_range)))
    cuts = []
    if parts > 1 and lowest is not None:
        probs = [F.lit(i / parts) for i in range(1, parts)]
        got = base.agg(F.percentile_approx("id", F.array(*probs), F.lit(max(10_000, 20 * parts))).alias("q")).first()["q"]
        cuts = sorted(set(got or []))

    @F.pandas_udf("int")
    def range_of(ids):
        # Descending: the largest ids are range 0, null ids the last.
        at = len(cuts) - np.searchsorted(np.array(cuts, dtype=np.float64 if ids.dtype.kind == "f" else np.int64), ids.fillna(0).to_numpy(), side="left")
        return ids.__class__(np.where(ids.isna(), len(cuts) + 1, at)).astype("int32")

    dealt = base.withColumn("range", range_of("id"))
    # One row per range: its first id, and among equal ids the least text.
    firsts = dealt.groupBy("range").agg(F.max("id").alias("first")).collect()
    order = sorted(r["range"] for r in firsts)
    before = {b: a for a, b in zip(order, order[1:], strict=False)} | ({order[0]: order[-1]} if order else {})
    spark = docs.sparkSession
    heads = spark.createDataFrame([(r["range"], r["first"], before[r["range"]]) for r in firsts], "head int, first long, prior int")
    extra = (dealt.join(F.broadcast(heads), (F.col("range") == F.col("head")) & F.col("id").eqNullSafe(F.col("first")))
             .groupBy("prior").agg(F.min(F.struct("text", "id")).alias("row"))
             .select(F.col("row.id").alias("id"), F.col("row.text").alias("text"), F.col("prior").alias("range"), F.lit(1).alias("extra")))
    return dealt.withColumn("extra", F.lit(0)).unionByName(extra), len(order)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint beside that of its edited text and its likeness to that and to the next row.

    The edited text's last floor(n/2) code points give way to the first as many of the next row
    by descending id (equal ids by text, null ids last, the first row after the last). Null
    texts count as empty; extra columns don't matter; an empty table gives an empty result. Ids are whole numbers
    of any width (TypeError otherwise).
    """
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col} must hold whole numbers, not {kind}")
    rows, parts = with_next(docs, id_col, text_col)

    def emit(ids: list, texts: list[str], follow: list[str]) -> pa.RecordBatch:
        edited = [t[:len(t) - len(t) // 2] + f[:len(t) // 2] for t, f in zip(texts, follow, strict=True)]
        raw = [t.encode() for t in edited]
        own = sketches(*_as_buffer([t.encode() for t in [*texts, follow[-1]]]))
        other = sketches(*_as_buffer(raw))
        mine = own[:-1]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
             pa.array(packed_hex(mine), pa.string()), pa.array(packed_hex(other), pa.string()), pa.array(likeness(mine, other)), pa.array(likeness(mine, own[1:]))],
            names=[id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of range and place; ``held`` waits for the row that follows it."""
        ids: list = []
        texts: list[str] = []
        size, at = 0, None
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                for i, t, r, x in zip(*(c.to_pylist() for c in batch.slice(k, 256).columns), strict=True):
                    if x:
                        if ids:
                            yield emit(ids, texts, [*texts[1:], t])
                        ids, texts, size = [], [], 0
                        continue
                    at = r
                    ids.append(i)
                    texts.append(t)
                    size += len(t)
                    if size > 2 << 20 and len(texts) > 1:
                        yield emit(ids[:-1], texts[:-1], texts[1:])
                        ids, texts, size = ids[-1:], texts[-1:], len(t)
        if ids:
            raise RuntimeError(f"range {at} has no following row")

    placed = (rows.repartition(max(1, parts), "range").sortWithinPartitions("range", "extra", F.col("id").desc_nulls_last(), "text"))
    return placed.select("id", "text", "range", "extra").mapInArrow(
        run, f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    ).withColumn(id_col, F.col(f"`{id_col}`").cast(kind))
