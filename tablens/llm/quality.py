"""Quality classifier: hashed word n-gram logistic regression trained with FTRL-proximal updates.

A document's features are its word unigrams and bigrams and the uni-, bi- and trigrams of its
words' shapes (letter case, digits, symbols, length class, repetition of one of the last words),
all hashed into 2^BITS slots; a feature counts its occurrences over the square root of the
number of words. Scores are sparse dot products. The model is fitted on a sample of at most
SAMPLE labelled rows; scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import LOWER, cut, hash_spans, mix, slices, text_column, words

BITS = 18
SCORE_SLICE = 1 << 20
SAMPLE = 8000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.2, 1.0, 0.02, 1e-4
_A = np.uint64(0x9E3779B97F4A7C15)


def _has(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flagged bytes each span holds."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[ends] - total[starts]


_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[ord("A"):ord("Z") + 1] = 1
_KINDS[ord("0"):ord("9") + 1] = 2
_KINDS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 3


def features(chunk: np.ndarray, offs: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all features of a padded chunk, the document of each, and words per document."""
    starts, ends, first = words(chunk, offs)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    word = hash_spans(LOWER[chunk], starts, ends, 1)
    kind = _KINDS[chunk[:offs[-1]]]
    size = ends - starts
    upper, digit, symbol = (_has(kind == k, starts, ends) for k in (1, 2, 3))
    level = lambda x: (x > 0) * 1 + (x * 2 > size) * 1 + (x >= size) * 1
    shape = level(upper) + 4 * level(digit) + 16 * level(symbol) + 64 * np.minimum(size // 4, 5) + 512 * np.minimum(symbol, 3)
    for back in (1, 2, 4):
        same = np.zeros(len(word), dtype=np.int64)
        same[back:] = (word[back:] == word[:-back]) & (doc[back:] == doc[:-back])
        shape = shape * 2 + same
    shape = mix(shape.astype(np.uint64) + _A)
    out, docs = [word, shape], [doc, doc]
    for h, most in ((word, 2), (shape, 3)):
        gram = h
        for k in range(1, most):
            gram = mix(gram[:-1] * _A + h[k:])
            inside = doc[k:] == doc[:-k] if k else slice(None)
            out.append(gram[inside] + np.uint64(k))
            docs.append(doc[k:][inside])
    return (np.concatenate(out) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(docs), n


def fit(texts: list[bytes], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """FTRL-proximal weights (2^bits, then the intercept), one document per update."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(at):
        zz = z[at]
        w = -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zz) <= L1, 0.0, w)

    rows = []
    for raw in texts:
        chunk, offs = cut(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 0, 1)
        slots, _, size = features(chunk, offs, bits)
        at, count = np.unique(slots, return_counts=True)
        # Narrow types: the whole sample is held.
        rows.append((at.astype(np.int32), count.astype(np.min_scalar_type(count.max(initial=0))), np.sqrt(max(1, size[0]))))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, count, root = rows[i]
            at, x = np.append(at, 1 << bits), np.append(count / root, 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - labels[i]) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(len(z)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, limit: int, id_col: str = "doc_id",
                    text_col: str = "text", balanced: bool = False) -> DataFrame:
    """``text, label`` of at most ``limit`` labelled documents, chosen by the hash of their id.

    Ids with no label or with both labels give none; a repeated id counts once, with its
    smallest text. ``balanced`` takes up to half of the limit of either label.
    """
    one = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col)
           .agg(F.min(label_col).alias("label"), F.max(label_col).alias("other")).where("label = other")
           .select(F.col(id_col).alias("id"), "label"))
    parts = [(one, limit)] if not balanced else [(one.where(f"label = {v}"), limit // 2) for v in (0, 1)]
    picked = None
    for part, most in parts:
        ids = part.orderBy(F.xxhash64("id"), "id").limit(most)
        picked = ids if picked is None else picked.union(ids)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    # At most ``limit`` ids and labels are broadcast.
    return (texts.join(F.broadcast(picked), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
            .select("id", "text", "label"))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text", bits: int = BITS) -> np.ndarray:
    """Fits the classifier in one task on at most ``sample`` labelled rows; 2^bits + 1 weights return."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        marks: list[int] = []
        for batch in batches:
            texts += [t.encode() for t in batch.column(0).to_pylist()]
            marks += batch.column(1).to_pylist()
        w = fit(texts, np.array(marks, dtype=np.float64), bits)
        yield pa.RecordBatch.from_arrays([pa.array([w.astype(np.float32).tobytes()], pa.binary())], names=["w"])

    rows = labelled_sample(docs, labels, label_col, sample, id_col, text_col)
    got = (rows.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id").select("text", "label")
           .mapInArrow(run, "w binary").first())
    return np.frombuffer(got["w"], np.float32).astype(np.float64) if got else np.zeros((1 << bits) + 1)


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` in 0..1: the sparse dot product of every whole text, squashed.

    Null and empty texts score the intercept alone; every row keeps its columns (one named
    ``score_col`` is replaced); an empty table gives an empty result.
    """
    docs = docs.drop(score_col)
    at, bits = docs.columns.index(text_col), int(len(weights) - 1).bit_length() - 1
    model = docs.sparkSession.sparkContext.broadcast(weights)  # 2^bits + 1 doubles, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            buf, offs = text_column(batch.column(at))
            out = [np.zeros(0)]
            for i, j in slices(offs, SCORE_SLICE):
                slots, doc, size = features(*cut(buf, offs, i, j), bits)
                total = np.bincount(doc, weights=w[slots], minlength=j - i) / np.sqrt(np.maximum(size, 1))
                out.append(1 / (1 + np.exp(-np.clip(total + w[-1], -35, 35))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out))], names=[*batch.schema.names, score_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, `{score_col}` double")
