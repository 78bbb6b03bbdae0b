"""SimHash fingerprints and their near-duplicate classes found by BK-trees.

A fingerprint takes one bit per position from the majority of the 64-bit hashes of a text's
word shingles. Two fingerprints at most ``radius`` bits apart link. Linked pairs must agree on
at least two of five bit blocks when radius is 3 (radius + 2 blocks in general), so every
choice of two blocks and their value names a shard; each shard's fingerprints form a BK-tree
(children keyed by their integer Hamming distance to the parent) and a search follows only the
edges within the radius. Shards are dealt by key to the tasks, since the trees of a whole corpus
have no size bound under which they could be broadcast; a shard over ``shard_limit``
fingerprints is dealt once more on finer blocks, of which a linked pair shares one, so no
shard is cut and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import connected_components
from .textbatch import text_column

SHINGLE_WORDS = 3
RADIUS = 3
SHARD_LIMIT = 8192
_VOTES = 1 << 15


def fingerprint(raw: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned SimHash of one UTF-8 text; 0 for a text without words."""
    found = raw.lower().split()
    if not found:
        return 0
    k = shingle_words
    parts = [found[i:] for i in range(k)] if len(found) >= k else [[w] for w in found]
    n = max(1, len(found) - k + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, zip(*parts, strict=False)), repeat(42)),
                         dtype=np.uint64, count=n)
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _VOTES):
        part = hashes[at:at + _VOTES].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(votes * 2 > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, text_col: str = "text", shingle_words: int = SHINGLE_WORDS, fp_col: str = "fp") -> DataFrame:
    """``docs`` with ``fp_col``: each text's fingerprint as a signed long. Null text: 0."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_column(batch.column(at))
            data = memoryview(buf)
            fp = np.fromiter((fingerprint(bytes(data[offs[i]:offs[i + 1]]), shingle_words)
                              for i in range(len(offs) - 1)), dtype=np.uint64, count=len(offs) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp.view(np.int64))], names=[*batch.schema.names, fp_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, `{fp_col}` long")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``id_col, fp``: one row per document, the fingerprint as a signed long. Null text: 0."""
    return with_fingerprints(docs.select(id_col, text_col), text_col, shingle_words).drop(text_col)


class BKTree:
    """A BK-tree over 64-bit integers under Hamming distance."""

    def __init__(self, root: int):
        self.root: tuple[int, dict] = (root, {})

    def add(self, fp: int) -> None:
        node = self.root
        while d := (node[0] ^ fp).bit_count():
            child = node[1].get(d)
            if child is None:
                node[1][d] = (fp, {})
                return
            node = child

    def within(self, fp: int, radius: int) -> list[int]:
        found, todo = [], [self.root]
        while todo:
            held, edges = todo.pop()
            d = (held ^ fp).bit_count()
            if d <= radius:
                found.append(held)
            for e, child in edges.items():
                if d - radius <= e <= d + radius:
                    todo.append(child)
        return found


def shard_links(fps: list[int], radius: int) -> list[tuple[int, int]]:
    """Links of one shard's distinct fingerprints, thinned to a spanning forest of (fp, fp)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    tree, out = BKTree(fps[0]), []
    for fp in fps[1:]:
        for other in tree.within(fp, radius):
            a, b = root(fp), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((fp, other))
        tree.add(fp)
    return out


def _blocks(bits: int, n: int) -> list[tuple[int, int]]:
    """(shift, width) of ``n`` near-equal blocks of ``bits`` bits."""
    cuts = [bits * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _part(col, shift: int, width: int):
    return F.shiftrightunsigned(col, shift).bitwiseAND((1 << width) - 1)


def links(distinct: DataFrame, radius: int = RADIUS, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """``a, b``: fingerprint links (a spanning forest of every shard) of a table of distinct ``fp``."""
    blocks = _blocks(64, radius + 2)
    tables = []
    for t, pair in enumerate(combinations(range(radius + 2), 2)):
        key = F.xxhash64(F.lit(t), *[_part(F.col("fp"), *blocks[i]) for i in pair])
        rest, at = F.lit(0).cast("long"), 0
        for i in (i for i in range(radius + 2) if i not in pair):
            rest = rest.bitwiseOR(F.shiftleft(_part(F.col("fp"), *blocks[i]), at))
            at += blocks[i][1]
        tables.append(F.struct(key.alias("key"), rest.alias("rest")))
    keyed = distinct.select("fp", F.explode(F.array(*tables)).alias("t")).select("fp", "t.key", "t.rest")
    hot = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > shard_limit).select("key", F.lit(True).alias("hot"))
    finer = F.array(*[F.xxhash64("key", F.lit(j), _part(F.col("rest"), *b)) for j, b in enumerate(_blocks(39, radius + 1))])
    shards = (keyed.join(hot, "key", "left")
              .select("fp", F.explode(F.when(F.col("hot"), finer).otherwise(F.array("key"))).alias("shard")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def solve(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
            out = []
            for i in np.flatnonzero(np.diff(cuts) > 1):
                out += shard_links([x & (2**64 - 1) for x in f[cuts[i]:cuts[i + 1]].tolist()], radius)
            pairs = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy()])
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))  # the last shard may go on in the next batch
            if last:
                yield solve(keys[:last], fps[:last])
                keys, fps = keys[last:], fps[last:]
        if len(keys):
            yield solve(keys, fps)

    return (shards.select("shard", "fp").repartition("shard").sortWithinPartitions("shard", "fp")
            .mapInArrow(run, "a long, b long"))


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``id_col, fingerprint, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over fingerprint links (the smallest id that
    isn't null; null where a class has none). Null and word-free texts have fingerprint zero and
    link like any other; repeated rows stay, each with its class; extra columns don't matter; an
    empty table gives an empty result. Exact copies meet as one fingerprint before any search.
    """
    fps = written(fingerprints(docs, id_col, text_col, shingle_words), "simhash")
    rooted = fp_classes(fps, id_col, radius)
    named = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    label = written(rooted.join(named, "root").select("fp", "component_id"), "simhash-classes")
    return fps.join(label, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def fp_classes(fps: DataFrame, id_col: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``fp, rep, root``: every distinct fingerprint, its least id, and the fingerprint that names its class."""
    distinct = written(fps.groupBy("fp").agg(F.min(id_col).alias("rep")), "simhash-distinct")
    classes = connected_components(links(distinct.select("fp"), radius))
    return (distinct.join(classes.select(F.col("node").alias("fp"), "component"), "fp", "left")
            .select("fp", "rep", F.coalesce("component", "fp").alias("root")))
