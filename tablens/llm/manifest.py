"""Merkle manifest of a table: a ternary hash tree per source, one over the sources, and proofs.

A leaf is the SHA-256 of a row's fields; a node is the SHA-256 of its one to three children's hex
digests. Trees are postorder append logs: aligned builders, each over up to 3^HEIGHT neighbouring
leaves, write nodes in the order in which they are completed, so that a builder's log is one
run of digests. Where a node lies in it follows in closed form from the sizes of the
subtrees before it (``log_position``), and so do the places of its siblings: proofs are read from the logs
by position. Builders' roots are the leaves of the next tier, until one remains.

Leaves ascend by id within a source (null first; rows that share an id by their leaf). A null field
counts as ``-``; equal rows are leaves of their own; a lone leaf is its source's root, and a lone
source's root is the root; an empty table gives an empty result. Fields may be of any type
that casts to a string; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, written

FANOUT = 3
HEIGHT = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SIZE = 32


def node_hash(digests: Sequence[bytes]) -> bytes:
    """The digest of a node: SHA-256 of its children's hex digests one after the other."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The binary digest of a row's fields: ``-`` for null, else byte count, ``:``, value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def height_of(leaves: int) -> int:
    """Levels above the leaves until a single node remains."""
    h = 0
    while leaves > 1:
        leaves, h = -(-leaves // FANOUT), h + 1
    return h


def build_log(leaves: Sequence[bytes], height: int) -> list[bytes]:
    """All nodes of a tree of ``height`` levels above its leaves, in the order in which they are completed."""
    log: list[bytes] = []
    pending: list[list[bytes]] = [[] for _ in range(height + 1)]

    def complete(level: int, digest: bytes) -> None:
        log.append(digest)
        pending[level].append(digest)
        if level < height and len(pending[level]) == FANOUT:
            done, pending[level] = pending[level], []
            complete(level + 1, node_hash(done))

    for leaf in leaves:
        complete(0, leaf)
    for level in range(height):
        if pending[level]:
            done, pending[level] = pending[level], []
            complete(level + 1, node_hash(done))
    return log


def log_position(level: int, index: int, leaves: int, height: int) -> int:
    """The place of node ``index`` of ``level`` in the log of a tree: how many nodes are completed before it.

    It is completed with leaf ``e`` of its subtree; up to its own level whole subtrees of the first ``e``
    leaves are there, and above it those of the leaves before the last.
    """
    e = min((index + 1) * FANOUT**level, leaves)
    at = -1
    for j in range(height + 1):
        span = FANOUT**j
        if j > level:
            at += (e - 1) // span
        else:
            at += -(-e // span) if e == leaves else e // span
    return at


def siblings(log: bytes, index: int, leaves: int, height: int) -> list[tuple[bytes, bytes]]:
    """For each level below the root the digests left and right of a leaf's ancestor in its run, read from a packed log."""
    out = []
    for level in range(height):
        width = -(-leaves // FANOUT**level)
        first = index - index % FANOUT
        near = [log[SIZE * p:SIZE * p + SIZE] for p in (log_position(level, k, leaves, height)
                                                      for k in range(first, min(first + FANOUT, width)) if k != index)]
        out.append((b"".join(near[:index - first]), b"".join(near[index - first:])))
        index //= FANOUT
    return out


def pack_path(path: Sequence[tuple[bytes, bytes]]) -> bytes:
    return b"".join(bytes([len(a) // SIZE, len(b) // SIZE]) + a + b for a, b in path)


def unpack_path(raw: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(raw):
        a, b = raw[at] * SIZE, raw[at + 1] * SIZE
        out.append((raw[at + 2:at + 2 + a], raw[at + 2 + a:at + 2 + a + b]))
        at += 2 + a + b
    return out


def fold(leaf: bytes, path: Sequence[tuple[bytes, bytes]]) -> bytes:
    """The root that follows from a leaf and its siblings."""
    for left, right in path:
        leaf = node_hash([left, leaf, right])
    return leaf


def ranked(rows: DataFrame, by: str | None, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their rank ``index`` (from 0) in each ``by`` by ``order``, which must be unique, and the number ``n``.

    Rows are dealt by ranges of (by, order), numbered within a range and moved by the number of rows before it.
    """
    group = [by] if by else []
    keys = [*group, *order]
    parts = written(rows.repartitionByRange(*keys).withColumn("_slice", F.spark_partition_id()), name)
    before = Window.partitionBy(*group).orderBy("_slice")
    counts = parts.groupBy(*group, "_slice").agg(F.count("*").alias("_c"))
    # One row per range of a source.
    counts = counts.select(F.col("_slice").alias("_s"), *[F.col(c).alias("_g") for c in group],
                           (F.sum("_c").over(before) - F.col("_c")).alias("_first"), F.sum("_c").over(Window.partitionBy(*group)).alias("n"))
    local = parts.withColumn("_local", F.row_number().over(Window.partitionBy("_slice", *group).orderBy(*order)) - 1)
    match = F.col("_slice") == F.col("_s")
    if by:
        match &= F.col(by).eqNullSafe(F.col("_g"))
    return local.join(counts, match).withColumn("index", F.col("_first") + F.col("_local")).drop("_slice", "_s", "_g", "_first", "_local")


def _builders(nodes: DataFrame, limit: int, name: str, carried: Sequence[str] = ()) -> DataFrame:
    """Logs of ``tree, index, n, digest``: a row ``tree, block, n, leaves, log, root`` per builder.

    ``carried`` columns of the leaves come as arrays in the leaves' order.
    """
    extra = {c: nodes.schema[c].dataType.simpleString() for c in carried}
    span = FANOUT**limit
    schema = "tree " + nodes.schema["tree"].dataType.simpleString() + ", block long, n long, leaves int, log binary, root binary"
    schema += "".join(f", {c} array<{t}>" for c, t in extra.items())

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("index").combine_chunks()
        n = table["n"][0].as_py()
        log = build_log(table["digest"].to_pylist(), _block_height(n, limit))
        cols = {"tree": table["tree"].slice(0, 1), "block": table["block"].slice(0, 1), "n": table["n"].slice(0, 1),
                "leaves": pa.array([table.num_rows], pa.int32()), "log": pa.array([b"".join(log)], pa.binary()), "root": pa.array([log[-1]], pa.binary())}
        for c in carried:
            values = table[c].combine_chunks()
            cols[c] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.table(cols)

    rows = nodes.select("tree", F.expr(f"index div {span}").alias("block"), "index", "n", "digest", *carried)
    return written(rows.groupBy("tree", "block").applyInArrow(build, schema), name)


def _tiers(nodes: DataFrame, limit: int, name: str, carried: Sequence[str] = ()) -> list[DataFrame]:
    """Builders of all tiers, lowest first; the last has one row per tree."""
    tiers = [_builders(nodes, limit, f"{name}-0", carried)]
    span = FANOUT**limit
    while True:
        top = tiers[-1]
        most = top.agg(F.max("n").alias("n")).first()["n"]
        if most is None or most <= span:
            return tiers
        above = top.where(F.col("n") > span).select("tree", F.col("block").alias("index"), F.expr(f"(n + {span - 1}) div {span}").alias("n"), F.col("root").alias("digest"))
        tiers.append(_builders(above, limit, f"{name}-{len(tiers)}"))


def _block_height(n: int, limit: int) -> int:
    """The levels of a builder's tree in a tier of ``n`` leaves."""
    return limit if n > FANOUT**limit else height_of(n)


def _paths(blocks: DataFrame, limit: int) -> DataFrame:
    """``tree, index, path`` of all leaves of builders that know their own ``path`` to the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                first = r["block"] * FANOUT**limit
                paths = [pack_path(siblings(r["log"], k, r["leaves"], _block_height(r["n"], limit))) + r["path"] for k in range(r["leaves"])]
                tree = pa.array([r["tree"]] * len(paths), batch.schema.field("tree").type)
                yield pa.RecordBatch.from_arrays([tree, pa.array(range(first, first + len(paths)), pa.int64()), pa.array(paths, pa.binary())], names=["tree", "index", "path"])

    kind = blocks.schema["tree"].dataType.simpleString()
    return blocks.select("tree", "block", "n", "leaves", "log", "path").mapInArrow(run, f"tree {kind}, index long, path binary")


def _with_path(tiers: list[DataFrame], tops: DataFrame, limit: int, name: str) -> DataFrame:
    """The lowest tier's builders with the ``path`` of each to the root; ``tops`` has ``tree, path`` of the trees' roots."""
    span = FANOUT**limit
    tops = tops.select(F.col("tree").alias("_t"), F.col("path"))
    known = None
    for k in reversed(range(len(tiers))):
        done = tiers[k].where(F.col("n") <= span).join(tops, F.col("tree").eqNullSafe(F.col("_t"))).drop("_t")
        if known is not None:
            above = written(_paths(known, limit), f"{name}-paths-{k}").select(F.col("tree").alias("_t"), F.col("index").alias("_b"), "path")
            part = tiers[k].where(F.col("n") > span).join(above, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("block") == F.col("_b")))
            done = done.unionByName(part.drop("_t", "_b"))
        known = done
    return known


@dataclass
class Manifest:
    """The logs of all builders: per tier of the sources' trees (``source_tiers``) and of the tree over them (``top_tiers``)."""

    source_tiers: list[DataFrame]
    top_tiers: list[DataFrame]
    sources: DataFrame
    root: bytes | None
    height: int


def build(docs: DataFrame, tampered: dict[str, Column] | None = None, fields: Sequence[str] = FIELDS, id_col: str = "doc_id",
          source_col: str = "source", height: int = HEIGHT) -> Manifest:
    """Builds the manifest, each builder over up to 3^``height`` leaves.

    ``tampered`` gives other values of fields, whose digest is kept beside each leaf (null if it is the same).
    """
    bounded_batches(docs.sparkSession)
    other = leaf_digest([(tampered or {}).get(c, F.col(c)) for c in fields])
    rows = docs.select(F.col(source_col).alias("tree"), F.col(id_col).alias("id"), leaf_digest([F.col(c) for c in fields]).alias("digest"),
                       other.alias("other")).withColumn("other", F.when(F.col("other") != F.col("digest"), F.col("other")))
    # Written once, so that the row number which tells equal rows apart stays.
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "manifest-leaves")
    leaves = ranked(rows, "tree", ["id", "digest", "_row"], "manifest-ranges").drop("_row")
    tiers = _tiers(leaves, height, "manifest-source", ["id", "other"])
    roots = [t.where(F.col("n") <= FANOUT**height).select("tree", "root") for t in tiers]
    subroots = roots[0]
    for r in roots[1:]:
        subroots = subroots.unionByName(r)
    sources = written(ranked(written(subroots, "manifest-subroots"), None, ["tree"], "manifest-sources"), "manifest-order")
    tops = _tiers(sources.select(F.lit(0).alias("tree"), "index", "n", F.col("root").alias("digest")), height, "manifest-top")
    root = tops[-1].select("root").first()
    return Manifest(tiers, tops, sources, bytes(root["root"]) if root else None, height)


def verify(docs: DataFrame, tampered: dict[str, Column] | None = None, fields: Sequence[str] = FIELDS, id_col: str = "doc_id",
           source_col: str = "source", height: int = HEIGHT) -> DataFrame:
    """``doc_id`` (as ``id_col``), ``leaf, subroot, root, proof_sha256, folded_root, verified``, hex digests, a row per row.

    ``proof_sha256`` digests all siblings from leaf to root; ``folded_root`` follows from the tampered leaf (else the
    leaf) and these siblings; ``verified`` tells whether it is the root.
    """
    m = build(docs, tampered, fields, id_col, source_col, height)
    one = docs.sparkSession.createDataFrame([(0, b"")], "tree int, path binary")
    tops = _paths(_with_path(m.top_tiers, one, height, "manifest-top"), height).select(F.col("index").alias("_i"), "path")
    paths = m.sources.select("tree", "index").join(tops, F.col("index") == F.col("_i")).select("tree", "path")
    blocks = _with_path(m.source_tiers, written(paths, "manifest-top-paths"), height, "manifest-source")
    subroots = m.sources.select(F.col("tree").alias("_t"), F.col("root").alias("subroot"))
    blocks = blocks.join(subroots, F.col("tree").eqNullSafe(F.col("_t")))
    root = m.root or b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i] for c in batch.schema.names}
                log, leaves, levels = r["log"].as_py(), r["leaves"].as_py(), _block_height(r["n"].as_py(), height)
                above, others = unpack_path(r["path"].as_py()), r["other"].as_py()
                upper = b"".join(a + b for a, b in above)
                subroot = r["subroot"].as_py().hex()
                cols: list[list] = [[] for _ in range(4)]
                for k in range(leaves):
                    path = siblings(log, k, leaves, levels)
                    at = SIZE * log_position(0, k, leaves, levels)
                    leaf = log[at:at + SIZE]
                    folded = fold(fold(others[k] or leaf, path), above)
                    proof = node_hash([*(a + b for a, b in path), upper])
                    for col, x in zip(cols, (leaf.hex(), proof.hex(), folded.hex(), folded == root), strict=True):
                        col.append(x)
                same = lambda x: pa.array([x] * leaves, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [r["id"].values, pa.array(cols[0], pa.string()), same(subroot), same(root.hex()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()),
                     pa.array(cols[3], pa.bool_())], names=[id_col, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (blocks.select("id", "n", "leaves", "log", "path", "other", "subroot")
            .mapInArrow(run, f"`{id_col}` {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"))
