"""Embedding near-dedup by product quantisation.

Exact copies meet first. Every distinct vector, scaled to length one, is stored in its nearest
coarse list with the codes of its residual's subspaces, and looks into the PROBES nearest
lists. There an asymmetric table lookup gives the distance to each stored code; what may lie
within the threshold, given the stored vector's own quantisation error, is compared by exact
cosine in double precision. So only the choice of lists can miss a pair: at a cosine of 0.9
about 3 pairs in 1000 on directions without structure, fewer above (tests measure it).

Lists and codebooks are fitted on a bounded sample (SAMPLE vectors); every vector is indexed.
Long lists are cut into blocks of bounded size, each pair of blocks a task's work on its own;
pairs never leave a block, only link counts and a spanning forest do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import connected_components

THRESHOLD = 0.9
SAMPLE = 20_000
PROBES = 24
MAX_LISTS = 16_384
SUBSPACES, CODES = 8, 64
MEMBERS, QUERIES = 2048, 4096
_STRIP = 256


def _kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres, 1)[:, 0]
        n = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, weights=x[:, j], minlength=len(centres)) for j in range(x.shape[1])], axis=1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres).astype(np.float32)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centres of each row, nearest first."""
    out = np.empty((len(x), min(k, len(centres))), dtype=np.int32)
    norms = (centres ** 2).sum(axis=1)
    for i in range(0, len(x), 2048):
        d = norms - 2 * (x[i:i + 2048] @ centres.T)
        if out.shape[1] < d.shape[1]:
            part = np.argpartition(d, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
        else:
            part = np.broadcast_to(np.arange(d.shape[1]), d.shape)
        order = np.argsort(np.take_along_axis(d, part, axis=1), axis=1, kind="stable")
        out[i:i + 2048] = np.take_along_axis(part, order, axis=1)
    return out


def _apart(x: np.ndarray, centres: np.ndarray, gap: float) -> np.ndarray:
    """Centres at least ``gap`` from each other, those of the largest lists first.

    So a dense group doesn't fall into many lists whose members all link with one another.
    """
    near = _nearest(x, centres, 1)[:, 0]
    order = np.argsort(-np.bincount(near, minlength=len(centres)), kind="stable")
    kept = np.empty((0, centres.shape[1]), dtype=centres.dtype)
    for c in order:
        if not len(kept) or ((kept - centres[c]) ** 2).sum(axis=1).min() >= gap * gap:
            kept = np.concatenate([kept, centres[c:c + 1]])
    return kept


def _spans(dim: int) -> list[slice]:
    cuts = [dim * i // min(SUBSPACES, dim) for i in range(min(SUBSPACES, dim) + 1)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


class Index:
    """Coarse centres and residual codebooks."""

    def __init__(self, sample: np.ndarray, lists: int, threshold: float = THRESHOLD):
        self.centres = _apart(sample, _kmeans(sample, lists), np.sqrt(2 - 2 * threshold))
        home = _nearest(sample, self.centres, 1)[:, 0]
        rest = sample - self.centres[home]
        self.books = [_kmeans(np.ascontiguousarray(rest[:, s]), CODES, seed=6 + i) for i, s in enumerate(_spans(sample.shape[1]))]

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Residual codes and the length of what they leave over."""
        codes = np.stack([_nearest(rest[:, s], b, 1)[:, 0] for s, b in zip(_spans(rest.shape[1]), self.books, strict=True)], axis=1)
        back = np.concatenate([b[codes[:, m]] for m, b in enumerate(self.books)], axis=1)
        return codes, np.sqrt(((rest - back) ** 2).sum(axis=1))


def _unit(raw: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double and in single precision, of vectors stored as ``kind``."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1)[:, None]  # the cosine stays; no square over- or underflows
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    return x, x.astype(np.float32)


def block_pairs(index: Index, place: int, queries: np.ndarray, members: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query rows, member rows) of all pairs of a block that reach the threshold by exact cosine."""
    centre = index.centres[place]
    codes, error = index.encode(members.astype(np.float32) - centre)
    reach = np.sqrt(2 - 2 * threshold) + error + 1e-3
    spans = _spans(queries.shape[1])
    for i in range(0, len(queries), _STRIP):
        rest = queries[i:i + _STRIP].astype(np.float32) - centre
        total = np.zeros((len(rest), len(members)), dtype=np.float32)
        for m, (s, book) in enumerate(zip(spans, index.books, strict=True)):
            part = rest[:, s]
            table = (part ** 2).sum(axis=1)[:, None] - 2 * part @ book.T + (book ** 2).sum(axis=1)
            total += np.take(table, codes[:, m], axis=1)
        q, y = np.nonzero(total <= reach ** 2)
        for j in range(0, len(q), 50_000):
            a, b = q[j:j + 50_000] + i, y[j:j + 50_000]
            near = np.einsum("ij,ij->i", queries[a], members[b]) >= threshold
            yield a[near], b[near]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row each of n rows reaches over the pairs (a, b)."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD,
                 sample: int = SAMPLE, probes: int = PROBES) -> DataFrame:
    """``id_col, n_links, component_id, kept`` for every row of ``vectors``.

    Rows link at a cosine of ``threshold`` or more, equal vectors included, with vectors of the same length; each
    length has an index of its own. Nothing links with a row whose vector is null, zero, empty or holds a
    null or non-finite component: such a row has no links and is its own class. A row with a null
    id links like any other; the class takes its least id that isn't null (null where there is none), and a null
    id isn't kept. Rows that repeat an id count like any other rows. Components are floats, or else
    read as doubles. Extra columns don't matter; an empty table gives an empty result.
    """
    element = vectors.schema[vec_col].dataType.elementType.simpleString()
    element, kind = ("float", "<f4") if element == "float" else ("double", "<f8")
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(f"array<{element}>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fit = F.coalesce((F.size("v") > 0) & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0), F.lit(False))
    good = base.where(fit)
    # Numbered once, as written: ids may repeat over different vectors.
    classes = written(good.groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("n"))
                      .withColumn("node", F.monotonically_increasing_id()), "vectors")
    lengths = classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect()  # one row per length
    if not lengths:
        return base.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                           F.col("id").isNotNull().alias("kept"))
    found = None
    for r in lengths:
        part = _links(classes.where(F.size("v") == r["d"]), r["n"], kind, threshold, sample, probes)
        found = part if found is None else found.unionByName(part)
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    groups = connected_components(found.select("a", "b"))
    rooted = written(classes.join(counts, "node", "left").join(groups, "node", "left")
                     .select("v", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                             F.coalesce("component", "node").alias("root")), "vector-classes")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    label = rooted.join(named, "root").select("v", "n_links", "component_id")
    linked = good.join(label, "v").select("id", "n_links", "component_id")
    alone = base.where(~fit).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id",
                                            F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _links(classes: DataFrame, distinct: int, kind: str, threshold: float, sample: int, probes: int) -> DataFrame:
    """``a, b, links``: a spanning forest and the link counts among ``distinct`` vectors of one length."""
    spark = classes.sparkSession
    lists = max(1, min(MAX_LISTS, int(4 * distinct ** 0.5)))
    # A bounded sample: SAMPLE vectors, or 16 per list where there are more lists than that serves.
    rows = classes.orderBy(F.xxhash64("v")).limit(max(sample, 16 * lists)).select("v").toArrow()
    index = Index(_unit([x.values.to_numpy().astype(kind).tobytes() for x in rows["v"]], kind)[1], lists, threshold)
    held = spark.sparkContext.broadcast(index)  # at most MAX_LISTS centres and SUBSPACES x CODES codewords

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(kind)
                raw = [x.tobytes() for x in flat.reshape(batch.num_rows, -1)]
                near = _nearest(_unit(raw, kind)[1], held.value.centres, probes)
                yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()), batch.column(1), batch.column(2), pa.array(list(near), pa.list_(pa.int32()))],
                                                 names=["v", "node", "n", "near"])

    placed = written(classes.select("v", "node", "n").mapInArrow(assign, "v binary, node long, n long, near array<int>"), "placed")
    sizes = placed.groupBy(F.col("near")[0].alias("list")).agg(F.count("*").alias("members"))
    looks = placed.select(F.explode("near").alias("list")).groupBy("list").agg(F.count("*").alias("queries"))
    cuts = sizes.join(looks, "list").select("list", F.ceil(F.col("members") / MEMBERS).cast("int").alias("m"),
                                            F.ceil(F.col("queries") / QUERIES).cast("int").alias("q"))
    cuts = F.broadcast(cuts)  # at most MAX_LISTS rows
    part = lambda name: F.pmod(F.xxhash64("node"), F.col(name)).cast("int")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    member = (placed.withColumn("list", F.col("near")[0]).join(cuts, "list")
              .select("list", part("m").alias("mc"), every("q").alias("qc"), F.lit(0).alias("side"), "node", "n", "v", "near"))
    query = (placed.withColumn("list", F.explode("near")).join(cuts, "list")
             .select("list", every("m").alias("mc"), part("q").alias("qc"), F.lit(1).alias("side"), "node", "n", "v",
                     F.array(F.col("near")[0]).alias("near")))

    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        """One block: members first. Pairs that two blocks see count in the one of the lower list."""
        k = sum(r[3] == 0 for r in rows)
        if not 0 < k < len(rows):
            return None
        place = rows[0][0]
        x, _ = _unit([r[6] for r in rows], kind)
        node, n = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
        home = np.array([r[7][0] for r in rows[k:]])
        seen = np.zeros((k, len(held.value.centres)), dtype=bool)
        for i, r in enumerate(rows[:k]):
            seen[i, r[7]] = True
        links = np.zeros(len(rows), dtype=np.int64)
        left, right = [], []
        for a, b in block_pairs(held.value, place, x[k:], x[:k], threshold):
            both = seen[b, home[a]]
            mine = np.where(both, np.where(home[a] == place, node[k + a] < node[b], place < home[a]), True) & (node[k + a] != node[b])
            a, b = a[mine] + k, b[mine]
            links += np.bincount(a, weights=n[b], minlength=len(rows)).astype(np.int64) + np.bincount(b, weights=n[a], minlength=len(rows)).astype(np.int64)
            left.append(a)
            right.append(b)
        # A vector may be both member and query here: its rows count as one.
        _, one = np.unique(node, return_inverse=True)
        a, b = (one[np.concatenate(z)] if z else np.zeros(0, np.int64) for z in (left, right))
        names = np.unique(node)
        root = names[_forest(len(names), a, b)]
        keep = np.flatnonzero(np.bincount(one, weights=links, minlength=len(names)) > 0)
        total = np.bincount(one, weights=links, minlength=len(names)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(names[keep]), pa.array(root[keep]), pa.array(total[keep])], names=["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(8)), strict=True):
                if rows and row[:3] != rows[0][:3]:
                    out = solve(rows)
                    rows = []
                    if out is not None:
                        yield out
                rows.append(row)
        out = solve(rows) if rows else None
        if out is not None:
            yield out

    return written(member.unionByName(query).repartition("list", "mc", "qc").sortWithinPartitions("list", "mc", "qc", "side", "node")
                   .mapInArrow(run, "a long, b long, links long"), "vector-links")
