"""Many k-means models in one sweep over the data.

Rows are packed once into blocks of up to ``BLOCK_ROWS`` vectors, kept in memory or on disk. A Lloyd pass
reads the blocks once for all models that still move: a task adds up sums, counts and costs of every model;
only these leave it, and are added up in tasks, so that one row a pass reaches the driver. So an
elbow curve costs as many passes as its slowest model, whatever the number of models. Blocks are dealt
over the cores where the scan leaves them in few tasks.

Starts come from k-means++ on one sample of at most ``SAMPLE_ROWS`` rows (all rows where there are no more);
every pass reads all rows. A centre that loses all its rows stays where it is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablens.session import materialize, ship_package

BLOCK_ROWS = 4096
SAMPLE_ROWS = 8192
TOLERANCE = 1e-4
MAX_ITER = 300
# Partial sums are first added in so many groups of tasks, then in one.
GROUPS = 16
# Up to so many columns sums are counted up per column, beyond it multiplied.
COUNTED_COLUMNS = 8


@dataclass
class Model:
    """Centres (k x columns), the sum of squared distances to the nearest, and the passes made."""

    centers: np.ndarray
    cost: float
    passes: int


def pack_blocks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``block, n, data``: the rows' ``columns`` (complete, finite) as packed doubles."""
    ship_package(df.sparkSession)
    dims = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype("<f8") if dims else np.zeros((batch.num_rows, 0))
            parts = [x[i:i + BLOCK_ROWS] for i in range(0, len(x), BLOCK_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array([len(p) for p in parts], pa.int32()), pa.array([np.ascontiguousarray(p).tobytes() for p in parts], pa.binary())], names=["n", "data"])

    packed = materialize(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(run, "n int, data binary"))
    blocks = packed.withColumn("block", F.monotonically_increasing_id())
    busiest, held = packed.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    spread = min(held or 0, max(packed.rdd.getNumPartitions(), 2 * df.sparkSession.sparkContext.defaultParallelism))
    if held and busiest > 2 * -(-held // spread):
        blocks = blocks.repartition(spread)
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)


def sample_rows(blocks: DataFrame, dims: int, seed: int, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """At most ``rows`` rows, each with the same chance, the same for the same blocks and seed.

    The rows with the least draws; only draws below a share that holds a few more than ``rows`` of them are collected.
    """
    held = blocks.agg(F.sum("n")).first()[0] or 0
    share = min(1.0, (rows + 8.0 * rows ** 0.5 + 16) / max(held, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, n, data in zip(batch["block"].to_pylist(), batch["n"].to_pylist(), batch["data"].to_pylist(), strict=True):
                draw = np.random.default_rng([seed, block]).random(n)
                at = np.flatnonzero(draw < share)
                x = np.frombuffer(data, "<f8").reshape(n, dims)
                yield pa.RecordBatch.from_arrays([pa.array(draw[at]), pa.array([x[i].tobytes() for i in at], pa.binary())], names=["draw", "x"])

    while True:
        got = blocks.select("block", "n", "data").mapInArrow(run, "draw double, x binary").collect()  # rows and a few more
        if len(got) >= min(rows, held):
            break
        share = min(1.0, 2 * share)
    got = sorted((r["draw"], bytes(r["x"])) for r in got)[:rows]
    return np.array([np.frombuffer(x, "<f8") for _, x in got]).reshape(len(got), dims)


def plus_plus(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ starts: each next centre is drawn with the squared distance to those there are."""
    rng = np.random.default_rng(seed)
    centers = [sample[rng.integers(len(sample))]]
    near = ((sample - centers[0]) ** 2).sum(axis=1)
    for _ in range(1, k):
        total = near.sum()
        at = rng.choice(len(sample), p=near / total) if total > 0 else rng.integers(len(sample))
        centers.append(sample[at])
        near = np.minimum(near, ((sample - sample[at]) ** 2).sum(axis=1))
    return np.array(centers)


def _nearest(x: np.ndarray, centers: np.ndarray, square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each column of ``x`` (columns x rows), the first among equals, and its squared distance less the row's own square."""
    far = centers @ x
    far *= -2.0
    far += square[:, None]
    at, best = np.zeros(x.shape[1], np.intp), far[0]
    for j in range(1, len(far)):
        np.copyto(at, j, where=far[j] < best)
        np.minimum(best, far[j], out=best)
    return at, best


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for t in batch["total"]:
            part = np.frombuffer(t.as_buffer(), "<f8")
            total = part.copy() if total is None else np.add(total, part, out=total)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])


def _sweep(blocks: DataFrame, dims: int, centers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass: sums (all centres x dims), counts and the cost of every model."""
    spark = blocks.sparkSession
    sizes = [len(c) for c in centers]
    cuts = np.cumsum([0, *sizes])
    held = spark.sparkContext.broadcast(np.vstack(centers))  # all centres

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = held.value
        square = (c * c).sum(axis=1)
        sums, counts, costs = np.zeros(c.shape), np.zeros(len(c)), np.zeros(len(sizes))
        for batch in batches:
            for n, data in zip(batch["n"].to_pylist(), batch["data"].to_pylist(), strict=True):
                x = np.frombuffer(data, "<f8").reshape(n, dims)
                across = np.ascontiguousarray(x.T)
                own = (x * x).sum(axis=1)
                for m, k in enumerate(sizes):
                    span = slice(cuts[m], cuts[m + 1])
                    at, best = _nearest(across, c[span], square[span])
                    costs[m] += np.maximum(own + best, 0.0).sum()
                    counts[span] += np.bincount(at, minlength=k)
                    if dims <= COUNTED_COLUMNS:
                        for d in range(dims):
                            sums[span, d] += np.bincount(at, weights=across[d], minlength=k)
                    else:
                        sums[span] += (at == np.arange(k)[:, None]).astype(np.float64) @ x
        total = np.concatenate([sums.ravel(), counts, costs]).astype("<f8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.binary())], names=["total"])

    parts, tasks = blocks.select("n", "data").mapInArrow(add, "total binary"), blocks.rdd.getNumPartitions()
    if tasks > GROUPS:
        parts = parts.repartition(GROUPS).mapInArrow(_sum_rows, "total binary")
    if tasks > 1:
        parts = parts.repartition(1).mapInArrow(_sum_rows, "total binary")
    rows = parts.collect()  # one row
    held.destroy()
    total = sum((np.frombuffer(r["total"], "<f8") for r in rows), np.zeros(cuts[-1] * (dims + 1) + len(sizes)))
    edge = cuts[-1] * dims
    return total[:edge].reshape(-1, dims), total[edge:edge + cuts[-1]], total[edge + cuts[-1]:]


def lloyd(blocks: DataFrame, dims: int, starts: Sequence[np.ndarray], max_iter: int = MAX_ITER, tol: float = 0.0) -> list[Model]:
    """Moves the centres of all models until their squared shift is at most ``tol`` (or after ``max_iter`` passes)."""
    centers = [np.array(s, dtype=np.float64) for s in starts]
    passes = [0] * len(centers)
    moving = list(range(len(centers)))
    for _ in range(max_iter):
        if not moving:
            break
        sums, counts, _ = _sweep(blocks, dims, [centers[m] for m in moving])
        at, still = 0, []
        for m in moving:
            k = len(centers[m])
            n, s = counts[at:at + k, None], sums[at:at + k]
            moved = np.where(n > 0, s / np.maximum(n, 1), centers[m])
            shift = ((moved - centers[m]) ** 2).sum()
            centers[m], passes[m], at = moved, passes[m] + 1, at + k
            if shift > tol:
                still.append(m)
        moving = still
    _, _, costs = _sweep(blocks, dims, centers)
    return [Model(c, float(x), p) for c, x, p in zip(centers, costs, passes, strict=True)]


def fit_models(df: DataFrame, columns: Sequence[str], sizes: Sequence[int], starts: int, seed: int, max_iter: int = MAX_ITER) -> dict[int, Model]:
    """The best model (least cost, then least start) of each number of clusters, all fitted together."""
    dims = len(columns)
    blocks = pack_blocks(df, columns)
    try:
        sample = sample_rows(blocks, dims, seed)
        if not len(sample):
            return {}
        specs = [(k, s) for k in sizes for s in range(starts if k > 1 else 1)]
        first = [plus_plus(sample, k, seed + s) for k, s in specs]
        scale = float(sample.var(axis=0).mean()) if dims else 0.0
        fits = lloyd(blocks, dims, first, max_iter, TOLERANCE * scale)
        best: dict[int, Model] = {}
        for (k, _), m in zip(specs, fits, strict=True):
            if k not in best or m.cost < best[k].cost:
                best[k] = m
        return best
    finally:
        blocks.unpersist()


def assign(df: DataFrame, columns: Sequence[str], key: Sequence[str], centers: np.ndarray) -> DataFrame:
    """``(key..., cluster)``: the nearest centre of each row, the first among equals."""
    ship_package(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(centers)
    keys = len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = held.value
        square = (c * c).sum(axis=1)
        for batch in batches:
            x = np.column_stack([col.to_numpy(zero_copy_only=False) for col in batch.columns[keys:]])
            at = (square - 2 * (x @ c.T)).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:keys], pa.array(at.astype(np.int32))], names=[*batch.schema.names[:keys], "cluster"])

    rows = df.select(*key, *[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)])
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in key)
    return rows.mapInArrow(run, f"{fields}, cluster int")


def cluster_distances(rows: DataFrame, points: np.ndarray, number: dict) -> np.ndarray:
    """Sums of Euclidean distances from each of ``points`` to the rows ``cluster, x`` of every cluster (points x clusters)."""
    ship_package(rows.sparkSession)
    held = rows.sparkSession.sparkContext.broadcast((points, number))  # a bounded sample
    dims = points.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        p, code = held.value
        total = np.zeros((len(p), len(code)))
        step = max(1, (1 << 20) // len(p))
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            c = np.array([code[v] for v in batch.column(0).to_pylist()], dtype=np.int64)
            for i in range(0, len(x), step):
                far = np.zeros((len(p), len(x[i:i + step])))
                for d in range(dims):
                    diff = p[:, d, None] - x[None, i:i + step, d]
                    far += diff * diff
                hot = np.zeros((far.shape[1], len(code)))
                hot[np.arange(far.shape[1]), c[i:i + step]] = 1.0
                total += np.sqrt(far) @ hot
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % GROUPS], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "total"])

    def merge(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(t, "<f8") for t in table["total"].to_pylist())
        return pa.table({"part": table["part"].slice(0, 1), "total": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(add, "part int, total binary").groupBy("part").applyInArrow(merge, "part int, total binary").collect()  # at most GROUPS rows
    return sum((np.frombuffer(r["total"], "<f8") for r in parts), np.zeros(len(points) * len(number))).reshape(len(points), len(number))
