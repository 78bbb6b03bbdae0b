"""Regression forests (Breiman, 2001) grown from histograms, one pass over grouped rows per level.

Features are cut into at most ``max_bins`` bins, as Spark ML's ``RandomForestRegressor`` does; rows of equal bins and
target then act alike, so they are counted once and travel as one row. A tree's bootstrap takes a row Poisson(1)
times, hence n equal rows Poisson(n) times: the drawn sample follows the same law, with one draw per group.
The draws are hashed from the group, so every pass repeats them and the forest doesn't depend on how rows are
partitioned. Where many groups share their bins, their drawn
sums are kept, at most two numbers per tree for every ``KEEP_FROM`` groups. Tasks hold one batch and one level's histogram; only summed histograms (trees × nodes × bins) and
the trees reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablens.functions.frames import long_form
from tablens.functions.quantiles import quantile_table
from tablens.session import materialize, ship_package

# The defaults of Spark ML's forests.
MAX_DEPTH = 5
MAX_BINS = 32
DRAWS_AT_ONCE = 500_000
GROUPS_PER_TASK = 250_000
# From so many groups per cell on, a cell's drawn sums are kept instead of being drawn anew for every level.
KEEP_FROM = 10


# ---------------------------------------------------------------- bins

def _few_values(batches: Iterator[pd.DataFrame], columns: list[str], most: int) -> Iterator[pd.DataFrame]:
    """A task's distinct values per column; one NULL stands for more than ``most``."""
    seen: dict[str, np.ndarray | None] = {c: np.empty(0) for c in columns}
    for b in batches:
        for c in columns:
            if seen[c] is not None:
                x = b[c].to_numpy(dtype=float)
                both = np.unique(np.concatenate([seen[c], x[~np.isnan(x)] + 0.0]))
                seen[c] = both if len(both) <= most else None
    for c in columns:
        yield pd.DataFrame({"column": c, "value": [None] if seen[c] is None else seen[c]}).astype({"value": float})


def cut_points(df: DataFrame, columns: Sequence[str], max_bins: int = MAX_BINS) -> dict[str, list[float]]:
    """Ascending cuts per column from all rows: midpoints of up to ``max_bins`` distinct values, else exact quantiles."""
    columns = list(columns)
    ship_package(df.sparkSession)
    x = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    few = x.mapInPandas(partial(_few_values, columns=columns, most=max_bins), "column string, value double")
    few = few.groupBy("column").agg(F.max(F.col("value").isNull() | F.isnan("value")).alias("many"),
                                    F.slice(F.sort_array(F.collect_set("value")), 1, max_bins + 1).alias("values"))
    cuts: dict[str, list[float]] = {c: [] for c in columns}
    many = []
    for r in few.collect():
        if r["many"] or len(r["values"]) > max_bins:
            many.append(r["column"])
        else:
            cuts[r["column"]] = [(a + b) / 2 for a, b in zip(r["values"], r["values"][1:])]
    if many:
        probs = {f"_q{i}": i / max_bins for i in range(1, max_bins)}
        for r in quantile_table(long_form(x, sorted(many)), ["column"], probs).collect():
            cuts[r["column"]] = sorted({r[q] for q in probs})
    return cuts


def bin_of(x: Column, cuts: Sequence[float], first: int = 0) -> Column:
    """Number of ``cuts`` below ``x`` by bisection; a value equal to a cut stays below it."""
    if not cuts:
        return F.lit(first)
    m = len(cuts) // 2
    return F.when(x <= F.lit(cuts[m]), bin_of(x, cuts[:m], first)).otherwise(bin_of(x, cuts[m + 1:], first + m + 1))


# ---------------------------------------------------------------- draws

def _uniform(hashes: np.ndarray, trees: int) -> np.ndarray:
    """Uniform numbers of every (group, tree) by the SplitMix64 finaliser."""
    with np.errstate(over="ignore"):
        z = hashes.astype(np.int64).view(np.uint64)[:, None] + np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)) * 2.0 ** -53


def _poisson(u: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Poisson(n) quantiles of ``u``, row by row; the table reaches 9 standard deviations and more, beyond double precision."""
    out = np.empty(u.shape)
    order = np.argsort(n, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(n[order])) + 1):
        mean = int(n[rows[0]])
        low = max(0, int(mean - 9 * mean ** 0.5 - 20))
        k = np.arange(low + 1, int(mean + 9 * mean ** 0.5 + 40))
        log_p = np.concatenate([[0.0], np.cumsum(np.log(mean) - np.log(k))])
        cdf = np.cumsum(np.exp(log_p - log_p.max()))
        out[rows] = low + np.minimum(np.searchsorted(cdf / cdf[-1], u[rows], side="right"), len(k))
    return out


# ---------------------------------------------------------------- trees

@dataclass
class Forest:
    """Trees as arrays ``[tree, node]``; node i has children 2i+1 and 2i+2, feature -1 marks a leaf."""
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Node of every (row of ``bins``, tree) after at most ``depth`` steps."""
        tree = np.arange(len(self.feature))
        rows = np.arange(len(bins))[:, None]
        at = np.zeros((len(bins), len(tree)), dtype=np.int64)
        for _ in range(depth):
            f = self.feature[tree, at]
            at = np.where(f < 0, at, 2 * at + 1 + (bins[rows, f] > self.cut[tree, at]))
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        """Mean of the trees' leaf values."""
        cells, of = np.unique(bins, axis=0, return_inverse=True)
        depth = int(np.log2(self.feature.shape[1] + 1)) - 1
        return self.value[np.arange(len(self.feature)), self.nodes(cells, depth)].mean(axis=1)[of.reshape(-1)]


def _drawn(b: pd.DataFrame, bins: list[str], trees: int, mean: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, drawn weight and sum of centred targets ``[cell, tree]``; rows come sorted by bins, a run of equal ones is one cell."""
    x = b[bins].to_numpy(dtype=np.int64)
    w = _poisson(_uniform(b["_h"].to_numpy(), trees), b["_n"].to_numpy())
    y = b["_target"].to_numpy(dtype=float) - mean
    start = np.concatenate([[0], np.flatnonzero((x[1:] != x[:-1]).any(axis=1)) + 1])
    return x[start], np.add.reduceat(w, start, axis=0), np.add.reduceat(w * y[:, None], start, axis=0)


def _chunks(batches: Iterator[pd.DataFrame], trees: int) -> Iterator[pd.DataFrame]:
    step = max(1, DRAWS_AT_ONCE // trees)
    for b in batches:
        for lo in range(0, len(b), step):
            yield b.iloc[lo:lo + step]


def _cells(batches: Iterator[pd.DataFrame], bins: list[str], trees: int, mean: float) -> Iterator[pd.DataFrame]:
    for b in _chunks(batches, trees):
        x, w, s = _drawn(b, bins, trees, mean)
        yield pd.DataFrame(dict(zip(bins, x.T)) | {"_w": list(w), "_s": list(s)})


def _histograms(batches: Iterator[pd.DataFrame], forest: Forest, level: int, tried: np.ndarray, bins: list[str],
                mean: float, max_bins: int) -> Iterator[pd.DataFrame]:
    """A task's (weight, sum of centred targets) per tree, node of ``level``, tried feature and bin."""
    trees, width, per_node = tried.shape
    size = tried.size * max_bins
    weight, total = np.zeros(size), np.zeros(size)
    for b in _chunks(batches, trees):
        if "_w" in b:
            x, w, s = b[bins].to_numpy(dtype=np.int64), np.stack(b["_w"].to_list()), np.stack(b["_s"].to_list())
        else:
            x, w, s = _drawn(b, bins, trees, mean)
        node = forest.nodes(x, level) - (width - 1)
        row, t = np.nonzero((node >= 0) & (w > 0))
        node, w, s = node[row, t], w[row, t], s[row, t]
        for j in range(per_node):
            at = ((t * width + node) * per_node + j) * max_bins + x[row, tried[t, node, j]]
            weight += np.bincount(at, w, size)
            total += np.bincount(at, s, size)
    at = np.flatnonzero(weight)
    yield pd.DataFrame({"at": at, "w": weight[at], "s": total[at]})


def fit_regression(train: DataFrame, bins: Sequence[str], target: str, mean: float, num_trees: int = 100, seed: int = 42,
                   max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS) -> Forest:
    """Grow ``num_trees`` trees on all rows of ``train``: integer ``bins`` columns and a number ``target`` (``mean``: its mean).

    As in Spark ML: variance gain, a third of the features tried at every node (all for a single tree),
    both sides of a split non-empty. A tree whose bootstrap is empty predicts ``mean``.
    """
    spark = train.sparkSession
    ship_package(spark)
    bins = list(bins)
    groups = train.select(*bins, F.col(target).cast("double").alias("_target")).groupBy(*bins, "_target") \
        .agg(F.count(F.lit(1)).alias("_n")).withColumn("_h", F.xxhash64(F.lit(seed), *bins, "_target"))
    groups = materialize(groups)
    # a task costs a histogram, so few groups go to few tasks
    n_groups = groups.count()
    parts = max(spark.sparkContext.defaultParallelism, -(-n_groups // GROUPS_PER_TASK))
    groups = materialize(groups.repartitionByRange(parts, *bins, "_target").sortWithinPartitions(*bins, "_target"))
    if KEEP_FROM * groups.select(*bins).distinct().count() <= n_groups:
        schema = ", ".join(f"`{c}` int" for c in bins) + ", _w array<double>, _s array<double>"
        groups = materialize(groups.mapInPandas(partial(_cells, bins=bins, trees=num_trees, mean=mean), schema))
    per_node = len(bins) if num_trees == 1 else -(-len(bins) // 3)
    nodes = 2 ** (max_depth + 1) - 1
    forest = Forest(np.full((num_trees, nodes), -1), np.zeros((num_trees, nodes), dtype=np.int64),
                    np.full((num_trees, nodes), float(mean)))
    rng = np.random.default_rng(seed)
    for level in range(max_depth):
        width = 2 ** level
        tried = rng.random((num_trees, width, len(bins))).argsort(axis=-1)[..., :per_node]
        task = partial(_histograms, forest=forest, level=level, tried=tried, bins=bins, mean=mean, max_bins=max_bins)
        sums = groups.mapInPandas(task, "at long, w double, s double").groupBy("at") \
            .agg(F.sum("w").alias("w"), F.sum("s").alias("s")).toPandas()
        hist = np.zeros((2, tried.size * max_bins))
        hist[:, sums["at"].to_numpy()] = sums[["w", "s"]].to_numpy().T
        if not _split(forest, level, tried, *hist.reshape(2, *tried.shape, max_bins), mean):
            break
    return forest


def _split(forest: Forest, level: int, tried: np.ndarray, weight: np.ndarray, total: np.ndarray, mean: float) -> bool:
    """Give every node of ``level`` its value and best split; whether any node was split."""
    trees, width, per_node = tried.shape
    w, s = weight[:, :, :1].sum(axis=-1, keepdims=True), total[:, :, :1].sum(axis=-1, keepdims=True)
    lw, ls = weight.cumsum(axis=-1)[..., :-1], total.cumsum(axis=-1)[..., :-1]
    rw, rs = w - lw, s - ls
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where((lw > 0) & (rw > 0), ls ** 2 / lw + rs ** 2 / rw - s ** 2 / w, 0.0).reshape(trees, width, -1)
    best = gain.argmax(axis=-1)
    t, i = np.nonzero(gain.max(axis=-1) > 0)
    j, at = np.divmod(best[t, i], lw.shape[-1])
    node = i + width - 1
    if level == 0:
        some = w[:, 0, 0, 0] > 0
        forest.value[some, 0] = mean + s[some, 0, 0, 0] / w[some, 0, 0, 0]
    forest.feature[t, node], forest.cut[t, node] = tried[t, i, j], at
    forest.value[t, 2 * node + 1] = mean + ls[t, i, j, at] / lw[t, i, j, at]
    forest.value[t, 2 * node + 2] = mean + rs[t, i, j, at] / rw[t, i, j, at]
    return len(t) > 0


def predicted(forest: Forest, bins: Sequence[str]) -> Column:
    """The forest's prediction as a column over the ``bins`` columns."""
    @F.pandas_udf("double")
    def predict(*x: pd.Series) -> pd.Series:
        return pd.Series(forest.predict(np.column_stack([v.to_numpy(dtype=np.int64) for v in x])) if len(x[0]) else np.empty(0))

    return predict(*[F.col(c) for c in bins])
