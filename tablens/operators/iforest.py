"""Isolation forest (Liu, Ting & Zhou, 2008) as a Spark job.

* subsampling: every row draws, per tree, a hash of ``(seed, tree, key)``; a row
  joins a tree's candidate set when the hash falls under a rate that yields about
  twice the subsample size, and each tree keeps its ``max_samples`` smallest hashes
  (``row_number`` ≤ ψ, planned as a partial WindowGroupLimit). No row is copied to
  all trees and no tree sees more than ψ rows;
* growing: ``groupBy(tree).applyInPandas`` builds each tree from its ≤ ψ rows (random
  feature, random split between min and max, height limit ⌈log₂ ψ⌉);
* scoring: the node table (≤ trees × 2ψ rows) is broadcast to a vectorised
  ``mapInPandas`` that walks all trees for a batch of rows at once;
* threshold: the exact ``1 − contamination`` quantile of the scores.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablens.functions.frames import as_list
from tablens.functions.joins import attach
from tablens.functions.quantiles import quantile_table

# Forest defaults.
N_TREES = 100
MAX_SAMPLES = 256
CONTAMINATION = 0.05
SEED = 42
EULER_GAMMA = 0.5772156649015329
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size long, depth int"


def _c(n):
    """Average path length of an unsuccessful BST search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


# Rows walked at once, so that their positions stay in the processor's cache.
WALK_ROWS = 8192


def _tree_arrays(nodes: pd.DataFrame) -> list:
    """Per tree, by node id: feature, threshold, both children in turn (a leaf's are itself), path length with the c(size) correction; and the depth."""
    out = []
    for _, g in nodes.groupby("tree"):
        g = g.set_index("node").sort_index()
        feat, left, right, depth = (g[c].to_numpy(dtype=np.intp) for c in ("feature", "left", "right", "depth"))
        leaf, own = feat < 0, np.arange(len(g))
        kids = np.column_stack([np.where(leaf, own, left), np.where(leaf, own, right)]).ravel()
        out.append((np.where(leaf, 0, feat), g["threshold"].to_numpy(dtype=float), kids, depth + _c(g["size"].to_numpy()), int(depth.max())))
    return out


def _mean_path(X: np.ndarray, trees: list) -> np.ndarray:
    """Average path length (with the c(size) leaf correction) of every row over all trees."""
    total = np.zeros(len(X))
    for lo in range(0, len(X), WALK_ROWS):
        x = np.ascontiguousarray(X[lo:lo + WALK_ROWS])
        flat, start = x.ravel(), np.arange(len(x)) * x.shape[1]
        for feat, thr, kids, path, levels in trees:
            pos = np.zeros(len(x), dtype=np.intp)
            for _ in range(levels):
                stay = flat.take(start + feat.take(pos)) < thr.take(pos)
                pos = kids.take(2 * pos + ~stay)
            total[lo:lo + WALK_ROWS] += path.take(pos)
    return total / max(len(trees), 1)


def _grow(features: list[str], max_depth: int, seed: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        X = pdf[features].to_numpy(dtype=float)
        nodes = []
        stack = [(0, np.arange(len(X)), 0)]
        next_id = 1
        while stack:
            nid, idx, depth = stack.pop()
            sub = X[idx]
            if depth >= max_depth or len(idx) <= 1:
                nodes.append((tree, nid, -1, 0.0, -1, -1, len(idx), depth))
                continue
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            cand = np.flatnonzero(hi > lo)
            if cand.size == 0:
                nodes.append((tree, nid, -1, 0.0, -1, -1, len(idx), depth))
                continue
            f = int(rng.choice(cand))
            thr = float(rng.uniform(lo[f], hi[f]))
            left, right = next_id, next_id + 1
            next_id += 2
            nodes.append((tree, nid, f, thr, left, right, len(idx), depth))
            mask = sub[:, f] < thr
            stack.append((left, idx[mask], depth + 1))
            stack.append((right, idx[~mask], depth + 1))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "size", "depth"])
    return grow


def pool_rate(n: float, psi: float, n_trees: int) -> float:
    """The share of n rows in the common pool: twice the rows that all trees need, at most all."""
    return min(1.0, 2.0 * n_trees * psi / n)


def _picked(df: DataFrame, key: list[str], n, psi, n_trees: int, seed: int) -> DataFrame:
    """Rows drawn for the trees (about 2ψ each, more than enough to keep ψ), with their ``tree``.

    One hash per row draws a pool of about 2·trees·ψ rows, whatever n is (the rate is a double,
    so it holds for any n); only pool rows are hashed once more per tree.
    """
    fraction = lambda h: h.cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)
    cols = [F.col(k) for k in key]
    need = F.lit(2.0 * n_trees) * psi
    pool = df.filter(fraction(F.xxhash64(F.lit(seed + 7), *cols)) < F.least(F.lit(1.0), need / n))
    rate = F.least(F.lit(1.0), 2.0 * psi / F.least(n, need))
    trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
    return pool.withColumn("tree", F.explode(F.filter(trees, lambda t: fraction(F.xxhash64(F.lit(seed), t, *cols)) < rate)))


def anomaly_record(scored: DataFrame, group=None) -> DataFrame:
    """Rows, flagged rows and share, and the least and greatest decision value (per group)."""
    group = as_list(group)
    return scored.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("is_outlier").alias("n_flagged"),
        (F.count_if("is_outlier") * 100.0 / F.count(F.lit(1))).alias("flagged_pct"),
        F.min("decision").alias("min_decision"), F.max("decision").alias("max_decision"))


def fit_forest(df: DataFrame, columns: Sequence[str], key, n_trees: int = N_TREES,
               max_samples: int = MAX_SAMPLES, seed: int = SEED) -> tuple[DataFrame, int]:
    """Grow the forest; returns the node table and the subsample size ψ."""
    from pyspark.sql import Window
    from tablens.session import ship_package
    ship_package(df.sparkSession)
    key = as_list(key)
    n = df.count()
    psi = int(min(max_samples, n))
    picked = _picked(df.select(*key, *columns), key, F.lit(float(max(n, 1))), F.lit(float(psi)), n_trees, seed)
    picked = picked.withColumn("_h", F.xxhash64(F.lit(seed + 1), F.col("tree"), *[F.col(k) for k in key]))
    w = Window.partitionBy("tree").orderBy("_h", *key)
    sample = picked.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= psi)
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    nodes = sample.select("tree", *columns).groupBy("tree").applyInPandas(
        _grow(list(columns), max_depth, seed), NODE_SCHEMA)
    from tablens.session import materialize
    return materialize(nodes), psi


def score(df: DataFrame, nodes: DataFrame, columns: Sequence[str], key, psi: int) -> DataFrame:
    """Anomaly score ``2^(−E[h(x)]/c(ψ))`` per row: ``(key..., anomaly_score)``."""
    from tablens.session import ship_package
    ship_package(df.sparkSession)
    key = as_list(key)
    table = nodes.toPandas()  # bounded: ≤ trees × 2ψ rows
    bc = df.sparkSession.sparkContext.broadcast(table)
    cpsi = float(_c([psi])[0])
    cols = list(columns)

    def walk(it):
        trees = _tree_arrays(bc.value)
        for pdf in it:
            out = pdf[key].copy()
            out["anomaly_score"] = np.power(2.0, -_mean_path(pdf[cols].to_numpy(dtype=float), trees) / cpsi)
            yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*key).schema.fields)
    # Walking costs more than dealing the rows over the cores, and a small file is one task of the scan.
    rows = df.select(*key, *cols).repartition(2 * df.sparkSession.sparkContext.defaultParallelism)
    return rows.mapInPandas(walk, f"{schema}, anomaly_score double")


def isolation_forest(df: DataFrame, columns: Sequence[str], key, contamination: float = CONTAMINATION,
                     n_trees: int = N_TREES, max_samples: int = MAX_SAMPLES, seed: int = SEED,
                     standardise: bool = True, min_rows: int = 10) -> DataFrame:
    """Flag the ``contamination`` share of rows with the highest anomaly score.

    Returns ``(key..., anomaly_score, decision, is_outlier)`` for every complete row, with
    ``decision = threshold − score`` (negative = outlier). ``standardise`` scales the
    columns by mean and population std first.
    """
    from tablens.operators.cleaning import complete_cases
    from tablens.operators.ml import standardize
    key = as_list(key)
    columns = list(columns)
    data = standardize(df, columns, key) if standardise else complete_cases(df.select(*key, *columns), columns)
    if data.limit(min_rows).count() < min_rows:
        return data.sparkSession.createDataFrame([], data.select(*key).schema.simpleString()[7:-1]
                                                 + ", anomaly_score double, decision double, is_outlier boolean")
    nodes, psi = fit_forest(data, columns, key, n_trees, max_samples, seed)
    s = score(data, nodes, columns, key, psi)
    from tablens.session import materialize
    s = materialize(s)
    thr = quantile_table(s.select(F.col("anomaly_score").alias("value")), [],
                         {"threshold": 1.0 - contamination}).select("threshold")
    j = s.crossJoin(F.broadcast(thr))
    return j.select(*key, "anomaly_score", (F.col("threshold") - F.col("anomaly_score")).alias("decision"),
                    (F.col("anomaly_score") > F.col("threshold")).alias("is_outlier"))


SLICE_ROWS = 1_000_000


def isolation_forest_by_group(df: DataFrame, columns: Sequence[str], key, group,
                              contamination: float = CONTAMINATION, n_trees: int = N_TREES,
                              max_samples: int = MAX_SAMPLES, seed: int = SEED,
                              slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One isolation forest per group (raw columns, complete rows), flags per group.

    Trees are keyed by (group, tree) with a per-group subsample rate; scoring cogroups
    slices of each group's rows (``hash(key) mod slices``, about ``slice_rows`` rows each)
    with that group's trees replicated per slice, so neither a large group nor the
    number of groups concentrates in one task. The threshold is the exact per-group
    ``1 − contamination`` quantile. Returns ``(group..., key..., anomaly_score, decision, is_outlier)``.
    """
    from pyspark.sql import Window

    from tablens.operators.cleaning import complete_cases
    from tablens.session import materialize, ship_package
    ship_package(df.sparkSession)
    key, group, columns = as_list(key), as_list(group), list(columns)
    data = complete_cases(df.select(*group, *key, *columns), columns)
    for g in group:
        data = data.filter(F.col(g).isNotNull())
    sizes = data.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumn("_psi", F.least(F.col("_n"), F.lit(max_samples))) \
        .withColumn("_slices", F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(slice_rows))))
    sizes = materialize(sizes)
    n_groups = sizes.count()
    d = attach(data, sizes, group, known_rows=n_groups) if group else data.crossJoin(F.broadcast(sizes))
    picked = _picked(d.select(*group, *key, *columns, "_n", "_psi"), key, F.col("_n").cast("double"), F.col("_psi").cast("double"),
                     n_trees, seed)
    picked = picked.withColumn("_h", F.xxhash64(F.lit(seed + 1), F.col("tree"), *[F.col(k) for k in key]))
    w = Window.partitionBy(*group, "tree").orderBy("_h", *key)
    sample = picked.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= F.col("_psi"))
    max_depth = int(math.ceil(math.log2(max(max_samples, 2))))
    gschema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data.select(*group).schema.fields)
    gprefix = gschema + ", " if gschema else ""
    def grow_group(pdf: pd.DataFrame) -> pd.DataFrame:
        # depth limit from the group's own subsample size, as for a single forest
        limit = int(math.ceil(math.log2(max(len(pdf), 2))))
        nodes = _grow(columns, min(limit, max_depth), seed)(pdf)
        for g in group:
            nodes[g] = pdf[g].iloc[0]
        return nodes

    nodes = sample.select(*group, "tree", *columns).groupBy(*group, "tree").applyInPandas(
        grow_group, f"{gprefix}{NODE_SCHEMA}")
    nodes = materialize(attach(nodes, sizes.select(*group, "_psi", "_slices"), group, known_rows=n_groups)
                        if group else nodes.crossJoin(F.broadcast(sizes.select("_psi", "_slices"))))
    rows = d.withColumn("_slice", F.pmod(F.xxhash64(F.lit(seed + 2), *[F.col(k) for k in key]), F.col("_slices")))
    rows = rows.select(*group, "_slice", *key, *columns)
    tree_slices = nodes.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slices") - 1)))
    kschema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data.select(*key).schema.fields)

    def score_slice(rpdf: pd.DataFrame, npdf: pd.DataFrame) -> pd.DataFrame:
        if rpdf.empty:
            return pd.DataFrame(columns=[*group, *key, "anomaly_score"])
        psi = float(npdf["_psi"].iloc[0])
        eh = _mean_path(rpdf[columns].to_numpy(dtype=float), _tree_arrays(npdf))
        out = rpdf[[*group, *key]].copy()
        out["anomaly_score"] = np.power(2.0, -eh / float(_c([psi])[0]))
        return out

    scores = rows.groupBy(*group, "_slice").cogroup(tree_slices.groupBy(*group, "_slice")).applyInPandas(
        score_slice, f"{gprefix}{kschema}, anomaly_score double")
    scores = materialize(scores)
    thr = quantile_table(scores.select(*group, F.col("anomaly_score").alias("value")), group,
                         {"threshold": 1.0 - contamination}).select(*group, "threshold")
    j = attach(scores, thr, group, known_rows=n_groups) if group else scores.crossJoin(F.broadcast(thr))
    return j.select(*group, *key, "anomaly_score", (F.col("threshold") - F.col("anomaly_score")).alias("decision"),
                    (F.col("anomaly_score") > F.col("threshold")).alias("is_outlier"))
