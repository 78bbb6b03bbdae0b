"""Clustering, projection and regression on block passes, Spark ML and SQL aggregates.

Fits are distributed (k-means in ``kmeans.py``, PCA by Spark ML); the fitted state (centres, loadings) is small
and is applied back with column expressions, so projections stay in codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablens.functions.frames import as_list, numeric_columns
from tablens.functions.numeric import missing_to_null, nan_to_null
from tablens.operators.kmeans import assign, cluster_distances, fit_models

# Clustering defaults.
KMEANS_STARTS = 10
KMEANS_SEED = 42
MAX_CLUSTERS = 10
ELBOW_ROWS_PER_K = 5
# Rows whose silhouette is taken, against all rows.
SILHOUETTE_SAMPLE = 1000


def array_columns(df: DataFrame, array_col: str, dims: int, prefix: str = "f") -> tuple[DataFrame, list[str]]:
    """Expand the first ``dims`` elements of an array column into double columns."""
    names = [f"{prefix}{i}" for i in range(dims)]
    return df.select("*", *[F.col(array_col)[i].cast("double").alias(n) for i, n in enumerate(names)]), names


def standardize(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Complete rows of ``columns``, each scaled by mean and population std (0 → 1)."""
    from tablens.operators.cleaning import complete_cases
    from tablens.operators.features import scale_features
    base = complete_cases(df.select(*as_list(keep), *columns), columns)
    scaled, _ = scale_features(base, "standard", list(columns))
    return scaled


def _vectors(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def kmeans_best(df: DataFrame, columns: Sequence[str], k: int, starts: int = KMEANS_STARTS,
                seed: int = KMEANS_SEED, max_iter: int = 300):
    """Best of ``starts`` k-means models (lowest cost, ties → lowest start), fitted in the same passes."""
    return fit_models(df, columns, [k], starts, seed, max_iter).get(k)


def cluster(df: DataFrame, columns: Sequence[str], key, k: int | None = None, max_clusters: int = MAX_CLUSTERS,
            starts: int = KMEANS_STARTS, seed: int = KMEANS_SEED, scale: bool = True) -> DataFrame:
    """Cluster assignments ``(key..., cluster)`` of complete rows, standardised with ``scale``; ``k=None``
    chooses k by the elbow rule, from the same models that are then used."""
    from tablens.operators.cleaning import complete_cases
    key, columns = as_list(key), as_list(columns)
    data = standardize(df, columns, key) if scale else complete_cases(df.select(*key, *columns), columns)
    if k is None:
        models = elbow_models(data, columns, max_clusters, starts, seed)
        chosen = elbow_k(_curve(df, models), max_clusters)
        model = models.get(chosen) or kmeans_best(data, columns, chosen, starts, seed)
    else:
        model = kmeans_best(data, columns, k, starts, seed)
    if model is None:
        return data.select(*key, F.lit(0).alias("cluster")).limit(0)
    return assign(data, columns, key, model.centers)


def cluster_profile(df: DataFrame, assignments: DataFrame, key, columns: Sequence[str]) -> DataFrame:
    """Per cluster: size, percentage, mean and sample std of each column in original units."""
    key = as_list(key)
    j = df.select(*key, *columns).join(assignments, key)
    tot = F.sum("size").over(Window.partitionBy())
    g = j.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"),
                                 *[x for c in columns for x in (F.avg(nan_to_null(c)).alias(f"{c}__mean"),
                                                                F.stddev_samp(nan_to_null(c)).alias(f"{c}__std"))])
    g = g.withColumn("pct", F.col("size") * 100.0 / tot)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__mean").alias("mean"),
                               F.col(f"{c}__std").alias("std")) for c in columns])
    return g.select("cluster", "size", "pct", F.explode(cells).alias("_c")).select(
        "cluster", F.col("size").cast("long").alias("size"), "pct", "_c.*")


def cluster_centers(df: DataFrame, assignments: DataFrame, key, columns: Sequence[str]) -> DataFrame:
    """Long centres ``(cluster, column_name, center)`` as per-cluster means."""
    key = as_list(key)
    j = df.select(*key, *columns).join(assignments, key)
    g = j.groupBy("cluster").agg(*[F.avg(nan_to_null(c)).alias(c) for c in columns])
    return g.unpivot(["cluster"], list(columns), "column_name", "center")


def cluster_feature_importance(centers: DataFrame) -> DataFrame:
    """Range of the centres per feature divided by the total range; all zero → 1/p."""
    r = centers.groupBy("column_name").agg((F.max("center") - F.min("center")).alias("range"))
    w = Window.partitionBy()
    tot = F.sum("range").over(w)
    cnt = F.count(F.lit(1)).over(w)
    return r.select("column_name", F.when(tot > 0, F.col("range") / tot).otherwise(1.0 / cnt).alias("importance"))


def silhouette(df: DataFrame, assignments: DataFrame, key, columns: Sequence[str], sample: int = SILHOUETTE_SAMPLE) -> float | None:
    """Mean silhouette with plain Euclidean distances to all rows, over at most ``sample`` rows.

    The sample holds the rows with the least md5 of their key (all rows where there are no more, which gives the exact
    mean). Its distances to every row are summed per cluster block by block. A cluster of one row scores 0;
    fewer than two clusters give None. Rows with a missing coordinate or cluster are left out.
    """
    from tablens.operators.cleaning import complete_cases
    key, columns = as_list(key), as_list(columns)
    j = df.select(*key, *columns).join(assignments, key).where(F.col("cluster").isNotNull())
    rows = complete_cases(j, columns).select(F.md5(F.concat_ws("~", *[F.col(k).cast("string") for k in key])).alias("_h"), "cluster",
                                             F.array(*[F.col(c).cast("double") for c in columns]).alias("_x"))
    sizes = {r["cluster"]: r["n"] for r in rows.groupBy("cluster").agg(F.count("*").alias("n")).collect()}  # one row per cluster
    if len(sizes) < 2:
        return None
    drawn = rows.orderBy("_h", "cluster", "_x").limit(sample).collect()
    number = {c: i for i, c in enumerate(sorted(sizes))}
    sums = cluster_distances(rows.select("cluster", "_x"), np.array([r["_x"] for r in drawn]), number)
    count = np.array([sizes[c] for c in sorted(sizes)], dtype=float)
    own = np.array([number[r["cluster"]] for r in drawn])
    at = np.arange(len(drawn))
    with np.errstate(divide="ignore", invalid="ignore"):
        a = sums[at, own] / (count[own] - 1)
        means = sums / count
        means[at, own] = np.inf
        b = means.min(axis=1)
        score = np.where(count[own] > 1, np.where(np.maximum(a, b) > 0, (b - a) / np.maximum(a, b), 0.0), 0.0)
    return float(score.mean())


def elbow_models(df: DataFrame, columns: Sequence[str], max_clusters: int = MAX_CLUSTERS, starts: int = KMEANS_STARTS,
                 seed: int = KMEANS_SEED) -> dict:
    """The best model of each k = 1 … min(max_clusters, n // 5), one at least, all fitted in the same passes."""
    kmax = min(max_clusters, df.count() // ELBOW_ROWS_PER_K)
    return fit_models(df, columns, range(1, max(kmax, 1) + 1), starts, seed)


def _curve(df: DataFrame, models: dict) -> DataFrame:
    return df.sparkSession.createDataFrame([(k, m.cost) for k, m in sorted(models.items())], "k int, inertia double")


def inertia_curve(df: DataFrame, columns: Sequence[str], max_clusters: int = MAX_CLUSTERS,
                  starts: int = KMEANS_STARTS, seed: int = KMEANS_SEED) -> DataFrame:
    """``(k, inertia)`` for k = 1 … min(max_clusters, n // 5), best of ``starts`` each."""
    return _curve(df, elbow_models(df, columns, max_clusters, starts, seed))


def second_difference(curve: DataFrame, x: str = "k", y: str = "inertia") -> DataFrame:
    """``y[i+2] − 2·y[i+1] + y[i]`` attached to the first x of each triple (window over a short curve)."""
    w = Window.orderBy(x)
    return curve.withColumn("second_diff", F.lead(y, 2).over(w) - 2 * F.lead(y, 1).over(w) + F.col(y))


def elbow_k(curve: DataFrame, max_clusters: int = MAX_CLUSTERS, compat: bool = False) -> int:
    """Elbow k: argmax of the second difference + 2 (+3 with ``compat``), clamped to [2, max];
    two points or fewer → 2."""
    d = second_difference(curve).filter(F.col("second_diff").isNotNull()).orderBy(F.desc("second_diff"), "k")
    first = d.select("k").first()
    if first is None:
        return 2
    idx = first[0] - 1
    k = idx + (3 if compat else 2)
    return int(max(2, min(k, max_clusters)))


def elbow_choice(df: DataFrame, columns, max_clusters=MAX_CLUSTERS, starts=KMEANS_STARTS, seed=KMEANS_SEED) -> int:
    return elbow_k(inertia_curve(df, columns, max_clusters, starts, seed), max_clusters)


def pca(df: DataFrame, columns: Sequence[str], key, k: int = 2, scale: bool = True,
        fill_mean: bool = False) -> tuple[DataFrame, DataFrame]:
    """Principal components. Returns ``(scores, components)``:

    scores ``(key..., pc1 … pck)``; components ``(component, column_name, loading,
    explained_variance_ratio)``. Input is centred (Spark's PCA does not centre) and,
    with ``scale``, divided by the population std; ``fill_mean`` fills missing values
    with the column mean instead of dropping incomplete rows. Each component's sign is
    fixed so that its largest-magnitude loading is positive.
    """
    from pyspark.ml.feature import PCA
    from tablens.operators.cleaning import complete_cases, impute_mean
    key = as_list(key)
    columns = list(columns)
    base = df.select(*key, *[nan_to_null(c).alias(c) for c in columns])
    base = impute_mean(base, columns) if fill_mean else complete_cases(base, columns)
    st = base.agg(*[x for c in columns for x in (F.avg(c).alias(f"m__{c}"), F.stddev_pop(c).alias(f"s__{c}"))]).first()
    def centred(c):
        s = st[f"s__{c}"] if scale else 1.0
        s = s if s else 1.0
        return ((F.col(c) - F.lit(st[f"m__{c}"])) / F.lit(s)).alias(c)
    z = base.select(*key, *[centred(c) for c in columns])
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(_vectors(z, columns))
    pc = model.pc.toArray()
    ev = list(model.explainedVariance.toArray())
    rows = []
    for j in range(k):
        col = pc[:, j]
        sign = 1.0 if col[abs(col).argmax()] >= 0 else -1.0
        for i, c in enumerate(columns):
            rows.append((j + 1, c, float(sign * col[i]), float(ev[j])))
    comps = df.sparkSession.createDataFrame(rows, "component int, column_name string, loading double, "
                                                  "explained_variance_ratio double")
    scores = z.select(*key, *[sum((F.col(c) * F.lit(r[2]) for r in rows if r[0] == j + 1 for c in [r[1]]),
                                  F.lit(0.0)).alias(f"pc{j + 1}") for j in range(k)])
    return scores, comps


def ols_by_group(df: DataFrame, y: str, x: str, group=None) -> DataFrame:
    """Least-squares line ``y = slope·x + intercept`` per group, with r² and n."""
    group = as_list(group)
    base = missing_to_null(df, [y, x])
    for g in group:
        base = base.filter(F.col(g).isNotNull())
    return base.groupBy(*group).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                                    F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))
