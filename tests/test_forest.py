"""Regression forests from histograms: cuts, draws, splits, and imputation that no layout of the rows changes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablens.operators import cleaning as C
from tablens.operators import forest as FO


def test_cut_points_keep_rare_values_and_take_exact_quantiles(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"few": [0.0] * 990 + [1.0] * 5 + [3.0] * 5, "many": rng.permutation(1000).astype(float), "none": [None] * 1000, "one": 4})
    pdf["none"] = pdf["none"].astype(float)
    df = spark.createDataFrame(pdf).repartition(5)
    cuts = FO.cut_points(df, ["few", "many", "none", "one"])
    assert cuts["few"] == [0.5, 2.0] and cuts["none"] == cuts["one"] == []
    assert np.allclose(cuts["many"], np.quantile(pdf["many"], np.arange(1, 32) / 32))
    got = df.select("few", "many", *[FO.bin_of(F.col(c), cuts[c]).alias(f"b_{c}") for c in cuts]).toPandas()
    assert (got.b_few == np.searchsorted(cuts["few"], got.few)).all() and (got.b_none == 0).all()
    assert (got.b_many == np.searchsorted(cuts["many"], got.many)).all()


@pytest.mark.parametrize("n", [1, 4, 60, 3000, 2_000_000])
def test_draws_of_n_equal_rows_are_poisson(n):
    h = np.random.default_rng(n).integers(-2 ** 62, 2 ** 62, 400)
    w = FO._poisson(FO._uniform(h, 100), np.full(400, n))
    assert abs(w.mean() - n) < 5 * (n / w.size) ** 0.5 and 0.95 < w.var() / n < 1.05
    if n == 1:
        assert np.allclose([(w == k).mean() for k in range(4)], np.exp(-1) / np.array([1, 1, 2, 6]), atol=0.01)
    assert len(np.unique(w[:, 0])) > 1 and abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.25


def test_a_tree_takes_the_best_split_of_its_own_draw(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.integers(0, 6, 500), "b": rng.integers(0, 4, 500)})
    pdf["y"] = np.where(pdf.a > 2, 5.0, 1.0) + pdf.b
    df = spark.createDataFrame(pdf)
    one = FO.fit_regression(df, ["a", "b"], "y", pdf.y.mean(), num_trees=1, max_depth=2, max_bins=6)
    g = df.groupBy("a", "b", "y").agg(F.count(F.lit(1)).alias("n")).withColumn("h", F.xxhash64(F.lit(42), "a", "b", "y")).toPandas()
    w = FO._poisson(FO._uniform(g.h.to_numpy(), 1), g.n.to_numpy())[:, 0]

    def spread(rows):
        return 0.0 if w[rows].sum() == 0 else (w[rows] * (g.y[rows] - np.average(g.y[rows], weights=w[rows])) ** 2).sum()

    costs = {(j, c): spread((g[x] <= c).to_numpy()) + spread((g[x] > c).to_numpy()) for j, x in enumerate("ab") for c in range(5 if x == "a" else 3)}
    assert (one.feature[0, 0], one.cut[0, 0]) == min(costs, key=costs.get) == (0, 2)
    left = (g.a <= 2).to_numpy()
    assert np.isclose(one.value[0, 1], np.average(g.y[left], weights=w[left]))
    bins = g[["a", "b"]].to_numpy()
    by_node = pd.DataFrame({"node": one.nodes(bins, 2)[:, 0], "w": w, "wy": w * g.y}).groupby("node").sum()
    for node, r in by_node[by_node.w > 0].iterrows():
        assert np.isclose(one.value[0, node], r.wy / r.w)


def test_forest_is_as_good_as_spark_mls(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (1500, 4))
    pdf = pd.DataFrame(x, columns=list("abcd"))
    pdf["y"] = 1e6 + np.sin(2 * x[:, 0]) * 3 + x[:, 1] ** 2 + rng.normal(0, 0.3, 1500)
    pdf["id"] = range(1500)
    df = spark.createDataFrame(pdf)
    held = F.col("id") % 5 == 0
    got = C.impute_random_forest(df.withColumn("z", F.when(~held, F.col("y"))), ["z"], predictors=list("abcd"), num_trees=60).filter(held)
    ours = got.agg(F.avg((F.col("z") - F.col("y")) ** 2)).first()[0]
    va = VectorAssembler(inputCols=list("abcd"), outputCol="f")
    theirs = RandomForestRegressor(featuresCol="f", labelCol="y", numTrees=60, seed=42).fit(va.transform(df.filter(~held))).transform(va.transform(df.filter(held)))
    assert ours < 1.1 * theirs.agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0]


def test_forest_imputation_is_the_same_however_rows_are_partitioned(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"id": range(400), "x": rng.integers(0, 40, 400).astype(float), "z": rng.normal(0, 1, 400)})
    pdf["y"] = pdf.x * 2 + pdf.z
    df = spark.createDataFrame(pdf).withColumn("y", F.when(F.col("id") % 9 != 0, F.col("y"))).withColumn("x", F.when(F.col("id") % 7 != 0, F.col("x")))
    one, many = (C.impute_random_forest(d, ["x", "y"], predictors=["x", "y", "z"], num_trees=10).toPandas().sort_values("id").reset_index(drop=True)
                 for d in (df.coalesce(1), df.repartition(6, "z")))
    pd.testing.assert_frame_equal(one, many, rtol=1e-9)
    assert one.notna().all().all()


def test_kept_sums_grow_the_same_forest_as_repeated_draws(spark, monkeypatch):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"a": rng.integers(0, 5, 2000), "b": rng.integers(0, 7, 2000), "c": rng.integers(0, 2, 2000)})
    pdf["y"] = pdf.a * pdf.b + rng.normal(0, 1, 2000)
    df = spark.createDataFrame(pdf)
    kept = FO.fit_regression(df, ["a", "b", "c"], "y", pdf.y.mean(), num_trees=12)
    monkeypatch.setattr(FO, "KEEP_FROM", 10 ** 6)
    again = FO.fit_regression(df, ["a", "b", "c"], "y", pdf.y.mean(), num_trees=12)
    assert (kept.feature == again.feature).all() and (kept.cut == again.cut).all() and np.allclose(kept.value, again.value)
    assert (kept.feature >= 0).sum() > 100


def test_a_column_without_values_cannot_be_learnt(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    with pytest.raises(ValueError, match="no value"):
        C.impute_random_forest(df, ["y"], predictors=["x", "y"], num_trees=2)
