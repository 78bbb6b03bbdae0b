"""Distribution tests with p-values, bounded bins, forest imputation in one plan."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablens.functions.numeric import kolmogorov_sf, norm_cdf
from tablens.operators import cleaning as C
from tablens.operators import density as D
from tablens.operators import stats as S


def test_norm_cdf_and_kolmogorov_against_plain_formulas(spark):
    zs = [-40.0, -8.0, -7.08, -3.0, -0.5, 0.0, 1e-9, 0.7, 2.0, 7.06, 7.2, 30.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select("z", norm_cdf("z").alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(math.erfc(-r.z / math.sqrt(2)) / 2, rel=1e-7, abs=2e-15)
    xs = [0.0, 0.3, 0.8, 1.17, 1.18, 1.36, 2.0, 4.0]
    for r in spark.createDataFrame([(x,) for x in xs], "x double").select("x", kolmogorov_sf("x").alias("p")).collect():
        want = 1.0 if r.x == 0 else 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * r.x * r.x) for k in range(1, 400))
        assert r.p == pytest.approx(want, abs=1e-9)


def test_ks_statistic_with_ties_and_constant_columns(spark):
    rng = np.random.default_rng(4)
    v = np.round(rng.normal(3, 2, 500), 1)
    df = spark.createDataFrame([(float(x), 5.0, None) for x in v], "a double, b double, c double")
    got = {r.column_name: r for r in S.ks_normal(df, ["a", "b", "c"]).collect()}
    z = (np.sort(v) - v.mean()) / v.std(ddof=1)
    phi = np.array([math.erfc(-x / math.sqrt(2)) / 2 for x in z])
    i = np.arange(1, 501)
    assert got["a"].statistic == pytest.approx(max((i / 500 - phi).max(), (phi - (i - 1) / 500).max()), abs=1e-12)
    assert 0 < got["a"].pValue < 1 and got["a"].n == 500
    assert (got["b"].n, got["b"].statistic, got["b"].pValue) == (500, None, None)
    assert (got["c"].n, got["c"].statistic) == (0, None)


def test_shapiro_francia_p_value_tells_normal_from_exponential(spark):
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b), 1.0) for a, b in zip(rng.normal(0, 1, 400), rng.exponential(1, 400), strict=True)]
    got = {r.column_name: r for r in S.normality(spark.createDataFrame(rows, "a double, b double, c double")).collect()}
    assert got["a"].sf_pvalue > 0.05 and got["b"].sf_pvalue < 1e-6 and got["c"].sf_pvalue is None


def test_far_values_widen_the_bins(spark):
    rows = [(i / 1000,) for i in range(1000)]
    for far in (1e5, 1e9, 1e300, float("inf")):
        bins = D.histogram(spark.createDataFrame([*rows, (far,)], "v double"), ["v"]).collect()
        assert len(bins) <= D.MAX_BINS and sum(r["count"] for r in bins) == (1000 if far == float("inf") else 1001)


def scans(df):
    return len(re.findall(r"Scan parquet", df._jdf.queryExecution().executedPlan().toString()))


def test_forest_imputation_is_one_plan_however_many_columns(spark, tmp_path):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (120, 10)).cumsum(axis=1)
    rows = [tuple(None if (i + j) % 17 == 0 else float(v) for j, v in enumerate(r)) for i, r in enumerate(x)]
    names = [f"c{j}" for j in range(10)]
    spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    two = C.impute_random_forest(df, names[:2], num_trees=3)
    ten = C.impute_random_forest(df, names, num_trees=3)
    assert scans(ten) == scans(two) <= 4
    got = ten.toPandas()
    assert len(got) == 120 and not got.isna().any().any()
    given = df.dropna().toPandas()
    assert set(map(tuple, given.values)) <= set(map(tuple, got.values))
    assert ten.where(F.col("c0").isNull()).count() == 0
