import numpy as np
import pandas as pd

from tablens.operators import quality as Q
from tablens.operators import stats as S


def test_missing_counts_nan_as_missing(micro):
    r = {x["column_name"]: (x["missing"], x["missing_pct"]) for x in Q.missing_report(micro["nulls"]).collect()}
    assert r["a"] == (2, 33.33) and r["b"] == (1, 16.67) and r["g"] == (1, 16.67) and r["id"] == (0, 0.0)


def test_duplicates_null_equals_null(micro):
    d = Q.duplicate_report(micro["dups"].drop("k")).first()
    assert d["duplicates"] == 2
    rows = {(r["k"], r["first_key"]) for r in Q.duplicate_rows(micro["dups"], "k").collect()}
    assert rows == {(2, 1), (4, 3)}


def test_ratio_check_ieee_policy(micro):
    r = Q.ratio_check(micro["zero_div"], "a", "b", 10).first()
    # 1/0=+inf fails, -1/0=-inf passes, 0/0=NaN fails, 5 passes, 25 fails
    assert r["violations"] == 3 and r["passed"] is False


def test_mixed_types_rejects_java_suffix(micro):
    r = Q.mixed_types(micro["mixed"], ["s"]).first()
    assert r["numeric_count"] == 2  # '1' and '1e3'; not '1d', 'NaN', 'x', NULL


def test_distinct_and_constant(micro):
    d = {r["column_name"]: r["n_unique"] for r in Q.distinct_counts(micro["constant"]).collect()}
    assert d == {"id": 10, "a": 1, "b": 10}
    assert [r[0] for r in Q.constant_columns(micro["constant"]).collect()] == ["a"]


def test_profile_matches_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"x": rng.normal(3, 2, 500), "y": rng.integers(0, 20, 500).astype(float)})
    pdf.loc[::17, "x"] = None
    p = S.profile(spark.createDataFrame(pdf)).toPandas().set_index("column_name")
    for c in ["x", "y"]:
        s = pdf[c].dropna()
        assert p.loc[c, "count"] == len(s)
        assert np.isclose(p.loc[c, "std"], s.std())
        assert np.allclose(p.loc[c, ["p05", "p25", "p50", "p75", "p95"]].astype(float),
                           np.quantile(s, [0.05, 0.25, 0.5, 0.75, 0.95]))
        assert p.loc[c, "n_unique"] == s.nunique()


def test_correlation_constant_is_null_and_matches_pandas(spark, micro):
    c = {(r["col1"], r["col2"]): r["corr"] for r in S.correlation_long(micro["constant"], ["a", "b"]).collect()}
    assert c[("a", "b")] is None
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"u": rng.normal(size=300)})
    pdf["v"] = pdf.u * 2 + rng.normal(size=300)
    pdf.loc[::9, "v"] = None
    got = {(r["col1"], r["col2"]): r["corr"] for r in S.correlation_long(spark.createDataFrame(pdf)).collect()}
    assert np.isclose(got[("u", "v")], pdf.corr().loc["u", "v"])


def test_top_values_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "t string")
    r = [(x["rank"], x["value"]) for x in S.top_values(df, ["t"], k=2).orderBy("rank").collect()]
    assert r == [(1, "c"), (2, "a")]


def test_feature_importance_sums_to_one(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.normal(10, 1, 200), "b": rng.normal(5, 3, 200), "c": rng.normal(1, 1, 200)})
    fi = S.feature_importance(spark.createDataFrame(pdf)).toPandas()
    assert abs(fi.importance.sum() - 1) < 1e-3
    one = S.feature_importance(spark.createDataFrame(pdf[["a"]])).first()
    assert one["importance"] == 1.0


def test_normality_shapiro_francia(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=800)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    r = S.normality(df, ["x"]).first()
    assert r["shapiro_francia_w"] > 0.99
    from statistics import NormalDist
    m = np.array([NormalDist().inv_cdf((i - 0.375) / (len(x) + 0.25)) for i in range(1, len(x) + 1)])
    w = np.corrcoef(np.sort(x), m)[0, 1] ** 2
    assert abs(r["shapiro_francia_w"] - w) < 1e-8
