import numpy as np
import pandas as pd
import pytest

from tablens.operators import density as D
from tablens.operators import iforest as IF
from tablens.operators import ml as M
from tablens.operators import timeseries as TS


@pytest.fixture(scope="module")
def sine_hourly(spark):
    t = pd.date_range("2024-01-01", periods=24 * 10, freq="h")
    v = 10 + 3 * np.sin(2 * np.pi * np.arange(len(t)) / 24)
    keep = np.ones(len(t), bool)
    keep[[5, 6, 7, 50, 100, 101]] = False  # missing hours
    pdf = pd.DataFrame({"ts": t[keep], "v": v[keep]})
    return pdf, spark.createDataFrame(pdf)


def test_resample_interpolates_like_pandas(sine_hourly):
    pdf, df = sine_hourly
    got = TS.resample(df, "ts", "v", 3600).orderBy("t").toPandas()
    exp = pdf.set_index("ts").v.resample("1h").mean().interpolate("linear")
    assert len(got) == len(exp)
    assert np.allclose(got.value.values, exp.values)
    assert (~got.populated).sum() == 6


def test_decomposition_matches_numpy(sine_hourly):
    pdf, df = sine_hourly
    reg = TS.resample(df, "ts", "v", 3600)
    got = TS.decompose(reg, 24).orderBy("t").toPandas()
    y = got.observed.values
    w = np.r_[0.5, np.ones(23), 0.5] / 24
    trend = np.full(len(y), np.nan)
    trend[12:-12] = np.convolve(y, w, mode="valid")
    assert np.allclose(got.trend.values, trend, equal_nan=True)
    det = y - trend
    pm = np.array([np.nanmean(det[i::24]) for i in range(24)])
    pm -= pm.mean()
    assert np.allclose(got.seasonal.values, pm[np.arange(len(y)) % 24])


def test_dft_matches_numpy_fft(sine_hourly):
    pdf, df = sine_hourly
    reg = TS.resample(df, "ts", "v", 3600)
    y = reg.orderBy("t").toPandas().value.values
    p = TS.dft_power(reg).orderBy("k").toPandas()
    ref = np.abs(np.fft.fft(y - y.mean())) ** 2
    assert np.allclose(p.power.values, ref[1:len(y) // 2])
    dom = TS.dominant_periods(reg).toPandas()
    assert 24.0 in set(np.round(dom.period, 6))


def test_gap_regularity(spark, sine_hourly):
    pdf, df = sine_hourly
    reg = TS.resample(df, "ts", "v", 3600)
    g = TS.gap_stats(reg, "bucket_ts").first()
    assert g["distinct_gaps"] == 1 and g["step_seconds"] == 3600 and g["regularity"] == 1.0
    irr = TS.gap_stats(df, "ts").first()
    gaps = np.diff(pdf.ts.values.astype("datetime64[us]").astype(np.int64)) / 1e6
    assert np.isclose(irr["std_interval_seconds"], gaps.std()) and irr["regularity"] < 1


def test_kde_bimodal(spark):
    rng = np.random.default_rng(4)
    x = np.r_[rng.normal(0, 1, 300), rng.normal(8, 1, 300)]
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    modes = D.kde_modes(df, ["x"]).toPandas()
    assert len(modes) >= 2
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 1000)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    peaks = [i for i in range(1, 999) if dens[i] > dens[i - 1] and dens[i] > dens[i + 1]]
    assert sorted(modes.i) == peaks
    small = spark.createDataFrame(pd.DataFrame({"x": x[:50]}))
    assert D.kde_modes(small, ["x"]).count() == 0


def test_histogram_auto(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=1000)
    h = D.histogram(spark.createDataFrame(pd.DataFrame({"x": x}))).toPandas()
    counts, _ = np.histogram(x, bins="auto")
    assert h["count"].sum() == 1000 and h["bin"].max() + 1 == len(counts)


def test_kmeans_recovers_blobs_and_pca(spark):
    rng = np.random.default_rng(8)
    centres = np.array([[0, 0], [10, 10], [0, 10]])
    X = np.vstack([c + rng.normal(0, 0.5, (60, 2)) for c in centres])
    pdf = pd.DataFrame({"id": np.arange(len(X)), "x": X[:, 0], "y": X[:, 1], "true": np.repeat([0, 1, 2], 60)})
    df = spark.createDataFrame(pdf)
    a = M.cluster(df, ["x", "y"], "id", k=3, starts=2).toPandas().merge(pdf, on="id")
    assert a.groupby("true").cluster.nunique().max() == 1 and a.cluster.nunique() == 3
    curve = M.inertia_curve(M.standardize(df, ["x", "y"], ["id"]), ["x", "y"], max_clusters=5, starts=1)
    assert M.elbow_k(curve, 5) in (2, 3, 4)
    scores, comps = M.pca(df, ["x", "y"], "id", k=2)
    c = comps.toPandas()
    L = c.pivot(index="column_name", columns="component", values="loading").values
    assert np.allclose(L.T @ L, np.eye(2), atol=1e-8)
    Z = (X - X.mean(0)) / X.std(0)
    ev = np.linalg.eigvalsh(np.cov(Z.T))[::-1]
    assert np.allclose(c.groupby("component").explained_variance_ratio.first().values, ev / ev.sum())


def test_isolation_forest_flags_planted(spark):
    rng = np.random.default_rng(12)
    X = rng.normal(0, 1, (500, 2))
    X[:10] += 9
    pdf = pd.DataFrame({"id": np.arange(500), "a": X[:, 0], "b": X[:, 1]})
    r = IF.isolation_forest(spark.createDataFrame(pdf), ["a", "b"], "id", n_trees=50).toPandas()
    top = set(r.sort_values("anomaly_score", ascending=False).id.head(10))
    assert len(top & set(range(10))) >= 9
    assert abs(r.is_outlier.mean() - 0.05) < 0.01


def test_four_step_fft_equals_numpy(spark):
    rng = np.random.default_rng(21)
    n = 360  # 18 x 20
    y = np.sin(2 * np.pi * np.arange(n) / 24) + rng.normal(0, 0.3, n)
    pdf = pd.DataFrame({"s": np.repeat(["a", "b"], n), "t": np.tile(np.arange(n), 2), "value": np.r_[y, 2 * y]})
    df = spark.createDataFrame(pdf)
    fft = TS.dft_power(df, "s").toPandas().sort_values(["s", "k"]).reset_index(drop=True)
    assert len(fft) == 2 * (n // 2 - 1)
    ref = np.abs(np.fft.fft(y - y.mean())) ** 2
    assert np.allclose(fft[fft.s == "a"].power.values, ref[1:n // 2])
    assert np.allclose(fft[fft.s == "b"].power.values, 4 * ref[1:n // 2])


def test_fft_single_series_awkward_length(spark):
    n = 2 * 211  # 2 x prime: unbalanced split
    y = np.cos(2 * np.pi * np.arange(n) / 7.0)
    df = spark.createDataFrame(pd.DataFrame({"t": np.arange(n), "value": y}))
    fft = TS.dft_power(df).toPandas().sort_values("k")
    ref = np.abs(np.fft.fft(y - y.mean())) ** 2
    assert np.allclose(fft.power.values, ref[1:n // 2], atol=1e-6)


@pytest.mark.parametrize("n", [97, 2 * 53])
def test_bluestein_matches_numpy(spark, n):
    rng = np.random.default_rng(n)
    y = np.sin(2 * np.pi * np.arange(n) / 5.0) + rng.normal(0, 0.2, n)
    pdf = pd.DataFrame({"s": np.repeat(["a", "b"], n), "t": np.tile(np.arange(n), 2), "value": np.r_[y, -y]})
    got = TS.dft_power(spark.createDataFrame(pdf), "s", max_class_points=8) \
        .toPandas().sort_values(["s", "k"])
    ref = np.abs(np.fft.fft(y - y.mean())) ** 2
    for s in ("a", "b"):
        assert np.allclose(got[got.s == s].power.values, ref[1:n // 2], rtol=1e-7, atol=1e-7)


def test_isolation_forest_by_group(spark):
    rng = np.random.default_rng(41)
    parts = []
    for g, scale in (("a", 1.0), ("b", 50.0)):
        X = rng.normal(0, scale, (400, 2))
        X[:8] += 10 * scale
        parts.append(pd.DataFrame({"g": g, "id": np.arange(400) + (0 if g == "a" else 1000), "u": X[:, 0], "v": X[:, 1]}))
    pdf = pd.concat(parts, ignore_index=True)
    df = spark.createDataFrame(pdf)
    one = IF.isolation_forest_by_group(df, ["u", "v"], "id", "g", n_trees=40).toPandas()
    sliced = IF.isolation_forest_by_group(df, ["u", "v"], "id", "g", n_trees=40, slice_rows=60).toPandas()
    m = one.merge(sliced, on=["g", "id"])
    assert len(m) == 800 and np.allclose(m.anomaly_score_x, m.anomaly_score_y)
    for g, base in (("a", 0), ("b", 1000)):
        sub = one[one.g == g]
        top = set(sub.sort_values("anomaly_score", ascending=False).id.head(8))
        assert len(top & set(range(base, base + 8))) >= 7
        assert abs(sub.is_outlier.mean() - 0.05) < 0.015


def test_forest_walk_is_spread_and_follows_the_nodes(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2))
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double").coalesce(1)
    nodes, psi = IF.fit_forest(df, ["a", "b"], "id", n_trees=5)
    s = IF.score(df, nodes, ["a", "b"], "id", psi)
    assert s.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    table = {(r.tree, r.node): r for r in nodes.collect()}

    def walk(tree, v):
        r = table[tree, 0]
        while r.feature >= 0:
            r = table[tree, r.left if v[r.feature] < r.threshold else r.right]
        return r.depth + IF._c([r.size])[0]

    want = {i: 2.0 ** (-sum(walk(t, v) for t in range(5)) / 5 / IF._c([psi])[0]) for i, v in enumerate(x)}
    got = {r["id"]: r.anomaly_score for r in s.collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-12 for i in want)


def test_dominant_periods_transform_once(spark):
    """The bins are kept, so neither the threshold nor a reader of the result repeats the transform."""
    reg = spark.createDataFrame([(s, i, float(np.sin(2 * np.pi * i * s / 96))) for s in (4, 8) for i in range(96)], "s int, t long, value double")
    d = TS.dominant_periods(reg, series="s", top=1)
    assert "FlatMapGroupsInPandas" not in d._jdf.queryExecution().toString()
    assert sorted((r["s"], r["k"]) for r in d.collect()) == [(4, 4), (8, 8)]
