"""Missing values, row-local removal, complete grids, imputers and CSV types on micro tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablens.operators import cleaning as C
from tablens.operators import density as D
from tablens.operators import features as FE
from tablens.operators import outliers as O
from tablens.operators import quality as Q
from tablens.operators import stats as S
from tablens.operators import timeseries as TS
from tablens.sources import io

NAN = float("nan")


@pytest.fixture(scope="module")
def holes(spark):
    return spark.createDataFrame([(1, "a", 1.0, 2.0), (2, "a", NAN, 3.0), (3, "a", 3.0, None), (4, "b", 4.0, 7.0), (5, "b", -5.0, 1.0), (6, "b", 6.0, NAN)],
                                 "id int, g string, x double, y double")


def test_nan_is_missing_everywhere(spark, holes):
    assert {r.g: r.x for r in S.group_means(holes, "g", ["x"]).collect()} == {"a": 2.0, "b": pytest.approx(5 / 3)}
    corr = S.correlation_long(holes, ["x", "y"], include_diagonal=False).first().corr
    assert corr == pytest.approx(np.corrcoef([1, 4, -5], [2, 7, 1])[0, 1])
    assert Q.positive_check(holes, ["x"]).first().violations == 2
    assert sorted(r.id for r in C.filter_positive(holes, ["x"]).collect()) == [1, 3, 4, 6]
    clipped = {r.id: r.x for r in FE.clip_columns(holes, {"x": (0.0, 5.0)}).collect()}
    assert clipped == {1: 1.0, 2: None, 3: 3.0, 4: 4.0, 5: 0.0, 6: 5.0}
    assert {r.id: r.x for r in O.cap_outliers(holes, ["x"], "iqr").collect()}[2] is None
    assert S.ks_normal(holes, "x").first().statistic > 0


def test_signed_zeros_are_one_value(spark):
    df = spark.createDataFrame([(0.0, "x"), (-0.0, "x"), (NAN, None)], "z double, s string")
    assert {r.column_name: r.n_unique for r in Q.distinct_counts(df).collect()} == {"z": 1, "s": 1}
    assert {r.column_name for r in Q.constant_columns(df).collect()} == {"z", "s"}


def test_removal_compares_cells_not_hashes(spark):
    rows = [(float(i % 10), float(i % 7)) for i in range(40)] + [(100.0, None), (None, 100.0 / 50)]
    df = spark.createDataFrame(rows, "a double, b double")
    kept = O.handle(df, "remove", "iqr", ["a", "b"])
    assert kept.count() == 41 and kept.filter("a = 100").count() == 0
    flagged = O.flag_rows(df, O.fit_bounds(df, ["a", "b"], "iqr"))
    assert flagged.select("_row_key").distinct().count() == 1


def test_bounds_of_several_methods_keep_their_own_rule(spark):
    df = spark.createDataFrame([(float(i % 10),) for i in range(50)] + [(60.0,)], "v double")
    both = O.fit_bounds(df, ["v"], "iqr").unionByName(O.fit_bounds(df, ["v"], "modified_zscore"))
    got = {(r.method, r.value) for r in O.flag_rows(df, both).collect()}
    assert got == {("iqr", 60.0), ("modified_zscore", 60.0)}
    assert {r.method: r.outlier_count for r in O.outlier_counts(df, both).collect()} == {"iqr": 1, "modified_zscore": 1}


@pytest.mark.parametrize("method", ["iqr", "zscore", "zscore_sample", "modified_zscore", "isolation_forest"])
def test_every_method_with_every_strategy(spark, method):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(np.r_[rng.normal(0, 1, 300), [90.0, -80.0]])], "id long, v double")
    assert not {300, 301} & {r.id for r in O.handle(df, "remove", method, ["v"], key="id").collect()}
    filled = {r.id: r.v for r in O.handle(df, "impute", method, ["v"], key="id").collect()}
    assert len(filled) == 302 and abs(filled[300]) < 1 and abs(filled[301]) < 1
    if method == "isolation_forest":
        with pytest.raises(ValueError):
            O.handle(df, "cap", method, ["v"], key="id")
    else:
        assert max(r.v for r in O.handle(df, "cap", method, ["v"]).collect()) < 90


def test_group_count_is_rows_of_the_level(spark, holes):
    got = {r.level: r["count"] for r in S.group_stats(holes, ["g"], ["x"]).collect()}
    assert got == {"a": 3, "b": 3}


def test_gap_spread_of_a_nearly_regular_series(spark):
    year = 365 * 86400
    steps = [year + (0.0005 if i % 2 else -0.0005) for i in range(40)]
    ts = pd.to_datetime("1990-01-01") + pd.to_timedelta(np.r_[0, np.cumsum(steps)], unit="s").round("us")
    df = spark.createDataFrame(pd.DataFrame({"ts": ts}))
    got = TS.gap_stats(df, "ts").first()
    assert got.std_interval_seconds == pytest.approx(5e-4, rel=1e-3)
    twice = TS.gap_stats(df.union(df), "ts").first()
    gaps = np.diff(np.sort(np.r_[ts, ts]).astype("datetime64[us]").astype("int64")) / 1e6
    assert twice.std_interval_seconds == pytest.approx(np.std(gaps), rel=1e-9)


def test_whole_density_grid_and_all_bins(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame(pd.DataFrame({"v": np.r_[rng.normal(0, 1, 1000), 10_000.0]}))
    grid = D.kde_grid(df, ["v"]).toPandas().sort_values("i")
    assert grid.i.tolist() == list(range(1000)) and (grid.density >= 0).all()
    bins = D.histogram(df, ["v"], bins=50).toPandas().sort_values("bin")
    want, edges = np.histogram(df.toPandas().v, bins=50)
    assert bins["count"].tolist() == want.tolist() and np.allclose(bins.lower, edges[:-1])


def test_decomposition_is_the_same_in_small_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame(pd.DataFrame({"t": range(300), "value": rng.normal(size=300)}))
    for period in (7, 24):
        whole = TS.decompose(df, period).toPandas().sort_values("t").reset_index(drop=True)
        monkeypatch.setattr(TS, "DECOMPOSE_BLOCK", 50)
        parts = TS.decompose(df, period).toPandas().sort_values("t").reset_index(drop=True)
        monkeypatch.undo()
        pd.testing.assert_frame_equal(whole, parts, rtol=1e-9)


def test_forest_imputers_beat_the_simple_ones(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(0, 10, 800)
    y = x ** 2 + rng.normal(0, 1, 800)
    lab = np.where(x > 6, "hi", "lo")
    pdf = pd.DataFrame({"id": range(800), "x": x, "y": y, "lab": lab})
    df = spark.createDataFrame(pdf).withColumn("y", F.when(F.col("id") % 5 == 0, F.lit(NAN)).otherwise(F.col("y"))) \
        .withColumn("lab", F.when(F.col("id") % 4 != 0, F.col("lab")))
    got = C.impute_random_forest(df, ["x", "y"], num_trees=30).toPandas().set_index("id")
    assert len(got) == 800 and got.y.notna().all() and list(got.columns) == ["x", "y", "lab"]
    lost = pdf.id % 5 == 0
    assert np.mean((got.y[lost.to_numpy()].sort_index() - pdf.y[lost]) ** 2) < 0.1 * np.var(pdf.y[lost])
    assert np.allclose(got.y.sort_index()[~lost.to_numpy()], pdf.y[~lost])
    labels = C.impute_label(df, "lab", ["x"], num_trees=30).toPandas().set_index("id").lab.sort_index()
    assert (labels == pdf.lab).mean() > 0.98
    with pytest.raises(ValueError):
        C.impute_random_forest(df.union(df), ["x", "y"], key="id")
    cleaned = C.clean(df.drop("id"), ["x", "y"], handle_missing="model_based", label="lab", num_trees=10)
    assert cleaned.filter("y is null or lab is null").count() == 0


def test_csv_numbers_with_missing_tokens_stay_numbers(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b,c,d,e\n1,2.5,x,true,2024-01-01 10:00:00\nNA,<NA>, NA ,false,\n3,#N/A,n/a,true,2024-02-01 00:00:00\n")
    df = io.load_table(spark, str(p))
    assert [t for _, t in df.dtypes] == ["int", "double", "string", "boolean", "timestamp"]
    rows = df.orderBy("a").collect()
    assert rows[0].a is None and rows[0].b is None and rows[0].c == " NA " and rows[2].c is None


def test_list_of_columns_is_used_whole(spark):
    from tablens.operators import plotdata as V
    df = spark.createDataFrame([tuple("abcdefg")], [f"c{i}" for i in range(7)])
    assert V.category_bars(df, [f"c{i}" for i in range(7)]).count() == 7


def test_no_checkpoints_on_a_cluster_without_a_shared_folder():
    from tablens.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_forest_pool_rate_needs_no_integer_grid():
    from tablens.operators import iforest
    assert iforest.pool_rate(1e13, 256, 100) * 1e13 == pytest.approx(2 * 256 * 100)
    assert iforest.pool_rate(1000, 256, 100) == 1.0


def test_forest_does_not_depend_on_partitioning(spark):
    from tablens.operators import iforest
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(3000, 2)))] + [(5000, 40.0, 40.0)], "id long, a double, b double")
    one = iforest.isolation_forest(df.repartition(1), ["a", "b"], "id").select("id", "is_outlier")
    many = iforest.isolation_forest(df.repartition(7), ["a", "b"], "id").select("id", "is_outlier")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    record = iforest.anomaly_record(iforest.isolation_forest(df, ["a", "b"], "id")).first()
    assert record.n_rows == 3001 and 120 <= record.n_flagged <= 180 and record.min_decision < 0
    assert one.filter("id = 5000 and is_outlier").count() == 1


def test_small_helpers(spark):
    from tablens.operators import plotdata as V
    from tablens.operators import roles
    df = spark.createDataFrame([(i, float(i % 10), "2024-01-0%d" % (i % 9 + 1), "x") for i in range(50)] + [(99, 500.0, None, "y")],
                               "id long, v double, day string, s string")
    assert [tuple(r) for r in Q.dtype_report(df).collect()][1] == ("v", "double", True)
    assert {r.value for r in V.box_fliers(df, "id", ["v"]).collect()} == {500.0}
    some = io.sample_fraction(df, 0.5, seed=1)
    assert 5 < some.count() < 45 and some.exceptAll(df).count() == 0
    assert dict(roles.promote_datetimes(df).dtypes)["day"].startswith(("timestamp", "date")) and dict(roles.promote_datetimes(df).dtypes)["s"] == "string"
