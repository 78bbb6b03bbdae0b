import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablens.operators import cleaning as C
from tablens.operators import features as FE
from tablens.operators import roles as R
from tablens.sources import io as IO


def test_select_features(micro):
    df = micro["nulls"]
    assert FE.select_features(df, exclude=["id", "zzz"]).columns == ["a", "b", "g"]
    with pytest.raises(ValueError):
        FE.select_features(df, keep=["a", "zzz"])


def test_label_encoding_sorted_and_unseen(spark):
    df = spark.createDataFrame([("c",), ("a",), ("b",), ("a",), (None,)], "s string")
    m = FE.fit_label_encoder(df, "s")
    assert [(r["label"], r["code"]) for r in m.orderBy("code").collect()] == [("a", 0), ("b", 1), ("c", 2)]
    other = spark.createDataFrame([("a",), ("z",)], "s string")
    with pytest.raises(ValueError):
        FE.encode_labels(other, m, "s").collect()
    codes = FE.category_codes(df, "s").orderBy("s").collect()
    assert codes[0]["s_encoded"] == -1


def test_scaling_rules(micro):
    df = micro["constant"]
    s, stats = FE.scale_features(df, "minmax", ["a", "b"])
    r = s.toPandas()
    assert (r.a == 0).all() and r.b.min() == 0 and r.b.max() == 1
    z, st = FE.scale_features(df, "standard", ["a", "b"])
    zz = z.toPandas()
    assert (zz.a == 0).all() and np.isclose(zz.b.std(ddof=0), 1.0)
    back = FE.inverse_scale(z, st, ["b"]).toPandas()
    assert np.allclose(back.b, df.toPandas().b)
    with pytest.raises(ValueError):
        FE.fit_scaler(df, ["a"], "robust")


def test_half_even_rounding_and_coercion(spark, micro):
    df = spark.createDataFrame([(0.25,), (0.35,), (2.5,)], "v double")
    assert [r[0] for r in FE.round_columns(df, ["v"], 1).collect()] == [0.2, 0.4, 2.5]
    got = {r["id"]: r["s"] for r in FE.coerce_numeric(micro["mixed"], ["s"]).collect()}
    assert got == {1: 1.0, 2: None, 3: None, 4: None, 5: None, 6: 1000.0}


def test_ratio_zero_divisor_is_null(micro):
    r = FE.add_ratio(micro["zero_div"], "a", "b", "r", epsilon=None).orderBy("id").collect()
    assert r[0]["r"] is None and r[3]["r"] == 5.0


def test_filters_and_imputers(spark, micro):
    df = micro["nulls"]
    assert C.filter_rules(df, ["a > 1", "b < 7"]).count() == 1  # row 5 only (NULL / NaN fail)
    med = C.impute_median(df, ["a", "b"]).orderBy("id").toPandas()
    assert med.a[1] == np.median([1.0, 3.0, 5.0, 6.0]) and med.a[3] == med.a[1]
    grp = C.impute_median(df, ["a"], group="g").orderBy("id").toPandas()
    assert grp.a[1] == 1.0  # group x median
    mean = C.impute_mean(df, ["b"]).orderBy("id").toPandas()
    assert np.isclose(mean.b[2], np.mean([2, 3, 5, 6, 7]))
    assert C.complete_cases(df).count() == 3


def test_roles(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "x", 2.0, "setosa"), (2, None, "y", 3.0, "virginica")],
                               "Id int, when string, code string, v double, Species string")
    r = {x["column_name"]: (x["role"], x["is_label"], x["is_id"]) for x in R.column_roles(df).collect()}
    assert r["when"][0] == "datetime" and r["code"][0] == "categorical" and r["v"][0] == "numeric"
    assert r["Species"][1] and r["Id"][2]


def test_io_round_trip_and_errors(spark, micro):
    d = tempfile.mkdtemp(prefix="tablens-io-")
    df = micro["nulls"]
    for fmt in ("csv", "json", "parquet"):
        p = f"{d}/t_{fmt}"
        IO.save_table(df, p, fmt)
        back = IO.load_table(spark, p, fmt, required=["id", "a"])
        assert back.count() == df.count()
    csv = IO.load_table(spark, f"{d}/t_csv", "csv")
    assert csv.filter(F.col("g").isNull()).count() == 1
    with pytest.raises(FileNotFoundError):
        IO.load_table(spark, f"{d}/missing", "parquet")
    with pytest.raises(ValueError):
        IO.load_table(spark, f"{d}/t_csv", "xlsx")
    with pytest.raises(ValueError):
        IO.load_table(spark, f"{d}/t_parquet", "parquet", required=["nope"])
    assert IO.sample_rows(df, 3, key=["id"]).count() == 3
    assert {r["id"] for r in IO.sample_rows(df, 3, key=["id"]).collect()} == \
        {r["id"] for r in IO.sample_rows(df.repartition(3), 3, key=["id"]).collect()}
