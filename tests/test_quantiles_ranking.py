import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from tablens.functions import quantiles
from tablens.functions.quantiles import key_value, quantile_table, with_ordered_key
from tablens.functions.ranking import rank_distinct


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    g = rng.integers(0, 3, 4000).astype(str)
    v = np.round(rng.lognormal(0, 1, 4000), 2)
    v[:1300] = 7.0  # one hot value holding a third of the rows
    pdf = pd.DataFrame({"g": g, "value": v})
    return pdf, spark.createDataFrame(pdf)


PROBS = {"p0": 0.0, "q1": 0.25, "med": 0.5, "q3": 0.75, "p95": 0.95, "p1": 1.0}


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_exact_quantiles_match_numpy(skewed, monkeypatch, broadcast):
    """A hot value and groups of a third each; found digits joined by shuffle and by broadcast."""
    monkeypatch.setattr(quantiles, "MAX_BROADCAST_ROWS", broadcast)
    pdf, df = skewed
    got = quantile_table(df, ["g"], PROBS).toPandas().set_index("g")
    for g, x in pdf.groupby("g").value:
        exp = np.quantile(x.values, list(PROBS.values()))
        assert got.loc[g, "n"] == len(x)
        assert np.allclose(got.loc[g, list(PROBS)].astype(float).values, exp, rtol=0, atol=1e-12)


def test_global_quantiles(skewed):
    pdf, df = skewed
    r = quantile_table(df, [], [0.1, 0.5, 0.9]).first()
    assert np.allclose([r["p10"], r["p50"], r["p90"]], np.quantile(pdf.value, [0.1, 0.5, 0.9]))


def test_ordered_keys_are_the_bits_of_doubles(spark):
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.integers(-2**63, 2**63 - 1, 3000).view(np.float64), rng.normal(0, 1e5, 500), np.ldexp(1.0, np.arange(-1074, 1024)),
                        np.nextafter(np.ldexp(1.0, np.arange(-1073, 1024)), 0), [0.0, -0.0, np.inf, -np.inf, 5e-324, -5e-324, 1.7976931348623157e308]])
    v = v[~np.isnan(v)]
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "i long, v double")
    rows = with_ordered_key(df, "v", "key").select("key", key_value(F.col("key")).alias("back"), "i").orderBy("i").collect()
    bits = (np.abs(v) + 0.0).view(np.int64)
    assert [r.key for r in rows] == np.where(v < 0, -1 - bits, bits).tolist()
    assert [r.back for r in rows] == v.tolist()


def test_quantiles_of_mixed_groups_and_extreme_values(spark):
    """Null groups, one-row groups, signs, infinities, values that differ in their last bits only."""
    rng = np.random.default_rng(2)
    groups = {None: [1.5], "one": [-3.0], "close": list(1.0 + rng.integers(0, 40, 301) * 2.0**-52), "signs": list(rng.normal(0, 1, 200)) + [0.0, -0.0, 1e-310, -1e-310],
              "far": [float("inf"), float("-inf"), 1e308, -1e308, 2.0], "same": [7.25] * 50}
    df = spark.createDataFrame([(g, float(x)) for g, xs in groups.items() for x in xs] + [("none", None)], "g string, value double").repartition(6)
    got = {r.g: r for r in quantile_table(df, ["g"], {"a": 0.0, "b": 0.25, "c": 0.5, "d": 1.0}).collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        s = np.sort(np.array(xs))
        low, high = s[(len(s) - 1) // 2], s[len(s) // 2]
        assert got[g].n == len(xs) and (got[g].a, got[g].c, got[g].d) == (s[0], low if low == high else low + 0.5 * (high - low), s[-1])
    assert quantile_table(df.limit(0), ["g"], [0.5]).collect() == []


def test_approx_quantiles_close(skewed):
    pdf, df = skewed
    r = quantile_table(df, [], {"m": 0.5}, method="approx").first()
    assert abs(r["m"] - np.median(pdf.value)) < 0.2


def test_nulls_ignored(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (float("nan"),)], "value double")
    from tablens.functions.frames import long_form
    r = quantile_table(long_form(df, ["value"]), [], {"m": 0.5}).first()
    assert r["n"] == 2 and r["m"] == 2.0


@pytest.mark.parametrize("slice_rows", [50, 1_000_000])
def test_rank_distinct_both_paths(spark, slice_rows):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 3000).astype(str), "value": rng.integers(0, 400, 3000).astype(float)})
    got = rank_distinct(spark.createDataFrame(pdf), ["g"], rows_per_slice=slice_rows).toPandas() \
        .sort_values(["g", "value"]).reset_index(drop=True)
    exp = pdf.groupby(["g", "value"]).size().rename("c").reset_index().sort_values(["g", "value"])
    exp["start_rank"] = exp.groupby("g").c.cumsum() - exp.c + 1
    exp["prev"] = exp.groupby("g").value.shift()
    assert (got.c.values == exp.c.values).all()
    assert (got.start_rank.values == exp.start_rank.values).all()
    assert np.allclose(got.prev_value.fillna(-1).values, exp.prev.fillna(-1).values)


def test_compact_local_and_checkpoint_paths(spark):
    from tablens.session import compact
    df = spark.range(50).withColumnRenamed("id", "k")
    small, n = compact(df, max_rows=100)
    assert n == 50 and small.count() == 50
    big, n2 = compact(df, max_rows=10)  # over the limit: reliable checkpoint, then counted
    assert n2 == 50 and sorted(r["k"] for r in big.collect()) == list(range(50))
