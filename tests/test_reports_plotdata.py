import json

import numpy as np
import pandas as pd
import pytest

from conftest import SF_SMALL
from pyspark.sql import functions as F
from tablens.operators import plotdata as V
from tablens.plans.reports import report_rows, summary_report


@pytest.fixture(scope="module")
def grouped(spark):
    rng = np.random.default_rng(31)
    pdf = pd.DataFrame({"id": np.arange(600), "g": np.repeat(["a", "b", "c"], 200),
                        "x": np.r_[rng.normal(0, 1, 200), rng.normal(5, 2, 200), rng.exponential(1, 200)],
                        "y": rng.normal(size=600)})
    return pdf, spark.createDataFrame(pdf)


def test_box_stats_match_numpy(grouped):
    pdf, df = grouped
    b = V.box_stats(df, ["x"], group="g").toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        x = part.x.values
        q1, med, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert np.isclose(b.loc[g, "median"], med)
        assert np.isclose(b.loc[g, "whisker_low"], x[x >= lo].min())
        assert np.isclose(b.loc[g, "whisker_high"], x[x <= hi].max())
        assert b.loc[g, "n_fliers"] == ((x < lo) | (x > hi)).sum()


def test_caps_and_pairs(grouped):
    pdf, df = grouped
    s = V.strip_points(df, "id", ["x", "y"], group="g", cap=25).toPandas()
    assert s.groupby(["g", "column_name"]).size().max() == 25
    again = V.strip_points(df.repartition(5), "id", ["x", "y"], group="g", cap=25).toPandas()
    assert set(map(tuple, s[["id", "column_name"]].values)) == set(map(tuple, again[["id", "column_name"]].values))
    p = V.pair_points(df, "id", ["x", "y"], group="g", sample=50)
    assert p.count() == 100 and p.select("id").distinct().count() == 50
    low = V.pair_points(df, "id", ["x", "y"], sample=None, lower_only=True)
    assert low.count() == 600


def test_summary_report_parts(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    rep = summary_report(ev.withColumn("user_id", F.col("user_id").cast("double")), ["value", "user_id"], label="event_type", key="event_id", ts="ts")
    assert {"clusters", "cluster_importance", "forest", "calendar", "monthly_means", "gaps", "periods"} <= set(rep)
    rows = report_rows({k: rep[k] for k in ("info", "missing", "gaps", "clusters")}).collect()
    assert {r.section for r in rows} == {"info", "missing", "gaps", "clusters"}
    assert [json.loads(r.row)["n_gaps"] for r in rows if r.section == "gaps"] == [999]
    record = rep["forest"].first()
    assert record.n_rows == 1000 and 40 <= record.n_flagged <= 60 and record.min_decision < 0 < record.max_decision
    assert rep["clusters"].agg(F.sum("size")).first()[0] == 2 * 1000
    assert {r.column_name for r in rep["periods"].collect()} <= {"value", "user_id"}
    for name in ("info", "missing", "describe", "anomalies", "importance", "group_stats", "top_groups",
                 "quality_issues"):
        assert rep[name].count() >= 0
    assert rep["top_groups"].count() == 3
    assert {r["method"] for r in rep["anomalies"].collect()} == {"iqr", "zscore_sample", "modified_zscore"}
