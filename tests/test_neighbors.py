"""Exact nearest neighbours and k-NN imputation against plain loops."""

import math
import random

import pytest

from tablens.operators import cleaning as C
from tablens.operators import neighbors as N


def brute_nearest(queries, donors, k):
    out = []
    for q, *x in queries:
        ranked = sorted((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), d) for d, *y in donors)
        out += [(q, i, d, round(math.sqrt(s), 9)) for i, (s, d) in enumerate(ranked[:k], 1)]
    return sorted(out)


def brute_impute(rows, k):
    """rows: (key, cells...); a missing cell is None."""
    p = len(rows[0]) - 1
    means = [(lambda v: sum(v) / len(v) if v else None)([r[j + 1] for r in rows if r[j + 1] is not None]) for j in range(p)]
    out = []
    for key, *x in rows:
        cells = list(x)
        for j in range(p):
            if x[j] is not None:
                continue
            found = []
            for other, *y in rows:
                both = [i for i in range(p) if x[i] is not None and y[i] is not None]
                if y[j] is not None and both:
                    found.append((sum((x[i] - y[i]) ** 2 for i in both) * (p / len(both)), other, y[j]))
            near = [v for _, _, v in sorted(found)[:k]]
            cells[j] = sum(near) / len(near) if near else means[j]
        out.append((key, *[None if c is None else round(c, 9) for c in cells]))
    return sorted(out)


@pytest.mark.parametrize("block, copies", [(16, 8), (2048, 4096)])
def test_nearest_neighbors_equal_brute_force(spark, monkeypatch, block, copies):
    """Small blocks and copies force rings, dealt rings and copied blocks; a third of the donors are equal."""
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "QUERY_BLOCK", copies)
    rng = random.Random(block)
    donors = [(i, rng.gauss(0, 100), rng.choice([0.0, -0.0, 1.0, 5.0])) for i in range(400)] + [(1000 + i, 3.0, 1.0) for i in range(200)]
    queries = [(i, rng.gauss(0, 120), rng.choice([0.0, 1.0, 40.0])) for i in range(80)] + [(900, 3.0, 1.0), (901, 1e9, 0.0), (902, 3.0, 1.0)]
    rng.shuffle(donors)
    report = {}
    extra = [(5000, None, 1.0), (5001, float("nan"), 1.0), (5002, float("inf"), 1.0)]
    got = N.nearest_neighbors(spark.createDataFrame(queries + extra, "q long, a double, b double"),
                              spark.createDataFrame(donors + extra, "d long, a double, b double"), ["a", "b"], "q", "d", 4, report=report)
    assert got.columns == ["q", "rank", "neighbor_d", "distance"]
    assert sorted((r.q, r["rank"], r.neighbor_d, round(r.distance, 9)) for r in got.collect()) == brute_nearest(queries, donors, 4)
    assert report["pairs"] < 0.5 * len(queries) * len(donors)


def test_few_donors_repeated_queries_and_empty_tables(spark):
    q = spark.createDataFrame([(1, 0.0), (1, 0.0), (2, 5.0)], "q long, a double")
    d = spark.createDataFrame([(7, 1.0), (8, 4.0)], "d long, a double")
    got = sorted((r.q, r["rank"], r.neighbor_d, r.distance) for r in N.nearest_neighbors(q, d, ["a"], "q", "d", 5).collect())
    assert got == sorted([(1, 1, 7, 1.0), (1, 2, 8, 4.0)] * 2 + [(2, 1, 8, 1.0), (2, 2, 7, 4.0)])
    assert N.nearest_neighbors(q, d.limit(0), ["a"], "q", "d", 5).collect() == []
    assert N.nearest_neighbors(q.limit(0), d, ["a"], "q", "d", 5).collect() == []


def test_compared_pairs_stay_well_below_all_pairs(spark):
    rng = random.Random(1)
    rows = [(i, rng.random(), rng.random()) for i in range(4000)]
    df = spark.createDataFrame(rows, "k long, a double, b double")
    report = {}
    got = N.nearest_neighbors(df, df, ["a", "b"], "k", "k", 3, report=report).where("rank = 1").collect()
    assert all(r.k == r.neighbor_k and r.distance == 0 for r in got) and len(got) == 4000
    assert report["pairs"] < 0.1 * 4000 * 4000


@pytest.mark.parametrize("block", [8, 2048])
def test_knn_imputation_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rng = random.Random(block)
    hole = lambda v: None if rng.random() < 0.2 else v
    rows = [(i, hole(rng.gauss(0, 10)), hole(float(rng.randrange(5))), hole(rng.gauss(5, 1)), hole(rng.gauss(0, 1000))) for i in range(150)]
    rows += [(200 + i, 1.0, 2.0, hole(3.0), 4.0) for i in range(60)] + [(300, None, None, None, None)]
    df = spark.createDataFrame([(*r, f"x{r[0]}") for r in rows], "k long, a double, b double, c double, d double, note string").repartition(4)
    got = N.impute_knn(df, ["a", "b", "c", "d"], "k", 5)
    assert got.columns == df.columns
    seen = got.collect()
    assert all(r.note == f"x{r.k}" for r in seen)
    assert sorted((r.k, *[round(x, 9) for x in r[1:5]]) for r in seen) == brute_impute(rows, 5)


def test_knn_imputation_without_shared_columns_nan_and_integers(spark):
    nan = float("nan")
    rows = [(1, 1.0, None), (2, 3.0, None), (3, None, 5), (4, nan, 9), (5, float("inf"), 2)]
    df = spark.createDataFrame(rows, "k long, a double, b int")
    got = sorted(tuple(r) for r in N.impute_knn(df, ["a", "b"], "k").collect())
    # No row has both columns: every missing cell is its column's mean.
    assert got == [(1, 1.0, 16 / 3), (2, 3.0, 16 / 3), (3, 2.0, 5.0), (4, 2.0, 9.0), (5, 2.0, 2.0)]
    full = spark.createDataFrame([(1, 2.0, 3)], "k long, a double, b int")
    assert [tuple(r) for r in N.impute_knn(full, ["a", "b"]).collect()] == [(1, 2.0, 3.0)]
    assert N.impute_knn(full.limit(0), ["a", "b"]).collect() == []
    none = spark.createDataFrame([(1, None, 3), (2, None, None)], "k long, a double, b int")
    assert sorted(tuple(r) for r in N.impute_knn(none, ["a", "b"], "k").collect()) == [(1, None, 3.0), (2, None, 3.0)]


def test_clean_offers_knn(spark):
    df = spark.createDataFrame([(i, float(i), float(i) if i != 5 else None) for i in range(12)], "k int, a double, b double")
    got = {r.k: r.b for r in C.clean(df, ["a", "b"], handle_missing="knn", key="k").collect()}
    assert got[5] == 4.4  # 3, 4, 6, 7 and, of 2 and 8 at equal distance, the smaller key
