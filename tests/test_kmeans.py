"""Many k-means models in one sweep against a plain loop per model."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablens.operators import kmeans as K
from tablens.operators import ml as M


def plain_lloyd(x, centers, passes):
    centers = centers.copy()
    for _ in range(passes):
        at = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        for c in range(len(centers)):
            if (at == c).any():
                centers[c] = x[at == c].mean(axis=0)
    return centers, ((x[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1).sum()


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(m, 0.4, (120, 3)) for m in ([0, 0, 0], [5, 5, 0], [-5, 4, 3])] + [np.tile([[9.0, 9, 9]], (90, 1))])
    rows = [(i, *map(float, v)) for i, v in enumerate(x)]
    return x, spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(20)


def test_all_models_move_as_if_alone(spark, blobs, monkeypatch):
    """Twenty partitions: the sums of tasks are added in groups first."""
    monkeypatch.setattr(K, "BLOCK_ROWS", 16)
    x, df = blobs
    blocks = K.pack_blocks(df, ["a", "b", "c"])
    starts = [x[:1], x[[0, 200]], x[[0, 130, 250, 400]], np.vstack([x[:2], [[500.0, 0, 0]]])]
    for passes in (1, 4):
        fits = K.lloyd(blocks, 3, starts, passes, -1.0)
        for start, got in zip(starts, fits, strict=True):
            centers, cost = plain_lloyd(x, start, passes)
            assert np.allclose(got.centers, centers, atol=1e-9) and got.cost == pytest.approx(cost, rel=1e-9) and got.passes == passes
    done = K.lloyd(blocks, 3, starts)
    assert all(m.passes < 50 for m in done) and tuple(done[3].centers[2]) == (500.0, 0, 0)


def test_sample_holds_each_row_once(spark, blobs):
    x, df = blobs
    blocks = K.pack_blocks(df, ["a", "b", "c"])
    every = K.sample_rows(blocks, 3, 1)
    assert sorted(map(tuple, every)) == sorted(map(tuple, x))
    some = K.sample_rows(blocks, 3, 1, 50)
    assert len(some) == 50 and np.array_equal(some, K.sample_rows(blocks, 3, 1, 50))
    hot = (some == 9.0).all(axis=1).sum()
    assert 2 <= hot <= 25  # a fifth of the rows are equal


def test_few_rows_reach_the_driver(spark, blobs, monkeypatch):
    """One row a pass and the sample's rows, however many partitions there are."""
    monkeypatch.setattr(K, "BLOCK_ROWS", 8)
    x, df = blobs
    blocks = K.pack_blocks(df, ["a", "b", "c"])
    assert blocks.rdd.getNumPartitions() == 20
    got, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: got.append(collect(self)) or got[-1])
    K.lloyd(blocks, 3, [x[:4], x[:2]], 3, -1.0)
    assert [len(rows) for rows in got] == [1] * 4
    got.clear()
    K.sample_rows(blocks, 3, 1, 4)
    assert max(len(rows) for rows in got) <= 80


def test_sample_holds_the_least_draws(spark, blobs):
    x, df = blobs
    blocks = K.pack_blocks(df, ["a", "b", "c"])
    drawn = [(d, v) for r in blocks.collect() for d, v in zip(np.random.default_rng([1, r["block"]]).random(r["n"]), np.frombuffer(r["data"], "<f8").reshape(-1, 3).tolist(), strict=True)]
    assert K.sample_rows(blocks, 3, 1, 30).tolist() == [v for _, v in sorted(drawn)[:30]]


def test_blocks_of_one_partition_are_spread(spark, blobs, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_ROWS", 16)
    x, df = blobs
    blocks = K.pack_blocks(df.coalesce(1).union(df.where("id < 0")), ["a", "b", "c"])  # the other partitions are empty
    sizes = [r["count"] for r in blocks.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= spark.sparkContext.defaultParallelism and max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert sorted(v for r in blocks.collect() for v in np.frombuffer(r["data"], "<f8").reshape(-1, 3).tolist()) == sorted(x.tolist())
    centers, cost = plain_lloyd(x, x[[0, 130, 250, 400]], 3)
    got, = K.lloyd(blocks, 3, [x[[0, 130, 250, 400]]], 3, -1.0)
    assert np.allclose(got.centers, centers, atol=1e-9) and got.cost == pytest.approx(cost, rel=1e-9)


@pytest.mark.parametrize("dims", [2, 12])
def test_nearest_is_the_first_among_equals(dims):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 3, (500, dims)).astype(float)
    c = rng.integers(0, 3, (9, dims)).astype(float)
    at, best = K._nearest(np.ascontiguousarray(x.T), c, (c * c).sum(axis=1))
    far = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (at == far.argmin(axis=1)).all() and np.allclose(best + (x * x).sum(axis=1), far.min(axis=1))


def test_elbow_and_clusters_of_blobs(spark, blobs):
    x, df = blobs
    models = M.elbow_models(df, ["a", "b", "c"], max_clusters=6, starts=3)
    costs = [models[k].cost for k in range(1, 7)]
    assert costs == sorted(costs, reverse=True)
    assert costs[0] == pytest.approx(((x - x.mean(axis=0)) ** 2).sum(), rel=1e-9)
    # The true number of groups leaves only the spread within them.
    assert costs[3] == pytest.approx(sum(((g - g.mean(axis=0)) ** 2).sum() for g in (x[:120], x[120:240], x[240:360])), rel=1e-6)
    got = {r.id: r.cluster for r in M.cluster(df, ["a", "b", "c"], "id", k=4, starts=5).collect()}
    groups = [{got[i] for i in part} for part in (range(120), range(120, 240), range(240, 360), range(360, 450))]
    assert [len(g) for g in groups] == [1] * 4 and len(set.union(*groups)) == 4


def test_edge_tables(spark):
    empty = spark.createDataFrame([], "id long, a double, b double")
    assert M.cluster(empty, ["a", "b"], "id").collect() == [] and M.cluster(empty, ["a", "b"], "id", k=3).collect() == []
    same = spark.createDataFrame([(i, 2.0, 3.0) for i in range(12)] + [(50, None, 1.0)], "id long, a double, b double")
    assert M.cluster(same, ["a", "b"], "id", k=3).count() == 12
    assert [r.inertia for r in M.inertia_curve(same.dropna(), ["a", "b"]).collect()] == [0.0, 0.0]


def test_silhouette_equals_a_plain_loop(spark):
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(m, 1.0, (25, 2)) for m in (0, 3)] + [[[50.0, 50.0]]])
    label = [0] * 25 + [1] * 25 + [7]
    df = spark.createDataFrame([(i, *map(float, v), c) for i, (v, c) in enumerate(zip(x, label, strict=True))], "id long, a double, b double, cluster int").repartition(20)
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    scores = []
    for i, c in enumerate(label):
        mine = [j for j, o in enumerate(label) if o == c and j != i]
        a = far[i, mine].mean() if mine else None
        b = min(far[i, [j for j, o in enumerate(label) if o == k]].mean() for k in {0, 1, 7} - {c})
        scores.append((b - a) / max(a, b) if mine else 0.0)
    both = df.select("id", "a", "b"), df.select("id", "cluster")
    assert M.silhouette(*both, "id", ["a", "b"]) == pytest.approx(np.mean(scores), abs=1e-9)
    some = M.silhouette(*both, "id", ["a", "b"], sample=20)
    assert some != pytest.approx(np.mean(scores), abs=1e-9) and abs(some - np.mean(scores)) < 0.2
    assert M.silhouette(both[0], df.select("id", (df.cluster * 0).alias("cluster")), "id", ["a", "b"]) is None
