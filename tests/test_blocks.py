"""Silhouettes over streamed blocks: no row is copied for the pairs, equal to brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_clustering import brute_silhouette

from riskloom.operators import blocks, neighbours


def table(spark, x, label):
    rows = [(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, "id long, x array<double>, c int").repartition(3)


@pytest.mark.parametrize("d", [2, 3, 9, 64])
def test_silhouettes_copy_no_rows(spark, d, monkeypatch):
    monkeypatch.setattr(blocks, "TILE", 64)
    rng = np.random.default_rng(d)
    x = np.vstack([rng.normal(0, 1, (40, d)), rng.normal(3, 1, (30, d)), np.full((5, d), 3.0), rng.normal(1e3, 1e-4, (25, d))])
    label = np.r_[rng.integers(0, 4, 99), 7]
    out = neighbours.silhouette_samples(table(spark, x, label), "id", "x", "c", block_rows=16)
    assert "Generate" not in out._jdf.queryExecution().toString()
    got = [r["silhouette"] for r in out.orderBy("id").collect()]
    np.testing.assert_allclose(got, brute_silhouette(x, label), atol=1e-12)


def test_rows_without_label_and_equal_ids(spark):
    x = np.random.default_rng(1).random((60, 3))
    label = np.arange(60) % 3
    df = table(spark, x, label)
    more = df.unionByName(df.where("id < 9")).unionByName(df.where("id = 1").withColumn("c", F.lit(None).cast("int")))
    got = neighbours.silhouette_samples(more, "id", "x", "c").orderBy("id").collect()
    twice = np.r_[np.arange(60), np.arange(9)]
    assert [r["id"] for r in got] == list(range(60))
    np.testing.assert_allclose([r["silhouette"] for r in got], brute_silhouette(x[twice], label[twice])[:60], atol=1e-12)


def test_elbow_measures_distances_once(spark, monkeypatch):
    from riskloom.operators import kmeans

    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(c, 0.1, (25, 3)) for c in (0, 1, 2)])
    calls, real = [], neighbours._silhouettes
    monkeypatch.setattr(neighbours, "_silhouettes", lambda *a, **b: calls.append(1) or real(*a, **b))
    got = kmeans.elbow(table(spark, x, np.zeros(75)), "id", "x", [1, 2, 3]).collect()
    assert len(calls) == 1 and [r["k"] for r in got] == [1, 2, 3] and got[0]["silhouette"] == 0.0
    want = brute_silhouette(x, np.repeat([0, 1, 2], 25)).mean()
    assert got[2]["silhouette"] == pytest.approx(want)


def test_nearest_rows_of_crowded_cells(spark, monkeypatch):
    """Rows that would visit every cell meet a stream of blocks: the same neighbours, ties to the smaller id."""
    from riskloom.operators import metric

    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (300, 9)) + 0.0
    x[:100] += rng.random((100, 9))
    rows = spark.createDataFrame([(i % 2, i, [float(v) for v in r], float(i)) for i, r in enumerate(x)], "g int, id long, x array<double>, v double")
    visited = []
    real = metric.MetricIndex.visits
    monkeypatch.setattr(metric.MetricIndex, "visits", lambda *a, **b: visited.append(b.get("radius")) or real(*a, **b))
    monkeypatch.setattr(metric, "FEW_VISITS", 2)
    monkeypatch.setattr(blocks, "LEAST_ROWS", 16)
    got = {r["id"]: [(n["d2"], n["id"], n["v"]) for n in r["near"]] for r in metric.nearest_rows(rows.select("g", "id", "x"), rows, 7, 10).collect()}
    assert "radius" not in visited and len(got) == 300
    for i in range(300):
        d2 = metric.squared(np.repeat(x[i : i + 1], 300, axis=0), x)
        assert got[i] == sorted((d2[j], j, float(j)) for j in range(300) if j % 2 == i % 2)[:7]


@pytest.mark.parametrize(("d", "eps", "m"), [(6, 0.35, 4), (9, 0.7, 5), (5, 3.0, 3)])
def test_density_clusters_of_crowded_cells(spark, monkeypatch, d, eps, m):
    """Places that would visit every cell meet a stream of blocks: the labels of brute force, parts of many blocks joined."""
    from test_clustering import brute_dbscan

    from riskloom.operators import metric, metric_dbscan

    rng = np.random.default_rng(d)
    x = np.vstack([rng.random((200, d)) * 1.2, np.tile(rng.random(d), (9, 1)), np.linspace(2.0, 9.0, 40)[:, None] + np.zeros(d)])
    visited = []
    monkeypatch.setattr(metric.MetricIndex, "visits", lambda *a, **b: visited.append(1))
    monkeypatch.setattr(metric, "FEW_VISITS", -1)
    monkeypatch.setattr(blocks, "LEAST_ROWS", 16)
    rows = [(run, i, [float(v) for v in r]) for run in (0, 1) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "run int, id long, x array<double>").repartition(4)
    got = metric_dbscan.dbscan_vectors(df, {0: (eps, m), 1: (eps / 2, 2)}, block_rows=20).collect()
    labels = {(r["run"], r["id"]): r["label"] for r in got}
    for run, (e, n) in {0: (eps, m), 1: (eps / 2, 2)}.items():
        assert [labels[run, i] for i in range(len(x))] == brute_dbscan(x, e, n).tolist()
    assert not visited


def test_grid_measures_each_point_once(spark, monkeypatch):
    """The silhouettes of all cells of a grid come from one block of each point, with the labels of every cell."""
    from riskloom.operators import density

    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(c, 0.05, (30, 2)) for c in (0, 1, 2)])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    held, real = [], blocks.packed
    monkeypatch.setattr(blocks, "packed", lambda *a: held.append(real(*a)) or held[-1])
    got = density.parameter_sensitivity(df, "id", ["a", "b"], 0.3, 4, eps_values=[0.25, 0.3, 0.4], min_samples_values=[3, 4])
    assert [r["n_clusters"] for r in got.collect()] == [3] * 6
    want = brute_silhouette(x, np.repeat([0, 1, 2], 30)).mean()
    assert all(r["silhouette"] == pytest.approx(want) for r in got.collect())
    assert len(held) == 1 and held[0].agg(F.sum(F.size("ids"))).first()[0] == 90


def test_groups_with_points_of_their_own(spark):
    """Groups whose points differ meet only their own blocks, without copies."""
    rng = np.random.default_rng(9)
    x, label = rng.random((3, 50, 2)), rng.integers(0, 3, (3, 50))
    rows = [(run, i, [float(v) for v in x[run, i]], int(label[run, i])) for run in range(3) for i in range(50)]
    df = spark.createDataFrame(rows, "run int, id long, x array<double>, c int")
    out = neighbours.group_silhouettes(df, ["run"], "x", "c", block_rows=16)
    assert "Generate" not in out._jdf.queryExecution().toString()
    for r in out.collect():
        assert r["silhouette"] == pytest.approx(brute_silhouette(x[r["run"]], label[r["run"]]).mean())
