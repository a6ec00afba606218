import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import components as C
from riskloom.operators import dbscan as D
from riskloom.operators import density, kmeans, neighbours, reduction


def brute_dbscan(x, eps, m):
    d2 = sum((x[:, i][:, None] - x[:, i][None, :]) ** 2 for i in range(x.shape[1]))
    near = d2 <= eps * eps
    core = near.sum(1) >= m
    label = np.full(len(x), -1)
    k = 0
    for i in range(len(x)):
        if not core[i] or label[i] != -1:
            continue
        todo = [i]
        label[i] = k
        while todo:
            p = todo.pop()
            for q in np.flatnonzero(near[p]):
                if label[q] == -1:
                    label[q] = k
                    if core[q]:
                        todo.append(q)
        k += 1
    for i in np.flatnonzero(~core):
        owners = label[np.flatnonzero(near[i] & core)]
        label[i] = owners.min() if len(owners) else -1
    return label


def frame(spark, x):
    names = [f"v{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names)), names


def check(spark, x, eps, m, **kw):
    df, names = frame(spark, x)
    got = [r["label"] for r in D.dbscan(df, "id", names, eps, m, **kw).orderBy("id").collect()]
    assert got == brute_dbscan(x, eps, m).tolist()


@pytest.mark.parametrize("d,eps,m", [(1, 0.02, 4), (2, 0.08, 5), (3, 0.2, 6)])
def test_dbscan_matches_brute_force(spark, d, eps, m):
    rng = np.random.default_rng(d)
    blobs = [rng.normal(c, 0.05, (60, d)) for c in (0.0, 0.4, 1.0)]
    check(spark, np.vstack([*blobs, rng.random((80, d)) * 1.5]), eps, m)


def test_dbscan_crowded_cells_and_duplicates(spark):
    rng = np.random.default_rng(9)
    # Most rows sit in two crowded cells; one location holds a third of them.
    hot = np.tile([[0.5, 0.5]], (150, 1))
    near = 0.5 + rng.random((150, 2)) * 0.01
    ring = np.column_stack([np.cos(np.linspace(0, 6, 60)), np.sin(np.linspace(0, 6, 60))]) * 0.09 + 0.5
    x = np.vstack([ring, hot, near, rng.random((40, 2))])
    check(spark, x, 0.08, 5)
    check(spark, x, 0.08, 5, direct_pairs=4)


def test_dbscan_small_boxes_and_distributed_components(spark, monkeypatch):
    monkeypatch.setattr(D, "CHEAP_PAIRS", 10)
    rng = np.random.default_rng(11)
    x = np.vstack([rng.random((250, 2)) * [1.0, 0.2], rng.random((50, 2)) + 2])
    check(spark, x, 0.09, 4, direct_pairs=6, small_edges=0)


def test_dbscan_of_all_applications(spark):
    from riskloom.plans import cluster_queries as Q

    sf = "/root/testdata/sf0.001"
    rows = Q._complete(spark, sf).orderBy("app_id").collect()
    want = brute_dbscan(np.array([[r[c] for c in Q._SCALED] for r in rows]), 0.15, 10)
    got = {r["app_id"]: r["label"] for r in Q.dbscan_applications(spark, sf).collect()}
    assert [got[r["app_id"]] for r in rows] == want.tolist() and len(got) == len(rows)


def test_dbscan_border_between_two_chains(spark):
    left = [[i * 1.0, 0.0] for i in range(5)]
    right = [[i * 1.0 + 6.0, 0.0] for i in range(5)]
    # The middle point reaches one end of each chain and is not core; distance exactly eps counts.
    check(spark, np.array(right + left + [[5.0, 0.0]]), 1.0, 3)


def test_dbscan_all_noise_and_salted_join(spark, monkeypatch):
    monkeypatch.setattr(D, "SALT_ROWS", 3)
    rng = np.random.default_rng(2)
    check(spark, rng.random((30, 2)) * 100, 0.1, 3)
    check(spark, np.vstack([rng.random((100, 2)) * 0.05, [[0.12, 0.02], [0.13, 0.05]]]), 0.1, 8)


def test_dbscan_refuses(spark):
    df, names = frame(spark, np.zeros((2, 4)))
    with pytest.raises(ValueError):
        D.dbscan(df, "id", [], 1.0)
    with pytest.raises(ValueError):
        D.dbscan(df, "id", names[:2], 0.0)


@pytest.mark.parametrize("small", [0, 10**6])
def test_components_on_a_long_chain(spark, small):
    edges = [(0, i, i + 1) for i in range(200)] + [(0, 500, 501), (1, 7, 3)]
    nodes = [(0, i) for i in range(201)] + [(0, 500), (0, 501), (0, 900), (1, 3), (1, 7)]
    got = C.connected_components(
        spark.createDataFrame(nodes, "run int, node long"), spark.createDataFrame(edges, "run int, u long, v long"), small_edges=small
    )
    roots = {(r["run"], r["node"]): r["root"] for r in got.collect()}
    assert all(roots[0, i] == 0 for i in range(201))
    assert (roots[0, 501], roots[0, 900], roots[1, 7]) == (500, 900, 3) and len(roots) == len(nodes)


def brute_silhouette(x, lab):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i in range(len(x)):
        own = (lab == lab[i]) & (np.arange(len(x)) != i)
        if not own.any():
            out.append(0.0)
            continue
        a = d[i, own].mean()
        b = min(d[i, lab == o].mean() for o in set(lab) - {lab[i]})
        out.append((b - a) / max(a, b))
    return np.array(out)


def test_silhouettes(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(70, 3))
    lab = np.array([0] * 40 + [1] * 28 + [2] + [-1])
    rows = [(i, [float(v) for v in r], int(k)) for i, (r, k) in enumerate(zip(x, lab))]
    df = spark.createDataFrame(rows, "id long, x array<double>, c int")
    got = neighbours.silhouette_samples(df, "id", "x", "c").orderBy("id").collect()
    np.testing.assert_allclose([r["silhouette"] for r in got], brute_silhouette(x, lab), atol=1e-12)
    cut = neighbours.silhouette_samples(df, "id", "x", "c", block_rows=13).orderBy("id").collect()
    np.testing.assert_allclose([r["silhouette"] for r in cut], brute_silhouette(x, lab), atol=1e-12)
    assert neighbours.silhouette_samples(df, "id", "x", "c", drop_noise=True).count() == 69
    assert neighbours.silhouette_samples(df, "id", "x", "c", sample_size=30).count() == 30
    assert neighbours.silhouette_samples(df.where("c = 0"), "id", "x", "c").count() == 0


def test_k_distance_counts_itself(spark):
    df = spark.createDataFrame([(i, [float(i)]) for i in range(12)], "id long, x array<double>")
    got = {r["id"]: r["distance"] for r in neighbours.k_distances(df, "id", "x", 3, 10).collect()}
    assert got[0] == 2.0 and got[5] == 1.0
    idx = [r["idx"] for r in neighbours.k_distances(df, "id", "x", 3, 10).orderBy(F.col("distance").desc(), "id").collect()]
    assert idx == list(range(12))
    cut = {r["id"]: r["distance"] for r in neighbours.k_distances(df, "id", "x", 3, 10, block_rows=4).collect()}
    assert cut == got
    with pytest.raises(ValueError):
        neighbours.k_distances(df, "id", "x", 11, 10)


def test_knee_of_a_corner(spark):
    values = [10.0 - i for i in range(9)] + [1.0 - 0.01 * i for i in range(60)]
    curve = spark.createDataFrame(list(enumerate(values)), "idx int, value double")
    assert D.knee(curve).first()["idx"] == 9
    assert D.knee(spark.createDataFrame([(0, 1.0), (1, 1.0)], "idx int, value double")).count() == 0


def test_sensitivity_grid(spark):
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal(0, 0.05, (40, 2)), rng.normal(2, 0.05, (40, 2)), rng.random((10, 2)) * 5])
    df, names = frame(spark, x)
    got = density.parameter_sensitivity(df, "id", names, 0.2, 5).collect()
    assert len(got) == 6 * 7 and sum(r["recommended"] for r in got) == 1
    for r in got[::5]:
        lab = brute_dbscan(x, r["eps"], r["min_samples"])
        assert r["n_noise"] == (lab == -1).sum() and r["n_clusters"] == len(set(lab) - {-1})
        kept = lab != -1
        if r["silhouette"] is not None:
            assert r["silhouette"] == pytest.approx(brute_silhouette(x[kept], lab[kept]).mean())


def test_density_importance(spark):
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal([0, 0], 0.05, (40, 2)), rng.normal([2, 0], 0.05, (40, 2))])
    df, names = frame(spark, x)
    got = {r["feature"]: r for r in density.density_importance(df, "id", names, 0.2, 5).collect()}
    assert set(got) == {"v0", "v1"} and got["v0"]["std"] >= 0


def test_pca_against_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5)) + 3
    df, names = frame(spark, x)
    arr = reduction.feature_array(df, names)
    pcs = reduction.Components.fit(arr, "features", 5, names)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    table = pcs.explained_variance(spark).orderBy("component").collect()
    np.testing.assert_allclose([r["variance"] for r in table], values, rtol=1e-8)
    assert table[-1]["cumulative"] == pytest.approx(1.0)
    np.testing.assert_allclose(pcs.loadings.T @ pcs.loadings, np.eye(5), atol=1e-9)
    scores = np.array([r["pc"] for r in pcs.transform(arr, "features").orderBy("id").collect()])
    np.testing.assert_allclose(scores, (x - x.mean(0)) @ pcs.loadings, atol=1e-9)
    lead = pcs.loadings[np.abs(pcs.loadings).argmax(0), range(5)]
    assert (lead > 0).all()
    assert pcs.biplot_table(spark, 2).count() == 2 and pcs.importance_table(spark, 3).first()["rank"] == 1


def test_kmeans_assignment_elbow_importance(spark):
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal([0, 0, 0], 0.1, (50, 3)), rng.normal([5, 5, 0], 0.1, (50, 3))])
    df, names = frame(spark, x)
    arr = reduction.feature_array(df, names, "x").select("id", "x")
    model, out = kmeans.fit_kmeans(arr, "x", 2, "id", sample_size=40)
    labels = [r["cluster"] for r in out.orderBy("id").collect()]
    assert len(set(labels[:50])) == 1 and len(set(labels)) == 2
    centres = kmeans.centroids(out, "cluster", "x")
    assert [r["cluster"] for r in kmeans.assign_nearest(arr, "x", centres).orderBy("id").collect()] == labels
    assert kmeans.centroid_distances(spark, centres).first()["distance"] == pytest.approx(50**0.5, abs=0.2)
    assert kmeans.centroid_sizes(centres).agg(F.max("scaled")).first()[0] == 100.0
    curve = kmeans.elbow(arr, "id", "x", [1, 2, 3]).orderBy("k").collect()
    assert curve[0]["silhouette"] == 0.0 and curve[1]["silhouette"] > 0.9 and curve[0]["inertia"] > curve[1]["inertia"] > curve[2]["inertia"]
    imp = kmeans.kmeans_importance(model, arr, "id", "x", names, sample_size=60).collect()
    assert imp[2]["feature"] == "v2" and imp[0]["importance"] > 0.1 > imp[2]["importance"]


def test_permuted_copies_use_each_value_once(spark):
    df = spark.createDataFrame([(i, [float(i), float(-i)]) for i in range(20)], "id long, x array<double>")
    got = kmeans.permuted_copies(df, "id", "x", 2, 2).collect()
    assert len(got) == 20 + 4 * 20
    part = [r for r in got if r["feature"] == 1 and r["repeat"] == 0]
    assert sorted(r["x"][1] for r in part) == sorted(float(-i) for i in range(20))
    assert all(r["x"][0] == r["id"] for r in part) and any(r["x"][1] != -r["id"] for r in part)
