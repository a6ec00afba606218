import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import kmeans
from riskloom.operators import minibatch as M


def blobs(n=600, k=4, d=3, seed=5):
    rng = np.random.default_rng(seed)
    middle = rng.uniform(-20, 20, (k, d))
    return middle[rng.integers(0, k, n)] + rng.normal(0, 0.5, (n, d))


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>")


def test_batches_equal_a_plain_run_over_the_same_rows(spark):
    x = blobs()
    df = frame(spark, x)
    batch = {r["id"]: r["b"] for r in df.select("id", M.batch_of("id", 5).alias("b")).collect()}
    assert set(batch.values()) == set(range(5))
    centres, seen = M.start(df, 4), np.zeros(4)
    for step in range(7):
        mine = [i for i in batch if batch[i] == step % 5]
        best = [int(((x[i] - centres) ** 2).sum(axis=1).argmin()) for i in mine]
        new = centres.copy()
        for c in range(4):
            own = [x[i] for i, b in zip(mine, best, strict=True) if b == c]
            if own:
                new[c] = (seen[c] * centres[c] + np.sum(own, axis=0)) / (seen[c] + len(own))
                seen[c] += len(own)
        centres = new
    model = M.fit_minibatch(df.repartition(5), "id", "x", 4, batch_size=120, steps=7)
    assert np.allclose(model.centres, centres, atol=1e-9)


def test_groups_are_found_and_every_row_goes_to_its_nearest_centre(spark):
    x = blobs()
    df = frame(spark, x)
    model = M.fit_minibatch(df, "id", "x", 4, batch_size=200, steps=20)
    out = {r["id"]: r for r in model.transform(df, "x").collect()}
    gaps = ((x[:, None, :] - model.centres) ** 2).sum(axis=2)
    assert [out[i]["cluster"] for i in range(len(x))] == gaps.argmin(axis=1).tolist()
    assert model.cost(df, "x") == pytest.approx(gaps.min(axis=1).sum())
    assert gaps.min(axis=1).mean() < 2.0


def test_missing_vectors_ties_and_equal_rows(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(30)] + [(99, None)], "id long, x array<double>")
    model = M.fit_minibatch(df, "id", "x", 3, batch_size=10, steps=4)
    assert model.centres.tolist() == [[1.0, 1.0]]
    out = model.transform(df.withColumn("cluster", F.lit("old")), "x")
    assert out.columns == ["id", "x", "cluster", "distance"]
    assert {(r["cluster"], r["distance"]) for r in out.collect()} == {(0, 0.0), (None, None)}
    assert M.KMeansCentres(np.array([[0.0], [2.0]])).transform(spark.createDataFrame([(1, [1.0])], "id int, x array<float>"), "x").first()["cluster"] == 0
    with pytest.raises(ValueError):
        M.fit_minibatch(df.limit(0), "id", "x", 2)


def test_elbow_over_batches(spark):
    got = kmeans.elbow(frame(spark, blobs()), "id", "x", [1, 2, 4], batch_size=200).orderBy("k").collect()
    costs = [r["inertia"] for r in got]
    assert costs[0] > costs[1] > costs[2] and got[2]["silhouette"] > 0.8
