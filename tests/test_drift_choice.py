"""Distances between samples, the choice of test, and the logged drift run."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift as D
from riskloom.operators import neighbours
from riskloom.operators.registry import ModelRegistry


def area(a, b):
    """Area between two empirical distribution functions, by every step of the merged axis."""
    points = np.unique(np.concatenate([a, b]))
    total = 0.0
    for x, y in zip(points, points[1:]):
        total += abs((a <= x).mean() - (b <= x).mean()) * (y - x)
    return total / max(a.std(), 0.001)


def frame(spark, **columns):
    names = list(columns)
    rows = [tuple(None if v is None or v != v else v for v in r) for r in zip(*columns.values())]
    kinds = ["string" if any(isinstance(v, str) for v in columns[n]) else "double" for n in names]
    return spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def test_wasserstein_against_plain_area(spark):
    rng = np.random.default_rng(1)
    cases = {
        "x": (rng.normal(size=700), rng.normal(0.3, 2.0, 700)),
        "tied": (rng.integers(0, 4, 700) * 1.0, rng.integers(1, 6, 700) * 1.0),
        "one": (np.full(700, 2.0), np.full(700, 2.0)),
        "apart": (rng.random(700), rng.random(700) + 50),
        "hot": (np.where(rng.random(700) < 0.6, 0.0, rng.random(700)), rng.random(700)),
    }
    ref = frame(spark, **{k: v[0].tolist() for k, v in cases.items()}, gap=[None] * 700)
    cur = frame(spark, **{k: v[1].tolist() for k, v in cases.items()}, gap=[1.0] * 700)
    got = {r["feature"]: r["distance"] for r in D.wasserstein_distances(ref, cur, [*cases, "gap"]).collect()}
    for k, (a, b) in cases.items():
        assert got[k] == pytest.approx(area(a, b)), k
    assert got["gap"] is None and got["one"] == 0


def test_jensen_shannon_and_proportions(spark):
    ref = frame(spark, c=["a"] * 30 + ["b"] * 10, b=["y"] * 25 + ["n"] * 15, same=["u"] * 40)
    cur = frame(spark, c=["a"] * 10 + ["c"] * 10 + [None] * 20, b=["y"] * 10 + ["n"] * 30, same=["u"] * 40)
    got = {r["feature"]: r["distance"] for r in D.jensen_shannon_distances(ref, cur, ["c", "same"]).collect()}
    p, q = (0.75, 0.25, 0.0), (0.5, 0.0, 0.5)
    m = [(x + y) / 2 for x, y in zip(p, q)]
    kl = lambda a: sum(x * math.log(x / y) for x, y in zip(a, m) if x)
    assert got["c"] == pytest.approx(math.sqrt((kl(p) + kl(q)) / 2)) and got["same"] == 0
    z = {r["feature"]: r for r in D.proportion_tests(ref, cur, ["b", "same"]).collect()}
    share = 35 / 80
    expect = (25 / 40 - 30 / 40) / math.sqrt(share * (1 - share) * (2 / 40))
    assert z["same"]["statistic"] == 0 and z["same"]["p_value"] == 1
    assert abs(z["b"]["statistic"]) > 1 and z["b"]["p_value"] == pytest.approx(math.erfc(abs(z["b"]["statistic"]) / math.sqrt(2)))
    assert expect < 0


def test_choice_by_type_values_and_rows(spark):
    n = 60
    columns = dict(many=[float(i) for i in range(n)], few=[float(i % 4) for i in range(n)], two=[float(i % 2) for i in range(n)], name=["abc"[i % 3] for i in range(n)], flag=["yn"[i % 2] for i in range(n)])
    df = frame(spark, **columns)
    numeric, categorical = ["many", "few", "two"], ["name", "flag"]
    small = {r["feature"]: r["test"] for r in D.choose_tests(df, numeric, categorical).collect()}
    assert small == {"many": "ks", "few": "chi_square", "two": "z", "name": "chi_square", "flag": "z"}
    large = {r["feature"]: r["test"] for r in D.choose_tests(df, numeric, categorical, small_rows=59).collect()}
    assert large == {"many": "wasserstein", "few": "jensen_shannon", "two": "jensen_shannon", "name": "jensen_shannon", "flag": "jensen_shannon"}
    moved = df.withColumn("many", F.col("many") + 100).withColumn("flag", F.lit("y"))
    for rows in (1_000, 59):
        out = D.drift_report(df, moved, small_rows=rows)
        status = {r["feature"]: r["status"] for r in out["tests"].collect()}
        assert status == {"many": "drift", "few": "no_drift", "two": "no_drift", "name": "no_drift", "flag": "drift"}
        assert out["verdict"].first()["n_drifted"] == 2
    gone = df.withColumn("many", F.lit(None).cast("double"))
    assert {r["feature"]: r["status"] for r in D.drift_report(df, gone)["tests"].collect()}["many"] == "inconclusive"


def test_drift_is_logged(spark, tmp_path):
    df = frame(spark, x=[float(i) for i in range(30)], s=["a", "b", "c"] * 10)
    kept = ModelRegistry(spark, str(tmp_path))
    D.analyze_drift(df, df.withColumn("x", F.col("x") + 100), ["x"], ["s"], log_to=kept)
    assert kept.find_run("drift", "data drift") is not None
    values = {r["key"]: float(r["value"]) for r in kept.values().where("kind = 'metric'").collect()}
    assert values["n_drifted"] == 1 and values["n_features"] == 2 and values["p_value x"] < 0.05


def test_squared_silhouettes_of_many_clusters(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "_CLUSTERS", 3)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(90, 3)) + 1e4
    label = rng.integers(0, 8, 90)
    label[label == 7] = 6
    label[0] = 7  # alone in its cluster
    rows = [(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(x, label))]
    df = spark.createDataFrame([*rows, (90, None, 1), (91, [0.0] * 3, None)], "id long, x array<double>, c int")
    got = {r["id"]: r["silhouette"] for r in neighbours.squared_silhouettes(df, "id", "x", "c").collect()}
    d2 = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert len(got) == 90
    for i in range(90):
        own = (label == label[i]).sum()
        b = min(d2[i, label == c].mean() for c in set(label) if c != label[i])
        a = d2[i, label == label[i]].sum() / (own - 1) if own > 1 else None
        assert got[i] == pytest.approx(0.0 if a is None else (b - a) / max(a, b), abs=1e-6)
    assert neighbours.squared_silhouettes(df.limit(0), "id", "x", "c").collect() == []
