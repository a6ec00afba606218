"""Histogram boosting against a plain version that grows leaf by leaf."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import boosting as B
from riskloom.operators import explain


def data(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), rng.random(n), (rng.random(n) < 0.1) * 1.0, np.full(n, 3.0)])
    odds = 1.5 * x[:, 0] - 0.8 * (x[:, 1] == 2) + 2.0 * x[:, 3] * x[:, 2] - 1.0
    return x, (rng.random(n) < 1 / (1 + np.exp(-odds))).astype(float)


def frame(spark, x, y, parts=3):
    rows = [([float(v) for v in r], float(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "features array<double>, label double").repartition(parts)


def plain(x, y, s, cuts):
    """Trees as nested tuples ``(feature, cut, left, right)`` or leaf values, and the margins."""
    mean = y.mean()
    margin = np.full(len(y), math.log(mean / (1 - mean)))
    trees = []
    for _ in range(s.n_estimators):
        p = 1 / (1 + np.exp(-margin))
        w = np.where(y > 0, s.scale_pos_weight, 1.0)
        g, h = np.rint(w * (p - y) * B.UNIT), np.rint(w * p * (1 - p) * B.UNIT)

        def part(a, b):
            a, b = a / B.UNIT, b / B.UNIT
            return (np.sign(a) * max(abs(a) - s.reg_alpha, 0)) ** 2 / (b + s.reg_lambda)

        def best(rows):
            found = (0.0, None)
            for j in range(x.shape[1]):
                for c in cuts[j]:
                    left = rows[x[rows, j] <= c]
                    right = rows[x[rows, j] > c]
                    if min(len(left), len(right)) < max(1, s.min_child_samples):
                        continue
                    if min(h[left].sum(), h[right].sum()) < s.min_child_weight * B.UNIT:
                        continue
                    gain = part(g[left].sum(), h[left].sum()) + part(g[right].sum(), h[right].sum()) - part(g[rows].sum(), h[rows].sum())
                    if gain > found[0]:
                        found = (gain, (j, float(c), left, right))
            return found

        leaves = {(): (np.arange(len(y)), best(np.arange(len(y))))}
        splits = {}
        while len(leaves) < s.num_leaves:
            path = min(leaves, key=lambda k: (-leaves[k][1][0], k))
            gain, cut = leaves[path][1]
            if cut is None:
                break
            del leaves[path]
            splits[path] = cut[:2]
            for side in (0, 1):
                leaves[(*path, side)] = (cut[2 + side], best(cut[2 + side]))
        if not splits:
            break

        def value(rows):
            a, b = g[rows].sum() / B.UNIT, h[rows].sum() / B.UNIT + s.reg_lambda
            return -np.sign(a) * max(abs(a) - s.reg_alpha, 0) / b

        def nested(path):
            if path in splits:
                return (*splits[path], nested((*path, 0)), nested((*path, 1)))
            rows = leaves[path][0]
            margin[rows] += s.learning_rate * value(rows)
            return value(rows)

        trees.append(nested(()))
    return trees, margin


def nested(t, node=0):
    if t.left[node] < 0:
        return t.value[node]
    return (t.feature[node], t.threshold[node], nested(t, t.left[node]), nested(t, t.right[node]))


def same(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return a[:2] == b[:2] and same(a[2], b[2]) and same(a[3], b[3])
    return not isinstance(a, tuple) and not isinstance(b, tuple) and abs(a - b) < 1e-9


@pytest.mark.parametrize(
    "params",
    [
        dict(n_estimators=4, num_leaves=6, min_child_samples=5),
        dict(n_estimators=3, num_leaves=31, min_child_samples=15, reg_alpha=0.5, reg_lambda=5.0, scale_pos_weight=3.0),
        dict(n_estimators=2, num_leaves=2, max_bin=8),
        dict(n_estimators=12, num_leaves=3, learning_rate=0.5),
    ],
)
def test_same_trees_as_leaf_by_leaf(spark, params):
    x, y = data()
    s = B.Settings(**params)
    df = frame(spark, x, y)
    trees, start, width = B.fit_boosting(df, "features", "label", s)
    cuts = B.bin_cuts(df.withColumnRenamed("features", "x"), width, s.max_bin)
    expect, margin = plain(x, y, s, cuts)
    assert len(trees) == len(expect) == s.n_estimators
    assert all(same(nested(t), e) for t, e in zip(trees, expect))
    model = B.BoostedTreesModel("features", trees, start, s.learning_rate, width)
    assert np.allclose(model.margins(x), margin)
    assert all(sum(v < 0 for v in t.left) <= s.num_leaves for t in trees)


def test_partitions_change_nothing(spark):
    x, y = data(300, 2)
    s = B.Settings(n_estimators=2, num_leaves=8, min_child_samples=5, colsample_bytree=0.6)
    one = B.fit_boosting(frame(spark, x, y, 1), "features", "label", s)
    assert one == B.fit_boosting(frame(spark, x, y, 7), "features", "label", s)


def test_penalties_and_draws_change_scores(spark):
    x, y = data()
    df = frame(spark, x, y)
    base = dict(n_estimators=2, num_leaves=6, min_child_samples=5)
    margins = []
    changes = ({}, {"reg_alpha": 2.0}, {"reg_lambda": 10.0}, {"subsample": 0.5, "subsample_freq": 1}, {"colsample_bytree": 0.4}, {"subsample": 0.5})
    for change in changes:
        model = B.BoostedTrees("features", "label", **base, **change).fit(df)
        margins.append(model.margins(x))
    for i in range(1, 5):
        assert not np.allclose(margins[0], margins[i])
    assert np.array_equal(margins[0], margins[5])
    assert np.abs(margins[2]).max() < np.abs(margins[0]).max()


def test_pipeline_saved_and_loaded(spark, tmp_path):
    x, y = data(200)
    df = frame(spark, x, y)
    model = Pipeline(stages=[B.BoostedTrees("features", "label", n_estimators=3, num_leaves=4, min_child_samples=5)]).fit(df)
    model.write().save(f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m")

    def scores(m):
        out = m.transform(df).select("features", "label", vector_to_array("probability").alias("p"), vector_to_array("rawPrediction").alias("r"), "prediction")
        return sorted(tuple(map(str, r)) for r in out.collect())

    assert scores(model) == scores(again)
    stage = model.stages[0]
    row = model.transform(df).select("features", vector_to_array("probability").alias("p")).first()
    assert row["p"][1] == pytest.approx(1 / (1 + math.exp(-stage.margins(np.array([row["features"]]))[0])))
    importance = stage.featureImportances.toArray()
    assert importance.sum() == pytest.approx(1) and importance[4] == 0


def test_contributions_add_up(spark):
    x, y = data(200)
    df = frame(spark, x, y)
    model = B.BoostedTrees("features", "label", n_estimators=4, num_leaves=7, min_child_samples=5).fit(df)
    told = explain.tree_contributions(model, df.select(F.col("features").alias("x")))
    for r in told.collect():
        assert r["base_value"] + sum(r["contributions"]) == pytest.approx(model.margins(np.array([r["x"]]))[0])


def test_edges(spark):
    df = spark.createDataFrame([([1.0, float("nan")], 1.0), ([2.0, 5.0], 0.0), (None, 1.0), ([1.0, 2.0], None)] * 30, "features array<double>, label double")
    model = B.BoostedTrees("features", "label", n_estimators=2, min_child_samples=1).fit(df)
    rows = model.transform(df).collect()
    assert [r["probability"] is None for r in rows] == [r["features"] is None for r in rows]
    first = next(r for r in rows if r["label"] == 1.0 and r["features"])
    assert first["probability"][1] > 0.5
    constant = spark.createDataFrame([([1.0], 1.0), ([1.0], 0.0)] * 30, "features array<double>, label double")
    assert B.BoostedTrees("features", "label").fit(constant).trees == []
    with pytest.raises(ValueError):
        B.BoostedTrees("features", "label").fit(constant.limit(0))
    with pytest.raises(TypeError):
        B.settings_of({"num_leafs": 3}, 1.0, 1)
