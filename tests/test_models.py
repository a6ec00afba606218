import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import explain, metrics, models, registry, scoring, search


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(900):
        x, z = rng.normal(), rng.normal()
        y = int(x + 0.5 * z + rng.normal() * 0.7 > 1.0)
        rows.append((i, y, None if i % 50 == 0 else float(x), float(z), "ab"[i % 2] if i % 7 else None))
    return spark.createDataFrame(rows, "id long, target int, x double, z double, c string").cache()


def test_schedule():
    assert search.halving_schedule(64, 3, 128_000) == [(0, 64, 500), (1, 22, 1500), (2, 8, 4500), (3, 3, 13500)]
    assert search.halving_schedule(27, 4, 128_000) == [(0, 27, 500), (1, 7, 2000), (2, 2, 8000)]
    assert search.halving_schedule(1, 5, 128_000) == [(0, 1, 500)]
    assert search.halving_schedule(64, 3, 2000) == [(0, 64, 500), (1, 22, 1500)]


def test_grids(spark):
    assert len(models.grid_candidates(models.BOOSTING_GRID)) == 64
    assert len(models.grid_candidates(models.FOREST_GRID)) == 27
    boosted = models.classifier("boosting", models.grid_candidates(models.BOOSTING_GRID)[0], "t", 1.0).settings
    assert (boosted.num_leaves, boosted.reg_alpha, boosted.reg_lambda, boosted.scale_pos_weight) == (63, 0.5, 5.0, 11.4)
    assert models.classifier("forest", {"max_depth": None}, "t", 1.0).getMaxDepth() == 30


def test_logistic_is_the_balanced_optimum(data):
    model, prep = models.fit_model(data, "target", "logistic", {"C": 1.0, "tol": 1e-10}, ["x", "z"], [])
    rows = prep.assemble(data, ["target"]).collect()
    X = np.array([r["features"].toArray() for r in rows])
    y = np.array([r["target"] for r in rows])
    w = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    coef, b = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    p = 1 / (1 + np.exp(-(X @ coef + b)))
    # Gradient of 0.5 |coef|^2 + C * sum(w * loss) vanishes.
    assert np.abs(coef + X.T @ (w * (p - y))).max() < 0.05 and abs((w * (p - y)).sum()) < 0.05


def test_search_and_learning_curve(data):
    found = search.halving_search(data, "id", "target", "logistic", {"C": [1e-5, 1.0]}, ["x", "z"], ["c"], factor=2, min_resources=300)
    trials = found.trials.orderBy("rung", "candidate").collect()
    assert [(r["rung"], r["n_samples"]) for r in trials] == [(0, 300), (0, 300), (1, 600)]
    assert found.best_params in ({"C": 1e-5}, {"C": 1.0}) and found.best_score <= 0
    auc = metrics.roc_auc(models.score(found.model, data, ["target"]).withColumnRenamed("target", "y")).first()["auc"]
    assert auc > 0.85
    curve = search.learning_curve(data, "id", "target", "logistic", {"C": 1.0}, ["x", "z"], [], sizes=(0.2, 1.0), folds=2).collect()
    assert [r["n_train"] // 10 for r in curve] in ([8, 44], [9, 45]) and all(r["test_mean"] > 0.8 and r["test_std"] >= 0 for r in curve)


def test_registry_round_trip(spark, data, tmp_path):
    model, _ = models.fit_model(data, "target", "logistic", {"C": 1.0}, ["x", "z"], [])
    reg = registry.ModelRegistry(spark, str(tmp_path / "reg"))
    assert reg.register_best("exp", "first", "m") is None and reg.production("m") is None
    reg.log_run("exp", "first", {"C": 1.0}, {"score": -0.5}, {"step": "a"}, model)
    assert reg.register_best("exp", "first", "m", 0.37, 0.61, promote=True) == 1
    version, path, threshold = reg.production("m")
    assert (version, threshold) == (1, 0.37)
    reg.log_run("exp", "second", model=model)
    assert reg.register_best("exp", "second", "m", promote=True) == 2
    assert reg.production("m")[0] == 2 and reg.production("m")[2] == registry.SERVING_THRESHOLD
    stages = {r["version"]: r["stage"] for r in registry.current_stages(reg.events()).collect()}
    assert stages == {1: "Archived", 2: "Production"}
    loaded, limit = reg.load_production("m", registry.COMPARISON_THRESHOLD)
    assert limit == 0.5
    scored = scoring.score_batch(loaded, data, "id", limit, "target")
    assert scored.count() == 900 and {r[0] for r in scored.select("decision").distinct().collect()} == {"REJECTED", "ACCEPTED"}
    with pytest.raises(LookupError):
        reg.load_production("other")


def test_cost_evaluator(data):
    model, _ = models.fit_model(data, "target", "logistic", {"C": 1.0}, ["x", "z"], [])
    scored = model.transform(models.with_weights(data, "target", {}))
    ev = metrics.BusinessCostEvaluator("target")
    assert not ev.isLargerBetter() and 0 < ev.evaluate(scored) < 3


def test_linear_explanation_adds_up(data):
    model, prep = models.fit_model(data, "target", "logistic", {"C": 1.0}, ["x", "z"], ["c"])
    names = prep.feature_names()
    out = scoring.explain_batch(model, data, "id", names, top=3)
    assert out.count() == 2700
    final = {r["id"]: r["final_value"] for r in out.where("rank = 1").collect()}
    p = {r["id"]: r["probability"] for r in scoring.score_batch(model, data, "id", 0.5, "target").collect()}
    assert all(1 / (1 + math.exp(-final[i])) == pytest.approx(p[i], abs=1e-9) for i in final)
    assert out.where("feature LIKE 'cat__c_%' AND NOT (label LIKE 'YES%' OR label LIKE 'NO%')").count() == 0


def brute_shapley(leaves, x, width):
    """Path-dependent game by enumeration of all subsets."""

    def value(subset):
        total = 0.0
        for v, conditions in leaves:
            for f, share, low, high, cats in conditions:
                ok = low < x[f] <= high and (cats is None or x[f] in cats)
                v *= float(ok) if f in subset else share
            total += v
        return total

    phi = np.zeros(width)
    for i in range(width):
        rest = [j for j in range(width) if j != i]
        for k in range(width):
            for s in itertools.combinations(rest, k):
                w = math.factorial(k) * math.factorial(width - k - 1) / math.factorial(width)
                phi[i] += w * (value({*s, i}) - value(set(s)))
    return phi, value(set())


@pytest.mark.parametrize("family,params", [("forest", {"n_estimators": 3, "max_depth": 4}), ("boosting", {"n_estimators": 3, "num_leaves": 8, "min_child_samples": 5})])
def test_tree_contributions_match_enumeration(spark, data, family, params):
    model, prep = models.fit_model(data, "target", family, params, ["x", "z"], ["c"])
    final = model.stages[-1]
    out = model.transform(models.with_weights(data, "target", {})).where("id < 6")
    p = vector_to_array("probability")[1]
    rows = out.select("id", vector_to_array("features").alias("x"), p.alias("p"))
    told = explain.tree_contributions(final, rows).collect()
    is_forest = family == "forest"
    if is_forest:
        weights = [1 / len(final.trees)] * len(final.trees)
        cover = F.aggregate("impurityStats", F.lit(0.0), lambda s, v: s + v)
        nodes = explain.node_table(final, spark).withColumn("cover", cover).toPandas()
        leaves = [leaf for t, part in nodes.groupby("treeID") for leaf in explain._leaf_paths(part, weights[t], True)]
    else:
        leaves = [(final.start, []), *final.leaf_paths()]
    for r in told:
        phi, base = brute_shapley(leaves, r["x"], len(r["x"]))
        np.testing.assert_allclose(r["contributions"], phi, atol=1e-9)
        margin = r["p"] if is_forest else math.log(r["p"] / (1 - r["p"]))
        assert base == pytest.approx(r["base_value"]) and base + phi.sum() == pytest.approx(margin, abs=1e-9)


def test_importance_tables(spark, data):
    model, prep = models.fit_model(data, "target", "forest", {"n_estimators": 5, "max_depth": 4}, ["x", "z"], [])
    top = models.feature_importance(model, prep.feature_names(), 2).collect()
    assert top[0]["feature"] == "num__x"
    rows = prep.assemble(data, ["id"]).select("id", vector_to_array("features").alias("x"))
    told = explain.linear_contributions(rows, "x", [1.0, -2.0, 0.0, 0.0], [0.0] * 4, 0.25)
    assert explain.global_importance(told, prep.feature_names(), 1).first()["feature"] == "num__z"
    assert told.first()["base_value"] == 0.25


def test_array_vector_round_trip(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "a array<double>").select(array_to_vector("a").alias("v"))
    assert explain.features_as_array(df, "v").first()["x"] == [1.0, 2.0]


def test_search_logs_what_register_best_finds(spark, tmp_path):
    from riskloom.operators import models, search
    from riskloom.operators.registry import ModelRegistry

    rng = np.random.default_rng(2)
    rows = [(i, float(x), int(x + rng.normal() > 0), "ab"[i % 2]) for i, x in enumerate(rng.normal(size=240))]
    df = spark.createDataFrame(rows, "id long, x double, y int, c string")
    kept = ModelRegistry(spark, str(tmp_path / "registry"))
    found = search.halving_search(df, "id", "y", "logistic", {"C": [0.1, 1.0]}, ["x"], ["c"], factor=2, folds=2, log_to=kept, experiment="e")
    assert kept.register_best("e", "logistic", "risk", threshold=0.3, promote=True) == 1
    assert kept.register_best("e", "logistic", "risk", promote=True) == 2
    model, threshold = kept.load_production("risk")
    assert threshold == 0.3 and model.transform(df.withColumn("_w", F.lit(1.0))).count() == 240
    assert kept.production("risk")[0] == 2 and set(found.best_params) == {"C"}
    assert models.effective_params("boosting", {"subsample": 0.7, "num_leaves": 7}) == {"num_leaves": 7}
    drawn = {"subsample": 0.7, "subsample_freq": 1}
    assert models.effective_params("boosting", drawn) == drawn
