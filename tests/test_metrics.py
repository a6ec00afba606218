import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions.expr import decide
from riskloom.operators import metrics as M


def preds(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")


@pytest.mark.parametrize("y,hat,cost", [([0, 0, 1, 1], [0, 1, 0, 1], 2.75), ([1], [0], 10.0), ([0], [1], 1.0), ([0, 0], [0, 0], 0.0)])
def test_known_costs(spark, y, hat, cost):
    df = spark.createDataFrame(list(zip(y, hat)), "y int, y_hat int")
    assert M.business_cost(df).first()["cost"] == cost


def test_empty_cost_is_zero(spark):
    assert M.business_cost(spark.createDataFrame([], "y int, y_hat int")).first()["cost"] == 0.0


def test_curve_on_the_thresholds_themselves(spark):
    th = np.linspace(0, 1, 101)
    p = np.concatenate([th, np.nextafter(th, 0), np.nextafter(th, 2), [0.0, 1.0, -0.5, 1.5]])
    y = np.arange(len(p)) % 3 == 0
    got = M.cost_curve(preds(spark, y, p)).orderBy("threshold").collect()
    assert [r["threshold"] for r in got] == th.tolist()
    for r, t in zip(got, th):
        hat = p >= t
        assert r["fp"] == int((hat & ~y).sum()) and r["fn"] == int((~hat & y).sum())


def test_ties_pick_the_lowest_threshold(spark):
    best = M.optimal_threshold(preds(spark, [0, 1], [0.2, 0.8])).first()
    assert best["threshold"] == 21 * 0.01 and best["min_cost"] == 0.0


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("limit", [10**6, 30])
def test_auc_with_ties(spark, limit):
    rng = np.random.default_rng(1)
    y, p = rng.integers(0, 2, 500), np.round(rng.random(500), 2)
    assert M.roc_auc(preds(spark, y, p), row_limit=limit).first()["auc"] == pytest.approx(brute_auc(y, p), abs=1e-12)


def test_auc_of_one_class(spark):
    assert M.roc_auc(preds(spark, [1, 1], [0.1, 0.2])).first()["auc"] is None


def test_rates_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, y_hat int")
    r = M.rates(M.confusion(df)).first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (1.0, 0.0, 0.0, 0.0)
    cells = M.confusion_cells(M.confusion(df)).collect()
    assert len(cells) == 4 and {(r["actual"], r["predicted"]): r["n"] for r in cells}[0, 0] == 2


def test_leaderboard_order_and_missing_probability(spark):
    rows = [("b", 0, 0.1, 0), ("b", 1, 0.9, 1), ("a", 0, None, 0), ("a", 1, None, 1), ("c", 0, 0.9, 1), ("c", 1, 0.1, 0)]
    df = spark.createDataFrame(rows, "model string, y int, p double, y_hat int")
    got = M.leaderboard(df).orderBy("rank").collect()
    assert [r["model"] for r in got] == ["a", "b", "c"] and got[0]["auc"] == 0.5 and got[1]["auc"] == 1.0


@pytest.mark.parametrize(
    "champ,chall,promote,pct", [([0.9, 0.1], [0.1, 0.9], True, 100.0), ([0.1, 0.9], [0.1, 0.9], False, 0.0), ([0.1, 0.9], [0.9, 0.1], False, 0.0)]
)
def test_champion(spark, champ, chall, promote, pct):
    df = spark.createDataFrame(list(zip([0, 1], champ, chall)), "y int, a double, b double")
    r = M.compare_with_champion(df, "a", "b", 0.5).first()
    assert r["promote"] is promote and r["improvement_pct"] == pct


def test_champion_absent_or_failing(spark):
    df = spark.createDataFrame([(0, 0.1, None), (1, 0.9, 0.2)], "y int, a double, b double")
    assert M.compare_with_champion(df, None, "b", 0.5).first()["promote"] is True
    assert M.compare_with_champion(df, "a", "b", 0.5).first()["promote"] is False
    assert M.compare_with_champion(df, "a", "b", 0.5, fail_open=True).first()["promote"] is True
    assert M.compare_with_champion(df, "a", "nope", 0.5).first()["promote"] is False


def test_score_zones(spark):
    got = M.score_distribution(preds(spark, [0, 1, 1], [0.0, 1.0, 0.5]), 0.45).collect()
    assert len(got) == 100 and sum(r["n"] for r in got) == 3
    assert {r["zone"] for r in got if r["bin"] < 20} == {"approve"}


def test_missing_scores_and_labels(spark):
    rows = [(1, None), (1, 0.2), (0, 0.9), (0, 0.1), (None, 0.7), (None, None)]
    df = spark.createDataFrame(rows, "y int, p double")
    curve = {round(r["threshold"], 2): r for r in M.cost_curve(df).collect()}
    assert (curve[1.0]["fn"], curve[1.0]["fp"], curve[1.0]["cost"]) == (2, 0, 5.0)
    assert curve[0.0]["fn"] == 1
    decided = df.withColumn("y_hat", decide(F.col("p"), 0.5))
    assert M.business_cost(decided).first()["cost"] == 5.25
    assert [r["cost"] for r in M.business_cost(decided.withColumn("y_hat", F.when(F.col("p") >= 0.5, 1))).collect()] == [5.25]
    assert curve[0.5]["cost"] == 5.25
    for limit in (1_000, 1):
        assert M.roc_auc(df, row_limit=limit).first()["auc"] == 0.25
