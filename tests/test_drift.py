import itertools
import math

import numpy as np
import pytest

from riskloom.functions.special import chi_square_tail, exact_ks_tail
from riskloom.operators import drift as D


def brute_ks(a, b):
    grid = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    return np.abs(fa - fb).max()


def frames(spark, cols_a, cols_b):
    def make(cols):
        names = list(cols)
        rows = list(zip(*[[None if v is None else float(v) for v in cols[c]] for c in names]))
        return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names))

    return make(cols_a), make(cols_b)


@pytest.mark.parametrize("limit", [10**6, 60])
def test_ks_matches_brute_force(spark, limit):
    rng = np.random.default_rng(3)
    a = {"n": rng.normal(size=900), "t": rng.integers(0, 4, 900), "h": np.where(rng.random(900) < 0.5, 0.0, rng.normal(size=900)), "k": np.ones(900)}
    b = {"n": rng.normal(0.2, 1, 700), "t": rng.integers(0, 5, 700), "h": np.where(rng.random(700) < 0.3, 0.0, rng.normal(size=700)), "k": np.ones(700)}
    ref, cur = frames(spark, a, b)
    got = {r["feature"]: r["d"] for r in D.ks_statistics(ref, cur, list(a), limit).collect()}
    for c in a:
        assert got[c] == pytest.approx(brute_ks(np.asarray(a[c], float), np.asarray(b[c], float)), abs=1e-12)
    swapped = {r["feature"]: r["d"] for r in D.ks_statistics(cur, ref, list(a), limit).collect()}
    assert swapped == pytest.approx(got)


def test_ks_edge_cases(spark):
    ref, cur = frames(spark, {"same": [1, 2, 3], "far": [1, 2, 3], "hole": [1, None, 3]}, {"same": [1, 2, 3], "far": [7, 8, 9], "hole": [1, 2, 3]})
    got = {r["feature"]: r for r in D.ks_test(ref, cur, ["same", "far", "hole"]).collect()}
    assert got["same"]["statistic"] == 0 and got["same"]["p_value"] == 1.0
    assert got["far"]["statistic"] == 1.0
    assert got["hole"]["p_value"] is None and got["hole"]["reason"] == "missing values"
    omit = {r["feature"]: r for r in D.ks_test(ref, cur, ["hole"], "omit").collect()}
    assert omit["hole"]["statistic"] == pytest.approx(1 / 6)


@pytest.mark.parametrize("m,n", [(3, 4), (5, 5), (2, 7), (4, 6)])
def test_exact_ks_tail_by_enumeration(m, n):
    found = []
    for spots in itertools.combinations(range(m + n), m):
        a = np.array(spots, float)
        b = np.array([i for i in range(m + n) if i not in spots], float)
        found.append(brute_ks(a, b))
    for d in sorted(set(np.round(found, 12))):
        assert exact_ks_tail(m, n, d) == pytest.approx(np.mean(np.array(found) >= d - 1e-9), rel=1e-12)


def test_exact_and_asymptotic_agree_for_larger_samples(spark):
    rng = np.random.default_rng(12)
    ref, cur = frames(spark, {"x": rng.normal(size=2000)}, {"x": rng.normal(0.04, 1, 1500)})
    exact = D.ks_test(ref, cur, ["x"]).first()["p_value"]
    limit = D.ks_test(ref, cur, ["x"], p_method="asymptotic").first()["p_value"]
    assert exact != limit and exact == pytest.approx(limit, rel=0.05)


def test_chi_square_tail_known_values():
    # Fixed values from published tables.
    for x, dof, p in [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (18.307038053275146, 10, 0.05), (6.634896601021213, 1, 0.01)]:
        assert chi_square_tail(x, dof) == pytest.approx(p, rel=1e-10)
    assert chi_square_tail(0.0, 3) == 1.0 and math.isnan(chi_square_tail(1.0, 0))


def test_chi_square_cases(spark):
    ref = spark.createDataFrame([("a", "x", "p")] * 30 + [("b", "x", "p")] * 10, "two string, one string, gap string")
    cur = spark.createDataFrame([("a", "x", "p")] * 20 + [("b", "x", "q")] * 20, "two string, one string, gap string")
    got = {r["feature"]: r for r in D.chi_square_test(ref, cur, ["two", "one", "gap"]).collect()}
    assert got["two"]["statistic"] == pytest.approx(4.32)
    assert got["two"]["p_value"] == pytest.approx(chi_square_tail(4.32, 1))
    assert got["one"]["p_value"] == 1.0
    assert got["gap"]["statistic"] == pytest.approx((20 - 10 - 0.5) ** 2 * (1 / 10 + 1 / 10 + 1 / 30 + 1 / 30))


def test_empty_side_and_lost_column(spark):
    ref = spark.createDataFrame([(1.0, "a")], "x double, s string")
    cur = spark.createDataFrame([(None, None)], "x double, s string")
    got = {r["feature"]: r for r in D.drift_tests(ref, cur, ["x", "gone"], ["s"]).collect()}
    assert {r["status"] for r in got.values()} == {"inconclusive"}
    verdict = D.drift_verdict(D.drift_tests(ref, cur, ["x"], ["s"])).first()
    assert (verdict["n_features"], verdict["n_drifted"], verdict["dataset_drift"]) == (2, 0, False)


def test_analyze_and_report(spark):
    rng = np.random.default_rng(0)
    ref = spark.createDataFrame([(float(v), "a") for v in rng.normal(size=200)], "x double, s string")
    cur = spark.createDataFrame([(float(v), "b") for v in rng.normal(3, 1, 200)], "x double, s string")
    out = D.analyze_drift(ref, cur, ["x"], ["s"])
    assert out["verdict"].first()["n_drifted"] == 2
    assert out["statistics"].first()["mean_ref"] == pytest.approx(ref.agg({"x": "avg"}).first()[0])
    assert out["histograms"].count() == 60 and out["inconclusive"].count() == 0
    assert D.drift_report(ref, cur)["verdict"].first()["dataset_drift"]


def test_zero_reference_mean(spark):
    ref, cur = frames(spark, {"x": [-1, 1]}, {"x": [5, 7]})
    assert D.moments_table(ref, cur, ["x"]).first()["mean_pct_change"] == 0.0
