import numpy as np
import pytest

from riskloom.operators import ordering as O


def long_frame(spark, seed=1, n=3000):
    rng = np.random.default_rng(seed)
    hot = np.where(rng.random(n) < 0.4, 7.0, rng.lognormal(1, 2, n))
    data = {"a": rng.normal(size=n), "b": hot, "c": rng.integers(0, 5, n).astype(float), "d": np.full(n, 3.0)}
    rows = [(k, float(v)) for k, vs in data.items() for v in vs]
    return spark.createDataFrame(rows, "feature string, value double"), data


PROBS = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]


@pytest.mark.parametrize("limit", [10**6, 50])
def test_quantiles_are_exact(spark, limit):
    df, data = long_frame(spark)
    got = {r["feature"]: (r["n"], r["q"]) for r in O.exact_quantiles(df, PROBS, limit).collect()}
    for k, v in data.items():
        assert got[k][0] == len(v)
        np.testing.assert_allclose(got[k][1], np.quantile(v, PROBS), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("limit", [10**6, 100])
def test_running_totals(spark, limit):
    df, data = long_frame(spark, 2)
    rows = df.selectExpr("feature", "value", "1L AS one")
    got = O.running_totals(rows, ["feature"], "value", ["one"], limit).collect()
    for r in got:
        v = data[r["feature"]]
        assert r["one"] == int((v == r["value"]).sum()) and r["cum_one"] == int((v <= r["value"]).sum())
    assert len(got) == sum(len(np.unique(v)) for v in data.values())


def test_median_of_four(spark):
    df = spark.createDataFrame([("x", v) for v in (1.0, 2.0, 4.0, 10.0)], "feature string, value double")
    assert O.exact_quantiles(df, [0.5]).first()["q"] == [3.0]


def test_histogram_keeps_empty_bins_and_the_maximum(spark):
    df = spark.createDataFrame([("x", v) for v in (0.0, 0.0, 10.0)], "feature string, value double")
    got = O.bin_counts(df, ["feature"], 5).orderBy("bin").collect()
    assert [r["n"] for r in got] == [2, 0, 0, 0, 1]
    constant = spark.createDataFrame([("x", 3.0)] * 4, "feature string, value double")
    assert [r["n"] for r in O.bin_counts(constant, ["feature"], 3).orderBy("bin").collect()] == [4, 0, 0]
