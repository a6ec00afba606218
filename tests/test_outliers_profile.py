import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions.expr import normalise_missing
from riskloom.operators import outliers as O
from riskloom.operators import profile as P


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    a = rng.lognormal(0, 1, 400)
    a[::17] = np.nan
    return pd.DataFrame({"a": a, "k": np.full(400, 2.0), "void": np.full(400, np.nan), "b": rng.normal(size=400)})


@pytest.fixture(scope="module")
def df(spark, data):
    return normalise_missing(spark.createDataFrame(data))


@pytest.mark.parametrize("limit", [10**6, 40])
def test_bounds(df, data, limit):
    got = {(r["method"], r["feature"]): (r["lower"], r["upper"]) for r in O.fit_bounds(df, row_limit=limit).collect()}
    for c in ("a", "b", "k"):
        s = data[c]
        iqr = s.quantile(0.75) - s.quantile(0.25)
        want = {
            "Z-score (±3)": (s.mean() - 3 * s.std(), s.mean() + 3 * s.std()),
            "IQR 1.5": (s.quantile(0.25) - 1.5 * iqr, s.quantile(0.75) + 1.5 * iqr),
            "Quantile 1-99": (s.quantile(0.01), s.quantile(0.99)),
            "Full Range": (s.min(), s.max()),
        }
        for m, limits in want.items():
            np.testing.assert_allclose(got[m, c], limits, rtol=1e-10)
    assert got["IQR 1.5", "void"] == (None, None)


def test_unknown_method(df):
    with pytest.raises(ValueError):
        O.fit_bounds(df, ["a"], ["nope"])
    with pytest.raises(ValueError):
        O.mask_outliers(df, "nope")


def test_mask_keeps_boundary_rows_and_null_bounds(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, None), (3.0, 7.0), (4.0, 8.0)], "x double, y double")
    got = O.mask_outliers(df, bounds={"x": (2.0, 3.0), "y": (None, None), "gone": (0.0, 1.0)})
    assert [tuple(r) for r in got.collect()] == [(None, 5.0), (2.0, None), (3.0, 7.0), (None, 8.0)]


def test_given_bounds_win_over_the_method(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(11)], "x double, y double")
    got = O.mask_outliers(df, "Quantile 5-95", ["x", "y"], {"x": (-100.0, 100.0)})
    assert got.agg(F.count("x"), F.count("y")).first() == (11, 9)


def test_train_bounds_on_other_rows(spark):
    train = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    test = spark.createDataFrame([(-5.0,), (50.0,), (1000.0,)], "x double")
    bounds = O.fit_bounds(train, ["x"], ["Full Range"])
    assert [r[0] for r in O.mask_outliers(test, "Full Range", ["x"], bounds).collect()] == [None, 50.0, None]


def test_summary_numbers(df, data):
    got = {(r["method"], r["feature"]): r for r in O.outlier_summary(df).collect()}
    assert not any(f == "void" for _, f in got)
    s = data["a"]
    lo, hi = s.mean() - 2 * s.std(), s.mean() + 2 * s.std()
    out = (s < lo) | (s > hi)
    r = got["Z-score (±2)", "a"]
    clean = s[~out].mean()
    assert r["outlier_count"] == out.sum() and r["n_above"] == (s > hi).sum()
    np.testing.assert_allclose(r["outlier_pct"], out.sum() / s.count() * 100)
    np.testing.assert_allclose(r["mean_pct_change"], (s.mean() - clean) / clean * 100)
    np.testing.assert_allclose(r["skewness"], s.skew())
    assert got["Full Range", "a"]["outlier_count"] == 0 and got["Z-score (±2)", "k"]["skewness"] == 0


def test_compare_methods(df):
    assert O.compare_methods(df, "a").count() == 6
    with pytest.raises(ValueError):
        O.compare_methods(df, "nope")


def test_correlation_is_pairwise_complete(df, data):
    got = {(r["row"], r["col"]): r["corr"] for r in P.correlation_pairs(df, ["a", "b", "k"]).collect()}
    want = data[["a", "b", "k"]].corr()
    np.testing.assert_allclose(got["a", "b"], want.loc["a", "b"])
    assert got["k", "a"] is None and len(got) == 9
    low = {(r["row"], r["col"]): r["corr"] for r in P.lower_triangle(P.correlation_pairs(df, ["a", "b"])).collect()}
    assert low["a", "b"] == 0.0 and low["a", "a"] == 0.0 and low["b", "a"] == got["b", "a"]


def test_wide_correlation_uses_matrix_sums(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.normal(1e6, 1.0, size=(60, 14)), columns=[f"c{i}" for i in range(14)])
    pdf.iloc[::7, 3] = np.nan
    pdf["c5"] = 4.0
    pdf["c6"] = np.nan
    df = normalise_missing(spark.createDataFrame(pdf))
    got = P.correlation_pairs(df).toPandas().pivot(index="i", columns="j", values="corr")
    np.testing.assert_allclose(got.to_numpy(dtype=float), pdf.corr().to_numpy(), atol=1e-9)


def test_target_distribution_null_group(spark):
    df = spark.createDataFrame([(0,), (0,), (1,), (None,)], "t int")
    assert {r["target"]: r["n"] for r in P.target_distribution(df, "t").collect()} == {0: 2, 1: 1, None: 1}
    assert P.target_distribution(df, "t", keep_null=False).count() == 2


def test_box_stats(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    r = P.box_stats(spark.createDataFrame([(v,) for v in vals], "x double"), ["x"]).first()
    assert (r["whisker_low"], r["whisker_high"], r["n_outside"], r["median"]) == (1.0, 5.0, 1, 3.5)


def test_dataset_summary(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "a"), (3.0, None)], "x double, s string")
    got = {r["feature"]: r for r in P.dataset_summary(df).collect()}
    assert (got["x"]["n_missing"], got["x"]["n_distinct"], got["x"]["median"]) == (1, 2, 2.0)
    assert (got["s"]["n_missing"], got["s"]["n_distinct"], got["s"]["mean"]) == (1, 1, None)


def test_profile_picks_the_widest_features(spark):
    rows = [(i % 2, *[float(i * (j + 1)) for j in range(12)]) for i in range(10)]
    df = spark.createDataFrame(rows, "c int, " + ", ".join(f"f{j} double" for j in range(12)))
    out = P.cluster_profile(df, "c")
    assert out.columns == ["cluster", "size", "pct"] + [f"f{j}" for j in range(11, 1, -1)]
    assert out.where("cluster = 0").first()["pct"] == 50.0


def test_feature_list_file(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 3.0)], "feature string, v double")
    ranked = P.ranked_features(df, "v", "feature", 2)
    P.write_feature_list(ranked, str(tmp_path / "top"))
    assert [r["feature"] for r in spark.read.json(str(tmp_path / "top")).orderBy("rank").collect()] == ["b", "c"]
