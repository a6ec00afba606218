import math

from pyspark.sql import functions as F

from riskloom.functions import expr as X


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_package_imports():
    import riskloom
    from riskloom.operators import dbscan, drift, explain, kmeans, metrics, models, outliers, preparation, search  # noqa: F401

    assert riskloom.__version__


def test_ratio_columns_without_nulls(spark):
    rows = [
        (100, 1000, 100, -10000, -1000, 0.1, 0.2, 0.3),
        (200, 2000, 200, -15000, -2000, 0.4, 0.5, 0.6),
        (300, 3000, 300, -20000, -3000, 0.7, 0.8, 0.9),
    ]
    names = "AMT_INCOME_TOTAL long, AMT_CREDIT long, AMT_ANNUITY long, DAYS_BIRTH long, DAYS_EMPLOYED long"
    df = spark.createDataFrame(rows, names + ", EXT_SOURCE_1 double, EXT_SOURCE_2 double, EXT_SOURCE_3 double")
    out = X.add_ratios(df).orderBy("AMT_CREDIT").collect()
    assert [r["CREDIT_INCOME_PERCENT"] for r in out] == [10.0, 10.0, 10.0]
    assert [r["ANNUITY_INCOME_PERCENT"] for r in out] == [1.0, 1.0, 1.0]
    assert [r["CREDIT_TERM"] for r in out] == [0.1, 0.1, 0.1]
    assert [round(r["DAYS_EMPLOYED_PERCENT"], 6) for r in out] == [0.1, 0.133333, 0.15]
    assert all(v is not None for r in out for v in r)
    assert len(df.columns) == 8


def test_ratio_zero_denominator(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(X.ratio(F.col("a"), F.col("b"))).collect()] == [None] * 4
    inf = [r[0] for r in df.select(X.ratio(F.col("a"), F.col("b"), "inf")).collect()]
    assert inf[0] == math.inf and inf[1] == -math.inf and math.isnan(inf[2]) and inf[3] is None


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "a double, b int")
    assert _rows(X.normalise_missing(df)) == [(None, 1), (2.0, 2)]


def test_columns_of_kind(spark):
    df = spark.createDataFrame([], "a int, b long, c double, d string, e boolean, f float, g date")
    assert X.columns_of_kind(df) == ["a", "b", "c", "f"]
    assert X.columns_of_kind(df, "strict") == ["b", "c"]
    assert X.columns_of_kind(df, "categorical") == ["d"]


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.1,), (0.4,), (0.45,), (0.46,), (0.8,)], "p double")
    assert [r[0] for r in df.select(X.decide(F.col("p"), 0.45)).collect()] == [0, 0, 1, 1, 1]
    assert df.select(X.decision_label(F.col("p"), 0.45)).first()[0] == "ACCEPTED"


def test_drift_status_tests_missing_first(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.049,), (0.05,)], "p double")
    got = [r[0] for r in df.select(X.drift_status(F.col("p"))).collect()]
    assert got == ["inconclusive", "inconclusive", "drift", "no_drift"]


def test_feature_labels(spark):
    rows = [
        ("cat__NAME_TYPE_Cash loans", 1.0),
        ("cat__NAME_TYPE_Cash loans", 0.0),
        ("cat__plain", 1.0),
        ("ind__qty_origin", 1.0),
        ("ind__qty_origin", 0.0),
        ("num__qty", 1.234),
        ("other", 2.0),
    ]
    got = [r[0] for r in spark.createDataFrame(rows, "n string, v double").select(X.feature_label(F.col("n"), F.col("v"))).collect()]
    assert got == [
        "YES | NAME_TYPE: Cash loans",
        "NO | NAME_TYPE_Cash loans",
        "YES | plain",
        "PRESENT | qty",
        "MISSING | qty",
        "1.23 | qty",
        "2.00 | other",
    ]


def test_align_and_drop(spark):
    a = spark.createDataFrame([(1, 2, 3)], "x int, y int, z int")
    b = spark.createDataFrame([(1, 2, 3)], "z int, w int, y int")
    left, right = X.align_common(a, b)
    assert left.columns == right.columns == ["y", "z"]
    assert X.drop_existing(a, ["x", "nope"]).columns == ["y", "z"]
