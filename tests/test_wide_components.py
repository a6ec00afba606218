import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.reduction import Components
from riskloom.operators.wide_components import fit_wide, transform_wide


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>")


def test_ratios_and_loadings_equal_the_exact_ones(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 64)) * np.linspace(1.0, 1.6, 64) + 7
    df = frame(spark, x)
    exact = np.linalg.eigh(np.cov(x.T))
    model = fit_wide(df, "x", 10)
    assert np.allclose(model.ratios, exact[0][::-1][:10] / exact[0].sum(), atol=1e-6)
    assert np.allclose(np.abs((model.loadings * exact[1][:, ::-1][:, :10]).sum(axis=0)), 1, atol=1e-4)
    plain = Components.fit(df, "x", 10)
    scores = np.array([r["pc"] for r in transform_wide(model, df, "x").orderBy("id").collect()])
    other = np.array([r["pc"] for r in plain.transform(df, "x").orderBy("id").collect()])
    assert np.allclose(scores, other, atol=1e-2)


def test_more_columns_than_any_square_matrix_should_have(spark):
    rng = np.random.default_rng(2)
    hidden = rng.normal(size=(60, 3)) * [9, 5, 3]
    away = rng.normal(size=(3, 20_000))
    x = hidden @ away + rng.normal(size=(60, 20_000)) * 0.1
    model = fit_wide(frame(spark, x), "x", 3)
    s = np.linalg.svd(x - x.mean(axis=0), compute_uv=False) ** 2
    assert model.loadings.shape == (20_000, 3)
    assert np.allclose(model.ratios, s[:3] / s.sum(), atol=1e-6)


def test_missing_equal_and_empty_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [1.0, 2.0])], "id long, x array<double>")
    model = fit_wide(df, "x", 5)
    assert model.ratios.tolist() == [0.0, 0.0]
    got = transform_wide(model, df.withColumn("pc", F.lit(1)), "x").orderBy("id").collect()
    assert [r["pc"] for r in got] == [[0.0, 0.0], None, [0.0, 0.0]]
    with pytest.raises(ValueError):
        fit_wide(df.where("id = 2"), "x", 2)
