import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import preparation as P


@pytest.fixture(scope="module")
def train(spark):
    rows = [(1, 1.0, 5.0, None, "a"), (2, 2.0, 5.0, None, "b"), (3, 4.0, 5.0, None, None), (4, 10.0, 5.0, None, "a"), (5, None, 5.0, None, "b")]
    return spark.createDataFrame(rows, "id long, x double, k double, void double, c string")


def test_presence(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert [tuple(r) for r in P.presence_indicators(df, ["x"]).collect()] == [(1.0, 1), (None, 0)]
    assert P.presence_indicators(df, only_indicators=True).columns == ["x_origin"]


def test_fit_apply(spark, train):
    prep = P.Preprocessor.fit(train, ["x", "k", "void"], ["c"])
    assert prep.dropped == ["void"]
    assert prep.feature_names() == [
        "num__x", "num__k", "ind__x_origin", "ind__k_origin", "ind__void_origin", "cat__c_a", "cat__c_b", "cat__c_missing",
    ]
    x = np.array([1.0, 2.0, 4.0, 10.0])
    other = spark.createDataFrame([(9, None, 5.0, 1.0, "zz"), (10, 4.0, 6.0, None, None)], train.schema)
    got = prep.transform(other).collect()
    np.testing.assert_allclose(got[0]["num__x"], (3.0 - x.mean()) / x.std())
    np.testing.assert_allclose(got[1]["num__x"], (4.0 - x.mean()) / x.std())
    assert got[1]["num__k"] == 1.0
    assert (got[0]["ind__x_origin"], got[0]["ind__void_origin"]) == (0, 1)
    assert [got[0][f"cat__c_{v}"] for v in ("a", "b", "missing")] == [0, 0, 0]
    assert [got[1][f"cat__c_{v}"] for v in ("a", "b", "missing")] == [0, 0, 1]


def test_vector_and_saved_forms_agree(spark, train, tmp_path):
    prep = P.Preprocessor.fit(train, ["x", "k", "void"], ["c"])
    other = spark.createDataFrame([(9, None, 5.0, 1.0, "zz"), (10, 4.0, 6.0, None, None), (11, 1.5, 5.0, 2.0, "b")], train.schema)
    wide = [[float(v) for v in r] for r in prep.transform(other).collect()]
    assembled = [r[1].toArray().tolist() for r in prep.assemble(other, ["id"]).collect()]
    assert assembled == wide
    model = prep.pipeline().fit(train)
    model.write().overwrite().save(str(tmp_path / "prep"))
    from pyspark.ml import PipelineModel

    loaded = PipelineModel.load(str(tmp_path / "prep"))
    np.testing.assert_allclose([r["features"].toArray() for r in loaded.transform(other).collect()], wide)
    again = P.Preprocessor.from_table(prep.to_table(spark))
    assert again == prep


def test_neighbours_fill(spark):
    rows = [(1, 0.0, 10.0), (2, 1.0, 20.0), (3, 2.0, 30.0), (4, 9.0, 90.0), (5, 0.1, None), (6, None, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    imp = P.NeighbourImputer.fit(df, ["a", "b"], "id", k=2)
    got = {r["id"]: (r["a"], r["b"]) for r in imp.transform(df).collect()}
    assert got[5] == (0.1, 15.0)
    assert got[6] == (pytest.approx(12.1 / 5), 37.5)
    assert got[4] == (9.0, 90.0) and len(got) == 6


def test_blocks_do_not_change_what_is_filled(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *[None if rng.random() < 0.25 else float(rng.integers(0, 6)) for _ in range(3)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    got = []
    for block_rows in (4_000, 7):
        imp = P.NeighbourImputer.fit(df, ["a", "b", "c"], "id", k=3)
        imp.block_rows = block_rows
        got.append(sorted(tuple(r) for r in imp.transform(df).collect()))
    assert len(got[0]) == 60
    np.testing.assert_allclose(np.array(got[0]), np.array(got[1]), atol=1e-12)


def test_many_categories_only_as_a_vector(spark, monkeypatch):
    monkeypatch.setattr(P, "MAX_WIDE_LEVELS", 2)
    df = spark.createDataFrame([(c,) for c in "abcd"], "c string")
    prep = P.Preprocessor.fit(df, [], ["c"])
    with pytest.raises(ValueError):
        prep.transform(df)
    got = [r["features"].toArray().tolist() for r in prep.pipeline().fit(df).transform(df).collect()]
    assert got == np.eye(4).tolist()
