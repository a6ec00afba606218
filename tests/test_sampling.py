import hashlib

import pytest
from pyspark.sql import functions as F

from riskloom.operators import sampling as S


def key(i, seed=42):
    return hashlib.md5(f"{i}|{seed}".encode()).hexdigest()


def frame(spark, sizes):
    rows, i = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            rows.append((i, label))
            i += 1
    return spark.createDataFrame(rows, "id long, y int")


def test_sample_matches_the_sorted_hash(spark):
    df = spark.range(0, 5000)
    want = set(sorted(range(5000), key=key)[:321])
    assert {r[0] for r in S.sample_rows(df, "id", 321).collect()} == want
    assert {r[0] for r in S.sample_rows(df.repartition(7), "id", 321).collect()} == want
    assert S.sample_rows(df, "id", 9999).count() == 5000
    assert S.sample_rows(df, "id", 0).count() == 0


def test_split_quotas_and_disjointness(spark):
    df = frame(spark, {0: 77, 1: 5, 2: 1})
    split = S.split_rows(df, "id", "y").cache()
    assert split.count() == 83
    assert S.split_overlap(split, "id").count() == 0
    n = {r["split"]: r["c"] for r in split.groupBy("split").agg(F.count("*").alias("c")).collect()}
    assert n["test_final"] == 17 and n["val"] == 14 and n["train"] == 52
    share = {(r["split"], r["y"]): r["c"] for r in split.groupBy("split", "y").agg(F.count("*").alias("c")).collect()}
    assert share["test_final", 0] in (15, 16) and share["test_final", 1] == 1
    again = S.split_rows(df.repartition(5), "id", "y")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, split.collect()))
    sets = S.split_sets(split)
    assert sets["train_val"].count() == sets["train"].count() + sets["val"].count()


def test_one_class_may_hold_nearly_everything(spark):
    df = frame(spark, {0: 3000, 1: 12})
    got = S.split_rows(df, "id", "y").groupBy("y", "split").count().collect()
    n = {(r["y"], r["split"]): r["count"] for r in got}
    assert n[1, "test_final"] == 2 and n[1, "val"] == 2 and sum(n.values()) == 3012


def test_folds_differ_by_at_most_one(spark):
    got = S.stratified_folds(frame(spark, {0: 100, 1: 11}), "id", "y", 3).groupBy("y", "fold").count().collect()
    sizes = {}
    for r in got:
        sizes.setdefault(r["y"], []).append(r["count"])
    assert sorted(sizes[0]) == [33, 33, 34] and sorted(sizes[1]) == [3, 4, 4]


def test_stratified_sample_is_proportional_and_exact(spark):
    df = frame(spark, {0: 700, 1: 200, 2: 100})
    got = S.stratified_sample(df, "id", "y", 55)
    assert got.count() == 55
    n = {r["y"]: r["count"] for r in got.groupBy("y").count().collect()}
    assert n[0] >= 38 and n[1] >= 11 and n[2] >= 5


def test_tiny_buckets_and_many_strata_give_the_same_rows(spark, monkeypatch):
    df = frame(spark, {0: 700, 1: 200, 2: 100})
    plain = [sorted(r[0] for r in f.collect()) for f in (S.sample_rows(df, "id", 57), S.stratified_sample(df, "id", "y", 55))]
    capped = sorted(r[0] for r in S.noise_capped_sample(df, "id", "y", 90).collect())
    split = sorted(map(tuple, S.split_rows(df, "id", "y").collect()))
    monkeypatch.setattr(S, "BUCKET_ROWS", 1)
    again = [sorted(r[0] for r in f.collect()) for f in (S.sample_rows(df, "id", 57), S.stratified_sample(df, "id", "y", 55))]
    assert again == plain
    monkeypatch.setattr(S, "MAX_COUNTERS", 300)
    assert sorted(r[0] for r in S.stratified_sample(df, "id", "y", 55).collect()) == plain[1]
    assert sorted(r[0] for r in S.noise_capped_sample(df, "id", "y", 90).collect()) == capped
    assert sorted(map(tuple, S.split_rows(df, "id", "y").collect())) == split


def test_noise_is_capped(spark):
    df = frame(spark, {-1: 5000, 0: 300, 1: 300})
    got = S.noise_capped_sample(df, "id", "y", 100)
    assert got.count() == 100
    assert {r["y"]: r["count"] for r in got.groupBy("y").count().collect()} == {-1: 20, 0: 40, 1: 40}


@pytest.mark.parametrize("draws,sizes", [(10, {0: 33, 1: 33, 2: 34}), (3, {0: 1, 1: 1, 2: 1}), (0, {0: 5})])
def test_allocate_adds_up(draws, sizes):
    got = S.allocate(draws, sizes)
    assert sum(got.values()) == draws and all(got[k] <= sizes[k] for k in sizes)


def test_summary_shares(spark):
    split = S.split_rows(frame(spark, {0: 80, 1: 20}), "id", "y")
    got = {r["split"]: r["pct"] for r in S.split_summary(split).collect()}
    assert got == {"train": 80.0, "val": 20.0, "test_final": 20.0}


@pytest.mark.parametrize("sizes", [{i: 1 + i % 7 for i in range(60)}, {i: 3 for i in range(40)}, {0: 500, 1: 1, 2: 2, 9: 60}])
def test_quotas_as_a_table_equal_those_of_the_driver(spark, sizes):
    df = frame(spark, sizes).unionByName(spark.createDataFrame([(10**6, None)], "id long, y int"))
    for make in (S.split_rows, S.stratified_folds):
        want = sorted(map(tuple, make(df, "id", "y").collect()))
        assert sorted(map(tuple, make(df, "id", "y", held=2).collect())) == want
        assert len(want) == sum(sizes.values())


def test_thousands_of_classes_are_split_and_folded(spark):
    df = spark.range(0, 40000).select("id", F.concat(F.lit("c"), F.col("id") % 5000).alias("y"))
    split = S.split_rows(df, "id", "y", held=1000).cache()
    n = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert n == {"test_final": 8000, "val": 6400, "train": 25600} and S.split_overlap(split, "id").count() == 0
    tests = {r["y"]: r["count"] for r in split.where("split = 'test_final'").groupBy("y").count().collect()}
    assert set(tests.values()) == {1, 2} and [y for y in sorted({f"c{i}" for i in range(5000)}) if tests[y] == 2] == sorted(tests)[:3000]
    folds = S.stratified_folds(df, "id", "y", 3, held=1000).groupBy("y", "fold").count().collect()
    assert {r["count"] for r in folds} == {2, 3} and len(folds) == 15000


def test_empty_and_unlabelled_tables_have_no_classes(spark):
    none = spark.createDataFrame([(1, None)], "id long, y int")
    assert S.split_rows(none, "id", "y", held=0).count() == 0
    assert S.stratified_folds(none.limit(0), "id", "y", held=0).count() == 0
