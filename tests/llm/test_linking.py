import random

from pyspark.sql import functions as F

from riskloom.llm.linking import component_roots, join_split


def roots(links):
    parent = {}

    def top(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {a: top(a) for a in parent if top(a) != a}


def test_hubs_chains_and_random_links(spark):
    rng = random.Random(3)
    hub = [(5000, i) for i in range(1, 900)] + [(i, 5000) for i in range(6000, 6900)]
    chain = [(10_000 + i, 10_001 + i) for i in range(70)]
    loose = [(rng.randrange(20_000, 20_200), rng.randrange(20_000, 20_200)) for _ in range(120)]
    links = hub + chain + loose + [(-7, -3), (8, 8), (-7, -3)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r["node"]: r["root"] for r in component_roots(df).collect()}
    assert got == roots(links)


def test_no_links_give_no_components(spark):
    assert component_roots(spark.createDataFrame([(4, 4)], "u long, v long")).count() == 0
    assert component_roots(spark.createDataFrame([], "u long, v long")).count() == 0


def test_split_join_equals_the_join_and_spreads_one_key(spark):
    rows = spark.range(0, 3000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id") % 5).alias("k"), "id")
    table = spark.createDataFrame([(i, f"v{i}") for i in range(4)], "k long, v string")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = join_split(rows, table, "k", "id")
        assert sorted(map(tuple, got.select("k", "id", "v").collect())) == sorted(map(tuple, rows.join(table, "k").select("k", "id", "v").collect()))
        each = got.where("k = 1").groupBy(F.spark_partition_id()).count().collect()
        assert len(each) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert max(r["count"] for r in each) < 1300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_repeated_and_missing_split_values_stay(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (1, 2), (3, 4)], "k long, id long")
    table = spark.createDataFrame([(1, "a")], "k long, v string")
    assert join_split(rows, table, "k", "id").count() == 3
