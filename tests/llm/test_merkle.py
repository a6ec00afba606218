"""The manifest against a plain recursive tree, proofs folded by hand."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from riskloom.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves, fanout):
    """Levels of nodes up to the root, and each leaf's siblings level by level."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + fanout])) for i in range(0, len(last), fanout)])
    proofs = []
    for i in range(len(leaves)):
        steps, at = [], i
        for level in levels[:-1]:
            run = level[at - at % fanout : at - at % fanout + fanout]
            steps.append(("".join(run[: at % fanout]), "".join(run[at % fanout + 1 :])))
            at //= fanout
        proofs.append(steps)
    return levels[-1][0], proofs


def plain(rows, fanout):
    """``rows``: (group, order, leaf, claimed); expected tuples of results."""
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        subs[g] = tree([r[2] for r in groups[g]], fanout)
    root, above = tree([subs[g][0] for g in names], fanout)
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            steps = subs[g][1][i] + above[k]
            digest = r[3] or r[2]
            for left, right in steps:
                digest = h(left + digest + right)
            out.append((r[2], subs[g][0], root, h("".join(a + b for a, b in steps)), digest, digest == root, i))
    return sorted(out)


def check(spark, rows, fanout, levels):
    df = spark.createDataFrame(rows, "g string, o long, own string, told string")
    made = merkle.merkle_manifest(df, "g", "o", F.col("own"), F.col("told"), fanout, levels)
    got = [tuple(r[c] for c in merkle.ADDED[:-1]) for r in made.collect()]
    assert sorted(got) == plain(rows, fanout)


@pytest.mark.parametrize(("fanout", "levels"), [(2, 1), (3, 1), (2, 3), (16, 2)])
def test_sizes_of_one_group(spark, fanout, levels):
    """Every kind of incomplete run, for several groups of growing size at once."""
    rng = random.Random(fanout)
    sizes = [1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 33] if fanout < 16 else [1, 15, 16, 17, 256, 257, 300, 700]
    rows = []
    for k, n in enumerate(sizes):
        for i in range(n):
            own = h(f"{k}-{i}")
            rows.append((f"g{k:02}", rng.randrange(10 * n), own, h("other") if rng.random() < 0.1 else None))
    check(spark, rows, fanout, levels)


def test_nulls_ties_copies_and_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot", i, h(str(i)), None) for i in range(400)]
    rows += [("hot", 5, h("same"), None)] * 40 + [("hot", 5, h(str(i)), h("x")) for i in range(20)]
    rows += [(None, None, h(str(i)), None) for i in range(5)] + [(None, 3, h("n"), None), ("", 1, h("e"), None), ("Ä", 1, h("a"), None)]
    rng.shuffle(rows)
    check(spark, rows, 4, 1)


def test_many_groups(spark):
    check(spark, [(f"s{i}", i, h(str(i)), None) for i in range(150)], 4, 2)


def test_edges(spark):
    empty = spark.createDataFrame([], "g string, o long, own string, told string")
    assert merkle.merkle_manifest(empty, "g", "o", F.col("own")).collect() == []
    one = spark.createDataFrame([("a", 1, "ff", 9)], "g string, o long, root string, row int")
    r = merkle.merkle_manifest(one, "g", "o", F.col("root")).first()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] == "ff" and r["verified"] and r["row"] == 9
    assert r["proof_sha256"] == h("") and r["height"] == 0


def test_leaf_digest(spark):
    df = spark.createDataFrame([(1, "é", None)], "a long, b string, c string")
    assert df.select(merkle.leaf_digest([F.col(c) for c in "abc"]).alias("d")).first()["d"] == h("1:12:é-")


def test_tampering_is_found(spark):
    from riskloom.llm.queries import QUERIES, crc_of_id

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    chosen = docs.where((crc_of_id() % 5 == 0) & F.coalesce(F.col("text").rlike("[A-Z]"), F.lit(False)))
    bad = {r["doc_id"] for r in QUERIES["op12_merkle"](spark, sf).where("NOT verified").collect()}
    assert bad == {r["doc_id"] for r in chosen.select("doc_id").collect()} and bad
