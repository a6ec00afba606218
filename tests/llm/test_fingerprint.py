"""Edited texts against plain Python; the algebra of fingerprints."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskloom.llm import fingerprint
from riskloom.llm.ranges import range_cuts


def lanes_of(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    return {r["k"]: r["lanes"] for r in fingerprint.fingerprint_rows(df, "t", ["k"]).collect()}


def test_order_of_paragraphs_does_not_matter_and_contents_do(spark):
    got = lanes_of(spark, "one two\nthree four five", "three four five\n\none two", "one two\nthree four five six", None, "", " \n ", "one two\none two")
    assert got[0] == got[1] != got[2]
    assert got[3] == got[4] == got[5] == [0] * 129
    assert got[6] != lanes_of(spark, "one two")[0]


def plain_lanes(spark, text):
    """The fingerprint by adding bits up in Python; only the 64-bit hashes come from Spark."""
    asked = [[p, *re.findall(r"\S+", p)] for p in text.split("\n") if p.strip(" \t\r\x0b\x0c")]
    words = sorted({w for p in asked for w in p[1:]})
    lines = sorted({p[0] for p in asked})
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h"))
    hashed = {r["w"]: r["h"] for r in df.collect()}
    ends = spark.createDataFrame([(p,) for p in lines], "p string").select("p", F.xxhash64("p", F.lit("paragraph")).alias("h"))
    by_line = {r["p"]: r["h"] for r in ends.collect()}
    pairs = {(hashed[a], hashed[b] if b else None) for p in asked for a, b in zip(p[1:], [*p[2:], None])}
    df = spark.createDataFrame(sorted(pairs, key=str), "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h"))
    by_pair = {(r["a"], r["b"]): r["h"] for r in df.collect()}
    counts = Counter()
    for p in asked:
        counts[by_line[p[0]]] += 1
        for a, b in zip(p[1:], [*p[2:], None]):
            counts[by_pair[hashed[a], hashed[b] if b else None]] += 1
    second = spark.createDataFrame([(h,) for h in counts], "h long").select("h", F.xxhash64("h", F.lit(1)).alias("g"))
    rows = [(r["h"], r["g"], counts[r["h"]]) for r in second.collect()]
    lanes = [0] * 128
    for h, g, n in rows:
        for i, w in enumerate((h, g)):
            for k in range(32):
                lanes[32 * i + k] += n * (w >> k & 1)
                lanes[64 + 32 * i + k] += n * (w >> (k + 32) & 1)
    return [sum(counts.values()), *lanes]


def cosine(a, b):
    x, y = ([2 * v - lanes[0] for v in lanes[1:]] for lanes in (a, b))
    top, under = sum(p * q for p, q in zip(x, y)), math.sqrt(sum(p * p for p in x) * sum(q * q for q in y))
    return 1.0 if a == b else max(0.0, min(1.0, top / under)) if under else 0.0


@pytest.mark.parametrize("repeats", [1, 10, 6_000, 100_000])
def test_against_plain_sums_with_repeated_lines(spark, repeats):
    """Lanes, edited lanes and both likenesses, also beyond the range of 16-bit counters."""
    line = "one two three four five\n"
    texts = {2: line * repeats, 1: "six seven eight\n\t \n" * (2 * repeats) + line}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprint.compare_edits(df).collect()}
    for own, other in ((2, 1), (1, 2)):
        text = texts[own]
        cut = len(text) // 3
        a, e, b = (plain_lanes(spark, t) for t in (text, text[: len(text) - cut] + texts[other][:cut], texts[other]))
        r = got[own]
        assert r["lanes"] == a and r["edited_lanes"] == e
        assert r["near_edited"] == pytest.approx(cosine(a, e)) and r["near_next"] == pytest.approx(cosine(a, b))
        assert r["near_edited"] > 0.5 or own == 1 or repeats < 10


def test_insertion_and_deletion(spark):
    got = lanes_of(spark, "a b c\nd e", "f g", "d e\nf g\na b c")
    df = spark.createDataFrame([(got[0], got[1], got[2])], "a array<long>, b array<long>, both array<long>")
    row = df.select(
        (fingerprint.combine(F.col("a"), F.col("b")) == F.col("both")).alias("put"),
        (fingerprint.combine(F.col("both"), F.col("b"), delete=True) == F.col("a")).alias("taken"),
        fingerprint.likeness(F.col("a"), F.col("both")).alias("near"),
        fingerprint.likeness(F.col("a"), F.col("a")).alias("same"),
    ).first()
    assert row["put"] and row["taken"] and row["same"] == 1.0 and 0.5 < row["near"] < 1.0


ROWS = [(7, "äb😀defghi " * 30), (3, "x y z\n" * 50), (5, None), (4, ""), (12, "tail text of some words\nand another line"), (1, "q" * 30_000)]


@pytest.mark.parametrize("ranges", [1, 2, 4, 9])
def test_edits_as_in_plain_python(spark, ranges):
    df = spark.createDataFrame([(*r, "mine") for r in ROWS], "doc_id long, text string, near_next string")
    got = {r["doc_id"]: r for r in fingerprint.compare_edits(df, ranges=ranges).collect()}
    assert len(got) == len(ROWS)
    order = sorted(ROWS, reverse=True)
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert got[doc_id]["n_chars"] == len(text)
        assert got[doc_id]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert got[5]["lanes"] == got[4]["lanes"] and got[5]["near_next"] == 1.0
    for r in got.values():
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_null_and_repeated_ids_single_rows_and_empty_tables(spark):
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(None, "b"), (None, "a"), (2, "same"), (2, "same")], schema)
    assert fingerprint.compare_edits(df, ranges=3).count() == 4
    assert fingerprint.compare_edits(df.where("doc_id IS NULL")).count() == 2
    one = fingerprint.compare_edits(spark.createDataFrame([(1, "abcdef")], schema)).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one["near_next"] == 1.0
    assert fingerprint.compare_edits(df.limit(0)).collect() == []


def test_ids_beyond_the_precision_of_doubles(spark):
    rows = [((1 << 60) + 7 * i + 3, f"text of {i} " * (i % 5 + 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cuts = range_cuts(df, "doc_id", 6)
    assert set(cuts) <= {r[0] for r in rows} and cuts == sorted(set(cuts)) and cuts[-1] == rows[-1][0]
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprint.compare_edits(df, ranges=6).collect()}
    order = sorted(rows, reverse=True)
    for i, (doc_id, text) in enumerate(order):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + order[(i + 1) % len(order)][1][:cut]
        assert got[doc_id] == hashlib.sha256(edited.encode()).hexdigest()
