"""Fingerprints and components against brute force, with groups small enough to cut further."""

import random
import re

import pytest
import xxhash

from riskloom.llm import simhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(lowered)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints, bits=2):
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and bin(a ^ b).count("1") <= bits:
                x, y = top(a), top(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
    return {p: top(p) for p in prints}


def signed(p):
    return p - (1 << 64) if p >> 63 else p


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "ÄÖ é　x A\x1fb c", "a b c d a b c d " * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_pieces_of_a_long_text(monkeypatch):
    rng = random.Random(3)
    text = " ".join("w%d" % rng.randint(0, 50) for _ in range(3000)) + " " + "x" * 900 + " end"
    whole = plain_fingerprint(text)
    for size in (7, 100, 5000):
        monkeypatch.setattr(simhash, "PIECE_BYTES", size)
        assert simhash.fingerprint(text) == whole


def crowd(seed):
    """Fingerprints in balls around a few centres, some sharing a half, and far ones."""
    rng = random.Random(seed)
    prints = set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(60):
            p = centre
            for _ in range(rng.randint(0, 3)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
        for _ in range(40):
            prints.add((centre >> 32 << 32) | rng.getrandbits(32))
        for _ in range(40):
            prints.add((centre & 0xFFFFFFFF0000FFFF) | rng.getrandbits(16) << 16)
    return sorted(prints | {rng.getrandbits(64) for _ in range(50)} | {0, 1, 1 << 63})


@pytest.mark.parametrize("group", [simhash.GROUP, 6])
def test_links_join_what_brute_force_joins(spark, group):
    prints = crowd(11)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    links = [(r["u"], r["v"]) for r in simhash.fingerprint_links(df, group=group).collect()]
    mask = (1 << 64) - 1
    assert all(u != v for u, v in links)
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for u, v in links:
        x, y = top(u & mask), top(v & mask)
        root[max(x, y)] = min(x, y)
    assert {p: top(p) for p in prints} == plain_roots(prints)


def corpus(spark):
    base = " ".join("word%d" % i for i in range(400))
    rows = [
        (5, base, "a"),
        (3, base.replace("word7 ", "other "), "b"),
        (9, base, "c"),
        (9, base, "c"),
        (1, None, "d"),
        (2, "", "e"),
        (None, "a text without any id at all, twice", "f"),
        (None, "a text without any id at all, twice", "f"),
        (None, base, "g"),
        (8, "x " * 50_000, "h"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, component_id string")


def test_groups_and_the_row_that_stays(spark):
    df = corpus(spark)
    got = simhash.near_duplicate_groups(df).collect()
    assert len(got) == 10
    ids = {r["doc_id"]: r["component_id"] for r in got}
    assert ids[1] == ids[2] == 1 and ids[8] == 8 and ids[9] == ids[5]
    expected = plain_roots(sorted({plain_fingerprint(r["text"]) for r in df.collect()}))
    near = expected[plain_fingerprint(df.where("doc_id = 5").first()["text"])] == expected[plain_fingerprint(df.where("doc_id = 3").first()["text"])]
    assert ids[5] == (3 if near else 5)
    kept = simhash.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "8", "None", "3"] + ([] if near else ["5"]))


def test_empty_table(spark):
    df = corpus(spark).limit(0)
    assert simhash.near_duplicate_groups(df).collect() == []
    assert simhash.keep_one_of_each(df).collect() == []


def test_one_id_on_rows_of_many_components(spark):
    texts = [" ".join(f"t{k}w{i}" for i in range(60)) for k in range(12)]
    # One id on a third of the rows, with a text of its own each; copies of them under other ids.
    rows = [(7, t, k, {"n": k}) for k, t in enumerate(texts[:6])] + [(20 + k, t, k, None) for k, t in enumerate(texts[:6])]
    # Id 7 belongs to a component with a smaller id, too; rows repeated as a whole; a nameless copy.
    rows += [(3, texts[6], 0, None), (7, texts[6], 1, None), (30, texts[7], 5, None), (30, texts[7], 4, None), (30, texts[7], 4, None), (None, texts[7], 0, None)]
    rows += [(None, texts[8], 2, None), (None, texts[8], 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, more map<string,int>").repartition(5)
    kept = simhash.keep_one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(((r["text"], r["doc_id"], r["n"]) for r in kept.collect()), key=str)
    expected = [(t, 7, k) for k, t in enumerate(texts[:6])] + [(texts[6], 3, 0), (texts[7], 30, 4), (texts[8], None, 1)]
    assert got == sorted(expected, key=str)


def test_group_that_spans_two_batches_is_cut_further():
    import numpy as np
    import pyarrow as pa

    rows = [(i, i, 1) for i in range(11)] + [(50, 50, 2), (51, 51, 2), (60, 60, 3)]
    parts = [rows[:5], rows[5:]]
    batches = [pa.record_batch([pa.array(np.array(c, np.int64)) for c in zip(*p)], names=["fp", "free", "sig1"]) for p in parts]
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("large", pa.bool_()), ("free", pa.int64()), ("sig1", pa.int64())])
    out = [r for b in simhash._compare(1, 2, 6, schema)(iter(batches)) for r in b.to_pylist()]
    assert sorted(r["u"] for r in out if r["large"]) == list(range(11))
    assert [(r["u"], r["v"]) for r in out if not r["large"]] == [(51, 50)]
