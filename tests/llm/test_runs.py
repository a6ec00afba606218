"""Periodic runs against a search of every period and place."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from riskloom.llm import runs


def plain(words, floor=2, least=2):
    """Every maximal stretch of each period, kept if no smaller period holds in it."""
    out, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(floor, least * q):
                if all(any(words[k] != words[k + p] for k in range(i, i + size - p)) for p in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def periodic(words, rng):
    n = len(words)
    if n < 4:
        return words
    a, p = rng.randrange(n), rng.randint(1, max(1, n // 3))
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_all_runs_against_plain_search():
    rng = random.Random(3)
    for _ in range(1500):
        words = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(70))]
        if rng.random() < 0.5:
            words = periodic(words, rng)
        assert runs.all_runs(words) == plain(words)


def test_long_runs_and_many_occurrences():
    words = list(range(500)) + [7, 8] * 4_000 + [9] * 3_000
    assert [r for r in runs.all_runs(words) if r[1] >= 24] == [(500, 8_000, 2), (8_500, 3_000, 1)]
    rng = random.Random(4)
    words = periodic([rng.randrange(40) for _ in range(6_000)], rng)
    assert runs.all_runs(words) == plain(words)


@pytest.mark.parametrize(("floor", "least"), [(24, 3), (6, 3), (1, 3), (40, 4)])
def test_operator_on_several_texts(spark, floor, least):
    rng = random.Random(floor)
    texts = [None, "", " \t\n ", "a", "x " * 23, "x " * 24]
    for _ in range(150):
        words = [str(rng.randrange(rng.choice([2, 3, 50]))) for _ in range(rng.randrange(160))]
        texts.append(rng.choice([" ", "\n", " \t", "\r\n"]).join(periodic(words, rng)))
    texts += ["a b " * 30, "a\x1cb c " * 30, "a\x0bb\x0c" * 30]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "k int, text string, row int")
    got = {r["k"]: r for r in runs.find_runs(df, floor=floor, least=least).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        words = (text or "").encode().split()
        expect = plain(words, floor, least)
        r = got[k]
        assert r["row"] == k and r["n_words"] == len(words)
        assert [tuple(x) for x in r["runs"]] == expect
        dropped = {i for s, n, q in expect for i in range(s + q, s + n)}
        assert r["collapsed"] == b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()
        best = min(expect, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (tuple(r["strongest"]) if r["strongest"] else None) == best


def test_edges(spark):
    empty = spark.createDataFrame([], "text string, runs string")
    out = runs.find_runs(empty)
    assert out.collect() == [] and out.columns == ["text", *runs.ADDED.names]
    clash = spark.createDataFrame([("a " * 100, 1, 2, 3)] * 3, "text string, row int, _text int, strongest int")
    rows = runs.find_runs(clash).collect()
    assert rows[0] == rows[1] == rows[2] and rows[0]["row"] == 1 and rows[0]["_text"] == 2
    assert tuple(rows[0]["strongest"]) == (0, 100, 1)
    with pytest.raises(ValueError):
        runs.find_runs(clash, least=2)


def test_query_against_plain_search(spark, tmp_path):
    """The registered query on texts short enough for the plain search, with the rule that plants runs."""
    from riskloom.llm import queries

    rng = random.Random(9)
    docs = []
    for i in range(300):
        words = [str(rng.randrange(rng.choice([3, 400]))) for _ in range(rng.randrange(250))]
        docs.append((i, " ".join(words)))
    docs += [(None, "b " * 50), (1_000, None), (1_001, ""), (7, "c d " * 40)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    digest = lambda x: hashlib.sha256(x).hexdigest()
    expect = []
    for i, text in docs:
        words = (text or "").encode().split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if j < a else words[a + (j - a) % p] for j, w in enumerate(words)]
        found = plain(words, 24, 3)
        dropped = {j for s, n, q in found for j in range(s + q, s + n)}
        kept = b" ".join(w for j, w in enumerate(words) if j not in dropped)
        s, n, q = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        milli = 1000 * n // q if found else None
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in found).encode()
        expect.append((i, len(found), s, n, q, milli, digest(lines), digest(kept)))
    got = [tuple(r) for r in queries.QUERIES["op13_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(expect, key=repr) and sum(g[1] for g in got) > 10
