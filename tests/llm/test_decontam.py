"""Hit words against a plain search, in one block and in many."""

import random
import re

import pytest

from riskloom.llm import decontam

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, window=13):
    w = plain_words(text)
    hit, found = set(), set()
    for item, t in items:
        b = plain_words(t)
        n = min(window, len(b))
        for i in range(len(b) - n + 1 if b else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == b[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add(item)
    return len(w), len(hit), sorted(str(i) for i in found if i is not None)


def tables(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["The", "a", "of", "Éé", "x9", "benchmark"])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 5, 13, 14, 30])))) for i in range(12)]
    items += [(3, items[3][1]), (50, None), (51, "... !"), (None, "nameless item or five words"), (52, "")]
    docs = [(None, None, 1), (1, "", 2), (2, "  ;; ", 3), (2, "  ;; ", 3)]
    for i in range(3, 20):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30)))]
        t = rng.choice(items)[1] or ""
        docs.append((i, ", ".join([*parts, t.upper() if i % 2 else t, "tail"]), 4))
    docs.append((30, "filler " * 30_000 + "nameless  ITEM or\nfive words", 5))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, n_hit int"),
        spark.createDataFrame(items, "item_id long, text string"),
        docs,
        items,
    )


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_BYTES, 200])
def test_hits_spans_and_items(spark, block_bytes):
    df, benchmark, docs, items = tables(spark)
    out = decontam.find_contamination(df, benchmark, block_bytes=block_bytes)
    assert out.columns == ["doc_id", "text", "n_words", "n_hit", "hit_spans", "item_ids", "contaminated"]
    got = out.collect()
    assert len(got) == len(docs)
    for r in got:
        if r["doc_id"] == 30:
            assert (r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) == (30_005, 5, [], False)
            (span,) = r["hit_spans"]
            assert r["text"][span["start"] : span["end"]] == "nameless  ITEM or\nfive words"
            continue
        n, h, found = plain(r["text"], items)
        assert (r["n_words"], r["n_hit"], r["item_ids"]) == (n, h, found), r
        assert r["contaminated"] == (h > 0 and 20 * h >= n)
        inside = sum(len(plain_words(r["text"][s["start"] : s["end"]])) for s in r["hit_spans"])
        assert inside == h


def test_empty_tables(spark):
    df, benchmark, docs, _ = tables(spark)
    assert decontam.find_contamination(df.limit(0), benchmark).collect() == []
    assert {r["n_hit"] for r in decontam.find_contamination(df, benchmark.limit(0)).collect()} == {0}


def test_calls_of_one_session_keep_their_automata_apart(spark, monkeypatch):
    # Lists of successive calls often lie at the same address.
    monkeypatch.setattr(decontam, "id", lambda items: 1, raising=False)
    sent = []
    monkeypatch.setattr(decontam, "_scanner", lambda name, items, window, *_: sent.append((name, items.value, window)) or (lambda batches: batches))
    text = "one two three four five six seven"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")

    def hits(items, window):
        decontam.find_contamination(df, spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), window=window)
        # What a worker does with it that is kept for all calls.
        return decontam._machine(*sent[-1]).scan(decontam.words(text))

    assert hits(["one two three", "elsewhere"], 3) == ([(0, 2)], {"0"})
    assert hits(["of another kind", "five six seven"], 3) == ([(4, 6)], {"1"})
    assert hits(["of another kind", "five six eight"], 3) == ([], set())
    assert hits(["of another kind", "five six eight"], 2) == ([(4, 5)], {"1"})
