"""Removed bytes against a plain search, in few and many ranges, with blocks and single strings."""

import random

import pytest

from riskloom.llm import suffixes


def plain(rows):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            s = data[i : i + 100]
            if s in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), spans, kept))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(4)
    letters = "abcdefgh éä"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [text(n) for n in (60, 99, 100, 101, 150, 400)]
    rows = [(i, "".join(rng.choice([text(rng.randint(1, 120)), rng.choice(passages)]) for _ in range(rng.randint(1, 6)))) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (101, rows[3][1]), (102, "z" * 700), (103, "ab" * 200), (104, ""), (105, None), (None, rows[5][1])]
    rows += [(106, "é" * 90), (107, "x" + "é" * 90), (108, text(5000) + passages[5] * 3)]
    return rows


@pytest.mark.parametrize(("range_bytes", "hot"), [(suffixes.RANGE_BYTES, suffixes.HOT), (700, suffixes.HOT), (700, 1), (3000, 3)])
def test_as_a_plain_search(spark, range_bytes, hot):
    rows = corpus()
    df = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, _p string")
    out = suffixes.remove_repeats(df, range_bytes=range_bytes, hot=hot)
    assert out.columns == ["doc_id", "text", "_p", "n_bytes", "n_removed", "removed_spans", "kept"]
    got = out.collect()
    mine = sorted([(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["removed_spans"]), bytes(r["kept"])) for r in got], key=str)
    assert mine == plain(rows)
    for r in got:
        assert r["text"] == bytes(r["kept"]).decode("utf-8", "ignore")
        assert sum(s["end"] - s["start"] for s in r["removed_spans"]) == r["n_removed"]


def test_grams_in_small_lots(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(8)
    data = rng.integers(0, 2, (300, suffixes._BLOCK_BYTES)).astype(np.uint8)
    data[:, 0], data[:, 1:8] = rng.integers(0, 9, 300), 0
    data[:, 16], data[:, 17] = 2, 5
    data[:, 18:] = data[rng.integers(0, 40, 300), 18:]
    data[:, 8:16] = np.stack([np.arange(300), np.full(300, 50)], axis=1).astype("<u4").view(np.uint8)
    p = rng.integers(0, 5, 300)
    whole = suffixes._settle_blocks(data, p)
    monkeypatch.setattr(suffixes, "BLOCK_ROWS", 20)
    lots = suffixes._settle_blocks(data, p)
    rows = lambda r: sorted((int(o), *map(int, c)) for c, o in zip(*r))
    assert rows(whole) == rows(lots) and rows(whole)


def test_cut_pieces_change_nothing(spark, monkeypatch):
    import numpy as np

    text = np.frombuffer((corpus()[-1][1] * 2).encode(), np.uint8)
    valid = np.ones(len(text) - 99, bool)
    s, e, a, gram, body = suffixes._blocks(text, valid)
    assert (a >= e).all() and (a - s <= 76).all() and s[0] == 0 and e[-1] == len(valid) - 1
    strings = {}
    for start in range(len(valid)):
        block = int(np.searchsorted(s, start, side="right")) - 1
        # Equal strings have the same cover gram at the same distance.
        assert strings.setdefault(text[start : start + 100].tobytes(), (gram[block], a[block] - start)) == (gram[block], a[block] - start)


def test_empty_and_tiny_tables(spark):
    df = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    assert suffixes.remove_repeats(df.limit(0)).collect() == []
    assert {r["n_removed"] for r in suffixes.remove_repeats(df).collect()} == {0}
