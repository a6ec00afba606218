"""The lookup table against plain turn-taking, and where keys go."""

from collections import Counter

import pytest

from riskloom.llm import shards

NAMES = [f"s{i}" for i in range(7)]


def plain(names, size):
    prefer = {}
    for n in names:
        start, step = shards._preference(n, size)
        prefer[n] = [(start + j * step) % size for j in range(size)]
        assert sorted(prefer[n]) == list(range(size))
    owner = {}
    while len(owner) < size:
        for n in names:
            if len(owner) < size:
                owner[next(s for s in prefer[n] if s not in owner)] = n
    return [owner[s] for s in range(size)]


def test_turns_as_in_plain_python():
    table = shards.fill_table(NAMES, 101)
    assert [NAMES[i] for i in table] == plain(NAMES, 101)


def test_even_shares_weights_and_few_changes():
    table = shards.fill_table(NAMES, 1009)
    count = Counter(table.tolist())
    assert max(count.values()) - min(count.values()) <= 1
    fewer = shards.fill_table(NAMES[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved / 1009 < 0.2
    weighted = Counter(shards.fill_table(NAMES, 1009, [2, 1, 1, 1, 1, 1, 0]).tolist())
    assert weighted[6] == 0 and abs(weighted[0] - 2 * weighted[1]) <= 2


@pytest.mark.parametrize(("names", "size"), [([], 7), (["a", "a"], 7), (["a"], 8), (list("abcd"), 3)])
def test_refused_tables(names, size):
    with pytest.raises(ValueError):
        shards.fill_table(names, size)


def test_placement_of_rows(spark, tmp_path):
    rows = [(1, "a"), (2, "b"), (2, "b"), (None, "c"), (3, "d")]
    df = spark.createDataFrame(rows, "doc_id long, shard string")
    out = shards.assign_shards(df, "doc_id", NAMES, 101)
    assert out.columns == ["doc_id", "slot", "shard"]
    got = out.collect()
    assert len(got) == 5 and {r["slot"] for r in got if r["doc_id"] is None} == {0}
    table = shards.fill_table(NAMES, 101)
    assert all(r["shard"] == NAMES[table[r["slot"]]] for r in got)
    assert len({r["shard"] for r in got if r["doc_id"] == 2}) == 1
    assert shards.assign_shards(df.limit(0), "doc_id", NAMES, 101).collect() == []
    shards.write_shards(spark.range(500), str(tmp_path / "out"), "id", NAMES, files_per_shard=2, size=101)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 500 and {r[0] for r in back.select("shard").distinct().collect()} == set(NAMES)
