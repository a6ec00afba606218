"""Near copies against all pairs of shingle sets."""

import random

import pytest

from riskloom.llm import nearcopies


def words_of(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")


def sets_of(text):
    words = [w for w in words_of(text) if w]
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def groups(texts):
    """Smallest place of each text's group, by every pair."""
    sets = [sets_of(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if not union or len(sets[i] & sets[j]) / union >= 0.8:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [None, "", " \t\n", "one two", "One  TWO", "one two three"]
    for n in (30, 60, 120, 400):
        for _ in range(12):
            base = draw.choices(vocabulary, k=n)
            texts.append(" ".join(base))
            for share in (0.0, 0.01, 0.02, 0.04, 0.1):
                changed = list(base)
                for i in draw.sample(range(n), int(share * n)):
                    changed[i] = draw.choice(vocabulary)
                texts.append(" ".join(changed).upper() if draw.random() < 0.3 else "  ".join(changed))
    return texts


def test_groups_are_those_of_all_pairs(spark, corpus):
    root = groups(corpus)
    rows = [(i, t, "x", "y") for i, t in enumerate(corpus)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _digest string, class string").repartition(7)
    out = nearcopies.keep_one_of_near_copies(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(root))


def test_group_of_near_copies_keeps_one(spark):
    base = [f"b{i}" for i in range(200)]
    texts = [" ".join([*base[:i], f"new{i}", *base[i + 1 :]]) for i in range(1, 200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    assert [r["doc_id"] for r in nearcopies.keep_one_of_near_copies(df).collect()] == [0]


def test_repeated_ids_null_ids_and_equal_rows(spark):
    rows = [(1, "a b c d e f", 3), (1, "g h i j k l", 2), (1, "a b c d e f", 1), (None, "m n o p q r", 0), (None, "A b c d e f", 0), (2, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id int")
    got = sorted((tuple(r) for r in nearcopies.keep_one_of_near_copies(df).collect()), key=str)
    assert got == sorted([(1, "a b c d e f", 1), (1, "g h i j k l", 2), (None, "m n o p q r", 0), (2, None, 0)], key=str)


def test_empty_table_and_long_text(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert nearcopies.keep_one_of_near_copies(df).collect() == []
    long = " ".join(f"v{i % 70001}" for i in range(300000))
    df = spark.createDataFrame([(1, long), (2, long + " tail"), (3, "short")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in nearcopies.keep_one_of_near_copies(df).collect()) == [1, 3]


def test_signatures_follow_the_similarity():
    draw = random.Random(9)
    shared = 0
    for _ in range(50):
        base = [draw.getrandbits(63) for _ in range(450)]
        a = nearcopies.np.unique(nearcopies.np.array(base[:400], nearcopies.np.uint64))
        b = nearcopies.np.unique(nearcopies.np.array(base[50:], nearcopies.np.uint64))
        shared += bool(set(nearcopies.signatures(a)) & set(nearcopies.signatures(b)))
    assert shared >= 48
