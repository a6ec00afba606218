"""Licence scans against a plain search, and the expression parser by cases."""

import random
import re

import pytest

from riskloom.llm import licences
from riskloom.llm.queries import LICENCE_PHRASES

SF = "/root/testdata/sf0.001"


def plain(text, base=LICENCE_PHRASES):
    """Base places by comparing every position with every phrase."""
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    places = []
    for phrase, label in base:
        own = phrase.split()
        places += [(i, label) for i in range(len(words) - len(own) + 1) if words[i : i + len(own)] == own]
    return len(words), sorted(places)


def test_query_against_plain_search(spark):
    from riskloom.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_licences"](spark, SF).collect()
    assert len(rows) == len(docs)
    found = 0
    for r in rows:
        n, places = plain(docs[r["doc_id"]])
        at = [i for i, _ in places]
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        assert (r["first_word"], r["last_word"]) == ((min(at), max(at)) if at else (None, None))
        labels = {x for _, x in places}
        assert r["base_labels"] == ",".join(sorted(labels))
        assert labels <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
        found += bool(places)
    assert found


def test_random_texts():
    rng = random.Random(5)
    parts = ["under", "the", "MIT", "License", "cc", "BY", "nc", "by", "apache", "version", "2", "é", "Ä2"]
    scanner = licences.LicenceScanner(LICENCE_PHRASES)
    for _ in range(500):
        text = "".join(rng.choice(parts) + rng.choice([" ", "-", "\n", ", ", "_", " "]) for _ in range(rng.randrange(40)))
        n, places = plain(text)
        got = scanner.scan(text)
        assert (got[0], got[1]) == (n, places)


@pytest.mark.parametrize(
    ("text", "order", "labels", "freedom"),
    [
        ("MIT", ["MIT"], ["mit"], 2),
        ("MIT OR GPL-3.0-only", ["MIT", "GPL-3.0-only", "or"], ["gpl-3", "mit"], 2),
        ("MIT AND GPL-3.0-only", ["MIT", "GPL-3.0-only", "and"], ["gpl-3", "mit"], 0),
        ("MIT OR GPL-2.0 AND LGPL-2.1+", ["MIT", "GPL-2.0", "LGPL-2.1+", "and", "or"], ["gpl-2", "lgpl-2.1", "mit"], 2),
        ("(MIT OR GPL-2.0) AND MPL-2.0", ["MIT", "GPL-2.0", "or", "MPL-2.0", "and"], ["gpl-2", "mit", "mpl-2"], 1),
        ("GPL-2.0 WITH Classpath-exception-2.0-exception", ["GPL-2.0", "Classpath-exception-2.0-exception", "with"], ["gpl-2"], 1),
        ("Apache-2.0 or later versions", ["Apache-2.0"], ["apache-2"], 2),
        ("(MIT", [], [], None),
        ("MIT) AND ISC", ["MIT"], ["mit"], 2),
        ("CC-BY-NC-4.0", ["CC-BY-NC-4.0"], ["cc-by-nc"], 0),
        ("BSD-3-Clause and ISC", ["BSD-3-Clause", "ISC", "and"], ["bsd-3-clause", "isc"], 2),
        ("something", [], [], None),
    ],
)
def test_expressions(text, order, labels, freedom):
    got, whole = licences.postfix([t for t, _ in licences.tokens_at(text, 0)])
    assert got == order
    if whole:
        assert licences.evaluate(got) == (labels, freedom)


def test_deep_parentheses():
    text = "(" * 20_000 + "MIT" + ")" * 20_000
    order, whole = licences.postfix([t for t, _ in licences.tokens_at(text, 0)])
    assert (order, whole) == (["MIT"], 40_001)


def test_tags_notices_and_edges(spark):
    texts = [
        None,
        "",
        "SPDX-License-Identifier: (MIT OR Apache-2.0)\nrest",
        '{"license": "ISC"}',
        "license to kill",
        "GNU General Public License, version 3",
        "CC BY-NC-SA",
        "cc by nc " * 50_000,
        "cc by nc",
        "cc by nc",
    ]
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], "k int, text string, row int, _text string")
    got = {r["k"]: r for r in licences.scan_licences(df, [("cc by nc", "cc-by-nc"), ("", "never")]).collect()}
    assert len(got) == len(texts) and all(r["row"] == 7 and r["_text"] == "x" for r in got.values())
    assert got[0]["n_words"] == got[1]["n_words"] == 0 and got[0]["labels"] == [] and got[0]["score"] == 0
    e = got[2]["expressions"][0]
    assert texts[2][e["start"] : e["end"]] == "(MIT OR Apache-2.0)" and e["labels"] == ["apache-2", "mit"] and e["freedom"] == 2
    assert got[3]["labels"] == ["isc"] and got[4]["labels"] == []
    span = got[5]["notices"]
    assert [x["label"] for x in span] == ["gpl-3"] and texts[5][span[0]["start"] : span[0]["end"]] == texts[5]
    assert got[6]["labels"] == ["cc-by-nc", "cc-by-nc-sa"]
    assert len(got[7]["base_places"]) == 50_000 and got[7]["base_places"][-1]["word"] == 3 * 49_999
    assert got[8]["labels"] == got[9]["labels"] == ["cc-by-nc"]


def test_empty_table_and_replaced_columns(spark):
    df = spark.createDataFrame([], "text string, labels string")
    out = licences.scan_licences(df, [("mit", "mit")])
    assert out.collect() == [] and out.columns == ["text", *licences.ADDED.names]
    one = spark.createDataFrame([("mit", "old")], "text string, labels string")
    assert licences.scan_licences(one, [("mit", "mit")]).first()["labels"] == ["mit"]
