"""Columns called like the operators' own, and training samples that stay within their bounds."""

import pytest
from pyspark.sql import functions as F

from riskloom.llm import decontam, htmltext, langid, licences, pieces, runs, toxicity, urlfilter
from riskloom.llm.queries import PIECE_MODEL

OWN = ["_text", "_page", "_subject", "_best", "_row", "row", "_key", "_runs", "_items", "__text", "draw_", "row_", "text_"]


@pytest.fixture(scope="module")
def clash(spark):
    rows = [(i, f"some words of text number {i} in a line", f"http://a.org/{i}", "<article><p>hello there</p></article>", *[f"{n}-{i}" for n in OWN]) for i in range(4)]
    return spark.createDataFrame(rows, "doc_id long, text string, url string, html string, " + ", ".join(f"`{n}` string" for n in OWN))


def chain():
    return toxicity.Chain(["toxic"])


OPERATORS = {
    "pieces": lambda df: pieces.encode_pieces(df, PIECE_MODEL),
    "language": lambda df: langid.predict_language(df, langid.fit_language_model(df.withColumn("lang", F.lit("en")))),
    "url": lambda df: urlfilter.judge_urls(df, [urlfilter.site_rule("org/", "allow")]),
    "url join": lambda df: urlfilter.judge_urls(df, [urlfilter.site_rule("org/", "allow")], literal_rules=0),
    "page": lambda df: htmltext.extract_text(df, htmltext.fit_page_model(df, key="doc_id"), column="main"),
    "decontamination": lambda df: decontam.find_contamination(df, df.select(F.col("doc_id").alias("item_id"), "text")),
    "decontamination in blocks": lambda df: decontam.find_contamination(df, df.select(F.col("doc_id").alias("item_id"), "text"), block_bytes=60),
    "toxicity": lambda df: toxicity.predict_toxicity(df, toxicity.train(["a b", "c d"] * 6, __import__("numpy").array([[1], [0]] * 6), ["toxic"])),
    "licences": lambda df: licences.scan_licences(df, [("some words", "x")]),
    "runs": lambda df: runs.find_runs(df),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_named_like_internals_come_back(clash, name):
    out = OPERATORS[name](clash)
    got = out.select("doc_id", *[F.col(f"`{n}`") for n in OWN]).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(i, *[f"{n}-{i}" for n in OWN]) for i in range(4)]


def test_language_sample_with_one_id_copies_and_nulls(spark):
    texts = [(7, f"word{i} text", "en") for i in range(3_000)] + [(7, "copy of one text", "en")] * 3_000
    texts += [(None, f"mot{i} texte", "fr") for i in range(3_000)] + [(1, None, "en"), (2, "x", None), (3, "lang " * 30_000, "de")]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    sample = langid.training_sample(df, rows_per_language=200)
    counts = {x: [t for t, y in sample if y == x] for x in ("en", "fr", "de")}
    assert 60 <= len(counts["en"]) <= 200 and 100 <= len(counts["fr"]) <= 200 and len(counts["de"]) == 1
    assert counts["en"].count("copy of one text") <= 1 and len(counts["de"][0]) == langid.MAX_TEXT_CHARS
    assert sample == langid.training_sample(df.repartition(5), rows_per_language=200)


def test_toxicity_sample_with_repeated_ids_and_labels(spark):
    docs = spark.createDataFrame([(7, f"text {i}") for i in range(3_000)] + [(i, "t") for i in range(100, 400)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1, 1)] * 500 + [(i, 0, i % 2) for i in range(100, 400)] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    sample = toxicity.labelled_sample(docs, labels, "toxic", rows_per_class=100)
    counts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    assert 0 < counts[0] <= 100 and 0 < counts[1] <= 100
    assert sample.count() == sample.distinct().count()


def test_page_sample_of_copies(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(htmltext, "train", lambda pages: seen.append(pages))
    rows = [(1, "<p>same</p>")] * 2_000 + [(i, f"<p>page {i}</p>") for i in range(2_000)]
    htmltext.fit_page_model(spark.createDataFrame(rows, "page_id long, html string"), sample=50)
    assert 15 <= len(seen[0]) <= 50 and seen[0].count("<p>same</p>") <= 1
