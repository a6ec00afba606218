"""Stages one by one and the whole run, on a planted corpus."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import pieces

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, accepted string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Given documents, with planted ones and a benchmark beside them."""
    path = tmp_path_factory.mktemp("sf")
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 200").withColumn("accepted", F.lit("mine"))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    bench.write.parquet(str(path / "benchmark.parquet"))
    item = bench.orderBy("item_id").first()["text"]
    clean = docs.where("doc_id = 1").first()["text"]
    passage = " ".join(f"the{i} and of{i} in" for i in range(40))

    def own(name):
        return " ".join(f"the{name}{i} and of{name}{i} in" for i in range(40)) + " "

    rows = [
        (1001, clean, "en", "s", 0, "x"),
        (1002, item, "en", "s", 0, "x"),
        (1003, "before the passage in " + passage + " after it all", "en", "s", 0, "x"),
        (1004, "something other is here " + passage + " and another end", "en", "s", 0, "x"),
        (1005, None, "en", "s", 0, "x"),
        (1006, "12345", None, "s", 0, "x"),
        (1007, "", None, None, None, None),
        (1008, "a first text with words of its own " + own("first") + passage, "en", "s", 0, "x"),
        (1009, passage + " and then a second text with words " + own("second"), "en", "s", 0, "x"),
    ]
    docs.select("doc_id", "text", "lang", "source", "n_chars", "accepted").unionByName(spark.createDataFrame(rows, SCHEMA)).write.parquet(
        str(path / "documents.parquet")
    )
    return str(path)


def test_run_and_what_each_stage_decides(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, seen[-1], folder)
        if i < 4:
            assert out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(f"{folder}/stage-{i}")
        seen.append(spark.read.parquet(f"{folder}/stage-{i}"))
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in seen]
    assert ids[0] - ids[1] == {1005, 1006, 1007}
    assert 1001 in ids[1] - ids[2] and 1 in ids[2]
    assert ids[2] == ids[3]
    left = {r["doc_id"]: r for r in seen[3].where("doc_id > 1000").collect()}
    # 1003 and 1004 share 156 of 176 shingles: near copies. 1008 and 1009 share the passage only.
    assert 1004 in ids[1] - ids[2] and {1003, 1008, 1009} <= ids[2]
    assert "the20 and of20" in left[1003]["text"]
    for i, start in ((1008, "a first text"), (1009, "a second text with words")):
        assert "the20 and of20" not in left[i]["text"] and start in left[i]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in left.values())
    assert 1002 in ids[3] - ids[4]
    model = pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model")).library
    texts = {r["doc_id"]: r["text"] for r in seen[4].collect()}
    for r in seen[5].collect():
        assert r["n_tokens"] == len(model.encode(texts[r["doc_id"]])) + 2
    whole = corpus_pipeline.run(spark, folder)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in whole.collect()) == sorted((r["doc_id"], r["n_tokens"]) for r in seen[5].collect())


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == []
