"""From raw documents to piece ids: five stages, each one of the corpus operators.

``run`` writes what a stage returns as Parquet to the shared folder and gives it to the next one.
Every stage but the last returns the columns of ``documents``; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.session import materialise
from riskloom.llm import decontam, langid, nearcopies, pieces, queries, suffixes

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model accepts; a text without letters is rejected."""
    docs = docs.select(*COLUMNS)
    told = langid.predict_language(docs, queries.language_model(docs))
    return told.where("accepted").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8 or more), the one of smallest id."""
    return nearcopies.keep_one_of_near_copies(docs.select(*COLUMNS))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one holds; ``n_chars`` follows the text."""
    left = suffixes.remove_repeats(docs.select(*COLUMNS))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of the benchmark."""
    benchmark = queries.table(spark, sf_dir, "benchmark")
    return decontam.find_contamination(docs.select(*COLUMNS), benchmark).where("NOT contaminated").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with begin and end, and the digest of what they decode to."""
    coded = pieces.encode_pieces(docs.select(*COLUMNS), queries.PIECE_MODEL)
    return coded.select(
        "doc_id",
        "lang",
        "source",
        "n_tokens",
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_languages),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", remove_repeated_passages),
    ("benchmark", drop_contaminated),
    ("pieces", encode),
]

# Fingerprints, suffix buckets, a trained model and a vocabulary are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{i + 1}-{name.replace(' ', '-')}")
    return docs
