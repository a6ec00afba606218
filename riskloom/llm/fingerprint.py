"""Document fingerprints by a homomorphic multiset hash of paragraphs.

A text is the multiset of its paragraphs (lines that hold more than white space). A paragraph stands for a wide
vector: the sum of the vectors of its own hash and of its adjacent word pairs, each a row of 128
bits taken from two 64-bit hashes. The fingerprint is the sum over all paragraphs, lane by lane,
modulo 2^32, with the number of summands modulo 2^32 in front. A text of at most 2 GB has fewer than
2^31 summands, so its lanes are the sums themselves. So

* the order of paragraphs does not matter, and equal multisets have equal fingerprints;
* paragraphs are inserted or deleted by adding or subtracting fingerprints, without the text;
* twice a lane less the number of summands is a sum of random signs, so the cosine of two
  fingerprints estimates how much of their contents two texts share, to about 0.09.

Everything is DataFrame functions; sums run in generated code, one row per summand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.ranges import range_cuts, range_of

LANES = 128
_PAIR = (1 << 32) | 1  # one bit in each half of a 64-bit word


def _summands(text: Column) -> Column:
    """Hashes of the paragraphs and of their word pairs (the last word of each stands alone)."""
    paragraphs = F.filter(F.split(text, "\n"), lambda p: F.trim(p, F.lit(" \t\r\x0b\x0c")) != "")

    def cut(p: Column) -> Column:
        words = F.filter(F.split(p, r"\s+"), lambda w: w != "")
        return F.struct(p.alias("p"), F.transform(words, lambda w: F.xxhash64(w)).alias("w"))

    def summands(c: Column) -> Column:
        rest = F.slice(c["w"], 2, F.greatest(F.size(c["w"]), F.lit(1)))
        pairs = F.zip_with(c["w"], rest, lambda a, b: F.xxhash64(a, b))
        return F.concat(F.array(F.xxhash64(c["p"], F.lit("paragraph"))), pairs)

    return F.flatten(F.transform(F.transform(paragraphs, cut), summands))


def _lane_sums(h: str) -> list[Column]:
    """Two counters of 31 bits to a sum, which no text of at most 2 GB can overflow."""
    words = [F.col(h), F.when(F.col(h).isNotNull(), F.xxhash64(F.col(h), F.lit(1)))]
    return [
        F.coalesce(F.sum(F.shiftrightunsigned(w, k).bitwiseAND(F.lit(_PAIR))), F.lit(0)).alias(f"_w{i}_{k}")
        for i, w in enumerate(words)
        for k in range(32)
    ]


def _lanes() -> Column:
    """The fingerprint as an array: number of summands, then the lanes."""
    sums = [F.col(f"_w{i}_{k}") for i in range(2) for k in range(32)]
    low = [s.bitwiseAND(F.lit(0xFFFFFFFF)) for s in sums]
    high = [F.shiftrightunsigned(s, 32) for s in sums]
    count = F.col("_n").bitwiseAND(F.lit(0xFFFFFFFF))
    return F.array(count, *low, *high)


def fingerprint_rows(df: DataFrame, text: str, keys: Sequence[str], column: str = "lanes") -> DataFrame:
    """``keys`` and the fingerprint of ``text``; ``keys`` have to tell the rows apart.

    The fingerprint is an array of 129 numbers. A null, empty or blank text has all zeros. Where
    ``df`` is partitioned by some of ``keys`` already, nothing is shuffled.
    """
    each = df.select(*keys, F.explode_outer(_summands(F.col(text))).alias("_h"))
    sums = each.groupBy(*keys).agg(F.count("_h").alias("_n"), *_lane_sums("_h"))
    return sums.select(*keys, _lanes().alias(column))


def combine(a: Column, b: Column, delete: bool = False) -> Column:
    """The fingerprint after inserting (or deleting) the paragraphs of ``b`` into those of ``a``."""
    sign = -1 if delete else 1
    return F.zip_with(a, b, lambda x, y: F.pmod(x + sign * y, F.lit(1 << 32)))


def _signs(lanes: Column) -> Column:
    """Lanes as signed sums: 2 * lane - count, modulo 2^32, between -2^31 and 2^31."""
    n = F.element_at(lanes, 1)
    half = 1 << 31
    return F.transform(F.slice(lanes, 2, LANES), lambda x: (F.pmod(2 * x - n + half, F.lit(2 * half)) - half).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: one for equal fingerprints, else the cosine of the signed lanes, zero if negative."""
    pairs = F.zip_with(_signs(a), _signs(b), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    zero = F.struct(F.lit(0.0).alias("xy"), F.lit(0.0).alias("xx"), F.lit(0.0).alias("yy"))
    sums = F.aggregate(
        pairs,
        zero,
        lambda s, p: F.struct(
            (s["xy"] + p["x"] * p["y"]).alias("xy"), (s["xx"] + p["x"] * p["x"]).alias("xx"), (s["yy"] + p["y"] * p["y"]).alias("yy")
        ),
        lambda s: F.when((s["xx"] > 0) & (s["yy"] > 0), s["xy"] / F.sqrt(s["xx"] * s["yy"])).otherwise(0.0),
    )
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), sums)))


def to_hex(lanes: Column) -> Column:
    """The fingerprint as text: eight hex digits for the count and for each lane."""
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def with_next(df: DataFrame, key: str, columns: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Rows in descending order of ``key``, each next to the one that follows (the last: the first).

    Returns ``_range``, ``_place`` (order within the range), ``_ghost``, ``key``, ``columns`` and
    ``_next_<column>``. Ranges are cut at values of ``key``; the first row of every range is added
    once more, as a ghost, behind the last row of the range before it, so every range is complete in
    itself and one shuffle does. Ghosts have no next row. Null keys come last, equal keys are
    ordered by the columns.
    """
    cuts = range_cuts(df, key, ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    id_ = F.col(key)
    if cuts:
        own = range_of(id_, cuts)
        # The largest id of a range is also wanted by the range above, the largest of all by range 0.
        above = F.when(id_ == F.lit(cuts[-1]), F.lit(0)).when(F.array_contains(F.array(*map(F.lit, cuts)), id_), own + 1)
        places = F.filter(
            F.array(
                F.struct(own.alias("range"), F.lit(False).alias("ghost")),
                F.struct(above.alias("range"), F.lit(True).alias("ghost")),
            ),
            lambda p: p["range"].isNotNull(),
        )
    else:
        # Only null keys: one range, in the order of the columns; the first follows the last.
        places = F.array(
            F.struct(F.lit(0).alias("range"), F.lit(False).alias("ghost")), F.struct(F.lit(0).alias("range"), F.lit(True).alias("ghost"))
        )
    dealt = df.select(key, *columns, F.explode(places).alias("_p")).select(
        F.col("_p.range").alias("_range"), F.col("_p.ghost").alias("_ghost"), key, *columns
    )
    order = Window.partitionBy("_range").orderBy("_ghost", F.col(key).desc_nulls_last(), *columns)
    return dealt.select("*", F.row_number().over(order).alias("_place"), *[F.lead(c).over(order).alias(f"_next_{c}") for c in columns])


def compare_edits(df: DataFrame, id_column: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has its last third (rounded down, in code points) replaced by as many of the
    first code points of the next text in descending order of ids; the last one's next is the first.
    A null text counts as empty. Equal rows come back as often as they were given.
    """
    given = df.select(df[id_column].alias("_id"), F.coalesce(df[text].cast("string"), F.lit("")).alias("_text"))
    rows = with_next(given, "_id", ["_text"], ranges)
    n = F.length("_text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - cut), F.substring(F.coalesce("_next__text", F.lit("")), F.lit(1), cut))
    both = rows.withColumn("_edited", edited).select(
        "_range",
        "_place",
        "_ghost",
        "_id",
        n.cast("long").alias("_size"),
        F.sha2(F.col("_edited").cast("binary"), 256).alias("_sha"),
        F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("_text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("_edited").alias("t")))).alias("_v"),
    )
    keys = ["_range", "_place", "_which", "_ghost", "_id", "_size", "_sha"]
    prints = fingerprint_rows(both.withColumns({"_which": F.col("_v.which"), "_t": F.col("_v.t")}), "_t", keys)
    # Behind a text's row come its edited text's, and then the next text's.
    order = Window.partitionBy("_range").orderBy("_place", "_which")
    around = prints.select("*", F.lead("lanes", 1).over(order).alias("_edit"), F.lead("lanes", 2).over(order).alias("_next"))
    return around.where("_which = 0 AND NOT _ghost").select(
        F.col("_id").alias(id_column),
        F.col("_size").alias("n_chars"),
        F.col("_sha").alias("edited_sha256"),
        "lanes",
        F.col("_edit").alias("edited_lanes"),
        likeness(F.col("lanes"), F.col("_edit")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("_next")).alias("near_next"),
    )
