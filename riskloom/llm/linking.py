"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.session import materialise


PARTS = 64  # tasks that the rows of one key may be dealt to


def join_split(rows: DataFrame, table: DataFrame, key: str, by: str, parts: int = PARTS) -> DataFrame:
    """``rows`` joined with ``table``, of which a key has one row, with no task holding all rows of a key.

    Rows are dealt by key and a part of ``by``; only distinct (key, part) pairs, at most ``parts`` a key,
    meet the table itself.
    """
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(parts)).cast("int"))
    owned = dealt.select(key, "_part").distinct().join(table, key)
    return dealt.join(owned, [key, "_part"]).drop("_part")


def _star(links: DataFrame) -> DataFrame:
    """One round: every node's neighbours are tied to its smallest neighbour, larger ones first.

    The first half is written, as the second one reads it four times: a plan of both has 27 exchanges
    instead of 4, and the driver makes it anew whenever some of them are done.
    """
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    tied = join_split(both.where("v > u"), low, "u", "v").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v")
    tied = materialise(tied, "tied")
    low = tied.groupBy("u").agg(F.min("v").alias("m"))
    below = join_split(tied, low, "u", "v").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def component_roots(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links(u, v)``; the root is the component's smallest node.

    Rounds of star contraction, each written to the shared folder, until nothing changes; chains
    fold in a logarithmic number of rounds. Only a count and a checksum reach the driver. Roots
    themselves are not listed.
    """
    current = materialise(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(current)
    for _ in range(max_rounds):
        if not state[0]:
            break
        current = materialise(_star(current), "links")
        now = _state(current)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
