"""Merkle manifest of a data set: a tree of digests per group, and one over the groups.

Leaves are numbered within their group and dealt into aligned blocks of ``fanout ** levels``. A block
builds its own subtree. Above that no tree is walked downwards: in round ``r`` every block hands the
node it stands under to one block in each sibling subtree (the one at its own place there), so all
blocks of ``fanout`` sibling subtrees hash their common parent redundantly, and the siblings received
are the block's own proof of that level. After the last round each block knows the root and its whole
upper proof. Where the last sibling subtree is smaller, its blocks serve several places each.

Leaf numbers come from one range shuffle of digests: rows of equal ranges are counted per range, and
the ranges' counts are summed up, so no group has to be sorted in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from riskloom.functions.expr import col
from riskloom.functions.session import local_table, materialise, ship, small_table

FANOUT = 16
LEVELS = 2  # levels inside a block: 256 leaves

_PROOF = "array<struct<digit: int, siblings: string>>"
ADDED = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "position", "height"]


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 of the fields, each ``-`` if null, else its UTF-8 bytes' number, ``:`` and itself."""
    parts = []
    for f in fields:
        s = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _numbered(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """``(gid, size, idx)`` beside each row ``(g, o, leaf, ...)``; the number of groups and the largest group."""
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("g").asc_nulls_first(), F.col("o").asc_nulls_first(), F.col("leaf"), F.col("tie")]
    placed = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    number = F.monotonically_increasing_id()
    placed = placed.withColumn("at", number).drop("tie")
    part = F.shiftrightunsigned("at", 33).cast("int")
    placed = materialise(placed.select("*", part.alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("pos")).drop("at"), "leaves")
    # One row for each group in each range: ranges and groups together bound their number.
    pieces = placed.groupBy("part", "g").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    of_group = Window.partitionBy("g")
    pieces = materialise(
        pieces.select(
            "part", "g", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(of_group).alias("size"), F.min("part").over(of_group).alias("home")
        ),
        "pieces",
    )
    begun = pieces.where("part = home")
    started = {r["part"]: r["n"] for r in begun.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row a range
    total, passed = 0, []
    for p in sorted(started):
        passed.append((p, total))
        total += started[p]
    inside = F.row_number().over(Window.partitionBy("part").orderBy("first")) - 1
    groups = begun.withColumn("nth", inside).join(local_table(spark, passed, "part int, passed long"), "part")
    groups = groups.select(F.col("g").alias("g_"), (F.col("passed") + F.col("nth")).alias("gid"))
    known = pieces.join(groups, F.col("g").eqNullSafe(F.col("g_")))
    known = small_table(known.select(F.col("part").alias("part_"), "g_", "first", "offset", "size", "gid"))
    largest = pieces.agg(F.max("size").alias("n")).first()["n"] or 0
    joined = placed.join(known, (F.col("part") == F.col("part_")) & F.col("g").eqNullSafe(F.col("g_")))
    out = joined.select(*rows.columns, "gid", "size", (F.col("pos") - F.col("first") + F.col("offset")).alias("idx"))
    return out, total, largest


def _climb(nodes: DataFrame, fanout: int, largest: int) -> DataFrame:
    """``(tree, p, n, digest, proof)``: from the ``n`` nodes of each tree to its root, round by round.

    ``nodes`` is ``(tree, p, n, digest)`` with ``p`` from 0 to ``n - 1``; ``largest`` bounds ``n``.
    """
    state = nodes.select("tree", "p", "n", "digest", F.expr(f"cast(array() AS {_PROOF})").alias("proof"))
    span = 1
    while span < largest:
        q = F.expr(f"p div {span}")
        top = F.expr(f"(n - 1) div {span}")
        state = state.withColumns({"q": q, "low": F.col("p") % span, "top": top})
        state = state.withColumns({"digit": (F.col("q") % fanout).cast("int"), "hi": F.expr(f"q div {fanout}")})
        held = F.least(F.lit(span), F.col("n") - F.col("q") * span)
        alone = (F.col("q") == F.col("top")) & (F.col("digit") == 0)
        places = F.when(alone, F.array("low")).otherwise(F.sequence(F.col("low"), F.lit(span - 1).cast("long"), held))
        sent = state.where("top > 0").withColumn("place", F.explode(places))
        own = F.when(F.col("place") == F.col("low"), F.struct("p", "n", "proof"))
        met = sent.groupBy("tree", "hi", "place").agg(F.array_sort(F.collect_list(F.struct("digit", "digest", own.alias("own")))).alias("m"))
        met = met.select("tree", "m", F.explode(F.filter("m", lambda x: x["own"].isNotNull())).alias("x"))
        joined = lambda a: F.array_join(F.transform(a, lambda y: y["digest"]), "")
        others = F.filter("m", lambda y: y["digit"] != F.col("x.digit"))
        risen = met.select(
            "tree",
            F.col("x.own.p").alias("p"),
            F.col("x.own.n").alias("n"),
            F.sha2(joined(F.col("m")).cast("binary"), 256).alias("digest"),
            F.concat(F.col("x.own.proof"), F.array(F.struct(F.col("x.digit").alias("digit"), joined(others).alias("siblings")))).cast(_PROOF).alias("proof"),
        )
        state = state.where("top = 0").select("tree", "p", "n", "digest", "proof").unionByName(risen)
        span *= fanout
    return state


def _levels(leaves: list[str], fanout: int, levels: int, alone: bool) -> list[list[str]]:
    """Nodes of a block, level by level; a block that is its whole group stops at one node."""
    out = [leaves]
    while len(out) <= levels and not (alone and len(out[-1]) == 1):
        last = out[-1]
        out.append([_hash("".join(last[i : i + fanout])) for i in range(0, len(last), fanout)])
    return out


def _block_root(fanout: int, levels: int, schema: pa.Schema):
    def root(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        blocks = table["blocks"][0].as_py()
        nodes = _levels(table["leaf"].to_pylist(), fanout, levels, blocks == 1)[-1]
        row = {"tree": table["gid"][0].as_py(), "p": table["block"][0].as_py(), "n": blocks, "digest": nodes[0]}
        return pa.Table.from_pylist([row], schema=schema)

    return root


def _prover(fanout: int, levels: int, schema: pa.Schema):
    """Per leaf of a block: its proof, and the root that its claimed digest folds to."""

    def prove(ours: pa.Table, upper: pa.Table) -> pa.Table:
        if not ours.num_rows:
            return schema.empty_table()
        ours = ours.sort_by("idx")
        known = upper.to_pylist()[0]
        nodes = _levels(ours["leaf"].to_pylist(), fanout, levels, known["n"] == 1)
        steps = [(s["digit"] * 64, s["siblings"]) for s in [*known["proof"], *known["top_proof"]]]
        above = "".join(s for _, s in steps)
        proofs, folded = [], []
        for i, claimed in enumerate(ours["claimed"].to_pylist()):
            own, digest, at = [], claimed, i
            for level in nodes[:-1]:
                begin = at - at % fanout
                left, right = "".join(level[begin:at]), "".join(level[at + 1 : begin + fanout])
                own.append(left + right)
                digest = _hash(left + digest + right)
                at //= fanout
            for cut, siblings in steps:
                digest = _hash(siblings[:cut] + digest + siblings[cut:])
            proofs.append(_hash("".join(own) + above))
            folded.append(digest)
        n = ours.num_rows
        columns = {
            "row": ours["row"], "leaf": ours["leaf"], "subroot": pa.array([known["digest"]] * n), "root": pa.array([known["root"]] * n),
            "proof_sha256": pa.array(proofs), "folded_root": pa.array(folded), "verified": pa.array([f == known["root"] for f in folded]),
            "position": ours["idx"], "height": pa.array([len(nodes) - 1 + len(steps)] * n, pa.int32()),
        }
        return pa.table([columns[f.name].cast(f.type) for f in schema], schema=schema)

    return prove


def merkle_manifest(df: DataFrame, group: str, order: str, leaf: Column, claimed: Column | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Roots, proofs and their check for every row of ``df``.

    Per value of ``group`` the rows ascend by ``order`` (null first, then by digest) as leaves; while
    several nodes are left, every ``fanout`` consecutive ones (the last run fewer, even one) become the
    SHA-256 of their hex digests. The groups' roots, null first and bytewise, are joined likewise.

    Adds ``leaf``; ``subroot`` and ``root``; ``proof_sha256``, the digest of all siblings from the leaf
    upwards, each run left to right; ``folded_root``, the root that ``claimed`` (a digest; ``leaf`` where
    it is null) gives with these siblings; ``verified``, whether that is ``root``; ``position`` in the
    group and ``height`` (levels up to the root). Columns of ``df`` with these names are replaced.

    Null groups and orders are values of their own. Equal rows are leaves of their own; they have equal
    digests, so their order changes nothing. An empty table gives no rows; a single row is its own root.

    What is shuffled are digests: once by range, twice by block, and one row per block and round.
    """
    spark = df.sparkSession
    ship(spark)
    keep = df.drop(*ADDED).columns
    row = F.struct(*[col(c) for c in keep])
    given = df.select(row.alias("row"), col(group).alias("g"), col(order).alias("o"), leaf.alias("leaf"), F.coalesce(claimed, leaf).alias("claimed") if claimed is not None else leaf.alias("claimed"))
    size = fanout**levels
    numbered, n_groups, largest = _numbered(given)
    numbered = numbered.select(
        "row", "gid", "idx", "leaf", "claimed", F.expr(f"idx div {size}").alias("block"), F.expr(f"(size - 1) div {size} + 1").alias("blocks")
    )
    node = T.StructType().add("tree", "long").add("p", "long").add("n", "long").add("digest", "string")
    roots = numbered.select("gid", "block", "blocks", "idx", "leaf").groupBy("gid", "block").applyInArrow(_block_root(fanout, levels, to_arrow_schema(node)), node)
    risen = materialise(_climb(materialise(roots, "blocks"), fanout, -(-largest // size)), "proofs")
    tops = risen.where("p = 0").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("p"), F.lit(n_groups).cast("long").alias("n"), "digest")
    tops = _climb(tops, fanout, n_groups).select(F.col("p").alias("tree"), F.col("digest").alias("root"), F.col("proof").alias("top_proof"))
    upper = risen.join(small_table(tops), "tree").select(F.col("tree").alias("gid"), F.col("p").alias("block"), "n", "digest", "proof", "root", "top_proof")
    out = T.StructType([numbered.schema["row"]])
    for name, kind in (("leaf", "string"), ("subroot", "string"), ("root", "string"), ("proof_sha256", "string"), ("folded_root", "string"), ("verified", "boolean"), ("position", "long"), ("height", "integer")):
        out = out.add(name, kind)
    proved = numbered.groupBy("gid", "block").cogroup(upper.groupBy("gid", "block")).applyInArrow(_prover(fanout, levels, to_arrow_schema(out)), out)
    return proved.select(*[F.col("row").getField(c).alias(c) for c in keep], *ADDED)
