"""Near copies of whole texts: SimHash links and banded minima propose pairs, word shingles decide.

Fingerprints of texts with a Jaccard similarity of 0.8 differ in about ten of 64 bits. Segments that
guarantee such a distance would be ten bits wide and select nothing, so fingerprints link only what
differs in two bits (see ``simhash``). Beside them every text has ``BANDS`` signatures, each over
``ROWS`` minima of its shingles under random permutations: a pair of similarity 0.8 shares one with
probability 0.9996. A signature's members are paired with one of them, another one in every band, and
each pair is decided by its sets of shingles.

Texts with equal sets are one class, so copies cost nothing. Pairs are linear in the classes, a pair
whose sets differ too much in size is left out before any set is moved, and sets are built only for
classes that are in a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from riskloom.functions.session import materialise, ship
from riskloom.llm.linking import component_roots, join_split
from riskloom.llm.simhash import SEED, fingerprint, fingerprint_links, rows_of, shingles_of, text_digest

WORDS = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 5
# Shingles whose minima are taken at a time.
STEP = 4096

_DRAW = np.random.default_rng(SEED)
_TIMES = _DRAW.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _DRAW.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct XXH64 values of a text's word shingles; a text of fewer words is one shingle."""
    parts = [np.empty(0, np.uint64)]
    for shingles in shingles_of(text or "", words):
        parts.append(np.unique(np.frombuffer(b"".join([xxhash.xxh64_digest(s, SEED) for s in shingles]), ">u8").astype(np.uint64)))
    return np.unique(np.concatenate(parts))


def signatures(hashes: np.ndarray) -> list[int]:
    """The signature of each band, a signed 64-bit integer; none for an empty set."""
    if not len(hashes):
        return []
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), STEP):
        low = np.minimum(low, (hashes[at : at + STEP, None] * _TIMES + _PLUS).min(axis=0))
    found = [xxhash.xxh64_intdigest(low[b * ROWS : (b + 1) * ROWS].tobytes(), b) for b in range(BANDS)]
    return np.array(found, np.uint64).view(np.int64).tolist()


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether two sorted sets have a Jaccard similarity of ``least`` or more; two empty ones have."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - common
    return not union or common / union >= least


def _sketches(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, classes, sizes, bands = [], [], [], []
            for cell in batch.column(batch.num_columns - 1):
                text = cell.as_py()
                hashes = shingle_set(text)
                prints.append(fingerprint(text))
                classes.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                sizes.append(len(hashes))
                bands.append(signatures(hashes))
            made = [pa.array(np.array(prints, np.uint64).view(np.int64)), *map(pa.array, (classes, sizes, bands))]
            columns = [*batch.columns[:-1], *made]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingle_set(t.as_py()).tobytes() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["class", "set"])


def _decide(key: tuple, members: pa.Table, leader: pa.Table) -> pa.Table:
    """Which members of a leader's part are near copies of it."""
    if not leader.num_rows:
        return pa.table({"u": members["class"].slice(0, 0), "v": members["class"].slice(0, 0)})
    own = np.frombuffer(leader["set"][0].as_py(), np.uint64)
    near = [c for c, s in zip(members["class"], members["set"]) if similar(own, np.frombuffer(s.as_py(), np.uint64))]
    ids = [c.as_py() for c in near]
    return pa.table({"u": pa.array(ids, pa.binary()), "v": pa.array([key[0].as_py()] * len(ids), pa.binary())})


def _pairs(classes: DataFrame) -> DataFrame:
    """``(class, leader)``: pairs that share a signature, or fingerprints linked by at most two bits."""
    dealt = classes.select("class", "n", F.explode("bands").alias("sig"))
    chosen = dealt.groupBy("sig").agg(F.min(F.struct(F.xxhash64("class", "sig").alias("o"), "class", "n")).alias("l"), F.count("*").alias("c"))
    chosen = chosen.where("c > 1").select("sig", F.col("l.class").alias("leader"), F.col("l.n").alias("m"))
    shared = join_split(dealt, chosen, "sig", "class").select("class", "n", "leader", "m")

    first = classes.groupBy("fp").agg(F.min(F.struct("class", "n")).alias("l"), F.count("*").alias("c"))
    first = materialise(first.select("fp", F.col("l.class").alias("leader"), F.col("l.n").alias("m"), "c"), "first")
    equal = join_split(classes.select("fp", "class", "n"), first.where("c > 1").drop("c"), "fp", "class").select("class", "n", "leader", "m")
    links = fingerprint_links(first)
    ends = links.join(first.select(F.col("fp").alias("u"), F.col("leader").alias("class"), F.col("m").alias("n")), "u")
    close = ends.join(first.select(F.col("fp").alias("v"), "leader", "m"), "v").select("class", "n", "leader", "m")
    both = shared.unionByName(equal).unionByName(close).where("class <> leader")
    # A similarity cannot exceed the ratio of the sizes.
    return both.where(F.least("n", "m") / F.greatest("n", "m") >= SIMILARITY).select("class", "leader").distinct()


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(u, v)``: the pairs whose sets of shingles are similar; ``docs`` is ``(_id, _digest, _t)``."""
    involved = pairs.select("class").union(pairs.select("leader")).distinct().join(classes, "class").select("class", "row._id", "row._digest")
    involved = materialise(involved.select("class", F.col("_id").alias("_i"), F.col("_digest").alias("_d")), "involved")
    same = docs["_id"].eqNullSafe(involved["_i"]) & (docs["_digest"] == involved["_d"])
    texts = docs.join(involved, same).select("class", "_t")
    sets = texts.mapInArrow(_sets, "class binary, set binary").groupBy("class").agg(F.any_value("set").alias("set"))
    sets = materialise(sets, "sets")
    members = pairs.join(sets, "class").withColumn("part", F.pmod(F.xxhash64("class"), F.lit(64)).cast("int"))
    parts = pairs.select(F.col("leader").alias("leader"), F.pmod(F.xxhash64("class"), F.lit(64)).cast("int").alias("part")).distinct()
    own = sets.select(F.col("class").alias("leader"), F.col("set").alias("set"))
    leaders = parts.join(own, "leader").select(*[F.col(c).alias(c) for c in ("leader", "part", "set")])
    met = members.select("leader", "part", "class", "set").groupBy("leader", "part").cogroup(leaders.groupBy("leader", "part"))
    return met.applyInArrow(_decide, "u binary, v binary")


def keep_one_of_near_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: exactly one row of each group stays.

    Two rows are near copies if their sets of 5-word shingles (A-Z lower-cased) have a Jaccard
    similarity of 0.8 or more; groups are what links reach. Rows without words (null, empty or blank
    texts) are one group. The row of smallest id stays (null ids come last), then of smallest text
    digest, then the smallest by its other columns. Ids need not be unique. Columns are returned as
    given.
    """
    ship(docs.sparkSession)
    marked = docs.select(docs[id_column].alias("_id"), text_digest(docs[text]).alias("_digest"), docs[text].cast("string").alias("_t"))
    out = T.StructType([*marked.schema.fields[:2]]).add("fp", "long").add("class", "binary").add("n", "long").add("bands", T.ArrayType(T.LongType()))
    rows = materialise(marked.mapInArrow(_sketches(to_arrow_schema(out)), out), "sketches")
    # Id and digest decide all that follows them in the struct.
    least = F.min(F.struct(F.col("_id").isNull().alias("nameless"), "_id", "_digest", "fp", "n", "bands"))
    classes = materialise(rows.groupBy("class").agg(least.alias("row")).select("class", "row", "row.fp", "row.n", "row.bands"), "classes")
    pairs = materialise(_pairs(classes), "pairs")
    roots = component_roots(_verified(marked, classes, pairs))
    rooted = classes.select("class", "row").join(roots, F.col("class") == F.col("node"), "left")
    chosen = rooted.groupBy(F.coalesce("root", "class").alias("root")).agg(F.min("row").alias("row")).select("row._id", "row._digest")
    return rows_of(docs, rows, materialise(chosen, "staying"), id_column, text)
