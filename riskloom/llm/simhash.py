"""SimHash fingerprints and near-duplicate groups by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most two bits differ in at most one bit of the high or of
the low half. So each half gives 32 signatures, the half with one bit left out, and fingerprints
that differ in at most one bit of a half share a signature of it. An equality join on signatures
finds the candidates, and each is verified by counting bits.

Only distinct fingerprints take part, so copies cost nothing. A signature shared by more than
``GROUP`` fingerprints is not compared pair by pair: its members are cut further by the same method,
within the half that the signature leaves free (halves of 16 bits, then of 8). A signature of the
third level leaves 11 bits free, so its group cannot exceed 2,048 members: memory and work stay
bounded and no link is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.session import materialise, ship
from riskloom.llm.linking import component_roots, join_split

GROUP = 2048
SHINGLE = 3
SEED = 42
# A text is read in pieces of about this many bytes.
PIECE_BYTES = 1 << 20

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def shingles_of(text: str, size: int) -> Iterator[list[bytes]]:
    """Word shingles of a text, piece by piece; a text of fewer words is one shingle."""
    data = text.encode().lower()  # on bytes: A-Z only
    held: list[bytes] = []
    at, total = 0, 0
    while at < len(data):
        gap = _GAP.search(data, at + PIECE_BYTES)
        end = gap.end() if gap else len(data)
        new = data[at:end].split()  # white space of ASCII
        at = end
        total += len(new)
        words = held + new
        if len(words) >= size:
            yield [b" ".join(s) for s in zip(*(words[i:] for i in range(size)))]
        held = words[-(size - 1) :] if size > 1 else []
    if 0 < total < size:
        yield [b" ".join(held)]


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is set if more than half of the shingles' XXH64 values have it; no words give zero."""
    ones = np.zeros(64, np.int64)
    count = 0
    digest = xxhash.xxh64_digest
    for shingles in shingles_of(text or "", size):
        hashes = np.frombuffer(b"".join([digest(s, seed) for s in shingles]), np.uint8).reshape(-1, 8)
        count += len(hashes)
        for byte in range(8):
            ones[byte * 8 : byte * 8 + 8] += np.bincount(hashes[:, byte], minlength=256) @ _BITS
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big") if count else 0


def _fingerprints(size: int, seed: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), size, seed) for t in batch.column(batch.num_columns - 1)], np.uint64)
            keep = [c.cast(f.type) for c, f in zip(batch.columns[:-1], schema)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(prints.view(np.int64), pa.int64())], schema=schema)

    return run


def add_fingerprint(df: DataFrame, text: str = "text", column: str = "fp", size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``df`` without ``text`` and with its fingerprint as a signed 64-bit integer in ``column``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    names = [c for c in df.columns if c not in (text, column)]
    out = T.StructType([df.schema[c] for c in names]).add(column, "long")
    given = df.select(*[df[c] for c in names], df[text].cast("string").alias("_text"))
    return given.mapInArrow(_fingerprints(size, seed, to_arrow_schema(out)), out)


# Signatures of a level: (width of the free part, what is left of it after the level).
_LEVELS = {1: 64, 2: 32, 3: 16}


def _signatures(level: int) -> list[str]:
    """SQL for ``part`` (the free bits), ``s`` (which half and bit), ``sig`` and ``rest``.

    ``free`` holds the bits that no earlier level has fixed, right-aligned.
    """
    half = _LEVELS[level] // 2
    mask = (1 << half) - 1
    part = f"(CASE WHEN s < {half} THEN shiftrightunsigned(free, {half}) ELSE free END & {mask}L)"
    rest = f"(CASE WHEN s < {half} THEN free ELSE shiftrightunsigned(free, {half}) END & {mask}L)"
    sig = f"(shiftleft(cast(s AS bigint), 32) | ({part} & ~shiftleft(1L, s % {half})))"
    return [f"{sig} AS sig{level}", f"{rest} AS free"]


def _variants(members: DataFrame, level: int) -> DataFrame:
    """Members (``fp``, ``free`` and earlier signatures) with every signature of the level."""
    earlier = [f"sig{i}" for i in range(1, level)]
    exploded = members.select("fp", "free", *earlier, F.explode(F.sequence(F.lit(0), F.lit(_LEVELS[level] - 1))).alias("s"))
    return exploded.selectExpr("fp", *earlier, *_signatures(level))


def _labels(prints: np.ndarray, bits: int) -> np.ndarray:
    """For each fingerprint of a group the place of the first one that links reach from it."""
    close = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= bits
    n = len(prints)
    label = np.arange(n)
    while True:
        new = np.where(close, label[None, :], n).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(level: int, bits: int, group: int, schema: pa.Schema):
    """Links within each signature's group, for rows sorted by signature.

    A group larger than ``group`` is passed on, row by row, to be cut further.
    """
    last = level == max(_LEVELS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The open group: its rows so far, or only its key once it has grown too large.
        held: list[np.ndarray] = []
        key: tuple | None = None
        large = False

        def links(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            prints = np.unique(prints)
            if len(prints) < 2:
                return prints[:0], prints[:0]
            root = prints[_labels(prints, bits)]
            far = root != prints
            return prints[far], root[far]

        def emit(us: list[np.ndarray], vs: list[np.ndarray], passed: list[np.ndarray]) -> pa.RecordBatch:
            u = np.concatenate([np.empty(0, np.uint64), *us]).view(np.int64)
            v = np.concatenate([np.empty(0, np.uint64), *vs]).view(np.int64)
            rows = np.concatenate([np.empty((0, level + 2), np.int64), *passed])
            n, m = len(u), len(rows)
            columns = [
                np.concatenate([u, rows[:, 0]]),
                np.concatenate([v, np.zeros(m, np.int64)]),
                np.concatenate([np.zeros(n, bool), np.ones(m, bool)]),
                np.concatenate([np.zeros(n, np.int64), rows[:, 1]]),
                *[np.concatenate([np.zeros(n, np.int64), rows[:, 2 + i]]) for i in range(level)],
            ]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

        for batch in batches:
            # Columns: fp, free, then the signatures; sorted by the signatures.
            table = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            if not len(table):
                continue
            sig = table[:, 2:]
            cuts = np.flatnonzero((sig[1:] != sig[:-1]).any(axis=1)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(table)]])
            us, vs, passed = [], [], []
            first = 0
            if key == tuple(sig[0]):  # the open group goes on
                first = 1
                more = table[: ends[0]]
                if large:
                    passed.append(more)
                else:
                    held.append(more)
            if first < len(starts) and held:  # it has ended
                if not last and sum(map(len, held)) > group:
                    passed += held
                else:
                    u, v = links(np.concatenate(held)[:, 0].copy().view(np.uint64))
                    us.append(u), vs.append(v)
                held, large = [], False
            # Whole groups within this batch: those of one row have no link, those of two are done
            # together.
            size = ends - starts
            whole = np.arange(first, len(starts) - 1)
            two = whole[size[whole] == 2]
            a, b = (table[starts[two] + i, 0].copy().view(np.uint64) for i in (0, 1))
            near = (np.bitwise_count(a ^ b) <= bits) & (a != b)
            us.append(np.maximum(a, b)[near]), vs.append(np.minimum(a, b)[near])
            for g in whole[size[whole] > 2]:
                rows = table[starts[g] : ends[g]]
                if len(rows) > group and not last:
                    passed.append(rows)
                else:
                    u, v = links(rows[:, 0].copy().view(np.uint64))
                    us.append(u), vs.append(v)
            if first < len(starts):
                key, held, large = tuple(sig[-1]), [table[starts[-1] :]], False
            if not large and not last and sum(map(len, held)) > group:
                passed += held
                held, large = [], True
            yield emit(us, vs, passed)
        if held:
            u, v = links(np.concatenate(held)[:, 0].copy().view(np.uint64))
            yield emit([u], [v], [])

    return run


def _level(members: DataFrame, level: int, bits: int, group: int) -> tuple[DataFrame, DataFrame]:
    """Links of a level's groups, and the members of groups that are too large for it."""
    from pyspark.sql.pandas.types import to_arrow_schema

    sigs = [f"sig{i}" for i in range(1, level + 1)]
    dealt = _variants(members, level).select("fp", "free", *sigs).repartition(*sigs).sortWithinPartitions(*sigs)
    out = T.StructType().add("u", "long").add("v", "long").add("large", "boolean").add("free", "long")
    for s in sigs:
        out = out.add(s, "long")
    done = materialise(dealt.mapInArrow(_compare(level, bits, group, to_arrow_schema(out)), out), "simhash")
    return done.where("NOT large").select("u", "v"), done.where("large").select(F.col("u").alias("fp"), "free", *sigs)


def fingerprint_links(prints: DataFrame, column: str = "fp", group: int = GROUP) -> DataFrame:
    """``(u, v)``: links that join all fingerprints differing in at most two bits.

    Within a signature's group the links form a spanning forest of its close pairs, so connected
    components are exact while the number of links stays linear.
    """
    ship(prints.sparkSession)
    members = prints.select(F.col(column).alias("fp")).distinct().withColumn("free", F.col("fp"))
    links, members = _level(members, 1, 2, group)
    for level in (2, 3):
        if members.isEmpty():
            break
        more, members = _level(members, level, 2, group)
        links = links.unionByName(more)
    return links.distinct()


def keep_one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: exactly one row of each component stays.

    It is the row of smallest id (null ids come last), then of smallest text digest, then the
    smallest by its other columns. Ids need not be unique: a row is found by its id and its text's
    digest, which lie in one component only. Columns are returned as given.
    """
    marked = docs.select(docs[id_column].alias("_id"), text_digest(docs[text]).alias("_digest"), docs[text].alias("_t"))
    prints = materialise(add_fingerprint(marked, "_t"), "fingerprints")
    first = prints.groupBy("fp").agg(F.min(F.struct(F.col("_id").isNull().alias("nameless"), "_id", "_digest")).alias("row"))
    roots = component_roots(fingerprint_links(prints))
    rooted = first.join(roots, first["fp"] == roots["node"], "left").select(F.coalesce("root", "fp").alias("root"), "row")
    chosen = rooted.groupBy("root").agg(F.min("row").alias("row")).select("row._id", "row._digest")
    return rows_of(docs, prints, materialise(chosen, "staying"), id_column, text)


def text_digest(text: Column) -> Column:
    """SHA-256 of a text; a null one has an empty digest."""
    return F.coalesce(F.unhex(F.sha2(text.cast("string").cast("binary"), 256)), F.unhex(F.lit("")))


def rows_of(docs: DataFrame, marked: DataFrame, staying: DataFrame, id_column: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``staying(_id, _digest)`` names; of rows equal in both, one.

    ``marked`` holds ``_id`` and ``_digest`` of every row.
    """
    same = staying["_id"].eqNullSafe(F.col("_own_id")) & (staying["_digest"] == F.col("_own_digest"))
    repeated = marked.groupBy(F.col("_id").alias("_own_id"), F.col("_digest").alias("_own_digest")).count().where("count > 1")
    given = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs[id_column].alias("_own_id"), text_digest(docs[text]).alias("_own_digest"))
    if not repeated.join(staying, same, "left_semi").isEmpty():
        # Rows equal in id and text: one of them, reduced before anything is dealt out.
        others = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in (id_column, text)]
        order = F.to_json(F.struct(*others)) if others else F.lit("")
        given = given.groupBy("_own_id", "_own_digest").agg(F.min_by("_row", order).alias("_row"))
    return given.join(staying, same, "left_semi").select("_row.*")


def near_duplicate_groups(df: DataFrame, id_column: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """``(id, fp, root, component_id)`` for every row of ``df``.

    ``component_id`` is the smallest id that links reach, the row's own included; null ids count as
    no id, so a component of only such rows has none. ``root`` is the component's smallest fingerprint. Null, empty and blank texts have fingerprint
    zero and link like any other. Equal rows come back as often as they were given.
    """
    prints = materialise(add_fingerprint(df.select(df[id_column].alias("_id"), df[text].alias("_t")), "_t"), "fingerprints")
    first = prints.groupBy("fp").agg(F.min("_id").alias("first"))
    roots = component_roots(fingerprint_links(prints, group=group))
    rooted = first.join(roots, first["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return join_split(prints, classes, "fp", "_id").select(F.col("_id").alias(id_column), "fp", "root", "component_id")
