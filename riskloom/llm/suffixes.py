"""Removal of every byte that lies in a 100-byte string which also starts earlier in the corpus.

The strings of ``LENGTH`` bytes are ordered like the suffixes of a suffix array, bucket by bucket,
so that no task holds more than one bucket. Buckets and ranks come from a cover sample: positions
such that every string contains one, at a place that its own bytes decide (the leftmost of its
24-byte grams whose hash is smallest). Two equal strings therefore meet in the bucket of their
cover gram, at the same distance from it, and ties are decided by ranks that were computed once:
a string that begins ``t`` bytes before its cover position is its ``t`` bytes on the left, then the
suffix at the cover position, whose rank among the bucket's is known. (An arithmetic difference
cover gives the same guarantee with one position in eight; this one takes one in about forty.)

The steps, each a shuffle of packed arrays:

1. Documents are dealt into ranges of ids of a few megabytes. A range lists its blocks, the runs
   of strings with the same cover position, by the cover gram's hash and the hash of the block's
   bytes.
2. Per bucket of grams: a block that also lies in an earlier range is a copy as a whole. A gram
   with two different blocks or more is contested; the earliest range of each block is told so.
3. A contested block is sent, with the bytes around its cover position, to its gram's bucket, where
   left and right sides are sorted, ranked, and the first of equal strings is kept. Grams with more
   than ``HOT`` different blocks send the hashes of their single strings instead, dealt by those, so
   that a gram of a third of all documents does not meet in one task.
4. Each range applies what was found to its documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.session import ship
from riskloom.llm.ranges import MAX_RANGES, range_cuts, range_of

LENGTH = 100
GRAM = 24
# Bytes of text in a range, and blocks of one gram above which its strings are dealt singly.
RANGE_BYTES = 4 << 20
HOT = 1500
# Strings handled at a time within a range, and contested blocks within a bucket.
PIECE = 1 << 17
BLOCK_ROWS = 4000

_U = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_SECOND = 0xD6E8FEB86659FD93
_PACKED = T.StructType().add("_b", "integer").add("_p", "integer").add("_kind", "integer").add("_data", "binary")
_SPANS = T.ArrayType(T.StructType().add("start", "integer").add("end", "integer"))

COVER, BLOCKS, STRINGS = 0, 1, 2  # kinds of packed rows behind step 2
COPY, CONTESTED, CROWDED = 0, 1, 2  # kinds of blocks in step 2


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
_BYTE2 = _mix(np.arange(1, 257, dtype=np.uint64) * _U(_SECOND))
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, made once per process."""
    global _powers
    if _powers is None:
        n = PIECE + 2 * LENGTH
        up = np.full(n, _BASE, np.uint64)
        down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up), np.cumprod(down)
    return _powers


def _blocks(text: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, ...]:
    """Blocks of a text: first and last start, cover position, gram hash, block hash.

    ``valid`` says of every start whether the string that begins there lies within one document.
    Pieces may cut a block in two, which costs a comparison and changes no result.
    """
    up, down = _power_tables()
    span = LENGTH - GRAM + 1
    parts = []
    for at in range(0, len(valid), PIECE):
        ok = valid[at : at + PIECE]
        starts = np.flatnonzero(ok)
        if not len(starts):
            continue
        data = text[at : at + len(ok) + LENGTH - 1]
        m = len(data)
        sums = np.zeros(m + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:m], out=sums[1:])
        grams = _mix((sums[GRAM:] - sums[:-GRAM]) * down[: m - GRAM + 1])
        # Hash above position: the minimum of a stretch is its smallest hash, leftmost on ties.
        low = (grams & _U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
        cover = (low[starts] & _U(0xFFFFFFFF)).astype(np.int64)
        new = np.concatenate([[True], (np.diff(starts) != 1) | (np.diff(cover) != 0)])
        first = np.flatnonzero(new)
        s, e, a = starts[first], starts[np.concatenate([first[1:], [len(starts)]]) - 1], cover[first]
        body = (sums[e + LENGTH] - sums[s]) * down[s]
        body = _mix(body + (a - s).astype(np.uint64) * _U(_SECOND) + (e - s).astype(np.uint64) * _U(0xA0761D6478BD642F))
        parts.append((s + at, e + at, a + at, grams[a], body))
    if not parts:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*parts))


class _Range:
    """The documents of a range in corpus order, laid end to end."""

    def __init__(self, docs: pa.Table) -> None:
        pa.default_memory_pool().release_unused()  # what the group before has left
        order = pc.sort_indices(docs, sort_keys=[("_id", "ascending"), ("_text", "ascending")], null_placement="at_start")
        self.docs = docs.take(order)
        texts = self.docs.column("_text").to_pylist()
        self.size = np.array([len(t) for t in texts], np.int64)
        self.end = np.cumsum(self.size)
        self.begin = self.end - self.size
        self.text = np.frombuffer(b"".join(texts), np.uint8)

    def blocks(self) -> tuple[np.ndarray, ...]:
        n = max(0, len(self.text) - LENGTH + 1)
        valid = np.zeros(n + 1, np.int8)
        for b, size in zip(self.begin, self.size):
            if size >= LENGTH:
                valid[b] += 1
                valid[b + size - LENGTH + 1] -= 1
        return _blocks(self.text, np.cumsum(valid[:n], dtype=np.int8).astype(bool))

    def covered(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places in the laid-out text as (document, from, to)."""
        doc = np.searchsorted(self.end, start, side="right")
        return np.stack([doc, start - self.begin[doc], end - self.begin[doc]], axis=1).astype("<u4")


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Even buckets; cover grams have the smallest hashes around, so they are mixed once more."""
    return (((_mix(hashes * _U(_SECOND)) >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


def _packed(bucket: np.ndarray, p: np.ndarray | int, kind: int, rows: np.ndarray) -> pa.Table:
    """One packed row for each bucket and range, from rows of a two-dimensional array."""
    p = np.broadcast_to(p, bucket.shape)
    order = np.lexsort((p, bucket))
    bucket, p, rows = bucket[order], p[order], np.ascontiguousarray(rows[order])
    cut = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(p) != 0)) + 1
    at = np.concatenate([[0], cut]) if len(bucket) else np.empty(0, np.int64)
    data = [x.tobytes() for x in np.split(rows, cut)] if len(bucket) else []
    columns = [bucket[at], p[at], np.full(len(at), kind)]
    return pa.table([*[pa.array(c, pa.int32()) for c in columns], pa.array(data, pa.binary())], names=_PACKED.names)


def _unpacked(rows: pa.Table, kind: int, dtype, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a kind and the range each came from."""
    picked = rows.filter(pc.equal(rows.column("_kind"), kind))
    parts = [np.frombuffer(d.as_buffer(), dtype).reshape(-1, width) for d in picked.column("_data")]
    if not parts:
        return np.empty((0, width), dtype), np.empty(0, np.int64)
    p = picked.column("_p").to_numpy()
    return np.concatenate(parts), np.repeat(p, [len(x) for x in parts]).astype(np.int64)


def _same(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorted order by the columns (first one first) and where a new value begins in it."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    return order, new


def _among(pairs: np.ndarray, given: np.ndarray) -> np.ndarray:
    """Which rows of ``pairs`` are rows of ``given``."""
    both = np.concatenate([pairs, given])
    order, new = _same(both[:, 0], both[:, 1])
    group = np.empty(len(both), np.int64)
    group[order] = np.cumsum(new) - 1
    held = np.zeros(len(both) + 1, bool)
    held[group[len(pairs) :]] = True
    return held[group[: len(pairs)]]


def _list_blocks(buckets: int):
    """Step 1: the distinct blocks of a range, by bucket of their gram."""

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        _, _, _, gram, body = _Range(docs).blocks()
        order, new = _same(gram, body)
        gram, body = gram[order][new], body[order][new]
        return _packed(_bucket(gram, buckets), key[0].as_py(), 0, np.stack([gram, body], axis=1))

    return run


def _judge_blocks(hot: int):
    """Step 2: copies of blocks in earlier ranges, and the earliest blocks of contested grams."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        pairs, p = _unpacked(rows, 0, "<u8", 2)
        order = np.lexsort((p, pairs[:, 1], pairs[:, 0]))
        pairs, p = pairs[order], p[order]
        new_gram = np.concatenate([[True], pairs[1:, 0] != pairs[:-1, 0]])
        new = new_gram | np.concatenate([[True], pairs[1:, 1] != pairs[:-1, 1]])
        gram = np.cumsum(new_gram) - 1
        variants = np.bincount(gram[new], minlength=gram[-1] + 1)[gram]
        out = []
        for kind, mask in ((COPY, ~new), (CONTESTED, new & (variants > 1) & (variants <= hot)), (CROWDED, new & (variants > hot))):
            out.append(_packed(np.full(mask.sum(), key[0].as_py()), p[mask], kind, pairs[mask]))
        return pa.concat_tables(out)

    return run


# A contested block: gram, document, cover position in it, least and greatest distance of a start
# from the cover position, then the bytes to the left (nearest first) and to the right.
_LEFT = LENGTH - GRAM
_BLOCK_BYTES = 8 + 4 + 4 + 1 + 1 + _LEFT + LENGTH


def _send_blocks(buckets: int):
    """Step 3, first half: what a range removes by itself, and its contested blocks and strings."""

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, told: pa.Table) -> pa.Table:
        p = key[0].as_py()
        if not docs.num_rows:
            return _packed(np.empty(0, np.int64), p, COVER, np.empty((0, 3), "<u4"))
        here = _Range(docs)
        s, e, a, gram, body = here.blocks()
        pairs = np.stack([gram, body], axis=1)
        order, new = _same(gram, body)  # stable, so the first of a group is the first in the text
        again = np.empty(len(order), bool)
        again[order] = ~new
        gone = again | _among(pairs, _unpacked(told, COPY, "<u8", 2)[0])
        covers = [here.covered(s[gone], e[gone] + LENGTH)]
        out = []

        some = ~gone & _among(pairs, _unpacked(told, CONTESTED, "<u8", 2)[0])
        if some.any():
            out.append(_packed(_bucket(gram[some], buckets), p, BLOCKS, _around(here, s[some], e[some], a[some], gram[some])))
        some = ~gone & _among(pairs, _unpacked(told, CROWDED, "<u8", 2)[0])
        if some.any():
            size = e[some] - s[some] + 1
            start = np.repeat(s[some] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            start.sort()
            one, two = _string_hashes(here.text, start)
            order, new = _same(one, two)
            late = start[order[~new]]
            covers.append(here.covered(late, late + LENGTH))
            order = order[new]
            rows = np.zeros((len(order), 6), "<u4")
            rows[:, :2] = one[order].astype("<u8")[:, None].view("<u4")
            rows[:, 2:4] = two[order].astype("<u8")[:, None].view("<u4")
            rows[:, 4:] = here.covered(start[order], start[order] + LENGTH)[:, :2]
            out.append(_packed(_bucket(one[order], buckets), p, STRINGS, rows))
        cover = np.concatenate(covers)
        out.append(_packed(np.full(len(cover), p % buckets), p, COVER, cover))
        return pa.concat_tables(out)

    return run


def _around(here: _Range, s: np.ndarray, e: np.ndarray, a: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Contested blocks as rows of bytes; bytes outside of a block are zero."""
    n = len(s)
    rows = np.zeros((n, _BLOCK_BYTES), np.uint8)
    rows[:, :8] = gram.astype("<u8")[:, None].view(np.uint8)
    rows[:, 8:16] = here.covered(a, a)[:, :2].copy().view(np.uint8)
    rows[:, 16] = a - e
    rows[:, 17] = a - s
    padded = np.concatenate([here.text, np.zeros(LENGTH, np.uint8)])
    for i in range(_LEFT):
        rows[:, 18 + i] = np.where(a - s > i, padded[np.maximum(a - 1 - i, 0)], 0)
    for i in range(LENGTH):
        rows[:, 18 + _LEFT + i] = np.where(e + LENGTH > a + i, padded[a + i], 0)
    return rows


def _string_hashes(text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the strings that begin at ``start``, with different bases and byte values."""
    one, two = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
    for i in range(LENGTH):
        data = text[start + i]
        one = one * _U(_BASE) + _BYTE[data]
        two = two * _U(_SECOND) + _BYTE2[data]
    return _mix(one), _mix(two)


def _classes(gram: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the sides within their grams, and common prefixes with the one before."""
    width = -(-side.shape[1] // 8) * 8
    padded = np.zeros((len(side), width), np.uint8)
    padded[:, : side.shape[1]] = side
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort([*words.T[::-1], gram])
    common = np.full(len(side), -1)
    if len(side) > 1:
        equal = side[order][1:] == side[order][:-1]
        length = np.where(equal.all(axis=1), side.shape[1], equal.argmin(axis=1))
        common[1:] = np.where(gram[order][1:] == gram[order][:-1], length, -1)
    return order, common


def _settle():
    """Step 3, second half: for each bucket, all strings but the first of equal ones are covered."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        pa.default_memory_pool().release_unused()
        out = [rows.filter(pc.equal(rows.column("_kind"), COVER)).select(_PACKED.names)]
        data, p = _unpacked(rows, BLOCKS, np.uint8, _BLOCK_BYTES)
        if len(data):
            cover, owner = _settle_blocks(data, p)
            out.append(_packed(np.full(len(cover), bucket), owner, COVER, cover))
        data, p = _unpacked(rows, STRINGS, "<u4", 6)
        if len(data):
            one = data[:, 0].astype(np.uint64) | (data[:, 1].astype(np.uint64) << _U(32))
            two = data[:, 2].astype(np.uint64) | (data[:, 3].astype(np.uint64) << _U(32))
            order = np.lexsort((data[:, 5], data[:, 4], p, two, one))
            later = np.concatenate([[False], (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])])
            late = order[later]
            cover = np.stack([data[late, 4], data[late, 5], data[late, 5] + LENGTH], axis=1).astype("<u4")
            out.append(_packed(np.full(len(cover), bucket), p[late], COVER, cover))
        return pa.concat_tables([t.cast(out[0].schema) for t in out])

    return run


def _settle_blocks(data: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole grams at a time, so that only some thousand blocks are laid out for sorting."""
    gram = np.ascontiguousarray(data[:, :8]).view("<u8")[:, 0]
    order = np.argsort(gram, kind="stable")
    cuts = np.flatnonzero(np.diff(gram[order])) + 1
    covers, owners, at = [], [], 0
    while at < len(order):
        after = np.searchsorted(cuts, at + BLOCK_ROWS)
        end = int(cuts[after]) if after < len(cuts) else len(order)
        some = order[at:end]
        cover, owner = _settle_grams(data[some], p[some])
        covers.append(cover), owners.append(owner)
        at = end
    return np.concatenate(covers), np.concatenate(owners)


def _settle_grams(data: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.ascontiguousarray(data[:, 8:16]).view("<u4").astype(np.int64)
    order = np.lexsort((place[:, 1], place[:, 0], p))  # corpus order
    data, p, place = data[order], p[order], place[order]
    gram = np.ascontiguousarray(data[:, :8]).view("<u8")[:, 0]
    least, most = data[:, 16].astype(np.int64), data[:, 17].astype(np.int64)
    n = len(data)
    left, left_common = _classes(gram, data[:, 18 : 18 + _LEFT])
    right, right_common = _classes(gram, data[:, 18 + _LEFT :])
    late = np.zeros((n, _LEFT + 2), np.int8)
    code_left, code_right = np.empty(n, np.int64), np.empty(n, np.int64)
    for t in range(_LEFT + 1):
        own = np.flatnonzero((least <= t) & (most >= t))
        if len(own) < 2:
            continue
        # Equal to the left up to t bytes, and to the right up to the string's end.
        code_left[left] = np.cumsum(left_common < t)
        code_right[right] = np.cumsum(right_common < LENGTH - t)
        _, first = np.unique((code_left * (n + 1) + code_right)[own], return_index=True)
        late[own, t] = 1
        late[own[first], t] = 0
    # Runs of distances become covered bytes.
    edge = np.diff(late, axis=1, prepend=np.int8(0))
    row, low = np.nonzero(edge == 1)
    high = np.nonzero(edge == -1)[1] - 1
    at = place[row, 1]
    return np.stack([place[row, 0], at - high, at - low + LENGTH], axis=1).astype("<u4"), p[row]


def _apply(schema: pa.Schema):
    """Step 4: what is left of each document of a range."""

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, rows: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        here = _Range(docs)
        cover, _ = _unpacked(rows, COVER, "<u4", 3)
        cover = cover[np.argsort(cover[:, 0], kind="stable")].astype(np.int64)
        at = np.searchsorted(cover[:, 0], np.arange(len(here.size) + 1))
        removed, spans, kept = [], [], []
        for d, (begin, end) in enumerate(zip(here.begin, here.end)):
            text = here.text[begin:end]
            own = cover[at[d] : at[d + 1]]
            if not len(own):
                removed.append(0), spans.append([]), kept.append(text.tobytes())
                continue
            depth = np.zeros(len(text) + 1, np.int64)
            np.add.at(depth, own[:, 1], 1)
            np.add.at(depth, own[:, 2], -1)
            gone = np.cumsum(depth[:-1]) > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            spans.append([{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()])
            removed.append(int(gone.sum()))
            kept.append(text[~gone].tobytes())
        added = [here.size, removed, spans, kept]
        columns = [here.docs.column("_rest"), *added]
        return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _ranges(df: DataFrame, key: str, text: str, range_bytes: int) -> tuple[Column, int]:
    """Each row's range, in ascending order of ids, and how many ranges there are."""
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(least, -(-total // range_bytes))
    cuts = range_cuts(df, key, min(wanted, MAX_RANGES))
    own = range_of(F.col(key), cuts)
    finer = -(-wanted // MAX_RANGES)
    if finer > 1 and isinstance(cuts[0], int):
        # Beyond the number of cuts, ranges are divided evenly by id, which keeps their order.
        top = F.get(F.array(*map(F.lit, cuts)), own).cast("double")
        below = F.get(F.array(*map(F.lit, cuts)), own - 1).cast("double")
        part = F.floor((F.col(key) - below) / (top - below) * finer)
        return (own * finer + F.coalesce(F.greatest(F.lit(0), F.least(part, F.lit(finer - 1))), F.lit(0))).cast("int"), len(cuts) * finer
    return own.cast("int"), max(1, len(cuts))


def remove_repeats(df: DataFrame, id_column: str = "doc_id", text: str = "text", range_bytes: int = RANGE_BYTES, hot: int = HOT) -> DataFrame:
    """Remove every byte covered by a 100-byte string that also starts earlier.

    Earlier means in a row of smaller id, or before it in the same row. All rows count, the input as
    it is, and nothing crosses from one row to another. Returns the columns of ``df``, the text without
    the removed bytes (and without characters that a cut broke), and
    ``n_bytes``, ``n_removed``, ``removed_spans`` (byte offsets, end exclusive, not touching) and
    ``kept`` (binary, the remaining bytes); columns of ``df`` with these names are replaced. A null
    text counts as empty. Null ids come before all others; rows of equal id are ordered by text, so
    of rows that are equal altogether one keeps its bytes.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    added = T.StructType().add("n_bytes", "long").add("n_removed", "long").add("removed_spans", _SPANS).add("kept", "binary")
    names = [c for c in df.columns if c not in added.names]
    given = df.select(
        df[id_column].alias("_id"),
        F.coalesce(df[text].cast("string"), F.lit("")).cast("binary").alias("_text"),
        F.struct(*[df[c] for c in names if c != text] or [F.lit(0).alias("_none")]).alias("_rest"),
    )
    p, ranges = _ranges(given, "_id", "_text", range_bytes)
    # The one shuffle of texts; the three steps that read them share its files.
    docs = given.withColumn("_p", p)
    listed = docs.groupBy("_p").applyInArrow(_list_blocks(ranges), _PACKED)
    judged = listed.groupBy("_b").applyInArrow(_judge_blocks(hot), _PACKED)
    sent = docs.groupBy("_p").cogroup(judged.groupBy("_p")).applyInArrow(_send_blocks(ranges), _PACKED)
    settled = sent.groupBy("_b").applyInArrow(_settle(), _PACKED)
    out = T.StructType([T.StructField("_rest", given.schema["_rest"].dataType), *added.fields])
    done = docs.groupBy("_p").cogroup(settled.groupBy("_p")).applyInArrow(_apply(to_arrow_schema(out)), out)
    kept_names = [c for c in names if c != text]
    # A cut inside of a character leaves a broken one behind, which the text column leaves out.
    whole = F.col("kept").cast("string")
    whole = F.when(F.is_valid_utf8(whole), whole).otherwise(F.replace(F.make_valid_utf8(whole), F.lit("\ufffd"), F.lit(""))).alias(text)
    rest = {c: F.col("_rest").getField(c).alias(c) for c in kept_names}
    return done.select(*[whole if c == text else rest[c] for c in names], *added.names)
