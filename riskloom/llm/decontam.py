"""Benchmark decontamination: one automaton over all benchmark windows reads each text once.

Texts are normalised to words (A-Z in lower case; the ASCII characters that are neither letters nor
digits separate). A benchmark item gives every run of ``window`` consecutive words, or all its words
if it has fewer. The Aho-Corasick automaton works on word numbers instead of characters, so it has
one node per window word, and a text is scanned once whatever the number of windows. Hits are mapped
back to character offsets of the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.session import ship
from riskloom.llm.carry import free_name

WINDOW = 13
# Bytes of benchmark text in one automaton (about 130 MB of nodes in a worker). A larger benchmark
# is cut into blocks that are scanned one after the other.
BLOCK_BYTES = 1 << 20

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_PLACES = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_SPANS = T.ArrayType(T.StructType().add("start", "integer").add("end", "integer"))
_ADDED = (
    T.StructType()
    .add("n_words", "long")
    .add("n_hit", "long")
    .add("hit_spans", _SPANS)
    .add("item_ids", T.ArrayType(T.StringType()))
    .add("contaminated", "boolean")
)
_FOUND = (
    T.StructType().add("_key", "binary").add("_first", "integer").add("_last", "integer").add("_items", T.ArrayType(T.StringType()))
)


def words(text: str | None) -> list[bytes]:
    """Normalised words of a text, as UTF-8; a null text has none."""
    return text.encode().translate(_FOLD).split() if text else []


class Windows:
    """The automaton over the windows of some benchmark items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        self.number: dict[bytes, int] = {}
        self.owners: list[set[str | None]] = []
        self.lengths: list[int] = []
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        place: dict[tuple[int, ...], int] = {}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if ids else 0):
                key = tuple(ids[i : i + size])
                at = place.setdefault(key, len(self.owners))
                if at == len(self.owners):
                    self.owners.append(set())
                    self.lengths.append(size)
                    self.machine.add_word(key, at)
                self.owners[at].add(item)
        if place:
            self.machine.make_automaton()
        self.empty = not place

    def scan(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Runs of hit words (first and last place) and the items behind them."""
        if self.empty or not text_words:
            return [], set()
        get = self.number.get
        matches = list(self.machine.iter(tuple([get(w, 0) for w in text_words])))
        if not matches:
            return [], set()
        hit = bytearray(len(text_words))
        items: set[str | None] = set()
        for end, at in matches:
            size = self.lengths[at]
            hit[end - size + 1 : end + 1] = b"\1" * size
        for at in {at for _, at in matches}:
            items |= self.owners[at]
        return _runs(hit), items


def _runs(hit: bytearray) -> list[tuple[int, int]]:
    out, at = [], 0
    for value, group in groupby(hit):
        size = sum(1 for _ in group)
        if value:
            out.append((at, at + size - 1))
        at += size
    return out


_built: dict[str, Windows] = {}


def _block_name(items: list, window: int) -> str:
    """Tells automata apart by what they are built from; workers outlive the call that built one."""
    return hashlib.sha256(repr((window, items)).encode()).hexdigest()


def _machine(name: str, items: list, window: int) -> Windows:
    """The automaton of a block, built once per Python worker; only the latest is kept."""
    if name not in _built:
        _built.clear()
        _built[name] = Windows(items, window)
    return _built[name]


def _judged(texts: list, found: list, per: int, schema: pa.Schema, rest: list[pa.Array]) -> pa.RecordBatch:
    """Result columns from each text's runs of hit words and items."""
    n_words, n_hit, spans, items, bad = [], [], [], [], []
    for text, (count, runs, own) in zip(texts, found, strict=True):
        hits = sum(b - a + 1 for a, b in runs)
        if runs:
            places = [m.span() for m in _PLACES.finditer(text)]
            spans.append([{"start": places[a][0], "end": places[b][1]} for a, b in runs])
        else:
            spans.append([])
        n_words.append(count)
        n_hit.append(hits)
        items.append(sorted(i for i in own if i is not None))
        bad.append(hits > 0 and per * hits >= count)
    values = [n_words, n_hit, spans, items, bad]
    added = [pa.array(v, schema.field(f.name).type) for v, f in zip(values, _ADDED.fields, strict=True)]
    return pa.RecordBatch.from_arrays([*rest, *added], schema=schema)


def _scanner(name: str, items, window: int, per: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(name, items.value, window)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = []
            for text in texts:
                w = words(text)
                found.append((len(w), *machine.scan(w)))
            yield _judged(texts, found, per, schema, [c.cast(f.type) for c, f in zip(batch.columns, schema)])

    return run


def _finder(name: str, items, window: int, schema: pa.Schema):
    """Only the hits of one block, keyed by the text's digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(name, items.value, window)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                runs, own = machine.scan(words(text))
                known = sorted(i for i in own if i is not None)
                rows += [{"_key": key, "_first": a, "_last": b, "_items": known} for a, b in runs]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _merger(per: int, schema: pa.Schema):
    """Result columns from the hits that the blocks found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns
            texts = batch.column(n - 3).to_pylist()
            found = []
            for text, runs, items in zip(texts, batch.column(n - 2).to_pylist(), batch.column(n - 1).to_pylist(), strict=True):
                w = words(text)
                hit = bytearray(len(w))
                for r in runs or ():
                    hit[r["_first"] : r["_last"] + 1] = b"\1" * (r["_last"] - r["_first"] + 1)
                found.append((len(w), _runs(hit), set(items or ())))
            keep = batch.columns[: n - 2]
            yield _judged(texts, found, per, schema, [c.cast(f.type) for c, f in zip(keep, schema)])

    return run


def find_contamination(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    per: int = 20,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Mark the words of ``text`` that lie in a window of ``benchmark``.

    Adds ``n_words``, ``n_hit``, ``hit_spans`` (character offsets in the original, end exclusive),
    ``item_ids`` (as strings, sorted) and ``contaminated`` (``n_hit > 0`` and ``per * n_hit >=
    n_words``). Columns of ``df`` with these names are replaced. A null or empty text has no words
    and no hits; an item without words matches nothing; an item without id marks words but is not
    listed. Every row of ``df`` is kept once, equal rows alike.

    The benchmark is read to the driver in blocks of about ``block_bytes``. With one block nothing
    is shuffled. More blocks are scanned one after the other; their hits meet by the text's digest.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    ship(spark)
    asked = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).cast("string").alias("t"))
    size = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    keep = df.drop(*_ADDED.names)
    name = free_name(df, "_text")
    given = keep.select(*[keep[c] for c in keep.columns], df[text].cast("string").alias(name))
    out = T.StructType(given.schema.fields + _ADDED.fields)
    arrow = to_arrow_schema(out)

    def block(b: int):
        part = asked.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        items = sorted(((r["i"], r["t"]) for r in part.collect()), key=str)
        return _block_name(items, window), spark.sparkContext.broadcast(items)

    if blocks == 1:
        return given.mapInArrow(_scanner(*block(0), window, per, arrow), out).drop(name)
    key, runs, items = (free_name(df, n) for n in ("_key", "_runs", "_items"))
    texts = given.select(F.unhex(F.sha2(name, 256)).alias("_key"), name)
    found = None
    for b in range(blocks):
        hits = texts.mapInArrow(_finder(*block(b), window, to_arrow_schema(_FOUND)), _FOUND)
        found = hits if found is None else found.unionByName(hits)
    # Copies of a text give the same rows, so the distinct ones describe the text.
    merged = found.distinct().groupBy(F.col("_key").alias(key)).agg(
        F.collect_list(F.struct("_first", "_last")).alias(runs),
        F.array_distinct(F.flatten(F.collect_list("_items"))).alias(items),
    )
    joined = given.withColumn(key, F.unhex(F.sha2(name, 256))).join(merged, key, "left").drop(key)
    return joined.mapInArrow(_merger(per, arrow), out).drop(name)

