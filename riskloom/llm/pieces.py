"""Piece encoding and decoding for merge-type SentencePiece vocabularies.

Encoding follows the published merge algorithm: a text is a row of symbols (characters at first), an
agenda holds every adjacent pair that is itself a piece, and the pair with the best score (leftmost
on ties) is merged until none is left. Symbols that are no piece become byte pieces.

Two facts keep this fast without changing a result. A boundary that no piece spans is never merged
over, so a text falls into independent chunks there (in front of a run of spaces that follows
something else, and around a character that occurs in no longer piece). And a chunk always gives
the same ids, so chunks are remembered, within a fixed bound, for as long as a Python worker lives.

Every chunk that is encoded for the first time is also given to the sentencepiece library, in one
call per Arrow batch, and ``library_agrees`` says whether all chunks of a text gave the same ids.
"""

from __future__ import annotations

import heapq
import re
import string
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.session import ship
from riskloom.llm.carry import free_name

SPACE = "▁"
# Chunks remembered per Python worker: two generations of this many (about 150 MB together), and
# the longest chunk worth remembering.
MEMO_CHUNKS = 300_000
MEMO_CHARS = 48
# Up to this many symbols a list is searched faster than a heap is kept.
SHORT = 24
NEVER = 1 << 62
# Output rows are handed on in batches of about this many bytes.
OUT_BYTES = 4 << 20


class PieceModel:
    """A merge-type vocabulary: encodes with an agenda of pairs, decodes through the library."""

    def __init__(self, path: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        self.ids: dict[str, int] = {}
        self.bytes_: list[int] = [lib.unk_id()] * 256
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes_[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.ids[piece] = i
        scores = sorted({lib.get_score(i) for i in self.ids.values()}, reverse=True)
        place = {x: r for r, x in enumerate(scores)}
        self.rank = {p: place[lib.get_score(i)] for p, i in self.ids.items()}
        self.byte_fallback = any(lib.is_byte(i) for i in range(lib.get_piece_size()))
        self.prefix = lib.normalize("a") == SPACE + "a"
        self.chunks = re.compile(self._cuts()).findall
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.fresh: list[tuple[str, bytes]] = []
        self.wrong: set[str] = set()

    def _cuts(self) -> str:
        """A pattern whose matches are the chunks: no piece of the vocabulary spans two of them."""
        joined = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in joined):
            return "(?s:.+)"
        alone = "" if any("\n" in p for p in joined) else "\n"
        # Punctuation, with whatever some piece ties to it, against all other characters.
        marks = set(string.punctuation)
        pairs = {q for p in joined for q in zip(p, p[1:]) if SPACE not in q}
        while tied := {c for q in pairs if marks & {*q} for c in q} - marks:
            marks |= tied
        if any(c.isalnum() and c.isascii() for c in marks):
            return f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|{alone}".rstrip("|")
        marks = re.escape("".join(sorted(marks)))
        return f"{SPACE}*(?:[^{SPACE}{alone}{marks}]+|[{marks}]+)|{SPACE}+|{alone}".rstrip("|")

    def merge(self, text: str) -> list[int]:
        """Ids of one chunk (spaces already replaced), by merging the best-scored adjacent pair.

        An agenda entry is one integer, the pair's rank above the place of its left symbol, so the
        order is best score first and leftmost on ties.
        """
        rank = self.rank
        symbols = list(text)
        n = len(symbols)
        if n <= SHORT:
            return self._ids(self._merge_short(symbols))
        bits = n.bit_length()
        low = (1 << bits) - 1
        before = list(range(-1, n - 1))
        after = list(range(1, n + 1))
        ranks = [rank.get(a + b) for a, b in zip(symbols, symbols[1:])]
        agenda = [(r << bits) | i for i, r in enumerate(ranks) if r is not None]
        heapq.heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            left = entry & low
            right = after[left]
            if right >= n or not symbols[left]:
                continue
            pair = symbols[left] + symbols[right]
            # An entry is stale once one of its symbols was merged away or has grown.
            if rank.get(pair) != entry >> bits:
                continue
            symbols[left] = pair
            symbols[right] = ""
            nxt = after[left] = after[right]
            if nxt < n:
                before[nxt] = left
                r = rank.get(pair + symbols[nxt])
                if r is not None:
                    heappush(agenda, (r << bits) | left)
            prv = before[left]
            if prv >= 0:
                r = rank.get(symbols[prv] + pair)
                if r is not None:
                    heappush(agenda, (r << bits) | prv)
        return self._ids(symbols)

    def _merge_short(self, symbols: list[str]) -> list[str]:
        """The same for a few symbols, where the agenda is a plain list of the pairs' ranks."""
        get = self.rank.get
        ranks = [get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            pair = symbols[i] + symbols[i + 1]
            symbols[i] = pair
            del symbols[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(pair + symbols[i + 1], NEVER)
            if i:
                ranks[i - 1] = get(symbols[i - 1] + pair, NEVER)
        return symbols

    def _ids(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            if s:
                known = self.ids.get(s)
                if known is not None:
                    out.append(known)
                elif self.byte_fallback:
                    out.extend(self.bytes_[b] for b in s.encode())
                else:
                    out.append(self.library.unk_id())
        return out

    def normalise(self, text: str) -> str:
        """What the model's own rules make of the text; spaces become the space symbol."""
        return self.library.normalize(text)

    def encode(self, text: str) -> tuple[bytes, list[str]]:
        """Ids as little-endian unsigned 32-bit integers, and the chunks they came from."""
        parts = self.chunks(self.normalise(text))
        memo = self.memo
        try:
            return b"".join([memo[c] for c in parts]), parts
        except KeyError:
            pass
        got = []
        for c in parts:
            ids = memo.get(c)
            if ids is None:
                ids = self._remember(c)
                memo = self.memo
            got.append(ids)
        return b"".join(got), parts

    def _remember(self, chunk: str) -> bytes:
        """Ids of a chunk that the young generation lacks; a full one becomes the old one."""
        ids = self.old.get(chunk)
        if ids is None:
            ids = array("I", self.merge(chunk)).tobytes()
            self.fresh.append((chunk, ids))
        if len(chunk) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_CHUNKS:
                self.old, self.memo = self.memo, {}
            self.memo[chunk] = ids
        return ids

    def check(self) -> None:
        """Hold the chunks encoded since the last call against the library."""
        # The library puts its own space in front, so a chunk that begins with one is passed without
        # it. What it would lose or change that way is looked at next to a newline.
        first = SPACE if self.prefix else ""
        line = self.library.encode("\n")[len(self.library.encode("")) :]
        asked = []
        for c, _ in self.fresh:
            if first and not c.startswith(first):
                asked.append(("\n" + c.replace(SPACE, " "), len(line), 0))
            elif not c.strip(SPACE):
                asked.append((c[len(first) :].replace(SPACE, " ") + "\n", 0, len(self.library.encode("x\n")) - len(self.library.encode("x"))))
            else:
                asked.append((c[len(first) :].replace(SPACE, " "), 0, 0))
        coded = self.library.encode([t for t, _, _ in asked], num_threads=1)
        for (c, ids), (_, head, tail), lib in zip(self.fresh, asked, coded, strict=True):
            if array("I", lib[head : len(lib) - tail]).tobytes() != ids:
                self.wrong.add(c)
        self.fresh.clear()


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of this process; a Python worker loads it once and keeps its remembered chunks."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def _encoder(path: str, text_at: int, bos: bool, eos: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        head = array("I", [pieces.library.bos_id()] if bos else []).tobytes()
        tail = array("I", [pieces.library.eos_id()] if eos else []).tobytes()
        decode = pieces.library.decode
        for batch in batches:
            texts = batch.column(text_at)
            at = 0
            while at < batch.num_rows:
                begin, size, ids, back, used = at, 0, [], [], []
                while at < batch.num_rows and size < OUT_BYTES:
                    body, parts = pieces.encode(texts[at].as_py() or "")
                    row = head + body + tail
                    ids.append(row)
                    back.append(decode(memoryview(row).cast("I").tolist()))
                    used.append(parts if len(pieces.fresh) or pieces.wrong else ())
                    size += len(row) + len(back[-1])
                    at += 1
                pieces.check()
                wrong = pieces.wrong
                agrees = [wrong.isdisjoint(p) for p in used] if wrong else [True] * len(ids)
                columns = [*batch.slice(begin, at - begin).columns, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(back, pa.string()), pa.array(agrees, pa.bool_())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def encode_pieces(df: DataFrame, model_path: str, text: str = "text", bos: bool = True, eos: bool = True) -> DataFrame:
    """Encode ``text`` of every row and decode the ids again.

    Adds ``n_tokens`` (all ids), ``ids`` (binary, little-endian unsigned 32-bit), ``decoded`` and
    ``library_agrees``. ``model_path`` has to be readable on every executor. The columns of ``df``
    that carry one of these names are replaced. A null or empty text has the begin and end ids only
    and decodes to an empty text. Rows keep their number and partitioning; nothing is shuffled.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    added = T.StructType().add("n_tokens", "long").add("ids", "binary").add("decoded", "string").add("library_agrees", "boolean")
    keep = df.drop(*added.names)
    # The text goes in under a name of its own, so that an output column may replace it.
    name = free_name(df, "_text")
    given = keep.select(*[keep[c] for c in keep.columns], df[text].cast("string").alias(name))
    out = T.StructType(given.schema.fields + added.fields)
    fn = _encoder(model_path, len(keep.columns), bos, eos, to_arrow_schema(out))
    return given.mapInArrow(fn, out).drop(name)


def unpack_ids(column: str) -> F.Column:
    """The packed ids as an array of integers (``conv`` on each group of eight hex digits)."""
    swapped = F.regexp_replace(F.hex(column), "(..)(..)(..)(..)", "$4$3$2$1 ")
    words = F.filter(F.split(swapped, " "), lambda w: w != "")
    return F.transform(words, lambda w: F.conv(w, 16, 10).cast("int"))
