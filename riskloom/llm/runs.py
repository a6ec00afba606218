"""Periodic runs of words: a suffix automaton whose link tree is walked with link-cut access.

A run is a stretch of words that repeats with its smallest period and that no neighbouring word
extends. Words are numbered and one automaton is built over a stretch. Appending word ``i`` then
means to access the automaton's state of that prefix in the link tree: the path from there to the
root holds all suffixes, cut into segments that share the place where they last ended. Let a segment
have last ended at ``e``, with ``top`` words in its longest suffix and ``d = i - e``. If ``d`` lies
among the segment's lengths, the last ``2 d`` words are a square whose half is no repetition itself,
and ``i - d - top + 1`` is the first word of the run it belongs to, since no longer suffix ended at
``e``. The access recolours the path with ``i``. Squares that follow each other with equal period and
first word are one run, which ends with the last of them.

The path segments are the preferred paths of a link-cut tree over splay trees, so recolouring is the
usual access and costs a logarithm of the words, amortised.

Only stretches that can hold a wanted run are given to the automaton. In a run of at least ``floor``
words and ``least`` periods (3 at least), every piece of 8 words (with the defaults, see ``_piece``)
occurs again one period away; numpy marks the pieces that occur twice in the text, and a run lies
within one stretch of consecutive marks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskloom.llm.carry import map_texts

FLOOR = 24
LEAST = 3

_RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")
ADDED = (
    T.StructType().add("n_words", "long").add("runs", T.ArrayType(_RUN, False)).add("strongest", _RUN).add("collapsed", "string")
)


class SuffixAutomaton:
    """States of a sequence: ``link`` (0: none), ``length`` of the longest string, state of each prefix."""

    def __init__(self, sequence: Sequence[int]) -> None:
        after: list[dict[int, int]] = [{}, {}]
        link, length, prefixes = [0, 0], [0, 0], []
        last = 1
        for c in sequence:
            new = len(link)
            after.append({})
            length.append(length[last] + 1)
            link.append(1)
            p = last
            while p and c not in after[p]:
                after[p][c] = new
                p = link[p]
            if p:
                q = after[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    part = len(link)
                    after.append(after[q].copy())
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p and after[p].get(c) == q:
                        after[p][c] = part
                        p = link[p]
                    link[q] = link[new] = part
            prefixes.append(new)
            last = new
        self.link, self.length, self.prefixes = link, length, prefixes


class PathColours:
    """A link-cut tree over fixed parents: access recolours the path to the root and tells its old colours.

    Every preferred path is a splay tree ordered by depth; its one colour is kept at the splay root.
    """

    def __init__(self, parents: Sequence[int]) -> None:
        self.up = list(parents)
        self.left = [0] * len(parents)
        self.right = [0] * len(parents)
        self.colour = [-1] * len(parents)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x
        up[x] = g
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p] = x

    def _splay(self, x: int) -> None:
        up, left, right, rotate = self.up, self.left, self.right, self._rotate
        top = x
        p = up[x]
        while p and (left[p] == x or right[p] == x):
            top = p
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                top = g
                rotate(p if (left[g] == p) == (left[p] == x) else x)
            rotate(x)
            p = up[x]
        self.colour[x] = self.colour[top]

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """``(old colour, deepest node)`` of the segments between ``node`` and the root, deepest first."""
        up, left, right, colours = self.up, self.left, self.right, self.colour
        found = []
        x, below = node, 0
        while x:
            p = up[x]
            if p and (left[p] == x or right[p] == x):
                self._splay(x)
            found.append((colours[x], x))
            deeper = right[x]
            if deeper:
                colours[deeper] = colours[x]
            right[x] = below
            below = x
            x = up[x]
        colours[below] = colour
        return found


def all_runs(sequence: Sequence[int]) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run with at least two periods, by start, then period."""
    automaton = SuffixAutomaton(sequence)
    length = automaton.length
    paths = PathColours(automaton.link)
    ends: dict[tuple[int, int], int] = {}
    for i, state in enumerate(automaton.prefixes):
        segments = paths.access(state, i)
        shorter = 0
        for e, deepest in reversed(segments):
            if e < 0:
                break
            top = length[deepest]
            d = i - e
            if shorter < d <= top:
                ends[i - d - top + 1, d] = i
            shorter = top
    return sorted((start, end - start + 1, d) for (start, d), end in ends.items())


def _piece(floor: int, least: int) -> int:
    """Words of a piece that recurs one period away wherever it lies in a run."""
    return min(max(floor, least * q) - 2 * q for q in range(1, floor + 1))


def candidate_stretches(numbers: np.ndarray, rows: np.ndarray, floor: int = FLOOR, least: int = LEAST) -> list[tuple[int, int]]:
    """``[begin, end)`` stretches of the concatenated texts outside of which no wanted run lies.

    ``rows`` is the text of each word, ascending. Equal hashes of different pieces only add stretches.
    """
    size = _piece(floor, least)
    n = len(numbers) - size + 1
    if n <= 0:
        return []
    mixed = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    mixed ^= mixed >> np.uint64(29)
    piece = rows[:n].astype(np.uint64)
    for j in range(size):
        piece = piece * np.uint64(0xD1342543DE82EF95) + mixed[j : j + n]
    piece ^= piece >> np.uint64(32)
    inside = rows[:n] == rows[size - 1 :]
    order = np.argsort(piece, kind="stable")
    ranked = piece[order]
    same = ranked[1:] == ranked[:-1]
    marked = np.zeros(n, bool)
    marked[order[1:][same]] = True
    marked[order[:-1][same]] = True
    owner = np.concatenate(([0], np.where(marked & inside, rows[:n] + 1, 0), [0]))
    edge = np.flatnonzero(owner[1:] != owner[:-1])
    begins, ends = edge[:-1], edge[1:]
    wide = (owner[1:][begins] > 0) & (ends - begins >= floor - size + 1)
    return [(int(b), int(e) + size - 1) for b, e in zip(begins[wide], ends[wide])]


def _measure(texts: pa.Array, floor: int, least: int) -> list[pa.Array]:
    split = [t.encode().split() if t else [] for t in texts.to_pylist()]
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    flat = pa.array([w for words in split for w in words], pa.binary())
    numbers = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(flat) else np.empty(0, np.int32)
    rows = np.repeat(np.arange(len(split)), sizes)
    found: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for begin, end in candidate_stretches(numbers, rows, floor, least):
        row = int(rows[begin])
        base = begin - int(starts[row])
        for start, length, period in all_runs(numbers[begin:end].tolist()):
            if length >= max(floor, least * period):
                found[row].append((base + start, length, period))
    strongest, collapsed = [], []
    for words, runs in zip(split, found, strict=True):
        runs.sort(key=lambda r: (r[0], r[2]))
        best = None
        for r in runs:  # in order of start and period, so an equal exponent later on is no better
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        strongest.append(best)
        if runs:
            dropped = bytearray(len(words))
            for start, length, period in runs:
                dropped[start + period : start + length] = b"\1" * (length - period)
            words = [w for w, d in zip(words, dropped) if not d]
        collapsed.append(b" ".join(words).decode())
    names = _RUN.names
    kinds = pa.struct([(n, pa.int64()) for n in names])
    as_dict = lambda r: dict(zip(names, r))
    return [
        pa.array(sizes),
        pa.array([[as_dict(r) for r in runs] for runs in found], pa.list_(kinds)),
        pa.array([as_dict(r) if r else None for r in strongest], kinds),
        pa.array(collapsed, pa.string()),
    ]


def find_runs(df: DataFrame, text: str = "text", floor: int = FLOOR, least: int = LEAST) -> DataFrame:
    """Periodic runs among the words (whatever ASCII white space separates) of ``text``.

    Adds ``n_words``; ``runs``, the stretches with at least ``floor`` words and ``least`` (3 or more)
    times their smallest period, by start (word number from 0), then period; ``strongest``, the run with
    the greatest exact length / period (smallest start, then period on ties; null without runs); and
    ``collapsed``, the words that no run holds after its first period, joined by one space.

    A null or empty text has no words, no runs and an empty ``collapsed``. Every row is kept once,
    equal rows alike; columns of ``df`` with these names are replaced, all others stay, whatever their
    names. Each text is one unit of work; nothing is shuffled or collected.
    """
    if least < 3 or floor < 1:
        raise ValueError("runs of three periods and one word at least")

    def make():
        return lambda texts: _measure(texts, floor, least)

    return map_texts(df, text, ADDED, make)
