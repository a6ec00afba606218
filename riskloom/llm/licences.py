"""License scans: one Aho-Corasick automaton finds tags and notice phrases, a shunting-yard parser
evaluates the expressions behind the tags.

Texts are normalised to words like in ``decontam``; the automaton works on word numbers and reads a
text once, whatever the number of phrases. A tag (``SPDX-License-Identifier:``, ``License:``) is
followed up in the original text: its expression is cut into tokens, brought to postfix order and
evaluated. OR takes the freest side, AND the most bound one, and an exception behind WITH frees its
licence by one step.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskloom.llm.carry import map_texts
from riskloom.llm.decontam import words

# Notice phrases and the labels they stand for.
NOTICES = [
    ("mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("apache license", "apache"),
    ("apache license version 2", "apache-2"),
    ("gnu general public license", "gpl"),
    ("gnu general public license version 2", "gpl-2"),
    ("gnu general public license version 3", "gpl-3"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("mozilla public license version 2", "mpl-2"),
    ("eclipse public license", "epl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("creative commons attribution", "cc-by"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("cc by nc", "cc-by-nc"),
    ("cc by nc sa", "cc-by-nc-sa"),
    ("cc by nc nd", "cc-by-nc-nd"),
    ("all rights reserved", "proprietary"),
]
# Phrases in front of a licence expression.
TAGS = ["spdx license identifier", "license", "licence"]
# How free a licence leaves its user; 2 attribution at most, 1 copyleft of the work's own files, 0 more.
FREEDOM = {
    "mit": 2, "isc": 2, "bsd": 2, "apache": 2, "zlib": 2, "unlicense": 2, "cc0": 2, "cc-by": 2, "wtfpl": 2, "bsl": 2,
    "lgpl": 1, "mpl": 1, "epl": 1, "cddl": 1, "cc-by-sa": 1,
    "gpl": 0, "agpl": 0, "sspl": 0, "cc-by-nc": 0, "cc-by-nd": 0, "cc-by-nc-sa": 0, "cc-by-nc-nd": 0, "proprietary": 0,
}

# How much one piece of evidence of each kind tells by itself.
_WEIGHT = {"base": 0.8, "notice": 0.7, "expression": 0.95}
_BINDS = {"or": 1, "and": 2, "with": 3}

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_AFTER_TAG = re.compile(r"[\"']?[ \t]*[:=][ \t]*[\"'\[]*")
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+-]*)")
_SUFFIX = re.compile(r"(?:\+|-only|-or-later)+$")
_NUMBERS = re.compile(r"(?:-v?[0-9]+(?:\.[0-9]+)*)+(?:-(?:clause|patent|clear))*$")

_PLACE = T.StructType().add("word", "long").add("label", "string")
_SPAN = T.StructType().add("start", "integer").add("end", "integer").add("label", "string")
_EXPRESSION = (
    T.StructType()
    .add("start", "integer")
    .add("end", "integer")
    .add("postfix", T.ArrayType(T.StringType(), False))
    .add("labels", T.ArrayType(T.StringType(), False))
    .add("freedom", "integer")
)
ADDED = (
    T.StructType()
    .add("n_words", "long")
    .add("base_places", T.ArrayType(_PLACE, False))
    .add("notices", T.ArrayType(_SPAN, False))
    .add("expressions", T.ArrayType(_EXPRESSION, False))
    .add("base_labels", T.ArrayType(T.StringType(), False))
    .add("labels", T.ArrayType(T.StringType(), False))
    .add("score", "double")
)


def licence_label(identifier: str) -> str | None:
    """Label of an identifier (``Apache-2.0`` gives ``apache-2``); None if its family is unknown."""
    name = _SUFFIX.sub("", identifier.lower())
    family = _NUMBERS.sub("", name)
    if family not in FREEDOM:
        return None
    if family.startswith("cc"):
        return family
    return re.sub(r"\.0$", "", name)


def _freedom(label: str) -> int:
    return FREEDOM[label if label in FREEDOM else _NUMBERS.sub("", label)]


def tokens_at(text: str, at: int) -> list[tuple[str, int]]:
    """Tokens of an expression that begins at ``at`` (each with its end), up to what cannot belong to it."""
    out = []
    while m := _TOKEN.match(text, at):
        out.append((m.group(1), m.end()))
        at = m.end()
    return out


def postfix(tokens: Sequence[str]) -> tuple[list[str], int]:
    """Postfix order of the longest start of ``tokens`` that is a whole expression, and its number of tokens.

    Operators are the words or, and, with in any case, tighter in this order, left to right on ties.
    Operands are known identifiers; behind WITH any name that ends in ``exception``.
    """
    whole, depth, operand = 0, 0, True
    for k, token in enumerate(tokens):
        low = token.lower()
        if operand:
            if low == "(":
                depth += 1
                continue
            behind_with = k > 0 and tokens[k - 1].lower() == "with"
            if not (low.endswith("exception") if behind_with else licence_label(token)):
                break
            operand = False
        elif low == ")" and depth:
            depth -= 1
        elif low in _BINDS:
            if low == "with" and tokens[k - 1] == ")":
                break
            operand = True
        else:
            break
        if not depth and not operand:
            whole = k + 1
    out: list[str] = []
    waiting: list[str] = []
    for token in tokens[:whole]:
        low = token.lower()
        if low == "(":
            waiting.append(low)
        elif low == ")":
            while (top := waiting.pop()) != "(":
                out.append(top)
        elif low in _BINDS:
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[low]:
                out.append(waiting.pop())
            waiting.append(low)
        else:
            out.append(token)
    return out + waiting[::-1], whole


def evaluate(order: Sequence[str]) -> tuple[list[str], int]:
    """Labels of a postfix expression, sorted, and its freedom (0 to 2)."""
    labels: set[str] = set()
    values: list[int] = []
    for token in order:
        if token in _BINDS:
            right, left = values.pop(), values.pop()
            values.append({"or": max(left, right), "and": min(left, right), "with": min(2, left + 1)}[token])
        elif (label := licence_label(token)) is None:
            values.append(0)  # the exception's name
        else:
            labels.add(label)
            values.append(_freedom(label))
    return sorted(labels), values[0]


class LicenceScanner:
    """The automaton over base phrases, notices and tags."""

    def __init__(self, base: Sequence[tuple[str, str]]) -> None:
        self.number: dict[bytes, int] = {}
        self.means: list[list[tuple[str, str]]] = []
        self.sizes: list[int] = []
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        place: dict[tuple[int, ...], int] = {}
        given = [("base", p, label) for p, label in base]
        given += [("notice", p, label) for p, label in NOTICES] + [("tag", p, "") for p in TAGS]
        for kind, phrase, label in given:
            key = tuple(self.number.setdefault(w, len(self.number) + 1) for w in words(phrase))
            if not key:
                continue
            at = place.setdefault(key, len(self.means))
            if at == len(self.means):
                self.means.append([])
                self.sizes.append(len(key))
                self.machine.add_word(key, at)
            if (kind, label) not in self.means[at]:
                self.means[at].append((kind, label))
        self.machine.make_automaton()

    def scan(self, text: str | None) -> tuple:
        """The values of ``ADDED`` for one text."""
        own = words(text)
        get = self.number.get
        base: list[tuple[int, str]] = []
        notices: list[tuple[int, int, str]] = []
        tags: list[int] = []
        for end, at in self.machine.iter(tuple([get(w, 0) for w in own])) if own else ():
            start = end - self.sizes[at] + 1
            for kind, label in self.means[at]:
                if kind == "base":
                    base.append((start, label))
                elif kind == "notice":
                    notices.append((start, end, label))
                else:
                    tags.append(end)
        notices = _widest(notices)
        spans, expressions = [], []
        if notices or tags:
            places = [m.span() for m in _WORD.finditer(text)]
            spans = [(places[a][0], places[b][1], label) for a, b, label in notices]
            for end in tags:
                found = _expression(text, places[end][1])
                if found:
                    expressions.append(found)
        base.sort()
        base_labels = {label for _, label in base}
        labels = base_labels | {label for _, _, label in spans} | {x for e in expressions for x in e[3]}
        doubt = 1.0
        for kind, known in (("base", base), ("notice", spans), ("expression", expressions)):
            doubt *= 1.0 - _WEIGHT[kind] * bool(known)
        return len(own), base, spans, expressions, sorted(base_labels), sorted(labels), 1.0 - doubt


def _widest(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Without places that lie inside a longer one ("cc by" in "cc by nc"), by start."""
    out: list[tuple[int, int, str]] = []
    for place in sorted(found, key=lambda p: (p[0], -p[1], p[2])):
        if not out or place[1] > out[-1][1] or place[:2] == out[-1][:2]:
            out.append(place)
    return out


def _expression(text: str, at: int) -> tuple[int, int, list[str], list[str], int] | None:
    sign = _AFTER_TAG.match(text, at)
    if not sign:
        return None
    tokens = tokens_at(text, sign.end())
    order, whole = postfix([t for t, _ in tokens])
    if not whole:
        return None
    return (sign.end(), tokens[whole - 1][1], order, *evaluate(order))


def _columns(scanned: list[tuple]) -> list[pa.Array]:
    def kind(field: T.StructField) -> pa.DataType:
        from pyspark.sql.pandas.types import to_arrow_type

        return to_arrow_type(field.dataType)

    def packed(value, field: T.StructField):
        if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StructType):
            return [dict(zip(field.dataType.elementType.names, v)) for v in value]
        return value

    return [pa.array([packed(row[k], f) for row in scanned], kind(f)) for k, f in enumerate(ADDED.fields)]


def scan_licences(df: DataFrame, base: Sequence[tuple[str, str]], text: str = "text") -> DataFrame:
    """Licences named in ``text``.

    Adds ``n_words``; ``base_places``, every place (word number from 0) where a phrase of ``base``
    (phrase, label) stands, by place; ``notices``, the method's own phrases (character spans, places
    inside longer ones left out); ``expressions``, what stands behind a tag (character span, postfix
    order, labels, freedom: 2 permissive, 1 weak copyleft, 0 more bound); ``base_labels`` and ``labels``
    (the method's too), distinct and sorted; ``score``, 0 without labels, rising with each kind of
    evidence. A phrase without words matches nothing; a tag without a valid expression adds nothing.

    A null or empty text has no words, no places and score 0. Every row is kept once, equal rows alike;
    columns of ``df`` with these names are replaced, all others stay. Nothing is shuffled.
    """
    given = list(base)

    def make():
        scanner = LicenceScanner(given)
        return lambda texts: _columns([scanner.scan(t) for t in texts.to_pylist()])

    return map_texts(df, text, ADDED, make)
