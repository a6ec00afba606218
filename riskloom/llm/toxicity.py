"""Toxicity categories by a classifier chain.

Categories are predicted one after the other by linear models. Each sees which of a selected set of
words and word beginnings a text holds, and the probabilities of the categories before it. In
training these come from models of other folds, so a later model learns how far to trust the earlier
ones on texts they have not seen. Words and beginnings are selected per category by the chi-square
of their presence among the training rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.session import ship
from riskloom.llm.carry import distinct_draws, free_name

# Bounds of the training sample: rows per value of the last category, and bytes of a sampled text.
ROWS_PER_CLASS = 2_000
MAX_TEXT_BYTES = 20_000
BEGINNINGS = (4, 5, 6)
MAX_FEATURES = 600
LEAST_CHI_SQUARE = 20.0
FOLDS = 3

_WORDS = re.compile(r"[^\W\d_]+")


def text_features(text: str | None) -> set[str]:
    """Lower-case words, and their first letters followed by a mark."""
    words = set(_WORDS.findall((text or "").lower()))
    found = set(words)
    for n in BEGINNINGS:
        found |= {w[:n] + "*" for w in words if len(w) > n}
    return found


@dataclass
class Link:
    """One category: the features it reads, their weights, and those of the earlier categories."""

    place: dict[str, int]
    weights: np.ndarray
    chained: np.ndarray
    bias: float

    def logit(self, found: set[str], earlier: Sequence[float]) -> float:
        z = self.bias + float(np.dot(self.chained, earlier)) if len(earlier) else self.bias
        return z + float(sum(self.weights[self.place[f]] for f in found & self.place.keys()))


@dataclass
class Chain:
    categories: list[str]
    links: list[Link] = field(default_factory=list)
    threshold: float = 0.5

    def predict(self, text: str | None) -> list[float]:
        found = text_features(text)
        out: list[float] = []
        for link in self.links:
            out.append(_sigmoid(link.logit(found, out)))
        return out


def _sigmoid(z: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def _select(rows: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """Features whose presence tells the classes apart, the strongest first."""
    n, ones = len(y), int(y.sum())
    if not 0 < ones < n:
        return np.empty(0, int)
    total = np.bincount(np.concatenate(rows), minlength=size).astype(float)
    a = np.bincount(np.concatenate([r for r, label in zip(rows, y) if label]), minlength=size).astype(float)
    b, c = total - a, ones - a
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = n * (a * (n - total - c) - b * c) ** 2 / (total * (n - total) * ones * (n - ones))
    chi = np.where((total >= 5) & (total <= n - 5), chi, 0.0)
    order = np.argsort(-chi, kind="stable")[:MAX_FEATURES]
    return order[chi[order] >= LEAST_CHI_SQUARE]


def _matrix(rows: list[np.ndarray], chosen: np.ndarray, size: int) -> np.ndarray:
    column = np.full(size, -1)
    column[chosen] = np.arange(len(chosen))
    x = np.zeros((len(rows), len(chosen)), np.float32)
    for i, r in enumerate(rows):
        at = column[r]
        x[i, at[at >= 0]] = 1
    return x


def _fit(
    rows: list[np.ndarray], names: list[str], earlier: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 150
) -> Link:
    """Logistic regression by accelerated gradient descent with a quadratic penalty."""
    chosen = _select(rows, y, len(names))
    place = {names[f]: i for i, f in enumerate(chosen)}
    x = np.concatenate([_matrix(rows, chosen, len(names)), earlier.astype(np.float32)], axis=1)
    n, d = x.shape
    rate = np.clip(y.mean() if n else 0.5, 1e-4, 1 - 1e-4)
    y = y.astype(np.float32)
    w, bias = np.zeros(d, np.float32), float(np.log(rate / (1 - rate)))
    if d and n:
        # The largest curvature bounds the step.
        v = np.full(d, 1 / np.sqrt(d), np.float32)
        for _ in range(15):
            v = x.T @ (x @ v)
            v /= np.linalg.norm(v) or np.float32(1)
        step = float(1 / (0.25 * (np.linalg.norm(x @ v) ** 2 + n) + l2))
        look, look_bias, pace = w, bias, 1.0
        for _ in range(steps):
            gap = 1 / (1 + np.exp(-np.clip(x @ look + np.float32(look_bias), -35, 35))) - y
            new = look - np.float32(step) * (x.T @ gap + np.float32(l2) * look)
            new_bias = look_bias - step * float(gap.sum())
            following = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
            push = (pace - 1) / following
            look = new + np.float32(push) * (new - w)
            look_bias = new_bias + push * (new_bias - bias)
            w, bias, pace = new, new_bias, following
    k = len(place)
    return Link(place, w[:k].astype(np.float64), w[k:].astype(np.float64), bias)


def train(
    texts: Sequence[str], labels: np.ndarray, categories: Sequence[str], weights: np.ndarray | None = None, folds: int = FOLDS
) -> Chain:
    """Fit the chain; ``labels`` has a column of zeros and ones for each category, in their order.

    The threshold on the last category is the one with the best F1 on out-of-fold predictions, each
    row counting as the ``weights`` many that it was sampled from.
    """
    chain = Chain(list(categories))
    number: dict[str, int] = {}
    rows = [np.array(sorted(number.setdefault(f, len(number)) for f in sorted(text_features(t))), int) for t in texts]
    names = list(number)
    n = len(rows)
    fold = np.arange(n) % folds
    outside = np.zeros((n, 0))
    for c in range(len(chain.categories)):
        y = labels[:, c].astype(np.float64) if n else np.zeros(0)
        column = np.zeros(n)
        for k in range(folds):
            fit, held = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            link = _fit([rows[i] for i in fit], names, outside[fit], y[fit])
            column[held] = [_sigmoid(link.logit({names[f] for f in rows[i]}, outside[i])) for i in held]
        chain.links.append(_fit(rows, names, outside, y))
        outside = np.concatenate([outside, column[:, None]], axis=1)
    if n and chain.categories:
        y, p = labels[:, -1].astype(bool), outside[:, -1]
        grid = np.arange(5, 96) / 100
        of = np.ones(n) if weights is None else weights
        f1 = [2 * of[y & (p >= t)].sum() / max(1e-9, of[y].sum() + of[p >= t].sum()) for t in grid]
        best = np.flatnonzero(np.isclose(f1, max(f1)))
        chain.threshold = float(grid[best[len(best) // 2]])
    return chain


def labelled_sample(
    df: DataFrame, labels: DataFrame, last: str, key: str = "doc_id", rows_per_class: int = ROWS_PER_CLASS
) -> DataFrame:
    """Rows of ``df`` with their labels, at most ``rows_per_class`` for each value of ``last``.

    Labels are chosen by a hash of all their columns, at a rate set by one count; equal ones count once
    and at most ``rows_per_class`` of a class are left, so few that they are broadcast: the texts are
    scanned once and not shuffled. Where an id has many rows or labels, the joined rows are reduced to the
    bound once more, equal ones to one. ``sample_weight`` is the number of labels that a row stands for.
    Labels that are neither 0 nor 1, or have no key, are not used.
    """
    usable = labels.where(labels[last].isin(0, 1) & labels[key].isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(F.col(last).cast("int")).count().collect()}
    draw = F.xxhash64(*[labels[c].cast("string") for c in labels.columns], F.lit("toxicity"))
    wanted, weight = F.lit(False), F.lit(1.0)
    for value, n in counts.items():
        rate = min(1.0, rows_per_class / n)
        wanted = wanted | ((labels[last] == value) & (F.pmod(draw, F.lit(1 << 24)) < int(rate * (1 << 24))))
        weight = F.when(labels[last] == value, 1 / rate).otherwise(weight)
    chosen = usable.where(wanted).select(key, *[c for c in labels.columns if c != key], weight.alias("sample_weight"))
    few = distinct_draws(chosen, F.xxhash64(*[F.col(c).cast("string") for c in chosen.columns]), rows_per_class, last).drop("draw_")
    joined = df.join(F.broadcast(few), key)
    return distinct_draws(joined, F.xxhash64(*[F.col(c).cast("string") for c in joined.columns]), rows_per_class, last).drop("draw_")


def fit_chain(sample: DataFrame, categories: Sequence[str], text: str = "text", key: str = "doc_id") -> Chain:
    """Train on a labelled sample, which is collected whole (see ``labelled_sample`` for its bound).

    ``sample`` has a column of zeros and ones per category. Rows with a null in one, or without
    text, or over ``MAX_TEXT_BYTES`` bytes, are not used.
    """
    known = F.octet_length(sample[text]) <= MAX_TEXT_BYTES
    for c in categories:
        known = known & sample[c].isin(0, 1)
    order = F.xxhash64(sample[key].cast("string"), F.lit("fold"))
    marks = [sample[c].cast("int").alias(f"y{i}") for i, c in enumerate(categories)]
    marks.append((sample["sample_weight"] if "sample_weight" in sample.columns else F.lit(1.0)).alias("w"))
    got = sorted(sample.where(known).select(order.alias("o"), sample[text].alias("t"), *marks).collect(), key=lambda r: (r["o"], r["t"]))
    labels = np.array([[r[f"y{i}"] for i in range(len(categories))] for r in got], int).reshape(len(got), len(categories))
    return train([r["t"] for r in got], labels, categories, np.array([r["w"] for r in got]))


def _predictor(chain, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Chain = chain.value
        k = len(fitted.categories)
        for batch in batches:
            got = np.array([fitted.predict(t.as_py()) for t in batch.column(batch.num_columns - 1)]).reshape(batch.num_rows, k)
            added = [*[pa.array(got[:, i], pa.float64()) for i in range(k)], pa.array(got[:, -1] >= fitted.threshold)]
            yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(batch.columns, schema)], *added], schema=schema)

    return run


def predict_toxicity(df: DataFrame, chain: Chain, text: str = "text", flag: str = "is_toxic") -> DataFrame:
    """Adds ``p_<category>`` for every category and ``flag`` (the last one reaches the threshold).

    Columns of ``df`` with these names are replaced. A null or empty text is judged as one without
    words. Rows are kept as they are, equal rows alike; nothing is shuffled.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    ship(spark)
    added = T.StructType()
    for c in chain.categories:
        added = added.add(f"p_{c}", "double")
    added = added.add(flag, "boolean")
    keep = df.drop(*added.names)
    name = free_name(df, "_text")
    given = keep.select(*[keep[c] for c in keep.columns], df[text].cast("string").alias(name))
    out = T.StructType(given.schema.fields + added.fields)
    # At most MAX_FEATURES weights for each category.
    return given.mapInArrow(_predictor(spark.sparkContext.broadcast(chain), to_arrow_schema(out)), out).drop(name)


def holds_word(text: Column, words: Sequence[str]) -> Column:
    """1 if the text holds one of the words as a whole word, in any case, else 0."""
    return F.coalesce(F.regexp_like(text, F.lit(rf"(?i)\b(?:{'|'.join(words)})\b")), F.lit(False)).cast("int")
