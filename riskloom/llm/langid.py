"""Language identification with averaged hashed subword embeddings and a linear softmax.

A text is the bag of its subwords: the runs of 2 to 4 characters inside words, in lower case, with
a mark at both ends of a word. Every subword is hashed to a row of an embedding table; a text is the
mean of its rows, and a linear softmax turns the mean into language probabilities. Table and softmax
are trained together by stochastic gradient descent in numpy, on a bounded sample of labelled rows.

Scores are calibrated on held-back rows of the sample: a temperature that fits their likelihood, and
a threshold under which a prediction is rejected, set so that next to no right prediction goes.

As mean and softmax are linear, the embeddings are multiplied into the output layer once after
training, and a prediction adds up one short row per subword.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.session import ship
from riskloom.llm.carry import distinct_draws, free_name

UNDETERMINED = "und"
SIZES = (2, 3, 4)
BUCKET_BITS = 16
BUCKET_TYPE = np.uint16  # the training sample is kept in the driver as buckets, one per subword
DIMENSIONS = 16
# Bounds of the training sample: rows per language, languages, and characters taken of a sampled text.
ROWS_PER_LANGUAGE = 700
MAX_LANGUAGES = 200
MAX_TEXT_CHARS = 20_000
# Characters handled at a time.
PIECE_CHARS = 1 << 16
# A small sample is gone through more often, up to this many steps.
LEAST_STEPS = 1500

_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    """Whether each code point is a letter; made once per process."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def subwords(text: str) -> Iterator[np.ndarray]:
    """Hash buckets of a text's subwords, piece by piece."""
    letters = _is_letter()
    at = 0
    while at < len(text):
        # Pieces end behind a blank, or anywhere if a word is longer than a piece.
        end = at + PIECE_CHARS
        if end < len(text):
            end = (text.rfind(" ", at, end) + 1) or end
        # Surrogates cannot be encoded; lower-casing may lengthen a text, never empty it.
        codes = np.frombuffer(text[at:end].lower().encode("utf-32-le", "replace"), np.uint32)
        at = end
        codes = np.where(letters[codes], codes, 0)
        codes = np.concatenate([np.zeros(1, codes.dtype), codes, np.zeros(1, codes.dtype)])
        # Runs of other characters shrink to one mark.
        codes = codes[(codes != 0) | np.concatenate([[True], codes[:-1] != 0])].astype(np.uint64)
        mark = codes == 0
        found = []
        mixed = codes * _MULTIPLIERS[0]
        value = mixed.copy()
        inner = np.zeros(len(codes), bool)  # a mark strictly inside the run that begins here
        for n in range(2, max(SIZES) + 1):
            m = len(codes) - n + 1
            if m <= 0:
                break
            value = (value[:m] ^ (value[:m] >> np.uint64(29))) * _MULTIPLIERS[1] + mixed[n - 1 :]
            if n > 2:
                inner = inner[:m] | mark[n - 2 : n - 2 + m]
            if n in SIZES:
                ok = ~inner[:m] & ~(mark[:m] & mark[n - 1 :])
                found.append((value[ok] * _MULTIPLIERS[0]) >> np.uint64(64 - BUCKET_BITS))
        if found:
            yield np.concatenate(found).astype(np.int64)


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # buckets x languages: embeddings times output layer
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str) -> np.ndarray | None:
        total, count = np.zeros(len(self.languages)), 0
        for buckets in subwords(text):
            # Adding up in double precision by bucket, so that the order of pieces does not matter.
            total += self.table[buckets].sum(axis=0, dtype=np.float64)
            count += len(buckets)
        return total / count + self.bias if count else None

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, and whether the prediction is accepted."""
        z = self.logits(text) if text else None
        if z is None:
            return UNDETERMINED, 0.0, False
        p = _softmax(z[None, :] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(min(1.0, p[best])), bool(p[best] >= self.threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], epochs: int = 12, batch: int = 32, rate: float = 20.0, seed: int = 7) -> LanguageModel:
    """Fit embeddings and softmax by gradient descent, then calibrate on every fifth row.

    Each step sees a random run of a text's subwords, short ones included, so that short texts are
    judged by what short texts look like.
    """
    languages = sorted(set(labels))
    k = len(languages)
    number = {lang: i for i, lang in enumerate(languages)}
    bags, ys = [], []
    for text, label in zip(texts, labels, strict=True):
        got = list(subwords(text or ""))
        if got:
            bags.append(np.concatenate(got).astype(BUCKET_TYPE))
            ys.append(number[label])
    rng = np.random.default_rng(seed)
    buckets = 1 << BUCKET_BITS
    emb = rng.normal(0, 0.1, (buckets, DIMENSIONS)).astype(np.float32)
    out = np.zeros((DIMENSIONS, k), np.float32)
    bias = np.zeros(k, np.float32)
    rows = np.arange(len(bags))
    fit = rows[rows % 5 != 0] if len(bags) >= 25 else rows
    per_epoch = max(1, -(-len(fit) // batch))
    epochs = max(epochs, -(-LEAST_STEPS // per_epoch))
    steps, done = epochs * per_epoch, 0
    for _ in range(epochs if k > 1 and len(fit) else 0):
        order = rng.permutation(fit)
        for start in range(0, len(order), batch):
            some = order[start : start + batch]
            runs = []
            for i in some:
                size = min(len(bags[i]), int(np.exp(rng.uniform(np.log(2), np.log(400)))))
                runs.append(rng.choice(bags[i], size) if size < len(bags[i]) else bags[i])
            sizes = np.array([len(r) for r in runs])
            at = np.concatenate(runs)
            firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            x = np.add.reduceat(emb[at], firsts, axis=0) / sizes[:, None].astype(np.float32)
            g = _softmax(x @ out + bias)
            g[np.arange(len(some)), [ys[i] for i in some]] -= 1
            lr = np.float32(rate * (1 - done / steps) / len(some))
            back = (g @ out.T) / sizes[:, None]
            np.subtract.at(emb, at, lr * np.repeat(back, sizes, axis=0).astype(np.float32))
            out -= (lr * 0.1) * (x.T @ g).astype(np.float32)
            bias -= (lr * 0.02) * g.sum(axis=0).astype(np.float32)
            done += 1
    model = LanguageModel(languages, emb @ out, bias)
    held = rows[rows % 5 == 0] if len(bags) >= 25 else rows
    _calibrate(model, [bags[i] for i in held], np.array([ys[i] for i in held], int))
    return model


def _calibrate(model: LanguageModel, bags: list[np.ndarray], ys: np.ndarray, lost: float = 0.0005, most: float = 0.5) -> None:
    """Temperature by likelihood; threshold that rejects at most ``lost`` of the right predictions.

    The threshold never exceeds ``most``: a language with half of the probability is accepted.
    """
    if not bags:
        return
    z = np.stack([model.table[b].mean(axis=0, dtype=np.float64) + model.bias for b in bags])
    at = np.arange(len(ys))
    grid = np.geomspace(0.2, 5.0, 41)
    nll = [-np.log(np.maximum(_softmax(z / t)[at, ys], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(nll))])
    p = _softmax(z / model.temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == ys])
    if len(right):
        model.threshold = float(min(most, right[int(lost * len(right))]))


def held_out(doc_id: Column) -> Column:
    """The test fold: crc32 of the id as text leaves 2 modulo 4; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(
    df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows_per_language: int = ROWS_PER_LANGUAGE
) -> list[tuple[str, str]]:
    """At most ``rows_per_language`` labelled rows of each language, chosen by a hash of key and text.

    Rows without text or label are not sampled; of a text over ``MAX_TEXT_CHARS`` a piece is. Rows equal
    in key and text are drawn once, rows without a key each by its text. One count per language over all
    rows sets the sampling rate; the sample itself is all that is collected.
    """
    usable = df.where(df[lang].isNotNull() & (F.length(df[text]) > 0))
    given = usable.select(df[lang].alias("lang"), df[key].cast("string").alias("key"), df[text].cast("string").alias("text"))
    counts = given.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return []
    # 24 bits of a hash against the language's rate.
    hashed = F.xxhash64("key", "text", F.lit("language"))
    wanted = F.lit(False)
    for r in counts:
        rate = min(1.0, rows_per_language / r["count"])
        wanted = wanted | ((F.col("lang") == r["lang"]) & (F.pmod(hashed, F.lit(1 << 24)) < int(rate * (1 << 24))))
    spare = F.greatest(F.length("text") - MAX_TEXT_CHARS, F.lit(0)).cast("long")
    piece = F.substring(F.col("text"), (F.pmod(hashed, spare + 1) + 1).cast("int"), F.lit(MAX_TEXT_CHARS))
    got = distinct_draws(given.where(wanted).select("lang", piece.alias("text"), hashed.alias("h")), F.col("h"), rows_per_language, "lang")
    return [(r["text"], r["lang"]) for r in sorted(got.collect(), key=lambda r: (r["h"], r["lang"], r["text"]))]


def _predictor(model, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: LanguageModel = model.value
        for batch in batches:
            got = [fitted.predict(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            added = [pa.array([g[i] for g in got], schema.field(n).type) for i, n in enumerate(("lang_pred", "score", "accepted"))]
            yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(batch.columns, schema)], *added], schema=schema)

    return run


def predict_language(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Predict the language of every whole text; nothing but the text is looked at.

    Adds ``lang_pred``, ``score`` (calibrated probability) and ``accepted``; columns of ``df`` with
    these names are replaced. A null text, or one without letters, is ``und`` with score 0 and not
    accepted. Rows are kept as they are, equal rows alike.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    ship(spark)
    added = T.StructType().add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
    keep = df.drop(*added.names)
    name = free_name(df, "_text")
    given = keep.select(*[keep[c] for c in keep.columns], df[text].cast("string").alias(name))
    out = T.StructType(given.schema.fields + added.fields)
    # The model has a fixed number of buckets: 65,536 rows of one float per language.
    return given.mapInArrow(_predictor(spark.sparkContext.broadcast(model), to_arrow_schema(out)), out).drop(name)


def fit_language_model(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> LanguageModel:
    """Train on a bounded sample of ``df``; without labelled rows every text is ``und``."""
    sample = training_sample(df, text, lang, key)
    if not sample:
        return LanguageModel([UNDETERMINED], np.zeros((1 << BUCKET_BITS, 1), np.float32), np.zeros(1, np.float32))
    return train([t for t, _ in sample], [label for _, label in sample])
