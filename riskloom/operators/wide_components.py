"""Principal components of wide tables, without a features x features matrix anywhere.

A block of random directions is multiplied by the covariance in passes over the rows: each task adds
up its part of the product, Spark adds the parts. The products of all passes span a space that soon
holds the leading components; they are read off from its small projected matrix. Memory of the
driver and of a task is features x block, never features x features.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.session import ship
from riskloom.operators.metric import vectors
from riskloom.operators.reduction import Components

TASKS = 512  # partial products of a pass, each features x block numbers
_PRODUCT = T.StructType().add("i", "integer").add("v", T.ArrayType(T.DoubleType()))


def _products(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, block = shared.value
        total = np.zeros_like(block)
        for batch in batches:
            x = vectors(batch.column("x"))
            if len(x):
                x = x - mean
                total += x.T @ (x @ block)
        kind = schema.field("v").type
        for i in range(0, len(total), 4096):
            part = total[i : i + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(i, i + len(part), dtype=np.int32)), pa.array(list(part), kind)], schema=schema)

    return run


def _scatter(rows: DataFrame, mean: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The centred rows' scatter matrix times ``block``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = rows.sparkSession.sparkContext.broadcast((mean, block))
    parts = rows.coalesce(TASKS).mapInArrow(_products(shared, to_arrow_schema(_PRODUCT)), _PRODUCT)
    sums = [F.sum(F.get("v", F.lit(j))).alias(f"s{j}") for j in range(block.shape[1])]
    out = np.zeros_like(block)
    for i, *row in parts.groupBy("i").agg(*sums).collect():
        out[i] = row
    return out


def _new_directions(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to ``basis``; directions lost in rounding are left out."""
    scale = np.linalg.norm(block, axis=0).max()
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    u = u[:, s > 1e-10 * scale]
    u = u - basis @ (basis.T @ u)
    return np.linalg.qr(u)[0] if u.shape[1] else u


def fit_wide(
    df: DataFrame,
    features: str,
    n: int = 10,
    names: Sequence[str] | None = None,
    extra: int = 8,
    passes: int = 20,
    tol: float = 1e-9,
    seed: int = 42,
) -> Components:
    """The first ``n`` components, as :meth:`Components.fit` gives them, by up to ``passes`` passes.

    Stops when no wanted variance changes by more than ``tol`` of the total, or when the directions
    found are all there are. Rows without a vector are left out; a component without variance has
    ratio 0. Same sign rule: the largest loading is positive.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(features).cast("array<double>").alias("x")).where("x IS NOT NULL")
    if rows.isEmpty():
        raise ValueError("no rows")
    stats = rows.select(Summarizer.metrics("mean", "variance", "count").summary(array_to_vector("x")).alias("s")).first()["s"]
    mean, variances, count = stats["mean"].toArray(), stats["variance"].toArray(), stats["count"]
    d, total = len(mean), float(variances.sum())
    k = min(n, d)
    fresh = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, min(d, k + extra))))[0]
    basis, image, last = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros(k)
    for _ in range(passes):
        product = _scatter(rows, mean, fresh) / max(1, count - 1)
        basis, image = np.hstack([basis, fresh]), np.hstack([image, product])
        small = basis.T @ image
        values, turns = np.linalg.eigh((small + small.T) / 2)
        found = np.maximum(values[::-1][:k], 0.0)
        settled = total <= 0 or np.abs(found - last).max() <= tol * total
        last = found
        fresh = _new_directions(product, basis)[:, : d - basis.shape[1]]
        if settled or not fresh.shape[1]:
            break
    loadings = basis @ turns[:, ::-1][:, :k]
    lead = np.argmax(np.abs(loadings), axis=0)
    loadings = loadings * np.where(loadings[lead, np.arange(k)] < 0, -1.0, 1.0)
    labels = list(names) if names is not None else [f"x{i}" for i in range(d)]
    return Components(labels, loadings, mean, variances, last / total if total > 0 else np.zeros(k))


def _scores(shared, features: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, loadings = shared.value
        kind = schema.field(len(schema) - 1).type
        for batch in batches:
            column = batch.column(features)
            known = np.flatnonzero(np.asarray(column.is_valid()))
            scores: list = [None] * batch.num_rows
            if len(known):
                found = (vectors(column.drop_null().cast(pa.list_(pa.float64()))) - mean) @ loadings
                for i, row in zip(known, found, strict=True):
                    scores[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, kind)], schema=schema)

    return run


def transform_wide(components: Components, df: DataFrame, features: str, output: str = "pc") -> DataFrame:
    """``df`` with the centred scores in ``output``, NULL where the row has no vector; nothing is shuffled."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    kept = df.drop(output)
    out = T.StructType([*kept.schema.fields, T.StructField(output, T.ArrayType(T.DoubleType()))])
    shared = df.sparkSession.sparkContext.broadcast((components.means, components.loadings))
    return kept.mapInArrow(_scores(shared, features, to_arrow_schema(out)), out)
