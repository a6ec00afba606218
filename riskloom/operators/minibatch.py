"""Mini-batch k-means: a scalable seeded start, then batches that move centres by their own counts.

The start takes a few passes over the table and collects about ``2 k`` candidates a pass. A batch is
the rows whose hash falls in one slot of many, so it is the same under any partitioning. Only rows
of batches that are used are written, ordered by batch, so that a step reads its own files. What
comes back to the driver are sums of the size of the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.session import materialise, ship
from riskloom.operators.metric import vectors

PART = 4_000_000  # numbers in one distance matrix inside a task
_SUMS = T.StructType().add("cluster", "integer").add("n", "long").add("cost", "double").add("sums", T.ArrayType(T.DoubleType()))


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, the lowest on ties, and the squared distance to it."""
    if not len(x):
        return np.zeros(0, dtype=int), np.zeros(0)
    own = (centres * centres).sum(axis=1)
    step = max(1, PART // len(centres))
    best = np.concatenate([(own - 2.0 * (x[i : i + step] @ centres.T)).argmin(axis=1) for i in range(0, len(x), step)])
    gap = x - centres[best]
    return best, (gap * gap).sum(axis=1)


def _summed(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        k, d = centres.shape
        n, cost, sums = np.zeros(k, dtype=np.int64), np.zeros(k), np.zeros((k, d))
        for batch in batches:
            x = vectors(batch.column("x"))
            if len(x):
                best, square = nearest(x, centres)
                n += np.bincount(best, minlength=k)
                cost += np.bincount(best, square, minlength=k)
                np.add.at(sums, best, x)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()),
                pa.array(n[used]),
                pa.array(cost[used]),
                pa.array(list(sums[used]), schema.field("sums").type),
            ],
            schema=schema,
        )

    return run


def _placed(shared, features: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(features)
            known = np.asarray(column.is_valid())
            best, square = nearest(vectors(column.drop_null().cast(pa.list_(pa.float64()))), shared.value)
            cluster, distance = np.zeros(len(known), dtype=np.int32), np.zeros(len(known))
            cluster[known], distance[known] = best, np.sqrt(square)
            added = [pa.array(cluster, mask=~known), pa.array(distance, mask=~known)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema=schema)

    return run


def _totals(rows: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rows, cost, coordinate sums)`` of each centre's rows: task sums, added up by Spark."""
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = rows.sparkSession.sparkContext.broadcast(centres)
    parts = rows.select("x").mapInArrow(_summed(shared, to_arrow_schema(_SUMS)), _SUMS)
    each = parts.select("cluster", "n", "cost", F.posexplode("sums").alias("i", "v"))
    k, d = centres.shape
    n, cost, sums = np.zeros(k, dtype=np.int64), np.zeros(k), np.zeros((k, d))
    for c, i, rows_of, cost_of, v in each.groupBy("cluster", "i").agg(F.sum("n"), F.sum("cost"), F.sum("v")).collect():
        n[c], cost[c], sums[c, i] = rows_of, cost_of, v
    return n, cost, sums


def uniform(id_col: str, seed: int, draw: int = 0) -> Column:
    """A number in [0, 1) that depends on the id, the seed and the draw only."""
    return F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(seed), F.lit(draw)), F.lit(1 << 40)) / float(1 << 40)


def _weighted_start(points: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ over weighted candidates, a few times the centres wanted."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(points), p=weight / weight.sum()))]
    square = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k and (weight * square).sum() > 0:
        mass = weight * square
        chosen.append(int(rng.choice(len(points), p=mass / mass.sum())))
        square = np.minimum(square, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def start(rows: DataFrame, k: int, rounds: int = 2, seed: int = 42) -> np.ndarray:
    """Seeded start over ``rows(id, x)``: each round draws rows in proportion to their squared distance.

    A round keeps ``2 k`` rows on average. Fewer than ``k`` centres come back where fewer different
    rows were drawn.
    """
    first = rows.agg(F.min(F.struct(uniform("id", seed, -1).alias("u"), F.col("id").cast("string"), "x")).alias("r")).first()["r"]
    if first is None:
        raise ValueError("no rows to cluster")
    centres = np.asarray([first["x"]], dtype=float)
    for r in range(rounds):
        cost = float(_totals(rows, centres)[1].sum())
        if cost <= 0:
            break
        gap = KMeansCentres(centres).transform(rows, "x")
        drawn = gap.where(uniform("id", seed, r) * cost < F.col("distance") * F.col("distance") * (2 * k)).select("x").collect()
        if drawn:
            centres = np.unique(np.vstack([centres, np.asarray([d["x"] for d in drawn], dtype=float)]), axis=0)
    return _weighted_start(centres, _totals(rows, centres)[0].astype(float), k, seed)


def moved(centres: np.ndarray, seen: np.ndarray, n: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and counts after a batch: a centre is the mean of all rows it was given so far."""
    total = seen + n
    rate = np.divide(1.0, total, out=np.zeros(len(total)), where=total > 0)
    return centres + (sums - n[:, None] * centres) * rate[:, None], total


@dataclass
class KMeansCentres:
    """Fitted centres, an array of (clusters, features)."""

    centres: np.ndarray
    steps: int = 0

    def transform(self, df: DataFrame, features: str, output: str = "cluster") -> DataFrame:
        """``df`` with ``output`` and ``distance``, without a shuffle; both are NULL where the row has no vector."""
        from pyspark.sql.pandas.types import to_arrow_schema

        ship(df.sparkSession)
        kept = df.drop(output, "distance")
        out = T.StructType([*kept.schema.fields, T.StructField(output, T.IntegerType()), T.StructField("distance", T.DoubleType())])
        shared = df.sparkSession.sparkContext.broadcast(self.centres)
        return kept.mapInArrow(_placed(shared, features, to_arrow_schema(out)), out)

    def cost(self, df: DataFrame, features: str) -> float:
        """Sum of squared distances to the nearest centres."""
        rows = df.select(F.col(features).cast("array<double>").alias("x")).where("x IS NOT NULL")
        return float(_totals(rows, self.centres)[1].sum())


def batch_of(id_col: str, batches: int, seed: int = 42) -> Column:
    """The batch of a row, 0 to ``batches - 1``."""
    return F.floor(uniform(id_col, seed, 1 << 20) * batches).cast("int")


def fit_minibatch(
    df: DataFrame,
    id_col: str,
    features: str,
    k: int,
    batch_size: int = 10_000,
    steps: int = 50,
    rounds: int = 2,
    tol: float = 0.0,
    seed: int = 42,
) -> KMeansCentres:
    """Centres after up to ``steps`` batches of about ``batch_size`` rows, each batch read in turn.

    Stops once no coordinate of a centre moves by more than ``tol``. Rows without a vector are left out.
    A centre that no row is nearest to stays where it started.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(features).cast("array<double>").alias("x")).where("x IS NOT NULL")
    batches = max(1, -(-rows.count() // batch_size))
    centres = start(rows, k, rounds, seed)
    marked = rows.select("x", batch_of("id", batches, seed).alias("batch"))
    used = min(batches, steps)
    if used < batches:
        marked = marked.where(F.col("batch") < used)
    dealt = materialise(marked.repartitionByRange("batch").sortWithinPartitions("batch") if used > 1 else marked, "batches")
    seen = np.zeros(len(centres), dtype=np.int64)
    for step in range(steps):
        n, _, sums = _totals(dealt.where(F.col("batch") == step % used), centres)
        after, seen = moved(centres, seen, n, sums)
        change, centres = np.abs(after - centres).max(), after
        if change <= tol:
            return KMeansCentres(centres, step + 1)
    return KMeansCentres(centres, steps)
