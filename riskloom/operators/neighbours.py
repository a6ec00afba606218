"""Silhouettes and k-distances.

Silhouettes need every pair of rows: each block of rows meets a stream of all blocks in one task, which keeps
sums per row and cluster, so no pair is ever emitted, no row is copied, and only the clusters' sizes pass
through the driver. k-distances come from the pruned nearest-neighbour join of ``metric``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskloom.functions.session import local_table, materialise, ship, small_table
from riskloom.operators import blocks, metric, sampling
from riskloom.operators.ordering import running_totals

BLOCK_ROWS = 4_000  # rows of a block
_CLUSTERS = 500  # clusters whose moments a row looks at together


def block_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], block_rows: int = BLOCK_ROWS):
    """Both tables cut into blocks by a hash of ``id``, every block of one met with every block of the other.

    Returns a cogrouped pair for ``applyInPandas``, one group for each ``(keys, _i, _j)``. Rows are
    copied once per block of the other side, so a task never holds more than two blocks.
    """
    ship(left.sparkSession)
    sizes = [df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0 for df in (left, right)]
    n_left, n_right = (max(1, -(-n // block_rows)) for n in sizes)

    def cut(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int").alias(own)
        return df.select("*", mine, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))

    by = [*keys, "_i", "_j"]
    return cut(left, "_i", n_left, "_j", n_right).groupBy(*by).cogroup(cut(right, "_j", n_right, "_i", n_left).groupBy(*by))


def _packed_points(columns: pa.Table) -> dict:
    """Rows ``(id, x, code)`` of a block as places ``(id, x)``, ordered by the clusters they are in.

    Places that are in the same clusters, equally often, are a set: ``starts`` are the first places of the
    sets, ``set_at``, ``code`` and ``w`` list the clusters of each and how often its places are in them.
    """
    ids, x, code = columns["id"].combine_chunks(), blocks.matrix(columns["x"]), columns["code"].to_numpy()
    known = ids.dictionary_encode()
    named = known.indices.fill_null(len(known.dictionary)).to_numpy(zero_copy_only=False)
    place, first = np.arange(len(x)), np.arange(len(x))
    if len(np.unique(named)) < len(x):
        both = np.column_stack([named.astype("float64"), x + 0.0])
        _, first, place = np.unique(both, axis=0, return_index=True, return_inverse=True)
        place = place.ravel()
    pairs, w = np.unique(np.column_stack([place, code]), axis=0, return_counts=True)
    begin = np.flatnonzero(np.r_[True, pairs[1:, 0] != pairs[:-1, 0]])
    each = np.split(np.column_stack([pairs[:, 1], w]), begin[1:])
    sets = {}
    own = np.array([sets.setdefault(e.tobytes(), len(sets)) for e in each])
    order = np.argsort(own, kind="stable")
    starts = np.flatnonzero(np.r_[True, own[order][1:] != own[order][:-1]])
    held = [np.frombuffer(k, "i8").reshape(-1, 2) for k in sets]
    lists = np.concatenate(held)
    return {
        "ids": blocks.listed(ids.take(pa.array(first[order]))),
        "x": blocks.raw(x[first[order]], "f8"),
        "starts": blocks.raw(starts, "i8"),
        "set_at": blocks.raw(np.repeat(np.arange(len(held)), [len(h) for h in held]), "i8"),
        "code": blocks.raw(lists[:, 0], "i8"),
        "w": blocks.raw(lists[:, 1], "i8"),
    }


def _scores(sums: np.ndarray, n: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Silhouettes from each row's sums of distances to the clusters of sizes ``n``, and which rows have one."""
    at = np.arange(len(sums))
    alone = n[own] <= 1
    near = sums[at, own] / np.maximum(n[own] - 1, 1)
    means = sums / n
    means[at, own] = np.inf
    far = means.min(axis=1) if sums.shape[1] else np.full(len(sums), np.inf)
    top = np.maximum(near, far)
    value = np.divide(far - near, top, out=np.zeros(len(sums)), where=top != 0)
    return np.where(alone, 0.0, value), np.full(len(sums), len(n) > 1)


def _silhouettes(rows: DataFrame, keys: Sequence[str], block_rows: int, shared: bool = False) -> DataFrame:
    """``(keys..., id, cluster, silhouette)`` of ``(keys..., id, x, cluster)``; keys with one cluster are left out.

    ``shared`` says that a row has the same ``x`` under all keys: distances are then measured once for all of them.
    A task keeps a sum for each of its rows and clusters; the clusters' sizes are collected. ``rows`` are read twice.
    """
    keys = list(keys)
    spark = rows.sparkSession
    rows = rows.select(*keys, "id", "x", "cluster")
    for c in [*keys, "cluster"]:
        rows = rows.where(F.col(c).isNotNull())
    kinds = {c: rows.schema[c].dataType for c in [*keys, "id", "cluster"]}
    found = sorted(rows.groupBy(*keys, "cluster").agg(F.count("*").alias("n")).collect(), key=lambda r: tuple(r)[:-1])
    out = T.StructType([T.StructField(c, kinds[c]) for c in [*keys, "id", "cluster"]]).add("silhouette", "double")
    if not found:
        return spark.createDataFrame([], out)
    runs = list(dict.fromkeys(tuple(r)[: len(keys)] for r in found))
    group = {run: 0 if shared else i for i, run in enumerate(runs)}
    named, spans, sizes, rows_of = [], {}, {}, {}
    for r in found:
        run = tuple(r)[: len(keys)]
        g = group[run]
        n = sizes.setdefault(g, [])
        spans.setdefault(g, {}).setdefault(run, [len(n), len(n)])[1] += 1
        named.append((g, len(n), *run, r["cluster"]))
        n.append(r["n"])
        rows_of[g, run] = rows_of.get((g, run), 0) + r["n"]
    table = local_table(spark, named, T.StructType([T.StructField("g", T.IntegerType()), T.StructField("code", T.LongType()), *[T.StructField(c, kinds[c]) for c in [*keys, "cluster"]]]))
    held = {g: ([tuple(s) for s in spans[g].values()], np.array(sizes[g], dtype="float64")) for g in sizes}
    known = spark.sparkContext.broadcast(held)
    largest = {g: max(v for (h, _), v in rows_of.items() if h == g) for g in sizes}
    counts = blocks.block_counts(rows, largest, block_rows, {g: len(n) for g, n in sizes.items()})

    pack = T.StructType().add("g", "integer").add("block", "integer").add("ids", T.ArrayType(kinds["id"]))
    for c in ("x", "starts", "set_at", "code", "w"):
        pack = pack.add(c, "binary")
    dealt = blocks.packed(rows.join(table, [*keys, "cluster"]).select("g", "id", "x", "code"), counts, _packed_points, pack)

    def points(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        x = blocks.numbers(block["x"]).reshape(len(block["ids"].values), -1)
        return x, *[blocks.numbers(block[c], "i8") for c in ("starts", "set_at", "code", "w")]

    def start(block: dict) -> dict:
        x, starts, set_at, code, w = points(block)
        g = block["g"].as_py()
        return {"g": g, "ids": block["ids"].values, "x": x, "sets": (starts, set_at, code, w), "sums": np.zeros((len(x), len(known.value[g][1])))}

    def meet(state: dict, block: dict) -> None:
        x, starts, set_at, code, w = points(block)
        weight = np.zeros((len(starts), state["sums"].shape[1]))
        weight[set_at, code] = w
        for low, high, d in blocks.distance_tiles(state["x"], x):
            state["sums"][low:high] += np.add.reduceat(d, starts, axis=1) @ weight

    def finish(state: dict) -> dict:
        spans, n = known.value[state["g"]]
        starts, set_at, code, w = state["sets"]
        ids = state["ids"].dictionary_encode()
        named = ids.indices.fill_null(len(ids.dictionary)).to_numpy(zero_copy_only=False)
        sets = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(named)]))
        entries = np.bincount(set_at, minlength=len(starts))
        skip = np.r_[0, np.cumsum(entries)]
        at = np.repeat(np.arange(len(named)), entries[sets])
        entry = skip[sets[at]] + np.arange(len(at)) - np.repeat(np.r_[0, np.cumsum(entries[sets])[:-1]], entries[sets])
        code, w = code[entry], w[entry]
        rows_at, codes, values = [], [], []
        for low, high in spans:
            own = np.flatnonzero((code >= low) & (code < high))
            if not len(own):
                continue
            # Rows of one id and cluster are one.
            _, first, same = np.unique(np.column_stack([named[at[own]], code[own]]), axis=0, return_index=True, return_inverse=True)
            part = state["sums"][at[own], low:high] * w[own][:, None]
            if len(first) < len(own):
                total = np.zeros((len(first), high - low))
                np.add.at(total, same.ravel(), part)
            else:
                first, total = np.arange(len(own)), part
            value, has = _scores(total, n[low:high], code[own][first] - low)
            rows_at.append(at[own][first][has])
            codes.append(code[own][first][has])
            values.append(value[has])
        rows_at, codes, values = (np.concatenate(v) if v else np.empty(0, k) for v, k in ((rows_at, "i8"), (codes, "i8"), (values, "f8")))
        return {"g": pa.array(np.full(len(values), state["g"]), pa.int32()), "id": state["ids"].take(pa.array(rows_at)), "code": pa.array(codes), "silhouette": pa.array(values)}

    scored = T.StructType().add("g", "integer").add("id", kinds["id"]).add("code", "long").add("silhouette", "double")
    return blocks.streamed(dealt, dealt, start, meet, finish, scored).join(table, ["g", "code"]).select(*keys, "id", "cluster", "silhouette")


def silhouette_samples(
    df: DataFrame,
    id_col: str,
    features: str,
    label: str,
    sample_size: int | None = None,
    drop_noise: bool = False,
    seed: int = 42,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(id, cluster, silhouette)`` per point, exact Euclidean; empty if there is one cluster only.

    All rows, unless ``sample_size`` asks for a sample in proportion to the clusters. ``drop_noise``
    leaves out label -1. ``features`` is an array column; ids have to be unique.
    """
    rows = df.where(F.col(label) != -1) if drop_noise else df
    rows = rows.select(F.col(id_col).alias("id"), F.col(features).cast("array<double>").alias("x"), F.col(label).alias("cluster"))
    if sample_size is not None:
        rows = sampling.stratified_sample(rows, "id", "cluster", sample_size, seed)
    return _silhouettes(materialise(rows, "points"), [], block_rows).withColumnRenamed("id", id_col)


def mean_silhouettes(rows: DataFrame, keys: Sequence[str], block_rows: int = BLOCK_ROWS) -> dict[tuple, float]:
    """Mean silhouette of each labelling ``keys`` of the same points, ``(keys..., id, x, cluster)``; none below two clusters.

    Distances are measured once for all labellings. ``rows`` are read twice.
    """
    means = _silhouettes(rows, keys, block_rows, shared=True).groupBy(*keys).agg(F.avg("silhouette").alias("s"))
    return {tuple(r)[:-1]: float(r["s"]) for r in means.collect()}


def squared_silhouettes(df: DataFrame, id_col: str, features: str, label: str, drop_noise: bool = False) -> DataFrame:
    """``(id, cluster, silhouette)`` with squared Euclidean distances, in two aggregates for any number of rows.

    Not the silhouette of :func:`silhouette_samples`: distances are squared before they are averaged.
    The sum of squared distances from a row to a cluster follows from the cluster's count, sum and sum
    of squares, so no rows meet: a row looks at the moments of all clusters, some hundred at a time. A cluster of one scores 0; empty if there is one cluster only; rows without a
    vector, label or id are left out. Coordinates are taken from the mean of all rows to keep digits.
    """
    rows = df.where(F.col(label) != -1) if drop_noise else df.where(F.col(label).isNotNull())
    rows = rows.select(F.col(id_col).alias("id"), F.col(features).cast("array<double>").alias("x"), F.col(label).alias("cluster"))
    rows = materialise(rows.where("id IS NOT NULL AND x IS NOT NULL"), "points")
    width = rows.select(F.size("x").alias("d")).first()
    each = range(width["d"] if width else 0)
    centre = rows.agg(*[F.avg(F.get("x", F.lit(i))).alias(f"m{i}") for i in each], F.count("*").alias("n")).first()
    if not centre["n"]:
        return rows.select(F.col("id").alias(id_col), "cluster", F.lit(0.0).alias("silhouette"))
    shift = F.from_json(F.lit(json.dumps([centre[f"m{i}"] for i in each])), "array<double>")
    moved = rows.select("id", "cluster", F.zip_with("x", shift, lambda v, m: v - m).alias("x"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    sums = [F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in each]
    moments = moved.groupBy(F.col("cluster").alias("other")).agg(F.count("*").alias("n"), F.sum(dot(F.col("x"), F.col("x"))).alias("q"), *sums)
    moments = materialise(moments.select("other", "n", "q", F.array(*[f"s{i}" for i in each]).alias("s")), "moments")
    blocks = max(1, -(-moments.count() // _CLUSTERS))
    dealt = moments.withColumn("block", F.pmod(F.xxhash64("other"), F.lit(blocks)).cast("int"))
    dealt = small_table(dealt.groupBy("block").agg(F.collect_list(F.struct("other", "n", "q", "s")).alias("c")), 64)
    met = moved.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(dealt, "block")
    square = dot(F.col("x"), F.col("x"))
    far = F.transform(
        "c", lambda c: F.struct(c["other"].alias("other"), c["n"].alias("n"), F.greatest(c["n"] * square - 2 * dot(F.col("x"), c["s"]) + c["q"], F.lit(0.0)).alias("t"))
    )
    own = F.filter("far", lambda c: (c["other"] == F.col("cluster")) & (c["n"] > 1))
    others = F.filter("far", lambda c: c["other"] != F.col("cluster"))
    near = met.withColumn("far", far).select(
        "id", "cluster", F.array_max(F.transform(own, lambda c: c["t"] / (c["n"] - 1))).alias("a"), F.array_min(F.transform(others, lambda c: c["t"] / c["n"])).alias("b")
    )
    if blocks > 1:
        near = near.groupBy("id", "cluster").agg(F.max("a").alias("a"), F.min("b").alias("b"))
    value = F.when(F.col("a").isNull(), 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return near.where("b IS NOT NULL").select(F.col("id").alias(id_col), "cluster", value.alias("silhouette"))


def mean_silhouette(samples: DataFrame) -> DataFrame:
    """Mean, least and largest silhouette over all points and per cluster (cluster NULL = all)."""
    return samples.rollup("cluster").agg(
        F.avg("silhouette").alias("mean_silhouette"),
        F.min("silhouette").alias("min_silhouette"),
        F.max("silhouette").alias("max_silhouette"),
        F.count("*").alias("n"),
    )


def k_distances(
    df: DataFrame,
    id_col: str,
    features: str,
    min_samples: int = 5,
    n_neighbors: int = 10,
    sample_size: int | None = None,
    seed: int = 42,
    block_rows: int = metric.BLOCK_ROWS,
) -> DataFrame:
    """``(idx, id, distance)``: distance to the ``min_samples``-th neighbour, itself included, falling.

    All rows, unless ``sample_size`` asks for a sample; rows without a vector or with a gap in it are
    left out. Equal vectors are one weighted place. A place visits only the cells that can hold one of
    its neighbours; places along the curve come from prefix sums, not from one sorted task.
    """
    if n_neighbors < min_samples:
        raise ValueError("n_neighbors must be at least min_samples")
    rows = df.select(F.col(id_col).alias("id"), F.col(features).cast("array<double>").alias("x"))
    rows = rows.where(F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    if sample_size is not None:
        rows = sampling.sample_rows(rows, "id", sample_size, seed)
    rows = materialise(rows, "points")
    if rows.limit(n_neighbors).count() < n_neighbors:
        raise ValueError("fewer rows than neighbours asked for")
    places = rows.groupBy("x").agg(F.count("*").cast("double").alias("w"), F.min("id").alias("id"))
    places = materialise(places.select(F.lit(0).alias("g"), "id", "x", F.array("w").alias("v")), "places")
    near = metric.nearest_rows(places.select("g", "id", "x"), places, min_samples, block_rows)
    start = F.struct(F.lit(0.0).alias("w"), F.lit(None).cast("double").alias("d2"))
    walked = F.aggregate(
        "near",
        start,
        lambda s, p: F.struct(
            (s["w"] + p["v"][0]).alias("w"),
            F.coalesce(s["d2"], F.when(s["w"] + p["v"][0] >= min_samples, p["d2"])).alias("d2"),
        ),
    )
    reached = near.select(F.col("id").alias("place"), F.sqrt(walked["d2"]).alias("distance"))
    # A place may hold a large part of all rows; the join's other side has one row for it, which can be copied.
    known = places.select(F.col("id").alias("place"), F.col("x").alias("at")).join(reached, "place")
    measured = materialise(rows.join(known, rows["x"] == F.col("at")).select("id", "distance", F.lit(1).alias("one")), "curve")
    falling = measured.withColumn("key", -F.col("distance"))
    upto = running_totals(falling.withColumn("_all", F.lit(0)), ["_all"], "key", ["one"]).select("key", (F.col("cum_one") - F.col("one")).alias("before"))
    tie = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    placed = falling.join(upto, "key").withColumn("idx", (F.col("before") + tie - 1).cast("int"))
    return placed.select("idx", F.col("id").alias(id_col), "distance")


def group_silhouettes(df: DataFrame, keys: Sequence[str], features: str, label: str, id_col: str = "id", block_rows: int = BLOCK_ROWS, shared: bool = False) -> DataFrame:
    """``(keys..., silhouette)``: mean silhouette of each group; 0 below two clusters.

    ``shared``: a row has the same features in all groups, and its distances are measured once.
    """
    names = list(keys)
    rows = df.select(*names, F.col(id_col).alias("id"), F.col(features).cast("array<double>").alias("x"), F.col(label).alias("cluster"))
    rows = materialise(rows, "groups")
    means = _silhouettes(rows, names, block_rows, shared).groupBy(*names).agg(F.avg("silhouette").alias("silhouette"))
    return rows.select(*names).distinct().join(means, names, "left").na.fill(0.0, ["silhouette"])
