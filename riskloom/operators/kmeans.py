"""k-means: fit, assignment, elbow sweep, centroid distances and permutation importance."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.functions.expr import col
from riskloom.functions.session import local_table, materialise, small_table
from riskloom.operators import sampling
from riskloom.operators.minibatch import fit_minibatch
from riskloom.operators.neighbours import group_silhouettes, mean_silhouettes

MAX_CLUSTERS = 2_000


def _with_vector(df: DataFrame, features: str) -> DataFrame:
    return df.withColumn("_v", array_to_vector(F.col(features).cast("array<double>")))


def fit_kmeans(
    df: DataFrame, features: str, k: int, id_col: str | None = None, sample_size: int | None = None, seed: int = 42
) -> tuple[KMeansModel, DataFrame]:
    """``(model, df + cluster)``: optional sample for the fit, prediction on every row."""
    fit_rows = sampling.sample_rows(df, id_col, sample_size, seed) if sample_size is not None else df
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(
        _with_vector(fit_rows, features).select("_v")
    )
    return model, model.transform(_with_vector(df, features)).drop("_v")


def kmeans_labels(
    df: DataFrame, features: str, k: int, components: str | None = None, n_components: int = 3, **kwargs
) -> tuple[KMeansModel, DataFrame]:
    """Labels from the original features, plus ``pc_cluster`` from the first components when given."""
    model, out = fit_kmeans(df, features, k, **kwargs)
    if components is not None:
        sliced = out.withColumn("_pc", F.slice(components, 1, n_components)).withColumnRenamed("cluster", "_cluster")
        _, out = fit_kmeans(sliced, "_pc", k, **kwargs)
        out = out.withColumnRenamed("cluster", "pc_cluster").withColumnRenamed("_cluster", "cluster").drop("_pc")
    return model, out


def centroids(df: DataFrame, label: str, features: str) -> DataFrame:
    """``(cluster, size, centre array)`` as means per cluster; the coordinates are summed before any shuffle."""
    width = df.select(F.size(features).alias("d")).first()["d"]
    aggs = [F.avg(F.get(F.col(features), F.lit(i)).cast("double")).alias(f"m{i}") for i in range(width)]
    return df.groupBy(col(label).alias("cluster")).agg(F.count("*").alias("size"), *aggs).select(
        "cluster", "size", F.array(*[f"m{i}" for i in range(width)]).alias("centre")
    )


def _collected(centres: DataFrame) -> list:
    rows = centres.limit(MAX_CLUSTERS + 1).collect()
    if len(rows) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters")
    return sorted(rows, key=lambda r: r["cluster"])


def assign_nearest(df: DataFrame, features: str, centres: DataFrame, output: str = "cluster") -> DataFrame:
    """Nearest given centre per row (lowest cluster on ties) and its distance, without a shuffle."""
    rows = _collected(centres)
    kind = centres.schema["cluster"].dataType.simpleString()
    text = json.dumps([{"c": r["cluster"], "centre": list(r["centre"])} for r in rows])
    # One constant, folded at planning time.
    table = F.from_json(F.lit(text), f"array<struct<c: {kind}, centre: array<double>>>")
    x = F.col(features).cast("array<double>")
    best = F.array_min(
        F.transform(
            table,
            lambda t: F.struct(
                F.aggregate(
                    F.zip_with(x, t["centre"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v
                ).alias("d2"),
                t["c"].alias("c"),
            ),
        )
    )
    nearest = df.withColumn("_best", best)
    return nearest.withColumns({output: F.col("_best.c"), "distance": F.sqrt(F.col("_best.d2"))}).drop("_best")


def elbow(
    df: DataFrame,
    id_col: str,
    features: str,
    ks: Sequence[int] = range(2, 9),
    sample_size: int | None = None,
    seed: int = 42,
    batch_size: int | None = None,
    steps: int = 50,
) -> DataFrame:
    """``(k, inertia, silhouette)``: cost on all rows, mean silhouette (of a sample if asked for), 0 for k = 1.

    With ``batch_size`` the centres are fitted by up to ``steps`` mini-batches, otherwise by passes over all rows.
    The silhouettes of all ``ks`` come from one pass over the pairs of rows.
    """
    rows = materialise(df.select(id_col, F.col(features).cast("array<double>").alias("x")), "elbow")
    out, scored = [], None
    for i, k in enumerate(ks):
        if k == 1:
            centre = centroids(rows.withColumn("c", F.lit(0)), "c", "x")
            inertia = assign_nearest(rows, "x", centre).agg(F.sum(F.col("distance") * F.col("distance")).alias("s")).first()["s"]
            out.append((1, float(inertia), i))
            continue
        if batch_size is None:
            model, labelled = fit_kmeans(rows, "x", k, seed=seed)
            inertia = model.summary.trainingCost
        else:
            model = fit_minibatch(rows, id_col, "x", k, batch_size, steps, seed=seed)
            labelled, inertia = model.transform(rows, "x").drop("distance"), model.cost(rows, "x")
        each = labelled.select(F.lit(i).alias("i"), F.col(id_col).alias("id"), "x", "cluster")
        if sample_size is not None:
            each = sampling.stratified_sample(each, "id", "cluster", sample_size, seed)
        scored = each if scored is None else scored.unionByName(each)
        out.append((int(k), float(inertia), i))
    means = {} if scored is None else mean_silhouettes(materialise(scored, "labelled"), ["i"])
    out = [(k, inertia, 0.0 if k == 1 else means.get((i,))) for k, inertia, i in out]
    return local_table(df.sparkSession, out, "k int, inertia double, silhouette double")


def centroid_distances(spark: SparkSession, centres: DataFrame) -> DataFrame:
    """``(cluster_a, cluster_b, distance)`` for a < b: all pairs of centres are the result itself."""
    kept = materialise(centres.select("cluster", "centre"), "centres")
    a, b = (kept.select(F.col("cluster").alias(f"cluster_{n}"), F.col("centre").alias(f"x_{n}")) for n in "ab")
    squares = F.zip_with("x_a", "x_b", lambda p, q: (p - q) * (p - q))
    distance = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, v: s + v))
    return a.join(b, F.col("cluster_a") < F.col("cluster_b")).select("cluster_a", "cluster_b", distance.alias("distance"))


def centroid_sizes(centres: DataFrame) -> DataFrame:
    """``(cluster, size, scaled)``: sizes relative to the largest, times 100."""
    sizes = small_table(centres.select("cluster", "size"))
    largest = sizes.agg(F.max("size").alias("m")).first()["m"]
    return sizes.withColumn("scaled", F.col("size") * 100.0 / F.lit(largest))


def permuted_copies(sample: DataFrame, id_col: str, features: str, n_features: int, repeats: int, seed: int = 42) -> DataFrame:
    """``(feature, repeat, id, x)``: the sample once per feature and repeat with that feature shuffled.

    ``feature`` -1 is the untouched sample. Two hash orders of the (bounded) sample are matched by
    rank, so every value is used exactly once.
    """
    copies = F.explode(
        F.array(
            *[
                F.struct(F.lit(f).alias("feature"), F.lit(r).alias("repeat"))
                for f in range(n_features)
                for r in range(repeats)
            ]
        )
    )
    base = sample.select(F.col(id_col).alias("id"), F.col(features).cast("array<double>").alias("x"))
    spread = base.select("*", copies.alias("t")).select("id", "x", "t.feature", "t.repeat")
    group = ["feature", "repeat"]
    token = F.md5(F.concat_ws("|", F.col("id").cast("string"), F.col("feature"), F.col("repeat"), F.lit(seed)))
    place = F.row_number().over(Window.partitionBy(*group).orderBy("id"))
    drawn = F.row_number().over(Window.partitionBy(*group).orderBy(token, "id"))
    givers = spread.select(*group, drawn.alias("pos"), F.get("x", F.col("feature")).alias("v"))
    takers = spread.select("id", "x", *group, place.alias("pos"))
    swapped = takers.join(givers, [*group, "pos"]).select(
        *group, "id", F.transform("x", lambda a, i: F.when(i == F.col("feature"), F.col("v")).otherwise(a)).alias("x")
    )
    return base.select(F.lit(-1).alias("feature"), F.lit(0).alias("repeat"), "id", "x").unionByName(swapped)


def importance_table(scores: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop of the score per feature, mean and population deviation over repeats, largest first."""
    base = scores.where("feature = -1").first()["silhouette"]
    named = local_table(scores.sparkSession, list(enumerate(names)), "feature int, name string")
    drop = F.lit(base) - F.col("silhouette")
    return (
        scores.where("feature >= 0")
        .groupBy("feature")
        .agg(F.avg(drop).alias("importance"), F.stddev_pop(drop).alias("std"))
        .join(named, "feature")
        .select(F.col("name").alias("feature"), "importance", "std")
        .orderBy(F.col("importance").desc(), "feature")
    )


def kmeans_importance(
    model: KMeansModel, df: DataFrame, id_col: str, features: str, names: Sequence[str], repeats: int = 3, sample_size: int | None = None, seed: int = 42
) -> DataFrame:
    """Permutation importance: loss of silhouette when a feature is shuffled and rows are assigned anew.

    All features and repeats are scored in one job over copies of the rows, or of a sample if asked for.
    """
    rows = df.select(id_col, features)
    sample = materialise(rows if sample_size is None else sampling.sample_rows(rows, id_col, sample_size, seed), "sample")
    copies = permuted_copies(sample, id_col, features, len(names), repeats, seed)
    labelled = model.transform(_with_vector(copies, "x")).drop("_v")
    scores = small_table(group_silhouettes(labelled, ["feature", "repeat"], "x", "cluster"))
    return importance_table(scores, names)
