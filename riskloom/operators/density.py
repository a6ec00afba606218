"""Density clustering helpers: eps from the k-distance knee, sensitivity grid, importance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.functions.session import local_table, materialise, small_table
from riskloom.operators import sampling
from riskloom.operators.dbscan import dbscan_runs, knee, sensitivity_grid
from riskloom.operators.kmeans import importance_table, permuted_copies
from riskloom.operators.neighbours import group_silhouettes, k_distances

DEFAULT_EPS = 0.5


def choose_eps(
    df: DataFrame, id_col: str, features: str, min_samples: int = 5, n_neighbors: int = 10, sample_size: int | None = None, seed: int = 42
) -> float:
    """eps at the knee of the k-distance curve, 0.5 when there is none."""
    curve = k_distances(df, id_col, features, min_samples, n_neighbors, sample_size, seed)
    found = knee(curve.select("idx", F.col("distance").alias("value"))).collect()
    return float(found[0]["value"]) if found else DEFAULT_EPS


def _run_scores(points: DataFrame, labels: DataFrame, x: Sequence[str], keys: list[str], per_run: int | None, shared: bool = False) -> DataFrame:
    """Mean silhouette of the clustered points of each run, on at most ``per_run`` of them if given."""
    joined = points.join(labels, ["run", "id"]).where("label <> -1")
    if per_run is not None:
        order = Window.partitionBy("run").orderBy(F.md5(F.concat_ws("|", "id", F.lit("42"))))
        joined = joined.withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_run)
    return group_silhouettes(joined.withColumn("x", F.array(*x)), keys, "x", "label", shared=shared)


def parameter_sensitivity(
    df: DataFrame,
    id_col: str,
    coords: Sequence[str],
    eps: float,
    min_samples: int = 5,
    sample_size: int | None = None,
    eps_values: Sequence[float] | None = None,
    min_samples_values: Sequence[int] | None = None,
    score_size: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """``(eps, min_samples, n_clusters, n_noise, noise_pct, silhouette, recommended)`` per grid cell.

    All rows count, unless ``sample_size`` (clustering) or ``score_size`` (silhouettes) asks for a
    sample. The grid is clustered in one job, one run per cell. Silhouette is NULL below two clusters or
    when no more points than clusters are left; the best one is recommended, the first on ties.
    """
    default_eps, default_min = sensitivity_grid(eps, min_samples)
    grid = [(e, m) for e in (eps_values or default_eps) for m in (min_samples_values or default_min)]
    params = dict(enumerate(grid))
    spark = df.sparkSession
    sample = df.select(F.col(id_col).alias("id"), *coords)
    sample = sample if sample_size is None else sampling.sample_rows(sample, "id", sample_size, seed)
    each = F.explode(F.array(*[F.lit(r) for r in params])).alias("run")
    points = materialise(sample.select("id", *coords, each), "grid_points")
    labels = materialise(dbscan_runs(points, coords, params), "grid_labels")
    counts = labels.groupBy("run").agg(
        F.countDistinct(F.when(F.col("label") != -1, F.col("label"))).alias("n_clusters"),
        F.count_if(F.col("label") == -1).alias("n_noise"),
        F.count("*").alias("n"),
    )
    scores = _run_scores(points, labels, coords, ["run"], score_size, shared=True)
    table = local_table(spark, [(r, float(e), int(m)) for r, (e, m) in params.items()], "run int, eps double, min_samples int")
    usable = (F.col("n_clusters") >= 2) & (F.col("n") - F.col("n_noise") > F.col("n_clusters"))
    out = small_table(
        table.join(counts, "run")
        .join(scores, "run", "left")
        .select(
            "run",
            "eps",
            "min_samples",
            "n_clusters",
            "n_noise",
            (F.col("n_noise") * 100.0 / F.col("n")).alias("noise_pct"),
            F.when(usable, F.col("silhouette")).alias("silhouette"),
        )
    )
    best = out.where("silhouette IS NOT NULL").orderBy(F.col("silhouette").desc(), "run").first()
    chosen = F.lit(False) if best is None else F.col("run") == F.lit(best["run"])
    return out.withColumn("recommended", chosen).drop("run")


def density_importance(
    df: DataFrame,
    id_col: str,
    coords: Sequence[str],
    eps: float,
    min_samples: int = 5,
    repeats: int = 3,
    sample_size: int | None = None,
    score_size: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Loss of silhouette when a coordinate is shuffled and the sample is clustered anew.

    The untouched sample and all shuffled copies are the runs of one clustering job. A run with
    fewer than two clusters scores 0.
    """
    rows = df.select(F.col(id_col).alias("id"), F.array(*[F.col(c).cast("double") for c in coords]).alias("x"))
    sample = materialise(rows if sample_size is None else sampling.sample_rows(rows, "id", sample_size, seed), "sample")
    copies = permuted_copies(sample, "id", "x", len(coords), repeats, seed)
    run = (F.col("feature") + 1) * repeats + F.col("repeat")
    x = [f"x{i}" for i in range(len(coords))]
    points = materialise(
        copies.select(
            "feature", "repeat", "id", run.cast("int").alias("run"), *[F.get("x", F.lit(i)).alias(n) for i, n in enumerate(x)]
        ),
        "importance_points",
    )
    runs = [0] + [(f + 1) * repeats + r for f in range(len(coords)) for r in range(repeats)]
    labels = materialise(dbscan_runs(points.select("run", "id", *x), x, {r: (eps, min_samples) for r in runs}), "importance_labels")
    found = _run_scores(points, labels, x, ["run"], score_size)
    keys = points.select("run", "feature", "repeat").distinct()
    scores = small_table(keys.join(found, "run", "left").na.fill(0.0, ["silhouette"]))
    return importance_table(scores, list(coords))
