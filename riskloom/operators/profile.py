"""Descriptive tables: distributions, correlation, histograms, box statistics, summaries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.functions.expr import col, columns_of_kind, top_n, unpivot_numeric
from riskloom.functions.session import local_table, ship, small_table
from riskloom.operators.ordering import ROW_LIMIT, bin_counts, exact_quantiles


def target_distribution(df: DataFrame, target: str, keep_null: bool = True) -> DataFrame:
    """Rows per class; the NULL class is a row of its own unless ``keep_null`` is off."""
    rows = df if keep_null else df.where(col(target).isNotNull())
    return rows.groupBy(col(target).alias("target")).agg(F.count("*").alias("n"))


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Full Pearson matrix in long form ``(row, col, i, j, corr)``; pairs with a null are left out pairwise.

    Each task adds up the pair sums of its rows, shifted by the column means, as matrix products,
    and the sums are merged. A constant column has no correlation.
    """
    columns = list(columns or columns_of_kind(df))
    spark = df.sparkSession
    sums = small_table(_pair_sums(df, columns))
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    vy = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    varies = (vx > 1e-12 * F.col("sxx")) & (vy > 1e-12 * F.col("syy"))
    corr = F.when(varies & (F.col("i") == F.col("j")), 1.0).when(varies, F.try_divide(cov, F.sqrt(vx * vy)))
    corr = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), corr))
    values = sums.where("n > 0").select("i", "j", F.when(varies, corr).alias("corr"))
    names = local_table(spark, list(enumerate(columns)), "k int, name string")
    grid = names.select(F.col("k").alias("i"), F.col("name").alias("row"), F.explode(F.sequence(F.lit(0), F.lit(len(columns) - 1))).alias("j"))
    grid = grid.join(names.select(F.col("k").alias("j"), F.col("name").alias("col")), "j")
    return grid.join(values, ["i", "j"], "left").select("row", "col", "i", "j", "corr")


def _pair_sums(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(i, j, n, sx, sy, sxx, syy, sxy)`` over rows having both values, shifted by the column means."""
    ship(df.sparkSession)
    picked = df.select(*[col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    means = picked.agg(*[F.avg(c).alias(c) for c in picked.columns]).first()
    shift = np.array([0.0 if means[k] is None else means[k] for k in range(len(columns))])
    d = len(columns)
    ii, jj = (g.ravel().astype("int32") for g in np.meshgrid(np.arange(d), np.arange(d), indexing="ij"))

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, d, d))
        for b in batches:
            x = b.to_numpy(dtype="float64") - shift
            have = ~np.isnan(x)
            x, m = np.where(have, x, 0.0), have.astype("float64")
            sq = x * x
            total += np.stack([m.T @ m, x.T @ m, m.T @ x, sq.T @ m, m.T @ sq, x.T @ x])
        yield pd.DataFrame(dict(zip(["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"], [ii, jj, *(t.ravel() for t in total)])))

    parts = picked.mapInPandas(add_up, "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double")
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])


def lower_triangle(pairs: DataFrame) -> DataFrame:
    """Cells on and above the diagonal become 0, not null."""
    return pairs.withColumn("corr", F.when(F.col("i") > F.col("j"), F.col("corr")).otherwise(F.lit(0.0)))


def histograms(df: DataFrame, columns: Sequence[str], bins: int = 30, group: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram of each column; groups share a column's edges."""
    return bin_counts(unpivot_numeric(df, columns, keep=group), ["feature"], bins, group)


def box_stats(df: DataFrame, columns: Sequence[str], row_limit: int = ROW_LIMIT) -> DataFrame:
    """Quartiles, whisker ends (the last points within 1.5 IQR) and the number of points outside."""
    long_df = unpivot_numeric(df, columns).where(F.col("value").isNotNull())
    quart = small_table(exact_quantiles(long_df, (0.25, 0.5, 0.75), row_limit)).select(
        "feature",
        F.get("q", F.lit(0)).alias("q1"),
        F.get("q", F.lit(1)).alias("median"),
        F.get("q", F.lit(2)).alias("q3"),
    )
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(lo, hi)
    return (
        long_df.join(quart, "feature")
        .groupBy("feature")
        .agg(
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outside"),
        )
    )


def dataset_summary(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False, row_limit: int = ROW_LIMIT) -> DataFrame:
    """Per column: rows, missing, distinct; for numbers also min, max, mean, std and quartiles.

    Distinct values are counted by a two-step group-by, so a value holding most of the rows is
    merged before the shuffle. ``approx=True`` uses a sketch instead.
    """
    columns = list(columns or [*columns_of_kind(df), *columns_of_kind(df, "categorical")])
    numeric = [c for c in columns if c in set(columns_of_kind(df))]
    texts = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), col(c).cast("string").alias("text")) for c in columns]))
    long_text = df.select(texts)
    if approx:
        base = long_text.groupBy("feature").agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.col("text").isNull()).alias("n_missing"),
            F.approx_count_distinct("text").alias("n_distinct"),
        )
    else:
        base = (
            long_text.groupBy("feature", "text")
            .agg(F.count("*").alias("c"))
            .groupBy("feature")
            .agg(
                F.sum("c").alias("n_rows"),
                F.coalesce(F.sum(F.when(F.col("text").isNull(), F.col("c"))), F.lit(0)).alias("n_missing"),
                F.count("text").alias("n_distinct"),
            )
        )
    empty = [F.lit(None).cast("double").alias(c) for c in ("min", "max", "mean", "std", "q25", "median", "q75")]
    if not numeric:
        return base.select("*", *empty)
    long_num = unpivot_numeric(df, numeric)
    moments = long_num.groupBy("feature").agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )
    quart = small_table(exact_quantiles(long_num, (0.25, 0.5, 0.75), row_limit)).select(
        "feature",
        F.get("q", F.lit(0)).alias("q25"),
        F.get("q", F.lit(1)).alias("median"),
        F.get("q", F.lit(2)).alias("q75"),
    )
    return base.join(small_table(moments), "feature", "left").join(quart, "feature", "left")


def cluster_profile(df: DataFrame, label: str, features: Sequence[str] | None = None, top: int = 10) -> DataFrame:
    """Size, percent (1 decimal) and feature means (3 decimals) per cluster.

    With more than ``top`` features only those of largest variance are shown.
    """
    features = [c for c in (features or columns_of_kind(df)) if c != label]
    if len(features) > top:
        spread = df.agg(*[F.var_samp(col(c).cast("double")).alias(c) for c in features]).first()
        ranked = sorted(features, key=lambda c: (-(spread[c] if spread[c] is not None else -1.0), features.index(c)))
        features = ranked[:top]
    stats = small_table(
        df.groupBy(col(label).alias("cluster")).agg(F.count("*").alias("size"), *[F.avg(col(c)).alias(c) for c in features])
    )
    total = stats.agg(F.sum("size").alias("n")).first()["n"] or 1
    return stats.select(
        "cluster",
        "size",
        (F.rint(F.col("size") / F.lit(total) * 1000) / 10).alias("pct"),
        *[(F.rint(col(c) * 1000) / 1000).alias(c) for c in features],
    )


def cluster_sizes(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per cluster; label -1 is named Noise."""
    counts = small_table(df.groupBy(col(label).alias("cluster")).agg(F.count("*").alias("size")))
    total = counts.agg(F.sum("size").alias("n")).first()["n"] or 1
    return counts.select(
        "cluster",
        F.when(F.col("cluster") == -1, "Noise").otherwise(F.concat(F.lit("Cluster "), F.col("cluster").cast("string"))).alias("name"),
        "size",
        (F.col("size") * 100.0 / F.lit(total)).alias("pct"),
    )


def pivot_grid(df: DataFrame, index: str, columns: str, value: str) -> DataFrame:
    """Long results to a grid: one row per ``index``, one column per ``columns`` value."""
    return df.groupBy(index).pivot(columns).agg(F.first(value)).orderBy(index)


def ranked_features(df: DataFrame, by: str, name: str, n: int) -> DataFrame:
    """The ``n`` best rows with their 1-based rank."""
    best = top_n(df, by, n, name)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.col(by).desc_nulls_last(), F.col(name))))


def write_feature_list(ranked: DataFrame, path: str) -> None:
    """Save a ranked top-n table as JSON lines; the table is at most n rows."""
    ranked.coalesce(1).write.mode("overwrite").json(path)
