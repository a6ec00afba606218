"""Outlier bounds fitted once and applied anywhere: six methods, summaries and masking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expr import col, columns_of_kind, unpivot_numeric
from riskloom.functions.session import small_table
from riskloom.operators.ordering import ROW_LIMIT, exact_quantiles

# Method -> (family, argument).
METHODS = {
    "Z-score (±3)": ("z", 3.0),
    "IQR 1.5": ("iqr", 1.5),
    "Z-score (±2)": ("z", 2.0),
    "Quantile 1-99": ("quantile", (0.01, 0.99)),
    "Quantile 5-95": ("quantile", (0.05, 0.95)),
    "Full Range": ("range", None),
}
_PROBS = (0.01, 0.05, 0.25, 0.75, 0.95, 0.99)


def corrected_skewness(value: Column) -> Column:
    """Aggregate: bias-corrected sample skewness; 0 for a constant column, NULL below three values."""
    n = F.count(value).cast("double")
    raw = F.when(F.stddev_pop(value) > 0, F.skewness(value)).otherwise(0.0)
    return F.when(n > 2, raw * F.sqrt(n * (n - 1)) / (n - 2))


def _limits(method: str) -> tuple[Column, Column]:
    family, arg = METHODS[method]

    def q(p: float) -> Column:
        return F.get(F.col("q"), _PROBS.index(p))

    if family == "z":
        return F.col("mean") - arg * F.col("std"), F.col("mean") + arg * F.col("std")
    if family == "iqr":
        spread = arg * (q(0.75) - q(0.25))
        return q(0.25) - spread, q(0.75) + spread
    if family == "quantile":
        return q(arg[0]), q(arg[1])
    return F.col("min"), F.col("max")


def fit_bounds(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    methods: Sequence[str] | None = None,
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """``(method, feature, lower, upper)``. An all-null column gets NULL bounds, absent ones are skipped."""
    methods = list(methods or METHODS)
    for m in methods:
        if m not in METHODS:
            raise ValueError(f"Method {m} not found.")
    columns = [c for c in (columns or columns_of_kind(df, "strict")) if c in df.columns]
    long_df = unpivot_numeric(df, columns)
    stats = small_table(
        long_df.groupBy("feature").agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    if any(METHODS[m][0] in ("iqr", "quantile") for m in methods):
        counts = {r["feature"]: r["n"] for r in stats.select("feature", "n").collect()}
        quantiles = small_table(exact_quantiles(long_df, _PROBS, row_limit, counts))
        stats = stats.join(quantiles.select("feature", "q"), "feature", "left")
    pairs = []
    for m in methods:
        lo, hi = _limits(m)
        pairs.append(F.struct(F.lit(m).alias("method"), lo.alias("lower"), hi.alias("upper")))
    return small_table(stats.select("feature", F.inline(F.array(*pairs))).select("method", "feature", "lower", "upper"))


def bounds_dict(bounds: DataFrame, method: str) -> dict[str, tuple[float | None, float | None]]:
    rows = bounds.where(F.col("method") == method).collect()
    return {r["feature"]: (r["lower"], r["upper"]) for r in rows}


def mask_outliers(
    df: DataFrame,
    method: str | None = None,
    columns: Sequence[str] | None = None,
    bounds: Mapping[str, tuple[float | None, float | None]] | DataFrame | None = None,
) -> DataFrame:
    """Values strictly outside their bounds become NULL; rows are kept.

    Given bounds win per column, the rest is fitted on ``df`` with ``method``. A NULL bound masks
    nothing. With all bounds given this is a projection without a job.
    """
    if bounds is None and method not in METHODS:
        raise ValueError(f"Method {method} not found and no bounds provided.")
    if isinstance(bounds, DataFrame):
        rows = bounds if method is None or "method" not in bounds.columns else bounds.where(F.col("method") == method)
        bounds = {r["feature"]: (r["lower"], r["upper"]) for r in rows.collect()}
    given = dict(bounds or {})
    names = list(columns) if columns is not None else (list(given) or columns_of_kind(df, "strict"))
    names = [c for c in names if c in df.columns]
    missing = [c for c in names if c not in given]
    if missing:
        given.update(bounds_dict(fit_bounds(df, missing, [method]), method))
    out = []
    for field in df.schema.fields:
        c = col(field.name)
        if field.name in names:
            lo, hi = given[field.name]
            outside = F.lit(False)
            if lo is not None:
                outside = outside | (c < F.lit(lo))
            if hi is not None:
                outside = outside | (c > F.lit(hi))
            c = F.when(~F.coalesce(outside, F.lit(False)), c).alias(field.name)
        out.append(c)
    return df.select(*out)


def outlier_summary(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    bounds: DataFrame | None = None,
    methods: Sequence[str] | None = None,
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """One row per method and feature with counts, bounds, means and spread with and without outliers.

    One pass after the bounds: values meet the few bounds of their feature by broadcast, and the
    sums per method and feature are combined before the shuffle. Narrow aggregates keep the
    generated code small enough to be compiled. All-null columns are skipped.
    """
    columns = [c for c in (columns or columns_of_kind(df, "strict")) if c in df.columns]
    methods = list(methods or METHODS)
    if bounds is None:
        bounds = fit_bounds(df, columns, methods, row_limit)
    limits = small_table(bounds.where(F.col("method").isin(methods)).select("method", "feature", "lower", "upper"))
    rows = unpivot_numeric(df, columns).where(F.col("value").isNotNull()).join(limits, "feature")
    v = F.col("value")
    below = F.coalesce(v < F.col("lower"), F.lit(False))
    above = F.coalesce(v > F.col("upper"), F.lit(False))
    inside = F.when(~(below | above), v)
    long_out = rows.groupBy("method", "feature", "lower", "upper").agg(
        F.count("*").alias("n"),
        F.count_if(below).alias("n_below"),
        F.count_if(above).alias("n_above"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        corrected_skewness(v).alias("skewness"),
        F.avg(inside).alias("clean_mean"),
        F.stddev_samp(inside).alias("clean_std"),
    )
    change = F.when(
        F.col("clean_mean").isNotNull() & (F.col("clean_mean") != 0),
        (F.col("mean") - F.col("clean_mean")) / F.when(F.col("clean_mean") != 0, F.col("clean_mean")) * 100,
    ).otherwise(0.0)
    count = F.col("n_below") + F.col("n_above")
    return long_out.select(
        "method",
        "feature",
        count.alias("outlier_count"),
        (count * 100.0 / F.col("n")).alias("outlier_pct"),
        "lower",
        "upper",
        "n_below",
        "n_above",
        "mean",
        "clean_mean",
        change.alias("mean_pct_change"),
        "std",
        "clean_std",
        "skewness",
    ).orderBy("method", F.col("outlier_count").desc(), "feature")


def compare_methods(df: DataFrame, column: str, row_limit: int = ROW_LIMIT) -> DataFrame:
    """The methods side by side on one variable."""
    if column not in df.columns:
        raise ValueError(f"Variable {column!r} not found in dataframe.")
    return outlier_summary(df, [column], row_limit=row_limit).select(
        "method",
        "lower",
        "upper",
        "outlier_count",
        "outlier_pct",
        F.col("mean").alias("mean_with_outliers"),
        F.col("clean_mean").alias("mean_without_outliers"),
        F.col("std").alias("std_with_outliers"),
        F.col("clean_std").alias("std_without_outliers"),
    )
