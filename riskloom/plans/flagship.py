"""Raw tables to a chosen decision threshold, without a fitted model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.expr import add_ratios
from riskloom.functions.session import materialise
from riskloom.operators import metrics, outliers, sampling
from riskloom.plans.apps import NUMERIC, RATIOS, applications


def threshold_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost curve of the validation rows with the cheapest threshold marked.

    Ratios, a stratified split, outlier bounds from train only, one fixed score of the masked
    columns, then the sweep. One write of the joined table feeds all passes.
    """
    apps = materialise(add_ratios(applications(spark, sf_dir), RATIOS), "apps")
    split = sampling.split_rows(apps, "app_id", "target")
    bounds = outliers.fit_bounds(split.where("split = 'train'"), NUMERIC, ["IQR 1.5"])
    masked = outliers.mask_outliers(split, "IQR 1.5", NUMERIC, bounds)
    score = F.least(F.lit(1.0), F.coalesce(F.col("amt_goods"), F.lit(0.0)) / 400000.0)
    val = masked.where("split = 'val'").select(F.col("target").alias("y"), score.alias("p"))
    curve = metrics.cost_curve(val)
    best = metrics.optimal_threshold(val).first()["threshold"]
    return curve.withColumn("is_best", F.col("threshold") == F.lit(best))
