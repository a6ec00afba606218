"""Batch scoring with decision and per-row explanation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expr import col, decision_label, drop_existing
from riskloom.operators import explain
from riskloom.operators.models import WEIGHT


def score_batch(model: PipelineModel, df: DataFrame, id_col: str, threshold: float, target: str = "TARGET") -> DataFrame:
    """``(id, probability, threshold, decision)`` for every row; a target column is not needed."""
    rows = drop_existing(df, [target]).withColumn(WEIGHT, F.lit(1.0))
    p = vector_to_array("probability")[1]
    return model.transform(rows).select(
        col(id_col), p.alias("probability"), F.lit(float(threshold)).alias("threshold"), decision_label(p, threshold).alias("decision")
    )


def explain_batch(
    model: PipelineModel, df: DataFrame, id_col: str, names: Sequence[str], top: int = 15, background: DataFrame | None = None
) -> DataFrame:
    """Local explanations of a saved pipeline for every row; linear or tree by the last stage.

    ``background`` gives the feature means of the linear case, the rows themselves by default.
    """
    final = model.stages[-1]

    def vectors(rows: DataFrame) -> DataFrame:
        for stage in model.stages[:-1]:
            rows = stage.transform(rows)
        return rows.select(col(id_col), vector_to_array("features").alias("x"))

    rows = vectors(df)
    if hasattr(final, "coefficients"):
        means = explain.feature_means(vectors(background) if background is not None else rows, "x", len(names))
        told = explain.linear_contributions(rows, "x", final.coefficients.toArray().tolist(), means, final.intercept)
    else:
        told = explain.tree_contributions(final, rows, "x")
    return explain.local_explanations(told, id_col, "x", names, top)
