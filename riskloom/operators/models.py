"""Classifiers on the preprocessed vector, with the weighting and parameter names of the search grids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expr import col
from riskloom.operators.boosting import BoostedTrees, settings_of
from riskloom.operators.preparation import Preprocessor

WEIGHT = "_weight"
FEATURES = "features"

# The search grids.
LOGISTIC_GRID = {"C": [1.0]}
BOOSTING_GRID = {
    "n_estimators": [2000, 3000],
    "learning_rate": [0.005, 0.01],
    "num_leaves": [63, 127],
    "min_child_samples": [100, 200],
    "reg_alpha": [0.5, 1.0],
    "reg_lambda": [5.0, 10.0],
    "colsample_bytree": [0.6],
    "subsample": [0.7],
}
FOREST_GRID = {
    "n_estimators": [300, 500, 800],
    "max_depth": [15, 25, None],
    "min_samples_leaf": [2, 5, 10],
    "max_features": ["sqrt"],
}
SCALE_POS_WEIGHT = 11.4
MAX_DEPTH = 30  # deepest tree the library grows


def grid_candidates(grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations, names in alphabetical order, the last name varying fastest."""
    names = sorted(grid)
    return [dict(zip(names, values)) for values in product(*[grid[n] for n in names])]


def class_weights(df: DataFrame, target: str) -> dict:
    """Balanced weights n / (2 n_class)."""
    sizes = {r["t"]: r["n"] for r in df.groupBy(col(target).alias("t")).agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    return {t: total / (len(sizes) * n) for t, n in sizes.items()}


def with_weights(df: DataFrame, target: str, weights: Mapping) -> DataFrame:
    w = F.lit(1.0)
    for t, value in weights.items():
        w = F.when(col(target) == F.lit(t), F.lit(float(value))).otherwise(w)
    return df.withColumn(WEIGHT, w)


def effective_params(family: str, params: Mapping) -> dict:
    """The parameters that change a fit: candidates that differ in others only are one fit.

    Boosting draws rows only if ``subsample_freq`` says how often.
    """
    idle = {"subsample"} if family == "boosting" and not params.get("subsample_freq") else set()
    return {k: v for k, v in params.items() if k not in idle}


def classifier(family: str, params: Mapping, target: str, total_weight: float, seed: int = 42):
    """An estimator of ``family`` (logistic, boosting, forest) for grid parameters.

    Boosting grows leaf-wise trees on histograms with all parameters of the grid; it lifts the positive
    class itself and takes no weights.
    """
    common = dict(featuresCol=FEATURES, labelCol=target, weightCol=WEIGHT)
    if family == "logistic":
        return LogisticRegression(
            **common,
            maxIter=int(params.get("max_iter", 1000)),
            tol=float(params.get("tol", 1e-4)),
            regParam=1.0 / (float(params.get("C", 1.0)) * total_weight),
            elasticNetParam=0.0,
            standardization=False,
        )
    trees = int(params.get("n_estimators", 100))
    if family == "boosting":
        return BoostedTrees(FEATURES, target, **asdict(settings_of(params, SCALE_POS_WEIGHT, seed)))
    if family == "forest":
        depth = params.get("max_depth")
        return RandomForestClassifier(
            **common,
            numTrees=trees,
            maxDepth=min(MAX_DEPTH, int(depth)) if depth else MAX_DEPTH,
            minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
            featureSubsetStrategy=str(params.get("max_features", "sqrt")),
            seed=seed,
        )
    raise ValueError(f"unknown family {family!r}")


def family_weights(family: str, df: DataFrame, target: str) -> dict:
    """Balanced classes, except boosting which lifts the positive class by a fixed factor."""
    return {0: 1.0, 1: SCALE_POS_WEIGHT} if family == "boosting" else class_weights(df, target)


def fit_model(
    train: DataFrame,
    target: str,
    family: str,
    params: Mapping,
    numeric: Sequence[str],
    categorical: Sequence[str],
    seed: int = 42,
) -> tuple[PipelineModel, Preprocessor]:
    """Preprocessing and classifier as one saved-model pipeline, fitted on ``train`` only."""
    prep = Preprocessor.fit(train, numeric, categorical)
    weights = family_weights(family, train, target)
    weighted = with_weights(train, target, weights)
    total = weighted.agg(F.sum(WEIGHT).alias("s")).first()["s"]
    estimator = classifier(family, params, target, total, seed)
    return Pipeline(stages=[*prep.vector_stages(FEATURES), estimator]).fit(weighted), prep


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str], output: str = "p") -> DataFrame:
    """``(keep..., p)``: probability of the positive class."""
    scored = model.transform(df.withColumn(WEIGHT, F.lit(1.0)) if WEIGHT not in df.columns else df)
    return scored.select(*map(col, keep), vector_to_array("probability")[1].alias(output))


def feature_importance(model: PipelineModel, names: Sequence[str], top: int = 20) -> DataFrame:
    """Split importance of a tree model, largest first."""
    from riskloom.functions.session import local_table
    from riskloom.functions.expr import top_n
    from pyspark.sql import SparkSession

    values = model.stages[-1].featureImportances.toArray()
    spark = SparkSession.getActiveSession()
    table = local_table(spark, [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")
    return top_n(table, "importance", top, "feature")
