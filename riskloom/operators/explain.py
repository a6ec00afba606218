"""Additive explanations: linear and tree contributions, global and local rankings."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.expr import col, feature_label, top_n
from riskloom.functions.session import ship, work_dir
from riskloom.operators.boosting import BoostedTreesModel


def _doubles(values: Sequence[float]) -> Column:
    return F.from_json(F.lit("[" + ",".join(repr(float(v)) for v in values) + "]"), "array<double>")


def _names(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def feature_means(df: DataFrame, features: str, width: int) -> list[float]:
    """Mean of every position of an array column; one row reaches the driver."""
    row = df.agg(*[F.avg(F.get(F.col(features), F.lit(i))).alias(f"m{i}") for i in range(width)]).first()
    return [float(row[i]) for i in range(width)]


def linear_contributions(
    df: DataFrame, features: str, coefficients: Sequence[float], means: Sequence[float], intercept: float, output: str = "contributions"
) -> DataFrame:
    """Add ``contributions`` (array: coefficient times distance to the mean) and ``base_value``.

    A projection on the array column; nothing is shuffled. The base is the margin at the means.
    """
    shifted = F.zip_with(F.col(features), _doubles(means), lambda x, m: x - m)
    base = float(intercept) + math.fsum(c * m for c, m in zip(coefficients, means))
    return df.withColumn(output, F.zip_with(shifted, _doubles(coefficients), lambda x, c: x * c)).withColumn(
        "base_value", F.lit(base)
    )


def global_importance(df: DataFrame, names: Sequence[str], top: int = 20, contributions: str = "contributions") -> DataFrame:
    """Mean absolute contribution per feature, the ``top`` largest."""
    long_df = df.select(F.posexplode(contributions).alias("pos", "c"))
    means = long_df.groupBy("pos").agg(F.avg(F.abs("c")).alias("importance"))
    named = means.select(F.get(_names(names), F.col("pos")).alias("feature"), "importance")
    return top_n(named, "importance", top, "feature")


def local_explanations(
    df: DataFrame, id_col: str, features: str, names: Sequence[str], top: int = 15, contributions: str = "contributions"
) -> DataFrame:
    """The ``top`` contributions of each row by size, with label, base and final value.

    The ranking is a sort of the row's own array, so no rows are moved. The final value is the base
    plus all contributions, not only the shown ones.
    """
    entries = F.transform(
        F.arrays_zip(F.col(contributions).alias("c"), _names(names).alias("n"), F.col(features).alias("x")),
        lambda e: F.struct(
            (-F.abs(e["c"])).alias("order"), e["n"].alias("feature"), e["c"].alias("contribution"), e["x"].alias("value")
        ),
    )
    best = F.slice(F.array_sort(entries), 1, top)
    final = F.col("base_value") + F.aggregate(contributions, F.lit(0.0), lambda s, c: s + c)
    return (
        df.select(col(id_col), "base_value", final.alias("final_value"), F.posexplode(best).alias("pos", "e"))
        .select(
            id_col,
            (F.col("pos") + 1).alias("rank"),
            F.col("e.feature").alias("feature"),
            F.col("e.contribution").alias("contribution"),
            F.col("e.value").alias("value"),
            "base_value",
            "final_value",
        )
        .withColumn("label", feature_label(F.col("feature"), F.col("value")))
    )


def features_as_array(df: DataFrame, vector: str = "features", output: str = "x") -> DataFrame:
    return df.withColumn(output, vector_to_array(F.col(vector)))


# -- trees ------------------------------------------------------------------------------------------------


def node_table(model, spark: SparkSession) -> DataFrame:
    """Nodes of a fitted tree ensemble, from its saved form (trees are found in the node data)."""
    path = f"{work_dir(spark)}/trees-{uuid.uuid4().hex}"
    model.write().save(path)
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")


def _leaf_paths(nodes: pd.DataFrame, weight: float, is_forest: bool) -> list[tuple[float, list[tuple]]]:
    """Per leaf: its value and, for each feature on its path, cover share and admitted values.

    A condition is ``(feature, share, low, high, categories)``: low < x <= high for a number, or
    membership of ``categories``.
    """
    by_id = {r.id: r for r in nodes.itertuples()}
    out = []
    stack = [(0, {})]
    while stack:
        node_id, held = stack.pop()
        node = by_id[node_id]
        if node.leftChild < 0:
            value = node.prediction
            if is_forest:
                value = node.impurityStats[1] / sum(node.impurityStats)
            out.append((weight * value, [(f, *c) for f, c in held.items()]))
            continue
        f, cut, n_cat = node.split["featureIndex"], node.split["leftCategoriesOrThreshold"], node.split["numCategories"]
        for child, goes_left in ((node.leftChild, True), (node.rightChild, False)):
            share, low, high, cats = held.get(f, (1.0, -math.inf, math.inf, None))
            share *= by_id[child].cover / node.cover
            if n_cat == -1:
                low, high = (low, min(high, cut[0])) if goes_left else (max(low, cut[0]), high)
            else:
                side = set(cut) if goes_left else set(map(float, range(n_cat))) - set(cut)
                cats = side if cats is None else cats & side
            stack.append((child, {**held, f: (share, low, high, cats)}))
    return out


def _leaf_shares(met: list[np.ndarray], shares: list[float]) -> list[np.ndarray]:
    """Shapley shares of a product game: member i adds ``met_i`` when present and ``share_i`` when not."""
    m = len(met)
    out = []
    for i in range(m):
        poly = [np.ones(len(met[0]))]
        for j in range(m):
            if j == i:
                continue
            grown = [shares[j] * p for p in poly] + [np.zeros(len(met[0]))]
            for k, p in enumerate(poly):
                grown[k + 1] = grown[k + 1] + met[j] * p
            poly = grown
        weight = sum(p * (math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)) for k, p in enumerate(poly))
        out.append((met[i] - shares[i]) * weight)
    return out


def _own_leaves(model: BoostedTreesModel) -> tuple[list, float]:
    """Leaves of boosted trees and their expected margin."""
    leaves = model.leaf_paths()
    return leaves, model.start + math.fsum(v * math.prod(c[1] for c in held) for v, held in leaves)


def _saved_leaves(model, spark: SparkSession) -> tuple[list, float]:
    """Leaves of a library model, read from its saved form, and their expected output."""
    is_forest = "RandomForest" in type(model).__name__
    weights = [1.0 / len(model.trees)] * len(model.trees) if is_forest else [2.0 * w for w in model.treeWeights]
    cover = F.aggregate("impurityStats", F.lit(0.0), lambda s, v: s + v) if is_forest else F.get("impurityStats", F.lit(0))
    nodes = node_table(model, spark).withColumn("cover", cover)
    pdf = nodes.toPandas()
    leaves, base = [], 0.0
    for tree_id, part in pdf.groupby("treeID"):
        for value, conditions in _leaf_paths(part, weights[tree_id], is_forest):
            leaves.append((value, conditions))
            base += value * math.prod(c[1] for c in conditions)
    return leaves, base


def tree_contributions(model, df: DataFrame, features: str = "x", output: str = "contributions") -> DataFrame:
    """Path-dependent Shapley contributions of a tree ensemble for the positive class.

    Adds ``contributions`` and ``base_value``: together they give the probability of a forest, or
    the log-odds of a boosted model. Expectations follow the training cover of the branches. The
    leaves are model-sized and copied to the tasks; rows are handled in Arrow batches.
    """
    spark = df.sparkSession
    ship(spark)
    leaves, base = _own_leaves(model) if isinstance(model, BoostedTreesModel) else _saved_leaves(model, spark)
    shared = spark.sparkContext.broadcast(leaves)
    names = df.columns

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b) == 0:
                continue
            x = np.stack(b[features].to_numpy())
            phi = np.zeros_like(x, dtype="float64")
            for value, conditions in shared.value:
                if not conditions:
                    continue
                met = []
                for f, _, low, high, cats in conditions:
                    ok = (x[:, f] > low) & (x[:, f] <= high)
                    if cats is not None:
                        ok &= np.isin(x[:, f], list(cats))
                    met.append(ok.astype("float64"))
                for (f, *_), part in zip(conditions, _leaf_shares(met, [c[1] for c in conditions])):
                    phi[:, f] += value * part
            out = b[names].copy()
            out[output] = list(phi)
            out["base_value"] = base
            yield out

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(explain, f"{fields}, {output} array<double>, base_value double")
