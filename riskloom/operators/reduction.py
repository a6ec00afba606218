"""Principal components with mean-centred scores and a fixed sign."""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.functions.expr import col, top_n
from riskloom.functions.session import local_table


@dataclass
class Components:
    """Loadings (features x components), feature means and variances."""

    names: list[str]
    loadings: np.ndarray
    means: np.ndarray
    variances: np.ndarray
    ratios: np.ndarray

    @classmethod
    def fit(cls, df: DataFrame, features: str, n: int = 10, names: Sequence[str] | None = None) -> Components:
        """One pass for the moments, one for the covariance; only d x d numbers reach the driver.

        ``features`` is an array column without gaps. The sign of a component is chosen so that
        its largest loading is positive.
        """
        vectors = df.select(array_to_vector(F.col(features).cast("array<double>")).alias("v"))
        stats = vectors.select(Summarizer.metrics("mean", "variance").summary(F.col("v")).alias("s")).first()["s"]
        means, variances = stats["mean"].toArray(), stats["variance"].toArray()
        k = min(n, len(means))
        model = PCA(k=k, inputCol="v", outputCol="p").fit(vectors)
        loadings = model.pc.toArray()
        lead = np.argmax(np.abs(loadings), axis=0)
        loadings = loadings * np.where(loadings[lead, np.arange(k)] < 0, -1.0, 1.0)
        labels = list(names) if names is not None else [f"x{i}" for i in range(len(means))]
        return cls(labels, loadings, means, variances, model.explainedVariance.toArray())

    def transform(self, df: DataFrame, features: str, output: str = "pc", n: int | None = None) -> DataFrame:
        """Add the centred scores as an array column; a plain projection on the JVM side."""
        k = n or self.loadings.shape[1]
        centred = F.zip_with(F.col(features).cast("array<double>"), _doubles(self.means), lambda a, m: a - m)
        scores = [
            F.aggregate(
                F.zip_with(F.col("_centred"), _doubles(self.loadings[:, j]), lambda a, w: a * w), F.lit(0.0), lambda s, t: s + t
            )
            for j in range(k)
        ]
        return df.withColumn("_centred", centred).withColumn(output, F.array(*scores)).drop("_centred")

    def explained_variance(self, spark: SparkSession) -> DataFrame:
        """``(component, variance, ratio, cumulative)``."""
        total = float(self.variances.sum())
        rows, upto = [], 0.0
        for j, r in enumerate(self.ratios):
            upto += float(r)
            rows.append((f"PC{j + 1}", float(r) * total, float(r), upto))
        return local_table(spark, rows, "component string, variance double, ratio double, cumulative double")

    def loading_table(self, spark: SparkSession) -> DataFrame:
        """``(feature, component, loading)``."""
        rows = [
            (f, f"PC{j + 1}", float(self.loadings[i, j]))
            for i, f in enumerate(self.names)
            for j in range(self.loadings.shape[1])
        ]
        return local_table(spark, rows, "feature string, component string, loading double")

    def _wide(self, spark: SparkSession, n: int) -> DataFrame:
        parts = [F.max(F.when(F.col("component") == f"PC{j + 1}", F.col("loading"))).alias(f"pc{j + 1}") for j in range(n)]
        return self.loading_table(spark).groupBy("feature").agg(*parts)

    def biplot_table(self, spark: SparkSession, top: int = 20) -> DataFrame:
        """The ``top`` features by length of their (PC1, PC2) arrow."""
        wide = self._wide(spark, 2).withColumn("length", F.sqrt(F.col("pc1") * F.col("pc1") + F.col("pc2") * F.col("pc2")))
        return top_n(wide, "length", top, "feature")

    def importance_table(self, spark: SparkSession, top: int = 10) -> DataFrame:
        """The ``top`` features by absolute PC1 loading, with their first three loadings."""
        n = min(3, self.loadings.shape[1])
        wide = self._wide(spark, n).withColumn("strength", F.abs("pc1"))
        best = top_n(wide, "strength", top, "feature")
        return best.withColumn("rank", F.row_number().over(Window.orderBy(F.col("strength").desc(), "feature"))).drop("strength")


def _doubles(values: np.ndarray):
    return F.array(*[F.lit(float(v)) for v in values])


def feature_array(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Numeric columns as one array column."""
    return df.withColumn(output, F.array(*[col(c).cast("double") for c in columns]))


def vector_column_to_array(df: DataFrame, vector: str, output: str) -> DataFrame:
    return df.withColumn(output, vector_to_array(F.col(vector)))
