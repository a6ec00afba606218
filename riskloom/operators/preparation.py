"""Preprocessing fitted on train and applied anywhere: indicators, scaling, imputation, one-hot.

Fitted numbers are small parameter tables; applying them is a projection of literals, so it adds
no join and no shuffle to the plan it sits in.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.expr import col, unpivot_numeric
from riskloom.functions.session import local_table, materialise, small_table
from riskloom.operators import metric
from riskloom.operators.neighbours import block_pairs
from riskloom.operators.ordering import ROW_LIMIT, exact_quantiles

MISSING_LEVEL = "missing"
MAX_WIDE_LEVELS = 2_000


def presence_indicators(
    df: DataFrame, columns: Sequence[str] | None = None, suffix: str = "_origin", only_indicators: bool = False
) -> DataFrame:
    """``<column><suffix>``: 1 where the value is present, 0 where it is missing."""
    columns = list(columns or df.columns)
    flags = [col(c).isNotNull().cast("int").alias(f"{c}{suffix}") for c in columns]
    return df.select(*flags) if only_indicators else df.select("*", *flags)


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, n, mean, scale)``: population standard deviation, 1 for a constant column; nulls skipped."""
    spread = F.stddev_pop("value")
    return small_table(
        unpivot_numeric(df, columns)
        .groupBy("feature")
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.when(spread > 0, spread).when(spread == 0, 1.0).alias("scale"),
        )
    )


def fit_medians(
    df: DataFrame, columns: Sequence[str], row_limit: int = ROW_LIMIT, counts: dict[str, int] | None = None
) -> DataFrame:
    """``(feature, median)``: exact, interpolated; an all-null column has no row."""
    found = exact_quantiles(unpivot_numeric(df, columns), (0.5,), row_limit, counts)
    return small_table(found.select("feature", F.get("q", F.lit(0)).alias("median")))


def scaled(c: Column, mean: float, scale: float) -> Column:
    return (c.cast("double") - F.lit(mean)) / F.lit(scale)


def fit_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, level)``: the categories seen, missing counted as the level 'missing'."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.coalesce(col(c).cast("string"), F.lit(MISSING_LEVEL)).alias("level"))
            for c in columns
        ]
    )
    return df.select(F.inline(pairs)).distinct()


@dataclass
class Preprocessor:
    """num (scale, then median), ind (presence flags), cat (one-hot) — in that order."""

    numeric: list[str]
    categorical: list[str]
    params: dict[str, tuple[float, float, float]] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)
    too_wide: bool = False  # more categories than single columns are made for

    @classmethod
    def fit(
        cls, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], row_limit: int = ROW_LIMIT
    ) -> Preprocessor:
        out = cls(list(numeric), list(categorical))
        if numeric:
            scale = {r["feature"]: r for r in fit_scaler(df, numeric).collect()}
            counts = {c: r["n"] for c, r in scale.items()}
            median = {r["feature"]: r["median"] for r in fit_medians(df, numeric, row_limit, counts).collect()}
            for c in numeric:
                if c not in median:
                    out.dropped.append(c)
                    continue
                mean, by = scale[c]["mean"], scale[c]["scale"]
                out.params[c] = (mean, by, (median[c] - mean) / by)
        if categorical:
            rows = fit_levels(df, categorical).limit(MAX_WIDE_LEVELS + 1).collect()
            out.too_wide = len(rows) > MAX_WIDE_LEVELS
            for r in [] if out.too_wide else rows:
                out.levels.setdefault(r["feature"], []).append(r["level"])
            for c in out.levels:
                out.levels[c].sort()
        return out

    def _need_levels(self) -> None:
        if self.too_wide:
            raise ValueError("too many categories for one column each; use vector_stages()")

    # -- output names -------------------------------------------------------------------------
    def feature_names(self) -> list[str]:
        self._need_levels()
        names = [f"num__{c}" for c in self.numeric if c in self.params]
        names += [f"ind__{c}_origin" for c in self.numeric]
        return names + [f"cat__{c}_{v}" for c in self.categorical for v in self.levels[c]]

    # -- apply ---------------------------------------------------------------------------------
    def expressions(self) -> list[Column]:
        self._need_levels()
        out = []
        for c in self.numeric:
            if c in self.params:
                mean, scale, fill = self.params[c]
                out.append(F.coalesce(scaled(col(c), mean, scale), F.lit(fill)).alias(f"num__{c}"))
        out += [col(c).isNotNull().cast("int").alias(f"ind__{c}_origin") for c in self.numeric]
        for c in self.categorical:
            level = F.coalesce(col(c).cast("string"), F.lit(MISSING_LEVEL))
            out += [(level == F.lit(v)).cast("int").alias(f"cat__{c}_{v}") for v in self.levels[c]]
        return out

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Named output columns after the ``keep`` ones; other input columns are dropped."""
        return df.select(*map(col, keep), *self.expressions())

    def assemble(self, df: DataFrame, keep: Sequence[str] = (), output: str = "features") -> DataFrame:
        """The same features as one vector column."""
        names = self.feature_names()
        plain = self.transform(df, keep)
        safe = plain.toDF(*keep, *[f"f{i}" for i in range(len(names))])
        assembler = VectorAssembler(inputCols=[f"f{i}" for i in range(len(names))], outputCol=output)
        return assembler.transform(safe).select(*map(col, keep), output)

    # -- as stages of a saved model --------------------------------------------------------------
    def vector_stages(self, output: str = "features") -> list:
        """Stages for a ``Pipeline``: a SQL projection, indexers, one-hot and the assembled vector.

        The extra slot for unseen categories is the one the encoder leaves out, so an unseen level
        becomes an all-zero block.
        """

        def quoted(name: str) -> str:
            return "`" + name.replace("`", "``") + "`"

        parts, inputs = [], []
        for c in self.numeric:
            if c in self.params:
                mean, scale, fill = (repr(float(x)) + "D" for x in self.params[c])
                parts.append(f"coalesce((CAST({quoted(c)} AS double) - {mean}) / {scale}, {fill}) AS {quoted('num__' + c)}")
                inputs.append(f"num__{c}")
        for c in self.numeric:
            parts.append(f"CAST({quoted(c)} IS NOT NULL AS int) AS {quoted('ind__' + c + '_origin')}")
            inputs.append(f"ind__{c}_origin")
        for c in self.categorical:
            parts.append(f"coalesce(CAST({quoted(c)} AS string), '{MISSING_LEVEL}') AS {quoted('lvl__' + c)}")
        stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")]
        if self.categorical:
            lvl, idx, cat = ([f"{p}__{c}" for c in self.categorical] for p in ("lvl", "idx", "cat"))
            stages.append(StringIndexer(inputCols=lvl, outputCols=idx, stringOrderType="alphabetAsc", handleInvalid="keep"))
            stages.append(OneHotEncoder(inputCols=idx, outputCols=cat, dropLast=True))
            inputs += cat
        stages.append(VectorAssembler(inputCols=inputs, outputCol=output))
        return stages

    def pipeline(self, output: str = "features") -> Pipeline:
        return Pipeline(stages=self.vector_stages(output))

    # -- parameter table -------------------------------------------------------------------------
    def to_table(self, spark: SparkSession) -> DataFrame:
        """``(kind, feature, stat, level, value, position)``, one row per fitted number or category."""
        self._need_levels()
        rows = []
        for i, c in enumerate(self.numeric):
            if c not in self.params:
                rows.append(("num", c, "dropped", None, None, i))
                continue
            for stat, value in zip(("mean", "scale", "fill"), self.params[c]):
                rows.append(("num", c, stat, None, float(value), i))
        for i, c in enumerate(self.categorical):
            for v in self.levels[c]:
                rows.append(("cat", c, "level", v, None, i))
        return spark.createDataFrame(
            rows, "kind string, feature string, stat string, level string, value double, position int"
        )

    @classmethod
    def from_table(cls, table: DataFrame) -> Preprocessor:
        rows = table.collect()
        order = {(r["kind"], r["feature"]): r["position"] for r in rows}
        out = cls(
            sorted((f for k, f in order if k == "num"), key=lambda f: order["num", f]),
            sorted((f for k, f in order if k == "cat"), key=lambda f: order["cat", f]),
        )
        stats = {(r["feature"], r["stat"]): r["value"] for r in rows if r["kind"] == "num"}
        for c in out.numeric:
            if (c, "dropped") in stats:
                out.dropped.append(c)
            else:
                out.params[c] = tuple(stats[c, s] for s in ("mean", "scale", "fill"))
        for r in rows:
            if r["kind"] == "cat":
                out.levels.setdefault(r["feature"], []).append(r["level"])
        for c in out.levels:
            out.levels[c].sort()
        return out


@dataclass
class NeighbourImputer:
    """Mean of the ``k`` nearest donors that have the value, by distance over the shared features.

    Distance is ``(d / shared) * sum(diff^2)`` over the ``shared`` features present on both sides,
    the order of the usual missing-aware Euclidean distance; ties go to the smaller donor id. Donors
    are a table the caller chooses (whole train set, or an explicit sample of it).

    Between rows that lack the same features and donors that lack the same features this is a plain
    distance in the features both have, times a constant. So every pair of frequent patterns (at least
    ``index_rows`` rows) gets a metric index of its own and a pruned nearest-neighbour join; what is left
    meets block by block. Both give the nearest donors per row and feature, which are merged: neither
    table passes through the driver or has to fit in a task.
    """

    columns: list[str]
    id_col: str
    donors: DataFrame
    means: list[float | None]
    k: int = 5
    block_rows: int = 2_000
    index_rows: int = 200

    @classmethod
    def fit(cls, donors: DataFrame, columns: Sequence[str], id_col: str, k: int = 5) -> NeighbourImputer:
        picked = donors.select(col(id_col).alias("id"), *[col(c).cast("double").alias(c) for c in columns], _pattern(columns).alias("_p"))
        picked = materialise(picked, "donors")
        means = picked.agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
        return cls(list(columns), id_col, picked, list(means), k)

    def _frequent(self, rows: DataFrame) -> list[str]:
        """Patterns of at least ``index_rows`` rows: a bounded share of all."""
        counts = rows.groupBy("_p").agg(F.count("*").alias("n")).where(F.col("n") >= self.index_rows)
        return sorted(r["_p"] for r in counts.collect())

    def _indexed(self, asked: DataFrame, ours: Sequence[str], theirs: Sequence[str]) -> DataFrame | None:
        """``(id, j, near)`` of rows and donors of frequent patterns, by the pruned join."""
        columns, k = self.columns, self.k
        pairs = []
        for a in ours:
            for b in theirs:
                both = "".join("1" if x == y == "1" else "0" for x, y in zip(a, b))
                gives = "".join("1" if x == "0" and y == "1" else "0" for x, y in zip(a, b))
                if "1" in both and "1" in gives:
                    pairs.append((len(pairs), a, b, both, gives, both.count("1")))
        if not pairs:
            return None
        table = local_table(asked.sparkSession, pairs, "g int, _a string, _b string, both string, gives string, shared int")
        x = F.array(*[F.when(F.substring("both", j + 1, 1) == "1", col(c)).otherwise(0.0) for j, c in enumerate(columns)])
        rows = asked.join(table, F.col("_p") == F.col("_a")).select("g", "id", x.alias("x"))
        points = self.donors.join(table, F.col("_p") == F.col("_b")).select("g", "id", x.alias("x"), F.array(*map(col, columns)).alias("v"))
        near = metric.nearest_rows(rows, metric.distinct_nearest_ids(points, k), k, self.block_rows)
        scaled_near = F.transform(
            "near",
            lambda n: F.struct((n["d2"] * float(len(columns)) / F.col("shared")).alias("d"), n["id"].alias("donor"), F.get(n["v"], F.col("j")).alias("v")),
        )
        each = near.join(table, "g").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(len(columns) - 1))))
        return each.where(F.expr("substring(gives, j + 1, 1) = '1'")).select("id", "j", scaled_near.alias("near"))

    def _in_blocks(self, asked: DataFrame, donors: DataFrame, kinds: list[str], near: str) -> DataFrame:
        """The same for rows and donors of any patterns, block against block."""
        columns, k = self.columns, self.k

        def nearest(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
            rows: list[tuple] = []
            theirs = theirs.sort_values("id", kind="stable")
            data, given = (p[columns].to_numpy(dtype="float64") for p in (ours, theirs))
            names, ids = theirs["id"].to_numpy(), ours["id"].to_numpy()
            for start in range(0, len(data) if len(given) else 0, 128):
                block = data[start : start + 128]
                dist = missing_aware_distance(block, given)
                for j in range(len(columns)):
                    need = np.flatnonzero(np.isnan(block[:, j]))
                    has = np.flatnonzero(~np.isnan(given[:, j]))
                    if not len(need) or not len(has):
                        continue
                    order = np.argsort(dist[np.ix_(need, has)], axis=1, kind="stable")[:, :k]
                    for i, best in zip(need, has[order]):
                        found = [(float(dist[i, b]), names[b], float(given[b, j])) for b in best if not np.isnan(dist[i, b])]
                        rows.append((ids[start + i], j, found))
            return pd.DataFrame(rows, columns=["id", "j", "near"])

        return block_pairs(asked.drop("_p"), donors.drop("_p"), [], self.block_rows).applyInPandas(nearest, f"id {kinds[0]}, j int, near {near}")

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill the columns of every row; complete rows pass through untouched. Ids have to be unique.

        A value that no donor can give is the donors' mean.
        """
        columns, k = self.columns, self.k
        gaps = F.lit(False)
        for c in columns:
            gaps = gaps | col(c).isNull()
        typed = df.withColumns({c: col(c).cast("double") for c in columns})
        asked = typed.where(gaps).select(col(self.id_col).alias("id"), *[col(c) for c in columns], _pattern(columns).alias("_p"))
        asked = materialise(asked, "gaps")
        kinds = [x.schema["id"].dataType.simpleString() for x in (asked, self.donors)]
        near = f"array<struct<d: double, donor: {kinds[1]}, v: double>>"
        ours, theirs = self._frequent(asked), self._frequent(self.donors)
        often, given = F.col("_p").isin(ours) if ours else F.lit(False), F.col("_p").isin(theirs) if theirs else F.lit(False)
        parts = [self._indexed(asked, ours, theirs)] if ours and theirs else []
        for some, donors in ((asked.where(often), self.donors.where(~given)), (asked.where(~often), self.donors)):
            if not some.isEmpty() and not donors.isEmpty():
                parts.append(self._in_blocks(some, donors, kinds, near))
        parts = [p.select("id", "j", F.col("near").cast(near).alias("near")) for p in parts if p is not None]
        if not parts:
            parts = [asked.limit(0).select("id", F.lit(0).alias("j"), F.expr(f"cast(array() AS {near})").alias("near"))]
        found = reduce(DataFrame.unionByName, parts)
        merged = found.groupBy("id", "j").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
        mean = F.aggregate("near", F.lit(0.0), lambda s, x: s + x["v"]) / F.size("near")
        filling = merged.where(F.size("near") > 0).groupBy("id").agg(
            *[F.max(F.when(F.col("j") == j, mean)).alias(f"_f{j}") for j in range(len(columns))]
        )
        key = F.col("id").alias("_id")
        filled = typed.where(gaps).join(filling.select(key, *[f"_f{j}" for j in range(len(columns))]), col(self.id_col) == F.col("_id"), "left")
        values = {c: F.coalesce(col(c), F.col(f"_f{j}"), F.lit(self.means[j])) for j, c in enumerate(columns)}
        return typed.where(~gaps).unionByName(filled.withColumns(values).select(*map(col, df.columns)))


def _pattern(columns: Sequence[str]) -> Column:
    """Which columns are present, one character each."""
    return F.concat(*[F.when(col(c).isNull(), "0").otherwise("1") for c in columns])


def missing_aware_distance(rows: np.ndarray, donors: np.ndarray) -> np.ndarray:
    """Squared distance scaled by d / shared; NaN where nothing is shared. Summed feature by feature."""
    total = np.zeros((len(rows), len(donors)))
    shared = np.zeros((len(rows), len(donors)))
    for j in range(rows.shape[1]):
        diff = rows[:, j][:, None] - donors[:, j][None, :]
        ok = ~np.isnan(diff)
        total += np.where(ok, diff * diff, 0.0)
        shared += ok
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(shared > 0, total * rows.shape[1] / shared, np.nan)
