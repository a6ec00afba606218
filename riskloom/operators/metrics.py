"""Cost and rank metrics on long predictions ``(keys..., y 0/1, p)``; ``keys`` may be a model or a split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.functions.expr import decide
from riskloom.functions.session import small_table
from riskloom.operators.ordering import ROW_LIMIT, bin_counts, running_totals

FN_COST = 10.0
FP_COST = 1.0
N_THRESHOLDS = 101


def confusion(df: DataFrame, keys: Sequence[str] = (), y: str = "y", y_hat: str = "y_hat") -> DataFrame:
    """``(keys..., tn, fp, fn, tp, n)``; one row per key, zero cells kept.

    A missing decision counts as 0, since a missing score reaches no threshold. A row without a
    label is in no cell and not in ``n``.
    """
    t, p = F.col(y) == 1, F.coalesce(F.col(y_hat) == 1, F.lit(False))
    return df.groupBy(*keys).agg(
        F.count_if(~t & ~p).alias("tn"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(t & p).alias("tp"),
        F.count(F.col(y)).alias("n"),
    )


def confusion_cells(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Four rows per key ``(actual, predicted, n, rate)``; the rate is of the actual class."""
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(c).alias("n_cell"), F.expr(t).alias("row_total"))
            for a, b, c, t in ((0, 0, "tn", "tn + fp"), (0, 1, "fp", "tn + fp"), (1, 0, "fn", "fn + tp"), (1, 1, "tp", "fn + tp"))
        ]
    )
    return counts.select(*keys, F.inline(cells)).select(
        *keys, "actual", "predicted", F.col("n_cell").alias("n"), F.try_divide("n_cell", "row_total").alias("rate")
    )


def cost_column(fn_cost: float = FN_COST, fp_cost: float = FP_COST) -> Column:
    """Average cost per row over confusion columns; 0 for an empty set."""
    return F.coalesce(F.try_divide(F.col("fn") * F.lit(fn_cost) + F.col("fp") * F.lit(fp_cost), F.col("n")), F.lit(0.0))


def business_cost(
    df: DataFrame, keys: Sequence[str] = (), y: str = "y", y_hat: str = "y_hat", fn_cost: float = FN_COST, fp_cost: float = FP_COST
) -> DataFrame:
    return confusion(df, keys, y, y_hat).select(*keys, cost_column(fn_cost, fp_cost).alias("cost"))


def threshold_value(k: Column) -> Column:
    """The k-th of 101 thresholds, bit for bit ``k * 0.01``."""
    return k.cast("double") * F.lit(0.01)


def threshold_index(p: Column) -> Column:
    """Largest k with ``k * 0.01 <= p``: the floor, moved by one where rounding crossed an edge.

    -1 for a missing score, which is below every threshold.
    """
    p = F.when(~F.isnan(p), p)
    k = F.floor(p * 100).cast("int")
    k = F.when(threshold_value(k + 1) <= p, k + 1).when(threshold_value(k) > p, k - 1).otherwise(k)
    return F.when(k.isNull(), -1).otherwise(F.least(k, F.lit(N_THRESHOLDS - 1)))


def cost_curve(
    df: DataFrame, keys: Sequence[str] = (), y: str = "y", p: str = "p", fn_cost: float = FN_COST, fp_cost: float = FP_COST
) -> DataFrame:
    """Cost at 101 thresholds from one pass: rows are counted by the last threshold they reach.

    ``p`` may lie outside [0, 1]; such rows are above or below every threshold. A missing ``p`` is
    below every threshold, and a row without a label is left out.
    """
    keys = list(keys)
    reached = F.greatest(threshold_index(F.col(p)), F.lit(-1)).alias("k")
    counts = small_table(
        df.groupBy(*keys, reached).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    )
    grid = counts.groupBy(*keys).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    grid = grid.select("*", F.explode(F.sequence(F.lit(0), F.lit(N_THRESHOLDS - 1))).alias("k"))
    filled = grid.join(counts, [*keys, "k"], "left").na.fill(0, ["pos", "neg"])
    from_top = Window.partitionBy(*keys).orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    swept = filled.select(
        *keys,
        "k",
        F.sum("pos").over(from_top).alias("tp"),
        F.sum("neg").over(from_top).alias("fp"),
        "all_pos",
        "all_neg",
    )
    fn = F.col("all_pos") - F.col("tp")
    return swept.select(
        *keys,
        threshold_value(F.col("k")).alias("threshold"),
        F.col("fp"),
        fn.alias("fn"),
        F.try_divide(fn * F.lit(fn_cost) + F.col("fp") * F.lit(fp_cost), F.col("all_pos") + F.col("all_neg")).alias("cost"),
    )


def optimal_threshold(
    df: DataFrame, keys: Sequence[str] = (), y: str = "y", p: str = "p", fn_cost: float = FN_COST, fp_cost: float = FP_COST
) -> DataFrame:
    """Cheapest threshold per key, the lowest one on ties. The total cost is compared, not the ratio."""
    curve = cost_curve(df, keys, y, p, fn_cost, fp_cost)
    total = F.col("fn") * F.lit(fn_cost) + F.col("fp") * F.lit(fp_cost)
    best = F.min(F.struct(total.alias("total"), F.col("threshold"), F.col("cost"))).alias("b")
    return curve.groupBy(*keys).agg(best).select(
        *keys, F.col("b.threshold").alias("threshold"), F.col("b.cost").alias("min_cost")
    )


def roc_auc(df: DataFrame, keys: Sequence[str] = (), y: str = "y", p: str = "p", row_limit: int = ROW_LIMIT) -> DataFrame:
    """Exact tie-aware AUC; NULL when a key has one class only.

    Missing scores are the lowest and tie with each other; rows without a label are left out.
    """
    keys = list(keys)
    by = keys or ["_all"]
    rows = df.where(F.col(y).isNotNull()).select(
        *([F.col(k) for k in keys] or [F.lit(0).alias("_all")]),
        F.col(p).alias("p"),
        (F.col(y) == 1).cast("long").alias("pos"),
        (F.col(y) != 1).cast("long").alias("neg"),
    )
    swept = running_totals(rows, by, "p", ["pos", "neg"], row_limit)
    below = F.col("cum_neg") - F.col("neg")
    # Twice the pair count keeps the sum an integer: ties count one half each.
    twice = F.sum(F.col("pos").cast("decimal(20,0)") * (below * 2 + F.col("neg")).cast("decimal(18,0)"))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return swept.groupBy(*by).agg(F.try_divide(twice.cast("double"), pairs * 2).alias("auc")).select(*keys, "auc")


def rates(counts: DataFrame, keys: Sequence[str] = (), fn_cost: float = FN_COST, fp_cost: float = FP_COST) -> DataFrame:
    """Accuracy, precision, recall, F1 and cost from confusion counts; 0 where a rate is undefined."""

    def share(num: str, den: str) -> Column:
        return F.coalesce(F.try_divide(F.expr(num).cast("double"), F.expr(den).cast("double")), F.lit(0.0))

    return counts.select(
        *keys,
        share("tp + tn", "n").alias("accuracy"),
        share("tp", "tp + fp").alias("precision"),
        share("tp", "tp + fn").alias("recall"),
        share("2 * tp", "2 * tp + fp + fn").alias("f1"),
        cost_column(fn_cost, fp_cost).alias("cost"),
    )


def compare_models(
    predictions: DataFrame, keys: Sequence[str] = ("model",), threshold: float = 0.5, row_limit: int = ROW_LIMIT
) -> DataFrame:
    """All six metrics per key over ``(keys..., y, p[, y_hat])``.

    Rows without a probability count as a model without one: its AUC is 0.5 and ``y_hat`` must be given.
    """
    keys = list(keys)
    rows = predictions
    if "y_hat" not in rows.columns:
        rows = rows.withColumn("y_hat", decide(F.col("p"), threshold))
    table = rates(confusion(rows, keys), keys)
    auc = roc_auc(rows.where(F.col("p").isNotNull()), keys, row_limit=row_limit)
    with_p = rows.groupBy(*keys).agg(F.count("p").alias("n_p"))
    joined = small_table(table).join(small_table(auc), keys, "left").join(small_table(with_p), keys)
    return joined.withColumn("auc", F.when(F.col("n_p") == 0, 0.5).otherwise(F.col("auc"))).drop("n_p")


def leaderboard(predictions: DataFrame, threshold: float = 0.5, row_limit: int = ROW_LIMIT) -> DataFrame:
    """Models by ascending cost, name as tie-break, ``rank`` 1 is the choice."""
    table = compare_models(predictions, ["model"], threshold, row_limit).select("model", "cost", "auc", "f1")
    order = Window.orderBy("cost", "model")
    return small_table(table).withColumn("rank", F.row_number().over(order))


def generalisation_gap(predictions: DataFrame, threshold: float = 0.5, row_limit: int = ROW_LIMIT) -> DataFrame:
    """Validation and test metrics per model over ``(model, split, y, p)`` with absolute differences."""
    table = small_table(compare_models(predictions, ["model", "split"], threshold, row_limit))

    def side(split: str, name: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(name)))

    out = table.groupBy("model").agg(
        *[side("val", m).alias(f"val_{m}") for m in ("cost", "auc", "f1")],
        *[side("test_final", m).alias(f"test_{m}") for m in ("cost", "auc", "f1")],
    )
    return out.select("*", *[F.abs(F.col(f"test_{m}") - F.col(f"val_{m}")).alias(f"{m}_gap") for m in ("cost", "auc", "f1")])


def compare_with_champion(
    scored: DataFrame,
    champion_p: str | None,
    challenger_p: str,
    challenger_threshold: float,
    champion_threshold: float = 0.5,
    y: str = "y",
    fn_cost: float = FN_COST,
    fp_cost: float = FP_COST,
    fail_open: bool = False,
) -> DataFrame:
    """One row ``(champion_cost, challenger_cost, improvement_pct, promote, reason)``, one pass.

    The challenger must be strictly cheaper. Without a champion it wins. A failing comparison
    keeps the champion, or promotes with ``fail_open=True``.
    """
    spark = scored.sparkSession
    schema = "champion_cost double, challenger_cost double, improvement_pct double, promote boolean, reason string"
    if champion_p is None:
        return spark.createDataFrame([(None, None, None, True, "no champion")], schema)
    absent = [c for c in (champion_p, challenger_p, y) if c not in scored.columns]
    if absent:
        return spark.createDataFrame([(None, None, None, fail_open, f"scoring failed: no column {', '.join(absent)}")], schema)

    def cost(p: str, limit: float) -> Column:
        hat, t = F.col(p) >= F.lit(float(limit)), F.col(y) == 1
        total = F.count_if(t & ~hat) * F.lit(fn_cost) + F.count_if(~t & hat) * F.lit(fp_cost)
        return F.coalesce(F.try_divide(total, F.count("*")), F.lit(0.0))

    costs = scored.agg(
        cost(champion_p, champion_threshold).alias("champion_cost"),
        cost(challenger_p, challenger_threshold).alias("challenger_cost"),
        F.count_if(F.col(champion_p).isNull() | F.col(challenger_p).isNull()).alias("n_missing"),
    )
    champ, chall = F.col("champion_cost"), F.col("challenger_cost")
    failed = F.col("n_missing") > 0
    better = chall < champ
    return costs.select(
        champ,
        chall,
        F.when(champ > 0, (champ - chall) / F.when(champ > 0, champ) * 100).otherwise(0.0).alias("improvement_pct"),
        F.when(failed, F.lit(fail_open)).otherwise(better).alias("promote"),
        F.when(failed, "scoring failed: missing probabilities")
        .when(better, "challenger is cheaper")
        .otherwise("challenger is not cheaper")
        .alias("reason"),
    )


def score_distribution(df: DataFrame, threshold: float, y: str = "y", p: str = "p", bins: int = 50) -> DataFrame:
    """Score histogram per class on shared edges, with the zone each bin's left edge falls in."""
    rows = df.select(F.lit("score").alias("feature"), F.col(p).alias("value"), F.col(y).alias("y"))
    out = bin_counts(rows, ["feature"], bins, ["y"])
    return out.drop("feature").withColumn("zone", F.when(F.col("left_edge") >= threshold, "reject").otherwise("approve"))


class BusinessCostEvaluator(Evaluator):
    """Average business cost of a scored frame, for model selection; lower is better."""

    def __init__(self, label: str = "label", fn_cost: float = FN_COST, fp_cost: float = FP_COST, threshold: float = 0.5):
        super().__init__()
        self.label, self.fn_cost, self.fp_cost, self.threshold = label, fn_cost, fp_cost, threshold

    def _evaluate(self, dataset: DataFrame) -> float:
        p = vector_to_array("probability")[1]
        rows = dataset.select(F.col(self.label).alias("y"), decide(p, self.threshold).alias("y_hat"))
        return float(business_cost(rows, fn_cost=self.fn_cost, fp_cost=self.fp_cost).first()["cost"])

    def isLargerBetter(self) -> bool:
        return False
