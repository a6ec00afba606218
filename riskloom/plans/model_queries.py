"""Queries on cost, rank metrics, model comparison, training, registry, scoring and explanations."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.expr import decide
from riskloom.functions.session import local_table, materialise, work_dir
from riskloom.operators import boosting, explain, metrics, models, preparation, registry, sampling, scoring, search
from riskloom.plans.apps import APPS_SQL, NUMERIC, PREDICTIONS_SQL, SCORED_SQL, applications, long_predictions, scored
from riskloom.plans.catalogue import PREDS, SCORES, SPLIT, query, u, with_micro


def _preds(spark: SparkSession, sf: str) -> DataFrame:
    return long_predictions(scored(applications(spark, sf)))


def _confusion(keys: str, source: str) -> str:
    return f"""cm AS (SELECT {keys}, count(*) FILTER (y = 0 AND p < 0.5) AS tn, count(*) FILTER (y = 0 AND p >= 0.5) AS fp,
 count(*) FILTER (y = 1 AND p < 0.5) AS fn, count(*) FILTER (y = 1 AND p >= 0.5) AS tp, count(*) AS n FROM {source} GROUP BY {keys}),
au AS (SELECT {keys}, sum(CASE WHEN y = 1 THEN r END) AS rs, count(*) FILTER (y = 1) AS np, count(*) FILTER (y = 0) AS nn FROM
 (SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY p) + (count(*) OVER (PARTITION BY {keys}, p) - 1) / 2.0 AS r FROM {source}) GROUP BY {keys}),
me AS (SELECT {keys}, (tp + tn) / n AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision_, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
 coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, (10.0 * fn + fp) / n AS cost, (rs - np * (np + 1) / 2.0) / nullif(np * nn, 0) AS auc
 FROM cm JOIN au USING ({keys}))"""


@query(
    "confusion_matrix",
    f"""{PREDS}, c AS (SELECT model, y AS actual, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS predicted, count(*) AS n FROM preds GROUP BY ALL),
    g AS (SELECT DISTINCT model, a.v AS actual, b.v AS predicted FROM preds, (VALUES (0), (1)) a(v), (VALUES (0), (1)) b(v))
    SELECT model, actual, predicted, coalesce(n, 0) AS n,
      {u('coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY model, actual)')} AS rate
    FROM g LEFT JOIN c USING (model, actual, predicted)""",
)
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    rows = _preds(spark, sf).withColumn("y_hat", (F.col("p") >= 0.5).cast("int"))
    return with_micro(metrics.confusion_cells(metrics.confusion(rows, ["model"]), ["model"]), "rate")


@query(
    "business_cost",
    f"""{PREDS} SELECT model, {u('(10.0 * count(*) FILTER (y = 1 AND p < 0.45) + count(*) FILTER (y = 0 AND p >= 0.45)) / count(*)')} AS cost
    FROM preds GROUP BY 1""",
)
def business_cost(spark: SparkSession, sf: str) -> DataFrame:
    rows = _preds(spark, sf).withColumn("y_hat", (F.col("p") >= 0.45).cast("int"))
    return with_micro(metrics.business_cost(rows, ["model"]), "cost")


_CURVE = """th AS (SELECT i, i * 0.01::double AS threshold FROM range(101) g(i)),
cu AS (SELECT model, i, threshold, count(*) FILTER (y = 0 AND p >= threshold) AS fp, count(*) FILTER (y = 1 AND p < threshold) AS fn,
 count(*) AS n FROM preds CROSS JOIN th GROUP BY ALL)"""


@query("cost_curve", f"{PREDS}, {_CURVE} SELECT model, {u('threshold')} AS threshold, fp, fn, {u('(10.0 * fn + fp) / n')} AS cost FROM cu")
def cost_curve(spark: SparkSession, sf: str) -> DataFrame:
    return with_micro(metrics.cost_curve(_preds(spark, sf), ["model"]), "threshold", "cost")


@query(
    "optimal_threshold",
    f"""{PREDS}, {_CURVE} SELECT model, {u('threshold')} AS threshold, {u('(10.0 * fn + fp) / n')} AS min_cost FROM cu
    QUALIFY row_number() OVER (PARTITION BY model ORDER BY 10 * fn + fp, i) = 1""",
)
def optimal_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return with_micro(metrics.optimal_threshold(_preds(spark, sf), ["model"]), "threshold", "min_cost")


@query("roc_auc", f"{PREDS}, {_confusion('model', 'preds')} SELECT model, {u('auc')} AS auc FROM me")
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return with_micro(metrics.roc_auc(materialise(_preds(spark, sf), "predictions"), ["model"]), "auc")


# Predictions of which some lack the score and some the label.
_HOLES = f"""{PREDS}, holes AS (SELECT model, CASE WHEN app_id % 11 <> 0 THEN y END AS y, CASE WHEN app_id % 7 <> 0 THEN p END AS p FROM preds)"""
_HOLES_AUC = f"""{_HOLES}, r AS (SELECT model, y, rank() OVER w + (count(*) OVER (PARTITION BY model, p) - 1) / 2.0::double AS r
 FROM holes WHERE y IS NOT NULL WINDOW w AS (PARTITION BY model ORDER BY p NULLS FIRST)),
 s AS (SELECT model, sum(r) FILTER (y = 1) AS ranks, count(*) FILTER (y = 1) AS ones, count(*) FILTER (y = 0) AS zeros FROM r GROUP BY 1)
 SELECT model, {u('(ranks - ones * (ones + 1) / 2.0::double) / (ones * zeros)')} AS auc FROM s"""


def _holes(spark: SparkSession, sf: str) -> DataFrame:
    rows = long_predictions(scored(applications(spark, sf)), ("app_id",))
    y, p = F.when(F.col("app_id") % 11 != 0, F.col("y")), F.when(F.col("app_id") % 7 != 0, F.col("p"))
    return rows.select("model", y.alias("y"), p.alias("p"))


@query(
    "cost_curve_with_gaps",
    f"""{_HOLES}, th AS (SELECT i, i * 0.01::double AS threshold FROM range(101) g(i)),
    cu AS (SELECT model, threshold, count(*) FILTER (y = 0 AND p >= threshold) AS fp,
      count(*) FILTER (y = 1 AND NOT coalesce(p >= threshold, false)) AS fn, count(y) AS n FROM holes CROSS JOIN th GROUP BY ALL)
    SELECT model, {u('threshold')} AS threshold, fp, fn, {u('(10.0 * fn + fp) / n')} AS cost FROM cu""",
)
def cost_curve_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return with_micro(metrics.cost_curve(_holes(spark, sf), ["model"]), "threshold", "cost")


@query(
    "business_cost_with_gaps",
    f"""{_HOLES} SELECT model, {u("""(10.0 * count(*) FILTER (y = 1 AND NOT coalesce(p >= 0.45, false))
      + count(*) FILTER (y = 0 AND p >= 0.45)) / count(y)""")} AS cost FROM holes GROUP BY 1""",
)
def business_cost_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    rows = _holes(spark, sf).withColumn("y_hat", decide(F.col("p"), 0.45))
    return with_micro(metrics.business_cost(rows, ["model"]), "cost")


@query("roc_auc_with_gaps", _HOLES_AUC)
def roc_auc_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return with_micro(metrics.roc_auc(materialise(_holes(spark, sf), "predictions"), ["model"]), "auc")


@query("roc_auc_with_gaps_by_ranges", _HOLES_AUC)
def roc_auc_with_gaps_by_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """The same in two levels, as for keys beyond the row limit."""
    return with_micro(metrics.roc_auc(materialise(_holes(spark, sf), "predictions"), ["model"], row_limit=1), "auc")


@query(
    "classification_rates",
    f"""{PREDS}, {_confusion('model', 'preds')} SELECT model, {u('accuracy')} AS accuracy, {u('precision_')} AS "precision",
    {u('recall')} AS recall, {u('f1')} AS f1, {u('cost')} AS cost FROM me""",
)
def classification_rates(spark: SparkSession, sf: str) -> DataFrame:
    rows = _preds(spark, sf).withColumn("y_hat", (F.col("p") >= 0.5).cast("int"))
    out = metrics.rates(metrics.confusion(rows, ["model"]), ["model"])
    return with_micro(out, "accuracy", "precision", "recall", "f1", "cost")


@query(
    "leaderboard",
    f"""{PREDS}, {_confusion('model', 'preds')} SELECT model, {u('cost')} AS cost, {u('auc')} AS auc, {u('f1')} AS f1,
    row_number() OVER (ORDER BY cost, model) AS rank FROM me""",
)
def leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    return with_micro(metrics.leaderboard(materialise(_preds(spark, sf), "predictions")), "cost", "auc", "f1")


@query(
    "model_comparison",
    f"""{PREDS}, {_confusion('model', 'preds')} SELECT model, {u('auc')} AS auc, {u('accuracy')} AS accuracy,
    {u('precision_')} AS "precision", {u('recall')} AS recall, {u('f1')} AS f1, {u('cost')} AS cost FROM me""",
)
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.compare_models(materialise(_preds(spark, sf), "predictions"))
    return with_micro(out, "auc", "accuracy", "precision", "recall", "f1", "cost")


@query(
    "generalisation_gap",
    f"""{SPLIT}, {SCORED_SQL}, {PREDICTIONS_SQL},
    ps AS (SELECT preds.*, split FROM preds JOIN sp USING (app_id) WHERE split <> 'train'),
    {_confusion('model, split', 'ps')},
    v AS (SELECT * FROM me WHERE split = 'val'), t AS (SELECT * FROM me WHERE split = 'test_final')
    SELECT model, {u('abs(t.cost - v.cost)')} AS cost_gap, {u('abs(t.auc - v.auc)')} AS auc_gap, {u('abs(t.f1 - v.f1)')} AS f1_gap,
      {u('v.cost')} AS val_cost, {u('v.auc')} AS val_auc, {u('v.f1')} AS val_f1,
      {u('t.cost')} AS test_cost, {u('t.auc')} AS test_auc, {u('t.f1')} AS test_f1 FROM v JOIN t USING (model)""",
)
def generalisation_gap(spark: SparkSession, sf: str) -> DataFrame:
    split = sampling.split_rows(materialise(applications(spark, sf), "apps"), "app_id", "target")
    held = split.where("split <> 'train'")
    scores = scored(held).join(held.select("app_id", "split"), "app_id")
    out = metrics.generalisation_gap(materialise(long_predictions(scores, ("split",)), "predictions"))
    return with_micro(out, *[c for c in out.columns if c != "model"])


@query(
    "champion_challenger",
    f"""{SCORES}, c AS (SELECT (10.0 * count(*) FILTER (y = 1 AND p_goods < 0.5) + count(*) FILTER (y = 0 AND p_goods >= 0.5)) / count(*) AS a,
      (10.0 * count(*) FILTER (y = 1 AND p_qty < 0.3) + count(*) FILTER (y = 0 AND p_qty >= 0.3)) / count(*) AS b FROM scored)
    SELECT {u('a')} AS champion_cost, {u('b')} AS challenger_cost, {u('CASE WHEN a > 0 THEN (a - b) / a * 100 ELSE 0 END')} AS improvement_pct,
      b < a AS promote, CASE WHEN b < a THEN 'challenger is cheaper' ELSE 'challenger is not cheaper' END AS reason FROM c""",
)
def champion_challenger(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.compare_with_champion(scored(applications(spark, sf)), "p_goods", "p_qty", 0.3, 0.5)
    return with_micro(out, "champion_cost", "challenger_cost", "improvement_pct")


@query(
    "score_distribution",
    f"""{SCORES}, lim AS (SELECT min(p_goods) AS lo, max(p_goods) AS hi FROM scored),
    b AS (SELECT y, cast(greatest(0, least(49, floor((p_goods - lo) / ((hi - lo) / 50.0::double)))) AS int) AS bin FROM scored, lim),
    c AS (SELECT y, bin, count(*) AS n FROM b GROUP BY ALL), t AS (SELECT y, sum(n) AS total FROM c GROUP BY 1)
    SELECT y, cast(g.bin AS int) AS bin, coalesce(n, 0) AS n, {u('100.0::double * coalesce(n, 0) / total')} AS pct,
      CASE WHEN lo + g.bin * ((hi - lo) / 50.0::double) >= 0.45 THEN 'reject' ELSE 'approve' END AS zone
    FROM t CROSS JOIN lim CROSS JOIN range(50) g(bin) LEFT JOIN c USING (y, bin)""",
)
def score_distribution(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.score_distribution(scored(applications(spark, sf)), 0.45, "y", "p_goods")
    return with_micro(out.select("y", "bin", "n", "pct", "zone"), "pct")


# -- training, registry, scoring --------------------------------------------------------------------------


def _split(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(sampling.split_rows(materialise(applications(spark, sf), "apps"), "app_id", "target"), "split")


_CAT = ["cat_segment", "cat_status"]


def _fitted(spark: SparkSession, sf: str, family: str, params: dict):
    split = _split(spark, sf)
    model, prep = models.fit_model(split.where("split = 'train'"), "target", family, params, NUMERIC, _CAT)
    return split, model, prep


@query(
    "halving_schedule",
    f"""{SPLIT}, n AS (SELECT count(*) AS n FROM sp WHERE split = 'train'),
    r AS (SELECT i AS rung, cast(500 * 3 ** i AS bigint) AS n_resources FROM range(4) g(i) WHERE 500 * 3 ** i <= (SELECT n FROM n))
    SELECT cast(rung AS int) AS rung, cast([64, 22, 8, 3][rung + 1] AS int) AS n_candidates, n_resources FROM r""",
)
def halving_schedule(spark: SparkSession, sf: str) -> DataFrame:
    n = _split(spark, sf).where("split = 'train'").count()
    return search.schedule_table(spark, search.halving_schedule(64, 3, n))


@query("halving_search")
def halving_search(spark: SparkSession, sf: str) -> DataFrame:
    """Three logistic candidates, factor 3: the trial table."""
    train = _split(spark, sf).where("split = 'train'")
    found = search.halving_search(train, "app_id", "target", "logistic", {"C": [0.001, 0.1, 1.0]}, NUMERIC, _CAT, factor=3)
    return found.trials


@query("learning_curve")
def learning_curve(spark: SparkSession, sf: str) -> DataFrame:
    train = _split(spark, sf).where("split = 'train'")
    return search.learning_curve(train, "app_id", "target", "logistic", {"C": 1.0}, NUMERIC, _CAT, sizes=(0.1, 1.0), folds=2)


@query("fold_sizes", f"{APPS_SQL} SELECT target, count(*) AS n, cast(ceil(count(*) / 3) AS bigint) AS largest, count(*) // 3 AS smallest FROM apps GROUP BY 1")
def fold_sizes(spark: SparkSession, sf: str) -> DataFrame:
    apps = materialise(applications(spark, sf).select("app_id", "target"), "apps")
    per_fold = sampling.stratified_folds(apps, "app_id", "target", 3).groupBy("target", "fold").agg(F.count("*").alias("c"))
    return per_fold.groupBy("target").agg(F.sum("c").alias("n"), F.max("c").alias("largest"), F.min("c").alias("smallest"))


def _registrations(spark: SparkSession, sf: str) -> DataFrame:
    """One run per segment and priority: its cheapest threshold; promoted when cheaper than 1."""
    apps = applications(spark, sf)
    rows = materialise(
        scored(apps).join(apps.select("app_id", "cat_segment", "cat_priority"), "app_id").select(
            F.col("cat_segment").alias("name"), F.col("cat_priority").alias("run_id"), "y", F.col("p_goods").alias("p")
        ),
        "registrations",
    )
    best = metrics.optimal_threshold(rows, ["name", "run_id"])
    return best.select(
        "name",
        "run_id",
        F.substring("run_id", 1, 1).cast("long").alias("logged_at"),
        (F.floor(F.col("min_cost") * 1000) % 2 == 0).alias("promote"),
        "threshold",
        "min_cost",
    )


_REG_SQL = f"""{SCORES}, th AS (SELECT i, i * 0.01::double AS threshold FROM range(101) g(i)),
 cu AS (SELECT cat_segment AS name, cat_priority AS run_id, i, threshold, count(*) FILTER (y = 0 AND p_goods >= threshold) AS fp,
   count(*) FILTER (y = 1 AND p_goods < threshold) AS fn, count(*) AS n FROM scored JOIN apps USING (app_id) CROSS JOIN th GROUP BY ALL),
 best AS (SELECT name, run_id, threshold, (10.0::double * fn + fp) / n AS min_cost FROM cu
   QUALIFY row_number() OVER (PARTITION BY name, run_id ORDER BY 10 * fn + fp, i) = 1),
 reg AS (SELECT *, cast(floor(min_cost * 1000) AS bigint) % 2 = 0 AS promote, row_number() OVER (PARTITION BY name ORDER BY run_id) AS version FROM best),
 st AS (SELECT *, max(CASE WHEN promote THEN version END) OVER (PARTITION BY name) AS live FROM reg)"""


def _registered(spark: SparkSession, runs: DataFrame) -> DataFrame:
    """The events that a new registry holds after registering all runs."""
    kept = registry.ModelRegistry(spark, f"{work_dir(spark)}/registry-{uuid.uuid4().hex}")
    kept.register(runs.drop("threshold", "min_cost"))
    return kept.events()


@query(
    "registry_stages",
    f"""{_REG_SQL} SELECT name, cast(version AS int) AS version, run_id,
    CASE WHEN NOT promote THEN 'None' WHEN version = live THEN 'Production' ELSE 'Archived' END AS stage FROM st""",
)
def registry_stages(spark: SparkSession, sf: str) -> DataFrame:
    return registry.current_stages(_registered(spark, _registrations(spark, sf)))


@query(
    "registry_production",
    f"""{_REG_SQL} SELECT name, cast(version AS int) AS version, run_id, {u('threshold')} AS threshold, {u('min_cost')} AS min_cost
    FROM st WHERE version = live""",
)
def registry_production(spark: SparkSession, sf: str) -> DataFrame:
    runs = materialise(_registrations(spark, sf), "runs")
    live = registry.production_versions(_registered(spark, runs))
    return with_micro(live.join(runs.select("name", "run_id", "threshold", "min_cost"), ["name", "run_id"]), "threshold", "min_cost")


@query("logistic_scores")
def logistic_scores(spark: SparkSession, sf: str) -> DataFrame:
    split, model, _ = _fitted(spark, sf, "logistic", {"C": 1.0})
    return scoring.score_batch(model, split.where("split <> 'train'"), "app_id", 0.45, "target")


@query("forest_evaluation")
def forest_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    """Validation and test metrics of two fitted families with their gaps."""
    split, forest, _ = _fitted(spark, sf, "forest", {"n_estimators": 10, "max_depth": 5, "min_samples_leaf": 5})
    train = split.where("split = 'train'")
    boosted, _ = models.fit_model(
        train, "target", "boosting", {"n_estimators": 5, "learning_rate": 0.1, "num_leaves": 15, "min_child_samples": 20}, NUMERIC, _CAT
    )
    held = split.where("split <> 'train'")
    parts = [
        models.score(m, held, ["split", "target"]).select(F.lit(name).alias("model"), "split", F.col("target").alias("y"), "p")
        for name, m in (("forest", forest), ("boosting", boosted))
    ]
    return metrics.generalisation_gap(materialise(parts[0].unionByName(parts[1]), "predictions"))


# The first cut of a boosted model in SQL: every value of every coarse feature is tried.
_COARSE = ["least(coalesce(n_lines, 0), 6)", "least(floor(coalesce(qty, 0) / 30), 6)", "least(floor(amt_credit / 40000), 6)", "CASE WHEN cat_segment = 'BUILDING' THEN 1 ELSE 0 END"]
_L1, _L2, _LEAF, _LIFT = 0.5, 5.0, 100, 11.4
_UNIT = 16777216.0


def _worth(g: str, h: str) -> str:
    part = f"greatest(abs({g} / {_UNIT}::double) - {_L1}::double, 0)"
    return f"{part} * {part} / ({h} / {_UNIT}::double + {_L2}::double)"


def _leaf(g: str, h: str) -> str:
    return f"-sign({g}) * greatest(abs({g} / {_UNIT}::double) - {_L1}::double, 0) / ({h} / {_UNIT}::double + {_L2}::double)"


@query(
    "boosting_first_cut",
    f"""{APPS_SQL}, p AS (SELECT avg(target)::double AS p FROM apps),
    r AS (SELECT {", ".join(f"cast({c} AS double) AS f{i}" for i, c in enumerate(_COARSE))},
      round_even(CASE WHEN target = 1 THEN {_LIFT}::double ELSE 1::double END * (p - target) * {_UNIT}::double, 0) AS g,
      round_even(CASE WHEN target = 1 THEN {_LIFT}::double ELSE 1::double END * p * (1 - p) * {_UNIT}::double, 0) AS h FROM apps CROSS JOIN p),
    v AS ({" UNION ALL ".join(f"SELECT {i} AS feature, f{i} AS v, sum(g) AS g, sum(h) AS h, count(*) AS n FROM r GROUP BY 2" for i in range(len(_COARSE)))}),
    c AS (SELECT feature, v AS threshold, sum(g) OVER w AS gl, sum(h) OVER w AS hl, cast(sum(n) OVER w AS bigint) AS nl,
      sum(g) OVER a AS gt, sum(h) OVER a AS ht, cast(sum(n) OVER a AS bigint) AS nt
      FROM v WINDOW w AS (PARTITION BY feature ORDER BY v), a AS (PARTITION BY feature))
    SELECT feature, threshold, nl AS n_left, {u(f"{_worth('gl', 'hl')} + {_worth('(gt - gl)', '(ht - hl)')} - {_worth('gt', 'ht')}")} AS gain,
      {u(_leaf('gl', 'hl'))} AS value_left, {u(_leaf('(gt - gl)', '(ht - hl)'))} AS value_right
    FROM c WHERE nl >= {_LEAF} AND nt - nl >= {_LEAF}
    ORDER BY {_worth('gl', 'hl')} + {_worth('(gt - gl)', '(ht - hl)')} DESC, feature, threshold LIMIT 1""",
)
def boosting_first_cut(spark: SparkSession, sf: str) -> DataFrame:
    """Feature, threshold, gain and leaf values of a boosted model's first cut, with both penalties."""
    rows = applications(spark, sf).select("target", F.array(*[F.expr(c).cast("double") for c in _COARSE]).alias("x"))
    fit = boosting.Settings(n_estimators=1, num_leaves=2, min_child_samples=_LEAF, reg_alpha=_L1, reg_lambda=_L2, scale_pos_weight=_LIFT)
    (tree,), _, _ = boosting.fit_boosting(rows, "x", "target", fit)
    left, right = tree.left[0], tree.right[0]
    row = (tree.feature[0], tree.threshold[0], tree.count[left], tree.gain[0], tree.value[left], tree.value[right])
    out = local_table(spark, [row], "feature int, threshold double, n_left long, gain double, value_left double, value_right double")
    return with_micro(out, "gain", "value_left", "value_right")


@query("tree_importance")
def tree_importance(spark: SparkSession, sf: str) -> DataFrame:
    _, model, prep = _fitted(spark, sf, "forest", {"n_estimators": 10, "max_depth": 5, "min_samples_leaf": 5})
    return models.feature_importance(model, prep.feature_names(), 20)


# -- explanations -------------------------------------------------------------------------------------------

# Fixed coefficients for the checks of the linear explanation.
_COEF = {"amt_credit": 0.5, "amt_income": -0.25, "amt_goods": 0.75, "qty": -1.0, "disc": 0.125, "n_lines": 0.3}
_INTERCEPT = -1.5

_LIN = f"""{APPS_SQL}, p AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}, quantile_cont({c}, 0.5) AS d_{c}" for c in NUMERIC)} FROM apps),
 z AS (SELECT app_id, {", ".join(f"(coalesce({c}, d_{c}) - m_{c}) / s_{c} AS {c}" for c in NUMERIC)} FROM apps CROSS JOIN p),
 zm AS (SELECT {", ".join(f"avg({c}) AS a_{c}" for c in NUMERIC)} FROM z),
 lc AS ({" UNION ALL ".join(f"SELECT app_id, 'num__{c}' AS feature, {k} * ({c} - a_{c}) AS contribution, {c} AS value FROM z CROSS JOIN zm" for c, k in _COEF.items())}),
 fin AS (SELECT app_id, {_INTERCEPT} + {" + ".join(f"{k} * a_{c}" for c, k in _COEF.items())} AS base_value FROM z CROSS JOIN zm),
 tot AS (SELECT app_id, sum(contribution) AS s FROM lc GROUP BY 1)"""


def _linear(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    apps = materialise(applications(spark, sf), "apps")
    prep = preparation.Preprocessor.fit(apps, NUMERIC, [])
    names = [f"num__{c}" for c in NUMERIC]
    rows = prep.transform(apps, ["app_id"]).select("app_id", F.array(*names).alias("x"))
    means = explain.feature_means(rows, "x", len(names))
    return explain.linear_contributions(rows, "x", [_COEF[c] for c in NUMERIC], means, _INTERCEPT), names


@query(
    "linear_contributions",
    f"{_LIN} SELECT app_id, feature, {u('contribution')} AS contribution FROM lc",
)
def linear_contributions(spark: SparkSession, sf: str) -> DataFrame:
    rows, names = _linear(spark, sf)
    long_df = rows.select("app_id", F.posexplode("contributions").alias("pos", "contribution"))
    named = long_df.select("app_id", F.get(F.array(*map(F.lit, names)), F.col("pos")).alias("feature"), "contribution")
    return with_micro(named, "contribution")


@query("global_importance", f"{_LIN} SELECT feature, {u('avg(abs(contribution))')} AS importance FROM lc GROUP BY 1")
def global_importance(spark: SparkSession, sf: str) -> DataFrame:
    rows, names = _linear(spark, sf)
    return with_micro(explain.global_importance(rows, names), "importance")


@query(
    "local_explanations",
    f"""{_LIN} SELECT app_id, row_number() OVER (PARTITION BY app_id ORDER BY abs(contribution) DESC, feature) AS rank, feature,
      {u('contribution')} AS contribution, {u('base_value')} AS base_value, {u('base_value + s')} AS final_value
    FROM lc JOIN fin USING (app_id) JOIN tot USING (app_id) QUALIFY rank <= 3""",
)
def local_explanations(spark: SparkSession, sf: str) -> DataFrame:
    rows, names = _linear(spark, sf)
    out = explain.local_explanations(rows, "app_id", "x", names, 3).drop("label", "value")
    return with_micro(out, "contribution", "base_value", "final_value")


@query("explained_scores")
def explained_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted logistic model: local explanations of the validation rows."""
    split, model, prep = _fitted(spark, sf, "logistic", {"C": 1.0})
    return scoring.explain_batch(model, split.where("split = 'val'"), "app_id", prep.feature_names())


def _tree_check(spark: SparkSession, sf: str, family: str, params: dict) -> DataFrame:
    """Base plus contributions against the model's own output, for every row."""
    split, model, _ = _fitted(spark, sf, family, params)
    final = model.stages[-1]
    out = model.transform(split.withColumn(models.WEIGHT, F.lit(1.0)))
    p = vector_to_array("probability")[1]
    margin = p if family == "forest" else F.log(p / (1 - p))
    rows = out.select("app_id", vector_to_array("features").alias("x"), margin.alias("margin"))
    told = explain.tree_contributions(final, rows)
    total = F.col("base_value") + F.aggregate("contributions", F.lit(0.0), lambda s, c: s + c)
    return told.select("app_id", (F.abs(total - F.col("margin")) < 1e-6).alias("adds_up"))


_ADDS_UP = f"{APPS_SQL} SELECT app_id, true AS adds_up FROM apps"


@query("forest_contributions", _ADDS_UP)
def forest_contributions(spark: SparkSession, sf: str) -> DataFrame:
    return _tree_check(spark, sf, "forest", {"n_estimators": 5, "max_depth": 4, "min_samples_leaf": 5})


@query("boosting_contributions", _ADDS_UP)
def boosting_contributions(spark: SparkSession, sf: str) -> DataFrame:
    return _tree_check(
        spark, sf, "boosting", {"n_estimators": 4, "learning_rate": 0.1, "num_leaves": 15, "min_child_samples": 20}
    )
