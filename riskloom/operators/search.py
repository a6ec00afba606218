"""Successive-halving search, cross-validation folds and learning curves."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import InheritableThread
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.expr import decide
from riskloom.functions.session import local_table, materialise
from riskloom.operators import metrics, models, sampling
from riskloom.operators.models import FEATURES, WEIGHT
from riskloom.operators.preparation import Preprocessor
from riskloom.operators.registry import ModelRegistry

MIN_RESOURCES = 500


def halving_schedule(n_candidates: int, factor: int, n_samples: int, min_resources: int = MIN_RESOURCES) -> list[tuple[int, int, int]]:
    """``(rung, candidates, rows)``: rows grow by ``factor`` while the candidates shrink by it."""
    if n_candidates < 1 or factor < 2:
        raise ValueError("need at least one candidate and a factor of at least 2")
    needed = 1
    while factor**needed <= n_candidates:
        needed += 1
    possible = 1
    while min_resources * factor**possible <= n_samples:
        possible += 1
    out, left = [], n_candidates
    for rung in range(min(needed, possible)):
        out.append((rung, left, min(n_samples, min_resources * factor**rung)))
        left = math.ceil(left / factor)
    return out


def schedule_table(spark: SparkSession, schedule: list[tuple[int, int, int]]) -> DataFrame:
    return local_table(spark, schedule, "rung int, n_candidates int, n_resources long")


@dataclass
class SearchResult:
    trials: DataFrame
    best_params: dict
    best_score: float
    model: PipelineModel
    preprocessor: Preprocessor


def _prepared_folds(rows: DataFrame, target: str, family: str, numeric, categorical, folds: int) -> list[tuple]:
    """Per fold: vectors of the other folds (weighted) and of the fold, written once for all candidates."""
    out = []
    for fold in range(folds):
        train, held = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        prep = Preprocessor.fit(train, numeric, categorical)
        weights = models.family_weights(family, train, target)
        vectors = materialise(prep.assemble(models.with_weights(train, target, weights), [target, WEIGHT], FEATURES), "fold_train")
        total = vectors.agg(F.sum(WEIGHT).alias("s")).first()["s"]
        held_vectors = materialise(prep.assemble(held.withColumn(WEIGHT, F.lit(1.0)), [target, WEIGHT], FEATURES), "fold_test")
        out.append((vectors, total, held_vectors))
    return out


def _cost(scored: DataFrame, target: str, fn_cost: float, fp_cost: float) -> float:
    rows = scored.select(F.col(target).alias("y"), decide(vector_to_array("probability")[1], 0.5).alias("y_hat"))
    return float(metrics.business_cost(rows, fn_cost=fn_cost, fp_cost=fp_cost).first()["cost"])


def halving_search(
    train: DataFrame,
    id_col: str,
    target: str,
    family: str,
    grid: Mapping[str, Sequence],
    numeric: Sequence[str],
    categorical: Sequence[str],
    factor: int = 5,
    folds: int = 3,
    min_resources: int = MIN_RESOURCES,
    seed: int = 42,
    parallelism: int = 4,
    fn_cost: float = metrics.FN_COST,
    fp_cost: float = metrics.FP_COST,
    log_to: ModelRegistry | None = None,
    experiment: str = "search",
    run_name: str | None = None,
) -> SearchResult:
    """Grid search by successive halving on business cost, refitted on all rows with the winner.

    Rungs use nested samples (the first rows by hash), so a later rung contains the earlier one.
    Preprocessing is fitted once per rung and fold, not per candidate; candidates are then fitted
    side by side from ``parallelism`` driver threads while Spark spreads each fit. Candidates that
    differ only in parameters without effect are fitted once and share the score.

    With ``log_to`` the winner is logged as a run (named after the family unless told otherwise)
    with its parameters, score and fitted pipeline, where ``register_best`` finds it.
    """
    spark = train.sparkSession
    candidates = models.grid_candidates(grid)
    # Folds use another hash order than the rungs, or a small rung would fall into one fold.
    rows = materialise(
        sampling.stratified_folds(train.select(id_col, target, *numeric, *categorical), id_col, target, folds, seed + 1), "search"
    )
    n = rows.count()
    alive = list(range(len(candidates)))
    log: list[tuple] = []
    final: list[tuple[float, int]] = []
    for rung, _, resources in halving_schedule(len(candidates), factor, n, min_resources):
        part = rows if resources >= n else materialise(sampling.sample_rows(rows, id_col, resources, seed), "rung")
        prepared = _prepared_folds(part, target, family, numeric, categorical, folds)

        def evaluate(candidate: int) -> list[float]:
            scores = []
            for vectors, total, held in prepared:
                fitted = models.classifier(family, candidates[candidate], target, total, seed).fit(vectors)
                scores.append(-_cost(fitted.transform(held), target, fn_cost, fp_cost))
            return scores

        same = {c: json.dumps(models.effective_params(family, candidates[c]), sort_keys=True) for c in alive}
        first = {key: c for c, key in reversed(same.items())}
        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            scored = dict(zip(first, pool.map(_in_session(evaluate), first.values())))
        results = [scored[same[c]] for c in alive]
        final = []
        for candidate, scores in zip(alive, results):
            mean = sum(scores) / len(scores)
            std = math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores))
            final.append((mean, candidate))
            log.append((rung, candidate, json.dumps(candidates[candidate], sort_keys=True), resources, mean, std))
        final.sort(key=lambda t: (-t[0], t[1]))
        alive = [c for _, c in final[: math.ceil(len(final) / factor)]]
    best_score, best = final[0]
    model, prep = models.fit_model(rows, target, family, candidates[best], numeric, categorical, seed)
    if log_to is not None:
        log_to.log_run(experiment, run_name or family, candidates[best], {"mean_score": best_score}, {"family": family}, model)
    schema = "rung int, candidate int, params string, n_samples long, mean_score double, std_score double"
    return SearchResult(local_table(spark, log, schema), candidates[best], best_score, model, prep)


def _in_session(fn):
    """Keep the caller's Spark properties (job group, pool) in worker threads."""

    def run(arg):
        out: list = []
        errors: list[BaseException] = []

        def body():
            try:
                out.append(fn(arg))
            except BaseException as e:  # noqa: BLE001
                errors.append(e)

        thread = InheritableThread(target=body)
        thread.start()
        thread.join()
        if errors:
            raise errors[0]
        return out[0]

    return run


def learning_curve(
    df: DataFrame,
    id_col: str,
    target: str,
    family: str,
    params: Mapping,
    numeric: Sequence[str],
    categorical: Sequence[str],
    sizes: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0),
    folds: int = 5,
    metric: str = "auc",
    seed: int = 42,
) -> DataFrame:
    """``(size, n_train, train_mean, train_std, test_mean, test_std)`` over the folds.

    Training parts are nested prefixes of each fold's training rows by hash. ``metric`` is ``auc``
    or ``cost`` (negated, larger is better). Predictions of all fits are scored in one pass.
    """
    rows = materialise(
        sampling.stratified_folds(df.select(id_col, target, *numeric, *categorical), id_col, target, folds, seed + 1), "curve"
    )
    sized = {r["fold"]: r["n"] for r in rows.groupBy("fold").agg(F.count("*").alias("n")).collect()}
    total = sum(sized.values())
    smallest = total - max(sized.values())
    scored: DataFrame | None = None
    taken: dict[float, int] = {}
    for fold in range(folds):
        others, held = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        for size in sizes:
            n = taken[size] = max(1, int(size * smallest))
            train = sampling.sample_rows(others, id_col, n, seed)
            model, _ = models.fit_model(train, target, family, params, numeric, categorical, seed)
            for part, data in (("train", train), ("test", held)):
                p = models.score(model, data, [target]).select(
                    F.lit(fold).alias("fold"), F.lit(float(size)).alias("size"), F.lit(part).alias("part"), F.col(target).alias("y"), "p"
                )
                scored = p if scored is None else scored.unionByName(p)
    keys = ["fold", "size", "part"]
    scored = materialise(scored, "curve_scores")
    if metric == "auc":
        values = metrics.roc_auc(scored, keys).withColumnRenamed("auc", "s")
    elif metric == "cost":
        values = metrics.business_cost(scored.withColumn("y_hat", decide(F.col("p"), 0.5)), keys).select(*keys, (-F.col("cost")).alias("s"))
    else:
        raise ValueError("metric must be 'auc' or 'cost'")
    table = local_table(df.sparkSession, list(taken.items()), "size double, n_train long")

    def over(part: str, fn):
        return fn(F.when(F.col("part") == part, F.col("s")))

    return (
        values.groupBy("size")
        .agg(
            over("train", F.avg).alias("train_mean"),
            over("train", F.stddev_pop).alias("train_std"),
            over("test", F.avg).alias("test_mean"),
            over("test", F.stddev_pop).alias("test_std"),
        )
        .join(table, "size")
        .orderBy("size")
    )
