"""Two-sample drift: Kolmogorov-Smirnov, chi-square, proportions, Wasserstein and Jensen-Shannon distances,
the choice among them, verdicts and change tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.functions.expr import align_common, col, columns_of_kind, drift_status, unpivot_numeric
from riskloom.functions.session import local_table, ship, small_table
from riskloom.functions.special import chi_square_tail_udf, exact_ks_tail_udf, kolmogorov_tail
from riskloom.operators.registry import ModelRegistry
from riskloom.operators.ordering import N_CUTS, ROW_LIMIT, bin_counts, cut_points, in_segment, range_index

EXACT_ROWS = 10_000  # values per sample up to which the p-value is exact
_KS_SCHEMA = "feature string, n_ref long, n_cur long, null_ref long, null_cur long, d double"


def _long_pair(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    ref = unpivot_numeric(reference, features).withColumn("is_ref", F.lit(1))
    cur = unpivot_numeric(current, features).withColumn("is_ref", F.lit(0))
    return ref.unionByName(cur)


def ks_statistics(reference: DataFrame, current: DataFrame, features: Sequence[str], row_limit: int = ROW_LIMIT) -> DataFrame:
    """``(feature, n_ref, n_cur, null_ref, null_cur, d)`` with the exact largest gap of the two ECDFs.

    A feature of up to ``row_limit`` values is swept directly after equal values are merged. A
    longer one is first counted in ranges: the gap at range edges is exact, and inside a range the
    gap cannot exceed what its two edges allow. Only ranges that could still beat the best edge
    are read again.
    """
    spark = reference.sparkSession
    long_df = _long_pair(reference, current, features)
    heads = {
        r["feature"]: r
        for r in long_df.groupBy("feature")
        .agg(
            F.count_if((F.col("is_ref") == 1) & F.col("value").isNotNull()).alias("n_ref"),
            F.count_if((F.col("is_ref") == 0) & F.col("value").isNotNull()).alias("n_cur"),
            F.count_if((F.col("is_ref") == 1) & F.col("value").isNull()).alias("null_ref"),
            F.count_if((F.col("is_ref") == 0) & F.col("value").isNull()).alias("null_cur"),
        )
        .collect()
    }
    best = {f: 0.0 for f, r in heads.items() if r["n_ref"] and r["n_cur"]}
    rows = long_df.where(F.col("value").isNotNull())
    # (feature, lo, hi, reference rows before, current rows before, rows inside)
    pending = [(f, None, None, 0, 0, heads[f]["n_ref"] + heads[f]["n_cur"]) for f in best]
    while pending:
        ready = [s for s in pending if s[5] <= row_limit]
        wide = [s for s in pending if s[5] > row_limit]
        pending = []
        if ready:
            for r in _gaps(spark, rows, ready, heads).collect():
                best[r["feature"]] = max(best[r["feature"]], r["gap"])
        if wide:
            pending = _narrow(spark, rows, wide, heads, best)
    out = []
    for f, r in heads.items():
        out.append((f, r["n_ref"], r["n_cur"], r["null_ref"], r["null_cur"], best.get(f)))
    return local_table(spark, out, _KS_SCHEMA)


def _gaps(spark, rows: DataFrame, segments: list, heads: dict) -> DataFrame:
    """Largest ECDF gap inside each segment, by a sweep over its merged values."""
    table = [(f, i, lo, hi, a, b, heads[f]["n_ref"], heads[f]["n_cur"]) for i, (f, lo, hi, a, b, _) in enumerate(segments)]
    segs = local_table(
        spark, table, "feature string, seg int, lo double, hi double, a long, b long, n_ref long, n_cur long"
    )
    inside = rows.join(segs, "feature").where(in_segment(F.col("value")))
    merged = inside.groupBy("feature", "seg", "a", "b", "n_ref", "n_cur", "value").agg(
        F.sum("is_ref").alias("r"), F.sum(1 - F.col("is_ref")).alias("c")
    )
    upto = Window.partitionBy("feature", "seg").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.abs(
        (F.col("a") + F.sum("r").over(upto)) / F.col("n_ref") - (F.col("b") + F.sum("c").over(upto)) / F.col("n_cur")
    )
    return merged.select("feature", gap.alias("gap")).groupBy("feature").agg(F.max("gap").alias("gap"))


def _narrow(spark, rows: DataFrame, wide: list, heads: dict, best: dict) -> list:
    """Range counts of long segments; raises ``best`` to the edge gaps, returns ranges still open."""
    table = [(f, i, lo, hi) for i, (f, lo, hi, *_) in enumerate(wide)]
    segs = local_table(spark, table, "feature string, seg int, lo double, hi double")
    inside = rows.join(segs, "feature").where(in_segment(F.col("value")))
    cuts = {r["seg"]: r["cuts"] for r in inside.groupBy("seg").agg(cut_points(F.col("value")).alias("cuts")).collect()}
    lookup = local_table(spark, list(cuts.items()), "seg int, cuts array<double>")
    counted = (
        inside.join(lookup, "seg")
        .groupBy("seg", range_index(F.col("value"), F.col("cuts")).alias("bin"))
        .agg(F.sum("is_ref").alias("r"), F.sum(1 - F.col("is_ref")).alias("c"))
        .collect()
    )
    state = {i: [s[3], s[4]] for i, s in enumerate(wide)}
    open_ranges = []
    for row in sorted(counted, key=lambda x: (x["seg"], x["bin"])):
        f, lo, hi, _, _, _ = wide[row["seg"]]
        a, b = state[row["seg"]]
        n_ref, n_cur = heads[f]["n_ref"], heads[f]["n_cur"]
        a2, b2 = a + row["r"], b + row["c"]
        best[f] = max(best[f], abs(a / n_ref - b / n_cur), abs(a2 / n_ref - b2 / n_cur))
        i, is_point = divmod(row["bin"], 2)
        if not is_point:
            ceiling = max(a2 / n_ref - b / n_cur, b2 / n_cur - a / n_ref)
            left = cuts[row["seg"]][i - 1] if i > 0 else lo
            right = cuts[row["seg"]][i] if i < N_CUTS else hi
            open_ranges.append((ceiling, (f, left, right, a, b, row["r"] + row["c"])))
        state[row["seg"]] = [a2, b2]
    return [s for ceiling, s in open_ranges if ceiling > best[s[0]]]


def ks_test(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    nan_policy: str = "propagate",
    row_limit: int = ROW_LIMIT,
    p_method: str = "auto",
) -> DataFrame:
    """Two-sample test per numeric feature.

    ``propagate``: a feature with any missing value has no p-value. ``omit``: missing values are
    left out of the test. The p-value is exact while both samples have at most 10,000 values and
    asymptotic beyond; ``p_method='asymptotic'`` never uses the exact one.
    """
    if p_method not in ("auto", "asymptotic"):
        raise ValueError("p_method must be 'auto' or 'asymptotic'")
    if nan_policy not in ("propagate", "omit"):
        raise ValueError("nan_policy must be 'propagate' or 'omit'")
    ship(reference.sparkSession)
    stats = ks_statistics(reference, current, features, row_limit)
    a, b = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    p = kolmogorov_tail(F.sqrt(F.try_divide(a * b, a + b)) * F.col("d"))
    if p_method == "auto":
        heads = stats.select("n_ref", "n_cur").collect()
        if any(max(h["n_ref"], h["n_cur"]) <= EXACT_ROWS for h in heads):
            few = F.greatest("n_ref", "n_cur") <= EXACT_ROWS
            exact = exact_ks_tail_udf(F.col("n_ref"), F.col("n_cur"), F.when(few, F.col("d")))
            stats = stats.withColumn("exact", exact)
            p = F.when(few, F.col("exact")).otherwise(p)
    empty = (F.col("n_ref") == 0) | (F.col("n_cur") == 0)
    dirty = (F.col("null_ref") + F.col("null_cur")) > 0
    bad = empty | dirty if nan_policy == "propagate" else empty
    reason = F.when(empty, "no values on one side")
    if nan_policy == "propagate":
        reason = reason.when(dirty, "missing values")
    return stats.select(
        "feature",
        F.lit("ks").alias("test"),
        F.when(~bad, F.col("d")).alias("statistic"),
        F.when(~bad, p).alias("p_value"),
        reason.alias("reason"),
    )


def category_counts(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, category, n_ref, n_cur)`` on the union of categories; nulls dropped, absent = 0."""

    def long_form(df: DataFrame, flag: int) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("feature"), col(c).cast("string").alias("category")) for c in features])
        return df.select(F.inline(pairs)).where(F.col("category").isNotNull()).withColumn("is_ref", F.lit(flag))

    return (
        long_form(reference, 1)
        .unionByName(long_form(current, 0))
        .groupBy("feature", "category")
        .agg(F.sum("is_ref").alias("n_ref"), F.sum(1 - F.col("is_ref")).alias("n_cur"))
    )


def chi_square_test(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """2 x K test per categorical feature; continuity correction for two categories.

    The correction moves each cell by at most one half and never past its expectation. One
    category gives p = 1; an empty side is inconclusive.
    """
    ship(reference.sparkSession)
    counts = category_counts(reference, current, features)
    totals = small_table(
        counts.groupBy("feature").agg(
            F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"), F.count("*").alias("k")
        )
    )
    joined = counts.join(totals, "feature")
    share = (F.col("n_ref") + F.col("n_cur")) / (F.col("t_ref") + F.col("t_cur"))

    def part(observed: str, total: str):
        expected = share * F.col(total)
        gap = F.abs(F.col(observed) - expected)
        moved = F.when(F.col("k") == 2, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return F.try_divide(moved * moved, expected)

    stat = joined.groupBy("feature").agg(F.sum(part("n_ref", "t_ref") + part("n_cur", "t_cur")).alias("statistic"))
    names = local_table(reference.sparkSession, [(f,) for f in features], "feature string")
    full = names.join(totals, "feature", "left").join(small_table(stat), "feature", "left")
    bad = F.col("k").isNull() | (F.col("t_ref") == 0) | (F.col("t_cur") == 0)
    dof = (F.col("k") - 1).cast("double")
    p = F.when(F.col("k") == 1, 1.0).otherwise(chi_square_tail_udf(F.col("statistic"), dof))
    return full.select(
        "feature",
        F.lit("chi_square").alias("test"),
        F.when(~bad, F.col("statistic")).alias("statistic"),
        F.when(~bad, p).alias("p_value"),
        F.when(bad, "no values on one side").alias("reason"),
    )


def drift_tests(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    nan_policy: str = "propagate",
    row_limit: int = ROW_LIMIT,
    p_method: str = "auto",
) -> DataFrame:
    """All features with statistic, p-value and status. Absent features are inconclusive, not fatal."""
    present = set(reference.columns) & set(current.columns)
    spark = reference.sparkSession
    parts = []
    num = [c for c in numeric if c in present]
    cat = [c for c in categorical if c in present]
    if num:
        parts.append(ks_test(reference, current, num, nan_policy, row_limit, p_method))
    if cat:
        parts.append(chi_square_test(reference, current, cat))
    lost = [(c, "ks", None, None, "column not in both sets") for c in numeric if c not in present]
    lost += [(c, "chi_square", None, None, "column not in both sets") for c in categorical if c not in present]
    if lost:
        schema = "feature string, test string, statistic double, p_value double, reason string"
        parts.append(local_table(spark, lost, schema))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", drift_status(F.col("p_value")))


def drift_verdict(tests: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Number and share of drifted features over all tested ones."""
    n, drifted = F.count("*"), F.count_if(F.col("status") == "drift")
    return tests.agg(
        n.alias("n_features"),
        drifted.alias("n_drifted"),
        F.count_if(F.col("status") == "inconclusive").alias("n_inconclusive"),
        F.try_divide(drifted, n).alias("share_drifted"),
    ).withColumn("dataset_drift", F.col("share_drifted") >= threshold)


def moments_table(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of both sets, and the change of the mean in percent (0 if it was 0)."""
    is_ref = F.col("is_ref") == 1
    stats = (
        _long_pair(reference, current, features)
        .groupBy("feature")
        .agg(
            F.avg(F.when(is_ref, F.col("value"))).alias("mean_ref"),
            F.stddev_samp(F.when(is_ref, F.col("value"))).alias("std_ref"),
            F.avg(F.when(~is_ref, F.col("value"))).alias("mean_cur"),
            F.stddev_samp(F.when(~is_ref, F.col("value"))).alias("std_cur"),
        )
    )
    base = F.abs(F.col("mean_ref"))
    change = F.when(base == 0, 0.0).otherwise(F.try_divide(F.col("mean_cur") - F.col("mean_ref"), base) * 100)
    return stats.withColumn("mean_pct_change", change)


def statistics_report(reference: DataFrame, current: DataFrame, features: Sequence[str], tests: DataFrame) -> DataFrame:
    """Moments of both sets next to the p-value, by feature name."""
    return (
        small_table(moments_table(reference, current, features))
        .join(tests.select("feature", "p_value", "status"), "feature", "left")
        .orderBy("feature")
    )


def drift_histograms(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 30) -> DataFrame:
    """Both distributions on shared edges, in percent of their own set."""
    rows = _long_pair(reference, current, features).withColumn(
        "data", F.when(F.col("is_ref") == 1, "reference").otherwise("current")
    )
    return bin_counts(rows, ["feature"], bins, ["data"])


def analyze_drift(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    nan_policy: str = "propagate",
    log_to: ModelRegistry | None = None,
    experiment: str = "drift",
    run_name: str = "data drift",
) -> dict[str, DataFrame]:
    """Tests, verdict, moments, histograms and the inconclusive list as named frames.

    With ``log_to`` the verdict's counts and the p-values are logged as a run.
    """
    tests = small_table(drift_tests(reference, current, numeric, categorical, nan_policy))
    if log_to is not None:
        told = drift_verdict(tests).first()
        counts = {c: told[c] for c in ("n_features", "n_drifted", "n_inconclusive", "share_drifted")}
        p_values = {f"p_value {r['feature']}": r["p_value"] for r in tests.collect() if r["p_value"] is not None}
        log_to.log_run(experiment, run_name, {"nan_policy": nan_policy}, counts | p_values)
    return {
        "tests": tests,
        "verdict": drift_verdict(tests),
        "inconclusive": tests.where(F.col("status") == "inconclusive").select("feature", "reason"),
        "statistics": statistics_report(reference, current, numeric, tests),
        "histograms": drift_histograms(reference, current, numeric),
    }


# -- distances and the choice of test -------------------------------------------------------------------------

# Fixed values of the report's rule: rows up to which tests are used, levels up to which a number counts
# as a category, and the limits of a p-value and of a distance.
SMALL_ROWS = 1_000
FEW_VALUES = 5
P_LIMIT = 0.05
DISTANCE_LIMIT = 0.1


def wasserstein_distances(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, distance)``: area between the two distribution functions, in deviations of the reference.

    Equal values are merged first. The axis is cut at sketched quantiles; the area inside a range comes
    from a window over its own values, the gap to the next range from the range totals, so no feature is
    sorted in one task. The deviation is the population's, 0.001 at least. Missing values are left out;
    a feature without values on one side has no distance.
    """
    rows = _long_pair(reference, current, features).where(F.col("value").isNotNull()).withColumn("is_cur", 1 - F.col("is_ref"))
    sketch = small_table(
        rows.groupBy("feature").agg(
            cut_points(F.col("value")).alias("cuts"),
            F.sum("is_ref").alias("n_ref"),
            F.sum("is_cur").alias("n_cur"),
            F.stddev_pop(F.when(F.col("is_ref") == 1, F.col("value"))).alias("spread"),
        )
    )
    merged = rows.groupBy("feature", "value").agg(F.sum("is_ref").alias("r"), F.sum("is_cur").alias("c"))
    ranged = merged.join(sketch.select("feature", "cuts"), "feature").withColumn("place", range_index(F.col("value"), F.col("cuts"))).drop("cuts")
    totals = ranged.groupBy("feature", "place").agg(F.sum("r").alias("r"), F.sum("c").alias("c"), F.min("value").alias("lo"))
    by_place = Window.partitionBy("feature").orderBy("place")
    before = by_place.rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    edges = small_table(totals.select("feature", "place", upto("r").alias("r0"), upto("c").alias("c0"), F.lead("lo").over(by_place).alias("follows")))
    inner = Window.partitionBy("feature", "place").orderBy("value")
    cum = inner.rowsBetween(Window.unboundedPreceding, 0)
    stepped = ranged.join(edges, ["feature", "place"]).select(
        "feature",
        "value",
        (F.col("r0") + F.sum("r").over(cum)).alias("r"),
        (F.col("c0") + F.sum("c").over(cum)).alias("c"),
        F.coalesce(F.lead("value").over(inner), F.col("follows")).alias("next"),
    )
    gap = F.abs(F.try_divide(F.col("r"), F.col("n_ref")) - F.try_divide(F.col("c"), F.col("n_cur")))
    area = F.sum(gap * (F.coalesce("next", F.col("value")) - F.col("value")))
    found = stepped.join(sketch.select("feature", "n_ref", "n_cur"), "feature").groupBy("feature").agg(area.alias("area"))
    whole = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    scaled = F.col("area") / F.greatest(F.col("spread"), F.lit(0.001))
    return small_table(found).join(sketch, "feature").select("feature", F.when(whole, scaled).alias("distance"))


def jensen_shannon_distances(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, distance)``: root of the divergence of both category shares from their mean (natural logarithm).

    Nulls are left out; a feature without values on one side has no distance.
    """
    counts = category_counts(reference, current, features)
    totals = small_table(counts.groupBy("feature").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur")))
    p, q = F.try_divide(F.col("n_ref"), F.col("t_ref")), F.try_divide(F.col("n_cur"), F.col("t_cur"))
    part = lambda a, b: F.when(a > 0, a * F.log(2.0 * a / (a + b))).otherwise(0.0)
    mean = counts.join(totals, "feature").groupBy("feature").agg((F.sum(part(p, q) + part(q, p)) / 2).alias("js"))
    whole = (F.col("t_ref") > 0) & (F.col("t_cur") > 0)
    return mean.join(totals, "feature").select("feature", F.when(whole, F.sqrt(F.greatest(F.col("js"), F.lit(0.0)))).alias("distance"))


def proportion_tests(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, statistic, p_value)``: z-test of the share of the larger of two values, with the pooled share."""
    ship(reference.sparkSession)
    counts = category_counts(reference, current, features)
    one = counts.groupBy("feature").agg(
        F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"), F.max_by("n_ref", "category").alias("a"), F.max_by("n_cur", "category").alias("b")
    )
    pooled = (F.col("a") + F.col("b")) / (F.col("t_ref") + F.col("t_cur"))
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), F.col("t_ref")) + F.try_divide(F.lit(1.0), F.col("t_cur"))))
    gap = F.try_divide(F.col("a"), F.col("t_ref")) - F.try_divide(F.col("b"), F.col("t_cur"))
    z = F.when(error > 0, gap / error).otherwise(F.when(gap.isNotNull(), 0.0))
    # The two-sided tail of a normal value is the chi-square tail of its square.
    return small_table(one.select("feature", z.alias("statistic"))).withColumn(
        "p_value", chi_square_tail_udf(F.col("statistic") * F.col("statistic"), F.lit(1.0))
    )


def choose_tests(reference: DataFrame, numeric: Sequence[str], categorical: Sequence[str], small_rows: int = SMALL_ROWS) -> DataFrame:
    """``(feature, kind, n_values, test)`` by type, distinct values of the reference and its number of rows.

    A number with at most five values counts as a category. Up to ``small_rows`` rows: Kolmogorov-Smirnov
    for numbers, a z-test for two values, chi-square for other categories. Beyond: Wasserstein distance for
    numbers, Jensen-Shannon distance for categories.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), col(c).cast("string").alias("v")) for c in [*numeric, *categorical]])
    levels = reference.select(F.inline(pairs)).groupBy("feature", "v").agg(F.count("*").alias("n"))
    known = small_table(levels.groupBy("feature").agg(F.count("v").alias("n_values")))
    few = reference.limit(small_rows + 1).count() <= small_rows
    number = F.col("feature").isin(*numeric) if numeric else F.lit(False)
    kind = F.when(number & (F.col("n_values") > FEW_VALUES), "number").when(F.col("n_values") == 2, "binary").otherwise("category")
    names = {"number": ("ks", "wasserstein"), "binary": ("z", "jensen_shannon"), "category": ("chi_square", "jensen_shannon")}
    test = None
    for k, pair in names.items():
        test = F.when(F.col("kind") == k, pair[0] if few else pair[1]) if test is None else test.when(F.col("kind") == k, pair[0] if few else pair[1])
    asked = local_table(reference.sparkSession, [(f,) for f in [*numeric, *categorical]], "feature string")
    full = asked.join(known, "feature", "left").na.fill(0, ["n_values"])
    return small_table(full.withColumn("kind", kind).withColumn("test", test))


def chosen_drift_tests(reference: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str], small_rows: int = SMALL_ROWS) -> DataFrame:
    """``(feature, test, statistic, p_value, limit, status)`` with the test that ``choose_tests`` picks for each feature.

    A test drifts below its p-value's limit, a distance from its limit on. One job per kind of test, not
    per feature. Missing values are left out.
    """
    choice = choose_tests(reference, numeric, categorical, small_rows)
    picked: dict[str, list[str]] = {}
    for r in choice.collect():  # one row a feature
        picked.setdefault(r["test"], []).append(r["feature"])
    none = F.lit(None).cast("double")
    parts = []
    if "ks" in picked:
        parts.append(ks_test(reference, current, picked["ks"], "omit").select("feature", "statistic", "p_value"))
    if "chi_square" in picked:
        parts.append(chi_square_test(reference, current, picked["chi_square"]).select("feature", "statistic", "p_value"))
    if "z" in picked:
        parts.append(proportion_tests(reference, current, picked["z"]))
    if "wasserstein" in picked:
        parts.append(wasserstein_distances(reference, current, picked["wasserstein"]).select("feature", F.col("distance").alias("statistic"), none.alias("p_value")))
    if "jensen_shannon" in picked:
        parts.append(jensen_shannon_distances(reference, current, picked["jensen_shannon"]).select("feature", F.col("distance").alias("statistic"), none.alias("p_value")))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    distance = F.col("test").isin("wasserstein", "jensen_shannon")
    drifted = F.when(distance, F.col("statistic") >= DISTANCE_LIMIT).otherwise(F.col("p_value") < P_LIMIT)
    status = F.when(drifted.isNull(), "inconclusive").when(drifted, "drift").otherwise("no_drift")
    return choice.select("feature", "test").join(found, "feature", "left").select(
        "feature", "test", "statistic", "p_value", F.when(distance, DISTANCE_LIMIT).otherwise(P_LIMIT).alias("limit"), status.alias("status")
    )


def drift_report(reference: DataFrame, current: DataFrame, drop: Sequence[str] = (), choose: bool = True, small_rows: int = SMALL_ROWS) -> dict[str, DataFrame]:
    """Drift over the columns both sets share.

    With ``choose`` each column gets the test that suits its type, values and number of rows; without,
    numbers are tested by Kolmogorov-Smirnov and strings by chi-square. Missing values are left out.
    """
    ref, cur = align_common(reference, current, drop)
    numeric = [c for c in columns_of_kind(ref) if c in set(columns_of_kind(cur))]
    categorical = [c for c in columns_of_kind(ref, "categorical") if c in set(columns_of_kind(cur, "categorical"))]
    if choose and (numeric or categorical):
        tests = chosen_drift_tests(ref, cur, numeric, categorical, small_rows)
    else:
        tests = drift_tests(ref, cur, numeric, categorical, "omit")
    tests = small_table(tests)
    return {"tests": tests, "verdict": drift_verdict(tests)}
