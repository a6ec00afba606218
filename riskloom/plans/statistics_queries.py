"""Queries on outliers, profiling, preprocessing and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.session import materialise
from riskloom.operators import drift, outliers, preparation, profile, sampling
from riskloom.plans.apps import APPS_SQL, CATEGORICAL, DRIFT_DATE, NUMERIC, applications, reference_current
from riskloom.plans.catalogue import SPLIT, query, u, with_micro


def _apps(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(applications(spark, sf), "apps")


def _train(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.split_rows(_apps(spark, sf), "app_id", "target").where("split = 'train'")


def _union(template: str, names: list[str] = NUMERIC) -> str:
    return " UNION ALL ".join(template.replace("{c}", c) for c in names)


# -- outliers ---------------------------------------------------------------------------------------

_STAT_ROWS = """SELECT '{c}' AS feature, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS mn, max({c}) AS mx,
 quantile_cont({c}, 0.01) AS q01, quantile_cont({c}, 0.05) AS q05, quantile_cont({c}, 0.25) AS q25,
 quantile_cont({c}, 0.75) AS q75, quantile_cont({c}, 0.95) AS q95, quantile_cont({c}, 0.99) AS q99 FROM src"""

_BOUNDS_CTE = f"""st AS ({_union(_STAT_ROWS)}),
bounds AS (
 SELECT 'Z-score (±3)' AS method, feature, mean - 3 * std AS lower, mean + 3 * std AS upper FROM st
 UNION ALL SELECT 'Z-score (±2)', feature, mean - 2 * std, mean + 2 * std FROM st
 UNION ALL SELECT 'IQR 1.5', feature, q25 - 1.5 * (q75 - q25), q75 + 1.5 * (q75 - q25) FROM st
 UNION ALL SELECT 'Quantile 1-99', feature, q01, q99 FROM st
 UNION ALL SELECT 'Quantile 5-95', feature, q05, q95 FROM st
 UNION ALL SELECT 'Full Range', feature, cast(mn AS double), cast(mx AS double) FROM st),
vals AS ({_union("SELECT '{c}' AS feature, cast({c} AS double) AS v FROM src")})"""

_SUMMARY_SQL = f"""base AS (
 SELECT method, feature, lower, upper, count(*) AS n, avg(v) AS mean, stddev_samp(v) AS std, skewness(v) AS skewness,
   count(*) FILTER (v < lower) AS n_below, count(*) FILTER (v > upper) AS n_above,
   avg(v) FILTER (v >= lower AND v <= upper) AS clean_mean, stddev_samp(v) FILTER (v >= lower AND v <= upper) AS clean_std
 FROM vals JOIN bounds USING (feature) WHERE v IS NOT NULL GROUP BY 1, 2, 3, 4)"""

_ALL_SRC = f"{APPS_SQL}, src AS (SELECT * FROM apps), {_BOUNDS_CTE}"


@query(
    "outlier_bounds",
    f"{SPLIT}, src AS (SELECT * FROM sp WHERE split = 'train'), {_BOUNDS_CTE} "
    f"SELECT method, feature, {u('lower')} AS lower, {u('upper')} AS upper FROM bounds",
)
def outlier_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return with_micro(outliers.fit_bounds(_train(spark, sf), NUMERIC), "lower", "upper")


@query(
    "outlier_summary",
    f"""{_ALL_SRC}, {_SUMMARY_SQL}
    SELECT method, feature, n_below + n_above AS outlier_count, {u('(n_below + n_above) * 100.0 / n')} AS outlier_pct,
      {u('lower')} AS lower, {u('upper')} AS upper, n_below, n_above, {u('mean')} AS mean, {u('clean_mean')} AS clean_mean,
      {u('CASE WHEN clean_mean <> 0 THEN (mean - clean_mean) / clean_mean * 100 ELSE 0 END')} AS mean_pct_change,
      {u('skewness')} AS skewness FROM base""",
)
def outlier_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = outliers.outlier_summary(_apps(spark, sf), NUMERIC).drop("std", "clean_std")
    return with_micro(out, "outlier_pct", "lower", "upper", "mean", "clean_mean", "mean_pct_change", "skewness")


@query(
    "outlier_method_comparison",
    f"""{_ALL_SRC}, {_SUMMARY_SQL}
    SELECT method, {u('lower')} AS lower, {u('upper')} AS upper, n_below + n_above AS outlier_count,
      {u('(n_below + n_above) * 100.0 / n')} AS outlier_pct, {u('mean')} AS mean_with_outliers,
      {u('clean_mean')} AS mean_without_outliers, {u('std')} AS std_with_outliers, {u('clean_std')} AS std_without_outliers
    FROM base WHERE feature = 'amt_goods'""",
)
def outlier_method_comparison(spark: SparkSession, sf: str) -> DataFrame:
    out = outliers.compare_methods(_apps(spark, sf), "amt_goods")
    return with_micro(out, *[c for c in out.columns if c not in ("method", "outlier_count")])


@query(
    "skewness",
    f"{APPS_SQL}, src AS (SELECT * FROM apps) "
    + _union(f"SELECT '{{c}}' AS feature, {u('skewness({c})')} AS skewness FROM src"),
)
def skewness(spark: SparkSession, sf: str) -> DataFrame:
    from riskloom.functions.expr import unpivot_numeric

    long_df = unpivot_numeric(applications(spark, sf), NUMERIC)
    return with_micro(long_df.groupBy("feature").agg(outliers.corrected_skewness(F.col("value")).alias("skewness")), "skewness")


# -- profiling --------------------------------------------------------------------------------------


@query("target_distribution", f"{APPS_SQL} SELECT target, count(*) AS n FROM apps GROUP BY 1")
def target_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return profile.target_distribution(applications(spark, sf), "target")


@query(
    "target_distribution_with_null",
    "SELECT quality AS target, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
)
def target_distribution_with_null(spark: SparkSession, sf: str) -> DataFrame:
    from riskloom.plans.apps import read

    joined = read(spark, sf, "documents").select("doc_id").join(read(spark, sf, "labels"), "doc_id", "left")
    return profile.target_distribution(joined, "quality", keep_null=True)


_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS row_name, '{b}' AS col_name, {u(f'corr({a}, {b})')} AS corr FROM apps" for a in NUMERIC for b in NUMERIC
)
_LOWER_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS row_name, '{b}' AS col_name, {u(f'corr({a}, {b})') if i > j else 'cast(0 AS bigint)'} AS corr FROM apps"
    + ("" if i > j else " GROUP BY ALL")
    for i, a in enumerate(NUMERIC)
    for j, b in enumerate(NUMERIC)
)


@query("correlation_matrix", f"{APPS_SQL} {_CORR_SQL}")
def correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.correlation_pairs(applications(spark, sf), NUMERIC)
    return with_micro(out.select(F.col("row").alias("row_name"), F.col("col").alias("col_name"), "corr"), "corr")


@query("correlation_lower_triangle", f"{APPS_SQL} SELECT DISTINCT * FROM ({_LOWER_SQL})")
def correlation_lower_triangle(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.lower_triangle(profile.correlation_pairs(applications(spark, sf), NUMERIC))
    return with_micro(out.select(F.col("row").alias("row_name"), F.col("col").alias("col_name"), "corr"), "corr")


def _hist_sql(bins: int, group: str = "'all'") -> str:
    """Counts per feature, group and bin on the feature's own edges."""
    return f"""v AS ({_union(f"SELECT '{{c}}' AS feature, {group} AS grp, cast({{c}} AS double) AS v FROM src WHERE {{c}} IS NOT NULL")}),
    lim AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM v GROUP BY 1),
    b AS (SELECT feature, grp, cast(greatest(0, least({bins - 1}, floor((v - lo) / ((hi - lo) / {float(bins)}::double)))) AS int) AS bin
      FROM v JOIN lim USING (feature)),
    cnt AS (SELECT feature, grp, bin, count(*) AS n FROM b GROUP BY ALL),
    tot AS (SELECT feature, grp, sum(n) AS total FROM cnt GROUP BY ALL),
    hist AS (SELECT feature, grp, cast(g.bin AS int) AS bin, coalesce(n, 0) AS n, {u('100.0::double * coalesce(n, 0) / total')} AS pct,
      {u(f'lo + g.bin * ((hi - lo) / {float(bins)}::double)')} AS left_edge
      FROM tot JOIN lim USING (feature) CROSS JOIN range({bins}) g(bin) LEFT JOIN cnt USING (feature, grp, bin))"""


@query(
    "histograms",
    f"{APPS_SQL}, src AS (SELECT * FROM apps), {_hist_sql(30)} SELECT feature, bin, n, pct, left_edge FROM hist",
)
def histograms(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.histograms(_apps(spark, sf), NUMERIC, 30)
    return with_micro(out.drop("right_edge"), "left_edge", "pct")


@query(
    "box_stats",
    f"""{APPS_SQL}, q AS ({_union("SELECT '{c}' AS feature, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM apps")}),
    v AS ({_union("SELECT '{c}' AS feature, cast({c} AS double) AS v FROM apps WHERE {c} IS NOT NULL")}),
    j AS (SELECT *, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM v JOIN q USING (feature))
    SELECT feature, {u('max(q1)')} AS q1, {u('max(median)')} AS median, {u('max(q3)')} AS q3,
      {u('min(v) FILTER (inside)')} AS whisker_low, {u('max(v) FILTER (inside)')} AS whisker_high,
      count(*) FILTER (NOT inside) AS n_outside FROM j GROUP BY 1""",
)
def box_stats(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.box_stats(_apps(spark, sf), NUMERIC)
    return with_micro(out, "q1", "median", "q3", "whisker_low", "whisker_high")


_SUMMARY_NUM = _union(
    f"""SELECT '{{c}}' AS feature, count(*) AS n_rows, count(*) - count({{c}}) AS n_missing, count(DISTINCT {{c}}) AS n_distinct,
 {u('min({c})')} AS min, {u('max({c})')} AS max, {u('avg({c})')} AS mean, {u('stddev_samp({c})')} AS std,
 {u('quantile_cont({c}, 0.25)')} AS q25, {u('quantile_cont({c}, 0.5)')} AS median, {u('quantile_cont({c}, 0.75)')} AS q75 FROM apps"""
)
_SUMMARY_CAT = _union(
    "SELECT '{c}' AS feature, count(*) AS n_rows, count(*) - count({c}) AS n_missing, count(DISTINCT {c}) AS n_distinct, "
    "NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM apps",
    CATEGORICAL,
)


@query("dataset_summary", f"{APPS_SQL} {_SUMMARY_NUM} UNION ALL {_SUMMARY_CAT}")
def dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.dataset_summary(_apps(spark, sf), NUMERIC + CATEGORICAL)
    return with_micro(out, "min", "max", "mean", "std", "q25", "median", "q75")


def _rint(e: str, scale: int) -> str:
    return u(f"round_even(({e}) * {scale}, 0) / {scale}")


@query(
    "cluster_profile",
    f"""{APPS_SQL} SELECT cat_segment AS cluster, count(*) AS size,
    {_rint('count(*)::double / (SELECT count(*) FROM apps) * 100', 10)} AS pct,
    {", ".join(f"{_rint(f'avg({c})', 1000)} AS {c}" for c in NUMERIC)} FROM apps GROUP BY 1""",
)
def cluster_profile(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.cluster_profile(applications(spark, sf), "cat_segment", NUMERIC)
    return with_micro(out, "pct", *NUMERIC)


@query(
    "cluster_sizes",
    f"""{APPS_SQL}, l AS (SELECT cast(coalesce(n_lines, 0) AS int) - 1 AS cluster FROM apps)
    SELECT cluster, CASE WHEN cluster = -1 THEN 'Noise' ELSE 'Cluster ' || cluster END AS name, count(*) AS size,
    {u('count(*) * 100.0 / (SELECT count(*) FROM l)')} AS pct FROM l GROUP BY 1, 2""",
)
def cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    labelled = applications(spark, sf).select((F.coalesce(F.col("n_lines"), F.lit(0)).cast("int") - 1).alias("label"))
    return with_micro(profile.cluster_sizes(labelled, "label"), "pct")


@query(
    "top_rows",
    f"""{APPS_SQL}, g AS (SELECT cat_segment || '/' || cat_priority AS name, count(*) FILTER (target = 1) AS score FROM apps GROUP BY 1)
    SELECT name, score, row_number() OVER (ORDER BY score DESC, name) AS rank FROM g QUALIFY rank <= 10""",
)
def top_rows(spark: SparkSession, sf: str) -> DataFrame:
    grouped = (
        applications(spark, sf)
        .groupBy(F.concat_ws("/", "cat_segment", "cat_priority").alias("name"))
        .agg(F.count_if(F.col("target") == 1).alias("score"))
    )
    return profile.ranked_features(grouped, "score", "name", 10)


@query(
    "long_to_grid",
    f"""{APPS_SQL} SELECT cat_segment, """
    + ", ".join(f"nullif(count(*) FILTER (cat_status = '{s}'), 0) AS {s}" for s in "FOP")
    + " FROM apps GROUP BY 1",
)
def long_to_grid(spark: SparkSession, sf: str) -> DataFrame:
    long_df = applications(spark, sf).groupBy("cat_segment", "cat_status").agg(F.count("*").alias("n"))
    return profile.pivot_grid(long_df, "cat_segment", "cat_status", "n")


# -- preprocessing ------------------------------------------------------------------------------------


@query(
    "scaler_parameters",
    f"{SPLIT}, src AS (SELECT * FROM sp WHERE split = 'train') "
    + _union(
        f"SELECT '{{c}}' AS feature, {u('avg({c})')} AS mean, {u('CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END')} AS scale FROM src"
    ),
)
def scaler_parameters(spark: SparkSession, sf: str) -> DataFrame:
    return with_micro(preparation.fit_scaler(_train(spark, sf), NUMERIC).drop("n"), "mean", "scale")


@query(
    "median_parameters",
    f"{SPLIT}, src AS (SELECT * FROM sp WHERE split = 'train') "
    + _union(f"SELECT '{{c}}' AS feature, {u('quantile_cont({c}, 0.5)')} AS median FROM src"),
)
def median_parameters(spark: SparkSession, sf: str) -> DataFrame:
    return with_micro(preparation.fit_medians(_train(spark, sf), NUMERIC), "median")


_LEVELS = {
    "cat_priority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "cat_segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "cat_status": ["F", "O", "P"],
}
_PARAMS = ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS s_{c}, quantile_cont({c}, 0.5) AS d_{c}"
    for c in NUMERIC
)
_PREPARED = ", ".join(
    [f"{u(f'(coalesce({c}, d_{c}) - m_{c}) / s_{c}')} AS num__{c}" for c in NUMERIC]
    + [f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END AS ind__{c}_origin" for c in NUMERIC]
    + [
        f"CASE WHEN coalesce({c}, 'missing') = '{v}' THEN 1 ELSE 0 END AS \"cat__{c}_{v}\""
        for c in ("cat_segment", "cat_status")
        for v in _LEVELS[c]
    ]
)


@query(
    "preprocessed",
    f"{SPLIT}, p AS (SELECT {_PARAMS} FROM sp WHERE split = 'train') SELECT app_id, split, {_PREPARED} FROM sp CROSS JOIN p",
)
def preprocessed(spark: SparkSession, sf: str) -> DataFrame:
    """Scale, median fill, presence flags and one-hot, fitted on train, applied to every split."""
    split = sampling.split_rows(_apps(spark, sf), "app_id", "target")
    prep = preparation.Preprocessor.fit(split.where("split = 'train'"), NUMERIC, ["cat_segment", "cat_status"])
    out = prep.transform(split, ["app_id", "split"])
    return with_micro(out, *[f"num__{c}" for c in NUMERIC])


@query(
    "one_hot",
    f"{SPLIT} SELECT app_id, "
    + ", ".join(f"CASE WHEN cat_priority = '{v}' THEN 1 ELSE 0 END AS \"cat__cat_priority_{v}\"" for v in _LEVELS["cat_priority"])
    + " FROM sp WHERE split <> 'train'",
)
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    split = sampling.split_rows(_apps(spark, sf), "app_id", "target")
    prep = preparation.Preprocessor.fit(split.where("split = 'train'"), [], ["cat_priority"])
    return prep.transform(split.where("split <> 'train'"), ["app_id"])


@query(
    "category_levels",
    f"{APPS_SQL} " + " UNION ".join(f"SELECT '{c}' AS feature, coalesce({c}, 'missing') AS level FROM apps" for c in CATEGORICAL),
)
def category_levels(spark: SparkSession, sf: str) -> DataFrame:
    return preparation.fit_levels(applications(spark, sf), CATEGORICAL)


_KNN_COLS = ["amt_credit", "amt_income", "amt_goods", "qty", "disc"]


@query(
    "neighbour_imputation",
    f"""{APPS_SQL}, p AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _KNN_COLS)} FROM apps),
    z AS (SELECT app_id, {", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in _KNN_COLS)} FROM apps CROSS JOIN p),
    donors AS (SELECT * FROM z),
    gap AS (SELECT * FROM z WHERE {" OR ".join(f"{c} IS NULL" for c in _KNN_COLS)}),
    d AS (SELECT gap.app_id, donors.app_id AS donor,
      ({" + ".join(f"coalesce((gap.{c} - donors.{c}) * (gap.{c} - donors.{c}), 0)" for c in _KNN_COLS)}) * 5
      / nullif({" + ".join(f"CASE WHEN gap.{c} IS NULL OR donors.{c} IS NULL THEN 0 ELSE 1 END" for c in _KNN_COLS)}, 0) AS dist,
      {", ".join(f"donors.{c} AS {c}" for c in _KNN_COLS)} FROM gap CROSS JOIN donors),
    f AS ({" UNION ALL ".join(f"SELECT app_id, '{c}' AS feature, avg({c}) AS v FROM (SELECT app_id, {c}, row_number() OVER (PARTITION BY app_id ORDER BY dist, donor) AS r FROM d WHERE {c} IS NOT NULL AND dist IS NOT NULL) WHERE r <= 5 GROUP BY 1" for c in _KNN_COLS)})
    SELECT app_id, {", ".join(u(f"coalesce(z.{c}, (SELECT v FROM f WHERE f.app_id = z.app_id AND feature = '{c}'))") + f" AS {c}" for c in _KNN_COLS)}
    FROM z""",
)
def neighbour_imputation(spark: SparkSession, sf: str) -> DataFrame:
    """Scaled values, gaps filled from the five nearest of all rows."""
    apps = _apps(spark, sf).select("app_id", *_KNN_COLS)
    scale = {r["feature"]: r for r in preparation.fit_scaler(apps, _KNN_COLS).collect()}
    z = apps.select(
        "app_id", *[preparation.scaled(F.col(c), scale[c]["mean"], scale[c]["scale"]).alias(c) for c in _KNN_COLS]
    )
    imputer = preparation.NeighbourImputer.fit(z, _KNN_COLS, "app_id")
    return with_micro(imputer.transform(z), *_KNN_COLS)


# -- drift ----------------------------------------------------------------------------------------------

_REF = f"app_date < date '{DRIFT_DATE}'"
_KS_D = f"""v AS ({_union(f"SELECT '{{c}}' AS feature, cast({{c}} AS double) AS v, CASE WHEN {_REF} THEN 1 ELSE 0 END AS r FROM apps WHERE {{c}} IS NOT NULL")}),
 m AS (SELECT feature, v, sum(r) AS r, sum(1 - r) AS c FROM v GROUP BY 1, 2),
 w AS (SELECT feature, sum(r) OVER (PARTITION BY feature ORDER BY v)::double / sum(r) OVER (PARTITION BY feature) AS fr,
   sum(c) OVER (PARTITION BY feature ORDER BY v)::double / sum(c) OVER (PARTITION BY feature) AS fc FROM m),
 sizes AS (SELECT feature, sum(r)::double AS n1, sum(c)::double AS n2 FROM m GROUP BY 1),
 ks AS (SELECT feature, max(abs(fr - fc)) AS d FROM w GROUP BY 1),
 lam AS (SELECT feature, d, sqrt(n1 * n2 / (n1 + n2)) * d AS l FROM ks JOIN sizes USING (feature)),
 ser AS (SELECT feature, d, l, sum(CASE WHEN k % 2 = 1 THEN 1.0::double ELSE -1.0::double END * exp(-2.0::double * k * k * l * l)) AS t
   FROM lam CROSS JOIN range(1, 101) g(k) GROUP BY ALL),
 ksp AS (SELECT feature, d, CASE WHEN l < 0.2 THEN 1.0::double ELSE greatest(0.0::double, least(1.0::double, 2.0 * t)) END AS p FROM ser)"""
_NULLS = _union("SELECT '{c}' AS feature, count(*) - count({c}) AS n_null FROM apps")


@query(
    "ks_drift",
    f"{APPS_SQL}, {_KS_D} SELECT feature, {u('d')} AS statistic, {u('p')} AS p_value FROM ksp",
)
def ks_drift(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = reference_current(_apps(spark, sf))
    out = drift.ks_test(ref, cur, NUMERIC, nan_policy="omit", p_method="asymptotic").select("feature", "statistic", "p_value")
    return with_micro(out, "statistic", "p_value")


@query("ks_p_values")
def ks_p_values(spark: SparkSession, sf: str) -> DataFrame:
    """Exact p-values while the samples are small; the exact tail is checked by enumeration in the tests."""
    ref, cur = reference_current(_apps(spark, sf))
    return drift.ks_test(ref, cur, NUMERIC, nan_policy="omit").select("feature", "statistic", "p_value")


_CHI = f"""o AS ({_union(f"SELECT '{{c}}' AS feature, {{c}} AS cat, count(*) FILTER ({_REF})::double AS a, count(*) FILTER (NOT ({_REF}))::double AS b FROM apps WHERE {{c}} IS NOT NULL GROUP BY 2", CATEGORICAL)}),
 t AS (SELECT feature, sum(a) AS ta, sum(b) AS tb, count(*) AS k FROM o GROUP BY 1),
 e AS (SELECT feature, k, a, b, (a + b) / (ta + tb) * ta AS ea, (a + b) / (ta + tb) * tb AS eb FROM o JOIN t USING (feature)),
 x AS (SELECT feature, k, CASE WHEN k = 2 THEN abs(a - ea) - least(0.5, abs(a - ea)) ELSE abs(a - ea) END AS da,
   CASE WHEN k = 2 THEN abs(b - eb) - least(0.5, abs(b - eb)) ELSE abs(b - eb) END AS db, ea, eb FROM e)"""


@query(
    "chi_square_drift",
    f"{APPS_SQL}, {_CHI} SELECT feature, {u('sum(da * da / ea + db * db / eb)')} AS statistic FROM x GROUP BY 1",
)
def chi_square_drift(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = reference_current(_apps(spark, sf))
    return with_micro(drift.chi_square_test(ref, cur, CATEGORICAL).select("feature", "statistic"), "statistic")


# The tail has a closed form for an even number of degrees of freedom, here 2 and 4.
@query(
    "chi_square_p_values",
    f"""{APPS_SQL}, {_CHI}, s AS (SELECT feature, max(k) AS k, sum(da * da / ea + db * db / eb) AS s FROM x GROUP BY 1)
    SELECT feature, {u('exp(-s / 2) * CASE k WHEN 3 THEN 1 WHEN 5 THEN 1 + s / 2 END')} AS p_value FROM s""",
)
def chi_square_p_values(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = reference_current(_apps(spark, sf))
    return with_micro(drift.chi_square_test(ref, cur, CATEGORICAL).select("feature", "p_value"), "p_value")


@query(
    "drift_status",
    f"""{APPS_SQL}, {_KS_D}, nu AS ({_NULLS})
    SELECT feature, CASE WHEN n_null > 0 THEN 'inconclusive' WHEN p < 0.05 THEN 'drift' ELSE 'no_drift' END AS status,
      CASE WHEN n_null > 0 THEN 'missing values' END AS reason FROM ksp JOIN nu USING (feature)""",
)
def drift_status(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = reference_current(_apps(spark, sf))
    return drift.drift_tests(ref, cur, NUMERIC, [], p_method="asymptotic").select("feature", "status", "reason")


@query(
    "drift_verdict",
    f"""{APPS_SQL}, {_KS_D}, nu AS ({_NULLS}), s AS (SELECT CASE WHEN n_null > 0 THEN 'inconclusive' WHEN p < 0.05 THEN 'drift'
      ELSE 'no_drift' END AS status FROM ksp JOIN nu USING (feature))
    SELECT count(*) AS n_features, count(*) FILTER (status = 'drift') AS n_drifted,
      count(*) FILTER (status = 'inconclusive') AS n_inconclusive,
      {u("count(*) FILTER (status = 'drift') / count(*)")} AS share_drifted FROM s""",
)
def drift_verdict(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = reference_current(_apps(spark, sf))
    out = drift.drift_verdict(drift.drift_tests(ref, cur, NUMERIC, [], p_method="asymptotic"))
    return with_micro(out.drop("dataset_drift"), "share_drifted")


_MOMENTS = _union(
    f"""SELECT '{{c}}' AS feature, avg({{c}}) FILTER ({_REF}) AS mean_ref, stddev_samp({{c}}) FILTER ({_REF}) AS std_ref,
 avg({{c}}) FILTER (NOT ({_REF})) AS mean_cur, stddev_samp({{c}}) FILTER (NOT ({_REF})) AS std_cur FROM apps"""
)


@query(
    "drift_statistics",
    f"""{APPS_SQL}, {_KS_D}, nu AS ({_NULLS}), mo AS ({_MOMENTS})
    SELECT feature, {u('mean_ref')} AS mean_ref, {u('std_ref')} AS std_ref, {u('mean_cur')} AS mean_cur, {u('std_cur')} AS std_cur,
      {u('CASE WHEN mean_ref = 0 THEN 0 ELSE (mean_cur - mean_ref) / abs(mean_ref) * 100 END')} AS mean_pct_change,
      CASE WHEN n_null = 0 THEN {u('p')} END AS p_value
    FROM mo JOIN ksp USING (feature) JOIN nu USING (feature)""",
)
def drift_statistics(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = reference_current(_apps(spark, sf))
    tests = drift.drift_tests(ref, cur, NUMERIC, [], p_method="asymptotic")
    out = drift.statistics_report(ref, cur, NUMERIC, tests).drop("status")
    return with_micro(out, "mean_ref", "std_ref", "mean_cur", "std_cur", "mean_pct_change", "p_value")


_GROUP = f"CASE WHEN {_REF} THEN 'reference' ELSE 'current' END"


@query(
    "drift_histograms",
    f"{APPS_SQL}, src AS (SELECT * FROM apps), {_hist_sql(30, _GROUP)} SELECT feature, grp AS data, bin, n, pct, left_edge FROM hist",
)
def drift_histograms(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = reference_current(_apps(spark, sf))
    out = drift.drift_histograms(ref, cur, NUMERIC)
    return with_micro(out.drop("right_edge"), "left_edge", "pct")


@query(
    "drift_report",
    """WITH e AS (SELECT event_type, value, ts < (SELECT min(ts) + INTERVAL 15 DAY FROM events) AS is_ref FROM events),
    m AS (SELECT value AS v, sum(CASE WHEN is_ref THEN 1 ELSE 0 END) AS r, sum(CASE WHEN is_ref THEN 0 ELSE 1 END) AS c
      FROM e WHERE value IS NOT NULL GROUP BY 1),
    w AS (SELECT sum(r) OVER (ORDER BY v)::double / sum(r) OVER () AS fr, sum(c) OVER (ORDER BY v)::double / sum(c) OVER () AS fc FROM m),
    o AS (SELECT event_type, count(*) FILTER (is_ref)::double AS a, count(*) FILTER (NOT is_ref)::double AS b FROM e GROUP BY 1),
    t AS (SELECT sum(a) AS ta, sum(b) AS tb FROM o),
    x AS (SELECT a, b, (a + b) / (ta + tb) * ta AS ea, (a + b) / (ta + tb) * tb AS eb FROM o CROSS JOIN t)
    SELECT 'value' AS feature, 'ks' AS test, """
    + u("(SELECT max(abs(fr - fc)) FROM w)")
    + """ AS statistic UNION ALL
    SELECT 'event_type', 'chi_square', """
    + u("(SELECT sum((a - ea) * (a - ea) / ea + (b - eb) * (b - eb) / eb) FROM x)"),
)
def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    """Shared columns of the first and the second half of the event period."""
    from riskloom.plans.apps import read

    events = read(spark, sf, "events")
    start = events.agg(F.min("ts").cast("string").alias("t")).first()["t"]
    border = F.lit(start).cast(events.schema["ts"].dataType) + F.expr("INTERVAL 15 DAY")
    ref = events.where(F.col("ts") < border).select("event_id", "event_type", "value")
    cur = events.where(F.col("ts") >= border).select("value", "event_type", "user_id")
    tests = drift.drift_report(ref, cur, choose=False)["tests"]
    return with_micro(tests.select("feature", "test", "statistic"), "statistic")


_DISTANCES = f"""{_KS_D.split(" sizes AS")[0].replace("w AS (SELECT feature,", "w AS (SELECT feature, v,")}
 g AS (SELECT feature, abs(fr - fc) * (lead(v) OVER (PARTITION BY feature ORDER BY v) - v) AS area FROM w),
 sp AS ({_union(f"SELECT '{{c}}' AS feature, stddev_pop({{c}}) FILTER ({_REF}) AS spread FROM apps")}),
 wd AS (SELECT feature, sum(area) / greatest(max(spread), 0.001) AS distance FROM g JOIN sp USING (feature) GROUP BY 1),
 {_CHI.split(" e AS")[0]}
 pq AS (SELECT feature, a / ta AS p, b / tb AS q FROM o JOIN t USING (feature)),
 js AS (SELECT feature, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS distance
   FROM pq GROUP BY 1)"""


@query(
    "drift_distances",
    f"{APPS_SQL}, {_DISTANCES} SELECT feature, 'wasserstein' AS test, {u('distance')} AS distance FROM wd UNION ALL SELECT feature, 'jensen_shannon', {u('distance')} FROM js",
)
def drift_distances(spark: SparkSession, sf: str) -> DataFrame:
    """Area between the distribution functions of numbers, distance of the shares of categories."""
    ref, cur = reference_current(_apps(spark, sf))
    w = drift.wasserstein_distances(ref, cur, NUMERIC).withColumn("test", F.lit("wasserstein"))
    j = drift.jensen_shannon_distances(ref, cur, CATEGORICAL).withColumn("test", F.lit("jensen_shannon"))
    return with_micro(w.unionByName(j).select("feature", "test", "distance"), "distance")


@query(
    "drift_choice",
    f"""{APPS_SQL}, {_DISTANCES}, few AS (SELECT count(*) FILTER ({_REF}) <= 100 AS small FROM apps),
    nv AS ({_union(f"SELECT '{{c}}' AS feature, count(DISTINCT {{c}}) FILTER ({_REF}) AS n_values FROM apps", [*NUMERIC, *CATEGORICAL])}),
    al AS (SELECT * FROM wd UNION ALL SELECT * FROM js)
    SELECT feature, CASE WHEN feature IN (SELECT feature FROM wd) THEN 'wasserstein' ELSE 'jensen_shannon' END AS test, {u('distance')} AS statistic,
      CASE WHEN distance >= 0.1 THEN 'drift' ELSE 'no_drift' END AS status FROM al JOIN nv USING (feature)
    WHERE NOT (SELECT small FROM few)""",
)
def drift_choice(spark: SparkSession, sf: str) -> DataFrame:
    """The report over all shared columns, each with the test chosen for it; more than 100 rows count as many."""
    ref, cur = reference_current(_apps(spark, sf))
    names = ["app_id", *NUMERIC, *CATEGORICAL]
    tests = drift.drift_report(ref.select(*names), cur.select(*names), drop=["app_id"], small_rows=100)["tests"]
    return with_micro(tests.select("feature", "test", "statistic", "status"), "statistic")
