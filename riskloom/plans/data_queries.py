"""Queries on sources, projections, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import expr as X
from riskloom.functions.session import materialise, work_dir
from riskloom.operators import outliers, sampling
from riskloom.operators.preparation import presence_indicators
from riskloom.plans.apps import APPS_SQL, NUMERIC, RATIOS, applications, read, reference_current, scored
from riskloom.plans.catalogue import SCORES, SPLIT, micro, query, u, with_micro
from riskloom.sources.lookup import build_scenarios, form_overrides, lookup_entities, select_ids, to_json_records
from riskloom.sources.tables import Database, TableLoader, create_database


def _apps(spark: SparkSession, sf: str) -> DataFrame:
    """The joined table, written once: the operators below read it several times."""
    return materialise(applications(spark, sf), "apps")


@query("csv_load", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_load(spark: SparkSession, sf: str) -> DataFrame:
    source = read(spark, sf, "customer")
    base = f"{work_dir(spark)}/csv-{spark.sparkContext.applicationId}"
    source.write.mode("overwrite").option("header", True).csv(f"{base}/customer.csv")
    return TableLoader(spark, base, {"customer": source.schema}).load("customer.csv")


@query(
    "database_round_trip",
    "SELECT n_name, r_name, count(*) AS n_suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2",
)
def database_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{work_dir(spark)}/db-{spark.sparkContext.applicationId}"
    create_database({t: read(spark, sf, t) for t in ("nation", "region", "supplier")}, path)
    db = Database(spark, path)
    suppliers = db.read_table("supplier")
    nations = db.read_table("nation").join(db.read_table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "r_name")
        .agg(F.count("*").alias("n_suppliers"))
    )


_SEGMENT_SQL = """
SELECT c_mktsegment, o_orderpriority, count(*) AS n_orders,
       cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS total
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = {status}
GROUP BY GROUPING SETS ((c_mktsegment, o_orderpriority), (c_mktsegment), ())"""


@query("sql_text", _SEGMENT_SQL.format(status="'F'"))
def sql_text(spark: SparkSession, sf: str) -> DataFrame:
    return Database(spark, sf, ".parquet").execute_query(_SEGMENT_SQL.format(status=":status"), {"status": "F"})


@query(
    "sql_text_cached",
    "SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY 1",
)
def sql_text_cached(spark: SparkSession, sf: str) -> DataFrame:
    db = Database(spark, sf, ".parquet")
    sql = "SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY 1"
    return db.execute_query(sql, cache_key="orders by status")


@query(
    "entity_lookup",
    """WITH req AS (SELECT DISTINCT l_orderkey + l_suppkey AS o_orderkey FROM lineitem),
    a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate < date '1998-01-01'),
    b AS (SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderdate >= date '1997-06-01')
    SELECT o_orderkey, CASE WHEN a.o_orderkey IS NOT NULL THEN a.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
           a.o_orderpriority AS o_orderpriority, CASE WHEN a.o_orderkey IS NULL THEN b.o_custkey END AS o_custkey,
           CASE WHEN a.o_orderkey IS NOT NULL THEN 'train' WHEN b.o_orderkey IS NOT NULL THEN 'test' END AS found_in
    FROM req LEFT JOIN a USING (o_orderkey) LEFT JOIN b USING (o_orderkey)""",
)
def entity_lookup(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders")
    wanted = read(spark, sf, "lineitem").select((F.col("l_orderkey") + F.col("l_suppkey")).alias("o_orderkey"))
    first = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("date"))
    second = orders.where(F.col("o_orderdate") >= F.lit("1997-06-01").cast("date"))
    return lookup_entities(
        wanted,
        first.select("o_orderkey", "o_orderstatus", "o_orderpriority"),
        second.select("o_orderkey", "o_orderstatus", "o_custkey"),
        "o_orderkey",
    )


@query(
    "json_records",
    f"""{APPS_SQL} SELECT app_id, cast(to_json({{'app_id': app_id, 'target': target, 'n_lines': n_lines,
    'cat_priority': cat_priority, 'cat_segment': cat_segment}}) AS varchar) AS record FROM apps""",
)
def json_records(spark: SparkSession, sf: str) -> DataFrame:
    picked = applications(spark, sf).select("app_id", "target", "n_lines", "cat_priority", "cat_segment")
    return to_json_records(picked, "app_id")


@query(
    "lookup_by_id_list",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey IN "
    "(SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20)",
)
def lookup_by_id_list(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders")
    ids = [r["o_orderkey"] for r in X.top_n(orders, "o_totalprice", 20, "o_orderkey").select("o_orderkey").collect()]
    return select_ids(orders, "o_orderkey", ids).select("o_orderkey", "o_custkey", "o_orderstatus")


_RATIO_COLS = ", ".join(f"{u(f'{a} / nullif({b}, 0)')} AS {out}" for out, (a, b) in RATIOS.items())


@query("ratio_features", f"{APPS_SQL} SELECT app_id, {_RATIO_COLS} FROM apps")
def ratio_features(spark: SparkSession, sf: str) -> DataFrame:
    out = X.add_ratios(applications(spark, sf), RATIOS)
    return with_micro(out.select("app_id", *RATIOS), *RATIOS)


@query("dropped_columns", f"{APPS_SQL} SELECT amt_credit, qty, n_lines, cat_status, cat_segment FROM apps")
def dropped_columns(spark: SparkSession, sf: str) -> DataFrame:
    names = ["app_id", "target", "not_there", "amt_income", "amt_goods", "disc", "cat_priority", "app_date"]
    return X.drop_existing(applications(spark, sf), names)


@query(
    "common_columns",
    "SELECT 'left' AS side, o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < date '1998-01-01' "
    "UNION ALL SELECT 'right', o_orderkey, o_orderstatus FROM orders WHERE o_orderdate >= date '1998-01-01'",
)
def common_columns(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders")
    limit = F.lit("1998-01-01").cast("date")
    left = orders.where(F.col("o_orderdate") < limit).select("o_orderkey", "o_totalprice", "o_orderstatus")
    right = orders.where(F.col("o_orderdate") >= limit).select("o_custkey", "o_orderstatus", "o_orderkey")
    a, b = X.align_common(left, right)
    return a.withColumn("side", F.lit("left")).unionByName(b.withColumn("side", F.lit("right")))


@query(
    "presence_flags",
    f"{APPS_SQL} SELECT app_id, " + ", ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END AS {c}_origin" for c in NUMERIC) + " FROM apps",
)
def presence_flags(spark: SparkSession, sf: str) -> DataFrame:
    flagged = presence_indicators(applications(spark, sf), NUMERIC)
    return flagged.select("app_id", *[f"{c}_origin" for c in NUMERIC])


@query("rows_with_value", f"{APPS_SQL} SELECT app_id, {u('amt_goods')} AS amt_goods FROM apps WHERE amt_goods IS NOT NULL")
def rows_with_value(spark: SparkSession, sf: str) -> DataFrame:
    return with_micro(X.drop_missing(applications(spark, sf), "amt_goods").select("app_id", "amt_goods"), "amt_goods")


_IQR = ",\n".join(
    f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo_{c}, "
    f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi_{c}"
    for c in NUMERIC
)
_MASKED = ", ".join(
    f"{u(f'CASE WHEN {c} < lo_{c} OR {c} > hi_{c} THEN NULL ELSE {c} END')} AS {c}" for c in NUMERIC
)


@query(
    "masked_outliers",
    f"{SPLIT}, b AS (SELECT {_IQR} FROM sp WHERE split = 'train') SELECT app_id, split, {_MASKED} FROM sp CROSS JOIN b",
)
def masked_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds from the train rows, applied to every split."""
    apps = _apps(spark, sf)
    split = sampling.split_rows(apps, "app_id", "target")
    bounds = outliers.fit_bounds(split.where("split = 'train'"), NUMERIC, ["IQR 1.5"])
    masked = outliers.mask_outliers(split, "IQR 1.5", NUMERIC, bounds)
    return with_micro(masked.select("app_id", "split", *NUMERIC), *NUMERIC)


@query(
    "decisions",
    f"""{SCORES} SELECT app_id, CASE WHEN p_goods >= 0.45 THEN 1 ELSE 0 END AS y_hat,
    CASE WHEN p_goods >= 0.45 THEN 'REJECTED' ELSE 'ACCEPTED' END AS decision FROM scored""",
)
def decisions(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("p_goods")
    return scored(applications(spark, sf)).select(
        "app_id", X.decide(p, 0.45).alias("y_hat"), X.decision_label(p, 0.45).alias("decision")
    )


@query(
    "what_if_scenarios",
    f"""{APPS_SQL}, s AS (SELECT app_id AS scenario_id, amt_credit * 2 AS amt_credit, amt_income, amt_goods, qty, disc,
      n_lines, cat_priority, 'BUILDING' AS cat_segment FROM apps)
    SELECT scenario_id, {u('amt_credit')} AS amt_credit, {u('amt_income')} AS amt_income, n_lines, cat_priority, cat_segment,
      {u('amt_credit / nullif(amt_income, 0)')} AS credit_income, {u('amt_goods / nullif(amt_credit, 0)')} AS goods_credit
    FROM s""",
)
def what_if_scenarios(spark: SparkSession, sf: str) -> DataFrame:
    """Every application with its credit doubled and another segment; unknown keys are ignored."""
    apps = _apps(spark, sf)
    changes = F.array(
        F.struct(F.lit("amt_credit").alias("feature"), (F.col("amt_credit") * 2).cast("string").alias("value")),
        F.struct(F.lit("cat_segment").alias("feature"), F.lit("BUILDING").alias("value")),
        F.struct(F.lit("no_such_field").alias("feature"), F.lit("1").alias("value")),
    )
    overrides = apps.select(F.col("app_id").alias("scenario_id"), F.inline(changes))
    template = apps.select(*NUMERIC, "cat_priority", "cat_segment")
    out = build_scenarios(overrides, template, apps, "app_id", ratios=RATIOS)
    out = out.select("scenario_id", "amt_credit", "amt_income", "n_lines", "cat_priority", "cat_segment", "credit_income", "goods_credit")
    return with_micro(out, "amt_credit", "amt_income", "credit_income", "goods_credit")


@query(
    "form_scenarios",
    f"""SELECT c_custkey AS scenario_id, {u('-abs((20 + c_nationkey) * 365.25)')} AS days_birth,
    cast(0 AS bigint) AS cnt_children, 'Cash loans' AS contract, {u('c_acctbal')} AS amt_income FROM customer""",
)
def form_scenarios(spark: SparkSession, sf: str) -> DataFrame:
    """The short form for every customer: years become negative days, constants are added."""
    customer = read(spark, sf, "customer")
    fields = F.array(
        F.struct(F.lit("AGE_YEARS").alias("feature"), (F.col("c_nationkey") + 20).cast("string").alias("value")),
        F.struct(F.lit("AMT_INCOME_TOTAL").alias("feature"), F.col("c_acctbal").cast("string").alias("value")),
        F.struct(F.lit("CNT_CHILDREN").alias("feature"), F.lit("3").alias("value")),
    )
    forms = customer.select(F.col("c_custkey").alias("scenario_id"), F.inline(fields))
    template = spark.createDataFrame(
        [], "DAYS_BIRTH double, CNT_CHILDREN long, NAME_CONTRACT_TYPE string, AMT_INCOME_TOTAL double"
    )
    out = build_scenarios(form_overrides(forms), template, with_ratios=False)
    return out.select(
        "scenario_id",
        micro("DAYS_BIRTH").alias("days_birth"),
        F.col("CNT_CHILDREN").alias("cnt_children"),
        F.col("NAME_CONTRACT_TYPE").alias("contract"),
        micro("AMT_INCOME_TOTAL").alias("amt_income"),
    )


@query(
    "simple_sample",
    f"{APPS_SQL} SELECT app_id, target FROM apps ORDER BY md5(cast(app_id AS varchar) || '|42') LIMIT 1000",
)
def simple_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_rows(_apps(spark, sf).select("app_id", "target"), "app_id", 1000)


@query(
    "stratified_sample",
    f"""{APPS_SQL}, k AS (SELECT app_id, cat_segment, md5(cast(app_id AS varchar) || '|42') AS key,
      count(*) OVER (PARTITION BY cat_segment) AS n, count(*) OVER () AS t FROM apps),
    q AS (SELECT *, row_number() OVER (PARTITION BY cat_segment ORDER BY key) AS r FROM k),
    f AS (SELECT *, r <= 1000 * n // t AS picked FROM q),
    g AS (SELECT *, row_number() OVER (PARTITION BY picked ORDER BY key) AS rest,
      sum(CASE WHEN picked THEN 1 ELSE 0 END) OVER () AS taken FROM f)
    SELECT app_id, cat_segment FROM g WHERE picked OR rest <= 1000 - taken""",
)
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    apps = _apps(spark, sf).select("app_id", "cat_segment")
    return sampling.stratified_sample(apps, "app_id", "cat_segment", 1000)


@query(
    "noise_capped_sample",
    f"""{APPS_SQL}, l AS (SELECT app_id, cast(coalesce(n_lines, 0) AS int) - 1 AS label FROM apps),
    k AS (SELECT app_id, label, md5(cast(app_id AS varchar) || '|42') AS key,
      row_number() OVER (PARTITION BY label ORDER BY md5(cast(app_id AS varchar) || '|42')) AS r FROM l),
    c AS (SELECT count(DISTINCT label) AS labels FROM l),
    f AS (SELECT *, r <= CASE WHEN label = -1 THEN 200 ELSE cast(floor(800.0 / (labels - 1)) AS bigint) END AS picked FROM k, c),
    g AS (SELECT *, row_number() OVER (PARTITION BY picked ORDER BY key) AS rest,
      sum(CASE WHEN picked THEN 1 ELSE 0 END) OVER () AS taken FROM f)
    SELECT app_id, label FROM g WHERE picked OR rest <= 1000 - taken""",
)
def noise_capped_sample(spark: SparkSession, sf: str) -> DataFrame:
    apps = _apps(spark, sf)
    labelled = apps.select("app_id", (F.coalesce(F.col("n_lines"), F.lit(0)).cast("int") - 1).alias("label"))
    return sampling.noise_capped_sample(labelled, "app_id", "label", 1000)


@query("train_val_test_split", f"{SPLIT} SELECT app_id, target, split FROM sp")
def train_val_test_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.split_rows(_apps(spark, sf).select("app_id", "target"), "app_id", "target")


@query(
    "split_summary",
    f"""{SPLIT}, c AS (SELECT split, count(*) AS n FROM sp GROUP BY 1)
    SELECT split, n, {u("100.0 * n / CASE WHEN split = 'test_final' THEN (SELECT sum(n) FROM c) "
    "ELSE (SELECT sum(n) FROM c WHERE split <> 'test_final') END")} AS pct FROM c""",
)
def split_summary(spark: SparkSession, sf: str) -> DataFrame:
    split = sampling.split_rows(_apps(spark, sf).select("app_id", "target"), "app_id", "target")
    return with_micro(sampling.split_summary(split), "pct")


@query(
    "split_overlap",
    f"{SPLIT} SELECT app_id, min(split) AS first_split, max(split) AS last_split FROM sp GROUP BY 1 HAVING count(DISTINCT split) > 1",
)
def split_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Must be empty."""
    split = sampling.split_rows(_apps(spark, sf).select("app_id", "target"), "app_id", "target")
    return sampling.split_overlap(split, "app_id")


@query(
    "stratified_folds",
    f"""{APPS_SQL}, k AS (SELECT app_id, target, count(*) OVER (PARTITION BY target) AS n,
      row_number() OVER (PARTITION BY target ORDER BY md5(cast(app_id AS varchar) || '|42')) AS r FROM apps)
    SELECT app_id, target, CASE WHEN r <= n // 3 + CASE WHEN n % 3 > 0 THEN 1 ELSE 0 END THEN 0
      WHEN r <= 2 * (n // 3) + least(n % 3, 2) THEN 1 ELSE 2 END AS fold FROM k""",
)
def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_folds(_apps(spark, sf).select("app_id", "target"), "app_id", "target", 3)


@query(
    "drift_sample",
    f"""{APPS_SQL}, r AS (SELECT app_id, app_date < date '1998-01-01' AS is_ref,
      row_number() OVER (PARTITION BY app_date < date '1998-01-01' ORDER BY md5(cast(app_id AS varchar) || '|42')) AS r FROM apps)
    SELECT app_id, is_ref FROM r WHERE r <= 1000""",
)
def drift_sample(spark: SparkSession, sf: str) -> DataFrame:
    """1000 rows of each period, the size the drift report reads."""
    ref, cur = reference_current(_apps(spark, sf))
    a = sampling.sample_rows(ref.select("app_id"), "app_id", 1000).withColumn("is_ref", F.lit(True))
    b = sampling.sample_rows(cur.select("app_id"), "app_id", 1000).withColumn("is_ref", F.lit(False))
    return a.unionByName(b)


_LABEL_SQL = """SELECT app_id, CASE WHEN cat_segment = 'BUILDING' THEN 'YES | segment: BUILDING' ELSE 'NO | segment_BUILDING' END AS cat_label,
 CASE WHEN qty IS NULL THEN 'MISSING | qty' ELSE 'PRESENT | qty' END AS ind_label,
 printf('%.2f', cast(n_lines AS double)) || ' | n_lines' AS num_label FROM apps"""


@query("feature_labels", f"{APPS_SQL} {_LABEL_SQL}")
def feature_labels(spark: SparkSession, sf: str) -> DataFrame:
    apps = applications(spark, sf)
    return apps.select(
        "app_id",
        X.feature_label(F.lit("cat__segment_BUILDING"), (F.col("cat_segment") == "BUILDING").cast("double")).alias("cat_label"),
        X.feature_label(F.lit("ind__qty_origin"), F.col("qty").isNotNull().cast("double")).alias("ind_label"),
        F.when(F.col("n_lines").isNotNull(), X.feature_label(F.lit("num__n_lines"), F.col("n_lines").cast("double"))).alias("num_label"),
    )


_MANY = SPLIT[SPLIT.index("cls AS") :].replace("apps", "many")
_CUSTOMERS = "many AS (SELECT o_orderkey AS app_id, o_custkey AS target FROM orders)"


def _orders_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(F.col("o_orderkey").alias("app_id"), F.col("o_custkey").alias("target"))


@query("split_many_classes", f"WITH {_CUSTOMERS}, {_MANY} SELECT app_id, target, split FROM sp")
def split_many_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Orders split within each customer, with quotas kept as a table."""
    return sampling.split_rows(_orders_by_customer(spark, sf), "app_id", "target", held=1000)


@query(
    "folds_many_classes",
    f"""WITH {_CUSTOMERS}, k AS (SELECT *, count(*) OVER (PARTITION BY target) AS n,
      row_number() OVER (PARTITION BY target ORDER BY md5(cast(app_id AS varchar) || '|42')) AS r FROM many)
    SELECT app_id, target, CASE WHEN r <= n // 3 + least(n % 3, 1) THEN 0
      WHEN r <= 2 * (n // 3) + least(n % 3, 2) THEN 1 ELSE 2 END AS fold FROM k""",
)
def folds_many_classes(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_folds(_orders_by_customer(spark, sf), "app_id", "target", 3, held=1000)
