"""The application table built from the star-schema tables: one row per order.

A line aggregate and a customer row are joined to each order. The line aggregate is combined
before its shuffle and the result is already partitioned by the order key the join needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.session import spread

NUMERIC = ["amt_credit", "amt_income", "amt_goods", "qty", "disc", "n_lines"]
CATEGORICAL = ["cat_priority", "cat_segment", "cat_status"]
RATIOS = {
    "credit_income": ("amt_credit", "amt_income"),
    "goods_credit": ("amt_goods", "amt_credit"),
    "goods_line": ("amt_goods", "n_lines"),
    "disc_line": ("disc", "n_lines"),
}
DRIFT_DATE = "1998-01-01"

# The same table as SQL text, for checks in another engine.
APPS_SQL = """WITH li AS (
  SELECT l_orderkey, count(*) AS n_lines,
         cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) AS amt_goods,
         cast(sum(cast(l_quantity AS decimal(18,2))) AS double) AS qty,
         cast(sum(cast(l_discount AS decimal(18,2))) AS double) AS disc,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_ret
  FROM lineitem GROUP BY l_orderkey),
apps AS (
  SELECT o_orderkey AS app_id,
         CASE WHEN coalesce(n_ret,0)*10 >= n_lines*6 THEN 1 ELSE 0 END AS target,
         o_totalprice AS amt_credit, c_acctbal AS amt_income,
         amt_goods, qty, disc, cast(n_lines AS bigint) AS n_lines,
         o_orderpriority AS cat_priority, c_mktsegment AS cat_segment, o_orderstatus AS cat_status,
         o_orderdate AS app_date
  FROM orders LEFT JOIN li ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey)"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    def money(c: str, out: str):
        return F.sum(F.col(c).cast("decimal(18,2)")).cast("double").alias(out)

    lineitem = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_quantity", "l_discount", "l_returnflag"
    )
    lines = (
        spread(lineitem, "l_orderkey")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            money("l_extendedprice", "amt_goods"),
            money("l_quantity", "qty"),
            money("l_discount", "disc"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_ret"),
        )
    )
    orders = spread(read(spark, sf_dir, "orders"), "o_orderkey")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(
        customer, F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    returned = F.coalesce(F.col("n_ret"), F.lit(0)) * 10 >= F.col("n_lines") * 6
    return joined.select(
        F.col("o_orderkey").alias("app_id"),
        F.when(returned, 1).otherwise(0).alias("target"),
        F.col("o_totalprice").alias("amt_credit"),
        F.col("c_acctbal").alias("amt_income"),
        "amt_goods",
        "qty",
        "disc",
        "n_lines",
        F.col("o_orderpriority").alias("cat_priority"),
        F.col("c_mktsegment").alias("cat_segment"),
        F.col("o_orderstatus").alias("cat_status"),
        F.col("o_orderdate").alias("app_date"),
    )


def reference_current(apps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two periods of the table, for drift."""
    limit = F.lit(DRIFT_DATE).cast("date")
    return apps.where(F.col("app_date") < limit), apps.where(F.col("app_date") >= limit)


def scored(apps: DataFrame) -> DataFrame:
    """``(app_id, y, p_goods, p_qty)``: two fixed score formulas in place of fitted models."""
    return apps.select(
        "app_id",
        F.col("target").alias("y"),
        F.least(F.lit(1.0), F.coalesce(F.col("amt_goods"), F.lit(0.0)) / 400000.0).alias("p_goods"),
        F.least(F.lit(1.0), F.coalesce(F.col("qty"), F.lit(0.0)) / 250.0).alias("p_qty"),
    )


SCORED_SQL = """scored AS (
  SELECT app_id, target AS y,
         least(1.0::double, coalesce(amt_goods, 0.0::double) / 400000.0::double) AS p_goods,
         least(1.0::double, coalesce(qty, 0.0::double) / 250.0::double) AS p_qty
  FROM apps)"""


def long_predictions(scores: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(keep..., model, y, p)``, one row per model and application."""
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"p_{m}").alias("p")) for m in ("goods", "qty")])
    return scores.select(*keep, "y", F.inline(pairs))


PREDICTIONS_SQL = """preds AS (
  SELECT app_id, 'goods' AS model, y, p_goods AS p FROM scored
  UNION ALL SELECT app_id, 'qty' AS model, y, p_qty AS p FROM scored)"""
