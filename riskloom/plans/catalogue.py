"""Named queries over the given tables, each with its SQL counterpart where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.plans.apps import APPS_SQL, PREDICTIONS_SQL, SCORED_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SCORES = f"{APPS_SQL},\n{SCORED_SQL}"
PREDS = f"{SCORES},\n{PREDICTIONS_SQL}"

# The stratified split as SQL: class quotas by largest remainder, then ranks by hash.
SPLIT = f"""{APPS_SQL},
cls AS (SELECT target, count(*) AS n FROM apps GROUP BY 1),
t1 AS (SELECT target, n, cast(ceil(0.2 * sum(n) OVER ()) AS bigint) AS draws, cast(sum(n) OVER () AS bigint) AS t FROM cls),
t2 AS (SELECT *, draws * n // t AS base, draws * n % t AS rem FROM t1),
t3 AS (SELECT target, n, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, target) <= draws - sum(base) OVER ()
       THEN 1 ELSE 0 END AS n_test FROM t2),
v1 AS (SELECT target, n_test, n - n_test AS n, cast(ceil(0.2 * sum(n - n_test) OVER ()) AS bigint) AS draws,
       cast(sum(n - n_test) OVER () AS bigint) AS t FROM t3),
v2 AS (SELECT *, draws * n // t AS base, draws * n % t AS rem FROM v1),
v3 AS (SELECT target, n_test, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, target) <= draws - sum(base) OVER ()
       THEN 1 ELSE 0 END AS n_val FROM v2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(cast(app_id AS varchar) || '|42')) AS r FROM apps),
sp AS (SELECT ranked.*, CASE WHEN r <= n_test THEN 'test_final' WHEN r <= n_test + n_val THEN 'val' ELSE 'train' END AS split
       FROM ranked JOIN v3 USING (target))"""


def micro(c: Column | str) -> Column:
    """Millionths as a whole number, so that two engines compare exactly."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 1000000 + 0.5).cast("long")


def u(expr: str) -> str:
    """``micro`` as SQL."""
    return f"cast(floor(({expr}) * 1000000 + 0.5) AS bigint)"


def with_micro(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: micro(n) for n in names})


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` only its rows can be checked."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
