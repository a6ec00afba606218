"""Run named queries next to their SQL in DuckDB: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession


def make_spark(cpus: str = "8", name: str = "riskloom-check") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "localhost")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def norm(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


def check(spark, con, fn, sql, sf_dir) -> str:
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return f"rows-only {len(rows)}"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    expect = rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS spark={sorted(df.columns)} sql={sorted(names)}"
    a, b = norm(rows, df.columns), norm(expect, names)
    if a == b:
        return f"ok {len(a)}"
    sa, sb = set(a), set(b)
    only_a, only_b = [x for x in a if x not in sb][:3], [x for x in b if x not in sa][:3]
    return f"MISMATCH spark={len(a)} sql={len(b)} cols={sorted(names)}\n   spark: {only_a}\n   sql:   {only_b}"


def main() -> None:
    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = args[1:]
    qs, sqls = entry.queries(), entry.oracle_sql()
    spark, con = make_spark(), connect(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            result = check(spark, con, fn, sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            result = f"ERROR {type(e).__name__}: {str(e)[:700]}"
            if names:
                traceback.print_exc()
        if not result.startswith(("ok", "rows-only")):
            bad += 1
        print(f"{time.time() - start:6.1f}s {name}: {result}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
