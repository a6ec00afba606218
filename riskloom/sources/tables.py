"""Tables: CSV loading, Parquet catalogue, SQL access and materialised results."""

from __future__ import annotations

import hashlib
import logging
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskloom.functions.expr import normalise_missing
from riskloom.functions.session import work_dir

log = logging.getLogger(__name__)

# The eight source tables, each one CSV file of the same name.
TABLE_NAMES = (
    "application_train",
    "application_test",
    "bureau",
    "bureau_balance",
    "credit_card_balance",
    "installments_payments",
    "POS_CASH_balance",
    "previous_application",
)


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


class TableLoader:
    """Reads the source tables under one base folder."""

    def __init__(self, spark: SparkSession, base: str, schemas: Mapping[str, T.StructType] | None = None):
        self.spark = spark
        self.base = base.rstrip("/")
        self.schemas = dict(schemas or {})

    def load(self, file_name: str) -> DataFrame:
        """One CSV with header. Raises ``FileNotFoundError`` at once when the file is missing.

        A schema given for the table is used as is; types are inferred only without one.
        """
        path = f"{self.base}/{file_name}"
        if not _path_exists(self.spark, path):
            raise FileNotFoundError(path)
        reader = self.spark.read.option("header", True)
        schema = self.schemas.get(re.sub(r"\.csv$", "", file_name))
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        return normalise_missing(reader.csv(path))

    def load_train(self) -> DataFrame:
        return self.load("application_train.csv")

    def load_test(self) -> DataFrame:
        return self.load("application_test.csv")

    def load_all(self, register: bool = True) -> dict[str, DataFrame]:
        """The tables that exist; a missing one is warned about and skipped."""
        out = {}
        for name in TABLE_NAMES:
            try:
                out[name] = self.load(f"{name}.csv")
            except FileNotFoundError:
                log.warning("table %s not found under %s", name, self.base)
                continue
            if register:
                out[name].createOrReplaceTempView(name)
        return out


def create_database(tables: Mapping[str, DataFrame], path: str) -> list[str]:
    """Write every table as Parquet under ``path``, replacing what is there."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
    return sorted(tables)


class Database:
    """Parquet tables under one folder, queried with SQL, with optional materialised results.

    A materialised result is stored under a digest of the source folder and its files, the caller's
    key and the SQL text: two sources or two queries never share a file, and a table that was
    written anew is queried anew.
    """

    def __init__(self, spark: SparkSession, path: str, suffix: str = ""):
        self.spark = spark
        self.path = path.rstrip("/")
        self.suffix = suffix
        self._cached: dict[str, DataFrame] = {}
        self._views = self._register()

    def _register(self) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = []
        for status in fs.listStatus(root):
            file_name = status.getPath().getName()
            if file_name.startswith((".", "_")) or not file_name.endswith(self.suffix):
                continue
            name = file_name[: len(file_name) - len(self.suffix)] if self.suffix else file_name
            self._frame(file_name).createOrReplaceTempView(name)
            names.append(name)
        return sorted(names)

    def _frame(self, file_name: str) -> DataFrame:
        return normalise_missing(self.spark.read.parquet(f"{self.path}/{file_name}"))

    def table_names(self) -> list[str]:
        """The registered tables whose view still exists."""
        listed = {r["viewName"].lower() for r in self.spark.sql("SHOW VIEWS").collect()}
        return [v for v in self._views if v.lower() in listed]

    def _state(self) -> str:
        """Names, sizes and times of the source's files: another state, another result."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True)
        seen = []
        while files.hasNext():
            f = files.next()
            seen.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return repr(sorted(seen))

    def _results(self) -> str:
        """Folder of this source's materialised results, whichever instance wrote them."""
        return f"{work_dir(self.spark)}/results/{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"

    def columns(self, name: str) -> list[str]:
        """Column template; read from the schema, no job."""
        return self._frame(name + self.suffix).columns

    def read_table(self, name: str, use_cache: bool = True) -> DataFrame:
        if name not in self._views:
            raise ValueError(f"unknown table {name!r}")
        # Parquet is already columnar, so a bare table is scanned in place rather than copied.
        return self._frame(name + self.suffix)

    def execute_query(self, sql: str, args: Mapping | None = None, cache_key: str | None = None) -> DataFrame:
        """Any SQL over the registered tables; ``cache_key`` materialises the result once."""
        df = self.spark.sql(sql, args=dict(args)) if args else self.spark.sql(sql)
        if cache_key is None:
            return df
        # The text as it is given: blanks inside a literal are part of the query.
        asked = repr((self._state(), cache_key, sql.strip(), sorted((args or {}).items())))
        digest = hashlib.sha256(asked.encode()).hexdigest()[:24]
        label = re.sub(r"[^0-9A-Za-z_-]", "", cache_key)[:40]
        path = f"{self._results()}/{label}-{digest}"
        if digest not in self._cached:
            for view in self._views:
                self._frame(view + self.suffix).createOrReplaceTempView(view)
            df = self.spark.sql(sql, args=dict(args)) if args else self.spark.sql(sql)
            if not _path_exists(self.spark, f"{path}/_SUCCESS"):
                df.write.mode("overwrite").parquet(path)
            self._cached[digest] = self.spark.read.schema(df.schema).parquet(path)
        return self._cached[digest]

    def clear_cache(self) -> int:
        """Delete the materialised results of this source, of all instances; returns how many there were."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self._results())
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        n = len(fs.listStatus(folder)) if fs.exists(folder) else 0
        fs.delete(folder, True)
        self._cached.clear()
        return n
