"""Runs, model versions and stages as append-only Parquet tables."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskloom.functions.session import local_table, materialise

# The parameter and tags that a registered run carries.
THRESHOLD_PARAM = "business_optimal_threshold"
READY_TAGS = {"model_status": "production_ready", "optimization_strategy": "cost_minimization"}
SERVING_THRESHOLD = 0.45
COMPARISON_THRESHOLD = 0.5

_RUNS = "run_id string, experiment string, run_name string, model_path string, logged_at long"
_VALUES = "run_id string, kind string, key string, value string, logged_at long"
_EVENTS = "name string, version int, run_id string, stage string, seq long"
_REGISTRATION = "name string, run_id string, logged_at long, promote boolean"


def current_stages(events: DataFrame) -> DataFrame:
    """``(name, version, run_id, stage)``: the latest event of each version."""
    return events.groupBy("name", "version").agg(
        F.max_by("run_id", "seq").alias("run_id"), F.max_by("stage", "seq").alias("stage")
    )


def production_versions(events: DataFrame) -> DataFrame:
    """The newest Production version per name."""
    live = current_stages(events).where(F.col("stage") == "Production")
    return live.groupBy("name").agg(F.max("version").alias("version"), F.max_by("run_id", "version").alias("run_id"))


class ModelRegistry:
    """One folder of run, value and event tables plus the saved models, for any number of writers.

    A version belongs to the writer that created its marker file; creating one that exists fails on the
    shared file system, and the writer goes on to the next number.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _append(self, table: str, rows: list[tuple], schema: str) -> None:
        self._publish(table, local_table(self.spark, rows, schema))

    def _publish(self, table: str, rows: DataFrame) -> None:
        """Add ``rows`` in a folder of their own, hidden until it is whole: writers do not meet, readers see all or nothing."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        part = uuid.uuid4().hex
        rows.coalesce(1).write.mode("error").parquet(f"{self.path}/{table}/_{part}")
        hidden, shown = (jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}/{p}") for p in (f"_{part}", part))
        if not hidden.getFileSystem(conf).rename(hidden, shown):
            raise OSError(f"could not publish {self.path}/{table}/{part}")

    def _read(self, table: str, schema: str) -> DataFrame:
        from riskloom.sources.tables import _path_exists

        struct = T.StructType.fromDDL(schema)
        if not _path_exists(self.spark, f"{self.path}/{table}"):
            return self.spark.createDataFrame([], struct)
        return self.spark.read.schema(struct).option("recursiveFileLookup", "true").parquet(f"{self.path}/{table}")

    def runs(self) -> DataFrame:
        return self._read("runs", _RUNS)

    def values(self) -> DataFrame:
        return self._read("run_values", _VALUES)

    def events(self) -> DataFrame:
        return self._read("events", _EVENTS)

    def log_run(
        self,
        experiment: str,
        run_name: str,
        params: Mapping | None = None,
        run_metrics: Mapping | None = None,
        tags: Mapping | None = None,
        model: PipelineModel | None = None,
    ) -> str:
        """Append a run with its parameters, metrics and tags; the model is saved beside it."""
        run_id, now = uuid.uuid4().hex, time.time_ns()
        model_path = None
        if model is not None:
            model_path = f"{self.path}/models/{run_id}"
            model.write().save(model_path)
        self._append("runs", [(run_id, experiment, run_name, model_path, now)], _RUNS)
        self.log_values(run_id, "param", params or {})
        self.log_values(run_id, "metric", run_metrics or {})
        self.log_values(run_id, "tag", tags or {})
        return run_id

    def log_values(self, run_id: str, kind: str, values: Mapping) -> None:
        rows = [(run_id, kind, k, v if isinstance(v, str) else json.dumps(v), time.time_ns()) for k, v in values.items()]
        if rows:
            self._append("run_values", rows, _VALUES)

    def find_run(self, experiment: str, run_name: str) -> str | None:
        """The newest run of that name, or None."""
        found = self.runs().where((F.col("experiment") == experiment) & (F.col("run_name") == run_name))
        row = found.orderBy(F.col("logged_at").desc()).first()
        return row["run_id"] if row else None

    def register_best(
        self,
        experiment: str,
        run_name: str,
        model_name: str,
        threshold: float | None = None,
        min_cost: float | None = None,
        promote: bool = False,
    ) -> int | None:
        """New version of ``model_name`` from a run; None when there is no such run.

        Promotion archives the versions in Production before.
        """
        run_id = self.find_run(experiment, run_name)
        if run_id is None:
            return None
        if threshold is not None or min_cost is not None:
            if threshold is not None:
                self.log_values(run_id, "param", {THRESHOLD_PARAM: threshold})
            if min_cost is not None:
                self.log_values(run_id, "metric", {"min_business_cost": min_cost})
            self.log_values(run_id, "tag", READY_TAGS)
        one = local_table(self.spark, [(model_name, run_id, time.time_ns(), promote)], _REGISTRATION)
        return self.register(one)[model_name][-1]

    def _claim(self, name: str, after: int, count: int) -> list[int]:
        """``count`` versions of ``name`` above ``after`` that no other writer has."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        folder = f"{self.path}/claims/{hashlib.sha256(name.encode()).hexdigest()[:32]}"
        found: list[int] = []
        version = after
        while len(found) < count:
            version += 1
            if self._create(jvm, conf, f"{folder}/{version}"):
                found.append(version)
        return found

    @staticmethod
    def _create(jvm, conf, name: str) -> bool:
        """Create a file that must not exist; False if it does. Atomic on shared file systems and on local disks."""
        path = jvm.org.apache.hadoop.fs.Path(name)
        fs = path.getFileSystem(conf)
        if fs.getScheme() == "file":
            # The local file system of Hadoop looks first and creates then; the JVM's own call does both at once.
            file = jvm.java.io.File(path.toUri().getPath())
            file.getParentFile().mkdirs()
            return file.createNewFile()
        try:
            fs.create(path, False).close()
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            return False
        return True

    def register(self, registrations: DataFrame) -> dict[str, list[int]]:
        """Append the events of ``(name, run_id, logged_at, promote)`` rows, in time order per name.

        Versions go on from those there are and are claimed before they are written; returned per name. A
        promoted version becomes Production and archives the ones in Production before it.
        """
        registrations = materialise(registrations, "registrations")
        known = materialise(self.events(), "events")
        asked = registrations.groupBy("name").agg(F.count("*").alias("n")).join(
            known.groupBy("name").agg(F.max("version").alias("base")), "name", "left"
        )
        claimed = {r["name"]: self._claim(r["name"], r["base"] or 0, r["n"]) for r in asked.collect()}  # one row a model
        places = [(name, i + 1, v) for name, versions in claimed.items() for i, v in enumerate(versions)]
        versions = local_table(self.spark, places, "name string, n int, version int")
        base = known.groupBy("name").agg(F.max("seq").alias("last"))
        live = current_stages(known).where(F.col("stage") == "Production").select("name", "version", "run_id")
        order = Window.partitionBy("name").orderBy("logged_at", "run_id")
        rows = registrations.join(base, "name", "left").withColumn("n", F.row_number().over(order))
        # Three places per registration: new, the archived ones, the promoted one.
        start = F.greatest(F.coalesce("last", F.lit(0)) + 1, F.col("logged_at")) + F.col("n") * 3
        rows = rows.withColumn("seq", start).join(versions, ["name", "n"]).select("name", "run_id", "promote", "version", "seq")
        rows = materialise(rows, "registrations")
        promoted = rows.where("promote")
        before = Window.partitionBy("name").orderBy("version")
        pairs = promoted.select(
            "name", "seq", F.lag("version").over(before).alias("version"), F.lag("run_id").over(before).alias("run_id")
        )
        first = pairs.where("version IS NULL").select("name", "seq").join(live, "name")
        archived = pairs.where("version IS NOT NULL").unionByName(first)
        events = (
            rows.select("name", "version", "run_id", F.lit("None").alias("stage"), "seq")
            .unionByName(archived.select("name", "version", "run_id", F.lit("Archived").alias("stage"), (F.col("seq") + 1).alias("seq")))
            .unionByName(promoted.select("name", "version", "run_id", F.lit("Production").alias("stage"), (F.col("seq") + 2).alias("seq")))
        )
        self._publish("events", events)
        return claimed

    def production(self, model_name: str, default_threshold: float = SERVING_THRESHOLD) -> tuple[int, str, float] | None:
        """``(version, model_path, threshold)`` of the Production version, or None."""
        live = production_versions(self.events().where(F.col("name") == model_name)).first()
        if live is None:
            return None
        run = self.runs().where(F.col("run_id") == live["run_id"]).first()
        stored = (
            self.values()
            .where((F.col("run_id") == live["run_id"]) & (F.col("kind") == "param") & (F.col("key") == THRESHOLD_PARAM))
            .orderBy(F.col("logged_at").desc())
            .first()
        )
        threshold = float(stored["value"]) if stored else default_threshold
        return live["version"], run["model_path"] if run else None, threshold

    def load_production(self, model_name: str, default_threshold: float = SERVING_THRESHOLD) -> tuple[PipelineModel, float]:
        found = self.production(model_name, default_threshold)
        if found is None or found[1] is None:
            raise LookupError(f"no production model {model_name!r}")
        return PipelineModel.load(found[1]), found[2]
