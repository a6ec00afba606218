"""Session helpers: shared work folder, materialised tables, size-checked small tables."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Largest parameter table that is pulled to the driver and broadcast.
SMALL_TABLE_ROWS = 20_000

# Bytes of an Arrow batch on its way to a Python worker: Spark's default and what replaces it.
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_DEFAULT, _BATCH_BYTES = "67108864b", "8m"

_local_dir: str | None = None
_scratch: list[list[str]] = []


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    ``spark.checkpoint.dir`` of the session wins. Only a local master may fall back to a
    temporary folder: on a cluster a machine-local path would be lost with its machine.
    """
    global _local_dir
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="riskloom-", dir="/tmp")
    sc.setCheckpointDir(_local_dir)
    return _local_dir


def ship(spark: SparkSession) -> None:
    """Give every Python worker this package, once per Spark application.

    Functions that run inside tasks are pickled by reference, so workers have to be able to import
    the package wherever the driver was started. The sources are zipped and handed to Spark's own
    file distribution; an executor that joins later fetches the same file. Where the session has the
    default size of Arrow batches, it is lowered, so that long texts do not fill the workers.
    """
    sc = spark.sparkContext
    # Without a default of the caller's, an unset size would come back as None.
    if spark.conf.get(_BATCH_CONF, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_CONF, _BATCH_BYTES)
    if getattr(sc, "_riskloom_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    files = sorted(os.path.join(d, n) for d, _, names in os.walk(root) for n in names if n.endswith(".py"))
    digest = hashlib.sha256()
    for f in files:
        with open(f, "rb") as source:
            digest.update(f.encode() + source.read())
    path = os.path.join(tempfile.mkdtemp(prefix="riskloom-src-"), f"riskloom-{digest.hexdigest()[:12]}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for f in files:
            archive.write(f, os.path.join(os.path.basename(root), os.path.relpath(f, root)))
    sc.addPyFile(path)
    sc._riskloom_shipped = True


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash ``df`` over the cores when its files give fewer splits than there are cores.

    A table of many files is returned as it is, so nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``materialise`` writes inside the block when it ends.

    Results that read them have to be collected or written before.
    """
    _scratch.append([])
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _scratch.pop():
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage like ``checkpoint()`` but stays columnar, so later passes still prune columns
    and push filters. Used where an operator reads a derived input more than once.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for made in _scratch[-1:]:
        made.append(path)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """A few driver-side rows as a broadcast local relation (no job, no Python worker)."""
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    columns = [pa.array([r[i] for r in rows], to_arrow_type(f.dataType)) for i, f in enumerate(struct.fields)]
    table = pa.Table.from_arrays(columns, names=struct.names)
    return F.broadcast(spark.createDataFrame(table, struct))


def small_table(df: DataFrame, limit: int = SMALL_TABLE_ROWS) -> DataFrame:
    """Evaluate ``df`` once; up to ``limit`` rows come back as a broadcast local table.

    A larger result is written to the shared folder instead, without any broadcast hint, so the
    join strategy is left to the optimiser.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return materialise(df, "parameters")
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return local_table(df.sparkSession, rows, nullable)
