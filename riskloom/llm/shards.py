"""Sharding by a lookup table that shards fill in turns.

Every shard has its own order of preference over the slots of a table of prime size: start and step
come from two hashes of its name, so the order is a permutation. The shards take turns, each claiming
its most preferred free slot, until the table is full. Shares differ by one slot at most, and when a
shard comes or goes few slots change owner beyond those it gains or loses. A key is placed by looking
up the slot of its hash in the broadcast table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A prime; at least a hundred times the number of shards keeps shares and changes even.
TABLE_SIZE = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _preference(name: str, size: int) -> tuple[int, int]:
    """Start and step of a shard's permutation of the slots."""
    digest = hashlib.md5(name.encode()).digest()
    start = int.from_bytes(digest[:8], "big") % size
    return start, int.from_bytes(digest[8:], "big") % (size - 1) + 1 if size > 1 else 0


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE, weights: Sequence[int] | None = None) -> np.ndarray:
    """The number of the owning shard for every slot.

    ``weights`` (whole numbers, 1 if not given) are turns per round. The order in which shards are
    named decides whose turn comes first, nothing else.
    """
    if not _is_prime(size):
        raise ValueError(f"{size} is not a prime")
    if not 0 < len(shards) <= size or len(set(shards)) != len(shards):
        raise ValueError("shards have to be distinct, and not more than there are slots")
    weights = list(weights or [1] * len(shards))
    if len(weights) != len(shards) or min(weights) < 0 or not any(weights):
        raise ValueError("a weight for every shard, none below zero, one above")
    table = np.full(size, -1, np.int32)
    prefer = [_preference(s, size) for s in shards]
    following = [0] * len(shards)
    free = size
    while free:
        for i, turns in enumerate(weights):
            start, step = prefer[i]
            for _ in range(turns):
                if not free:
                    break
                while table[(start + following[i] * step) % size] >= 0:
                    following[i] += 1
                table[(start + following[i] * step) % size] = i
                following[i] += 1
                free -= 1
    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key: the first 60 bits of its MD5 as text, modulo the table's size; null: 0."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    digits = F.substring(F.md5(text.cast("binary")), 1, 15)
    slot = F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(size))
    return F.when(key.isNull(), 0).otherwise(slot).cast("int")


def assign_shards(
    df: DataFrame, key: str, shards: Sequence[str], size: int = TABLE_SIZE, weights: Sequence[int] | None = None
) -> DataFrame:
    """Adds ``slot`` and ``shard``; columns of ``df`` with these names are replaced.

    Equal keys have the same shard, a null key that of slot 0. Nothing is shuffled: the table, of
    ``size`` rows, is broadcast.
    """
    spark = df.sparkSession
    names = [c for c in df.columns if c not in ("slot", "shard")]
    placed = df.select(*[df[c] for c in names], slot_of(df[key], size).alias("slot"))
    table = _lookup(spark, fill_table(shards, size, weights), shards)
    return placed.join(F.broadcast(table), "slot").select(*names, "slot", "shard")


def _lookup(spark: SparkSession, table: np.ndarray, shards: Sequence[str]) -> DataFrame:
    import pyarrow as pa

    owners = pa.array([shards[i] for i in table], pa.string())
    return spark.createDataFrame(pa.table({"slot": pa.array(np.arange(len(table), dtype=np.int32)), "shard": owners}))


def write_shards(df: DataFrame, path: str, key: str, shards: Sequence[str], files_per_shard: int = 1, **table) -> None:
    """Write ``df`` as Parquet, one folder per shard.

    A shard's rows are dealt by their key over ``files_per_shard`` tasks, so that no task holds a
    whole shard of a large table.
    """
    placed = assign_shards(df, key, shards, **table)
    part = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("file")), F.lit(files_per_shard))
    spread = placed.repartition(len(shards) * files_per_shard, F.col("shard"), part)
    spread.write.partitionBy("shard").mode("error").parquet(path)
