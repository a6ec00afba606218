"""Rows on their way through an Arrow function: the caller's columns travel as one struct."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from riskloom.functions.expr import col
from riskloom.functions.session import ship

# Bytes of text that are worked on at a time: words as Python objects take about ten times as much.
PART_BYTES = 1 << 20


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def distinct_draws(df: DataFrame, draw: Column, limit: int, by: str | None = None) -> DataFrame:
    """At most ``limit`` rows of ``df`` (for each value of ``by``), those of smallest ``draw``; equal draws are one row.

    Copies of a row go before anything is shuffled, so no group of them can fill the sample.
    """
    keys = ["draw_", *([by] if by else [])]
    row = F.min(F.struct(*[col(c) for c in df.columns if c != by])).alias("row_")
    single = df.withColumn("draw_", draw).groupBy(*keys).agg(row)
    if by:
        place = F.row_number().over(Window.partitionBy(by).orderBy("draw_"))
        single = single.withColumn("place_", place).where(F.col("place_") <= limit).drop("place_")
    else:
        single = single.orderBy("draw_").limit(limit)
    return single.select(*[F.col(by) if c == by else F.col("row_").getField(c).alias(c) for c in df.columns], "draw_")


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``PART_BYTES`` of text; a longer text is a slice of its own."""
    if not batch.num_rows:
        yield batch
        return
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + PART_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def map_texts(df: DataFrame, text: str, added: T.StructType, make: Callable[[], Callable[[pa.Array], list[pa.Array]]]) -> DataFrame:
    """Add the columns ``added`` to every row of ``df``, computed from its column ``text``.

    ``make`` is called once per task and returns a function from a batch's texts (strings, nulls
    kept) to one array per added column. Columns of ``df`` with an added name are replaced; all others,
    whatever their names, come back as they were. Nothing is shuffled.
    """
    ship(df.sparkSession)
    keep = df.drop(*added.names).columns
    row = F.struct(*[col(c) for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    given = df.select(row.alias("row"), col(text).cast("string").alias("text"))
    out = T.StructType([given.schema["row"], *added.fields])
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in _parts(batch):
                columns = [part.column(0), *fn(part.column(1))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    mapped = given.mapInArrow(run, out)
    return mapped.select(*[F.col("row").getField(c).alias(c) for c in keep], *[col(c) for c in added.names])
