"""Ranges of ids, cut at values that occur, for work that depends on the order of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cuts travel as literals of the plan, so their number is bounded.
MAX_RANGES = 1 << 16


def range_cuts(df: DataFrame, key: str, ranges: int) -> list:
    """Ascending values of ``key``, the last its maximum, that cut ``df`` into about ``ranges`` parts.

    Empty if ``df`` has no value of ``key``.
    """
    ranges = max(1, min(MAX_RANGES, ranges))
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    found = df.agg(F.percentile_approx(key, shares, 10 * ranges).alias("cuts"), F.max(key).alias("top")).first()
    if found["top"] is None:
        return []
    cuts = sorted({*(found["cuts"] if ranges > 1 else []), found["top"]})
    # The cuts come by way of doubles, so a large number may be rounded to one that does not occur:
    # the greatest value of each range stands for it.
    own = df.where(F.col(key).isNotNull()).groupBy(range_of(F.col(key), cuts).alias("_r")).agg(F.max(key).alias("cut"))
    return sorted(r["cut"] for r in own.collect())


def range_of(key: Column, cuts: list) -> Column:
    """How many cuts lie below ``key`` (a null key: 0), in two steps of about the root of their number."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    tops = F.array(*[F.lit(b[-1]) for b in blocks])
    block = F.size(F.filter(tops, lambda c: c < key))
    inside = F.get(F.array(*[F.array(*map(F.lit, b)) for b in blocks]), block)
    within = F.size(F.filter(F.coalesce(inside, F.array(F.lit(cuts[-1]))), lambda c: c < key))
    return F.coalesce(block * step + within, F.lit(0))
