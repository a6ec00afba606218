"""Order statistics on columns too long for one sorted task.

A column is cut at approximate quantiles into 256 ranges per key. Range sums are tiny, so prefix
sums over them are cheap; exact work then happens only inside single ranges. The cuts are
approximate but the results are not: they only decide how evenly the rows are spread. A value
that fills many rows is a cut itself and gets a range of its own, so it never needs sorting.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskloom.functions.session import local_table, small_table

N_CUTS = 255
ROW_LIMIT = 2_000_000  # rows one task may sort

_FRACTIONS = [i / (N_CUTS + 1) for i in range(1, N_CUTS + 1)]
_STEPS = [1 << b for b in reversed(range(8))]


def cut_points(value: Column) -> Column:
    """Aggregate: 255 ascending approximate quantiles (mergeable sketch, no sort)."""
    return F.percentile_approx(value, _FRACTIONS, 10_000)


def range_index(value: Column, cuts: Column) -> Column:
    """Binary search: ``2i`` for the open range below cut ``i``, ``2i+1`` for a value equal to it."""
    below = F.aggregate(
        F.array(*map(F.lit, _STEPS)),
        F.lit(0),
        lambda acc, step: acc + F.when(F.element_at(cuts, acc + step) < value, step).otherwise(0),
    )
    hit = F.when(below < N_CUTS, (F.element_at(cuts, F.least(below + 1, F.lit(N_CUTS))) == value).cast("int")).otherwise(0)
    return below * 2 + hit


def running_totals(
    rows: DataFrame, keys: Sequence[str], order: str, measures: Sequence[str], row_limit: int = ROW_LIMIT
) -> DataFrame:
    """One row per ``(keys, order)`` with summed measures and inclusive ``cum_*`` prefix sums per key.

    A missing order value comes first, as a value of its own. Equal order values are merged before
    the shuffle. Keys with more rows than ``row_limit`` are
    summed in two levels: inside each range, plus the total of the ranges before it.
    """
    keys = list(keys)
    merged = rows.groupBy(*keys, order).agg(*[F.sum(m).alias(m) for m in measures])
    sketch = small_table(rows.groupBy(*keys).agg(F.count("*").alias("_n"), cut_points(F.col(order)).alias("_cuts")))
    largest = sketch.agg(F.max("_n").alias("n")).first()["n"] or 0
    if largest <= row_limit:
        upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return merged.select(*keys, order, *measures, *[F.sum(m).over(upto).alias(f"cum_{m}") for m in measures])
    place = F.coalesce(range_index(F.col(order), F.col("_cuts")), F.lit(-1))
    ranged = merged.join(sketch, keys).withColumn("_r", place).drop("_cuts", "_n")
    inner = Window.partitionBy(*keys, "_r").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.join(sketch, keys).withColumn("_r", place)
    totals = totals.groupBy(*keys, "_r").agg(*[F.sum(m).alias(m) for m in measures])
    offsets = small_table(
        totals.select(*keys, "_r", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_o_{m}") for m in measures])
    )
    local = ranged.select("*", *[F.sum(m).over(inner).alias(f"_c_{m}") for m in measures])
    return local.join(offsets, [*keys, "_r"]).select(
        *keys, order, *measures, *[(F.col(f"_c_{m}") + F.col(f"_o_{m}")).alias(f"cum_{m}") for m in measures]
    )


def _segment_table(spark, rows: list[tuple], extra: str = "") -> DataFrame:
    """``(feature, seg, lo, hi, ...)``: the rows of a feature with lo < value < hi."""
    return local_table(spark, rows, f"feature string, seg int, lo double, hi double{', ' + extra if extra else ''}")


def in_segment(value: Column) -> Column:
    """Strictly between the segment's bounds; a NULL bound is open."""
    return (F.col("lo").isNull() | (value > F.col("lo"))) & (F.col("hi").isNull() | (value < F.col("hi")))


def exact_quantiles(
    long_df: DataFrame, probs: Sequence[float], row_limit: int = ROW_LIMIT, counts: dict[str, int] | None = None
) -> DataFrame:
    """``(feature, n, q array<double>)``: exact linearly interpolated quantiles of ``(feature, value)`` rows.

    ``counts`` are the non-null values per feature where the caller already knows them.

    Up to ``row_limit`` values per feature the built-in exact ``percentile`` is used. Beyond it
    the wanted ranks are located by range counts, and only the ranges that hold a wanted rank are
    read again and cut further.
    """
    spark = long_df.sparkSession
    rows = long_df.where(F.col("value").isNotNull())
    if counts is None:
        counts = {r["feature"]: r["n"] for r in rows.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    counts = {f: n for f, n in counts.items() if n}
    fractions = F.array(*[F.lit(float(p)) for p in probs])
    if max(counts.values(), default=0) <= row_limit:
        return rows.groupBy("feature").agg(
            F.count("*").alias("n"), F.percentile(F.col("value"), fractions).alias("q")
        )
    wanted: dict[str, set[int]] = {}
    for feature, n in counts.items():
        spots = [p * (n - 1) for p in probs]
        wanted[feature] = {int(math.floor(h)) + 1 for h in spots} | {int(math.ceil(h)) + 1 for h in spots}
    values = _values_at_ranks(rows, counts, wanted, row_limit)
    out = []
    for feature, n in counts.items():
        q = []
        for p in probs:
            h = p * (n - 1)
            lo, hi = values[feature, int(math.floor(h)) + 1], values[feature, int(math.ceil(h)) + 1]
            q.append(lo + (hi - lo) * (h - math.floor(h)))
        out.append((feature, n, q))
    return local_table(spark, out, "feature string, n long, q array<double>")


def _values_at_ranks(rows: DataFrame, counts: dict, wanted: dict, row_limit: int) -> dict:
    """Value at each wanted 1-based rank. The driver only sees range counts and the answers."""
    spark = rows.sparkSession
    found: dict[tuple[str, int], float] = {}
    # (feature, lo, hi, rows before the segment, rows inside)
    pending = [(f, None, None, 0, n) for f, n in counts.items()]
    while pending:
        ready = [s for s in pending if s[4] <= row_limit]
        wide = [s for s in pending if s[4] > row_limit]
        pending = []
        if ready:
            asked = [
                (f, i, lo, hi, r - before)
                for i, (f, lo, hi, before, n) in enumerate(ready)
                for r in wanted[f]
                if before < r <= before + n
            ]
            segs = _segment_table(spark, [(f, i, lo, hi) for i, (f, lo, hi, _, _) in enumerate(ready)])
            inside = rows.join(segs, "feature").where(in_segment(F.col("value")))
            merged = inside.groupBy("seg", "value").agg(F.count("*").alias("c"))
            upto = Window.partitionBy("seg").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
            merged = merged.withColumn("upto", F.sum("c").over(upto))
            ranks = _segment_table(spark, asked, "rank long").select("seg", "rank")
            hit = merged.join(ranks, "seg").where("rank <= upto and rank > upto - c")
            for r in hit.select("seg", "rank", "value").collect():
                f, _, _, before, _ = ready[r["seg"]]
                found[f, r["rank"] + before] = r["value"]
        if wide:
            segs = _segment_table(spark, [(f, i, lo, hi) for i, (f, lo, hi, _, _) in enumerate(wide)])
            inside = rows.join(segs, "feature").where(in_segment(F.col("value")))
            cuts = {r["seg"]: r["cuts"] for r in inside.groupBy("seg").agg(cut_points(F.col("value")).alias("cuts")).collect()}
            table = local_table(spark, list(cuts.items()), "seg int, cuts array<double>")
            binned = inside.join(table, "seg").groupBy("seg", range_index(F.col("value"), F.col("cuts")).alias("r"))
            for seg, group in _by_segment(binned.agg(F.count("*").alias("c")).collect()).items():
                f, lo, hi, before, _ = wide[seg]
                for row in sorted(group, key=lambda x: x["r"]):
                    ranks = {r for r in wanted[f] if before < r <= before + row["c"]}
                    i, is_point = divmod(row["r"], 2)
                    if ranks and is_point:
                        found.update({(f, r): cuts[seg][i] for r in ranks})
                    elif ranks:
                        left = cuts[seg][i - 1] if i > 0 else lo
                        right = cuts[seg][i] if i < N_CUTS else hi
                        pending.append((f, left, right, before, row["c"]))
                    before += row["c"]
    return found


def _by_segment(rows: list) -> dict[int, list]:
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r["seg"], []).append(r)
    return out


def bin_counts(
    long_df: DataFrame, keys: Sequence[str], bins: int, group: Sequence[str] = (), limits: DataFrame | None = None
) -> DataFrame:
    """Equal-width histogram per key: every bin present, also empty ones.

    ``group`` columns (a class, a data set) share the key's bin edges and get counts and percent
    of their own total. The last bin is closed on the right.
    """
    keys, group = list(keys), list(group)
    rows = long_df.where(F.col("value").isNotNull())
    if limits is None:
        limits = small_table(rows.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi")))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    spot = F.floor((F.col("value") - F.col("lo")) / F.when(width > 0, width).otherwise(F.lit(1.0)))
    index = F.greatest(F.lit(0), F.least(F.lit(bins - 1), spot)).cast("int")
    counted = rows.join(limits, keys).groupBy(*keys, *group, index.alias("bin")).agg(F.count("*").alias("n"))
    counted = small_table(counted)
    totals = counted.groupBy(*keys, *group).agg(F.sum("n").alias("total"))
    grid = totals.join(limits, keys).select(
        *keys, *group, "lo", "hi", "total", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    full = grid.join(counted, [*keys, *group, "bin"], "left")
    edge = F.col("lo") + F.col("bin") * width
    return full.select(
        *keys,
        *group,
        "bin",
        edge.alias("left_edge"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("right_edge"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
        (F.lit(100.0) * F.coalesce(F.col("n"), F.lit(0)) / F.col("total")).alias("pct"),
    )
