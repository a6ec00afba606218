"""Reproducible sampling and leak-free splits.

Rows are ordered by ``md5(id | seed)``, which every engine computes alike and which does not
depend on partitioning. A sample is never made by ranking all rows: the key of the r-th row is
located by counting hash prefixes, and the sample is then a plain filter on that key. The data
rows are not shuffled and a stratum holding most of the table costs no more than any other.
``id`` must be unique.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskloom.functions.expr import col
from riskloom.functions.session import local_table, materialise, small_table

_STEP = 2  # hex digits per level: 256 counters per stratum
MAX_COUNTERS = 100_000  # counters the driver holds (about 390 strata)
BUCKET_ROWS = 500_000  # rows of one hash bucket that one task may sort


def sample_key(id_col: str, seed: int = 42) -> Column:
    return F.md5(F.concat(col(id_col).cast("string"), F.lit(f"|{seed}")))


def _keyed(df: DataFrame, id_col: str, stratum: str | None, seed: int) -> DataFrame:
    value = col(stratum) if stratum else F.lit(0)
    keyed = df.select(value.alias("stratum"), sample_key(id_col, seed).alias("key"))
    return keyed.where(F.col("stratum").isNotNull()) if stratum else keyed


@dataclass
class HashCounts:
    """Rows per stratum and first hash digits of one table, id and seed."""

    keyed: DataFrame
    table: DataFrame
    local: dict | None  # stratum -> {prefix: rows}; None when there are too many strata

    @classmethod
    def of(cls, df: DataFrame, id_col: str, stratum: str | None = None, seed: int = 42, held: int | None = None) -> HashCounts:
        held = MAX_COUNTERS if held is None else held
        keyed = _keyed(df, id_col, stratum, seed)
        counts = keyed.groupBy("stratum", F.substring("key", 1, _STEP).alias("prefix")).agg(F.count("*").alias("n"))
        rows = counts.limit(held + 1).collect()
        if len(rows) > held:
            return cls(keyed, materialise(counts, "hash_counts"), None)
        local: dict = {}
        for r in rows:
            local.setdefault(r["stratum"], {})[r["prefix"]] = r["n"]
        return cls(keyed, counts, local)

    def sizes(self) -> dict:
        if self.local is None:
            raise ValueError("too many classes")
        return {s: sum(c.values()) for s, c in self.local.items()}

    def _schema(self, extra: str) -> T.StructType:
        kind = T.StructField("stratum", self.keyed.schema["stratum"].dataType)
        return T.StructType([kind, *T.StructType.fromDDL(extra).fields])

    def keys_at(self, wanted: Sequence[tuple]) -> list[tuple]:
        """``(stratum, cut, key)`` for wanted ``(stratum, cut, rank)``; ranks outside are left out.

        Only rows sharing the first digits of a wanted key are read again, and only those of the
        last bucket are sorted. Buckets too large for one task are counted by further digits.
        """
        pending = []
        for s, cut, rank in wanted:
            pending += _place(s, cut, rank, self.local.get(s, {}))
        digits = _STEP
        spark = self.keyed.sparkSession
        while pending and max(p[4] for p in pending) > BUCKET_ROWS and digits < 32:
            inside = self._inside(spark, pending, digits)
            digits += _STEP
            finer: dict = {}
            for r in inside.groupBy("stratum", "bucket", F.substring("key", 1, digits).alias("prefix")).count().collect():
                finer.setdefault((r["stratum"], r["bucket"]), {})[r["prefix"]] = r["count"]
            pending = [q for s, cut, rank, b, _ in pending for q in _place(s, cut, rank, finer[s, b])]
        if not pending:
            return []
        order = Window.partitionBy("stratum", "bucket").orderBy("key")
        ranked = self._inside(spark, pending, digits).withColumn("rank", F.row_number().over(order).cast("long"))
        asked = local_table(spark, [(s, b, rank, cut) for s, cut, rank, b, _ in pending], self._schema("bucket string, rank long, cut string"))
        hits = ranked.join(asked, ["stratum", "bucket", "rank"]).select("stratum", "cut", "key")
        return [tuple(r) for r in hits.collect()]

    def _inside(self, spark, pending: list, digits: int) -> DataFrame:
        buckets = sorted({(s, b) for s, _, _, b, _ in pending})
        table = local_table(spark, buckets, self._schema("bucket string"))
        return self.keyed.withColumn("bucket", F.substring("key", 1, digits)).join(table, ["stratum", "bucket"])

    def key_table(self, ranks: DataFrame) -> DataFrame:
        """:meth:`keys_at` for more strata than the driver may hold: the same steps as joins.

        ``ranks`` is ``(stratum, cut, rank)``; one bucket holds a 256th of one stratum.
        """
        upto = Window.partitionBy("stratum").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
        hits = (
            self.table.withColumn("upto", F.sum("n").over(upto))
            .join(ranks.where("rank >= 1"), "stratum")
            .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
            .select("stratum", F.col("prefix").alias("p1"), "cut", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))
        )
        scoped = self.keyed.withColumn("p1", F.substring("key", 1, _STEP))
        scoped = scoped.join(hits.select("stratum", "p1").distinct(), ["stratum", "p1"], "left_semi")
        scoped = scoped.withColumn("p2", F.substring("key", 1, 2 * _STEP))
        finer = scoped.groupBy("stratum", "p1", "p2").agg(F.count("*").alias("n"))
        upto = Window.partitionBy("stratum", "p1").orderBy("p2").rowsBetween(Window.unboundedPreceding, 0)
        spots = (
            finer.withColumn("upto", F.sum("n").over(upto))
            .join(hits, ["stratum", "p1"])
            .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
            .select("stratum", "p2", "cut", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))
        )
        order = Window.partitionBy("stratum", "p2").orderBy("key")
        placed = scoped.withColumn("rank", F.row_number().over(order).cast("long"))
        return materialise(placed.join(spots, ["stratum", "p2", "rank"]).select("stratum", "cut", "key"), "keys")


def _place(stratum, cut, rank: int, counts: Mapping[str, int]) -> list[tuple]:
    """The bucket that holds a rank, with the rank inside it: ``(stratum, cut, rank, bucket, rows)``."""
    if rank < 1:
        return []
    for prefix in sorted(counts):
        if rank <= counts[prefix]:
            return [(stratum, cut, rank, prefix, counts[prefix])]
        rank -= counts[prefix]
    return []


def _last_key(df: DataFrame, id_col: str, n: int, seed: int) -> str | None:
    """Sample key of the n-th row overall; None when there are fewer rows."""
    found = HashCounts.of(df, id_col, None, seed).keys_at([(0, "last", n)])
    return found[0][2] if found else None


def sample_rows(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement."""
    if n <= 0:
        return df.limit(0)
    last = _last_key(df, id_col, n, seed)
    return df if last is None else df.where(sample_key(id_col, seed) <= F.lit(last))


def _join_cuts(df: DataFrame, stratum: str, cuts: list[tuple], names: Sequence[str]) -> DataFrame:
    """Add ``cut_<name>`` columns: one broadcast row per class."""
    wide: dict = {}
    for s, cut, key in cuts:
        wide.setdefault(s, {})[cut] = key
    fields = [T.StructField(stratum, df.schema[stratum].dataType)] + [T.StructField(f"cut_{n}", T.StringType()) for n in names]
    rows = [(s, *[found.get(n) for n in names]) for s, found in wide.items()]
    return df.join(local_table(df.sparkSession, rows, T.StructType(fields)), stratum, "left")


def _quota_sample(df: DataFrame, id_col: str, stratum: str, counts: HashCounts, quota, n: int, seed: int) -> DataFrame:
    """Per-stratum quotas, then a top-up by global hash order to ``n`` rows.

    ``quota(stratum, rows, total, strata)`` works on numbers and, for very many strata, on columns.
    """
    if counts.local is not None:
        sizes = counts.sizes()
        total = sum(sizes.values())
        quotas = {s: quota(s, c, total, len(sizes)) for s, c in sizes.items()}
        taken = sum(quotas.values())
        cuts = counts.keys_at([(s, "q", q) for s, q in quotas.items()])
        marked = _join_cuts(df, stratum, cuts, ["q"])
    else:
        sized = counts.table.groupBy("stratum").agg(F.sum("n").alias("n"))
        head = sized.agg(F.sum("n").alias("total"), F.count("*").alias("strata")).first()
        each = quota(F.col("stratum"), F.col("n"), head["total"], head["strata"])
        ranks = sized.select("stratum", F.lit("q").alias("cut"), each.cast("long").alias("rank"))
        taken = ranks.agg(F.sum("rank").alias("s")).first()["s"]
        keys = counts.key_table(ranks).select(F.col("stratum").alias(stratum), F.col("key").alias("cut_q"))
        marked = df.join(keys, stratum, "left")
    marked = marked.withColumn("_in", F.coalesce(sample_key(id_col, seed) <= F.col("cut_q"), F.lit(False)))
    if n > taken:
        last = _last_key(marked.where(~F.col("_in")), id_col, n - taken, seed)
        extra = F.lit(True) if last is None else sample_key(id_col, seed) <= F.lit(last)
        marked = marked.withColumn("_in", F.col("_in") | extra)
    return marked.where("_in").select(*map(col, df.columns))


def _total(counts: HashCounts) -> int:
    if counts.local is not None:
        return sum(counts.sizes().values())
    return counts.table.agg(F.sum("n").alias("n")).first()["n"]


def stratified_sample(df: DataFrame, id_col: str, stratum: str, n: int, seed: int = 42) -> DataFrame:
    """Proportional sample: ``floor(n * share)`` rows per stratum, topped up to ``n``."""
    labelled = df.where(col(stratum).isNotNull())
    counts = HashCounts.of(df, id_col, stratum, seed)
    if _total(counts) <= n:
        return labelled

    def quota(_, rows, total, __):
        if isinstance(rows, Column):
            exact = F.lit(n).cast("decimal(20,0)") * rows.cast("decimal(20,0)")
            return F.floor(exact / F.lit(total).cast("decimal(20,0)"))
        return n * rows // total

    return _quota_sample(labelled, id_col, stratum, counts, quota, n, seed)


def noise_capped_sample(df: DataFrame, id_col: str, label: str, n: int, seed: int = 42) -> DataFrame:
    """Cluster sample: label -1 gets at most 20 %, the others share 80 % evenly, then a top-up."""
    labelled = df.where(col(label).isNotNull())
    counts = HashCounts.of(df, id_col, label, seed)
    if _total(counts) <= n:
        return labelled

    def quota(s, rows, _, strata):
        noise, each = int(n * 0.2), int(n * 0.8 / max(1, strata - 1))
        if isinstance(rows, Column):
            return F.least(rows, F.when(s == -1, F.lit(noise)).otherwise(F.lit(each)))
        return min(rows, noise if s == -1 else each)

    return _quota_sample(labelled, id_col, label, counts, quota, n, seed)


def allocate(draws: int, sizes: Mapping) -> dict:
    """Share ``draws`` over classes in proportion; the largest remainders get the odd rows."""
    total = sum(sizes.values())
    if total == 0:
        return {k: 0 for k in sizes}
    base = {k: draws * n // total for k, n in sizes.items()}
    odd = draws - sum(base.values())
    order = sorted(sizes, key=lambda k: (-(draws * sizes[k] % total), k))
    for k in order[:odd]:
        base[k] += 1
    return base


def _first_places(table: DataFrame, order: Sequence[Column], n: int, output: str) -> DataFrame:
    """Add ``output``: true for the first ``n`` rows by ``order``, which no two rows may share.

    Rows are dealt by ranges of the order and ranked inside them; what comes before a range is the
    sum of the counts of the ranges before it, one row each.
    """
    dealt = materialise(table.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "places")
    before, offsets = 0, []
    for p, rows in sorted(map(tuple, dealt.groupBy("_p").count().collect())):
        offsets.append((p, before))
        before += rows
    starts = local_table(table.sparkSession, offsets, "_p int, _before long")
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return dealt.join(starts, "_p").withColumn(output, place <= n).drop("_p", "_before")


def allocated(sizes: DataFrame, size: str, draws: int, output: str) -> DataFrame:
    """:func:`allocate` for a table of any number of classes: adds ``output`` to ``sizes(stratum, ...)``."""
    total = sizes.agg(F.sum(size)).first()[0] or 0
    if total == 0:
        return sizes.withColumn(output, F.lit(0).cast("long"))
    whole = F.lit(total).cast("decimal(19,0)")
    exact = F.lit(draws).cast("decimal(19,0)") * F.col(size).cast("decimal(19,0)")
    shared = sizes.withColumn("_rem", exact % whole).withColumn("_base", ((exact - F.col("_rem")) / whole).cast("long"))
    odd = draws - shared.agg(F.sum("_base")).first()[0]
    marked = _first_places(shared, [F.col("_rem").desc(), F.col("stratum").asc()], odd, "_odd")
    return marked.withColumn(output, F.col("_base") + F.col("_odd").cast("long")).drop("_rem", "_base", "_odd")


def _cut_rows(df: DataFrame, stratum: str, counts: HashCounts, ranks: dict[str, Column], sizes: DataFrame) -> DataFrame:
    """:func:`_join_cuts` from a table of classes; ``ranks`` names each cut's rank in ``sizes``."""
    cuts = F.explode(F.array(*[F.struct(F.lit(n).alias("cut"), r.cast("long").alias("rank")) for n, r in ranks.items()]))
    keys = counts.key_table(sizes.select("stratum", cuts.alias("c")).select("stratum", "c.cut", "c.rank"))
    wide = keys.groupBy(F.col("stratum").alias(stratum)).agg(
        *[F.max(F.when(F.col("cut") == n, F.col("key"))).alias(f"cut_{n}") for n in ranks]
    )
    return df.join(wide, stratum, "left")


def split_rows(
    df: DataFrame, id_col: str, target: str, test_size: float = 0.2, val_size: float = 0.2, seed: int = 42, held: int | None = None
) -> DataFrame:
    """Add ``split``: 'test_final', 'val' or 'train', stratified on ``target``.

    Every id falls in one split by construction. ``val_size`` is a share of what is left after
    the test rows. Rows without a target are left out. Any number of classes is taken: up to ``held``
    counters (by default 100,000, 256 a class) the quotas are numbers of the driver, beyond that they
    are a table; the result is the same.
    """
    counts = HashCounts.of(df, id_col, target, seed, held)
    known = df.where(col(target).isNotNull())
    if counts.local is None:
        classes = materialise(counts.table.groupBy("stratum").agg(F.sum("n").alias("n")), "classes")
        total = classes.agg(F.sum("n")).first()[0]
        test = materialise(allocated(classes, "n", math.ceil(test_size * total), "test"), "classes")
        left = test.withColumn("left", F.col("n") - F.col("test"))
        rest = left.agg(F.sum("left")).first()[0]
        quotas = materialise(allocated(left, "left", math.ceil(val_size * rest), "val"), "classes")
        marked = _cut_rows(known, target, counts, {"test": F.col("test"), "val": F.col("test") + F.col("val")}, quotas)
    else:
        sizes = counts.sizes()
        test = allocate(math.ceil(test_size * sum(sizes.values())), sizes)
        left = {k: sizes[k] - test[k] for k in sizes}
        val = allocate(math.ceil(val_size * sum(left.values())), left)
        cuts = counts.keys_at([(k, "test", test[k]) for k in sizes] + [(k, "val", test[k] + val[k]) for k in sizes])
        marked = _join_cuts(known, target, cuts, ["test", "val"])
    key = sample_key(id_col, seed)
    split = F.when(key <= F.col("cut_test"), "test_final").when(key <= F.col("cut_val"), "val").otherwise("train")
    return marked.withColumn("split", split).select(*map(col, df.columns), "split")


def split_sets(split_df: DataFrame) -> dict[str, DataFrame]:
    """The four named sets of a split frame: train, val, test_final and train_val."""
    sets = {s: split_df.where(F.col("split") == s).drop("split") for s in ("train", "val", "test_final")}
    sets["train_val"] = split_df.where(F.col("split") != "test_final").drop("split")
    return sets


def split_summary(split_df: DataFrame) -> DataFrame:
    """Rows per split. Train and validation shares are of train + validation, test is of all rows."""
    counts = small_table(split_df.groupBy("split").agg(F.count("*").alias("n")))
    n = {r["split"]: r["n"] for r in counts.collect()}
    everything = sum(n.values())
    base = F.when(F.col("split") == "test_final", F.lit(everything)).otherwise(F.lit(everything - n.get("test_final", 0)))
    return counts.select("split", "n", (F.lit(100.0) * F.col("n") / base).alias("pct"))


def split_overlap(df: DataFrame, id_col: str, split_col: str = "split") -> DataFrame:
    """Ids found in more than one split; empty when the split is sound."""
    return (
        df.groupBy(id_col)
        .agg(F.min(split_col).alias("first_split"), F.max(split_col).alias("last_split"))
        .where("first_split <> last_split")
    )


def stratified_folds(df: DataFrame, id_col: str, target: str, k: int = 3, seed: int = 42, held: int | None = None) -> DataFrame:
    """Add ``fold`` 0..k-1: consecutive hash ranges per class, sizes differing by at most one.

    Any number of classes is taken; ``held`` is that of :func:`split_rows`.
    """
    counts = HashCounts.of(df, id_col, target, seed, held)
    known = df.where(col(target).isNotNull())
    names = [str(j) for j in range(k - 1)]
    if counts.local is None:
        classes = materialise(counts.table.groupBy("stratum").agg(F.sum("n").alias("n")), "classes")
        whole, odd = F.floor(F.col("n") / k), F.col("n") % k
        upto = {n: (int(n) + 1) * whole + F.least(odd, F.lit(int(n) + 1)) for n in names}
        rows = _cut_rows(known, target, counts, upto, classes) if names else known
    else:
        wanted = []
        for label, n in counts.sizes().items():
            upto = 0
            for j in range(k - 1):
                upto += n // k + (1 if j < n % k else 0)
                wanted.append((label, str(j), upto))
        rows = _join_cuts(known, target, counts.keys_at(wanted), names)
    key = sample_key(id_col, seed)
    fold = F.lit(k - 1)
    for j in reversed(range(k - 1)):
        fold = F.when(key <= F.col(f"cut_{j}"), F.lit(j)).otherwise(fold)
    return rows.withColumn("fold", fold.cast("int")).select(*map(col, df.columns), "fold")
