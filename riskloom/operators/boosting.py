"""Gradient boosting of leaf-wise trees on histograms, for a binary target.

Features are cut into at most 255 bins once. A tree grows by its best leaf until it has ``num_leaves``;
the gain of a split counts L1 and L2 penalties on the leaf values. What Spark does for a tree is one
aggregate per round: every task adds up gradients by (leaf, feature, bin), the partial histograms meet
by (leaf, feature), and only the best cut of each leaf and feature comes back. A round expands all
leaves that may still be chosen, so a tree takes about as many rounds as it is deep, and choosing among
leaves whose children are known gives exactly the order of growing leaf by leaf.

Gradients are whole multiples of 2 ** -24. Sums of whole numbers do not depend on their order, so the
same trees come out under any partitioning and after any lost task.

Rows are written once as bins; margins are carried with them and renewed every few trees.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from riskloom.functions.expr import col
from riskloom.functions.session import materialise, ship

MAX_BIN = 255
UNIT = float(1 << 24)
WRITE_EVERY = 10  # trees between two writings of the margins
HISTOGRAM_BYTES = 64 << 20  # of one task


@dataclass
class Settings:
    """Names and defaults as in the search grids' library."""

    n_estimators: int = 100
    learning_rate: float = 0.1
    num_leaves: int = 31
    min_child_samples: int = 20
    min_child_weight: float = 1e-3
    reg_alpha: float = 0.0
    reg_lambda: float = 0.0
    colsample_bytree: float = 1.0
    subsample: float = 1.0
    subsample_freq: int = 0  # 0: subsample has no effect
    scale_pos_weight: float = 1.0
    max_bin: int = MAX_BIN
    seed: int = 42


@dataclass
class Tree:
    """Nodes as parallel lists; ``left`` is -1 at a leaf. A row goes left if its bin (value) is at most the cut."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    count: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, count: int, value: float) -> int:
        for name, v in (("feature", 0), ("bin", 0), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", value), ("count", count), ("gain", 0.0)):
            getattr(self, name).append(v)
        return len(self.left) - 1

    def route(self, x: np.ndarray, by_bin: bool) -> np.ndarray:
        """Leaf of each row, from bins or from values (a missing value goes right)."""
        f, left, right = np.array(self.feature), np.array(self.left), np.array(self.right)
        cut = np.array(self.bin if by_bin else self.threshold)
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while True:
            inner = left[node] >= 0
            if not inner.any():
                return node
            goes = x[rows, f[node]] <= cut[node]
            node = np.where(inner, np.where(goes, left[node], right[node]), node)


def penalised(g: np.ndarray | float, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def leaf_value(g: int, h: int, s: Settings) -> float:
    total = h / UNIT + s.reg_lambda
    return float(-penalised(g / UNIT, s.reg_alpha) / total) if total > 0 else 0.0


def best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray, s: Settings) -> tuple[float, int]:
    """Gain and bin of a histogram's best cut (the first on ties); gain -inf if no cut is allowed."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    if not len(gl):
        return -math.inf, 0
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl

    def worth(a, b):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.nan_to_num(penalised(a / UNIT, s.reg_alpha) ** 2 / (b / UNIT + s.reg_lambda), nan=0.0, posinf=0.0)

    gain = worth(gl, hl) + worth(gr, hr) - worth(g.sum(), h.sum())
    weight = s.min_child_weight * UNIT
    allowed = (nl >= max(1, s.min_child_samples)) & (nr >= max(1, s.min_child_samples)) & (hl >= weight) & (hr >= weight)
    gain = np.where(allowed, gain, -math.inf)
    at = int(gain.argmax())
    return float(gain[at]), at


def gradients(y: np.ndarray, margin: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the weighted log loss, in whole units."""
    p = 1.0 / (1.0 + np.exp(-margin))
    w = np.where(y > 0, s.scale_pos_weight, 1.0)
    return np.rint(w * (p - y) * UNIT).astype(np.int64), np.rint(w * p * (1.0 - p) * UNIT).astype(np.int64)


def chosen_features(width: int, tree: int, s: Settings) -> np.ndarray:
    n = min(width, max(1, round(width * s.colsample_bytree)))
    if n == width:
        return np.arange(width)
    return np.sort(np.random.default_rng([s.seed, tree]).permutation(width)[:n])


def in_bag(key: np.ndarray, tree: int, s: Settings) -> np.ndarray:
    """Rows that a tree is grown on; the draw is renewed every ``subsample_freq`` trees."""
    if s.subsample >= 1.0 or s.subsample_freq <= 0:
        return np.ones(len(key), bool)
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64) + np.uint64((s.seed * 1_000_003 + tree // s.subsample_freq) & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53) < s.subsample


@dataclass
class _Leaf:
    """A node while its tree grows: sums, best cut, and its children once a round has measured them."""

    node: int
    path: tuple
    g: int
    h: int
    n: int
    gain: float
    feature: int
    bin: int
    children: list | None = None


def grow(measure, s: Settings, cuts: Sequence[np.ndarray]) -> Tree | None:
    """Grow one tree. ``measure(tree, leaves)`` gives ``(g, h, n, gain, feature, bin)`` of each node in ``leaves``."""
    tree = Tree()
    sketch = Tree()  # with all nodes that were measured, chosen or not
    start = sketch.add(0, 0.0)
    root = _Leaf(start, (), *measure(sketch, [start])[0])
    if not root.gain > 0:
        return None
    heap = [(-root.gain, root.path, root)]
    place = {(): tree.add(root.n, leaf_value(root.g, root.h, s))}
    leaves = 1
    while heap and leaves < s.num_leaves:
        if heap[0][2].children is None:
            # All leaves that may still be chosen, best first.
            asked = [x for _, _, x in heapq.nsmallest(s.num_leaves - leaves, heap) if x.children is None]
            for x in asked:
                kids = [sketch.add(0, 0.0), sketch.add(0, 0.0)]
                sketch.feature[x.node], sketch.bin[x.node] = x.feature, x.bin
                sketch.left[x.node], sketch.right[x.node] = kids
            nodes = [k for x in asked for k in (sketch.left[x.node], sketch.right[x.node])]
            found = measure(sketch, nodes)
            for i, x in enumerate(asked):
                x.children = [_Leaf(nodes[2 * i + side], (*x.path, side), *found[2 * i + side]) for side in (0, 1)]
        _, _, x = heapq.heappop(heap)
        at = place[x.path]
        kids = []
        for child in x.children:
            k = place[child.path] = tree.add(child.n, leaf_value(child.g, child.h, s))
            kids.append(k)
            if child.gain > 0:
                heapq.heappush(heap, (-child.gain, child.path, child))
        tree.feature[at], tree.bin[at], tree.threshold[at] = x.feature, x.bin, float(cuts[x.feature][x.bin])
        tree.left[at], tree.right[at], tree.gain[at] = kids[0], kids[1], x.gain
        leaves += 1
    return tree


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Bins of a batch, from one fixed-length binary value per row."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


class _Rows:
    """The training rows as bins, and the trees grown since their margins were written."""

    def __init__(self, rows: DataFrame, width: int, bins: int, settings: Settings) -> None:
        self.rows, self.width, self.bins, self.s = rows, width, bins, settings
        self.fresh: list[Tree] = []
        self.grown = 0

    def add(self, tree: Tree) -> None:
        self.fresh.append(tree)
        self.grown += 1
        if len(self.fresh) < WRITE_EVERY:
            return
        fresh, schema, width, own = self.fresh, to_arrow_schema(self.rows.schema), self.width, _margin_of(self.s)

        def renew(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = _matrix(b.column("bins"), width)
                columns = [b.column("key"), b.column("bins"), b.column("y"), pa.array(own(b, x, fresh))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

        self.rows = materialise(self.rows.mapInArrow(renew, self.rows.schema), "boosted")
        self.fresh = []

    def measure(self, tree: Tree, leaves: list[int]) -> list[tuple]:
        """Sums and best cut of each leaf, a bounded number of leaves at a time."""
        features = chosen_features(self.width, self.grown, self.s)
        at_once = max(1, HISTOGRAM_BYTES // (24 * self.bins * len(features)))
        out: list[tuple] = []
        for i in range(0, len(leaves), at_once):
            out += self._measured(tree, leaves[i : i + at_once], features)
        return out

    def _measured(self, tree: Tree, leaves: list[int], features: np.ndarray) -> list[tuple]:
        s, width, bins, fresh, grown = self.s, self.width, self.bins, list(self.fresh), self.grown
        slot = np.full(len(tree.left), -1)
        slot[leaves] = np.arange(len(leaves))
        margin_of = _margin_of(s)
        sums = T.StructType().add("slot", "integer").add("feature", "integer").add("sums", T.ArrayType(T.LongType()))
        best = T.StructType.fromDDL("slot int, feature int, g long, h long, n long, gain double, bin int")
        sums_schema, best_schema = to_arrow_schema(sums), to_arrow_schema(best)

        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(features), 3, len(leaves) * bins), np.int64)
            for b in batches:
                x = _matrix(b.column("bins"), width)
                place = slot[tree.route(x, True)]
                used = np.flatnonzero((place >= 0) & in_bag(b.column("key").to_numpy(), grown, s))
                if not len(used):
                    continue
                y = b.column("y").to_numpy(zero_copy_only=False)
                g, h = gradients(y, margin_of(b, x, fresh), s)
                g, h, x, place = g[used], h[used], x[used], place[used]
                for k, f in enumerate(features):
                    at = place * bins + x[:, f]
                    for m, weight in enumerate((g, h, None)):
                        total[k, m] += np.bincount(at, weight, minlength=total.shape[2]).astype(np.int64)
            rows = [
                {"slot": i, "feature": int(f), "sums": total[k, :, i * bins : (i + 1) * bins].ravel()}
                for k, f in enumerate(features)
                for i in range(len(leaves))
                if total[k, 2, i * bins : (i + 1) * bins].any()
            ]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=sums_schema)

        def choose(table: pa.Table) -> pa.Table:
            parts = table["sums"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, 3, bins).sum(axis=0)
            gain, at = best_cut(*parts, s)
            g, h, n = (int(v) for v in parts.sum(axis=1))
            row = {"slot": table["slot"][0].as_py(), "feature": table["feature"][0].as_py(), "g": g, "h": h, "n": n, "gain": gain, "bin": at}
            return pa.Table.from_pylist([row], schema=best_schema)

        found = self.rows.mapInArrow(collect, sums).groupBy("slot", "feature").applyInArrow(choose, best).collect()
        out: list[tuple] = [(0, 0, 0, -math.inf, 0, 0)] * len(leaves)
        for r in sorted(found, key=lambda r: (r["slot"], -r["gain"], r["feature"]), reverse=True):
            out[r["slot"]] = (r["g"], r["h"], r["n"], r["gain"], r["feature"], r["bin"])
        return out


def _margin_of(s: Settings):
    def margin(batch: pa.RecordBatch, x: np.ndarray, fresh: list[Tree]) -> np.ndarray:
        out = batch.column("margin").to_numpy(zero_copy_only=False).copy()
        for t in fresh:
            out += s.learning_rate * np.array(t.value)[t.route(x, True)]
        return out

    return margin


def bin_cuts(rows: DataFrame, width: int, max_bin: int = MAX_BIN) -> list[np.ndarray]:
    """Ascending cuts of each position of the array ``x``: values that occur, at equal shares of the rows.

    A value's bin is the number of cuts below it; equal quantiles are one cut.
    """
    shares = [i / max_bin for i in range(1, max_bin)]
    long = rows.select(F.posexplode("x").alias("j", "v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    found = {r["j"]: r["cuts"] for r in long.groupBy("j").agg(F.percentile_approx("v", shares, 10_000).alias("cuts")).collect()}
    return [np.unique(np.array(found.get(j) or [0.0])) for j in range(width)]


def fit_boosting(df: DataFrame, features: str, label: str, settings: Settings) -> tuple[list[Tree], float, int]:
    """Trees, starting margin (log odds of the mean label) and number of features.

    ``features`` is a vector or array column of one length, ``label`` 0 or 1. Rows without either are
    left out. Boosting ends early where no cut has a positive gain.
    """
    ship(df.sparkSession)
    is_vector = df.schema[features].dataType.typeName() != "array"
    x = vector_to_array(col(features)) if is_vector else col(features).cast("array<double>")
    raw = df.where(col(features).isNotNull() & col(label).isNotNull()).select(x.alias("x"), col(label).cast("double").alias("y"))
    raw = materialise(raw.withColumn("key", F.monotonically_increasing_id()), "boosting_input")
    told = raw.agg(F.avg("y").alias("p"), F.max(F.size("x")).alias("width")).first()
    if told["p"] is None:
        raise ValueError("no rows to learn from")
    p, width = min(max(told["p"], 1e-15), 1 - 1e-15), told["width"]
    start = math.log(p / (1 - p))
    cuts = bin_cuts(raw, width, settings.max_bin)
    binned = T.StructType().add("key", "long").add("bins", "binary").add("y", "double").add("margin", "double")
    schema = to_arrow_schema(binned)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            bins = np.empty(values.shape, np.uint8)
            for j in range(width if b.num_rows else 0):
                bins[:, j] = np.searchsorted(cuts[j], values[:, j], side="left")
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array([r.tobytes() for r in bins], pa.binary()), b.column("y"), pa.array(np.full(b.num_rows, start))], schema=schema
            )

    rows = _Rows(materialise(raw.mapInArrow(cut, binned), "boosting_bins"), width, max(len(c) for c in cuts) + 1, settings)
    trees: list[Tree] = []
    for _ in range(settings.n_estimators):
        tree = grow(rows.measure, settings, cuts)
        if tree is None:
            break
        trees.append(tree)
        rows.add(tree)
    return trees, start, width


class BoostedTrees(Estimator):
    """Estimator with the grid's parameter names; takes its place in a ``Pipeline``."""

    def __init__(self, features: str = "features", label: str = "label", **params) -> None:
        super().__init__()
        self.features, self.label = features, label
        self.settings = Settings(**params)

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        trees, start, width = fit_boosting(dataset, self.features, self.label, self.settings)
        return BoostedTreesModel(self.features, trees, start, self.settings.learning_rate, width)


class BoostedTreesModel(Model, MLWritable, MLReadable):
    """Adds ``rawPrediction``, ``probability`` and ``prediction``; can be saved as a stage of a pipeline."""

    def __init__(self, features: str = "features", trees: Sequence[Tree] = (), start: float = 0.0, rate: float = 0.1, width: int = 0) -> None:
        super().__init__()
        self.features, self.trees, self.start, self.rate, self.width = features, list(trees), start, rate, width

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += self.rate * np.array(t.value)[t.route(x, False)]
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship(dataset.sparkSession)
        trees, start, rate = dataset.sparkSession.sparkContext.broadcast(self.trees), self.start, self.rate
        is_vector = dataset.schema[self.features].dataType.typeName() != "array"
        x = vector_to_array(col(self.features)) if is_vector else col(self.features).cast("array<double>")

        @F.pandas_udf("double")
        def margin(values: pd.Series) -> pd.Series:
            known = values.notna().to_numpy()
            out = np.full(len(values), np.nan)
            if known.any():
                rows = np.stack(values[known].to_numpy())
                total = np.full(len(rows), start)
                for t in trees.value:
                    total += rate * np.array(t.value)[t.route(rows, False)]
                out[known] = total
            return pd.Series(out)

        scored = dataset.withColumn("_margin", margin(x))
        known = F.col("_margin").isNotNull()
        m = F.coalesce("_margin", F.lit(0.0))
        p = 1.0 / (1.0 + F.exp(-m))
        pair = lambda a, b: F.when(known, array_to_vector(F.array(a, b)))
        return scored.withColumns(
            {"rawPrediction": pair(-m, m), "probability": pair(1.0 - p, p), "prediction": F.when(known, (p > 0.5).cast("double"))}
        ).drop("_margin")

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        """Gain of all splits on each feature, adding up to one."""
        total = np.zeros(self.width)
        for t in self.trees:
            for f, left, gain in zip(t.feature, t.left, t.gain):
                if left >= 0:
                    total[f] += gain
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def leaf_paths(self) -> list[tuple[float, list[tuple]]]:
        """Per leaf its value and, per feature on its path, ``(feature, share of rows, low, high, None)``."""
        out = []
        for t in self.trees:
            stack: list[tuple[int, dict]] = [(0, {})]
            while stack:
                node, held = stack.pop()
                if t.left[node] < 0:
                    out.append((self.rate * t.value[node], [(f, *c, None) for f, c in held.items()]))
                    continue
                f, cut = t.feature[node], t.threshold[node]
                share, low, high = held.get(f, (1.0, -math.inf, math.inf))
                for child, bounds in ((t.left[node], (low, min(high, cut))), (t.right[node], (max(low, cut), high))):
                    stack.append((child, {**held, f: (share * t.count[child] / t.count[node], *bounds)}))
        return out

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: BoostedTreesModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802
        m = self.model
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={"settings": [m.features, m.start, m.rate, m.width]})
        rows = [(i, json.dumps(asdict(t))) for i, t in enumerate(m.trees)]
        spark.createDataFrame(rows, "tree int, nodes string").write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> BoostedTreesModel:
        spark = self.sparkSession
        features, start, rate, width = DefaultParamsReader.loadMetadata(path, spark)["settings"]
        trees = [Tree(**json.loads(r["nodes"])) for r in spark.read.parquet(f"{path}/trees").orderBy("tree").collect()]
        return BoostedTreesModel(features, trees, start, rate, width)


def settings_of(params: Mapping, scale_pos_weight: float, seed: int) -> Settings:
    """Settings from grid parameters; unknown names are an error."""
    return Settings(**{"scale_pos_weight": scale_pos_weight, "seed": seed, **params})
