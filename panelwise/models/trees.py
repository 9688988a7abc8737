"""Boosted trees grown leaf by leaf on histograms.

Each feature is cut into at most 255 bins (one per value where there are no more values, else by quantiles from a sketch), missing values
are a bin of their own, and rows are kept as one byte per feature. A *pass* is one Spark job: every task sends its rows down the tree as far as it
is known and adds their gradients up per node, feature and bin. The driver sees histograms only; it takes the best split of each
node, tries missing values on either side, and grows the tree best gain first.

A pass serves many nodes. All nodes that best-first growth could still choose, given what is known, are split for trial, and the
histogram of the smaller child of each is summed; the larger one's is the difference to their parent's. Growth ends when everything
it chooses is known, so the tree is exactly the one that splitting one leaf at a time gives, after as many passes as the tree is deep.

Gains that differ by rounding only count as equal, and the first feature, bin and direction wins, so the same rows give the same trees
however they are dealt out. Predictions are kept with the rows: the first pass of a round adds the tree before to them and
caches the result, so that no pass goes through finished trees again. Every ``KEEP`` rounds the rows are written into a
staged table, which cuts the lineage.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise.functions.columns import by_position
from panelwise.models.gram import matrix_of
from panelwise.runtime import col, drop_staged, stage_table

MISSING = 255
BINS = 256
#: Rounds after which the rows are staged, rows of a task at least, and rows of a task at most if there are four tasks per core.
KEEP = 20
TASK_ROWS = 50_000
MOST_TASK_ROWS = 1_000_000
#: Bytes of histograms that tasks hand to the driver unsummed, and that one pass makes at most.
DIRECT_BYTES = 32 * 1024 * 1024
PASS_BYTES = 128 * 1024 * 1024
#: Gains closer than this, relative to the larger one, are equal.
EQUAL = 1e-9
SKETCH_K = 4096

SUMS = T.StructType([T.StructField("node", T.IntegerType()), T.StructField("f", T.IntegerType()), T.StructField("v", T.ArrayType(T.DoubleType()))])


@dataclass
class Tree:
    """Nodes by number; -1 as ``left`` marks a leaf. Bins up to ``cut`` go left, missing values where ``missing_left`` says."""

    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def add(self) -> int:
        for own, empty in ((self.feature, 0), (self.cut, 0), (self.missing_left, False), (self.left, -1), (self.right, -1), (self.value, 0.0), (self.gain, 0.0)):
            own.append(empty)
        return len(self.left) - 1

    def leaves_of(self, bins: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The node at which each row ends, starting from where it is, if ``at`` says so."""
        feature, cut, missing, left, right = (np.array(x) for x in (self.feature, self.cut, self.missing_left, self.left, self.right))
        at = np.zeros(len(bins), np.int64) if at is None else at.copy()
        flat, first = np.ascontiguousarray(bins.T).reshape(-1), feature * len(bins)
        moving = np.flatnonzero(left[at] >= 0)
        while len(moving):
            node = at[moving]
            own = flat[first[node] + moving]
            goes_left = np.where(own == MISSING, missing[node], own <= cut[node])
            at[moving] = np.where(goes_left, left[node], right[node])
            moving = moving[left[at[moving]] >= 0]
        return at


@dataclass
class Split:
    gain: float
    feature: int
    cut: int
    missing_left: bool
    #: Sum of gradients and rows of the left child.
    g: float
    n: float


def best_split(hist: np.ndarray, least: int, penalty: float) -> Split | None:
    """The best split of a node by its histogram (features x (gradients, rows) x bins); none if nothing is gained."""
    g, n = hist[:, 0, :MISSING], hist[:, 1, :MISSING]
    missing_g, missing_n = hist[:, 0, MISSING], hist[:, 1, MISSING]
    total_g, total_n = g.sum(axis=1) + missing_g, n.sum(axis=1) + missing_n
    below_g, below_n = np.cumsum(g, axis=1), np.cumsum(n, axis=1)
    before = (total_g**2 / (total_n + penalty))[:, None]
    found, sides = [], []
    for with_missing in (False, True):
        left_g = below_g + (missing_g[:, None] if with_missing else 0.0)
        left_n = below_n + (missing_n[:, None] if with_missing else 0.0)
        right_g, right_n = total_g[:, None] - left_g, total_n[:, None] - left_n
        allowed = (left_n >= least) & (right_n >= least) & (n > 0)
        if with_missing:
            allowed &= missing_n[:, None] > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_g**2 / (left_n + penalty) + right_g**2 / (right_n + penalty) - before
        found.append(np.where(allowed, gain, -np.inf))
        sides.append((left_g, left_n))
    gains = np.stack(found, 2)  # feature, bin, direction
    top = gains.max(initial=-np.inf)
    scale = float(before.max(initial=0.0))
    if not np.isfinite(top) or top <= EQUAL * max(scale, 1e-300):
        return None
    f, b, d = (int(x) for x in np.unravel_index(np.flatnonzero(gains.ravel() >= top - EQUAL * top)[0], gains.shape))
    left_g, left_n = sides[d]
    goes_left = bool(d) if missing_n[f] > 0 else bool(left_n[f, b] * 2 > total_n[f])
    return Split(float(gains[f, b, d]), f, b, goes_left, float(left_g[f, b]), float(left_n[f, b]))


#: Rows are kept in blocks, one per batch that came: bins (one row per feature), labels, which rows are held out, predictions.
BLOCK = "n long, total double, low double, high double, bins binary, y binary, held binary, f binary"


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for bins, y, held, f in zip(*(batch.column(c) for c in ("bins", "y", "held", "f"))):
            y = np.frombuffer(y.as_buffer())
            yield np.frombuffer(bins.as_buffer(), np.uint8).reshape(width, len(y)).T, y, np.frombuffer(held.as_buffer(), bool), np.frombuffer(f.as_buffer())


def _block(bins: np.ndarray, y: np.ndarray, held: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
    own = y[~held]
    numbers = [len(own), float(own.sum()), float(own.min(initial=np.inf)), float(own.max(initial=-np.inf))]
    parts = [np.ascontiguousarray(bins.T), y, held, f]
    arrays = [pa.array([numbers[0]], pa.int64()), *[pa.array([x], pa.float64()) for x in numbers[1:]], *[pa.array([x.tobytes()], pa.binary()) for x in parts]]
    return pa.RecordBatch.from_arrays(arrays, names=["n", "total", "low", "high", "bins", "y", "held", "f"])


class _Places:
    """At which node of the tree that is growing the rows of a task stand.

    A worker process remembers this for a few tasks and goes on from there; one that has not seen a task before starts at the root.
    """

    known: OrderedDict[tuple[str, int], list] = OrderedDict()
    MOST = 8

    def __init__(self, growing: str, part: int, tree: Tree):
        self.key, self.tree = (growing, part), tree
        self.before = _Places.known.pop(self.key, [])
        self.now: list[np.ndarray] = []

    def next(self, bins: np.ndarray) -> np.ndarray:
        """The nodes of the next batch of the task."""
        at = self.before[len(self.now)] if len(self.now) < len(self.before) else None
        if at is not None and (len(at) != len(bins) or at.max(initial=0) >= len(self.tree.left)):
            at = None
        at = self.tree.leaves_of(bins, at).astype(np.int32)
        self.now.append(at)
        return at

    def remember(self) -> None:
        _Places.known[self.key] = self.now
        while len(_Places.known) > self.MOST:
            _Places.known.popitem(last=False)


def find_cuts(rows: DataFrame, width: int, max_bins: int) -> list[np.ndarray]:
    """Ascending cuts per feature: a value goes into the first bin whose cut it does not exceed, beyond all of them into the last.

    Midpoints between the values where a feature has at most ``max_bins`` of them, else quantiles from a sketch of all rows.
    """

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[np.ndarray | None] = [np.zeros(0)] * width
        for batch in batches:
            table = matrix_of(batch)
            for f in range(width):
                if known[f] is not None:
                    own = np.unique(np.concatenate([known[f], table[:, f]]))
                    own = own[~np.isnan(own)]
                    known[f] = own if len(own) <= max_bins else None
        out = [(f, None if v is None else float(x)) for f, v in enumerate(known) for x in ([0.0] if v is None else v)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in out], pa.int32()), pa.array([x for _, x in out], pa.float64())], names=["f", "x"])

    values = rows.select(*[f"x{f}" for f in range(width)]).mapInArrow(distinct, "f int, x double").distinct()
    gathered = values.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x").isNull()).alias("more"), F.sort_array(F.collect_set("x")).alias("x"))
    few = gathered.withColumn("many", (F.col("more") > 0) | (F.col("n") > max_bins)).select("f", "many", F.when(~F.col("many"), F.col("x")).alias("x")).collect()
    cuts, many = [np.zeros(0)] * width, []
    for r in few:
        if r["many"]:
            many.append(r["f"])
        else:
            x = np.array(r["x"])
            cuts[r["f"]] = (x[:-1] + x[1:]) / 2
    if many:
        shares = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
        pairs = by_position(rows, [F.col(f"x{f}") for f in many]).filter("value is not null and not isnan(value)")
        sketched = pairs.groupBy("position").agg(F.kll_sketch_agg_double("value", SKETCH_K).alias("s"))
        for r in sketched.select("position", F.kll_sketch_get_quantile_double("s", shares).alias("q")).collect():
            cuts[many[r["position"]]] = np.unique(r["q"])
    return cuts


def to_bins(table: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    out = np.empty((len(table), len(cuts)), np.uint8)
    for f, own in enumerate(cuts):
        out[:, f] = np.where(np.isnan(table[:, f]), MISSING, np.searchsorted(own, table[:, f], "left"))
    return out


class LeafwiseTrees(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Gradient boosting for squared error. Missing features are allowed; rows without a label are left out.

    With ``validation`` that share of the rows, chosen by their content, only decides when to stop: after ``patience`` rounds without a gain of more than ``tol``.
    """

    maxIter = Param(Params._dummy(), "maxIter", "most rounds", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "share of a tree that is added", TypeConverters.toFloat)
    maxLeaves = Param(Params._dummy(), "maxLeaves", "most leaves of a tree", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "most splits above a leaf, 0 for any number", TypeConverters.toInt)
    minRows = Param(Params._dummy(), "minRows", "fewest rows of a leaf", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "most bins of a feature", TypeConverters.toInt)
    penalty = Param(Params._dummy(), "penalty", "penalty on squared leaf values", TypeConverters.toFloat)
    validation = Param(Params._dummy(), "validation", "share of rows that only decide when to stop", TypeConverters.toFloat)
    patience = Param(Params._dummy(), "patience", "rounds without gain before stopping", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "smallest gain that counts", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)

    # The default settings of the surveyed trees.
    SETTINGS = {"maxIter": 100, "learningRate": 0.1, "maxLeaves": 31, "maxDepth": 0, "minRows": 20, "maxBins": 255, "penalty": 0.0, "validation": 0.1, "patience": 10, "tol": 1e-7, "seed": 42, "labelCol": "ret"}

    @keyword_only
    def __init__(
        self, *, inputCols=None, maxIter=None, learningRate=None, maxLeaves=None, maxDepth=None, minRows=None, maxBins=None, penalty=None, validation=None, patience=None, tol=None, seed=None, labelCol=None
    ):
        super().__init__()
        self._setDefault(**self.SETTINGS)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        if not 2 <= self.getOrDefault("maxBins") <= 255:
            raise ValueError("maxBins must be between 2 and 255")

    def _fit(self, df: DataFrame) -> LeafwiseModel:
        names, width = self.getInputCols(), len(self.getInputCols())
        label, share = col(self.getOrDefault("labelCol")).cast("double"), self.getOrDefault("validation")
        rows = df.filter(label.isNotNull()).select(*[col(c).cast("double").alias(f"x{f}") for f, c in enumerate(names)], label.alias("y"))
        draw = F.pmod(F.xxhash64(F.lit(self.getOrDefault("seed")), *rows.columns), F.lit(1_000_000))
        rows = rows.withColumn("held", (draw < int(share * 1_000_000)).cast("double"))
        cuts = find_cuts(rows, width, self.getOrDefault("maxBins"))

        def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                table = matrix_of(batch)
                if len(table):
                    yield _block(to_bins(table[:, :width], cuts), table[:, width], table[:, width + 1] > 0, np.zeros(len(table)))

        binned = stage_table(rows.mapInArrow(bin_rows, BLOCK))
        n, total, low, high = binned.agg(F.sum("n"), F.sum("total"), F.min("low"), F.max("high")).first()
        base = total / n if n else 0.0
        grower = _Grower(self, binned, width, n or 0, base)
        try:
            trees = grower.boost() if n and high > low else []
        finally:
            grower.close()
        flat = [[i, t.feature[k], t.left[k], t.right[k], int(t.missing_left[k]), t.cut[k]] for i, t in enumerate(trees) for k in range(len(t.left))]
        cut_of = [float(cuts[t.feature[k]][t.cut[k]]) if t.left[k] >= 0 and t.cut[k] < len(cuts[t.feature[k]]) else float("inf") for t in trees for k in range(len(t.left))]
        values = [v for t in trees for v in t.value]
        gains = np.zeros(width)
        for t in trees:
            np.add.at(gains, t.feature, np.where(np.array(t.left) >= 0, t.gain, 0.0))
        weights = (gains / gains.sum() if gains.sum() > 0 else gains).tolist()
        return LeafwiseModel(inputCols=names, base=float(base), nodes=[int(x) for row in flat for x in row], cuts=[str(c) for c in cut_of], values=values, weights=weights)


class _Grower:
    """The rows of one fit, and how trees are grown on them."""

    def __init__(self, settings: LeafwiseTrees, rows: DataFrame, width: int, n: int, base: float):
        self.get, self.width, self.n, self.base = settings.getOrDefault, width, n, base
        self._hold(rows)

    def _hold(self, rows: DataFrame) -> None:
        cores = rows.sparkSession.sparkContext.defaultParallelism
        self.tasks = max(1, min(self.n // TASK_ROWS, max(4 * cores, self.n // MOST_TASK_ROWS)))
        self.rows = rows.select("bins", "y", "held", "f").coalesce(self.tasks).persist(StorageLevel.MEMORY_AND_DISK)
        self.name = uuid.uuid4().hex
        self.staged, self.since, self.older = rows, 0, []

    def close(self) -> None:
        for held in [*self.older, self.rows]:
            held.unpersist()
        drop_staged(self.staged)

    def _add(self, tree: Tree) -> None:
        """Adds a finished tree to the predictions: with the next pass over the rows, or into a staged table."""
        width = self.width

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value = np.array(tree.value)
            for bins, y, held, f in _blocks(batches, width):
                yield _block(bins, y, held, f + value[tree.leaves_of(bins)])

        added = self.rows.mapInArrow(apply, BLOCK)
        self.since += 1
        if self.since == KEEP:
            kept = stage_table(added)
            self.close()
            self._hold(kept)
        else:
            self.older.append(self.rows)
            self.rows = added.select("bins", "y", "held", "f").persist(StorageLevel.MEMORY_AND_DISK)
            self.name = uuid.uuid4().hex

    def _pass(self, tree: Tree, nodes: Sequence[int]) -> tuple[dict[int, np.ndarray], tuple[float, float]]:
        """Histograms of some nodes of a tree, and rows and squared error of the held-out rows."""
        width, wanted, name, base = self.width, {k: i for i, k in enumerate(nodes)}, self.name, self.base

        def sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, held = np.zeros((len(wanted), width, 2, BINS)), np.zeros(2)
            place_of = np.full(len(tree.left), -1)
            for k, i in wanted.items():
                place_of[k] = i
            places = _Places(name, TaskContext.get().partitionId(), tree)
            for bins, y, out, f in _blocks(batches, width):
                g = base + f - y
                held += [out.sum(), (g[out] ** 2).sum()]
                place = place_of[places.next(bins)]
                own = np.flatnonzero((place >= 0) & ~out)
                place, g = place[own] * BINS, g[own]
                for j in range(width):
                    cell = place + bins[own, j]
                    sums[:, j, 0] += np.bincount(cell, g, len(wanted) * BINS).reshape(-1, BINS)
                    sums[:, j, 1] += np.bincount(cell, None, len(wanted) * BINS).reshape(-1, BINS)
            places.remember()
            keys = [(i, j) for i in range(len(wanted)) for j in range(width)] + [(-1, 0)]
            values = [*sums.reshape(-1, 2 * BINS), held]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in keys], pa.int32()), pa.array([j for _, j in keys], pa.int32()), pa.array(values, pa.list_(pa.float64()))], names=["node", "f", "v"])

        made = self.rows.mapInArrow(sum_rows, SUMS)
        if self.tasks * len(nodes) * width * BINS * 16 > DIRECT_BYTES:
            made = made.groupBy("node", "f").agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v"))
        table = made.toArrow()
        # This pass has cached the rows with the tree before; those without it have served.
        while self.older:
            self.older.pop().unpersist()
        hist, held = np.zeros((len(nodes), width, 2 * BINS)), np.zeros(2)
        for i, j, v in zip(table.column("node").to_pylist(), table.column("f").to_pylist(), table.column("v")):
            own = v.values.to_numpy()
            if i < 0:
                held += own
            else:
                hist[i, j] += own
        return {k: hist[i].reshape(self.width, 2, BINS) for k, i in wanted.items()}, (float(held[0]), float(held[1]))

    def boost(self) -> list[Tree]:
        done: list[Tree] = []
        losses: list[float] = []
        patience, tol = self.get("patience"), self.get("tol")
        best = (np.inf, 0)
        while True:
            # The pass that starts a round also judges the rounds before it.
            root, (n, error) = self._pass(Tree(), [0])
            if n:
                losses.append(error / n)
                best = min(best, (losses[-1], len(done)))
                if len(losses) > patience and min(losses[-patience:]) > losses[-patience - 1] - tol:
                    return done[: best[1]]
            if len(done) == self.get("maxIter"):
                return done[: best[1]] if n else done
            tree = self._grow(root[0])
            if tree is None:
                return done[: best[1]] if n else done
            done.append(tree)
            self._add(tree)

    def _grow(self, root: np.ndarray) -> Tree | None:
        least, penalty, rate, depth = self.get("minRows"), self.get("penalty"), self.get("learningRate"), self.get("maxDepth")
        hist, level = {0: root}, {0: 0}
        tree, split = Tree(), {0: best_split(root, least, penalty)}
        at_once = max(1, PASS_BYTES // (self.width * BINS * 16))
        while True:
            chosen, unknown = self._choose(tree, split)
            if not unknown:
                break
            sums, smaller = {}, {}
            for k in unknown[:at_once]:
                s = split[k]
                tree.feature[k], tree.cut[k], tree.missing_left[k], tree.gain[k] = s.feature, s.cut, s.missing_left, s.gain
                tree.left[k], tree.right[k] = tree.add(), tree.add()
                total = hist[k][0, 1].sum()
                smaller[k] = tree.left[k] if 2 * s.n <= total else tree.right[k]
            sums, _ = self._pass(tree, list(smaller.values()))
            for k, small in smaller.items():
                large = tree.left[k] + tree.right[k] - small
                hist[small], hist[large] = sums[small], hist[k] - sums[small]
                for child in (tree.left[k], tree.right[k]):
                    level[child] = level[k] + 1
                    split[child] = None if depth and level[child] >= depth else best_split(hist[child], least, penalty)
        if not chosen:
            return None
        return self._finished(tree, set(chosen), hist, rate, penalty)

    def _choose(self, tree: Tree, split: dict[int, Split | None]) -> tuple[list[int], list[int]]:
        """The nodes that best-first growth splits as far as it is known, and those among them whose children are not known yet."""
        open_, chosen, unknown = [0], [], []
        while len(chosen) + 1 < self.get("maxLeaves"):
            able = [k for k in open_ if split[k] is not None]
            if not able:
                break
            top = max(split[k].gain for k in able)
            k = next(k for k in able if split[k].gain >= top - EQUAL * top)
            open_.remove(k)
            chosen.append(k)
            if tree.left[k] < 0:
                unknown.append(k)
            else:
                open_ += [tree.left[k], tree.right[k]]
        return chosen, unknown

    def _finished(self, tree: Tree, inner: set[int], hist: dict[int, np.ndarray], rate: float, penalty: float) -> Tree:
        """The tree without the splits that were not chosen, and with its leaves' values."""
        out, todo = Tree(), [(0, 0)]
        while todo:
            old, new = todo.pop()
            if old in inner:
                out.feature[new], out.cut[new], out.missing_left[new], out.gain[new] = tree.feature[old], tree.cut[old], tree.missing_left[old], tree.gain[old]
                out.left[new], out.right[new] = out.add(), out.add()
                todo += [(tree.left[old], out.left[new]), (tree.right[old], out.right[new])]
            else:
                g, n = hist[old][0].sum(axis=1)
                out.value[new] = float(-rate * g / (n + penalty))
        return out


class LeafwiseModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """``nodes`` holds six numbers per node: tree, feature, left and right child in the tree (-1 in leaves), whether missing goes left, bin."""

    base = Param(Params._dummy(), "base", "prediction before the first tree", TypeConverters.toFloat)
    nodes = Param(Params._dummy(), "nodes", "all nodes of all trees", TypeConverters.toListInt)
    cuts = Param(Params._dummy(), "cuts", "largest value that goes left, per node", TypeConverters.toListString)
    values = Param(Params._dummy(), "values", "value per node", TypeConverters.toListFloat)
    weights = Param(Params._dummy(), "weights", "share of the total gain per feature", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, base=0.0, nodes=None, cuts=None, values=None, weights=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.getOrDefault("weights"))

    @property
    def getNumTrees(self) -> int:
        nodes = self.getOrDefault("nodes")
        return nodes[-6] + 1 if nodes else 0

    def leaves(self) -> list[int]:
        """Leaves per tree."""
        nodes = np.array(self.getOrDefault("nodes"), int).reshape(-1, 6)
        return [int(((nodes[:, 0] == t) & (nodes[:, 2] < 0)).sum()) for t in range(self.getNumTrees)]

    def _transform(self, df: DataFrame) -> DataFrame:
        nodes, base = np.array(self.getOrDefault("nodes"), int).reshape(-1, 6), self.getOrDefault("base")
        if not len(nodes):
            return df.withColumn("prediction", F.lit(base))
        cut, value = np.array([float(c) for c in self.getOrDefault("cuts")]), np.array(self.getOrDefault("values"))
        first = np.searchsorted(nodes[:, 0], np.arange(self.getNumTrees))
        left, right = (np.where(nodes[:, c] >= 0, nodes[:, c] + first[nodes[:, 0]], -1) for c in (2, 3))
        feature, missing = nodes[:, 1], nodes[:, 4] == 1

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            total = np.full(len(x), base)
            for root in first:
                at = np.full(len(x), root)
                moving = np.arange(len(x)) if left[root] >= 0 else np.zeros(0, np.int64)
                while len(moving):
                    node = at[moving]
                    own = x[moving, feature[node]]
                    goes_left = np.where(np.isnan(own), missing[node], own <= cut[node])
                    at[moving] = np.where(goes_left, left[node], right[node])
                    moving = moving[left[at[moving]] >= 0]
                total += value[at]
            return pd.Series(total)

        return df.withColumn("prediction", score(*[col(c).cast("double") for c in self.getInputCols()]))
