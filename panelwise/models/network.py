"""A small feed-forward regressor, trained data-parallel in one of two ways.

Spark ML has no network for regression. The prepared rows are staged once.

``mode="averaged"`` deals them into shards of ``shardRows`` rows by a hash of their content. Each epoch is one Spark job: every shard starts from the shared weights and
moments, takes minibatch Adam steps over its own rows, in a fixed order, and hands both back; the row-weighted mean starts
the next epoch (iterative parameter mixing). Shards depend on the data only, so the result does not depend on the cluster.
With a single shard this is plain minibatch Adam. The rows of a shard are cached as blocks of bytes, one per batch that came, so that an epoch does not turn columns into rows again.

``mode="synchronous"`` is plain minibatch Adam over all tasks: a row's content says which batch of an epoch it belongs to, each task
sums the gradient over its rows of the batch, the sums are exchanged, and every task takes the same step. An epoch is one barrier
stage, through which rows stream in the order of their batches, sorted by Spark; a lost executor costs the epoch, not the fit. Every
step sends the weights' size from every task to every other and takes about a second (Spark's barrier looks once a second whether all have come), so
this is for dozens of tasks and large batches; the averaged way exchanges once an epoch.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext, StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.models.gram import matrix_of
from panelwise.runtime import col, drop_staged, stage_table

CHUNK = 4096
# Adam's decay rates and the smallest gain that counts as progress.
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8
MIN_GAIN = 1e-4


def layer_slices(sizes: Sequence[int]) -> list[tuple[slice, slice, int, int]]:
    """Where each layer's weights and offsets lie in one flat vector."""
    out, at = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        out.append((slice(at, at + a * b), slice(at + a * b, at + a * b + b), a, b))
        at += a * b + b
    return out


def start_weights(sizes: Sequence[int], seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        bound = np.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    return np.concatenate(parts)


def forward(flat: np.ndarray, sizes: Sequence[int], x: np.ndarray) -> list[np.ndarray]:
    """Activations of every layer, input first; all but the last layer are rectified."""
    layers = layer_slices(sizes)
    acts = [x]
    for i, (w, b, rows, cols) in enumerate(layers):
        z = acts[-1] @ flat[w].reshape(rows, cols)
        z += flat[b]
        acts.append(z if i == len(layers) - 1 else np.maximum(z, 0.0, out=z))
    return acts


def gradient(flat: np.ndarray, sizes: Sequence[int], x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Gradient of half the mean squared error plus the weight penalty of one minibatch."""
    acts, grad = forward(flat, sizes, x), np.zeros_like(flat)
    delta = (acts[-1] - y[:, None]) / len(y)
    layers = layer_slices(sizes)
    for i in range(len(layers) - 1, -1, -1):
        w, b, rows, cols = layers[i]
        weights = flat[w].reshape(rows, cols)
        grad[w] = (acts[i].T @ delta + penalty * weights / len(y)).ravel()
        grad[b] = delta.sum(axis=0)
        if i:
            delta = delta @ weights.T
            delta *= acts[i] > 0
    return grad


def as_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each batch as the bytes of one matrix."""
    for batch in batches:
        if len(batch):
            yield pa.RecordBatch.from_arrays([pa.array([matrix_of(batch).tobytes()], pa.binary())], names=["rows"])


def batch_of(place: Column, seed: int, batches: int) -> Column:
    """The batch of a row in one epoch, by a hash of its content: batches of about the same size, others in every epoch."""
    return F.pmod(F.xxhash64(place, F.lit(seed)), F.lit(batches))


class NetworkRegressor(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    hidden = Param(Params._dummy(), "hidden", "hidden layer sizes", TypeConverters.toListInt)
    alpha = Param(Params._dummy(), "alpha", "weight penalty", TypeConverters.toFloat)
    batchSize = Param(Params._dummy(), "batchSize", "rows per step", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "step size", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "most epochs", TypeConverters.toInt)
    patience = Param(Params._dummy(), "patience", "epochs without progress before stopping", TypeConverters.toInt)
    validation = Param(Params._dummy(), "validation", "share of rows that only decide when to stop", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    shardRows = Param(Params._dummy(), "shardRows", "rows of one shard, about", TypeConverters.toInt)
    mode = Param(Params._dummy(), "mode", "'averaged' or 'synchronous'", TypeConverters.toString)
    tasks = Param(Params._dummy(), "tasks", "tasks of the synchronous way, which must all run at a time", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols=None,
        hidden=(256, 128, 64),
        alpha=0.001,
        batchSize=1000,
        learningRate=0.01,
        maxIter=100,
        patience=5,
        validation=0.1,
        seed=42,
        labelCol="ret",
        shardRows=100_000,
        mode="averaged",
        tasks=4,
    ):
        super().__init__()
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._setDefault(
            hidden=[256, 128, 64], alpha=0.001, batchSize=1000, learningRate=0.01, maxIter=100, patience=5, validation=0.1, seed=42, labelCol="ret", shardRows=100_000, mode="averaged", tasks=4
        )
        self._set(**given)
        if self.getOrDefault("mode") not in ("averaged", "synchronous"):
            raise ValueError("mode must be 'averaged' or 'synchronous'")

    def _fit(self, df: DataFrame) -> NetworkModel:
        names, hidden = self.getInputCols(), self.getOrDefault("hidden")
        sizes = [len(names), *hidden, 1]
        rows = df.select(*[col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(names)], col(self.getOrDefault("labelCol")).cast("double").alias("_y"))
        # A row's own content decides whether it validates and where it goes, so a lost task is redone alike.
        content = F.xxhash64(F.lit(self.getOrDefault("seed")), *rows.columns)
        draw = F.pmod(content, F.lit(1_000_000)) / F.lit(1_000_000.0)
        rows = stage_table(rows.withColumn("_held", (draw < self.getOrDefault("validation")).cast("double")).withColumn("_place", F.xxhash64(F.lit(1), content)))
        n, values = rows.count(), [c for c in rows.columns if c != "_place"]
        together = self.getOrDefault("mode") == "synchronous"
        shards = self.getOrDefault("tasks") if together else max(1, -(-n // self.getOrDefault("shardRows")))
        dealt = rows.repartition(shards, F.pmod("_place", F.lit(shards)))
        self._batches = max(1, -(-n // self.getOrDefault("batchSize")))
        if not together:
            dealt = dealt.sortWithinPartitions("_place", *values).select(*values).mapInArrow(as_blocks, "rows binary")
        dealt = dealt.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            best_flat = self._train(dealt, sizes)
        finally:
            dealt.unpersist()
            drop_staged(rows)
        return NetworkModel(inputCols=names, hidden=hidden, weights=best_flat.tolist())

    def _train(self, rows: DataFrame, sizes: list[int]) -> np.ndarray:
        """The weights that explain the held-out rows best."""
        flat = start_weights(sizes, self.getOrDefault("seed"))
        state, best, best_flat, idle = np.stack([flat, np.zeros_like(flat), np.zeros_like(flat)]), -np.inf, None, 0
        step, epochs = 0, self.getOrDefault("maxIter")
        # One pass judges the weights an epoch starts from and takes the next epoch's steps.
        for epoch in range(epochs + 1):
            one = self._epoch if self.getOrDefault("mode") == "averaged" else self._epoch_together
            after, score, steps = one(rows, sizes, state, step, epoch, epoch < epochs)
            if epoch:
                if score is None:
                    best_flat = state[0]
                else:
                    idle = 0 if score > best + MIN_GAIN else idle + 1
                    if score > best:
                        best, best_flat = score, state[0]
                    if idle > self.getOrDefault("patience"):
                        break
            state, step = after, step + steps
        return best_flat

    def _epoch(self, rows: DataFrame, sizes: list[int], state: np.ndarray, done: int, epoch: int, train: bool) -> tuple[np.ndarray, float | None, int]:
        """Weights and moments averaged after one epoch, the share of variance that the weights before explain on the held-out rows, and the steps taken."""
        size, rate, penalty = self.getOrDefault("batchSize"), self.getOrDefault("learningRate"), self.getOrDefault("alpha")
        seed = self.getOrDefault("seed") + epoch

        def run_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rng, held = np.random.default_rng(seed), np.zeros(4)
            flat, (w, first, second), step, seen = state[0], state.copy(), done, 0
            for block in (x for batch in batches for x in batch.column(0)):
                table = np.frombuffer(block.as_buffer()).reshape(-1, sizes[0] + 2)
                out, table = table[table[:, -1] > 0, :-1], table[table[:, -1] == 0, :-1]
                if len(out):
                    y = out[:, -1]
                    e = y - forward(flat, sizes, out[:, :-1])[-1][:, 0]
                    held += [len(y), y.sum(), (y * y).sum(), (e * e).sum()]
                if not train:
                    continue
                table = rng.permutation(table)
                seen += len(table)
                for at in range(0, len(table), size):
                    part = table[at : at + size]
                    g = gradient(w, sizes, part[:, :-1], part[:, -1], penalty)
                    step += 1
                    first = BETA1 * first + (1 - BETA1) * g
                    second = BETA2 * second + (1 - BETA2) * g * g
                    w -= rate * (first / (1 - BETA1**step)) / (np.sqrt(second / (1 - BETA2**step)) + EPSILON)
            mixed = np.concatenate([w, first, second]) * seen
            parts = [(-1, 0.0, 0, held)] + [(s, float(seen), step - done, mixed[s : s + CHUNK]) for s in range(0, len(mixed), CHUNK) if seen]
            chunk, count, steps, v = zip(*parts)
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(chunk, pa.int32()), "seen": pa.array(count), "steps": pa.array(steps, pa.int64()), "v": pa.array(list(v), pa.list_(pa.float64()))})

        parts = rows.mapInArrow(run_task, "chunk int, seen double, steps long, v array<double>")
        added = parts.groupBy("chunk").agg(F.sum("seen").alias("seen"), F.max("steps").alias("steps"), Summarizer.sum(array_to_vector("v")).alias("v"))
        after, score, steps = state.reshape(-1).copy(), None, 0
        for r in added.select("chunk", "seen", "steps", vector_to_array("v").alias("v")).collect():
            if r["chunk"] >= 0:
                after[r["chunk"] : r["chunk"] + len(r["v"])] = np.array(r["v"]) / r["seen"]
                steps = max(steps, r["steps"])
            elif r["v"][0]:
                n, y, yy, ee = r["v"]
                spread = yy - y * y / n
                score = 1.0 - ee / spread if spread > 0 else 0.0
        return after.reshape(state.shape), score, steps


    def _epoch_together(self, rows: DataFrame, sizes: list[int], state: np.ndarray, done: int, epoch: int, train: bool) -> tuple[np.ndarray, float | None, int]:
        """The same as :meth:`_epoch`, with one step per batch that all tasks take together."""
        rate, penalty, tasks, batches = self.getOrDefault("learningRate"), self.getOrDefault("alpha"), self.getOrDefault("tasks"), self._batches
        # Held-out rows come first, as batch -1.
        batch = F.when(F.col("_held") > 0, F.lit(-1)).otherwise(batch_of(F.col("_place"), self.getOrDefault("seed") + epoch, batches))
        values = [c for c in rows.columns if c not in ("_place", "_held")]
        ordered = rows.select(batch.cast("double").alias("_batch"), "_place", *values).sortWithinPartitions("_batch", "_place", *values).drop("_place")
        weights = np.concatenate([np.r_[np.ones(w.stop - w.start), np.zeros(b.stop - b.start)] for w, b, _, _ in layer_slices(sizes)])

        def run_task(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            context = BarrierTaskContext.get()
            w, first, second = state.copy()
            held, sums, step = np.zeros(4), np.zeros(1 + len(w)), done

            def together(own: np.ndarray) -> np.ndarray:
                """The sum over all tasks, added up in the same order everywhere."""
                if tasks == 1:
                    return own
                return sum(np.frombuffer(base64.b64decode(m)) for m in context.allGather(base64.b64encode(own.tobytes()).decode()))

            def take_step() -> None:
                nonlocal w, first, second, sums, step
                total = together(sums)
                sums = np.zeros_like(sums)
                if total[0]:
                    g = total[1:] / total[0] + penalty * weights * w / total[0]
                    step += 1
                    first = BETA1 * first + (1 - BETA1) * g
                    second = BETA2 * second + (1 - BETA2) * g * g
                    w = w - rate * (first / (1 - BETA1**step)) / (np.sqrt(second / (1 - BETA2**step)) + EPSILON)

            now = 0
            for one in batches_in:
                table = matrix_of(one)
                for b in np.unique(table[:, 0]).astype(int):
                    part = table[table[:, 0] == b, 1:]
                    x, y = part[:, :-1], part[:, -1]
                    if b < 0:
                        e = y - forward(state[0], sizes, x)[-1][:, 0]
                        held += [len(y), y.sum(), (y * y).sum(), (e * e).sum()]
                    elif train:
                        while now < b:
                            take_step()
                            now += 1
                        sums += np.r_[len(y), gradient(w, sizes, x, y, 0.0) * len(y)]
            while train and now < batches:
                take_step()
                now += 1
            held = together(held)
            if context.partitionId() == 0:
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([w, first, second]).tobytes()], pa.binary()), pa.array([held.tolist()], pa.list_(pa.float64())), pa.array([step - done], pa.int64())], names=["state", "held", "steps"])

        r = ordered.mapInArrow(run_task, "state binary, held array<double>, steps long", barrier=True).collect()[0]
        n, y, yy, ee = r["held"]
        spread = yy - y * y / n if n else 0.0
        score = None if not n else 1.0 - ee / spread if spread > 0 else 0.0
        return np.frombuffer(r["state"]).reshape(state.shape).copy(), score, r["steps"]


class NetworkModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    hidden = Param(Params._dummy(), "hidden", "hidden layer sizes", TypeConverters.toListInt)
    weights = Param(Params._dummy(), "weights", "all weights in one vector", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, hidden=None, weights=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.getInputCols()
        sizes, flat = [len(names), *self.getOrDefault("hidden"), 1], np.array(self.getOrDefault("weights"))

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            return pd.Series(forward(flat, sizes, x)[-1][:, 0])

        return df.withColumn("prediction", score(*[col(c).cast("double") for c in names]))
