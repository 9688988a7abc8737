"""Cross products of many training windows from one scan: each row is read once and added to every window that holds it.

A row enters a window clipped by that window's bounds and with its levels, so the windows' matrices differ and each task keeps one per
window (and fold). Scaling is affine; it is applied to the finished matrices. Before, columns are centred by their unclipped means, so nothing cancels.
The matrices of a task are bounded: where all windows together exceed the bound, they are dealt into several scans.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.models import gram
from panelwise.models.gram import Moments, fold_ends, row_order_key
from panelwise.models.linear import loo_sums, loo_terms, sum_moments
from panelwise.operators.order_stats import GUIDE_ROWS, order_statistics
from panelwise.prep.stages import plain_values
from panelwise.prep.windows import YEAR, Window
from panelwise.runtime import col, fewer_tasks

#: Bytes of all matrices that one task holds.
MAX_TASK_BYTES = 512 * 1024 * 1024
MATRIX = "w int, fold int, i int, v array<double>"


@dataclass
class Design:
    """How the rows of ``filled`` become the design matrix of a window: continuous columns, then all levels known to any window."""

    windows: Sequence[Window]
    continuous: list[str]
    discrete: list[str]
    label: str
    levels: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for c in self.discrete:
            self.levels[c] = list(dict.fromkeys(v for w in self.windows for k, v in w.levels if k == c))

    @property
    def size(self) -> int:
        return 2 + len(self.continuous) + sum(map(len, self.levels.values()))

    def columns(self, filled: DataFrame) -> list[Column]:
        numbers = [col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(self.continuous)]
        texts = [c.alias(f"_d{i}") for i, c in enumerate(plain_values(filled, self.discrete))]
        return [F.col(YEAR).cast("int").alias(YEAR), col(self.label).cast("double").alias("_y"), *numbers, *texts]

    def arrays(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Years, labels, numbers, and a code per discrete column (-1 is missing)."""
        k = len(self.continuous)
        numbers = np.column_stack([np.zeros(batch.num_rows), *[batch.column(2 + i).to_numpy(zero_copy_only=False).astype(float) for i in range(k)]])[:, 1:]
        codes = [pc.fill_null(pc.index_in(batch.column(2 + k + i), pa.array(self.levels[c], pa.string())), -1).to_numpy() for i, c in enumerate(self.discrete)]
        return batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), numbers, codes

    def matrix(self, w: int, rows: np.ndarray, y: np.ndarray, numbers: np.ndarray, codes: Sequence[np.ndarray]) -> np.ndarray:
        """(1, clipped and centred numbers, levels, label) of some rows as window ``w`` sees them."""
        window, k, n = self.windows[w], len(self.continuous), len(rows)
        z = np.zeros((n, self.size))
        z[:, 0], z[:, -1] = 1.0, y[rows]
        if k:
            x = numbers[rows]
            x = np.where(np.isnan(x), window.fallback, x)
            z[:, 1 : 1 + k] = np.clip(x, window.lows, window.highs) - window.fallback
        at = 1 + k
        for c, own in zip(self.discrete, codes):
            code, known = own[rows], self.levels[c]
            if c in window.modes:
                code = np.where(code < 0, known.index(window.modes[c]), code)
            there = np.flatnonzero(code >= 0)
            z[there, at + code[there]] = 1.0
            at += len(known)
        return z

    def scaled(self, w: int, n: float, sums: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Means and scales of the window's numbers, and the matrix that turns a row of ``matrix`` into one of scaled features."""
        k = len(self.continuous)
        shift = sums[1 : 1 + k] / n
        spread = np.sqrt(np.maximum(squares[1 : 1 + k] / n - shift**2, 0.0))
        means = shift + self.windows[w].fallback
        scales = np.where(spread > 1e-12 * np.abs(means), spread, 1.0)
        flat, own = [(c, v) for c in self.discrete for v in self.levels[c]], set(self.windows[w].levels)
        kept = [0, *range(1, 1 + k), *[1 + k + i for i, key in enumerate(flat) if key in own], self.size - 1]
        turn = np.eye(self.size)
        turn[0, 1 : 1 + k] = -shift / scales
        turn[np.arange(1, 1 + k), np.arange(1, 1 + k)] = 1.0 / scales
        return means, scales, turn[:, kept]

    def parts(self, batch: pa.RecordBatch, scan: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(window, its rows of the batch, their matrix) for the windows of a scan."""
        year, y, numbers, codes = self.arrays(batch)
        for w in scan:
            own = np.flatnonzero(np.isin(year, self.windows[w].years))
            if len(own):
                yield w, own, self.matrix(w, own, y, numbers, codes)

    def rows(self, filled: DataFrame, scan: Sequence[int], *more: Column) -> DataFrame:
        years = sorted({int(y) for w in scan for y in self.windows[w].years})
        return filled.filter(F.col(YEAR).isin(years)).select(*self.columns(filled), *more)


@dataclass
class Fit:
    """What one window's linear models are solved from."""

    folds: dict[int, Moments]
    means: np.ndarray
    scales: np.ndarray
    turn: np.ndarray
    #: Leave-one-out errors by the penalties asked for.
    loo: dict[tuple[float, ...], list[float]] = field(default_factory=dict)


def _scans(windows: int, bytes_each: int) -> list[range]:
    """Windows dealt into scans, so that a task's matrices stay below the bound."""
    at_once = max(1, MAX_TASK_BYTES // max(bytes_each, 1))
    return [range(a, min(a + at_once, windows)) for a in range(0, windows, at_once)]


def shared_moments(filled: DataFrame, design: Design, fold: Sequence[Column] | None = None, n_folds: int = 1) -> list[Fit]:
    """The cross products of all windows, scaled, by fold; ``fold`` has one column per window."""
    size = design.size
    if gram.too_wide(size - 2):
        raise ValueError(f"{size - 2} features: their cross products exceed {gram.MAX_MATRIX_BYTES} bytes")
    fits = []
    for scan in _scans(len(design.windows), size * size * 8 * n_folds):
        folds = [] if fold is None else [fold[w].cast("int").alias(f"_f{w}") for w in scan]

        def reduce_task(batches: Iterator[pa.RecordBatch], scan=scan, folded=bool(folds)) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for w, own, z in design.parts(batch, scan):
                    of = batch.column(batch.schema.get_field_index(f"_f{w}")).to_numpy(zero_copy_only=False)[own].astype(int) if folded else np.zeros(len(own), int)
                    for f in np.unique(of):
                        part = z[of == f]
                        sums[w, int(f)] = sums.get((w, int(f)), 0.0) + part.T @ part
            for (w, f), z in sums.items():
                yield _matrix_rows(w, f, z)

        partial = fewer_tasks(design.rows(filled, scan, *folds), size * size * 8 * len(scan) * n_folds).mapInArrow(reduce_task, MATRIX)
        added = partial.groupBy("w", "fold", "i").agg(Summarizer.sum(array_to_vector("v")).alias("v"))
        found: dict[int, dict[int, np.ndarray]] = {w: {} for w in scan}
        for r in added.select("w", "fold", "i", vector_to_array("v").alias("v")).collect():
            found[r["w"]].setdefault(r["fold"], np.zeros((size, size)))[r["i"]] = r["v"]
        for w in scan:
            total = sum(found[w][f] for f in sorted(found[w]))
            means, scales, turn = design.scaled(w, total[0, 0], total[0], np.diag(total))
            fits.append(Fit({f: Moments(turn.T @ z @ turn) for f, z in found[w].items()}, means, scales, turn))
    return fits


def _matrix_rows(w: int, fold: int, z: np.ndarray) -> pa.RecordBatch:
    n = len(z)
    return pa.RecordBatch.from_pydict(
        {"w": pa.array([w] * n, pa.int32()), "fold": pa.array([fold] * n, pa.int32()), "i": pa.array(range(n), pa.int32()), "v": pa.array(list(z), pa.list_(pa.float64()))}
    )


def shared_scales(filled: DataFrame, design: Design) -> list[Fit]:
    """Means and scales alone, for windows without linear models: sums and squares instead of products."""
    everything = range(len(design.windows))

    def reduce_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for w, _, z in design.parts(batch, everything):
                sums[w] = sums.get(w, 0.0) + np.stack([z.sum(axis=0), (z * z).sum(axis=0)])
        for w, z in sums.items():
            yield _matrix_rows(w, 0, z)

    added = design.rows(filled, everything).mapInArrow(reduce_task, MATRIX).groupBy("w", "i").agg(Summarizer.sum(array_to_vector("v")).alias("v"))
    found = np.zeros((len(design.windows), 2, design.size))
    for r in added.select("w", "i", vector_to_array("v").alias("v")).collect():
        found[r["w"], r["i"]] = r["v"]
    return [Fit({}, *design.scaled(w, z[0, 0], z[0], z[1])) for w, z in enumerate(found)]


def shared_leave_one_out(filled: DataFrame, design: Design, fits: Sequence[Fit], alphas: Sequence[Sequence[tuple[float, ...]]]) -> None:
    """Adds to ``fits`` the ridge errors for the penalties that each window asks for: one scan for all."""
    asked = {w: loo_terms(sum_moments(fits[w].folds), list(dict.fromkeys(a for part in own for a in part))) for w, own in enumerate(alphas) if own}
    if not asked:
        return
    turns = {w: fits[w].turn for w in asked}

    def reduce_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {w: np.zeros(len(terms.alphas)) for w, terms in asked.items()}
        for batch in batches:
            for w, _, z in design.parts(batch, list(asked)):
                z = z @ turns[w]
                total[w] += loo_sums(asked[w], z[:, 1:-1], z[:, -1])
        for w, t in total.items():
            yield pa.RecordBatch.from_pydict({"w": pa.array([w] * len(t), pa.int32()), "a": pa.array(range(len(t)), pa.int32()), "sse": pa.array(t)})

    partial = design.rows(filled, list(asked)).mapInArrow(reduce_task, "w int, a int, sse double")
    summed = {(r["w"], r["a"]): r["sse"] for r in partial.groupBy("w", "a").agg(F.sum("sse").alias("sse")).collect()}
    for w, terms in asked.items():
        error = {a: summed.get((w, i), 0.0) / terms.n for i, a in enumerate(terms.alphas)}
        for part in alphas[w]:
            fits[w].loo[part] = [error[a] for a in part]


def window_row_folds(rows: DataFrame, windows: Sequence[Window], k: int, entity: str = "permno", date: str = "date") -> list[Column]:
    """Per window the fold of a row when the window's rows, ordered by (entity, date), are cut into ``k`` contiguous blocks.

    Only the two key columns are read, once for all windows.
    """
    spark, key = rows.sparkSession, row_order_key(entity, date)
    members = F.broadcast(spark.createDataFrame([(i, int(y)) for i, w in enumerate(windows) for y in w.years], f"w int, {YEAR} int"))
    total = sum(w.rows for w in windows)

    def spread(part: DataFrame) -> DataFrame:
        return part.select(YEAR, key.alias("_key")).join(members, YEAR).select("w", "_key")

    sizes = spark.createDataFrame([(i, w.rows, w.rows) for i, w in enumerate(windows)], "w int, n long, m long"), True
    share = GUIDE_ROWS / max(total, 1)
    guide = spread(rows.sample(share, seed=1)) if share < 0.5 else None
    found = {r["w"]: r["stats"] for r in order_statistics(spread(rows), ["w"], "_key", lambda n, m: fold_ends(n, k), sizes=sizes, guide=guide).collect()}
    out = []
    for i in range(len(windows)):
        fold = F.lit(0)
        for last in found[i]:
            if last is not None:
                fold = fold + (key > F.lit(Decimal(last)).cast("decimal(38,0)")).cast("int")
        out.append(fold)
    return out

