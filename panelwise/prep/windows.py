"""The preprocessing of many training windows, learned together.

Expanding windows overlap: one year of rows belongs to every later window. So nothing is learned window by window. Each
statistic is taken once per *year* in a form that merges, and the years' summaries are merged forward into all windows:

* sums and counts give the means that fill gaps;
* quantile sketches (KLL) say where the bounds of each window lie; one further scan counts, for all columns and years, the values
  between these places and keeps those near a bound, and the counts make the bounds exact;
* value counts give modes and levels.

What is merged has one row per year, column and kept value; rows of the panel are never multiplied by the windows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.operators import order_stats
from panelwise.operators.order_stats import GROUP, exact_quantiles
from panelwise.prep.stages import MAX_LEVELS, ModeImputerModel, OneHotModel, PopScalerModel, WinsorizerModel, fill_from_sums, plain_values, value_counts
from panelwise.runtime import col, drop_staged, stage_table

#: Size of the sketches, and how far off a rank they are for sure (in shares of the values).
SKETCH_K = 4096
SKETCH_ERROR = 0.005
#: Size of the sketches that are the answer themselves.
FINE_K = 32768
#: Up to this many (value, window) pairs all distinct values are counted, without sketches.
DIRECT_PAIRS = 20_000_000

YEAR = "_year"


@dataclass
class Window:
    """The years before a predicted year, from ``first`` on, and what their rows teach."""

    year: int
    first: int | None = None
    #: The training years that have rows.
    years: tuple[int, ...] = ()
    rows: int = 0
    #: Per continuous column: what fills a gap of a period without any value, and the bounds.
    fallback: np.ndarray = field(default_factory=lambda: np.zeros(0))
    lows: np.ndarray = field(default_factory=lambda: np.zeros(0))
    highs: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: Per discrete column its most frequent value, and all levels in order; values as text.
    modes: dict[str, str] = field(default_factory=dict)
    levels: list[tuple[str, str]] = field(default_factory=list)

    def stages(self, continuous: Sequence[str], discrete: Sequence[str], means: Sequence[float], scales: Sequence[float]) -> PipelineModel:
        """The fitted preprocessor of this window, without the filling of gaps."""
        stages = []
        if continuous:
            stages.append(WinsorizerModel(inputCols=list(continuous), lows=self.lows.tolist(), highs=self.highs.tolist()))
            stages.append(PopScalerModel(inputCols=list(continuous), means=list(map(float, means)), scales=list(map(float, scales))))
        if discrete:
            known = [c for c in discrete if c in self.modes]
            stages.append(ModeImputerModel(inputCols=known, modes=[self.modes[c] for c in known]))
            stages.append(OneHotModel(inputCols=[c for c, _ in self.levels], levels=[v for _, v in self.levels]))
        return PipelineModel(stages=stages)


class YearMeans:
    """Sums and counts of every column by year, from the sums by period, and the means of any set of years."""

    def __init__(self, sums: DataFrame | None, n_columns: int, by: str):
        self.n = n_columns
        self.found: dict[int, np.ndarray] = {}
        if sums is None:
            return
        year = F.col("_period") if by == "year" else F.year("_period")
        pairs = [e for i in range(n_columns) for e in (F.sum(f"_s{i}").alias(f"_s{i}"), F.sum(f"_c{i}").alias(f"_c{i}"))]
        for r in sums.groupBy(year.alias(YEAR)).agg(*pairs).collect():
            self.found[r[YEAR]] = np.array([[r[f"_s{i}"] or 0.0, r[f"_c{i}"] or 0] for i in range(n_columns)], float).reshape(n_columns, 2)

    def over(self, years: Sequence[int]) -> np.ndarray:
        """Mean of each column over some years; 0 for a column without any value."""
        total = sum((self.found[y] for y in years if y in self.found), np.zeros((self.n, 2)))
        return np.where(total[:, 1] > 0, total[:, 0] / np.maximum(total[:, 1], 1.0), 0.0)


def filled_by_period(rows: DataFrame, columns: Sequence[str], sums: DataFrame, small: bool, date: str, by: str) -> DataFrame:
    """Gaps filled with the mean of their period; a period without any value keeps its gaps, whose filling depends on the window."""
    return fill_from_sums(rows, columns, sums, small, date, by, fallback=[None] * len(columns))


def fill_rest(rows: DataFrame, columns: Sequence[str], values: np.ndarray) -> DataFrame:
    return rows.withColumns({c: F.coalesce(col(c), F.lit(float(v))) for c, v in zip(columns, values)}) if len(columns) else rows


def learn_windows(
    filled: DataFrame, windows: Sequence[Window], continuous: Sequence[str], discrete: Sequence[str], means: YearMeans, lower: float = 0.0025, upper: float = 0.9975, exact: bool = True, direct_pairs: int | None = None
) -> None:
    """Completes ``windows`` from ``filled(_year, continuous, discrete)``, whose gaps are filled by period."""
    counts = {r[YEAR]: r["n"] for r in filled.groupBy(YEAR).agg(F.count(F.lit(1)).alias("n")).collect()}
    for w in windows:
        w.years = tuple(sorted(y for y in counts if y is not None and y < w.year and (w.first is None or y >= w.first)))
        w.rows = sum(counts[y] for y in w.years)
        w.fallback = means.over(w.years)
        if not w.rows:
            raise ValueError(f"year {w.year} has no training rows")
    rows = filled.filter(F.col(YEAR).isin(sorted({y for w in windows for y in w.years})))
    if continuous:
        bounds = window_quantiles(rows, windows, continuous, [lower, upper], exact, direct_pairs)
        for w, b in zip(windows, bounds):
            w.lows, w.highs = b[:, 0], b[:, 1]
    if discrete:
        _learn_levels(rows, windows, discrete)


def _learn_levels(rows: DataFrame, windows: Sequence[Window], discrete: Sequence[str]) -> None:
    years = len({y for w in windows for y in w.years})
    counted = value_counts(rows, discrete, [YEAR]).limit((MAX_LEVELS + 1) * years).collect()
    order = {(r["_column"], r["_value"]): r["_order"] for r in counted}
    if len(order) > MAX_LEVELS:
        raise ValueError(f"more than {MAX_LEVELS} levels in discrete columns {list(discrete)}: use one_hot_vector, which has no such bound")
    for w in windows:
        n: dict[tuple[str, str], int] = {}
        for r in counted:
            if r[YEAR] in w.years:
                key = r["_column"], r["_value"]
                n[key] = n.get(key, 0) + r["_n"]
        w.modes = {c: min((k for k in n if k[0] == c), key=lambda k: (-n[k], order[k]))[1] for c in discrete if any(k[0] == c for k in n)}
        w.levels = [k for c in discrete for k in sorted((k for k in n if k[0] == c), key=order.__getitem__)]


def window_quantiles(
    rows: DataFrame, windows: Sequence[Window], columns: Sequence[str], probs: Sequence[float], exact: bool = True, direct_pairs: int | None = None, segment_rows: int | None = None
) -> np.ndarray:
    """Interpolated quantiles by (window, column, probability): of the window's rows, gaps counting as the window's fallback.

    ``probs`` ascend. Not ``exact``: read off the merged sketches.
    """
    spark, names = rows.sparkSession, list(columns)
    members = F.broadcast(spark.createDataFrame([(i, int(y)) for i, w in enumerate(windows) for y in w.years], f"w int, {YEAR} int"))
    sizes = F.broadcast(spark.createDataFrame([(i, w.rows) for i, w in enumerate(windows)], "w int, n long"))
    values = rows.select(YEAR, F.posexplode(F.array(*[col(c).cast("double") for c in names])).alias("position", "value"))
    pairs = len(names) * sum(w.rows for w in windows)
    if not exact:
        return _from_sketches(_merged_sketches(values, members, sizes, FINE_K), windows, len(names), probs)
    if pairs <= (DIRECT_PAIRS if direct_pairs is None else direct_pairs):
        return _directly(values, windows, len(names), probs)
    places = _places(_merged_sketches(values, members, sizes, SKETCH_K), windows, len(names), probs)
    counts = _near_places(rows, names, places)
    counts = stage_table(counts)
    gaps = {(r["w"], r["position"]): r["c"] for r in counts.filter("gap").join(members, YEAR).groupBy("w", "position").agg(F.sum("c").alias("c")).collect()}
    merged = counts.filter("not gap").join(members, YEAR)
    group = F.struct("w", "position").alias(GROUP)
    ranges = [(i, j, places.ranges[i][j]) for i in range(len(windows)) for j in range(len(names))]
    near = F.broadcast(spark.createDataFrame(ranges, "w int, position int, ranges array<struct<a:int,b:int>>"))
    inside = F.exists("ranges", lambda r: (F.col("cell") >= r["a"]) & (F.col("cell") <= r["b"]))
    merged = merged.join(near, ["w", "position"]).withColumn("value", F.when(inside, F.col("value")))
    merged = merged.groupBy(group, F.col("cell").cast("long").alias("_seg"), F.col("value").alias("_w")).agg(F.sum("c").alias("_c"))
    if gaps:
        copies = []
        for (i, j), c in gaps.items():
            v = float(windows[i].fallback[j])
            cell = int(places.cells(j, np.array([v]))[0])
            kept = any(a <= cell <= b for a, b in places.ranges[i][j])
            copies.append(((i, j), cell, v if kept else None, c))
        merged = merged.unionByName(spark.createDataFrame(copies, f"{GROUP} struct<w:int,position:int>, _seg long, _w double, _c long"))
    ranks = []
    for i, w in enumerate(windows):
        below = [int(np.floor((w.rows - 1) * p)) for p in probs]
        ranks += [((i, j), w.rows, w.rows, [r for b in below for r in (b + 1, min(b + 2, w.rows))]) for j in range(len(names))]
    cells = spark.createDataFrame(ranks, f"{GROUP} struct<w:int,position:int>, n long, m long, ranks array<long>")
    limit = order_stats.SEGMENT_ROWS if segment_rows is None else segment_rows
    merged = stage_table(merged)
    found = order_stats.pick_in_segments(merged, cells, True, range(2 * len(probs)), limit).collect()
    drop_staged(counts, merged)
    out = np.zeros((len(windows), len(names), len(probs)))
    missed = set()
    for r in found:
        i, j = r[GROUP]["w"], r[GROUP]["position"]
        missed |= {i} if not all(r["_hit"]) else set()
        for s, p in enumerate(probs):
            spot = (windows[i].rows - 1) * p
            low, high = (np.nan if x is None else x for x in r["stats"][2 * s : 2 * s + 2])
            out[i, j, s] = low + (high - low) * (spot - np.floor(spot))
    for i in missed:  # a sketch was further off than it should be
        own = fill_rest(rows.filter(F.col(YEAR).isin([int(y) for y in windows[i].years])), names, windows[i].fallback)
        long = own.select(F.posexplode(F.array(*[col(c).cast("double") for c in names])).alias("position", "value"))
        for r in exact_quantiles(long, ["position"], "value", list(probs)).collect():
            out[i, r["position"]] = r["quantiles"]
    return out


def _directly(values: DataFrame, windows: Sequence[Window], columns: int, probs: Sequence[float]) -> np.ndarray:
    """All distinct values of a column in one group: their number is below ``DIRECT_PAIRS``."""

    def run(table: pa.Table) -> pa.Table:
        j = table.column("position")[0].as_py()
        year, value, c = (table.column(x).to_numpy() for x in (YEAR, "value", "c"))
        gap = table.column("value").combine_chunks().is_null().to_numpy(zero_copy_only=False)
        order = np.argsort(value[~gap], kind="stable")
        sorted_year, sorted_value, sorted_c = (x[~gap][order] for x in (year, value, c))
        found = []
        for w in windows:
            own = np.isin(sorted_year, w.years)
            v, n = sorted_value[own], sorted_c[own]
            gaps = int(c[gap & np.isin(year, w.years)].sum())
            if gaps:
                at = np.searchsorted(v, w.fallback[j])
                v, n = np.insert(v, at, w.fallback[j]), np.insert(n, at, gaps)
            upto, q = np.cumsum(n), []
            for p in probs:
                spot = (w.rows - 1) * p
                low, high = (v[np.searchsorted(upto, r)] for r in (int(spot) + 1, min(int(spot) + 2, w.rows)))
                q.append(float(low + (high - low) * (spot - int(spot))))
            found.append(q)
        return pa.table({"position": pa.array([j], pa.int32()), "q": pa.array([found], pa.list_(pa.list_(pa.float64())))})

    counts = values.groupBy("position", YEAR, "value").agg(F.count(F.lit(1)).alias("c"))
    out = np.zeros((len(windows), columns, len(probs)))
    for r in counts.groupBy("position").applyInArrow(run, "position int, q array<array<double>>").collect():
        out[:, r["position"]] = r["q"]
    return out


def _merged_sketches(values: DataFrame, members: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """One sketch per year and column from one scan, merged into (w, position, sketch, m, n): m values in the sketch, n rows of the window."""
    present = values.filter(F.col("value").isNotNull())
    by_year = stage_table(present.groupBy(YEAR, "position").agg(F.kll_sketch_agg_double("value", k).alias("sketch")))
    merged = by_year.join(members, YEAR).groupBy("w", "position").agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))
    return merged.withColumn("m", F.kll_sketch_get_n_double("sketch")).join(sizes, "w")


def _grids(sketches: DataFrame, probs: Sequence[float]) -> tuple[np.ndarray, dict[tuple[int, int], tuple[int, int, np.ndarray]]]:
    """Shares, closer together at the ends and around ``probs``, and per (window, column) the rows, the values and their quantiles at these shares."""
    around = [p + d * SKETCH_ERROR for p in probs for d in (-3, 0, 3)]
    tails = np.geomspace(1e-5, 0.5, 60)
    shares = np.unique(np.clip(np.concatenate([np.linspace(0, 1, 401), tails, 1 - tails, around]), 0.0, 1.0))
    rows = sketches.select("w", "position", "n", "m", F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(x)) for x in shares])).alias("q")).collect()
    return shares, {(r["w"], r["position"]): (r["n"], r["m"], np.array(r["q"])) for r in rows}


class _Places:
    """Per column the sorted ends of all windows' brackets, and per window which cells between them its brackets cover.

    Cells are numbered from below: even ones lie between two ends, odd ones are the ends themselves.
    """

    def __init__(self, brackets: dict[tuple[int, int], list[tuple[float, float]]], windows: int, columns: int):
        unknown = [(-np.inf, np.inf)]
        self.ends = []
        for j in range(columns):
            ends = [e for i in range(windows) for b in brackets.get((i, j), unknown) for e in b]
            self.ends.append(np.unique([e for e in ends if np.isfinite(e)]))
        self.ranges = [[[self._range(j, *b) for b in brackets.get((i, j), unknown)] for j in range(columns)] for i in range(windows)]
        self.kept = []
        for j in range(columns):
            kept = np.zeros(2 * len(self.ends[j]) + 1, bool)
            for i in range(windows):
                for a, b in self.ranges[i][j]:
                    kept[a : b + 1] = True
            self.kept.append(kept)

    def _range(self, j: int, low: float, high: float) -> tuple[int, int]:
        ends = self.ends[j]
        return (2 * int(np.searchsorted(ends, low)) + 1 if np.isfinite(low) else 0), (2 * int(np.searchsorted(ends, high)) + 1 if np.isfinite(high) else 2 * len(ends))

    def cells(self, j: int, values: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends[j], values, "left") + np.searchsorted(self.ends[j], values, "right")


def _places(sketches: DataFrame, windows: Sequence[Window], columns: int, probs: Sequence[float]) -> _Places:
    """Brackets around the wanted ranks. Gaps count as a value that may stand on either side, so they widen a bracket downwards."""
    shares, grids = _grids(sketches, probs)
    brackets = {}
    for key, (n, m, q) in grids.items():
        brackets[key] = []
        for p in probs:
            at = (n - 1) * p
            low = np.searchsorted(shares, (at - (n - m)) / m - 2 * SKETCH_ERROR, "right") - 1
            high = np.searchsorted(shares, (at + 2) / m + 2 * SKETCH_ERROR, "left")
            brackets[key].append((q[low] if low > 0 else -np.inf, q[high] if high < len(shares) - 1 else np.inf))
    return _Places(brackets, len(windows), columns)


def _from_sketches(sketches: DataFrame, windows: Sequence[Window], columns: int, probs: Sequence[float]) -> np.ndarray:
    """Quantiles of the sketched values and as many fallbacks as there are gaps."""
    out = np.repeat(np.stack([w.fallback for w in windows])[:, :, None], len(probs), 2)
    shares, grids = _grids(sketches, probs)
    for (i, j), (n, m, q) in grids.items():
        gaps, below = n - m, m * np.interp(windows[i].fallback[j], q, shares)
        for s, p in enumerate(probs):
            at = (n - 1) * p
            if not gaps or not below <= at < below + gaps:
                out[i, j, s] = np.interp((at if at < below or not gaps else at - gaps) / m, shares, q)
    return out


def _near_places(rows: DataFrame, names: Sequence[str], places: _Places) -> DataFrame:
    """(position, _year, cell, value, gap, c): counts per cell, with the value where it lies near a bound of some window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            years, which = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            parts = []
            for j in range(len(names)):
                v = batch.column(j + 1).to_numpy(zero_copy_only=False).astype(float)
                gap = np.isnan(v)
                cell = places.cells(j, v)
                near = places.kept[j][cell] & ~gap
                n_cells = 2 * len(places.ends[j]) + 1
                far = np.bincount((which * (n_cells + 1) + np.where(gap, n_cells, cell))[~near], minlength=len(years) * (n_cells + 1)).reshape(len(years), -1)
                y, c = np.nonzero(far)
                parts.append((np.full(len(y), j), years[y], c, np.full(len(y), np.nan), c == n_cells, far[y, c]))
                k = int(near.sum())
                parts.append((np.full(k, j), years[which[near]], cell[near], v[near], np.zeros(k, bool), np.ones(k, np.int64)))
            position, year, cell, value, gap, c = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(position.astype(np.int32)), pa.array(year.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(value, from_pandas=True), pa.array(gap), pa.array(c.astype(np.int64))],
                names=["position", YEAR, "cell", "value", "gap", "c"],
            )

    wide = rows.select(F.col(YEAR).cast("int").alias(YEAR), *[col(c).cast("double").alias(f"x{j}") for j, c in enumerate(names)])
    found = wide.mapInArrow(run, f"position int, {YEAR} int, cell int, value double, gap boolean, c long")
    return found.groupBy("position", YEAR, "cell", "value", "gap").agg(F.sum("c").alias("c"))
