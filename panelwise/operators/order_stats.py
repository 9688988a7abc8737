"""Exact order statistics per group, without ever sorting a whole group in one task.

Ranking a month's predictions or taking a column's quantile by a window would put one group on one
executor. Here a first pass takes a mergeable sketch per group; it only says *where to look*. A
second pass keeps the values inside the narrow brackets around the wanted ranks and merely counts
all others; equal values are merged into one row. What is kept of a bracket is cut again, by counted
parts, until no part with a wanted rank has more than ``SEGMENT_ROWS`` distinct values; only these are
sorted. The result is exact: whether a bracket holds the wanted rank is checked by the counts, and
the groups of brackets that missed are cut from their whole range instead.

Groups are compared null-safe, so rows with a NULL in a grouping column form a group of their own, and values
keep their type.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from panelwise.runtime import col, lookup_join, pocket, stage_table

# Up to this many rows in total and per group, all distinct values are sorted directly: one shuffle, no sketch.
DIRECT_ROWS = 20_000_000
GROUP_ROWS = 2_000_000
GRID = 500
ACCURACY = 2_500
# Distinct values that one task sorts at most, and the parts that a larger bracket is cut into.
SEGMENT_ROWS = 1_000_000
PARTS = 64
# Rows from which the place of a rank may be guessed before it is found exactly.
GUIDE_ROWS = 1_000_000

Ranks = Callable[[Column, Column], Sequence[Column]]
GROUP = "_g"


def _grouped(df: DataFrame, by: Sequence[str], *rest: Column) -> DataFrame:
    """The grouping columns as one struct: structs with NULLs inside are equal, so joins on it are null-safe."""
    return df.select(F.struct(*[col(c).alias(c) for c in by]).alias(GROUP), *rest)


def group_sizes(values: DataFrame, by: Sequence[str], value: str) -> tuple[DataFrame, bool]:
    """Rows ``n`` and non-missing values ``m`` per group."""
    return pocket(values.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("m")))


def order_statistics(
    values: DataFrame,
    by: Sequence[str],
    value: str,
    ranks: Ranks,
    direct_rows: int | None = None,
    grid: int = GRID,
    sizes: tuple[DataFrame, bool] | None = None,
    guide: DataFrame | None = None,
    segment_rows: int | None = None,
) -> DataFrame:
    """The values at the wanted ranks of every group.

    ``ranks(n, m)`` returns rank columns (1-based, ascending order of rank) from the number of rows
    ``n`` and of non-missing values ``m``; pass ``sizes`` if these are known already. ``guide`` may be
    a sample of ``values`` to take the sketch from; it affects the time taken, never the result. The
    result has the columns ``by``, ``n``, ``m``, ``ranks`` (array) and ``stats`` (array of the values' type; NULL where a
    rank lies outside 1..m) and is already computed.
    """
    by = list(by)
    narrow = _grouped(values, by, col(value).alias("_v"))
    cells, small = group_sizes(values, by, value) if sizes is None else sizes
    wanted = [r.cast("long") for r in ranks(F.col("n"), F.col("m"))]
    slots = range(len(wanted))
    cells = _grouped(cells, by, "n", "m", F.array(*wanted).alias("ranks"))
    total, largest = cells.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if largest <= GROUP_ROWS and total <= (DIRECT_ROWS if direct_rows is None else direct_rows):
        return pocket(_pick_directly(narrow, cells, small, slots))[0].select(f"{GROUP}.*", "n", "m", "ranks", "stats")
    limit = SEGMENT_ROWS if segment_rows is None else segment_rows
    points = [i / grid for i in range(grid + 1)]
    seen = narrow if guide is None else _grouped(guide, by, col(value).alias("_v"))
    sketch = seen.groupBy(GROUP).agg(F.percentile_approx("_v", points, ACCURACY).alias("_grid"))
    bracketed, small = pocket(_with_brackets(cells.join(sketch, GROUP, "left"), grid))
    found = pocket(_pick_in_brackets(narrow, bracketed, small, slots, limit))[0]
    missed = F.exists("_hit", lambda h: ~h)
    done = found
    if found.filter(missed).limit(1).count():
        # The few groups whose brackets missed are cut from their whole range.
        groups, few = pocket(found.filter(missed).select(GROUP))
        rest = lookup_join(narrow, groups, [GROUP], "left_semi", pocketed=few)
        left, few = pocket(cells.join(groups, GROUP, "left_semi"))
        again = _pick_in_parts(rest, left, few, slots, limit)
        done = found.filter(~missed).unionByName(again)
    return pocket(done.drop("_hit"))[0].select(f"{GROUP}.*", "n", "m", "ranks", "stats")


def _with_brackets(cells: DataFrame, grid: int) -> DataFrame:
    """Per wanted rank the sketch values two steps below and above it; NULL means no bound."""

    def at(step: Column) -> Column:
        return F.get("_grid", F.greatest(F.lit(0), F.least(F.lit(grid), step)).cast("int"))

    def position(r: Column) -> Column:
        return F.try_divide(r * F.lit(float(grid)), F.col("m"))

    return (
        cells.withColumn("_lo", F.transform("ranks", lambda r: at(F.floor(position(r)) - 2)))
        .withColumn("_hi", F.transform("ranks", lambda r: at(F.ceil(position(r)) + 2)))
        .drop("_grid")
    )


def _first_reaching(counts: DataFrame, within: list[str], cells: DataFrame, small: bool, before: DataFrame | None, slots: range, place: Column) -> DataFrame:
    """Per group the place of the first row that each rank reaches; ``within`` is sorted by value in one task."""
    w = Window.partitionBy(*within).orderBy(F.col("_w").asc_nulls_first())
    running = counts.withColumn("_upto", F.sum("_c").over(w))
    if before is not None:
        running = lookup_join(running, before, within, "inner").withColumn("_upto", F.col("_upto") + F.col("_before"))
    running = lookup_join(running, cells.select(GROUP, "ranks"), [GROUP], "inner", pocketed=small)
    picks = []
    for i in slots:
        rank = F.get("ranks", F.lit(i))
        picks.append(F.min(F.when((rank >= 1) & (F.col("_upto") >= rank), place)).alias(f"_p{i}"))
    return running.groupBy(GROUP).agg(*picks)


def _complete(cells: DataFrame, stats: DataFrame) -> DataFrame:
    kind = stats.schema["stats"].dataType.elementType
    missing = F.transform("ranks", lambda r: F.lit(None).cast(kind))
    joined = cells.select(GROUP, "n", "m", "ranks").join(stats, GROUP, "left")
    return joined.withColumn("stats", F.coalesce("stats", missing))


def _pick_directly(narrow: DataFrame, cells: DataFrame, small: bool, slots: range) -> DataFrame:
    counts = narrow.filter(F.col("_v").isNotNull()).groupBy(GROUP, F.col("_v").alias("_w")).agg(F.count(F.lit(1)).alias("_c"))
    found = _first_reaching(counts, [GROUP], cells, small, None, slots, F.col("_w"))
    return _complete(cells, found.select(GROUP, F.array(*[f"_p{i}" for i in slots]).alias("stats")))


def _pick_in_brackets(narrow: DataFrame, cells: DataFrame, small: bool, slots: range, limit: int) -> DataFrame:
    present = narrow.filter(F.col("_v").isNotNull())
    present = lookup_join(present, cells.select(GROUP, "_lo", "_hi"), [GROUP], "inner", pocketed=small)
    inside, seg = F.lit(False), F.lit(0).cast("long")
    for i in slots:
        low, high = F.get("_lo", F.lit(i)), F.get("_hi", F.lit(i))
        above = F.coalesce(F.col("_v") > high, F.lit(False))
        inside = inside | ~(F.coalesce(F.col("_v") < low, F.lit(False)) | above)
        seg = seg + above.cast("long")
    # Values outside every bracket share one NULL row per segment, below the segment's kept values.
    kept = present.select(GROUP, seg.alias("_seg"), F.when(inside, F.col("_v")).alias("_w"))
    counts = stage_table(kept.groupBy(GROUP, "_seg", "_w").agg(F.count(F.lit(1)).alias("_c")))
    return pick_in_segments(counts, cells, small, slots, limit)


def _pick_in_parts(narrow: DataFrame, cells: DataFrame, small: bool, slots: range, limit: int) -> DataFrame:
    """Without brackets: all values are one segment, to be cut until it is small."""
    present = narrow.filter(F.col("_v").isNotNull()).select(GROUP, F.lit(0).cast("long").alias("_seg"), F.col("_v").alias("_w"))
    return pick_in_segments(stage_table(present.groupBy(GROUP, "_seg", "_w").agg(F.count(F.lit(1)).alias("_c"))), cells, small, slots, limit)


def _offsets(sizes: DataFrame, *order: str) -> DataFrame:
    """Rows of the group that stand before each segment; a group has few segments."""
    before = Window.partitionBy(GROUP).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))


def pick_in_segments(counts: DataFrame, cells: DataFrame, small: bool, slots: range, limit: int) -> DataFrame:
    """From distinct values with their counts, by segment; a NULL value stands for values below those that were kept."""
    last = None
    while True:
        sizes, few = pocket(counts.groupBy(GROUP, "_seg").agg(F.sum("_c").alias("_size"), F.count("_w").alias("_distinct")))
        now = tuple(sizes.agg(F.coalesce(F.max("_distinct"), F.lit(0)), F.sum("_distinct")).first())
        if now[0] <= limit:
            break
        if now == last:
            raise ValueError(f"{now[0]} distinct values could not be parted further")
        counts, last = _cut(counts, cells, small), now
    before = pocket(_offsets(sizes, "_seg").select(GROUP, "_seg", "_before"))[0]
    place = F.struct("_seg", F.col("_w").isNotNull().alias("_kept"), "_w")
    found = _first_reaching(counts, [GROUP, "_seg"], cells, small, before, slots, place).select(
        GROUP,
        F.array(*[F.col(f"_p{i}._w") for i in slots]).alias("stats"),
        F.array(*[F.coalesce(F.col(f"_p{i}._kept"), F.lit(True)) for i in slots]).alias("_hit"),
    )
    hits = F.transform("ranks", lambda r: F.lit(True))
    return _complete(cells, found).withColumn("_hit", F.coalesce("_hit", hits))


def _cut(counts: DataFrame, cells: DataFrame, small: bool) -> DataFrame:
    """Every segment in ``PARTS`` parts by the quantiles of its distinct values; parts without a wanted rank become one row each.

    Sketches work on doubles. Whole numbers and decimals are measured from the segment's smallest value, so what a
    double cannot tell apart now it can once the segment is narrower.
    """
    low = pocket(counts.groupBy(GROUP, "_seg").agg(F.min("_w").alias("_low")))[0]
    marked = lookup_join(counts, low, [GROUP, "_seg"], "left")
    exact = isinstance(counts.schema["_w"].dataType, (T.IntegralType, T.DecimalType))
    wide = lambda c: F.col(c).cast("decimal(38,0)") if isinstance(counts.schema["_w"].dataType, T.IntegralType) else F.col(c)
    marked = marked.withColumn("_at", (wide("_w") - wide("_low") if exact else F.col("_w")).cast("double")).drop("_low")
    points = [i / PARTS for i in range(1, PARTS)]
    grid = marked.filter(F.col("_w").isNotNull()).groupBy(GROUP, "_seg").agg(F.percentile_approx("_at", points, 20 * PARTS).alias("_grid"))
    marked = lookup_join(marked, pocket(grid)[0], [GROUP, "_seg"], "left")
    part = F.when(F.col("_w").isNull(), 0).otherwise(1 + F.size(F.filter("_grid", lambda x: x < F.col("_at"))))
    marked = marked.withColumn("_part", part.cast("long")).drop("_grid", "_at")
    sizes = marked.groupBy(GROUP, "_seg", "_part").agg(F.sum("_c").alias("_size"))
    ranked = lookup_join(_offsets(sizes, "_seg", "_part"), cells.select(GROUP, "ranks"), [GROUP], "inner", pocketed=small)
    wanted = F.exists("ranks", lambda r: (r > F.col("_before")) & (r <= F.col("_before") + F.col("_size")))
    keep = pocket(ranked.select(GROUP, "_seg", "_part", wanted.alias("_wanted")))[0]
    kept = lookup_join(marked, keep, [GROUP, "_seg", "_part"], "inner")
    narrowed = kept.select(GROUP, (F.col("_seg") * (PARTS + 1) + F.col("_part")).alias("_seg"), F.when(F.col("_wanted"), F.col("_w")).alias("_w"), "_c")
    return stage_table(narrowed.groupBy(GROUP, "_seg", "_w").agg(F.sum("_c").alias("_c")))


def exact_quantiles(
    values: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Sequence[float],
    direct_rows: int | None = None,
    grid: int = GRID,
    sizes: tuple[DataFrame, bool] | None = None,
    guide: DataFrame | None = None,
    segment_rows: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per group: ``by``, ``n``, ``m``, ``quantiles`` (array in the order of ``probs``)."""
    ordered = sorted(range(len(probs)), key=lambda i: probs[i])

    def ranks(n: Column, m: Column) -> list[Column]:
        out = []
        for i in ordered:
            below = F.floor((m - 1) * F.lit(float(probs[i])))
            out += [below + 1, F.least(below + 2, m)]
        return out

    found = order_statistics(values, by, value, ranks, direct_rows, grid, sizes, guide, segment_rows)
    quantiles: list[Column | None] = [None] * len(probs)
    for slot, i in enumerate(ordered):
        spot = (F.col("m") - 1) * F.lit(float(probs[i]))
        low, high = (F.get("stats", F.lit(2 * slot + j)).cast("double") for j in (0, 1))
        quantiles[i] = low + (high - low) * (spot - F.floor(spot))
    return found.select(*by, "n", "m", F.array(*quantiles).alias("quantiles"))
