"""Preprocessing stages for ``pyspark.ml`` pipelines, fitted on a training window and applied to both parts.

Learned values are stage parameters, so a fitted pipeline is saved and loaded like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise.functions.columns import by_position, clip, to_long
from panelwise.functions.dates import ANCHOR_DAY
from panelwise.operators.order_stats import GUIDE_ROWS, exact_quantiles
from panelwise.runtime import col, lookup_join, pocket

MAX_LEVELS = 10_000
# The most period means that may travel inside the plan instead of being joined.
MAX_CONSTANTS = 50_000


class _Stage(HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    def _take(self, values: dict) -> None:
        self._set(**{k: v for k, v in values.items() if v is not None})


def period_of(date: str, by: str) -> Column:
    if by not in ("year", "date"):
        raise ValueError(f"impute by 'year' or 'date', not {by!r}")
    return F.year(date) if by == "year" else F.col(date)


def period_sums(df: DataFrame, columns: Sequence[str], date: str = "date", by: str = "year") -> tuple[DataFrame, bool]:
    """Sum and count of every column per period: one pass, one small row per period."""
    sums = [e for i, c in enumerate(columns) for e in (F.sum(col(c).cast("double")).alias(f"_s{i}"), F.count(col(c)).alias(f"_c{i}"))]
    return pocket(df.groupBy(period_of(date, by).alias("_period")).agg(*sums))


def fill_from_sums(
    df: DataFrame,
    columns: Sequence[str],
    sums: DataFrame,
    small: bool,
    date: str = "date",
    by: str = "year",
    max_constants: int | None = None,
    fallback: Sequence[float | None] | None = None,
) -> DataFrame:
    """Fill missing values with the mean of their period, else the mean over all periods of ``sums``, else 0.

    ``fallback`` gives other values for periods without any, None to leave them missing. Up to ``max_constants`` means travel
    as constants inside the plan; more are joined. Both ways give the same.
    """
    slots = range(len(columns))
    if fallback is None:
        totals = sums.agg(*[F.try_divide(F.sum(f"_s{i}"), F.sum(f"_c{i}").cast("double")).alias(f"_m{i}") for i in slots]).first()
        fallback = [0.0 if m is None else m for m in totals]
    if small:
        filled = _fill_from_constants(df, columns, sums, fallback, date, by, MAX_CONSTANTS if max_constants is None else max_constants)
        if filled is not None:
            return filled
    means = [F.coalesce(F.try_divide(F.col(f"_s{i}"), F.col(f"_c{i}").cast("double")), F.lit(fallback[i]).cast("double")).alias(f"_f{i}") for i in slots]
    joined = lookup_join(df.withColumn("_period", period_of(date, by)), sums.select("_period", *means), ["_period"], "left", pocketed=small)
    filled = joined.withColumns({c: F.coalesce(col(c), F.col(f"_f{i}")) for i, c in enumerate(columns)})
    return filled.select(*[col(c) for c in df.columns])


def _fill_from_constants(
    df: DataFrame, columns: Sequence[str], sums: DataFrame, fallback: Sequence[float | None], date: str, by: str, most: int
) -> DataFrame | None:
    """The same fill with the means as constant arrays indexed by year or day, or nothing if there would be too many.

    Joining the means would drag a second copy of every wide column through the join.
    """
    known = sums.filter(F.col("_period").isNotNull())
    position = F.col("_period") if by == "year" else F.year("_period") * 12 + F.month("_period") - 1
    placed = known.withColumn("_at", position)
    if by == "date" and known.filter(F.dayofmonth("_period") != ANCHOR_DAY).limit(1).count():
        return None
    rows = placed.orderBy("_at").collect()
    if not rows or (rows[-1]["_at"] - rows[0]["_at"] + 1) * len(columns) > most:
        return None
    start = rows[0]["_at"]
    period = F.year(date) if by == "year" else F.when(F.dayofmonth(date) == ANCHOR_DAY, F.year(date) * 12 + F.month(date) - 1)
    fills = {}
    for i, c in enumerate(columns):
        means = [float("nan") if fallback[i] is None else fallback[i]] * (rows[-1]["_at"] - start + 1)
        for r in rows:
            if r[f"_c{i}"]:
                means[r["_at"] - start] = r[f"_s{i}"] / r[f"_c{i}"]
        constants = F.split(F.lit(",".join(map(repr, means)).replace("nan", "NaN")), ",").cast("array<double>")
        fills[c] = F.coalesce(col(c), F.nanvl(F.get(constants, period - F.lit(start)), F.lit(None)))
    return df.withColumns(fills)


class CrossSectionalImputer(_Stage, Transformer):
    """Fill a missing value with its column's mean in the same year (or month) of the frame at hand.

    A period without any value takes the column's mean over the frame, a column without any value 0.
    Nothing is learned: each frame is filled from itself. The means are a small table that is joined
    back, so the wide rows are not shuffled. Filling by year uses later months of that year;
    ``by='date'`` avoids that.
    """

    dateCol = Param(Params._dummy(), "dateCol", "date column", TypeConverters.toString)
    by = Param(Params._dummy(), "by", "'year' or 'date'", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, dateCol="date", by="year"):
        super().__init__()
        self._setDefault(dateCol="date", by="year")
        self._take(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        names, date, by = self.getInputCols(), self.getOrDefault("dateCol"), self.getOrDefault("by")
        missing = [c for c in [date, *names] if c not in df.columns]
        if missing:
            raise ValueError(f"cannot impute: no column {missing}")
        if not names:
            return df
        sums, small = period_sums(df, names, date, by)
        return fill_from_sums(df, names, sums, small, date, by)


class Winsorizer(_Stage, Estimator):
    """Learn two quantiles per column and clip to them; a missing value stays missing.

    ``exact=False`` takes the quantiles from a sketch.
    """

    lower = Param(Params._dummy(), "lower", "lower quantile", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper quantile", TypeConverters.toFloat)
    exact = Param(Params._dummy(), "exact", "exact quantiles", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols=None, lower=0.0025, upper=0.9975, exact=True):
        super().__init__()
        self._setDefault(lower=0.0025, upper=0.9975, exact=True)
        self._take(self._input_kwargs)

    def _fit(self, df: DataFrame) -> WinsorizerModel:
        names = self.getInputCols()
        probs = [self.getOrDefault("lower"), self.getOrDefault("upper")]
        if self.getOrDefault("exact"):
            values = by_position(df, [col(c).cast("double") for c in names])
            # Counting the wide columns is cheaper than counting their long form.
            counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(col(c)).alias(f"_c{i}") for i, c in enumerate(names)]).first()
            rows = [(i, counts["n"], counts[f"_c{i}"]) for i in range(len(names))]
            sizes = df.sparkSession.createDataFrame(rows, "position int, n long, m long"), True
            # Some rows tell well enough where the quantiles lie; all rows decide what they are.
            share = GUIDE_ROWS / max(counts["n"], 1)
            guide = by_position(df.sample(share, seed=1), [col(c).cast("double") for c in names]) if share < 0.5 else None
            quantiles = exact_quantiles(values, ["position"], "value", probs, sizes=sizes, guide=guide)
            found = {r["position"]: r["quantiles"] for r in quantiles.collect()}
            bounds = [found[i] for i in range(len(names))]
        else:
            one = df.agg(*[F.percentile_approx(col(c).cast("double"), probs, 100_000).alias(f"_q{i}") for i, c in enumerate(names)]).first()
            bounds = [q or [None, None] for q in one]
        lows = [float("-inf") if b[0] is None else b[0] for b in bounds]
        highs = [float("inf") if b[1] is None else b[1] for b in bounds]
        return WinsorizerModel(inputCols=names, lows=lows, highs=highs)


class WinsorizerModel(_Stage, Model):
    lows = Param(Params._dummy(), "lows", "lower bounds", TypeConverters.toListFloat)
    highs = Param(Params._dummy(), "highs", "upper bounds", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, lows=None, highs=None):
        super().__init__()
        self._take(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        bounds = zip(self.getInputCols(), self.getOrDefault("lows"), self.getOrDefault("highs"))
        return df.withColumns({c: clip(col(c).cast("double"), F.lit(low), F.lit(high)) for c, low, high in bounds})


class PopScaler(_Stage, Estimator):
    """Subtract the mean and divide by the population deviation; a constant column is only centred."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._take(self._input_kwargs)

    def _fit(self, df: DataFrame) -> PopScalerModel:
        names = self.getInputCols()
        values = by_position(df, [col(c).cast("double") for c in names])
        moments = values.groupBy("position").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("spread"))
        found = {r["position"]: r for r in moments.collect()}
        means = [found[i]["mean"] or 0.0 if i in found else 0.0 for i in range(len(names))]
        spreads = [found[i]["spread"] or 0.0 if i in found else 0.0 for i in range(len(names))]
        # Filling a constant column with its own mean can leave rounding dust.
        scales = [d if d > 1e-12 * abs(m) else 1.0 for m, d in zip(means, spreads)]
        return PopScalerModel(inputCols=names, means=means, scales=scales)


class PopScalerModel(_Stage, Model):
    means = Param(Params._dummy(), "means", "column means", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "column deviations", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, means=None, scales=None):
        super().__init__()
        self._take(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        learned = zip(self.getInputCols(), self.getOrDefault("means"), self.getOrDefault("scales"))
        return df.withColumns({c: (col(c) - F.lit(m)) / F.lit(d) for c, m, d in learned})


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def plain_values(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Discrete columns as text."""
    return [(col(c) if _is_text(df, c) else col(c).cast("double").cast("string")).alias(c) for c in names]


def value_counts(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by, _column, _value, _n, _order)``: values as text, with an order that is numeric for numeric columns.

    Equal values are counted before the shuffle, so a frequent value is harmless.
    """
    plain = df.select(*[col(c) for c in by], *plain_values(df, names))
    known = to_long(plain, by, names, "_column", "_value").filter(F.col("_value").isNotNull())
    numeric = F.col("_column").isin([c for c in names if not _is_text(df, c)])
    number = F.when(numeric, F.col("_value").cast("double")).otherwise(F.lit(0.0))
    counts = known.groupBy(*by, "_column", "_value").agg(F.count(F.lit(1)).alias("_n"))
    return counts.withColumn("_order", F.struct(number.alias("number"), F.col("_value").alias("text")))


def _literal(df: DataFrame, name: str, value: str) -> Column:
    return F.lit(value) if _is_text(df, name) else F.lit(float(value))


class ModeImputer(_Stage, Estimator):
    """Fill a missing value with the column's most frequent training value, the smallest on a tie."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._take(self._input_kwargs)

    def _fit(self, df: DataFrame) -> ModeImputerModel:
        names = self.getInputCols()
        first = F.min_by("_value", F.struct((-F.col("_n")).alias("rarity"), "_order"))
        modes = value_counts(df, names).groupBy("_column").agg(first.alias("_mode"))
        found = {r["_column"]: r["_mode"] for r in modes.collect()}
        kept = [c for c in names if c in found]
        return ModeImputerModel(inputCols=kept, modes=[found[c] for c in kept])


class ModeImputerModel(_Stage, Model):
    modes = Param(Params._dummy(), "modes", "fill values", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, modes=None):
        super().__init__()
        self._take(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        learned = zip(self.getInputCols(), self.getOrDefault("modes"))
        return df.withColumns({c: F.coalesce(col(c), _literal(df, c, m)) for c, m in learned})


class OneHot(_Stage, Estimator):
    """One 0/1 column per training level, none dropped; a level unseen in training gives zeros everywhere."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._take(self._input_kwargs)

    def _fit(self, df: DataFrame) -> OneHotModel:
        names, found = self.getInputCols(), {}
        rows = value_counts(df, names).select("_column", "_order").limit(MAX_LEVELS + 1).collect()
        if len(rows) > MAX_LEVELS:
            raise ValueError(f"more than {MAX_LEVELS} levels in discrete columns {names}: use one_hot_vector, which has no such bound")
        for r in sorted(rows):
            found.setdefault(r["_column"], []).append(r["_order"]["text"])
        columns = [c for c in names for _ in found.get(c, [])]
        levels = [v for c in names for v in found.get(c, [])]
        return OneHotModel(inputCols=columns, levels=levels)


def one_hot_vector(columns: Sequence[str], output: str) -> Pipeline:
    """One sparse vector instead of one column per level, for columns of very many levels.

    Levels stand in order of their text, column after column; a level unseen in training, or a missing value, gives zeros.
    """
    indexed, coded = [f"_{c}_index" for c in columns], [f"_{c}_hot" for c in columns]
    stages = [
        StringIndexer(inputCols=list(columns), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=coded, dropLast=True),  # the last is the index of what training has not seen
        VectorAssembler(inputCols=coded, outputCol=output),
        SQLTransformer(statement="SELECT * EXCEPT (" + ", ".join(f"`{c}`" for c in [*indexed, *coded]) + ") FROM __THIS__"),
    ]
    return Pipeline(stages=stages)


class OneHotModel(_Stage, Model):
    """``inputCols`` and ``levels`` run in parallel, one entry per output column."""

    levels = Param(Params._dummy(), "levels", "level of each output column", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, levels=None):
        super().__init__()
        self._take(self._input_kwargs)

    def output_columns(self) -> list[str]:
        return [f"{c}_{v.removesuffix('.0')}".replace(".", "_") for c, v in zip(self.getInputCols(), self.getOrDefault("levels"))]

    def _transform(self, df: DataFrame) -> DataFrame:
        outs = zip(self.output_columns(), self.getInputCols(), self.getOrDefault("levels"))
        return df.withColumns({o: F.coalesce((col(c) == _literal(df, c, v)).cast("double"), F.lit(0.0)) for o, c, v in outs})
