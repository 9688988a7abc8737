"""Expanding-window training: fit on all earlier years, predict the next one, store, resume."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.functions.columns import narrow_floats
from panelwise.models.gram import too_wide
from panelwise.models.linear import LASSO_FOLDS, LinearFit
from panelwise.models.registry import build_model, default_variants, with_levels
from panelwise.models.shared import Design, Fit, shared_leave_one_out, shared_moments, shared_scales, window_row_folds
from panelwise.prep.pipeline import build_preprocessor, feature_names, fit_prepare
from panelwise.prep.stages import ModeImputer, period_sums
from panelwise.prep.windows import Window, YearMeans, fill_rest, filled_by_period, learn_windows
from panelwise.runtime import col, drop_staged, stage_table
from panelwise.sources import store as storage

Variant = tuple[str, str, dict]
T = TypeVar("T")
R = TypeVar("R")


def side_by_side(work: Callable[[T], R], items: Sequence[T], parallelism: int) -> Iterator[R]:
    """Results in the order of ``items``, up to ``parallelism`` at a time, so that small jobs fill the cluster together."""
    if parallelism < 2 or len(items) < 2:
        yield from map(work, items)
        return
    with ThreadPool(min(parallelism, len(items))) as pool:
        yield from pool.imap(inheritable_thread_target(SparkSession.active())(work), items)


def fit_variants(
    train: DataFrame, features: Sequence[str], variants: Iterable[Variant], label: str = "ret", parallelism: int = 1, shared: Fit | None = None
) -> list[tuple[str, Model]]:
    """Fit every variant on one prepared training frame; linear models share one pass over it, or none if its cross products are given."""
    estimators: list[tuple[str, Estimator]] = [(v, build_model(name, features, label, **params)) for v, name, params in variants]
    linear = [e for _, e in estimators if isinstance(e, LinearFit)]
    moments = None if shared is None else shared.folds
    if linear and not moments and not too_wide(len(features)):
        folded = [e for e in linear if e.getOrDefault("kind") == "lasso_cv"]
        moments = (folded or linear)[0].moments(train, bool(folded))

    def fit(estimator: Estimator) -> Model:
        if isinstance(estimator, LinearFit) and moments:
            return estimator.fit_moments(train, moments, shared and shared.loo)
        return estimator.fit(train)

    return list(zip([v for v, _ in estimators], side_by_side(fit, [e for _, e in estimators], parallelism)))


def shared_fits(filled: DataFrame, windows: Sequence[Window], todo: Mapping[int, Sequence[Variant]], continuous: Sequence[str], discrete: Sequence[str], label: str) -> list[Fit]:
    """Means, scales and, as far as linear models ask for them, the cross products and leave-one-out errors of all windows."""
    design = Design(windows, list(continuous), list(discrete), label)
    linear = {w.year: [e for e in (build_model(name, ["x"], label, **params) for _, name, params in todo[w.year]) if isinstance(e, LinearFit)] for w in windows}
    if not any(linear.values()) or too_wide(design.size - 2):
        return shared_scales(filled, design)
    folded = next((e for own in linear.values() for e in own if e.getOrDefault("kind") == "lasso_cv"), None)
    if folded is None:
        fits = shared_moments(filled, design)
    elif folded.getOrDefault("foldBy") == "entity":
        fits = shared_moments(filled, design, [folded.fold_column(filled)] * len(windows), LASSO_FOLDS)
    else:
        fits = shared_moments(filled, design, window_row_folds(filled, windows, LASSO_FOLDS, folded.getOrDefault("entityCol"), folded.getOrDefault("dateCol")), LASSO_FOLDS)
    shared_leave_one_out(filled, design, fits, [[tuple(e.getOrDefault("alphas")) for e in linear[w.year] if e.getOrDefault("kind") == "ridge_cv"] for w in windows])
    return fits


def score_variants(test: DataFrame, fitted: Sequence[tuple[str, Model]], keys: Sequence[str]) -> DataFrame:
    """``(keys, model, pred)``: all linear models in one pass over the frame, the others one by one."""
    plain = [(v, m) for v, m in fitted if hasattr(m, "score")]
    frames = []
    if plain:
        pairs = F.array(*[F.struct(F.lit(v).alias("model"), m.score().alias("pred")) for v, m in plain])
        frames.append(test.select(*keys, F.inline(pairs)))
    for v, m in fitted:
        if not hasattr(m, "score"):
            frames.append(m.transform(test).select(*keys, F.lit(v).alias("model"), F.col("prediction").alias("pred")))
    return reduce(DataFrame.unionByName, frames)


def walk_forward(
    panel: DataFrame,
    continuous: Sequence[str],
    discrete: Sequence[str] = (),
    years: Sequence[int] = tuple(range(2000, 2020)),
    variants: Sequence[Variant] | None = None,
    window_years: int | None = None,
    label: str = "ret",
    store: str | None = None,
    skip_done: bool = True,
    impute_by: str = "year",
    exact_quantiles: bool = True,
    parallelism: int = 4,
    single_precision: bool = False,
    level: str | None = None,
) -> DataFrame:
    """Out-of-sample predictions ``(permno, date, ret, model, pred)``.

    Each year is predicted by what the years before teach (all of them, or the last ``window_years``). The panel is
    staged once, laid out by year. Preprocessing and linear models of all windows are learned in the same scans: summaries
    of each year are merged into every later window, and one scan adds each row to the cross products of all its windows.
    Other models read their window's folders. With ``store`` every finished (model, year) is written there and,
    unless ``skip_done`` is off, not fitted again by a later run. ``parallelism`` windows are fitted
    at the same time. ``single_precision`` rounds the panel's doubles first. ``level`` names one more discrete column, of any
    number of levels, for the linear models other than the lasso; the others do not see it.
    """
    variants = default_variants() if variants is None else list(variants)
    variants = variants if level is None else with_levels(variants, level)
    spark = panel.sparkSession
    keys = ["permno", "date", "ret"]
    done = finished(spark, store) if store and skip_done else set()
    todo = {y: [v for v in variants if (v[0], y) not in done] for y in years}
    frames = []
    if any(todo.values()):
        wanted = list(dict.fromkeys(["permno", "date", label, *continuous, *discrete, *([level] if level else [])]))
        laid_out = panel.filter(col(label).isNotNull()).select(*[col(c) for c in wanted], F.year("date").alias("_year"))
        laid_out = narrow_floats(laid_out) if single_precision else laid_out
        staged = stage_table(laid_out.filter(F.col("_year") <= max(years)), "_year")
        # Filling by period learns nothing from other periods, so one pass over the panel serves all windows.
        sums, small = period_sums(staged, continuous, "date", impute_by) if continuous else (None, False)
        means = YearMeans(sums, len(continuous), impute_by)
        filled = filled_by_period(staged, continuous, sums, small, "date", impute_by) if continuous else staged
        windows = [Window(y, None if window_years is None else y - window_years) for y, left in todo.items() if left]
        learn_windows(filled, windows, continuous, discrete, means, exact=exact_quantiles)
        fits = shared_fits(filled, windows, todo, continuous, discrete, label)

        def scored(place: int) -> DataFrame:
            window, fit = windows[place], fits[place]
            pre = window.stages(continuous, discrete, fit.means, fit.scales)
            train = fill_rest(filled.filter(F.col("_year").isin([int(y) for y in window.years])), continuous, window.fallback)
            test = fill_rest(filled.filter(F.col("_year") == window.year), continuous, means.over([window.year]))
            if level:
                pre = PipelineModel(stages=[*pre.stages, ModeImputer(inputCols=[level]).fit(train)])
            fitted = fit_variants(pre.transform(train), feature_names(pre), todo[window.year], label, parallelism, fit)
            return score_variants(pre.transform(test.withColumn("ret", F.col(label).cast("double"))), fitted, keys)

        for frame in side_by_side(scored, range(len(windows)), parallelism):
            if store:
                storage.store_predictions(frame, store)
            else:
                frames.append(frame)
        if store:
            drop_staged(staged)  # the predictions are written; without a store they still read it
    if store:
        return storage.read_predictions(spark, store)
    return reduce(DataFrame.unionByName, frames)


def finished(spark, store: str) -> set[tuple[str, int]]:
    """The (model, year) pairs a store already holds."""
    return storage.finished_pairs(spark, store)


def final_fit(
    panel: DataFrame,
    continuous: Sequence[str],
    discrete: Sequence[str] = (),
    before_year: int = 2020,
    variants: Sequence[Variant] | None = None,
    label: str = "ret",
    folder: str | None = None,
    skip_saved: bool = True,
    parallelism: int = 4,
) -> dict[str, PipelineModel]:
    """One pipeline per variant, fitted afresh on all rows before ``before_year``; saved if a folder is given."""
    variants = default_variants() if variants is None else list(variants)
    spark = panel.sparkSession
    saved = {v[0] for v in variants if folder and skip_saved and storage.model_saved(spark, folder, v[0])}
    left = [v for v in variants if v[0] not in saved]
    models = {name: storage.load_model(folder, name) for name in saved}
    if left:
        rows = panel.filter(F.year("date") < before_year).filter(F.col(label).isNotNull())
        train = stage_table(rows.select(*dict.fromkeys(["permno", "date", label, *continuous, *discrete])))
        pre, prepared = fit_prepare(build_preprocessor(continuous, discrete), train)
        for name, model in fit_variants(prepared, feature_names(pre), left, label, parallelism):
            parts = model.stages if isinstance(model, PipelineModel) else [model]
            models[name] = PipelineModel(stages=[*pre.stages, *parts])
            if folder:
                storage.save_model(models[name], folder, name)
    return models


