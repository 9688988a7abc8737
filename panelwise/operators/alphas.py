"""Factor-model alphas: six regressions per portfolio from one pass of cross-product sums."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.operators.portfolio import LONG_SHORT
from panelwise.operators.series import long_short_series
from panelwise.runtime import lookup_join, only, pocket, repeats

# The factor sets of the six specifications.
SIX_SPECS: dict[str, tuple[str, ...]] = {
    "r^e": (),
    "CAPM": ("mkt_excess",),
    "FF3": ("mkt_excess", "SMB", "HML"),
    "FF4": ("mkt_excess", "SMB", "HML", "Mom"),
    "FF5": ("mkt_excess", "SMB", "HML", "RMW", "CMA"),
    "FF6": ("mkt_excess", "SMB", "HML", "RMW", "CMA", "Mom"),
}
SIGNIFICANT_T = 1.96


def factor_alphas(
    returns: DataFrame,
    factors: DataFrame,
    specs: Mapping[str, Sequence[str]] = SIX_SPECS,
    subtract_rf_from_ls: bool = True,
) -> DataFrame:
    """``(model, bin, factor_model, alpha, t_stat, n, r2, beta_<factor>...)`` in percent per month.

    ``returns(model, bin, date, ret)`` are decimals, ``factors`` are percent and include ``RF``. The
    excess return of every portfolio, long-short included unless told otherwise, is regressed on each
    factor set; months with a missing value in a regression are left out of that regression. With as many months as
    coefficients there is no t-statistic, with fewer no alpha either; such portfolios keep their row.
    """
    names = list(dict.fromkeys(f for s in specs.values() for f in s))
    percent = returns.select("model", "bin", "date", (F.col("ret") * 100).alias("_ret"))
    table, small = pocket(factors.select("date", "RF", *names))
    if repeats(table, "date"):
        raise ValueError("factors hold a date more than once")
    joined = lookup_join(percent, table, ["date"], "left", pocketed=small)
    rf = F.col("RF") if subtract_rf_from_ls else F.when(F.col("bin") == LONG_SHORT, F.lit(0.0)).otherwise(F.col("RF"))
    choices = []
    for spec, used in specs.items():
        whole = F.lit(True)
        for f in used:
            whole = whole & F.col(f).isNotNull()
        xs = [(F.col(f) if f in used else F.lit(0.0)).cast("double").alias(f"_x{i}") for i, f in enumerate(names)]
        choices.append(F.when(whole, F.struct(F.lit(spec).alias("factor_model"), *xs)))
    rows = (
        joined.select("model", "bin", (F.col("_ret") - rf).alias("_y"), F.explode(F.array(*choices)).alias("_s"))
        .filter(F.col("_y").isNotNull() & F.col("_s").isNotNull())
        .select("model", "bin", "_y", "_s.*")
    )
    size = len(names) + 1
    z = [F.lit(1.0)] + [F.col(f"_x{i}") for i in range(len(names))]
    sums = [F.sum(z[i] * z[j]) for i in range(size) for j in range(i, size)]
    sums += [F.sum(z[i] * F.col("_y")) for i in range(size)]
    moments = rows.groupBy("model", "bin", "factor_model").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_y") * F.col("_y")).alias("yy"), F.array(*sums).alias("sums")
    )
    betas = ", ".join(f"`beta_{f}` double" for f in names)
    schema = f"model string, bin string, factor_model string, alpha double, t_stat double, n long, r2 double{', ' + betas if betas else ''}"
    spec_index = {s: [0] + [1 + names.index(f) for f in used] for s, used in specs.items()}
    return moments.mapInPandas(lambda batches: _solve(batches, spec_index, size, names), schema)


def _solve(
    batches: Iterator[pd.DataFrame], spec_index: Mapping[str, list[int]], size: int, names: list[str]
) -> Iterator[pd.DataFrame]:
    """Normal equations of already aggregated rows, one stacked solve per specification."""
    upper = np.triu_indices(size)
    for batch in batches:
        for spec, rows in batch.groupby("factor_model"):
            keep = spec_index[spec]
            sums = np.stack(rows["sums"].to_numpy())
            gram = np.zeros((len(rows), size, size))
            gram[:, upper[0], upper[1]] = sums[:, : len(upper[0])]
            gram[:, upper[1], upper[0]] = sums[:, : len(upper[0])]
            gram = gram[:, keep][:, :, keep]
            xy = sums[:, len(upper[0]) :][:, keep]
            n = rows["n"].to_numpy(dtype=float)
            yy = rows["yy"].to_numpy(dtype=float)
            inverse = np.linalg.pinv(gram, hermitian=True)
            rank = np.linalg.matrix_rank(gram, hermitian=True)
            coef = np.einsum("rij,rj->ri", inverse, xy)
            sse = yy - np.einsum("ri,ri->r", coef, xy)
            total = yy - xy[:, 0] ** 2 / n
            free = n - rank
            coef[n < len(keep)] = np.nan  # fewer months than coefficients: no regression
            with np.errstate(divide="ignore", invalid="ignore"):
                error = np.sqrt(np.where(free > 0, sse / free, np.nan) * inverse[:, 0, 0])
                out = rows[["model", "bin", "factor_model"]].assign(
                    alpha=coef[:, 0], t_stat=coef[:, 0] / error, n=rows["n"], r2=1 - sse / total
                )
            for i, name in enumerate(names):
                out[f"beta_{name}"] = coef[:, keep.index(i + 1)] if i + 1 in keep else None
            yield out.replace([np.inf, -np.inf, np.nan], None)


def ls_alphas(returns: DataFrame, factors: DataFrame, models: Sequence[str] | None = None, **options) -> DataFrame:
    """Alphas of the long-short portfolios of several models; raises if there is none."""
    chosen = long_short_series(returns, models)
    if not chosen.limit(1).count():
        raise ValueError("no long-short portfolio found for the selected models")
    return factor_alphas(chosen, factors, **options)


def flag_significant(alphas: DataFrame, t: float = SIGNIFICANT_T) -> DataFrame:
    return alphas.withColumn("significant", F.abs("t_stat") > F.lit(t))


def alpha_table(alphas: DataFrame, portfolios: Sequence[str] | None = None) -> DataFrame:
    """The display layout: one row per (factor_model, metric), one column per portfolio."""
    rows = alphas.select(
        "factor_model",
        F.concat("model", F.lit("_bin"), "bin").alias("portfolio"),
        F.inline(F.array(
            F.struct(F.lit("alpha").alias("metric"), F.col("alpha").alias("v")),
            F.struct(F.lit("t-stat").alias("metric"), F.col("t_stat").alias("v")),
        )),
    )
    grouped = rows.groupBy("factor_model", "metric")
    return (grouped.pivot("portfolio", list(portfolios)) if portfolios else grouped.pivot("portfolio")).agg(only("v"))
