"""Readers and writers: what is written to the shared folder and read again must be what it was."""

from __future__ import annotations

import uuid
from datetime import date as Date

from pyspark.sql import functions as F

from panelwise.functions.columns import columns_after
from panelwise.models.interpret import coefficients
from panelwise.models.walk_forward import final_fit, walk_forward
from panelwise.operators import portfolio
from panelwise.operators.panel import lag_signals
from panelwise.plans import oracle_parts as sql
from panelwise.plans import tables
from panelwise.plans.model_queries import _THREE, YEARS
from panelwise.plans.registry import ORACLES, day, num, nums, query, shown
from panelwise.runtime import shared_folder
from panelwise.sources import store
from panelwise.sources import tables as files


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/delivery-{uuid.uuid4().hex}"


def _written(df, name: str) -> str:
    path = f"{_folder(df.sparkSession)}/{name}"
    files.write_table(df, path)
    return path


@query("returns_file", sql.statement([sql.PANEL], f"select permno, {day('date')}, {num('ret')} from panel"))
def returns_file(spark, sf_dir):
    """A CSV with more columns than are wanted, in another order."""
    wide = tables.panel(spark, sf_dir).select("ret", "disc_flag", "date", "permno", "sig_qty")
    return shown(files.read_returns(spark, _written(wide, "returns.csv")))


_SIGNALS = ("sig_qty", "sig_tax", "sig_price", "sig_rare")


@query("signals_file", sql.statement([sql.PANEL, sql.RAW_SIGNALS], f"select permno, yyyymm, {nums(*_SIGNALS)} from raw_signals"))
def signals_file(spark, sf_dir):
    return shown(files.read_signals(spark, _written(tables.raw_signals(spark, sf_dir), "signals.csv")))


@query("signals_file_lagged", sql.statement([sql.PANEL, sql.RAW_SIGNALS, sql.LAGGED_SIGNALS], f"select permno, {day('date')}, yyyymm_signals, {nums(*_SIGNALS)} from lagged"))
def signals_file_lagged(spark, sf_dir):
    found = lag_signals(files.read_signals(spark, _written(tables.raw_signals(spark, sf_dir), "signals")))
    return shown(found.select("permno", "date", "yyyymm_signals", *_SIGNALS))


_FACTORS = ("mkt_excess", "SMB", "HML", "RMW", "CMA", "RF", "Mom")


@query("factors_file", sql.statement([sql.FACTORS], f"select {day('date')}, {', '.join(num(chr(34) + c + chr(34), chr(34) + c + chr(34)) for c in _FACTORS)} from factors"))
def factors_file(spark, sf_dir):
    """Five factors and momentum from two files, under the names of the delivery."""
    f = tables.factors(spark, sf_dir)
    five = files.read_factors(spark, _written(f.drop("Mom").withColumnRenamed("mkt_excess", "Mkt-RF"), "five.csv"))
    momentum = files.read_factors(spark, _written(f.select(F.col("date").alias("Date"), "Mom"), "momentum"))
    return shown(files.combine_factors(five, momentum).select("date", *_FACTORS))


@query(
    "signal_doc_file",
    "select p_brand as \"Acronym\", p_type as \"Cat.Form\" from part group by 1, 2",
)
def signal_doc_file(spark, sf_dir):
    parts = tables.table(spark, sf_dir, "part").select(F.col("p_brand").alias("Acronym"), "p_name", F.col("p_type").alias("Cat.Form"))
    return files.read_signal_doc(spark, _written(parts, "doc.csv"))


@query("zoo_file", sql.statement(sql.ZOO_PORTS, f"select signalname, {day('date')}, {num('ret')} from zoo"))
def zoo_file(spark, sf_dir):
    more = tables.zoo_portfolios(spark, sf_dir).withColumns({"Nlong": F.lit(1), "note": F.lit("x, y")}).select("date", "note", "port", "Nlong", "ret", "signalname")
    return shown(files.read_zoo(spark, _written(more, "zoo.csv")).select("signalname", "date", "ret"))


@query("portfolio_files", sql.statement(sql.STATS, f"select model, bin, {day('date')}, {nums('ret', 'std')}, nfirms from stats"))
def portfolio_files(spark, sf_dir):
    """All portfolio outputs as CSV; the statistics come back, the wide returns are counted against them."""
    bins, folder = tables.bins(spark, sf_dir), _folder(spark)
    stats = portfolio.portfolio_stats(bins)
    wide = portfolio.returns_wide(portfolio.portfolio_returns(stats))
    files.write_portfolio_outputs(folder, wide, stats, portfolio.turnover(bins), csv=True)
    wide_back, stats_back, _ = files.read_portfolio_outputs(spark, folder, csv=True)
    if sorted(columns_after(wide_back, 1)) != sorted(columns_after(wide, 1)):
        raise ValueError("the wide returns changed on the way")
    return shown(stats_back)


@query("prediction_store", ORACLES["prediction_upsert"])
def prediction_store(spark, sf_dir):
    """The store keeps rows that a new run lacks, and takes the new run's values where it has them."""
    path = _folder(spark)
    every = tables.predictions(spark, sf_dir)
    store.store_predictions(every.filter(F.col("date") < F.lit(Date(2001, 1, 1))), path)
    new = every.filter((F.col("model") == "LassoCV") & (F.col("date") >= F.lit(Date(2000, 1, 1)))).withColumn("pred", F.col("pred") * 2)
    store.store_predictions(new, path)
    return shown(store.read_predictions(spark, path).select("permno", "date", "model", "ret", "pred"))


@query("walk_forward_resumed", ORACLES["walk_forward_ridge"])
def walk_forward_resumed(spark, sf_dir):
    """A run over the first two years, and a second over all three that only fits the last."""
    path, ridge = _folder(spark), [("Ridge", "Ridge", {})]
    frame = tables.panel(spark, sf_dir)
    walk_forward(frame, list(_THREE), years=YEARS[:2], variants=ridge, store=path)
    if store.finished_models(spark, path) != ["Ridge"] or len(store.finished_pairs(spark, path)) != 2:
        raise ValueError("the store does not hold what was fitted")
    return shown(walk_forward(frame, list(_THREE), years=YEARS, variants=ridge, store=path), 6)


@query("coef_ranking_saved", ORACLES["coef_ranking"])
def coef_ranking_saved(spark, sf_dir):
    """The saved pipeline, loaded by a second call that fits nothing."""
    folder, frame = _folder(spark), tables.panel(spark, sf_dir)
    final_fit(frame, ["sig_qty", "sig_price"], before_year=2001, variants=[("OLS", "OLS", {})], folder=folder)
    model = final_fit(frame.limit(0), ["sig_qty", "sig_price"], before_year=2001, variants=[("OLS", "OLS", {})], folder=folder)["OLS"]
    return shown(coefficients(model), 7)


@query(
    "display_text",
    sql.statement(
        sql.STATS,
        f"select model, bin, {day('date')}, case when std is null then '-' else printf('(%.7f)', std) end as std_text, printf('%.7f%%', ret * 100) as ret_text from stats",
    ),
)
def display_text(spark, sf_dir):
    """With seven digits, so that no value lies half way between two texts (there the engines round differently)."""
    found = tables.stats(spark, sf_dir)
    return shown(found.select("model", "bin", "date", files.number_text(F.col("std"), 7, brackets=True).alias("std_text"), files.percent_text(F.col("ret"), 7).alias("ret_text")))
