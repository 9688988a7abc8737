from datetime import date

import pytest
from pyspark.sql import functions as F

from panelwise.sources import store, tables


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_inputs(spark, tmp_path):
    rets = tables.read_returns(spark, write(tmp_path / "r.csv", "permno,date,ret\n10001,2020-01-31,1.5\n10001,2020-02-28,\n10002,2020-01-31,NaN\n"))
    assert [tuple(r) for r in rets.collect()] == [(10001, date(2020, 1, 31), 1.5), (10001, date(2020, 2, 28), None), (10002, date(2020, 1, 31), None)]
    sigs = tables.read_signals(spark, write(tmp_path / "s.csv", "permno,yyyymm,Beta,Size\n1,202001,0.5,\n"))
    assert sigs.dtypes == [("permno", "bigint"), ("yyyymm", "int"), ("Beta", "double"), ("Size", "double")]
    assert tuple(sigs.first()) == (1, 202001, 0.5, None)
    doc = tables.read_signal_doc(spark, write(tmp_path / "d.csv", 'Acronym,Cat.Form,Note\nBeta,continuous,"two\nlines"\nBeta,continuous,again\n'))
    assert [tuple(r) for r in doc.collect()] == [("Beta", "continuous")]
    fac = tables.read_factors(spark, write(tmp_path / "f.csv", "date,Mkt-RF,SMB,RF,_merge\n2020-01-01,1.0,2.0,0.1,both\n"))
    assert fac.columns == ["date", "mkt_excess", "SMB", "RF", "_merge"] and fac.first()["date"] == date(2020, 1, 28)
    zoo = tables.read_zoo(spark, write(tmp_path / "z.csv", "signalname,port,date,ret\nBM,LS,2020-01-31,2.0\nBM,01,2020-01-31,1.0\n"))
    assert [tuple(r) for r in zoo.collect()] == [("BM", date(2020, 1, 28), 2.0)]


def test_bad_inputs(spark, tmp_path):
    with pytest.raises(ValueError, match="unpack"):
        tables.read_table(spark, "x.zip")
    with pytest.raises(ValueError, match="schema"):
        tables.read_table(spark, "x.csv")
    broken = write(tmp_path / "b.csv", "permno,date,ret\n1,2020-01-31,many\n")
    with pytest.raises(Exception):
        tables.read_returns(spark, broken).collect()


def test_factor_tables_combine_unshifted(spark):
    five = spark.createDataFrame([(date(2020, 1, 1), 1.0, 0.1)], "Date date, `Mkt-RF` double, RF double")
    mom = spark.createDataFrame([(date(2020, 1, 31), 5.0), (date(2020, 2, 1), 6.0)], "date date, UMD double")
    got = tables.combine_factors(five, mom, provenance=True).orderBy("date").collect()
    assert [tuple(r) for r in got] == [(date(2020, 1, 28), 1.0, 0.1, 5.0, "both"), (date(2020, 2, 28), None, None, 6.0, "right_only")]


def test_outputs_round_trip(spark, tmp_path):
    d = date(2020, 1, 28)
    wide = spark.createDataFrame([(d, 0.1, None)], "date date, ret_Ridge_bin1 double, `ret_mlp-64-32_binLS` double")
    stats = spark.createDataFrame([("Ridge", 1, d, 0.1, None, 3)], tables.PORT_STATS)
    moves = spark.createDataFrame([("Ridge", 1, d, 0.5, 0.25, 0.25)], "model string, bin int, date date, buy double, sell double, hold double")
    folder = str(tmp_path / "out")
    tables.write_portfolio_outputs(folder, wide, stats, moves)
    tables.write_portfolio_outputs(folder, wide, stats, moves)
    back = tables.read_portfolio_outputs(spark, folder)
    assert [b.collect() for b in back] == [wide.collect(), stats.collect(), moves.collect()]
    tables.write_portfolio_outputs(folder + "-csv", wide, stats, moves, csv=True)
    assert [b.collect() for b in tables.read_portfolio_outputs(spark, folder + "-csv", csv=True)] == [b.collect() for b in back]
    assert "% buy" in spark.read.parquet(f"{folder}/turnover").columns
    tables.write_table(stats, f"{folder}/stats.csv")
    assert tables.read_table(spark, f"{folder}/stats.csv", tables.PORT_STATS).collect() == stats.collect()


def test_prediction_store_replaces_only_what_it_gets(spark, tmp_path):
    path = str(tmp_path / "p")
    schema = "permno long, date date, ret double, model string, pred double"
    store.write_predictions(spark.createDataFrame([(1, date(2000, 1, 28), 0.1, "a", 1.0), (1, date(2001, 1, 28), 0.1, "b", 2.0)], schema), path)
    store.write_predictions(spark.createDataFrame([(1, date(2000, 1, 28), 0.1, "a", 5.0)], schema), path)
    assert {(r["model"], r["pred"]) for r in store.read_predictions(spark, path).collect()} == {("a", 5.0), ("b", 2.0)}
    assert store.finished_models(spark, path) == ["a", "b"] and store.finished_models(spark, path + "-none") == []


def test_wide_files(spark, tmp_path):
    preds = tables.read_predictions_wide(spark, write(tmp_path / "p.csv", "permno,date,ret,pred_Ridge,pred_mlp-64-32\n1,2000-01-28,0.5,0.1,\n"))
    assert sorted(map(tuple, preds.collect()), key=str) == [(1, date(2000, 1, 28), 0.5, "Ridge", 0.1), (1, date(2000, 1, 28), 0.5, "mlp-64-32", None)]
    zoo = tables.read_zoo_wide(spark, write(tmp_path / "z.csv", "date,BM,Size\n2000-01-31,1.5,\n"))
    assert {tuple(r) for r in zoo.collect()} == {("BM", date(2000, 1, 28), 1.5), ("Size", date(2000, 1, 28), None)}


def test_display_text(spark):
    one = spark.createDataFrame([(0.1234, None)], "a double, b double")
    got = one.select(tables.percent_text(F.col("a")), tables.percent_text(F.col("b")), tables.number_text(F.col("a"), 2, True)).first()
    assert tuple(got) == ("12.34%", "-", "(0.12)")
