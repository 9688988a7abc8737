"""Common table expressions the oracle statements are put together from."""

PANEL = """
panel as (
  select permno, date, n_items, ret, sig_qty, case when n_items >= 4 then tax end as sig_tax, sig_price,
         floor(tax / 4) as sig_step, case when n_items >= 15 then tax end as sig_rare,
         case when n_items >= 4 then case when a >= n and a >= r then 'A' when n >= r then 'N' else 'R' end end as disc_flag,
         case when n_items >= 4 then case when f * 2 >= n_items then 1.0e0 else 0.0e0 end end as disc_line
  from (
    select l_suppkey as permno, make_date(year(l_shipdate), month(l_shipdate), 28) as date, count(*) as n_items,
           cast(sum(cast(round(l_discount * 100) as bigint)) as double) / count(*) - 5.0e0 as ret,
           cast(sum(cast(round(l_quantity) as bigint)) as double) / count(*) as sig_qty,
           cast(sum(cast(round(l_tax * 100) as bigint)) as double) / count(*) as tax,
           cast(sum(cast(floor(l_extendedprice) as bigint)) as double) / count(*) as sig_price,
           count(*) filter (l_returnflag = 'A') as a, count(*) filter (l_returnflag = 'N') as n,
           count(*) filter (l_returnflag = 'R') as r, count(*) filter (l_linestatus = 'F') as f
    from lineitem group by 1, 2)
)"""

PART_PANEL = PANEL.replace("panel as", "part_panel as", 1).replace("l_suppkey as permno", "l_partkey as permno")

RAW_SIGNALS = """
raw_signals as (
  select permno, year(date) * 100 + month(date) as yyyymm, sig_qty, sig_tax, sig_price, sig_rare from panel
)"""

LAGGED_SIGNALS = """
lagged as (
  select permno, cast(make_date(cast(yyyymm // 100 as int), cast(yyyymm % 100 as int), 28) + interval 1 month as date) as date,
         cast(yyyymm as varchar) as yyyymm_signals, sig_qty, sig_tax, sig_price, sig_rare
  from raw_signals
)"""


def _mean(condition: str, name: str) -> str:
    return (
        f"cast(sum(cast(floor(o_totalprice) as bigint)) filter ({condition}) as double)"
        f" / nullif(count(*) filter ({condition}), 0) / 100000.0e0 - 2.5e0 as {name}"
    )


FACTORS = f"""
factors as (
  select make_date(year(o_orderdate), month(o_orderdate), 28) as date,
         {_mean("true", "mkt_excess")}, {_mean("o_orderpriority[1] = '1'", '"SMB"')}, {_mean("o_orderpriority[1] = '2'", '"HML"')},
         {_mean("o_orderpriority[1] = '3'", '"RMW"')}, {_mean("o_orderpriority[1] = '4'", '"CMA"')},
         count(*) filter (o_orderpriority[1] = '5') / 1000.0e0 as "RF", {_mean("o_orderstatus = 'P'", '"Mom"')}
  from orders group by 1
)"""

_MODELS = {"Ridge": "sig_qty", "Lasso": "sig_step", "LassoCV": "sig_tax", "mlp-64-32": "sig_price"}
PREDICTIONS = "\npredictions as (\n" + "\n  union all\n".join(
    f"  select permno, date, ret / 100 as ret, '{m}' as model, {s} / 100 as pred from panel" for m, s in _MODELS.items()
) + "\n)"
ZOO_PREDICTIONS = "\nzoo_predictions as (\n" + "\n  union all\n".join(
    f"  select permno, date, ret, '{s}' as model, {s} as pred from panel" for s in ("sig_qty", "sig_tax", "sig_price")
) + "\n)"


def bins(source: str, name: str, nport: int = 5) -> str:
    return f"""
{name} as (
  select *, case when pred is not null then cast(ceil(
      (rank() over (partition by model, date order by pred nulls last)) * {nport}.0e0
      / (count(*) over (partition by model, date) + 1)) as int) end as bin
  from {source}
)"""


def stats(source: str, name: str) -> str:
    return f"""
{name} as (
  select model, bin, date, avg(ret) as ret, stddev_samp(ret) as std, count(ret) as nfirms
  from {source} where bin is not null group by 1, 2, 3
)"""


def long_short(source: str, name: str) -> str:
    return f"""
{name} as (
  select model, date, max(ret) filter (bin = top) - max(ret) filter (bin = bottom) as ret
  from (select *, max(bin) over (partition by model) as top, min(bin) over (partition by model) as bottom
        from {source} where ret is not null)
  group by 1, 2
)"""


def returns(stat: str, ls: str, name: str) -> str:
    return f"""
{name} as (
  select model, cast(bin as varchar) as bin, date, ret from {stat}
  union all
  select model, 'LS' as bin, date, ret from {ls}
)"""


BINS = [PANEL, PREDICTIONS, bins("predictions", "bins")]
STATS = [*BINS, stats("bins", "stats")]
RETURNS = [*STATS, long_short("stats", "ls"), returns("stats", "ls", "returns")]
ZOO_PORTS = [
    PANEL,
    ZOO_PREDICTIONS,
    bins("zoo_predictions", "zoo_bins"),
    stats("zoo_bins", "zoo_stats"),
    long_short("zoo_stats", "zoo_ls"),
    returns("zoo_stats", "zoo_ls", "zoo_returns"),
    "\nzoo as (select model as signalname, date, ret from zoo_ls)",
]


def statement(parts: list[str], select: str) -> str:
    """The parts, each once, in front of a select."""
    seen = list(dict.fromkeys(p.strip() for p in parts))
    return "with " + ",\n".join(seen) + "\n" + select.strip()


def cumulated(source: str, keys: str) -> str:
    """Growth of 1 with a base row, for a table (keys, date, ret)."""
    return f"""
cumulated as (
  select {keys}, date, case when ret is not null then product(1 + ret) over (partition by {keys} order by date) end as value
  from {source}
  union all
  select distinct {keys}, cast((select min(date) from {source}) - interval 1 month as date), 1.0e0 from {source}
)"""
