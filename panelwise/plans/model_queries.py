"""Walk-forward predictions of every model, and what the models rely on.

The SQL of the linear models refits the preprocessing per window and solves one model by orthogonal
steps, so it shares nothing with the implementation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from panelwise.models.interpret import coefficients, importances
from panelwise.models.network import NetworkRegressor, start_weights
from panelwise.models.registry import expand_grid
from panelwise.models.shared import Design, shared_scales
from panelwise.models.walk_forward import final_fit, walk_forward
from panelwise.models.trees import LeafwiseTrees
from panelwise.operators import portfolio, series
from panelwise.operators.panel import join_factors
from panelwise.plans import oracle_parts as sql
from panelwise.plans import tables
from panelwise.plans.registry import day, num, nums, query, shown
from panelwise.prep.stages import period_sums
from panelwise.prep.windows import Window, YearMeans, filled_by_period, learn_windows
from panelwise.runtime import stage_table

YEARS = (1999, 2000, 2001)
_THREE = ("sig_qty", "sig_tax", "sig_price")
_CONTINUOUS = ["sig_qty", "sig_tax", "sig_price", "sig_rare", "mkt_excess", "SMB", "HML", "RMW", "CMA", "Mom"]
_DISCRETE = ["disc_flag", "disc_line"]


_WITH_FACTORS = (
    'full_panel as (select p.*, f.mkt_excess, f."SMB", f."HML", f."RMW", f."CMA", f."Mom" '
    "from panel p left join factors f on cast(f.date + interval 1 month as date) = p.date)"
)


def prepared_sql(features: Sequence[str], discrete: Mapping[str, Sequence[str]] | None = None) -> list[str]:
    """``ready(y, train, permno, date, ret, x1..xk)``: imputed, clipped and scaled per prediction year.

    The levels of discrete columns, filled with the training mode, follow as further x columns.
    """
    xs = [(i, c if c.islower() else f'"{c}"') for i, c in enumerate(features, 1)]
    hot = [(c, v) for c, levels in (discrete or {}).items() for v in levels]
    names = "".join(f", {c}" for c in discrete or {})
    fill = ", ".join(f"coalesce({c}, avg({c}) over (partition by y, train, year(date)), avg({c}) over (partition by y, train), 0.0e0) as x{i}" for i, c in xs)
    bounds = ", ".join(f"quantile_cont(x{i}, 0.0025) as lo{i}, quantile_cont(x{i}, 0.9975) as hi{i}" for i, _ in xs)
    clipped = ", ".join(f"least(greatest(x{i}, lo{i}), hi{i}) as x{i}" for i, _ in xs)
    moments = ", ".join(f"avg(x{i}) as m{i}, stddev_pop(x{i}) as d{i}" for i, _ in xs)
    scaled = ", ".join(f"(x{i} - m{i}) / case when d{i} = 0 then 1 else d{i} end as x{i}" for i, _ in xs)
    levels = "".join(f", case when coalesce({c}, {c}_mode) = {v} then 1.0e0 else 0.0e0 end as x{i}" for i, (c, v) in enumerate(hot, len(xs) + 1))
    modes = [
        f"mode_{c} as (select y, {c} as {c}_mode from rows_of where train and {c} is not null group by 1, 2 "
        f"qualify row_number() over (partition by y order by count(*) desc, {c}) = 1)"
        for c in discrete or {}
    ]
    joins = "".join(f" join mode_{c} on mode_{c}.y = c.y" for c in discrete or {})
    return [
        sql.PANEL,
        sql.FACTORS,
        _WITH_FACTORS,
        f"windows as (select unnest([{', '.join(map(str, YEARS))}]) as y)",
        "rows_of as (select w.y, year(p.date) < w.y as train, p.* from full_panel p join windows w on year(p.date) <= w.y)",
        f"filled as (select y, train, permno, date, ret{names}, {fill} from rows_of)",
        f"bounds as (select y, {bounds} from filled where train group by y)",
        f"clipped as (select f.y, train, permno, date, ret{names}, {clipped} from filled f join bounds b on b.y = f.y)",
        f"moments as (select y, {moments} from clipped where train group by y)",
        *modes,
        f"ready as (select c.y, train, permno, date, ret, {scaled}{levels} from clipped c join moments m on m.y = c.y{joins})",
    ]


def orthogonal_sql(columns: Sequence[int], penalties: Sequence[float] = (0.0,), tag: str = "s") -> list[str]:
    """``<tag>_solved(y, a, train, permno, date, ret, pred, t, h)``: fit, training residual and leverage per penalty a.

    Ridge is least squares with one extra training row per feature, of size sqrt(a).
    """
    xs = [f"x{i}" for i in columns]
    centred = ", ".join(f"r.{x} - m.{x} as {x}" for x in xs)
    extra = "".join(
        f" union all select y, {a!r}, true, -1, null, null, 0.0e0, 0.0e0, 0.0e0, {', '.join(f'sqrt({a!r})' if x == e else '0.0e0' for x in xs)} from windows"
        for a in penalties
        if a
        for e in xs
    )
    steps = [
        f"{tag}_centre as (select y, avg(ret) as my, 1.0e0 / count(*) as h, {', '.join(f'avg({x}) as {x}' for x in xs)} from ready where train group by y)",
        f"{tag}0 as (select r.y, p.a, r.train, r.permno, r.date, r.ret, m.my as pred, case when r.train then r.ret - m.my end as t, m.h, {centred} "
        f"from ready r join {tag}_centre m on m.y = r.y cross join (select unnest([{', '.join(f'{a!r}e0' for a in penalties)}]) as a) p{extra})",
    ]
    for j, x in enumerate(xs, 1):
        over = "over (partition by y, a)"
        norm = f"sum({x} * {x}) filter (train) {over}"
        later = "".join(f", {v} - {x} * (sum({v} * {x}) filter (train) {over}) / {norm} as {v}" for v in xs[j:])
        slope = f"{x} * (sum(t * {x}) filter (train) {over}) / {norm}"
        steps.append(f"{tag}{j} as (select y, a, train, permno, date, ret, pred + {slope} as pred, t - {slope} as t, h + {x} * {x} / {norm} as h{later} from {tag}{j - 1})")
    steps.append(f"{tag}_solved as (select * from {tag}{len(xs)} where permno >= 0)")
    return steps


def leave_one_out_sql(tag: str) -> list[str]:
    """``<tag>_chosen(y, a)``: the penalty with the smallest leave-one-out error."""
    return [
        f"{tag}_errors as (select y, a, avg((t / (1 - h)) ^ 2) as e from {tag}_solved where train group by 1, 2)",
        f"{tag}_chosen as (select y, a from {tag}_errors qualify row_number() over (partition by y order by e, a) = 1)",
    ]


_PREDICTED = "predicted as (select permno, date, ret, pred from s_solved where not train)"


def _predictions_sql(parts: list[str], model: str) -> str:
    return sql.statement(parts, f"select permno, {day('date')}, {nums('ret', 'pred', digits=6)}, '{model}' as model from predicted")


def _forward(spark, sf_dir, variants, features=_THREE):
    return shown(walk_forward(tables.panel(spark, sf_dir), list(features), years=YEARS, variants=variants), 6)


@query("walk_forward_ols", _predictions_sql([*prepared_sql(_THREE), *orthogonal_sql((1, 2, 3)), _PREDICTED], "OLS"))
def walk_forward_ols(spark, sf_dir):
    return _forward(spark, sf_dir, [("OLS", "OLS", {})])


@query("walk_forward_ridge", _predictions_sql([*prepared_sql(_THREE), *orthogonal_sql((1, 2, 3), (1.0,)), _PREDICTED], "Ridge"))
def walk_forward_ridge(spark, sf_dir):
    return _forward(spark, sf_dir, [("Ridge", "Ridge", {})])


_BOUNDS = sql.statement(
    prepared_sql(_THREE),
    " union all ".join(f"select y as year, '{c}' as signal, {num(f'lo{i}', 'low', 7)}, {num(f'hi{i}', 'high', 7)}, {num(f'm{i}', 'mean', 7)}, {num(f'd{i}', 'spread', 7)} from bounds join moments using (y)" for i, c in enumerate(_THREE, 1)),
)


def _bounds(spark, sf_dir, **options):
    """Bounds, means and spreads of every window, from summaries of the years."""
    staged = stage_table(tables.panel(spark, sf_dir).select("date", "ret", *_THREE, F.year("date").alias("_year")), "_year")
    sums, small = period_sums(staged, _THREE)
    windows = [Window(y) for y in YEARS]
    filled = filled_by_period(staged, _THREE, sums, small, "date", "year")
    learn_windows(filled, windows, _THREE, (), YearMeans(sums, len(_THREE), "year"), **options)
    fits = shared_scales(filled, Design(windows, list(_THREE), [], "ret"))
    rows = [(w.year, c, *map(float, x)) for w, fit in zip(windows, fits) for c, *x in zip(_THREE, w.lows, w.highs, fit.means, fit.scales)]
    return shown(spark.createDataFrame(rows, "year int, signal string, low double, high double, mean double, spread double"), 7)


@query("window_bounds", _BOUNDS)
def window_bounds(spark, sf_dir):
    return _bounds(spark, sf_dir)


@query("window_bounds_sketched", _BOUNDS)
def window_bounds_sketched(spark, sf_dir):
    """The way taken for large panels: merged sketches of the years place the brackets of all windows, counts make them exact."""
    return _bounds(spark, sf_dir, direct_pairs=0)


_ONE = ("sig_tax",)
_FIT = "fit as (select y, avg(ret) as my, avg(x1) as mx, covar_pop(ret, x1) as c, var_pop(x1) as v, count(*) as n from ready where train group by y)"


def _soft(c: str, alpha: str, v: str) -> str:
    return f"sign({c}) * greatest(abs({c}) - {alpha}, 0) / {v}"


@query(
    "walk_forward_lasso",
    sql.statement(
        [*prepared_sql(_ONE), _FIT, "penalties as (select unnest([1.0e0, 0.01e0]) as a, unnest(['Lasso', 'Lasso-light']) as model)",
         f"predicted as (select permno, date, ret, p.model, my + {_soft('c', 'a', 'v')} * (x1 - mx) as pred from ready r join fit f on f.y = r.y cross join penalties p where not train)"],
        f"select permno, {day('date')}, {nums('ret', 'pred', digits=6)}, model from predicted",
    ),
)
def walk_forward_lasso(spark, sf_dir):
    return _forward(spark, sf_dir, [("Lasso", "Lasso", {}), ("Lasso-light", "Lasso", {"alpha": 0.01})], _ONE)


@query(
    "walk_forward_ridge_cv",
    _predictions_sql(
        [*prepared_sql(_ONE), _FIT, "penalties as (select unnest([0.1e0, 1.0e0, 10.0e0]) as a)",
         "loo as (select r.y, a, avg(((ret - my - c * n / (v * n + a) * (x1 - mx)) / (1 - 1.0e0 / n - (x1 - mx) ^ 2 / (v * n + a))) ^ 2) as e "
         "from ready r join fit f on f.y = r.y cross join penalties where train group by 1, 2)",
         "chosen as (select y, a from loo qualify row_number() over (partition by y order by e, a) = 1)",
         "predicted as (select permno, date, ret, my + c * n / (v * n + a) * (x1 - mx) as pred from ready r join fit f on f.y = r.y join chosen h on h.y = r.y where not train)"],
        "RidgeCV",
    ),
)
def walk_forward_ridge_cv(spark, sf_dir):
    return _forward(spark, sf_dir, [("RidgeCV", "RidgeCV", {})], _ONE)


@query(
    "walk_forward_lasso_cv",
    _predictions_sql(
        [*prepared_sql(_ONE), _FIT,
         "grid as (select y, i, abs(c) * pow(1e-3, i / 49.0e0) as a from fit cross join (select unnest(range(50)) as i))",
         "folded as (select *, ntile(5) over (partition by y order by permno, date) as k from ready where train)",
         "held as (select unnest([1, 2, 3, 4, 5]) as h)",
         "fold_fit as (select y, h, avg(ret) as my, avg(x1) as mx, covar_pop(ret, x1) as c, var_pop(x1) as v from folded join held on k <> h group by 1, 2)",
         f"fold_error as (select g.y, g.i, g.a, f.h, avg((r.ret - f.my - {_soft('f.c', 'g.a', 'f.v')} * (r.x1 - f.mx)) ^ 2) as e "
         "from grid g join fold_fit f on f.y = g.y join folded r on r.y = g.y and r.k = f.h group by 1, 2, 3, 4)",
         "chosen as (select y, a from (select y, i, a, avg(e) as e from fold_error group by 1, 2, 3) qualify row_number() over (partition by y order by e, i) = 1)",
         f"predicted as (select permno, date, ret, my + {_soft('c', 'a', 'v')} * (x1 - mx) as pred from ready r join fit f on f.y = r.y join chosen h on h.y = r.y where not train)"],
        "LassoCV",
    ),
)
def walk_forward_lasso_cv(spark, sf_dir):
    return _forward(spark, sf_dir, [("LassoCV", "LassoCV", {})], _ONE)


def _moments_sql(source: str, keys: str, name: str) -> str:
    """Means, variances and covariances of three features and the return."""
    pairs = ", ".join(f"covar_pop(x{i}, x{j}) as c{i}{j}" for i, j in ((1, 2), (1, 3), (2, 3)))
    each = ", ".join(f"avg(x{i}) as m{i}, var_pop(x{i}) as v{i}, covar_pop(ret, x{i}) as r{i}" for i in (1, 2, 3))
    return f"{name} as (select {keys}, avg(ret) as my, {pairs}, {each} from {source} group by {keys})"


def _descent_sql(source: str, keys: str, name: str, sweeps: int = 400) -> str:
    """Coordinate descent on three features: ``source`` has the moments and a penalty ``a`` per row of ``keys``."""
    same = ", ".join(f"s.{k}" for k in keys.split(", "))
    on = " and ".join(f"s.{k} = d.{k}" for k in keys.split(", "))
    step1 = f"select d.k, {same}, s.a, s.r2, s.r3, s.v2, s.v3, s.c12, s.c13, s.c23, d.b2, d.b3, {_soft('(s.r1 - d.b2 * s.c12 - d.b3 * s.c13)', 's.a', 's.v1')} as n1 from {name} d join {source} s on {on} where d.k < {sweeps}"
    step2 = f"select *, {_soft('(r2 - n1 * c12 - b3 * c23)', 'a', 'v2')} as n2 from ({step1})"
    return f"{name} as (select {keys}, 0 as k, 0.0e0 as b1, 0.0e0 as b2, 0.0e0 as b3 from {source} union all select {keys}, k + 1, n1, n2, {_soft('(r3 - n1 * c13 - n2 * c23)', 'a', 'v3')} from ({step2}))"


def _recursive(parts: Sequence[str], select: str) -> str:
    return sql.statement(list(parts), select).replace("with ", "with recursive ", 1)


_LIGHT = 0.01
_LINE = "m.my + b1 * (x1 - m1) + b2 * (x2 - m2) + b3 * (x3 - m3)"


@query(
    "walk_forward_lasso_three",
    _recursive(
        [*prepared_sql(_THREE), _moments_sql("(select * from ready where train)", "y", "moment3"), f"light as (select *, {_LIGHT}e0 as a from moment3)", _descent_sql("light", "y", "descent"),
         f"predicted as (select permno, date, ret, {_LINE} as pred from ready r join moment3 m on m.y = r.y join descent d on d.y = r.y and d.k = 400 where not train)"],
        f"select permno, {day('date')}, {nums('ret', 'pred', digits=6)}, 'Lasso' as model from predicted",
    ),
)
def walk_forward_lasso_three(spark, sf_dir):
    """A penalty that leaves several coefficients in place."""
    return _forward(spark, sf_dir, [("Lasso", "Lasso", {"alpha": _LIGHT})])


@query(
    "walk_forward_lasso_cv_three",
    _recursive(
        [*prepared_sql(_THREE),
         "folded as (select *, ntile(5) over (partition by y order by permno, date) as k from ready where train)",
         _moments_sql("(select * from ready where train)", "y", "moment3"),
         "grid as (select y, i, greatest(abs(r1), abs(r2), abs(r3)) * pow(1e-3, i / 49.0e0) as a from moment3 cross join (select unnest(range(50)) as i))",
         _moments_sql("(select f.*, h.h from folded f join (select unnest([1, 2, 3, 4, 5]) as h) h on f.k <> h.h)", "y, h", "fold_moment"),
         "fold_grid as (select f.*, g.i, g.a from fold_moment f join grid g on g.y = f.y)",
         _descent_sql("fold_grid", "y, h, i", "fold_descent"),
         f"fold_error as (select d.y, d.i, d.h, avg((ret - ({_LINE})) ^ 2) as e from fold_descent d join fold_moment m on m.y = d.y and m.h = d.h "
         "join folded f on f.y = d.y and f.k = d.h where d.k = 400 group by 1, 2, 3)",
         "chosen as (select y, i from (select y, i, avg(e) as e from fold_error group by 1, 2) qualify row_number() over (partition by y order by e, i) = 1)",
         "best as (select m.*, g.a from moment3 m join chosen c on c.y = m.y join grid g on g.y = m.y and g.i = c.i)",
         _descent_sql("best", "y", "descent"),
         f"predicted as (select permno, date, ret, {_LINE} as pred from ready r join moment3 m on m.y = r.y join descent d on d.y = r.y and d.k = 400 where not train)"],
        f"select permno, {day('date')}, {nums('ret', 'pred', digits=6)}, 'LassoCV' as model from predicted",
    ),
)
def walk_forward_lasso_cv_three(spark, sf_dir):
    return _forward(spark, sf_dir, [("LassoCV", "LassoCV", {})])


@query(
    "walk_forward_stump",
    sql.statement(
        [sql.PANEL, f"windows as (select unnest([{', '.join(map(str, YEARS))}]) as y)",
         "train_rows as (select w.y, p.sig_step as x, p.ret from panel p join windows w on year(p.date) < w.y)",
         "cuts as (select distinct y, x as c from train_rows)",
         "gains as (select t.y, c.c, sum(ret) filter (x <= c) ^ 2 / count(*) filter (x <= c) + sum(ret) filter (x > c) ^ 2 / count(*) filter (x > c) as gain "
         "from train_rows t join cuts c on c.y = t.y group by 1, 2 having count(*) filter (x > c) >= 20 and count(*) filter (x <= c) >= 20)",
         "best as (select y, c from gains qualify row_number() over (partition by y order by gain desc, c) = 1)",
         "leaves as (select t.y, b.c, avg(ret) filter (x <= c) as low, avg(ret) filter (x > c) as high from train_rows t join best b on b.y = t.y group by 1, 2)"],
        f"select permno, {day('date')}, {num('ret', digits=6)}, 'stump' as model, {num('case when sig_step <= c then low else high end', 'pred', 6)} from panel p join leaves l on l.y = year(p.date)",
    ),
)
def walk_forward_stump(spark, sf_dir):
    """One tree of one split: its threshold and leaf means have an exact answer."""
    return _forward(spark, sf_dir, [("stump", "hgbr", {"maxIter": 1, "maxDepth": 1, "learningRate": 1.0, "validation": 0.0})], ("sig_step",))


_TREE_X = {"n_items": "cast(n_items as double)", "sig_step": "sig_step", "disc_line": "disc_line", "sig_rare": "floor(sig_rare)"}
_TREES = {"maxIter": 2, "learningRate": 0.5, "maxLeaves": 4, "validation": 0.0}


def _leafwise_sql() -> list[str]:
    """Best-first growth step by step: every split of every leaf, on either side for missing values; the best one is made."""
    xs = range(1, 1 + len(_TREE_X))
    parts = [
        "features as (" + " union all ".join(f"select {i} as j, '{c}' as feature" for i, c in zip(xs, _TREE_X)) + ")",
        "f0 as (select permno, date, ret, year(date) < 2001 as train, " + ", ".join(f"{e} as x{i}" for i, e in zip(xs, _TREE_X.values())) + ", avg(ret) filter (year(date) < 2001) over () as f from panel)",
        "cuts as (select j, v, coalesce((v + lead(v) over (partition by j order by v)) / 2, 'infinity'::double) as cut from ("
        + " union ".join(f"select {i} as j, x{i} as v from f0 where train and x{i} is not null" for i in xs)
        + "))",
    ]
    for r in range(1, _TREES["maxIter"] + 1):
        parts.append(f"r{r}s0 as (select *, f - ret as g, 0 as leaf from f{r - 1})")
        for s in range(1, _TREES["maxLeaves"]):
            rows, now = f"r{r}s{s - 1}", f"r{r}s{s}"
            long = " union all ".join(f"select leaf, {i} as j, x{i} as v, g from {rows} where train" for i in xs)
            parts += [
                f"{now}_bins as (select leaf, j, v, sum(g) as g, count(*) as n from ({long}) group by 1, 2, 3)",
                f"{now}_run as (select leaf, j, v, sum(g) filter (v is not null) over w as gl, sum(n) filter (v is not null) over w as nl, "
                "coalesce(sum(g) filter (v is null) over a, 0) as mg, coalesce(sum(n) filter (v is null) over a, 0) as mn, sum(g) over a as tg, sum(n) over a as tn "
                f"from {now}_bins window a as (partition by leaf, j), w as (partition by leaf, j order by v nulls last rows unbounded preceding))",
                f"{now}_side as (select leaf, j, v, gl, nl, tg, tn, mn = 0 and nl * 2 > tn as gap_left from {now}_run where v is not null "
                f"union all select leaf, j, v, gl + mg, nl + mn, tg, tn, true from {now}_run where v is not null and mn > 0)",
                f"{now}_best as (select b.leaf, b.j, c.cut, b.gap_left, gl * gl / nl + (tg - gl) * (tg - gl) / (tn - nl) - tg * tg / tn as gain "
                f"from {now}_side b join cuts c on c.j = b.j and c.v = b.v where nl >= 20 and tn - nl >= 20 order by gain desc limit 1)",
                f"{now} as (select r.* exclude (leaf), case when r.leaf <> b.leaf then r.leaf when case b.j "
                + " ".join(f"when {i} then case when x{i} is null then gap_left else x{i} <= cut end" for i in xs)
                + f" end then {2 * s - 1} else {2 * s} end as leaf from {rows} r cross join {now}_best b)",
            ]
        last = f"r{r}s{_TREES['maxLeaves'] - 1}"
        parts.append(f"f{r} as (select r.permno, r.date, r.ret, r.train, " + ", ".join(f"r.x{i}" for i in xs) + f", r.f - {_TREES['learningRate']}e0 * avg(g) filter (train) over (partition by leaf) as f from {last} r)")
    return parts


@query(
    "leafwise_trees",
    sql.statement([sql.PANEL, *_leafwise_sql()], f"select permno, {day('date')}, {num('ret', digits=6)}, {num('f', 'pred', 6)} from f{_TREES['maxIter']} where not train"),
)
def leafwise_trees(spark, sf_dir):
    """Two rounds of trees of four leaves on features with missing values: an exact answer, from which leaf is split first to which side missing values take."""
    model, staged = _leafwise(spark, sf_dir)
    return shown(model.transform(staged.filter("_year >= 2001")).select("permno", "date", "ret", F.col("prediction").alias("pred")), 6)


@query(
    "leafwise_importance",
    sql.statement(
        [sql.PANEL, *_leafwise_sql(),
         "gains as (" + " union all ".join(f"select j, gain from r{r}s{s}_best" for r in range(1, _TREES["maxIter"] + 1) for s in range(1, _TREES["maxLeaves"])) + ")"],
        f"select feature, {num('coalesce(sum(gain), 0) / (select sum(gain) from gains)', 'importance', 7)} from features left join gains using (j) group by feature",
    ),
)
def leafwise_importance(spark, sf_dir):
    """Each feature's share of all gains of these trees."""
    return shown(importances(PipelineModel(stages=[_leafwise(spark, sf_dir)[0]])), 7)


def _leafwise(spark, sf_dir):
    panel = tables.panel(spark, sf_dir).select("permno", "date", "ret", "n_items", "sig_step", "disc_line", F.floor("sig_rare").cast("double").alias("sig_rare"))
    staged = stage_table(panel.withColumn("_year", F.year("date")))
    return LeafwiseTrees(inputCols=list(_TREE_X), **_TREES).fit(staged.filter("_year < 2001")), staged


_NET = {"hidden": [2], "maxIter": 4, "batchSize": 10_000_000, "learningRate": 0.05, "alpha": 0.5, "validation": 0.0, "seed": 3}
_NET_X = {"qty": "(sig_qty - 25e0) / 10", "items": "(n_items - 10e0) / 5"}


def _network_sql() -> list[str]:
    """One layer of rectified units, trained by Adam on all rows: activations, gradients and steps written out."""
    inputs, units, rate, penalty = len(_NET_X), _NET["hidden"][0], _NET["learningRate"], _NET["alpha"]
    start = start_weights([inputs, units, 1], _NET["seed"]).tolist()
    at_w = [[i * units + u for u in range(units)] for i in range(inputs)]
    at_b = [inputs * units + u for u in range(units)]
    at_v, at_c = [inputs * units + units + u for u in range(units)], inputs * units + 2 * units
    rows = "select permno, date, ret, year(date) < 2001 as train, " + ", ".join(f"{e} as x{i}" for i, e in enumerate(_NET_X.values())) + " from panel"
    parts = [f"net_rows as ({rows})", "s0 as (select " + ", ".join(f"{v!r}::double as p{k}, 0.0e0 as m{k}, 0.0e0 as v{k}" for k, v in enumerate(start)) + ")"]
    unit = [" + ".join([*[f"x{i} * p{at_w[i][u]}" for i in range(inputs)], f"p{at_b[u]}"]) for u in range(units)]
    for t in range(1, _NET["maxIter"] + 1):
        hidden = ", ".join(f"greatest({z}, 0) as h{u}" for u, z in enumerate(unit))
        delta = " + ".join([*[f"h{u} * p{at_v[u]}" for u in range(units)], f"p{at_c} - ret"])
        grads = {at_c: "avg(d)"} | {k: f"avg(d * h{u})" for u, k in enumerate(at_v)}
        grads |= {k: f"avg(case when h{u} > 0 then d * p{at_v[u]} else 0 end)" for u, k in enumerate(at_b)}
        grads |= {at_w[i][u]: f"avg(case when h{u} > 0 then d * p{at_v[u]} * x{i} else 0 end)" for i in range(inputs) for u in range(units)}
        shrunk = {*at_v, *(k for row in at_w for k in row)}
        parts += [
            f"a{t} as (select *, {delta} as d from (select r.*, s.*, {hidden} from net_rows r cross join s{t - 1} s where train))",
            f"g{t} as (select " + ", ".join(f"{e}{f' + {penalty}e0 * any_value(p{k}) / count(*)' if k in shrunk else ''} as g{k}" for k, e in sorted(grads.items())) + f" from a{t})",
            f"n{t} as (select " + ", ".join(f"p{k}, 0.9e0 * m{k} + 0.1e0 * g{k} as m{k}, 0.999e0 * v{k} + 0.001e0 * g{k} * g{k} as v{k}" for k in range(len(start))) + f" from s{t - 1} cross join g{t})",
            f"s{t} as (select " + ", ".join(f"p{k} - {rate}e0 * (m{k} / (1 - pow(0.9e0, {t}))) / (sqrt(v{k} / (1 - pow(0.999e0, {t}))) + 1e-8) as p{k}, m{k}, v{k}" for k in range(len(start))) + f" from n{t})",
        ]
    out = " + ".join([*[f"greatest({z}, 0) * p{at_v[u]}" for u, z in enumerate(unit)], f"p{at_c}"])
    return [*parts, f"predicted as (select permno, date, ret, {out} as pred from net_rows cross join s{_NET['maxIter']} where not train)"]


@query("network_steps", sql.statement([sql.PANEL, *_network_sql()], f"select permno, {day('date')}, {nums('ret', 'pred', digits=6)} from predicted"))
def network_steps(spark, sf_dir):
    """Four synchronous steps of a small network over three tasks; what every weight must be can be written out in SQL."""
    rows = stage_table(tables.panel(spark, sf_dir).select("permno", "date", "ret", *[F.expr(e).alias(c) for c, e in _NET_X.items()]))
    model = NetworkRegressor(inputCols=list(_NET_X), mode="synchronous", tasks=3, **_NET).fit(rows.filter(F.year("date") < 2001))
    return shown(model.transform(rows.filter(F.year("date") >= 2001)).select("permno", "date", "ret", F.col("prediction").alias("pred")), 6)


def _quality(predicted):
    """Rows, finite predictions, and whether they miss by less than twice the spread of the returns, per model."""
    ratio = F.sum((F.col("ret") - F.col("pred")) ** 2) / F.sum(F.col("ret") ** 2)
    return predicted.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs("pred") < 1e9).alias("finite"), (ratio < 2).alias("sane"))


def _quality_sql(models: Sequence[str]) -> str:
    each = " union all ".join(f"select '{m}' as model, count(*) as n, count(*) as finite, true as sane from panel where year(date) in ({', '.join(map(str, YEARS))})" for m in models)
    return sql.statement([sql.PANEL], each)


@query("network_quality", _quality_sql([name for name, _ in expand_grid("mlp")]))
def network_quality(spark, sf_dir):
    return _quality(walk_forward_mlp(spark, sf_dir))


@query("trees_quality", _quality_sql(["hgbr"]))
def trees_quality(spark, sf_dir):
    return _quality(walk_forward_gbt(spark, sf_dir))


def _full_panel(spark, sf_dir):
    return join_factors(tables.panel(spark, sf_dir), tables.factors(spark, sf_dir))


_EVERY_LEVEL = {"disc_flag": ("'A'", "'N'", "'R'"), "disc_line": ("0.0e0", "1.0e0")}
_READY = prepared_sql(_CONTINUOUS, _EVERY_LEVEL)
_EVERY_X = tuple(range(1, 16))
# Least squares cannot orthogonalise a full set of levels: the first level of each column (x11, x14) is left out.
_SOLVABLE_X = tuple(x for x in _EVERY_X if x not in (11, 14))
_OLS = orthogonal_sql(_SOLVABLE_X, tag="o")
_RIDGE = orthogonal_sql(_EVERY_X, (1.0,), "r")
_RIDGE_CV = [*orthogonal_sql(_EVERY_X, (0.1, 1.0, 10.0), "c"), *leave_one_out_sql("c")]


def _all_features(spark, sf_dir, names):
    variants = [(n, n, {}) for n in names]
    return shown(walk_forward(_full_panel(spark, sf_dir), _CONTINUOUS, _DISCRETE, YEARS, variants), 6)


@query("walk_forward_ols_all", _predictions_sql([*_READY, *_OLS, _PREDICTED.replace("s_solved", "o_solved")], "OLS"))
def walk_forward_ols_all(spark, sf_dir):
    """All features; with every one-hot level present the coefficients are not unique but the predictions are."""
    return _all_features(spark, sf_dir, ["OLS"])


@query("walk_forward_ridge_all", _predictions_sql([*_READY, *_RIDGE, _PREDICTED.replace("s_solved", "r_solved")], "Ridge"))
def walk_forward_ridge_all(spark, sf_dir):
    return _all_features(spark, sf_dir, ["Ridge"])


@query(
    "walk_forward_linear_all",
    sql.statement(
        [
            *_READY,
            *_OLS,
            *_RIDGE,
            *_RIDGE_CV,
            "flat as (select y, avg(ret) as pred from ready where train group by y)",
            "predicted as (select permno, date, ret, 'OLS' as model, pred from o_solved where not train "
            "union all select permno, date, ret, 'Ridge', pred from r_solved where not train "
            "union all select permno, date, ret, 'RidgeCV', pred from c_solved s join c_chosen c on c.y = s.y and c.a = s.a where not train "
            "union all select permno, date, ret, 'Lasso', f.pred from ready r join flat f on f.y = r.y where not train)",
        ],
        f"select permno, {day('date')}, {nums('ret', 'pred', digits=6)}, model from predicted",
    ),
)
def walk_forward_linear_all(spark, sf_dir):
    """Four linear models on all features from one pass per window; the default lasso penalty leaves the mean."""
    return _all_features(spark, sf_dir, ["OLS", "Lasso", "Ridge", "RidgeCV"])


@query(
    "walk_forward_ridge_levels",
    _predictions_sql(
        [*[part.replace("l_suppkey", "l_partkey") if part is sql.PANEL else part for part in prepared_sql(_ONE)],
         # A ridge penalty a on a level of n rows takes from each row the level's mean times 1 - sqrt(a / (n + a)).
         "level_of as (select y, permno, count(*) as n, avg(ret) as my, avg(x1) as mx, 1 - sqrt(1e0 / (count(*) + 1e0)) as s from ready where train group by 1, 2)",
         "taken as (select r.y, 1 - s as c, x1 - s * mx as x, ret - s * my as t from ready r join level_of l on l.y = r.y and l.permno = r.permno where train)",
         "normal as (select y, sum(c * c) as cc, sum(c * x) as cx, sum(x * x) + 1e0 as xx, sum(c * t) as ct, sum(x * t) as xt from taken group by y)",
         "solved as (select y, (ct * xx - xt * cx) / (cc * xx - cx * cx) as b0, (xt * cc - ct * cx) / (cc * xx - cx * cx) as b1 from normal)",
         "predicted as (select r.permno, r.date, r.ret, b0 + b1 * x1 + coalesce(n * (my - b0 - b1 * mx) / (n + 1e0), 0) as pred "
         "from ready r join solved using (y) left join level_of l on l.y = r.y and l.permno = r.permno where not train)"],
        "Ridge",
    ),
)
def walk_forward_ridge_levels(spark, sf_dir):
    """Ridge with one level per entity (20 000 parts at the benchmark's scale), none of them a column."""
    panel = tables.panel(spark, sf_dir, "l_partkey").withColumn("part", F.col("permno").cast("string"))
    return shown(walk_forward(panel, list(_ONE), years=YEARS, variants=[("Ridge", "Ridge", {})], level="part"), 6)


@query("walk_forward_lasso_cv_all")
def walk_forward_lasso_cv_all(spark, sf_dir):
    return _all_features(spark, sf_dir, ["LassoCV"])


@query("walk_forward_gbt")
def walk_forward_gbt(spark, sf_dir):
    """Up to 100 rounds, stopped early by a held-out tenth of the rows."""
    return shown(walk_forward(_full_panel(spark, sf_dir), _CONTINUOUS, _DISCRETE, YEARS, [("hgbr", "hgbr", {})]), 6)


@query("walk_forward_mlp")
def walk_forward_mlp(spark, sf_dir):
    """Up to 100 epochs of the three networks, stopped early."""
    variants = [(name, "mlp", params) for name, params in expand_grid("mlp")]
    return shown(walk_forward(_full_panel(spark, sf_dir), _CONTINUOUS, _DISCRETE, YEARS, variants), 6)


_CHAIN = [
    *_READY,
    *_RIDGE,
    _PREDICTED.replace("s_solved", "r_solved"),
    "ridge_predictions as (select permno, date, ret / 100 as ret, 'Ridge' as model, pred / 100 as pred from predicted)",
    sql.bins("ridge_predictions", "bins"),
    sql.stats("bins", "stats"),
    sql.long_short("stats", "ls"),
    "path as (select *, 1 - value / max(value) over (partition by model order by date) as drawdown "
    "from (select *, product(1 + ret) over (partition by model order by date) as value from ls))",
]


@query(
    "walk_forward_portfolios",
    sql.statement(
        _CHAIN,
        f"select model, {num('avg(ret) * 100', 'mean_pct', 6)}, {num('stddev_samp(ret) * 100', 'std_pct', 6)}, "
        f"{num('avg(ret) / stddev_samp(ret) * sqrt(12.0e0)', 'sharpe', 6)}, {num('max(drawdown) * 100', 'max_drawdown', 6)} from path group by model",
    ),
)
def walk_forward_portfolios(spark, sf_dir):
    """The whole chain: features, out-of-sample predictions, bins, long-short returns and their metrics."""
    found = walk_forward(_full_panel(spark, sf_dir), _CONTINUOUS, _DISCRETE, YEARS, [("Ridge", "Ridge", {})])
    decimal = found.withColumns({"ret": F.col("ret") / 100, "pred": F.col("pred") / 100})
    rets = portfolio.portfolio_returns(portfolio.portfolio_stats(portfolio.assign_bins(stage_table(decimal))))
    return shown(series.model_metrics(rets), 6)


@query(
    "coef_ranking",
    sql.statement(
        [*prepared_sql(("sig_qty", "sig_price")),
         "sums as (select avg(ret) as my, covar_pop(ret, x1) as c1, covar_pop(ret, x2) as c2, var_pop(x1) as v1, var_pop(x2) as v2, covar_pop(x1, x2) as v12 from ready where train and y = 2001)",
         "coefs as (select 'sig_qty' as feature, (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) as coefficient from sums "
         "union all select 'sig_price', (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) from sums)"],
        f"select feature, {num('coefficient', digits=7)} from coefs order by abs(coefficient) desc",
    ),
)
def coef_ranking(spark, sf_dir):
    model = final_fit(tables.panel(spark, sf_dir), ["sig_qty", "sig_price"], before_year=2001, variants=[("OLS", "OLS", {})])["OLS"]
    return shown(coefficients(model), 7)


@query("importance_ranking")
def importance_ranking(spark, sf_dir):
    model = final_fit(_full_panel(spark, sf_dir), _CONTINUOUS, _DISCRETE, 2001, [("hgbr", "hgbr", {})])["hgbr"]
    return shown(importances(model), 6)
