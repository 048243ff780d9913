"""Queries of the panel library over the given tables, and the SQL that gives the same rows.

Values are rounded on both sides, since sums of floating-point numbers depend on their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..core import expr
from ..core.scratch import scratch
from ..operators import checks, diagnostics, features, lake, portfolio, rebalance, signals, universe
from ..sources import panel as src

C = F.col
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

# SQL of the panels ------------------------------------------------------------------------------------------------------------

_P = "l_extendedprice / l_quantity"
PANEL = f"""panel AS (
  SELECT date_trunc('week', l_shipdate)::DATE AS date, l_suppkey::VARCHAR AS asset, arg_min({_P}, (l_orderkey, l_linenumber, {_P})) AS open, max({_P}) AS high,
         min({_P}) AS low, sum(l_extendedprice) / sum(l_quantity) AS close, sum(l_quantity) AS volume, sum(l_extendedprice) AS amount, sum(l_quantity) / 10000 AS turnover,
         any_value(s_acctbal) + 20000 AS market_cap, any_value(s_nationkey) AS grp, sum(l_quantity) > 0 AS is_tradable
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""
INDEX = f"""idx AS (
  SELECT date_trunc('week', l_shipdate)::DATE AS date, n_regionkey AS index_id, sum(l_extendedprice) / sum(l_quantity) AS close, max({_P}) AS high,
         sum(l_extendedprice) AS amount, avg(1 + l_discount * 100) AS valuation_pe_ttm
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)"""
MARGIN = """margin AS (
  SELECT date_trunc('week', l_shipdate)::DATE AS date, l_suppkey::VARCHAR AS asset, sum(l_extendedprice) AS financing_balance, sum(l_extendedprice * l_discount) AS financing_buy_amount,
         sum(l_extendedprice * l_tax) AS financing_repay_amount, sum(l_extendedprice * (1 + l_tax)) AS margin_total_balance,
         sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS short_sell_volume FROM lineitem GROUP BY 1, 2)"""
W = "PARTITION BY asset ORDER BY date"


def roll(f: str, x: str, n: int, w: str = W) -> str:
    over = f"OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {over} = {n} THEN {f}({x}) {over} END"


def chg(x: str, k: int, w: str = W) -> str:
    return f"({x} / nullif(lag({x}, {k}) OVER ({w}), 0) - 1)"


def fwd(x: str, k: int) -> str:
    return f"(lead({x}, {k}) OVER ({W}) / nullif({x}, 0) - 1)"


FEAT = f"""{PANEL}, r1 AS (SELECT *, {chg('close', 1)} AS ret_1d FROM panel), feat AS (
  SELECT *, {chg('close', 5)} AS ret_5d, {chg('close', 20)} AS ret_20d, {roll('stddev_samp', 'ret_1d', 20)} AS vol_20d, {roll('avg', 'amount', 20)} AS amount_20d,
         {fwd('close', 5)} AS fwd_ret_5d, {fwd('close', 20)} AS fwd_ret_20d FROM r1)"""


def rnk(x: str, part: str = "date", pct: bool = True) -> str:
    out = f"rank() OVER (PARTITION BY {part} ORDER BY {x} NULLS LAST) + (count(*) OVER (PARTITION BY {part}, {x}) - 1) / 2.0"
    out = f"({out}) / count({x}) OVER (PARTITION BY {part})" if pct else out
    return f"CASE WHEN {x} IS NOT NULL THEN {out} END"


def corr(x: str, y: str) -> str:
    ok = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    return f"CASE WHEN count(*) {ok} >= 2 AND stddev_pop({x}) {ok} * stddev_pop({y}) {ok} > 0 THEN covar_pop({y}, {x}) {ok} / (stddev_pop({x}) {ok} * stddev_pop({y}) {ok}) END"


def qcut(x: str, q: int, least: int, part: str = "date") -> str:
    r, n = f"row_number() OVER (PARTITION BY {part} ORDER BY {x} NULLS LAST, asset)", f"count({x}) OVER (PARTITION BY {part})"
    return f"CASE WHEN {x} IS NOT NULL AND {n} >= {max(2, least)} THEN greatest(1, ceil(({r} - 1) * {q}::DOUBLE / ({n} - 1)))::INTEGER END"


def rounded(cols: dict[str, int], keys: str) -> str:
    return f"{keys}, " + ", ".join(f"round({c}, {d}) + 0.0 AS {c}" for c, d in cols.items())


def rnd(df: DataFrame, keys: list[str], cols: dict[str, int]) -> DataFrame:
    return df.select(*keys, *[F.round(C(c), d).alias(c) for c, d in cols.items()])


def even(df: DataFrame, keys: list[str], cols: dict[str, int]) -> DataFrame:
    """Like rnd, with values moved a little, since quotients of decimals often stand exactly between two rounded values."""
    return df.select(*keys, *[F.round(C(c) + 10.0 ** -(d + 3), d).alias(c) for c, d in cols.items()])


def even_sql(cols: dict[str, tuple[str, int]]) -> str:
    return ", ".join(f"round({q} + 1e-{d + 3}, {d}) + 0.0 AS {c}" for c, (q, d) in cols.items())


def _own(cols: dict[str, int]) -> dict[str, tuple[str, int]]:
    return {c: (c, d) for c, d in cols.items()}


def register(name: str, query: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE_SQL[name] = sql


def _feat(spark: SparkSession, d: str) -> DataFrame:
    p = src.daily_panel(spark, d)
    return features.compute_features(p, ["ret_1d", "ret_5d", "ret_20d", "vol_20d", "amount_20d", "fwd_ret_5d", "fwd_ret_20d"], keep=("close", "volume", "amount", "market_cap", "grp", "is_tradable"))


# sources and features -----------------------------------------------------------------------------------------------------------

_BAR = {"open": 6, "high": 6, "low": 6, "close": 6, "volume": 2, "amount": 2, "turnover": 6, "market_cap": 2}
register("s1_daily_panel", lambda s, d: even(src.daily_panel(s, d), ["date", "asset", "grp", "is_tradable"], _BAR), f"WITH {PANEL} SELECT date, asset, grp, is_tradable, {even_sql(_own(_BAR))} FROM panel")
_F = {"ret_1d": 6, "ret_5d": 6, "ret_20d": 6, "vol_20d": 6, "amount_20d": 3, "fwd_ret_5d": 6, "fwd_ret_20d": 6}
register("f1_feature_store", lambda s, d: even(_feat(s, d), ["date", "asset"], _F), f"WITH {FEAT} SELECT date, asset, {even_sql(_own(_F))} FROM feat")
_T = {"turnover_5d": 6, "turnover_20d": 6, "market_cap": 2}
register("f5_turnover", lambda s, d: rnd(features.compute_features(src.daily_panel(s, d), list(_T)), ["date", "asset"], _T),
         f"WITH {PANEL} SELECT date, asset, round({roll('avg', 'turnover', 5)}, 6) AS turnover_5d, round({roll('avg', 'turnover', 20)}, 6) AS turnover_20d, round(market_cap, 2) AS market_cap FROM panel")
_M = {"ma_5": 5, "ma_20": 5, "ma_ratio_20": 6, "volatility_20d": 6}
register("f11_moving_averages", lambda s, d: even(features.moving_averages(src.daily_panel(s, d)), ["date", "asset"], _M),
         f"WITH {FEAT}, m AS (SELECT date, asset, {roll('avg', 'close', 5)} AS ma_5, {roll('avg', 'close', 20)} AS ma_20, close, vol_20d AS volatility_20d FROM feat), x AS (SELECT *, close / nullif(ma_20, 0) AS ma_ratio_20 FROM m) SELECT date, asset, {even_sql(_own(_M))} FROM x")
register("f12_forward_labels", lambda s, d: rnd(features.forward_labels(src.daily_panel(s, d), (1, 10)), ["date", "asset"], {"fwd_ret_1d": 6, "fwd_ret_10d": 6}),
         f"WITH {PANEL} SELECT date, asset, round({fwd('close', 1)}, 6) + 0.0 AS fwd_ret_1d, round({fwd('close', 10)}, 6) + 0.0 AS fwd_ret_10d FROM panel")

_tech: dict[str, tuple[str, int]] = {f"ret_{k}d": (chg("close", k), 6) for k in (5, 20, 60)} | {f"momentum_{k}d": (chg("close", k), 6) for k in (20, 60)} | {f"reversal_{k}d": (f"-{chg('close', k)}", 6) for k in (5, 20)}
for _k in (20, 60):
    _tech |= {
        f"realized_vol_{_k}d": (roll("stddev_samp", "r", _k), 6), f"downside_vol_{_k}d": (roll("stddev_samp", "neg", _k), 6), f"max_drawdown_{_k}d": (f"close / ({roll('max', 'close', _k)}) - 1", 6),
        f"amount_mean_{_k}d": (roll("avg", "amount", _k), 3), f"turnover_mean_{_k}d": (roll("avg", "turnover", _k), 6), f"amihud_illiquidity_{_k}d": (roll("avg", "illiq", _k), 9),
        f"high_low_range_{_k}d": (f"({roll('max', 'high', _k)}) / ({roll('min', 'low', _k)}) - 1", 6), f"close_to_high_{_k}d": (f"close / ({roll('max', 'high', _k)}) - 1", 6),
    }
for _x in ("amount", "turnover"):
    _tech[f"{_x}_shock_5d_vs_20d"] = (f"({roll('avg', _x, 5)}) / ({roll('avg', _x, 20)})", 6)
_TC = {k: v[1] for k, v in _tech.items()}
_TSQL = f"{FEAT}, tb AS (SELECT *, ret_1d AS r, CASE WHEN ret_1d < 0 THEN ret_1d END AS neg, abs(ret_1d) / CASE WHEN amount > 0 THEN amount END AS illiq FROM feat)"
register("t_technical_liquidity", lambda s, d: even(features.technical_liquidity(src.daily_panel(s, d)), ["date", "asset"], _TC), f"WITH {_TSQL} SELECT date, asset, " + even_sql(_tech) + " FROM tb")

_marg: dict[str, tuple[str, int]] = {c: (c, 2) for c in ("financing_balance", "margin_total_balance")}
_marg |= {f"{c}_chg_{k}d": (chg(c, k), 6) for c in ("financing_balance", "margin_total_balance") for k in (5, 20)}
for _n, _c in (("financing_buy", "financing_buy_amount"), ("short_sell", "short_sell_volume")):
    _marg |= {f"{_n}_mean_{k}d": (roll("avg", _c, k), 3) for k in (5, 20)} | {f"{_n}_shock_5d_vs_20d": (f"CASE WHEN ({roll('avg', _c, 20)}) > 0 THEN ({roll('avg', _c, 5)}) / nullif(({roll('avg', _c, 20)}), 0) END", 6)}
_marg |= {"financing_net_buy": ("financing_buy_amount - financing_repay_amount", 2)} | {f"financing_net_buy_mean_{k}d": (roll("avg", "(financing_buy_amount - financing_repay_amount)", k), 3) for k in (5, 20)}
register("m_margin_leverage", lambda s, d: even(features.margin_leverage(src.margin_panel(s, d)), ["date", "asset"], {k: v[1] for k, v in _marg.items()}), f"WITH {MARGIN} SELECT date, asset, " + even_sql(_marg) + " FROM margin")

_WI = "PARTITION BY index_id ORDER BY date"
_reg: dict[str, tuple[str, int]] = {f"index_ret_{k}d": (chg("close", k, _WI), 6) for k in (5, 20, 60)} | {f"index_momentum_{k}d": (chg("close", k, _WI), 6) for k in (20, 60)}
for _k in (20, 60):
    _reg |= {f"index_realized_vol_{_k}d": (roll("stddev_samp", "r", _k, _WI), 6), f"index_max_drawdown_{_k}d": (f"close / ({roll('max', 'close', _k, _WI)}) - 1", 6), f"index_close_to_high_{_k}d": (f"close / ({roll('max', 'high', _k, _WI)}) - 1", 6), f"index_amount_mean_{_k}d": (roll("avg", "amount", _k, _WI), 2)}
_reg |= {
    "index_amount_shock_5d_vs_20d": (f"({roll('avg', 'amount', 5, _WI)}) / ({roll('avg', 'amount', 20, _WI)})", 6), "index_pe_ttm": ("valuation_pe_ttm", 6),
    "index_pe_ttm_z_60d": (f"(valuation_pe_ttm - ({roll('avg', 'valuation_pe_ttm', 60, _WI)})) / nullif(({roll('stddev_samp', 'valuation_pe_ttm', 60, _WI)}), 0)", 5),
    "index_pe_ttm_pct_rank_60d": (f"CASE WHEN len(seen) = 60 THEN (len(list_filter(seen, lambda x: x < valuation_pe_ttm)) + (len(list_filter(seen, lambda x: x = valuation_pe_ttm)) + 1) / 2.0) / 60 END", 6),
}
register("g_market_regime", lambda s, d: even(features.market_regime(src.index_panel(s, d)), ["date", "index_id"], {k: v[1] for k, v in _reg.items()}),
         f"WITH {INDEX}, ib AS (SELECT *, {chg('close', 1, _WI)} AS r, list(valuation_pe_ttm) OVER ({_WI} ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS seen FROM idx) SELECT date, index_id, " + even_sql(_reg) + " FROM ib")

# cross sections -------------------------------------------------------------------------------------------------------------------


def _x(name: str, column: Callable[[], F.Column], sql: str, digits: int = 6) -> None:
    register(name, lambda s, d: rnd(_feat(s, d).withColumn("value", column()), ["date", "asset"], {"value": digits}), f"WITH {FEAT}, x AS (SELECT date, asset, {sql} AS value FROM feat) SELECT date, asset, round(value, {digits}) + 0.0 AS value FROM x")


_win = lambda x: f"CASE WHEN {x} IS NOT NULL THEN greatest(quantile_cont({x}, 0.01) OVER (PARTITION BY date), least(quantile_cont({x}, 0.99) OVER (PARTITION BY date), {x})) END"
_z = lambda x, sd="stddev_pop", flat="0.0": f"CASE WHEN coalesce({sd}({x}) OVER (PARTITION BY date), 0) = 0 THEN {flat} ELSE ({x} - avg({x}) OVER (PARTITION BY date)) / {sd}({x}) OVER (PARTITION BY date) END"
_x("x1_winsorize", lambda: signals.winsorize(C("ret_20d")), _win("ret_20d"))
_x("x2_zscore", lambda: signals.zscore(C("ret_20d")), _z("ret_20d"))
_x("x3_rank", lambda: signals.rank(C("ret_20d")), rnk("ret_20d"))
_s, _ok = "ln(greatest(market_cap, 1e-12))", "ret_20d IS NOT NULL AND market_cap IS NOT NULL"
register("x4_neutralize_by_size", lambda s, d: rnd(_feat(s, d).withColumn("value", signals.neutralize_by_size(C("ret_20d"), C("market_cap"))), ["date", "asset"], {"value": 6}),
         f"""WITH {FEAT}, p AS (SELECT date, asset, CASE WHEN {_ok} THEN ret_20d END AS y, CASE WHEN {_ok} THEN {_s} END AS s FROM feat),
         g AS (SELECT date, count(y) AS n, avg(y) AS my, avg(s) AS ms, CASE WHEN var_pop(s) > 1e-18 THEN covar_pop(y, s) / var_pop(s) ELSE 0 END AS b FROM p GROUP BY date)
         SELECT date, asset, round(CASE WHEN n >= 2 THEN y - my - b * (s - ms) END, 6) + 0.0 AS value FROM p JOIN g USING (date)""")
_x("x5_neutralize_by_group", lambda: signals.neutralize_by_group(C("ret_20d")), "ret_20d - avg(ret_20d) OVER (PARTITION BY date, grp)")
_x("x6_linear_combine", lambda: signals.linear_combine(None, {"ret_20d": 1.0, "vol_20d": -0.5}), "CASE WHEN ret_20d IS NOT NULL OR vol_20d IS NOT NULL THEN coalesce(ret_20d, 0) - 0.5 * coalesce(vol_20d, 0) END")
_ALPHA = f"CASE WHEN ({rnk('ret_20d')}) IS NULL AND ({_z('vol_20d')}) IS NULL THEN NULL ELSE coalesce({rnk('ret_20d')}, 0) - 0.5 * coalesce({_z('vol_20d')}, 0) END"
register("x8_demo_alpha", lambda s, d: rnd(signals.demo_alpha(_feat(s, d)), ["date", "asset"], {"signal": 6}), f"WITH {FEAT}, x AS (SELECT date, asset, {_ALPHA} AS signal FROM feat) SELECT date, asset, round(signal, 6) + 0.0 AS signal FROM x")
_x("x10_zscore_sample", lambda: signals.zscore(C("ret_20d"), ddof=1), _z("ret_20d", "stddev_samp"))
_CAND = {"mom_20d": ("ret_20d", 1), "rev_5d": ("ret_5d", -1), "low_vol": ("vol_20d", -1), "liquidity": ("amount_20d", 1), "size": ("market_cap", 1)}
_LONG = " UNION ALL ".join(f"SELECT '{n}' AS signal_name, date, asset, {c} * {v} AS raw, fwd_ret_5d, fwd_ret_20d FROM feat" for n, (c, v) in _CAND.items())
register("x11_signed_candidates", lambda s, d: rnd(signals.signed_candidates(_feat(s, d), _CAND), ["signal_name", "date", "asset"], {"value": 6}), f"WITH {FEAT}, l AS ({_LONG}) SELECT signal_name, date, asset, round({rnk('raw', 'signal_name, date')}, 6) AS value FROM l")
_EXP = f"""{FEAT}, e0 AS (SELECT date, asset, vol_20d AS v, CASE WHEN amount_20d > 0 THEN ln(amount_20d) END AS l, CASE WHEN market_cap > 0 THEN ln(market_cap) END AS c, ret_20d, fwd_ret_5d FROM feat),
  ex AS (SELECT date, asset, ret_20d, fwd_ret_5d, {_z('v', flat='NULL')} AS vol_20d_z, {_z('l', flat='NULL')} AS liquidity_z, {_z('c', flat='NULL')} AS size_z FROM e0)"""
_EC = {"vol_20d_z": 6, "liquidity_z": 6, "size_z": 6}
register("x12_risk_exposures", lambda s, d: rnd(signals.risk_exposures(_feat(s, d)), ["date", "asset"], _EC), f"WITH {_EXP} SELECT {rounded(_EC, 'date, asset')} FROM ex")
register("x13_condition_buckets", lambda s, d: signals.condition_buckets(signals.risk_exposures(_feat(s, d)).select("date", "asset", *[F.round(c, 9).alias(c) for c in _EC]), list(_EC)).select("date", "asset", *[f"{c}_bucket" for c in _EC]),
         f"WITH {_EXP}, r AS (SELECT date, asset, round(vol_20d_z, 9) AS vol_20d_z, round(liquidity_z, 9) AS liquidity_z, round(size_z, 9) AS size_z FROM ex) SELECT date, asset, " + ", ".join(f"{qcut(c, 3, 3)} AS {c}_bucket" for c in _EC) + " FROM r")
register("x14_quantiles", lambda s, d: _feat(s, d).select("date", "asset", expr.qcut_first(C("ret_20d"), 5, "date", least=5).alias("quantile")), f"WITH {FEAT} SELECT date, asset, {qcut('ret_20d', 5, 5)} AS quantile FROM feat")

# diagnostics ----------------------------------------------------------------------------------------------------------------------

_RIC = f"""pairs AS (SELECT date, {rnk('x', pct=False)} AS x, {rnk('y', pct=False)} AS y FROM (SELECT date, CASE WHEN ret_20d IS NOT NULL AND fwd_ret_5d IS NOT NULL THEN ret_20d END AS x, CASE WHEN ret_20d IS NOT NULL AND fwd_ret_5d IS NOT NULL THEN fwd_ret_5d END AS y FROM feat)),
  ric AS (SELECT date, {corr('x', 'y')} AS ic, count(x) AS n FROM pairs GROUP BY date)"""
_SUMM = "avg(ic) AS mean_ic, median(ic) AS median_ic, stddev_samp(ic) AS std_ic, avg(ic) / nullif(stddev_samp(ic), 0) AS icir, avg(ic) / nullif(stddev_samp(ic) / sqrt(count(ic)), 0) AS t_stat, avg(CASE WHEN ic IS NOT NULL THEN (round(ic, 12) > 0)::INTEGER END) AS positive_rate, count(ic) AS n_dates"
_SC = {"mean_ic": 6, "median_ic": 6, "std_ic": 6, "icir": 6, "t_stat": 5, "positive_rate": 6}
register("d1_daily_ic", lambda s, d: rnd(diagnostics.daily_ic(_feat(s, d), "ret_20d", "fwd_ret_5d"), ["date", "n"], {"ic": 6}), f"WITH {FEAT} SELECT date, count(*) FILTER (WHERE ret_20d IS NOT NULL AND fwd_ret_5d IS NOT NULL) AS n, round({corr('ret_20d', 'fwd_ret_5d')}, 6) + 0.0 AS ic FROM feat GROUP BY date")
register("d2_daily_rank_ic", lambda s, d: rnd(diagnostics.daily_ic(_feat(s, d), "ret_20d", "fwd_ret_5d", "spearman"), ["date", "n"], {"ic": 6}), f"WITH {FEAT}, {_RIC} SELECT date, n, round(ic, 6) + 0.0 AS ic FROM ric")
register("d5_rank_ic_summary", lambda s, d: rnd(diagnostics.summarize_ic(diagnostics.daily_ic(_feat(s, d), "ret_20d", "fwd_ret_5d", "spearman")), ["n_dates"], _SC), f"WITH {FEAT}, {_RIC}, x AS (SELECT {_SUMM} FROM ric) SELECT {rounded(_SC, 'n_dates')} FROM x")
_NAMES = ["ret_5d", "ret_20d", "vol_20d", "amount_20d"]
_FLONG = " UNION ALL ".join(f"SELECT '{c}' AS factor, date, asset, {c}::DOUBLE AS value, fwd_ret_5d FROM feat" for c in _NAMES)
_FIC = f"""fl AS ({_FLONG}), fp AS (SELECT factor, date, CASE WHEN value IS NOT NULL AND fwd_ret_5d IS NOT NULL THEN value END AS x, CASE WHEN value IS NOT NULL AND fwd_ret_5d IS NOT NULL THEN fwd_ret_5d END AS y FROM fl),
  fr AS (SELECT factor, date, {rnk('x', 'factor, date', False)} AS x, {rnk('y', 'factor, date', False)} AS y FROM fp), fic AS (SELECT factor, date, CASE WHEN count(x) >= 10 THEN {corr('x', 'y')} END AS ic, count(x) AS n FROM fr GROUP BY 1, 2)"""


def _fic(s, d):
    f = _feat(s, d)
    return diagnostics.daily_ic(diagnostics.long_form(f, _NAMES, ("date", "asset", "fwd_ret_5d")), "value", "fwd_ret_5d", "spearman", ("factor", "date"), 10)


register("d6_factor_ic", lambda s, d: rnd(_fic(s, d), ["factor", "date", "n"], {"ic": 6}), f"WITH {FEAT}, {_FIC} SELECT factor, date, n, round(ic, 6) + 0.0 AS ic FROM fic")
register("d7_factor_ic_summary", lambda s, d: rnd(diagnostics.summarize_ic(_fic(s, d), "factor"), ["factor", "n_dates"], _SC), f"WITH {FEAT}, {_FIC}, x AS (SELECT factor, {_SUMM} FROM fic GROUP BY factor) SELECT {rounded(_SC, 'factor, n_dates')} FROM x")


def _cond(s, d):
    f = _feat(s, d)
    e = signals.risk_exposures(f, keep=("ret_20d", "fwd_ret_5d")).withColumn("vol_20d_z", F.round("vol_20d_z", 9))
    b = signals.condition_buckets(e, ["vol_20d_z"]).withColumnRenamed("vol_20d_z_bucket", "bucket")
    return diagnostics.conditioned_ic(b, "bucket", "ret_20d", "fwd_ret_5d")


register("d8_conditioned_rank_ic", lambda s, d: rnd(_cond(s, d), ["bucket", "n_dates"], _SC | {"avg_n_assets": 6}),
         f"""WITH {_EXP}, b AS (SELECT date, {qcut('v', 3, 3)} AS bucket, CASE WHEN ret_20d IS NOT NULL AND fwd_ret_5d IS NOT NULL THEN ret_20d END AS x, CASE WHEN ret_20d IS NOT NULL AND fwd_ret_5d IS NOT NULL THEN fwd_ret_5d END AS y FROM (SELECT *, round(vol_20d_z, 9) AS v FROM ex)),
         r AS (SELECT date, bucket, {rnk('x', 'date, bucket', False)} AS x, {rnk('y', 'date, bucket', False)} AS y FROM b WHERE bucket IS NOT NULL), i AS (SELECT date, bucket, {corr('x', 'y')} AS ic, count(x) AS n FROM r GROUP BY 1, 2),
         q AS (SELECT bucket, avg(n) AS avg_n_assets, {_SUMM} FROM i GROUP BY bucket) SELECT {rounded(_SC | {'avg_n_assets': 6}, 'bucket, n_dates')} FROM q""")
_QR = f"q0 AS (SELECT date, asset, ret_20d, fwd_ret_5d FROM feat WHERE ret_20d IS NOT NULL AND fwd_ret_5d IS NOT NULL), q1 AS (SELECT *, {qcut('ret_20d', 5, 5)} AS quantile FROM q0), qr AS (SELECT date, quantile, avg(fwd_ret_5d) AS mean_ret, count(*) AS n FROM q1 WHERE quantile IS NOT NULL GROUP BY 1, 2)"
register("d11_quantile_returns", lambda s, d: rnd(diagnostics.quantile_returns(_feat(s, d), "ret_20d", "fwd_ret_5d"), ["date", "quantile", "n"], {"mean_ret": 6}), f"WITH {FEAT}, {_QR} SELECT date, quantile, n, round(mean_ret, 6) + 0.0 AS mean_ret FROM qr")
_SP = {"mean_spread": 6, "mean_top_excess": 6, "t_stat": 5}
register("d12_quantile_spread", lambda s, d: rnd(diagnostics.quantile_spread(diagnostics.quantile_returns(_feat(s, d), "ret_20d", "fwd_ret_5d")), ["n_dates"], _SP),
         f"WITH {FEAT}, {_QR}, dd AS (SELECT date, max(mean_ret) FILTER (WHERE quantile = 5) AS t, max(mean_ret) FILTER (WHERE quantile = 1) AS b, avg(mean_ret) AS m FROM qr GROUP BY date), x AS (SELECT avg(t - b) AS mean_spread, avg(t - m) AS mean_top_excess, avg(t - b) / (stddev_samp(t - b) / sqrt(count(t - b))) AS t_stat, count(t - b) AS n_dates FROM dd) SELECT {rounded(_SP, 'n_dates')} FROM x")
register("d9_edge_quantile_returns", lambda s, d: rnd(diagnostics.edge_quantile_returns(_feat(s, d).withColumn("ret_20d", F.round("ret_20d", 9)), "ret_20d", "fwd_ret_5d"), ["date", "quantile"], {"mean_ret": 6}),
         f"""WITH {FEAT}, q0 AS (SELECT date, round(ret_20d, 9) AS x, fwd_ret_5d FROM feat WHERE ret_20d IS NOT NULL AND fwd_ret_5d IS NOT NULL),
         e AS (SELECT date, list_distinct(quantile_cont(x, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])) AS edges FROM q0 GROUP BY date HAVING min(x) < max(x))
         SELECT date, greatest(1, len(list_filter(edges, lambda v: v < x)))::INTEGER AS quantile, round(avg(fwd_ret_5d), 6) + 0.0 AS mean_ret FROM q0 JOIN e USING (date) GROUP BY 1, 2""")
register("d14_pairwise_correlation", lambda s, d: rnd(diagnostics.factor_correlation(_feat(s, d), _NAMES), ["a", "b", "n_obs"], {"corr": 6}),
         f"WITH {FEAT} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n_obs, round({corr(a, b)}, 6) + 0.0 AS corr FROM feat" for i, a in enumerate(_NAMES) for b in _NAMES[i + 1 :]))
register("d17_coverage", lambda s, d: rnd(diagnostics.coverage(_feat(s, d), _NAMES), ["factor", "n_total", "n_non_null", "n_dates", "n_assets"], {"coverage": 6}),
         f"WITH {FEAT}, fl AS ({_FLONG}) SELECT factor, count(*) AS n_total, count(value) AS n_non_null, count(DISTINCT date) FILTER (WHERE value IS NOT NULL) AS n_dates, count(DISTINCT asset) FILTER (WHERE value IS NOT NULL) AS n_assets, round(count(value)::DOUBLE / count(*), 6) AS coverage FROM fl GROUP BY factor")
_PC = {"mean": 3, "std": 3, "min": 3, "max": 3} | {f"p{q:02d}": 3 for q in (1, 5, 25, 50, 75, 95, 99)}
register("d18_distribution", lambda s, d: rnd(diagnostics.distribution(_feat(s, d), _NAMES), ["factor"], _PC),
         f"WITH {FEAT}, fl AS ({_FLONG}) SELECT factor, round(avg(value), 3) + 0.0 AS mean, round(stddev_samp(value), 3) AS std, round(min(value), 3) + 0.0 AS min, round(max(value), 3) + 0.0 AS max, " + ", ".join(f"round(quantile_cont(value, {q / 100}), 3) + 0.0 AS p{q:02d}" for q in (1, 5, 25, 50, 75, 95, 99)) + " FROM fl GROUP BY factor")
register("d20_autocorrelation", lambda s, d: rnd(diagnostics.autocorrelation(_feat(s, d), "ret_20d"), ["date"], {"autocorr": 6}), f"WITH {FEAT}, l AS (SELECT date, ret_20d AS x, lag(ret_20d) OVER ({W}) AS y FROM feat) SELECT date, round({corr('x', 'y')}, 6) + 0.0 AS autocorr FROM l GROUP BY date")
_TOP = "dts AS (SELECT date, row_number() OVER (ORDER BY date) AS i FROM (SELECT DISTINCT date FROM feat WHERE ret_20d IS NOT NULL)), tp AS (SELECT date, asset FROM (SELECT date, asset, row_number() OVER (PARTITION BY date ORDER BY ret_20d DESC, asset) AS p FROM feat WHERE ret_20d IS NOT NULL) WHERE p <= 10), ti AS (SELECT * FROM tp JOIN dts USING (date))"
register("d21_top_n_turnover", lambda s, d: rnd(diagnostics.top_n_turnover(_feat(s, d), "ret_20d", 10), ["date"], {"turnover": 6}), f"WITH {FEAT}, {_TOP} SELECT a.date, round(1 - count(b.asset) / 10.0, 6) AS turnover FROM ti a LEFT JOIN ti b ON a.asset = b.asset AND a.i = b.i + 1 GROUP BY a.date")
register("d22_size_exposure", lambda s, d: rnd(diagnostics.size_exposure(_feat(s, d), "ret_20d"), ["date"], {"size_exposure": 6}), f"WITH {FEAT}, l AS (SELECT date, ret_20d AS x, CASE WHEN market_cap > 0 THEN ln(market_cap) END AS y FROM feat) SELECT date, round({corr('x', 'y')}, 6) + 0.0 AS size_exposure FROM l GROUP BY date")
register("d23_group_exposure", lambda s, d: rnd(diagnostics.group_exposure(_feat(s, d), "ret_20d"), ["date", "grp"], {"mean_signal": 6}), f"WITH {FEAT} SELECT date, grp, round(avg(ret_20d), 6) + 0.0 AS mean_signal FROM feat GROUP BY date, grp")

# universe ---------------------------------------------------------------------------------------------------------------------------

register("p1_eligibility", lambda s, d: (f := _feat(s, d)).select("date", "asset", universe.eligibility(f, ["ret_20d"], floors={"amount_20d": 500000.0, "market_cap": 22000.0}).alias("eligible")), f"WITH {FEAT} SELECT date, asset, coalesce(ret_20d IS NOT NULL AND round(amount_20d, 3) >= 500000 AND market_cap >= 22000 AND is_tradable, false) AS eligible FROM feat")
register("p3_tradability", lambda s, d: universe.tradability(src.daily_panel(s, d)),
         f"WITH {PANEL} SELECT date, asset, high >= greatest(open, low, close) AND low <= least(open, high, close) AS valid_ohlc, volume > 0 AND amount > 0 AS traded, high >= greatest(open, low, close) AND low <= least(open, high, close) AND volume > 0 AND amount > 0 AS tradable FROM panel")
_SNAP = "snap AS (SELECT DISTINCT last_day(l_shipdate) AS snapshot_date, l_suppkey::VARCHAR AS asset FROM lineitem)"
register("j4_members_asof", lambda s, d: universe.members_asof(src.member_snapshots(s, d), "1998-05-15"), f"WITH {_SNAP} SELECT snapshot_date, asset FROM snap WHERE snapshot_date = (SELECT max(snapshot_date) FROM snap WHERE snapshot_date <= DATE '1998-05-15')")
register("j5_pit_universe", lambda s, d: universe.pit_mask(src.daily_panel(s, d).select("date", "asset"), src.member_snapshots(s, d)),
         f"WITH {PANEL}, {_SNAP}, m AS (SELECT date, (SELECT max(snapshot_date) FROM snap WHERE snapshot_date <= date) AS snapshot_date FROM (SELECT DISTINCT date FROM panel)) SELECT p.date, p.asset FROM panel p JOIN m USING (date) JOIN snap s ON s.snapshot_date = m.snapshot_date AND s.asset = p.asset")


def _events(s, d):
    o = src.table(s, d, "orders").where(C("o_orderpriority") == "1-URGENT").select("o_orderkey")
    lines = src.table(s, d, "lineitem").join(o, C("l_orderkey") == C("o_orderkey"))
    return lines.select(C("l_suppkey").cast("string").alias("asset"), F.to_date("l_shipdate").alias("event_date")).distinct()


register("j7_event_window", lambda s, d: universe.event_window(src.daily_panel(s, d), _events(s, d), 2, 3),
         f"""WITH {PANEL}, ev AS (SELECT DISTINCT l_suppkey::VARCHAR AS asset, l_shipdate::DATE AS event_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT'),
         r AS (SELECT asset, date, row_number() OVER ({W}) AS i FROM panel), a AS (SELECT e.asset, e.event_date, min(r.i) AS at FROM ev e JOIN r ON r.asset = e.asset AND r.date >= e.event_date GROUP BY 1, 2)
         SELECT a.asset, a.event_date, r.date, (r.i - a.at)::INTEGER AS "offset" FROM a JOIN r ON r.asset = a.asset AND r.i BETWEEN a.at - 2 AND a.at + 3""")


def _industry(s, d):
    lines = src.table(s, d, "lineitem")
    return lines.groupBy(C("l_suppkey").cast("string").alias("asset"), F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("start_date")).agg((F.min("l_partkey") % 5).alias("grp"))


register("j6_group_asof", lambda s, d: universe.group_asof(src.daily_panel(s, d).select("date", "asset"), _industry(s, d)),
         f"""WITH {PANEL}, h AS (SELECT l_suppkey::VARCHAR AS asset, date_trunc('quarter', l_shipdate)::DATE AS start_date, min(l_partkey) % 5 AS grp FROM lineitem GROUP BY 1, 2)
         SELECT p.date, p.asset, h.grp AS asof_grp FROM (SELECT date, asset FROM panel) p ASOF LEFT JOIN h ON p.asset = h.asset AND p.date >= h.start_date""")

# portfolio and backtest -------------------------------------------------------------------------------------------------------------


def _sig(s, d):
    return _feat(s, d).withColumn("signal", F.round(signals.rank(C("ret_20d")), 9))


_SIG = f"{FEAT}, sig AS (SELECT *, round({rnk('ret_20d')}, 9) AS signal FROM feat)"
_WTS = "w0 AS (SELECT date, asset, row_number() OVER (PARTITION BY date ORDER BY signal DESC, asset) <= 10 AS top FROM sig WHERE signal IS NOT NULL), wts AS (SELECT date, asset, CASE WHEN top THEN 1.0::DOUBLE / sum(top::INTEGER) OVER (PARTITION BY date) ELSE 0.0 END AS weight FROM w0)"
register("b1_top_n", lambda s, d: rnd(portfolio.build_top_n(_sig(s, d), 10), ["date", "asset"], {"weight": 6}), f"WITH {_SIG}, {_WTS} SELECT date, asset, round(weight, 6) AS weight FROM wts")
register("b1_long_short", lambda s, d: rnd(portfolio.build_top_n(_sig(s, d), 10, bottom_n=5), ["date", "asset"], {"weight": 6}),
         f"""WITH {_SIG}, w0 AS (SELECT date, asset, signal, row_number() OVER (PARTITION BY date ORDER BY signal DESC, asset) <= 10 AS top FROM sig WHERE signal IS NOT NULL),
         w1 AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY top, signal, asset) <= 5 AND NOT top AS low FROM w0)
         SELECT date, asset, round(CASE WHEN top THEN 1.0 / sum(top::INTEGER) OVER (PARTITION BY date) WHEN low THEN -1.0 / sum(low::INTEGER) OVER (PARTITION BY date) ELSE 0.0 END, 6) AS weight FROM w1""")
register("b2_size_aware", lambda s, d: rnd(portfolio.build_top_n(_sig(s, d), 10, size_aware=True), ["date", "asset"], {"weight": 6}),
         f"""WITH {_SIG}, {_WTS}, z AS (SELECT w.date, w.asset, w.weight, ln(greatest(s.market_cap, 1e-12)) AS lg FROM wts w JOIN sig s USING (date, asset)), y AS (SELECT date, asset, weight * (1 + 0.5 * lg / max(abs(lg)) OVER (PARTITION BY date)) AS v FROM z)
         SELECT date, asset, round(v / sum(v) OVER (PARTITION BY date), 6) AS weight FROM y""")


def _liquid(s, d):
    return _sig(s, d).withColumn("liquidity", C("amount_20d"))


_LQ = "lq AS (SELECT *, coalesce(amount_20d >= 110000, false) AS fits FROM sig WHERE signal IS NOT NULL), lt AS (SELECT *, fits AND row_number() OVER (PARTITION BY date ORDER BY fits DESC, signal DESC, asset) <= 10 AS top FROM lq)"
register("p4_liquidity", lambda s, d: rnd(portfolio.build_top_n(_liquid(s, d), 10, min_liquidity=110000.0), ["date", "asset"], {"weight": 6}),
         f"WITH {_SIG}, {_LQ} SELECT date, asset, round(CASE WHEN top THEN 1.0 / sum(top::INTEGER) OVER (PARTITION BY date) ELSE 0.0 END, 6) AS weight FROM lt")
_CAP = """z0 AS (SELECT date, asset, grp, CASE WHEN top THEN 1.0::DOUBLE / sum(top::INTEGER) OVER (PARTITION BY date) ELSE 0.0 END AS w, ln(greatest(market_cap, 1e-12)) AS lg FROM lt),
  z1 AS (SELECT date, asset, grp, least(0.102, greatest(-0.102, w * (1 + 0.5 * coalesce(lg / nullif(max(abs(lg)) OVER (PARTITION BY date), 0), 0)))) AS w FROM z0), z2 AS (SELECT date, asset, grp, coalesce(w / nullif(sum(w) OVER (PARTITION BY date), 0), 0) AS w FROM z1)"""
register("b3_capped_size_aware", lambda s, d: rnd(portfolio.build_top_n(_liquid(s, d), 10, min_liquidity=110000.0, size_aware=True, max_weight=0.102), ["date", "asset"], {"weight": 6}),
         f"WITH {_SIG}, {_LQ}, {_CAP} SELECT date, asset, round(w, 6) + 0.0 AS weight FROM z2")
_round_sql = lambda i: f"g{i} AS (SELECT date, grp, m * (CASE WHEN t > 0.3 THEN 0.3 / t ELSE 1 END) / nullif(sum(least(t, 0.3)) OVER (PARTITION BY date), 0) AS m, least(t, 0.3) / nullif(sum(least(t, 0.3)) OVER (PARTITION BY date), 0) AS t FROM g{i - 1})"
register("b4_group_cap", lambda s, d: rnd(portfolio.build_top_n(_liquid(s, d), 10, min_liquidity=110000.0, size_aware=True, max_weight=0.102, group_cap=0.3), ["date", "asset"], {"weight": 6}),
         f"WITH {_SIG}, {_LQ}, {_CAP}, g0 AS (SELECT date, grp, 1.0::DOUBLE AS m, sum(w) AS t FROM z2 GROUP BY 1, 2), {', '.join(_round_sql(i) for i in range(1, 9))}, y AS (SELECT z2.date, asset, w * coalesce(m, 0) AS w FROM z2 JOIN g8 ON z2.date = g8.date AND z2.grp IS NOT DISTINCT FROM g8.grp) SELECT date, asset, round(coalesce(w / nullif(sum(w) OVER (PARTITION BY date), 0), 0), 6) + 0.0 AS weight FROM y")
_HELD = f"""{_SIG}, {_WTS}, rb AS (SELECT max(date) AS date FROM (SELECT DISTINCT date FROM wts) GROUP BY date_trunc('month', date)), grid AS (SELECT d.date, a.asset FROM (SELECT DISTINCT date FROM wts) d, (SELECT DISTINCT asset FROM wts) a),
  gw AS (SELECT g.date, g.asset, k.weight AS kw FROM grid g LEFT JOIN (SELECT w.* FROM wts w JOIN rb USING (date)) k ON g.date = k.date AND g.asset = k.asset),
  held AS (SELECT date, asset, coalesce(last_value(kw IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS weight FROM gw)"""


def _held(s, d):
    sig = _sig(s, d).select("date", "asset", "signal").where("signal is not null")
    return portfolio.hold_between(portfolio.build_top_n(portfolio.on_rebalance_dates(sig, "M"), 10), "M", sig)


register(
    "b6_hold_between",
    lambda s, d: rnd(_held(s, d), ["date", "asset"], {"weight": 6}),
    f"WITH {_HELD} SELECT date, asset, round(weight, 6) AS weight FROM held",
)
_BT = f"""nx AS (SELECT date, asset, lead(ret_1d) OVER ({W}) AS nr FROM feat), g AS (SELECT h.date, sum(weight * nr) AS gross FROM held h JOIN nx USING (date, asset) GROUP BY h.date),
  di AS (SELECT date, row_number() OVER (ORDER BY date) AS i FROM (SELECT DISTINCT date FROM held)), hv AS (SELECT i, asset, weight FROM held JOIN di USING (date)),
  mv AS (SELECT i, sum(abs(d)) AS turnover FROM (SELECT i, asset, sum(v) AS d FROM (SELECT i, asset, weight AS v FROM hv UNION ALL SELECT i + 1, asset, -weight FROM hv) GROUP BY 1, 2) GROUP BY 1),
  bt AS (SELECT di.date, gross, turnover, turnover * 5.0 / 1e4 AS cost, coalesce(gross, 0) - turnover * 5.0 / 1e4 AS net FROM di JOIN mv USING (i) LEFT JOIN g USING (date))"""


def _bt(s, d):
    sig = _sig(s, d)
    marked = portfolio.build_top_n(portfolio.on_rebalance_dates(sig, "M"), 10)
    return portfolio.held_backtest(marked, sig.select("date", "asset", "ret_1d"), sig.where("signal is not null"))


_BC = {"gross": 6, "turnover": 6, "cost": 8, "net": 6}
register("b7_backtest", lambda s, d: rnd(_bt(s, d), ["date"], _BC), f"WITH {_HELD}, {_BT} SELECT {rounded(_BC, 'date')} FROM bt")
_PF = {"total_return": 4, "annual_return": 4, "annual_vol": 4, "max_drawdown": 5, "sharpe": 4}
_PERF = "cv AS (SELECT date, net, product(1 + net) OVER (ORDER BY date) AS c FROM bt), dw AS (SELECT *, c / max(c) OVER (ORDER BY date) - 1 AS dd FROM cv), pf AS (SELECT product(1 + net) - 1 AS total_return, CASE WHEN product(1 + net) > 0 THEN pow(product(1 + net), 252.0 / count(*)) - 1 ELSE -1 END AS annual_return, stddev_pop(net) * sqrt(252.0) AS annual_vol, min(dd) AS max_drawdown, count(*) AS n_days FROM dw), ps AS (SELECT *, CASE WHEN annual_vol > 0 THEN annual_return / annual_vol ELSE 0 END AS sharpe FROM pf)"
register("b11_performance", lambda s, d: portfolio.performance(_bt(s, d), "net").select("n_days", *[F.round(F.signum(c) * F.log1p(F.abs(c)), n).alias(c) for c, n in _PF.items()]),
         f"WITH {_HELD}, {_BT}, {_PERF} SELECT n_days, " + ", ".join(f"round(sign({c}) * ln(1 + abs({c})), {n}) + 0.0 AS {c}" for c, n in _PF.items()) + " FROM ps")
_BEN = f"""{FEAT}, rb AS (SELECT max(date) AS date FROM (SELECT DISTINCT date FROM feat) GROUP BY date_trunc('month', date)), mk AS (SELECT d.date, max(rb.date) OVER (ORDER BY d.date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hf FROM (SELECT DISTINCT date FROM feat) d LEFT JOIN rb USING (date)),
  nm AS (SELECT date AS hf, asset, count(*) OVER (PARTITION BY date) AS k FROM feat JOIN rb USING (date)), bn AS (SELECT mk.date, sum(f.ret_1d / nm.k) AS b FROM mk JOIN feat f ON f.date = mk.date JOIN nm ON nm.hf = mk.hf AND nm.asset = f.asset GROUP BY mk.date)"""
register("r4_equal_weight_benchmark", lambda s, d: rnd(portfolio.equal_weight_benchmark(_feat(s, d).select("date", "asset", "ret_1d"), "M"), ["date"], {"bench_ret": 6}), f"WITH {_BEN} SELECT mk.date, round(coalesce(b, 0), 6) + 0.0 AS bench_ret FROM mk LEFT JOIN bn ON mk.date = bn.date")


def _ranked(s, d):
    f = _feat(s, d).where("ret_20d is not null")
    place = F.row_number().over(Window.partitionBy("date").orderBy(C("score").desc(), "asset"))
    return f.withColumn("score", F.round("ret_20d", 9)).select("date", "asset", "score", "is_tradable").withColumn("rank", place)


_POL = {"strict": rebalance.BufferedConfig(10, 10, 10, 10, 10, max_weight=None, min_trade_weight=0.0, freq="M"), "buffered": rebalance.BufferedConfig(10, 8, 20, 5, 12, max_weight=0.2, min_trade_weight=0.01, freq="M")}
_RK = "rk AS (SELECT date, asset, score, is_tradable, row_number() OVER (PARTITION BY date ORDER BY score DESC, asset) AS rank FROM (SELECT date, asset, round(ret_20d, 9) AS score, is_tradable FROM feat WHERE ret_20d IS NOT NULL))"
# the recursion over holdings: a rank is the place in the date's list of names; every name of the given tables is tradable
_BOOKS = f"""{FEAT}, {_RK}, md AS (SELECT max(date) AS date FROM (SELECT DISTINCT date FROM rk) GROUP BY date_trunc('month', date)), m AS (SELECT rk.* FROM rk JOIN md USING (date)),
  dd AS (SELECT date, row_number() OVER (ORDER BY date)::INTEGER AS i, list(asset ORDER BY rank) AS names FROM m GROUP BY date),
  pol AS ({" UNION ALL ".join(f"SELECT '{k}' AS portfolio_id, {c.target_n} AS tn, {c.buy_rank} AS br, {c.sell_rank} AS sr, {c.min_holding_n} AS mn, {c.min_trade_weight}::DOUBLE AS mt" for k, c in _POL.items())}),
  st AS (SELECT portfolio_id, 0 AS i, NULL::DATE AS date, []::STRUCT(a VARCHAR, w DOUBLE)[] AS prev, []::STRUCT(a VARCHAR, w DOUBLE)[] AS book, []::VARCHAR[] AS gone, []::VARCHAR[] AS small FROM pol UNION ALL
    SELECT portfolio_id, i, date, old, list_transform(nb, lambda b: {{'a': b.a, 'w': b.w / list_sum(list_transform(nb, lambda z: z.w))}})::STRUCT(a VARCHAR, w DOUBLE)[], gone, small FROM (
      SELECT *, list_filter(list_transform(moves, lambda v: {{'a': v.a, 'w': CASE WHEN abs(v.g - v.p) < mt THEN v.p ELSE v.g END}}), lambda b: b.w > 0) AS nb, list_transform(list_filter(moves, lambda v: abs(v.g - v.p) < mt), lambda v: v.a) AS small FROM (
        SELECT *, list_transform(list_distinct(sel || list_transform(old, lambda b: b.a)), lambda a: {{'a': a, 'g': CASE WHEN list_contains(sel, a) THEN 1.0::DOUBLE / len(sel) ELSE 0.0 END, 'p': coalesce(list_filter(old, lambda b: b.a = a)[1].w, 0.0)}}) AS moves FROM (
          SELECT *, CASE WHEN len(old) = 0 OR len(kept) < mn THEN kept || list_filter(names[1:br], lambda a: NOT list_contains(kept, a))[1:tn - len(kept)] ELSE kept END AS sel FROM (
            SELECT pol.*, dd.i, dd.date, dd.names, st.book AS old, list_filter(list_transform(st.book, lambda b: b.a), lambda a: NOT list_contains(dd.names, a) OR list_position(dd.names, a) <= sr) AS kept,
                   list_filter(list_transform(st.book, lambda b: b.a), lambda a: coalesce(list_position(dd.names, a), 0) > sr) AS gone FROM st JOIN dd ON dd.i = st.i + 1 JOIN pol USING (portfolio_id)))))),
  bk AS (SELECT portfolio_id, date, b.a AS asset, b.w AS weight FROM (SELECT portfolio_id, date, unnest(book) AS b FROM st)), pv AS (SELECT portfolio_id, date, b.a AS asset, b.w AS prev_weight FROM (SELECT portfolio_id, date, unnest(prev) AS b FROM st)),
  sm AS (SELECT portfolio_id, date, unnest(small) AS asset FROM st), gn AS (SELECT portfolio_id, date, unnest(gone) AS asset FROM st),
  ky AS (SELECT portfolio_id, date, asset FROM m, (SELECT portfolio_id FROM pol) UNION SELECT portfolio_id, date, asset FROM bk UNION SELECT portfolio_id, date, asset FROM pv),
  lg AS (SELECT k.*, coalesce(prev_weight, 0) AS prev_weight, coalesce(weight, 0) AS weight, m.rank::INTEGER AS rank,
    CASE WHEN sm.asset IS NOT NULL THEN 'min_trade_filter' WHEN prev_weight IS NULL THEN '' WHEN m.rank IS NULL THEN 'missing_signal' WHEN gn.asset IS NOT NULL THEN 'sell_rank_exceeded' WHEN m.rank <= br THEN 'still_in_buy_zone' ELSE 'in_buffer_zone' END AS reason
    FROM ky k JOIN pol USING (portfolio_id) LEFT JOIN m USING (date, asset) LEFT JOIN pv USING (portfolio_id, date, asset) LEFT JOIN bk USING (portfolio_id, date, asset) LEFT JOIN sm USING (portfolio_id, date, asset) LEFT JOIN gn USING (portfolio_id, date, asset)),
  lo AS (SELECT *, CASE WHEN prev_weight = 0 AND weight > 0 THEN 'buy' WHEN prev_weight > 0 AND weight = 0 THEN 'sell' WHEN prev_weight > 0 AND abs(weight - prev_weight) >= 1e-12 THEN CASE WHEN weight > prev_weight THEN 'add' ELSE 'trim' END ELSE 'keep' END AS action FROM lg)"""
_LW = {"prev_weight": 6, "weight": 6}


def _log(s, d):
    return rebalance.buffered_weights(_ranked(s, d), _POL)


def _named_action():
    """Weights that differ by rounding alone are kept: an action is told by weights of 9 digits."""
    before, now = F.round("prev_weight", 9), F.round("weight", 9)
    return F.when((before == 0) & (now > 0), "buy").when((before > 0) & (now == 0), "sell").when(now > before, "add").when(now < before, "trim").otherwise("keep")


register("r2_buffered_weights", lambda s, d: rnd(_log(s, d).withColumn("action", _named_action()), ["portfolio_id", "date", "asset", "rank", "reason", "action"], _LW),
         f"""WITH RECURSIVE {_BOOKS} SELECT portfolio_id, date, asset, rank, reason, CASE WHEN round(prev_weight, 9) = 0 AND round(weight, 9) > 0 THEN 'buy' WHEN round(prev_weight, 9) > 0 AND round(weight, 9) = 0 THEN 'sell' WHEN round(weight, 9) > round(prev_weight, 9) THEN 'add'
         WHEN round(weight, 9) < round(prev_weight, 9) THEN 'trim' ELSE 'keep' END AS action, round(prev_weight, 6) + 0.0 AS prev_weight, round(weight, 6) + 0.0 AS weight FROM lg""")


def _saved_log(s, d):
    """The log, written once for all that reads it: its recursion runs once."""
    path = scratch(s, "log")
    _log(s, d).write.parquet(path)
    return s.read.parquet(path)


def _policy_daily(s, d, log=None):
    return rebalance.buffered_daily(log or _saved_log(s, d), _feat(s, d).select("date", "asset", "ret_1d"), portfolios=list(_POL))


_PD = {"gross": 6, "turnover": 6, "cost": 8, "net": 6}
_BD = f"""{_BOOKS}, sp AS (SELECT portfolio_id, i, date AS f, lead(date) OVER (PARTITION BY portfolio_id ORDER BY i) AS t FROM st WHERE i > 0), er AS (SELECT b.portfolio_id, f.date, sum(b.weight * f.ret_1d) AS gross FROM bk b JOIN sp ON sp.portfolio_id = b.portfolio_id AND sp.f = b.date JOIN feat f ON f.asset = b.asset AND f.date > sp.f AND (sp.t IS NULL OR f.date <= sp.t) GROUP BY 1, 2),
  tu AS (SELECT portfolio_id, date, sum(abs(weight - prev_weight)) AS turnover FROM lg GROUP BY 1, 2),
  pd AS (SELECT portfolio_id, date, coalesce(gross, 0) AS gross, coalesce(turnover, 0) AS turnover, coalesce(turnover, 0) * 5.0 / 1e4 AS cost, coalesce(gross, 0) - coalesce(turnover, 0) * 5.0 / 1e4 AS net FROM (SELECT date, portfolio_id FROM (SELECT DISTINCT date FROM feat), pol) LEFT JOIN er USING (portfolio_id, date) LEFT JOIN tu USING (portfolio_id, date)),
  cv AS (SELECT portfolio_id, date, net, turnover, cost, product(1 + net) OVER (PARTITION BY portfolio_id ORDER BY date) AS c FROM pd), dw AS (SELECT *, c / max(c) OVER (PARTITION BY portfolio_id ORDER BY date) - 1 AS dd FROM cv),
  pf AS (SELECT portfolio_id, product(1 + net) - 1 AS total_return, CASE WHEN product(1 + net) > 0 THEN pow(product(1 + net), 252.0 / count(*)) - 1 ELSE -1 END AS annual_return, stddev_pop(net) * sqrt(252.0) AS annual_vol, min(dd) AS max_drawdown, count(*) AS n_days, avg(turnover) AS average_turnover, sum(cost) AS total_cost FROM dw GROUP BY 1),
  tr AS (SELECT portfolio_id, count(*) FILTER (WHERE action = 'buy') AS n_buy, count(*) FILTER (WHERE action = 'sell') AS n_sell FROM lo GROUP BY 1),
  cmp AS (SELECT *, CASE WHEN annual_vol > 0 THEN annual_return / annual_vol ELSE 0 END AS sharpe FROM pf JOIN tr USING (portfolio_id))"""
register("r5_policy_daily", lambda s, d: rnd(_policy_daily(s, d), ["portfolio_id", "date"], _PD), f"WITH RECURSIVE {_BD} SELECT {rounded(_PD, 'portfolio_id, date')} FROM pd")


def _comparison(s, d):
    log = _saved_log(s, d)
    return rebalance.compare_policies(log, _policy_daily(s, d, log))


def _resumed_log(s, d):
    """The log in two runs, the second of which goes on from the saved holdings of the first."""
    ranked, first, state = _ranked(s, d), scratch(s, "first"), scratch(s, "state")
    rebalance.buffered_weights(ranked.where(C("date") <= F.lit(_SPLIT).cast("date")), _POL).write.parquet(first)
    rebalance.holdings(s.read.parquet(first)).write.parquet(state)
    rest = rebalance.buffered_weights(ranked.where(C("date") > F.lit(_SPLIT).cast("date")), _POL, s.read.parquet(state), _SPLIT)
    return s.read.parquet(first).unionByName(rest)


#: The end of a month, and so of a period.
_SPLIT = "1998-06-30"
register("r2_resumed_weights", lambda s, d: rnd(_resumed_log(s, d).withColumn("action", _named_action()), ["portfolio_id", "date", "asset", "rank", "reason", "action"], _LW), ORACLE_SQL["r2_buffered_weights"])


_CM = {"total_return": 4, "annual_return": 4, "annual_vol": 4, "max_drawdown": 5, "sharpe": 4, "average_turnover": 6, "total_cost": 6}
_squash = lambda c: F.signum(c) * F.log1p(F.abs(c))
_squash_sql = lambda c, n: f"round(sign({c}) * ln(1 + abs({c})), {n}) + 0.0"
register("r11_policy_comparison", lambda s, d: _comparison(s, d).select("portfolio_id", "n_days", "n_buy", "n_sell", *[F.round(_squash(C(c)), n).alias(c) for c, n in _CM.items()]),
         f"WITH RECURSIVE {_BD} SELECT portfolio_id, n_days, n_buy, n_sell, {', '.join(f'{_squash_sql(c, n)} AS {c}' for c, n in _CM.items())} FROM cmp")
register("r12_summary_metrics", lambda s, d: rebalance.summary_metrics(_comparison(s, d), list(_POL)).select("metric", *[F.round(_squash(C(p)), 4).alias(p) for p in _POL]),
         f"WITH RECURSIVE {_BD}, ul AS (UNPIVOT (SELECT portfolio_id, {', '.join(f'{m}::DOUBLE AS {m}' for m in rebalance.METRICS)} FROM cmp) ON {', '.join(rebalance.METRICS)} INTO NAME metric VALUE value) SELECT metric, "
         + ", ".join(f"{_squash_sql(chr(109) + 'ax(value) FILTER (WHERE portfolio_id = ' + repr(p) + ')', 4)} AS {p}" for p in _POL) + " FROM ul GROUP BY metric")
_df = lambda m: f"(max({m}) FILTER (WHERE portfolio_id = 'buffered') - max({m}) FILTER (WHERE portfolio_id = 'strict'))"
_rd = lambda m: f"((max({m}) FILTER (WHERE portfolio_id = 'strict') - max({m}) FILTER (WHERE portfolio_id = 'buffered')) / nullif(max({m}) FILTER (WHERE portfolio_id = 'strict'), 0))"
register("r12_policy_differences", lambda s, d: rebalance.policy_differences(_comparison(s, d), "buffered", "strict").select("metric", F.round(_squash(C("value")), 4).alias("value")),
         f"WITH RECURSIVE {_BD} " + " UNION ALL ".join(f"SELECT 'buffered_vs_strict_{n}' AS metric, {_squash_sql(q, 4)} AS value FROM cmp" for n, q in [(f"{m}_diff", _df(m)) for m in ("total_return", "sharpe", "max_drawdown")] + [(f"{n}_reduction", _rd(m)) for n, m in (("turnover", "average_turnover"), ("cost", "total_cost"), ("buy", "n_buy"), ("sell", "n_sell"))]))


def _index_curves(s, d):
    return rebalance.index_curve(src.index_panel(s, d).select(C("index_id").cast("string").alias("portfolio_id"), "date", "close"), "portfolio_id")


_IC = f"ix AS (SELECT index_id::VARCHAR AS portfolio_id, date, coalesce(close / nullif(lag(close) OVER (PARTITION BY index_id ORDER BY date), 0) - 1, 0) AS net FROM idx)"
register("r6_index_curve", lambda s, d: rnd(_index_curves(s, d), ["portfolio_id", "date"], {"gross": 6, "net": 6, "cumulative_net": 5}),
         f"WITH {INDEX}, {_IC} SELECT portfolio_id, date, round(net, 6) + 0.0 AS gross, round(net, 6) + 0.0 AS net, round(product(1 + net) OVER (PARTITION BY portfolio_id ORDER BY date) - 1, 5) + 0.0 AS cumulative_net FROM ix")


def _excess(s, d):
    curves = _policy_daily(s, d).where("portfolio_id = 'buffered'").select("portfolio_id", "date", "net").unionByName(_index_curves(s, d).select("portfolio_id", "date", "net"))
    return rebalance.excess_returns(portfolio.performance(curves, "net", "portfolio_id"), "buffered")


register("r13_excess_returns", lambda s, d: _excess(s, d).select("benchmark", "outperformed", *[F.round(_squash(C(c)), 4).alias(c) for c in ("policy_return", "benchmark_return", "excess_return")]),
         f"WITH RECURSIVE {_BD}, {INDEX}, {_IC}, bt AS (SELECT portfolio_id AS benchmark, product(1 + net) - 1 AS b FROM ix GROUP BY 1), ow AS (SELECT total_return AS p FROM pf WHERE portfolio_id = 'buffered') SELECT benchmark, p > b AS outperformed, {_squash_sql('p', 4)} AS policy_return, {_squash_sql('b', 4)} AS benchmark_return, {_squash_sql('(p - b)', 4)} AS excess_return FROM bt, ow")
_RS = {"total_return": 4, "annual_return": 4, "annual_vol": 4, "sharpe": 4}
register("b12_return_summary", lambda s, d: portfolio.return_summary(_index_curves(s, d), "net", "portfolio_id").select("portfolio_id", "n_days", *[F.round(_squash(C(c)), n).alias(c) for c, n in _RS.items()]),
         f"WITH {INDEX}, {_IC}, z AS (SELECT portfolio_id, count(*) AS n_days, product(1 + net) - 1 AS total_return, CASE WHEN product(1 + net) > 0 THEN pow(product(1 + net), 252.0 / count(*)) - 1 ELSE -1 END AS annual_return, stddev_pop(net) * sqrt(252.0) AS annual_vol FROM ix GROUP BY 1), y AS (SELECT *, CASE WHEN annual_vol > 0 THEN annual_return / annual_vol END AS sharpe FROM z) SELECT portfolio_id, n_days, {', '.join(f'{_squash_sql(c, n)} AS {c}' for c, n in _RS.items())} FROM y")
register("r8_holding_periods", lambda s, d: rebalance.holding_periods(portfolio.build_top_n(_sig(s, d), 10)),
         f"WITH {_SIG}, {_WTS}, di AS (SELECT date, row_number() OVER (ORDER BY date) AS i FROM (SELECT DISTINCT date FROM wts)), h AS (SELECT asset, date, i - row_number() OVER (PARTITION BY asset ORDER BY i) AS g FROM wts JOIN di USING (date) WHERE weight <> 0) SELECT asset, min(date) AS start, count(*) AS n_dates FROM h GROUP BY asset, g")
_BIN = "CASE WHEN rank <= 10 THEN '1-10' WHEN rank <= 20 THEN '11-20' WHEN rank <= 40 THEN '21-40' ELSE '>40' END"
register("r9_rank_migration", lambda s, d: rebalance.rank_migration(portfolio.build_top_n(_sig(s, d), 60), _ranked(s, d).select("date", "asset", "rank"), (10, 20, 40)),
         f"""WITH {_SIG}, {_RK}, w0 AS (SELECT date, asset, row_number() OVER (PARTITION BY date ORDER BY signal DESC, asset) <= 60 AS top FROM sig WHERE signal IS NOT NULL), h AS (SELECT date, asset, {_BIN} AS b FROM w0 JOIN rk USING (date, asset) WHERE top),
         l AS (SELECT b AS to_bin, lag(b) OVER ({W}) AS from_bin FROM h), n AS (SELECT unnest(['1-10', '11-20', '21-40', '>40']) AS b) SELECT f.b AS from_bin, t.b AS to_bin, count(l.to_bin) AS n FROM n f CROSS JOIN n t LEFT JOIN l ON l.from_bin = f.b AND l.to_bin = t.b GROUP BY 1, 2""")


def _trades(s, d):
    return _events(s, d).select("asset", C("event_date").alias("date"), F.when(F.dayofmonth("event_date") <= 15, "buy").otherwise("sell").alias("action"))


_FW = {"mean_ret": 5, "median_ret": 6}
register("j8_trade_forward_returns", lambda s, d: rnd(rebalance.trade_forward_returns(_trades(s, d), _feat(s, d).select("date", "asset", "ret_1d"), (2, 5)), ["action", "horizon", "n"], _FW),
         f"""WITH {FEAT}, ev AS (SELECT DISTINCT l_suppkey::VARCHAR AS asset, l_shipdate::DATE AS date FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT'), t AS (SELECT *, CASE WHEN day(date) <= 15 THEN 'buy' ELSE 'sell' END AS action FROM ev),
         a AS (SELECT asset, date AS rd, lag(date) OVER ({W}) AS pd, coalesce(product(1 + ret_1d) OVER ({W} ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING), 1) AS f2, coalesce(product(1 + ret_1d) OVER ({W} ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING), 1) AS f5 FROM feat),
         h AS (SELECT t.action, f2 - 1 AS r2, f5 - 1 AS r5 FROM t LEFT JOIN a ON t.asset = a.asset AND a.rd > t.date AND (a.pd IS NULL OR a.pd <= t.date)), l AS (SELECT action, 2 AS horizon, r2 AS r FROM h UNION ALL SELECT action, 5, r5 FROM h)
         SELECT action, horizon, count(r) AS n, round(avg(r), 5) + 0.0 AS mean_ret, round(median(r), 6) + 0.0 AS median_ret FROM l GROUP BY 1, 2""")

# quality and maintenance ------------------------------------------------------------------------------------------------------------

register("v1_validate_bars", lambda s, d: checks.validate_bars(src.daily_panel(s, d)),
         f"""WITH {PANEL} SELECT 'null_key' AS check_name, count(*) FILTER (WHERE date IS NULL OR asset IS NULL) AS failed_rows FROM panel UNION ALL SELECT 'null_price', count(*) FILTER (WHERE open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL) FROM panel
         UNION ALL SELECT 'ohlc_bounds', count(*) FILTER (WHERE high < greatest(open, low, close) OR low > least(open, high, close)) FROM panel UNION ALL SELECT 'negative', count(*) FILTER (WHERE close < 0 OR volume < 0 OR amount < 0) FROM panel
         UNION ALL SELECT 'duplicate_key', count(*) - count(DISTINCT (date, asset)) FROM panel""")
register("v2_validate_factors", lambda s, d: checks.validate_factors(features.technical_liquidity(src.daily_panel(s, d)), ["ret_60d", "downside_vol_20d", "amihud_illiquidity_20d"]),
         f"WITH {_TSQL}, t AS (SELECT {_tech['ret_60d'][0]} AS a, {_tech['downside_vol_20d'][0]} AS b, {_tech['amihud_illiquidity_20d'][0]} AS c FROM tb), l AS (SELECT 'ret_60d' AS factor, a AS v FROM t UNION ALL SELECT 'downside_vol_20d', b FROM t UNION ALL SELECT 'amihud_illiquidity_20d', c FROM t) SELECT factor, count(*) AS n_rows, count(*) - count(v) AS n_null, count(*) FILTER (WHERE isinf(v)) AS n_inf, count(v) = 0 AS all_null FROM l GROUP BY factor")
register("v7_profile", lambda s, d: checks.profile(src.table(s, d, "orders"), ["o_orderkey"], "o_orderdate").select("n_rows", "n_keys", "n_duplicate_keys", "min_date", "max_date", "n_null_o_totalprice"),
         "SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS n_duplicate_keys, min(o_orderdate) AS min_date, max(o_orderdate) AS max_date, count(*) FILTER (WHERE o_totalprice IS NULL) AS n_null_o_totalprice FROM orders")
_RULES = [{"name": "status", "kind": "enum", "column": "o_orderstatus", "values": ["O", "F"]}, {"name": "priority", "kind": "required", "column": "o_orderpriority"}, {"name": "urgent_small", "kind": "implies", "if": "o_orderpriority = '1-URGENT'", "then": "o_totalprice < 450000"}, {"name": "key", "kind": "unique", "column": "o_orderkey"}]
register("v8_check_rules", lambda s, d: checks.check_rules(src.table(s, d, "orders"), _RULES, "o_orderkey"),
         """SELECT 'status' AS rule, o_orderkey::VARCHAR AS key, 'enum' AS message FROM orders WHERE NOT coalesce(o_orderstatus IN ('O', 'F'), false) UNION ALL SELECT 'priority', o_orderkey::VARCHAR, 'required' FROM orders WHERE o_orderpriority IS NULL OR trim(o_orderpriority) = ''
         UNION ALL SELECT 'urgent_small', o_orderkey::VARCHAR, 'implies' FROM orders WHERE o_orderpriority = '1-URGENT' AND NOT coalesce(o_totalprice < 450000, false) UNION ALL SELECT 'key', o_orderkey::VARCHAR, 'not unique' FROM orders GROUP BY o_orderkey HAVING count(*) > 1""")
register("v6_status_rollup", lambda s, d: checks.status_rollup(src.table(s, d, "events").select(C("event_type").alias("api"), F.when(C("event_type") == "error", "failed").otherwise("success").alias("status"))),
         "SELECT event_type AS api, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS n_failed, CASE WHEN count(*) FILTER (WHERE event_type = 'error') = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM events GROUP BY ROLLUP (event_type)")


def _slices(s, d):
    o = src.table(s, d, "orders")
    old, new = o.where("o_orderdate < timestamp '1999-01-01'"), o.where("o_orderdate >= timestamp '1998-01-01'")
    return old, new.withColumn("o_totalprice", F.when(C("o_orderkey") % 97 == 0, C("o_totalprice") + 1).otherwise(C("o_totalprice")))


_SL = "o AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'), n AS (SELECT * REPLACE (CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"
register("l3_merge_report", lambda s, d: lake.merge_report(*_slices(s, d), ["o_orderkey"]),
         f"""WITH {_SL}, j AS (SELECT o.o_orderkey AS ok, n.o_orderkey AS nk, o.o_custkey IS NOT DISTINCT FROM n.o_custkey AND o.o_orderstatus IS NOT DISTINCT FROM n.o_orderstatus AND o.o_totalprice IS NOT DISTINCT FROM n.o_totalprice AND o.o_orderdate IS NOT DISTINCT FROM n.o_orderdate AND o.o_orderpriority IS NOT DISTINCT FROM n.o_orderpriority AS same FROM o FULL JOIN n ON o.o_orderkey = n.o_orderkey),
         c AS (SELECT count(*) FILTER (WHERE nk IS NULL) AS old_only, count(*) FILTER (WHERE ok IS NULL) AS new_only, count(*) FILTER (WHERE ok IS NOT NULL AND nk IS NOT NULL AND same) AS identical, count(*) FILTER (WHERE ok IS NOT NULL AND nk IS NOT NULL AND NOT same) AS conflict FROM j),
         k AS (SELECT (SELECT count(*) FROM (SELECT 1 FROM o GROUP BY o_orderkey HAVING count(*) > 1)) + (SELECT count(*) FROM (SELECT 1 FROM n GROUP BY o_orderkey HAVING count(*) > 1)) AS duplicate_keys)
         SELECT *, true AS schema_equal, CASE WHEN conflict = 0 AND duplicate_keys = 0 THEN 'READY' ELSE 'BLOCKED' END AS status FROM c, k""")
register("l3_keyed_merge", lambda s, d: lake.keyed_merge(*_slices(s, d), ["o_orderkey"]), f"WITH {_SL} SELECT * FROM o UNION ALL SELECT * FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)")
register("k9_upsert", lambda s, d: lake.upsert(*_slices(s, d), ["o_orderkey"]), f"WITH {_SL} SELECT * FROM n UNION ALL SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n)")
register("l6_keep_last", lambda s, d: lake.keep_last(src.table(s, d, "events").select("user_id", "event_type", "ts", "event_id", "value"), ["user_id", "event_type"], C("ts"), C("event_id")), "SELECT user_id, event_type, ts, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")


def _gaps(s, d):
    landed = src.daily_panel(s, d).select("date", "asset")
    return lake.coverage_gaps(diagnostics.date_grid(landed), landed, ["date", "asset"])


register("j15_coverage_gaps", _gaps, f"WITH {PANEL} SELECT d.date, a.asset FROM (SELECT DISTINCT date FROM panel) d, (SELECT DISTINCT asset FROM panel) a WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE p.date = d.date AND p.asset = a.asset)")
