"""Per-asset window features and factor families. All columns of a family share one partitioning by asset and one sort by date."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core.expr import ahead, by_asset, change, ieee_div, require, rolling

C = F.col


def _returns(k: int) -> Callable[[DataFrame], Column]:
    return lambda df: change(C("close"), k)


def _turnover(n: int) -> Callable[[DataFrame], Column]:
    return lambda df: rolling(F.avg, C("turnover" if "turnover" in df.columns else "amount"), n)


#: Feature store: name to a function of the panel that gives the column.
FEATURES: dict[str, Callable[[DataFrame], Column]] = {
    "ret_1d": _returns(1), "ret_5d": _returns(5), "ret_20d": _returns(20),
    "vol_20d": lambda df: rolling(F.stddev_samp, C("_ret_1d"), 20),
    "turnover_5d": _turnover(5), "turnover_20d": _turnover(20),
    "amount_20d": lambda df: rolling(F.avg, C("amount"), 20),
    "market_cap": lambda df: C("market_cap") if "market_cap" in df.columns else F.lit(None).cast("double"),
    "fwd_ret_5d": lambda df: ahead(C("close"), 5), "fwd_ret_20d": lambda df: ahead(C("close"), 20),
}


def compute_features(panel: DataFrame, names: list[str] | None = None, registry: dict | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(date, asset, keep..., names...). An unknown name raises."""
    registry = registry or FEATURES
    names = list(registry) if names is None else names
    if unknown := [n for n in names if n not in registry]:
        raise KeyError(f"unknown features: {', '.join(unknown)}")
    require(panel, "date", "asset", "close", "amount")
    base = panel.withColumn("_ret_1d", change(C("close"), 1))
    return base.select("date", "asset", *keep, *[registry[n](base).alias(n) for n in names])


def forward_labels(panel: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    return panel.select("date", "asset", *[ahead(C("close"), h).alias(f"fwd_ret_{h}d") for h in horizons])


def moving_averages(panel: DataFrame) -> DataFrame:
    ma20 = rolling(F.avg, C("close"), 20)
    base = panel.withColumn("_r", change(C("close"), 1))
    return base.select("date", "asset", rolling(F.avg, C("close"), 5).alias("ma_5"), ma20.alias("ma_20"), F.try_divide(C("close"), ma20).alias("ma_ratio_20"), rolling(F.stddev_samp, C("_r"), 20).alias("volatility_20d"))


#: How values of equal windows that follow one another give the value of all of them, where each has one.
_UNITED: dict[str, Callable[[list[Column]], Column]] = {"sum": lambda x: reduce(Column.__add__, x), "max": lambda x: F.greatest(*x), "min": lambda x: F.least(*x)}


def _windows(df: DataFrame, short: int, sums: tuple[str, ...] = (), tops: tuple[str, ...] = (), lows: tuple[str, ...] = (), devs: tuple[str, ...] = (), keep: tuple[Column, ...] = ()) -> DataFrame:
    """df with keep and, of the last `short` rows, {c}_sum, {c}_max, {c}_min, and {c}_mean with {c}_squares (about that mean), named with the
    number of rows, like close_max_5; NULL unless all rows have c."""
    w = by_asset().rowsBetween(-(short - 1), 0)
    whole = lambda c, x: F.when(F.count(c).over(w) == short, x)
    out = [whole(c, f(c).over(w)).alias(f"{c}_{n}_{short}") for n, f, cs in (("sum", F.sum, sums), ("max", F.max, tops), ("min", F.min, lows), ("mean", F.avg, devs)) for c in cs]
    return df.select("*", *keep, *out, *[whole(c, F.var_pop(c).over(w) * short).alias(f"{c}_squares_{short}") for c in devs])


def _longer(df: DataFrame, short: int, times: int) -> DataFrame:
    """df with the windows of short * times rows made of those of `short` rows: a few steps a row, where a sliding frame takes one for each
    row that it spans. Only windows that do not overlap are united and nothing is subtracted that was once added, so that one huge value leaves
    no error behind; squares about the common mean are those about each window's and those of the means."""
    names = [c.removesuffix(f"_{short}") for c in df.columns if c.endswith(f"_{short}")]
    part = lambda n, i: f"_{n}_at_{i}"
    at = df.select("*", *[(F.lag(f"{n}_{short}", i * short).over(by_asset()) if i else C(f"{n}_{short}")).alias(part(n, i)) for n in names for i in range(times)])
    of = lambda n: [C(part(n, i)) for i in range(times)]
    there = lambda n: reduce(Column.__and__, [x.isNotNull() for x in of(n)])
    mean = lambda x: x[0] + reduce(Column.__add__, [y - x[0] for y in x[1:]]) / times
    out = {}
    for n in names:
        c, kind = n.rsplit("_", 1)
        if kind == "squares":
            means = of(f"{c}_mean")
            out[n] = reduce(Column.__add__, of(n)) + short * reduce(Column.__add__, [(x - mean(means)) * (x - mean(means)) for x in means])
        else:
            out[n] = mean(of(n)) if kind == "mean" else F.when(there(n), _UNITED[kind](of(n)))
    return at.select(*df.columns, *[x.alias(f"{n}_{short * times}") for n, x in out.items()])


def _of_windows(k: int) -> dict[str, Column]:
    """Factors of the last k rows, from their windows."""
    mean, deviation = lambda c: C(f"{c}_sum_{k}") / k, lambda c: F.sqrt(C(f"{c}_squares_{k}") / (k - 1))
    top, low = C(f"high_max_{k}"), C(f"low_min_{k}")
    return {
        f"realized_vol_{k}d": deviation("r"), f"downside_vol_{k}d": deviation("neg"), f"max_drawdown_{k}d": F.try_divide(C("close"), C(f"close_max_{k}")) - 1,
        f"amount_mean_{k}d": mean("amount"), f"turnover_mean_{k}d": mean("turnover"), f"amihud_illiquidity_{k}d": mean("illiq"),
        f"high_low_range_{k}d": F.try_divide(top, low) - 1, f"close_to_high_{k}d": F.try_divide(C("close"), top) - 1,
    }


def technical_liquidity(panel: DataFrame) -> DataFrame:
    """Returns, volatility, drawdown, liquidity and range factors. downside_vol needs every return of its window to be negative."""
    base = panel.select("date", "asset", "close", "high", "low", "amount", "turnover", change(C("close"), 1).alias("r")).withColumn("neg", F.when(C("r") < 0, C("r")))
    base = base.withColumn("illiq", F.abs(C("r")) / F.when(C("amount") > 0, C("amount")))
    moves = tuple(change(C("close"), k).alias(f"ret_{k}d") for k in (5, 20, 60))
    base = _windows(base, 5, ("amount", "turnover", "illiq"), ("close", "high"), ("low",), ("r", "neg"), moves)
    # what a length gives is finished before the windows of the next one, so that no single step computes all columns: the JVM does not compile very long methods
    shocks = {f"{x}_shock_5d_vs_20d": ieee_div(C(f"{x}_sum_5") / 5, C(f"{x}_sum_20") / 20) for x in ("amount", "turnover")}
    base = _longer(base, 5, 4).withColumns(_of_windows(20) | shocks)
    out = _of_windows(60)
    base = _longer(base, 20, 3).withColumns(out)
    done = [f"ret_{k}d" for k in (5, 20, 60)], [f"{c.removesuffix('_60d')}_{k}d" for k in (20, 60) for c in out]
    moves = [C(f"ret_{k}d").alias(f"momentum_{k}d") for k in (20, 60)] + [(-C(f"ret_{k}d")).alias(f"reversal_{k}d") for k in (5, 20)]
    return base.select("date", "asset", *done[0], *moves, *done[1], *shocks)


def _guarded(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def margin_leverage(panel: DataFrame) -> DataFrame:
    """Financing and short-selling factors; the optional ones appear when their columns do."""
    require(panel, "financing_balance", "margin_total_balance", "financing_buy_amount")
    out: dict[str, Column] = {c: C(c) for c in ("financing_balance", "margin_total_balance")}
    out |= {f"{c}_chg_{k}d": change(C(c), k) for c in ("financing_balance", "margin_total_balance") for k in (5, 20)}
    base = panel
    flows = {"financing_buy": "financing_buy_amount"} | ({"short_sell": "short_sell_volume"} if "short_sell_volume" in panel.columns else {})
    for name, c in flows.items():
        means = {k: rolling(F.avg, C(c), k) for k in (5, 20)}
        out |= {f"{name}_mean_{k}d": m for k, m in means.items()} | {f"{name}_shock_5d_vs_20d": _guarded(means[5], means[20])}
    if "financing_repay_amount" in panel.columns:
        base = base.withColumn("_net", C("financing_buy_amount") - C("financing_repay_amount"))
        out |= {"financing_net_buy": C("_net")} | {f"financing_net_buy_mean_{k}d": rolling(F.avg, C("_net"), k) for k in (5, 20)}
    if "short_balance" in panel.columns:
        out |= {f"short_balance_chg_{k}d": change(C("short_balance"), k) for k in (5, 20)}
    if "margin_eligibility" in panel.columns:
        out["margin_eligibility_dummy"] = F.coalesce(C("margin_eligibility").cast("double") > 0, F.lit(False)).cast("double")
    return base.select("date", "asset", *[v.alias(k) for k, v in out.items()])


def market_regime(panel: DataFrame) -> DataFrame:
    """Index factors, for each index_id."""
    w = by_asset("index_id")
    base = panel.withColumn("_r", change(C("close"), 1, w))
    roll = lambda f, x, n: rolling(f, C(x), n, w)
    out: dict[str, Column] = {f"index_ret_{k}d": change(C("close"), k, w) for k in (5, 20, 60)} | {f"index_momentum_{k}d": change(C("close"), k, w) for k in (20, 60)}
    for k in (20, 60):
        out |= {f"index_realized_vol_{k}d": roll(F.stddev_samp, "_r", k), f"index_max_drawdown_{k}d": F.try_divide(C("close"), roll(F.max, "close", k)) - 1, f"index_close_to_high_{k}d": F.try_divide(C("close"), roll(F.max, "high", k)) - 1, f"index_amount_mean_{k}d": roll(F.avg, "amount", k)}
    out["index_amount_shock_5d_vs_20d"] = _guarded(roll(F.avg, "amount", 5), roll(F.avg, "amount", 20))
    pe = C("valuation_pe_ttm")
    seen = F.collect_list(pe).over(w.rowsBetween(-59, 0))
    below, same = F.size(F.filter(seen, lambda x: x < pe)), F.size(F.filter(seen, lambda x: x == pe))
    out |= {"index_pe_ttm": pe, "index_pe_ttm_z_60d": F.try_divide(pe - roll(F.avg, "valuation_pe_ttm", 60), roll(F.stddev_samp, "valuation_pe_ttm", 60)), "index_pe_ttm_pct_rank_60d": F.when(F.size(seen) == 60, (below + (same + 1) / 2) / 60)}
    return base.select("date", "index_id", *[v.alias(k) for k, v in out.items()])
