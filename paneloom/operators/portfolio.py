"""Weights from signals, turnover, cost and vectorised backtests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.expr import period_end
from .diagnostics import date_grid, date_index

C = F.col


def _normalised(w: Column, part: str = "date") -> Column:
    """Long weights sum to 1 and short ones to -1 within a date."""
    over = Window.partitionBy(part)
    longs, shorts = F.sum(F.greatest(w, F.lit(0.0))).over(over), F.sum(F.greatest(-w, F.lit(0.0))).over(over)
    return F.when(w > 0, w / longs).when(w < 0, w / shorts).otherwise(0.0)


def build_top_n(frame: DataFrame, n: int, bottom_n: int = 0, min_liquidity: float | None = None, size_aware: bool = False, max_weight: float | None = None, group_cap: float | None = None) -> DataFrame:
    """(date, asset, weight) from (date, asset, signal[, liquidity, market_cap, grp]).

    The n highest signals of a date weigh the same, less the bottom_n lowest of the rest. Every row with a signal has a weight, 0 if
    it is not chosen; rows below min_liquidity, or without liquidity, are not ranked. Then weights are scaled by up to half by the
    logarithm of the size (relative to the largest of all rows of the date), cut at max_weight, brought under the cap of their
    group in up to 8 rounds, and made to sum up to 1 again, which may exceed max_weight."""
    day = Window.partitionBy("date")
    base = frame.where(C("signal").isNotNull())
    fits = F.lit(True) if min_liquidity is None else F.coalesce(C("liquidity") >= min_liquidity, F.lit(False))
    base = base.withColumn("_fits", fits)
    base = base.withColumn("_top", C("_fits") & (F.row_number().over(day.orderBy(C("_fits").desc(), C("signal").desc(), "asset")) <= n))
    rest = C("_fits") & ~C("_top")
    base = base.withColumn("_low", rest & (F.row_number().over(day.orderBy(rest.desc(), "signal", "asset")) <= bottom_n))
    base = base.withColumn("weight", _normalised(F.when(C("_top"), 1.0).when(C("_low"), -1.0).otherwise(0.0)))
    if size_aware:
        log = F.log(F.greatest(C("market_cap"), F.lit(1e-12)))
        base = base.withColumn("weight", C("weight") * (1 + 0.5 * F.coalesce(F.try_divide(log, F.max(F.abs(log)).over(day)), F.lit(0.0))))
    if max_weight is not None:
        base = base.withColumn("weight", F.greatest(F.lit(-max_weight), F.least(F.lit(max_weight), C("weight"))))
    base = base.withColumn("weight", _normalised(C("weight")))
    if group_cap is not None:
        base = _group_capped(base, group_cap)
    return base.select("date", "asset", "weight")


def _group_capped(base: DataFrame, cap: float) -> DataFrame:
    """The rounds run on each date's few group totals; their multipliers are joined back."""
    totals = base.groupBy("date", "grp").agg(F.sum(F.abs("weight")).alias("t"))
    one = totals.groupBy("date").agg(F.array_sort(F.collect_list(F.struct(F.coalesce(C("grp").cast("string"), F.lit("")).alias("g"), C("grp").isNull().alias("free"), C("t").alias("t"), F.lit(1.0).alias("m")))).alias("g"))

    def step(acc, _):
        cut = F.transform(acc, lambda x: F.struct(x["g"].alias("g"), x["free"].alias("free"), F.when(~x["free"] & (x["t"] > cap), F.lit(cap)).otherwise(x["t"]).alias("t"), F.when(~x["free"] & (x["t"] > cap), x["m"] * cap / x["t"]).otherwise(x["m"]).alias("m")))
        return F.get(F.transform(F.array(cut), lambda c: F.transform(c, lambda x: F.struct(x["g"].alias("g"), x["free"].alias("free"), F.try_divide(x["t"], F.aggregate(c, F.lit(0.0), lambda s, y: s + y["t"])).alias("t"), F.try_divide(x["m"], F.aggregate(c, F.lit(0.0), lambda s, y: s + y["t"])).alias("m")))), 0)

    capped = one.select("date", F.explode(F.aggregate(F.sequence(F.lit(1), F.lit(8)), C("g"), step)).alias("x")).select("date", C("x.g").alias("_g"), C("x.m").alias("_m"))
    joined = base.withColumn("_g", F.coalesce(C("grp").cast("string"), F.lit(""))).join(capped, ["date", "_g"], "left")
    return joined.withColumn("weight", C("weight") * F.coalesce("_m", F.lit(0.0))).withColumn("weight", _normalised(C("weight")))


def rebalance_dates(dates: DataFrame, freq: str) -> DataFrame:
    """Last available date of each period: D, W or M."""
    days = dates.select("date").distinct()
    return days if freq == "D" else days.groupBy(period_end(C("date"), freq)).agg(F.max("date").alias("date")).select("date")


def on_rebalance_dates(frame: DataFrame, freq: str) -> DataFrame:
    """Rows of the rebalance dates among the dates that have a signal: what is ranked or weighed later is only these."""
    return frame.join(F.broadcast(rebalance_dates(frame.where(C("signal").isNotNull()), freq)), "date", "left_semi")


def hold_between(weights: DataFrame, freq: str, rows: DataFrame | None = None) -> DataFrame:
    """Weights of rebalance dates carried to every date and asset; 0 before the first; an asset that is absent on a rebalance date keeps
    its old weight. Dates and assets are those of `rows`, where weights are of rebalance dates alone, else of weights."""
    kept = weights.join(F.broadcast(rebalance_dates(weights, freq)), "date", "left_semi")
    grid = date_grid(weights if rows is None else rows).join(kept, ["date", "asset"], "left")
    held = F.last("weight", ignorenulls=True).over(Window.partitionBy("asset").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    return grid.select("date", "asset", F.coalesce(held, F.lit(0.0)).alias("weight"))


def held_backtest(marked: DataFrame, returns: DataFrame, dates: DataFrame, cost_bps: float = 5.0, slippage_bps: float = 0.0) -> DataFrame:
    """run_backtest of weights that are held between rebalance dates, without a grid of dates and assets.

    marked: (date, asset, weight) of the rebalance dates alone. Each return meets the asset's last weight in one window by asset;
    turnover is the change between an asset's own marks."""
    w = Window.partitionBy("asset").orderBy("date", "k")
    rows = marked.select("asset", "date", F.lit(0).alias("k"), "weight", F.lit(None).cast("double").alias("next_ret"))
    rows = rows.unionByName(next_day_returns(returns).select("asset", "date", F.lit(1).alias("k"), F.lit(None).cast("double").alias("weight"), "next_ret"))
    held = F.last("weight", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    before = F.coalesce(F.last("weight", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    daily = rows.select("date", "k", (C("weight") - before).alias("move"), (F.coalesce(held, F.lit(0.0)) * C("next_ret")).alias("earned"))
    daily = daily.groupBy("date").agg(F.sum(F.when(C("k") == 1, C("earned"))).alias("gross"), F.coalesce(F.sum(F.abs("move")), F.lit(0.0)).alias("turnover"))
    out = dates.select("date").distinct().join(daily, "date", "left").withColumn("turnover", F.coalesce("turnover", F.lit(0.0)))
    out = out.withColumn("cost", C("turnover") * cost_rate(cost_bps, slippage_bps))
    return out.select("date", "gross", "turnover", "cost", (F.coalesce("gross", F.lit(0.0)) - C("cost")).alias("net"))


def next_day_returns(returns: DataFrame, column: str = "ret_1d", execution: str = "next_close") -> DataFrame:
    """(date, asset, next_ret). Execution at the next open is told by the same returns from close to close, as no others are given."""
    if execution not in ("next_close", "next_open"):
        raise ValueError("execution is next_close or next_open")
    return returns.select("date", "asset", F.lead(column, 1).over(Window.partitionBy("asset").orderBy("date")).alias("next_ret"))


def turnover(weights: DataFrame) -> DataFrame:
    """(date, turnover): sum of absolute changes, absent names counting 0; without a dense grid: each weight enters on its date and leaves
    on the next."""
    dates = F.broadcast(date_index(weights))
    rows = weights.join(dates, "date").select("i", "asset", "weight")
    both = rows.union(rows.select(C("i") + 1, "asset", -C("weight")))
    moves = both.groupBy("i", "asset").agg(F.sum("weight").alias("d")).groupBy("i").agg(F.sum(F.abs("d")).alias("turnover"))
    return dates.join(moves, "i").select("date", "turnover")


def cost_rate(cost_bps: float, slippage_bps: float = 0.0) -> float:
    if cost_bps < 0 or slippage_bps < 0:
        raise ValueError("cost must not be negative")
    return (cost_bps + slippage_bps) / 1e4


def run_backtest(weights: DataFrame, returns: DataFrame, cost_bps: float = 5.0, slippage_bps: float = 0.0, execution: str = "next_close") -> DataFrame:
    """(date, gross, turnover, cost, net): weights of a date earn each asset's next return."""
    gross = weights.join(next_day_returns(returns, execution=execution), ["date", "asset"]).groupBy("date").agg(F.sum(C("weight") * C("next_ret")).alias("gross"))
    moved = turnover(weights).withColumn("cost", C("turnover") * cost_rate(cost_bps, slippage_bps))
    return moved.join(gross, "date", "left").select("date", "gross", "turnover", "cost", (F.coalesce("gross", F.lit(0.0)) - C("cost")).alias("net"))


def performance(daily: DataFrame, column: str, *by: str) -> DataFrame:
    """Total and annual return, volatility, Sharpe ratio (0 without volatility) and drawdown below the running peak of the curve, which
    starts at its first value. One row for each `by`; daily rows of one curve are few by construction."""
    rows = daily.where(C(column).isNotNull())
    run = Window.partitionBy(*by).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    curve = rows.withColumn("_c", F.product(1 + C(column)).over(run))
    curve = curve.withColumn("_dd", C("_c") / F.max("_c").over(run) - 1)
    n, total, vol = F.count("*"), F.product(1 + C(column)), F.stddev_pop(column) * F.sqrt(F.lit(252.0))
    annual = F.when(total > 0, F.pow(total, 252.0 / n) - 1).otherwise(-1.0)
    out = curve.groupBy(*by).agg((total - 1).alias("total_return"), annual.alias("annual_return"), vol.alias("annual_vol"), F.min("_dd").alias("max_drawdown"), n.alias("n_days"))
    return out.withColumn("sharpe", F.when(C("annual_vol") > 0, C("annual_return") / C("annual_vol")).otherwise(0.0))


def return_summary(daily: DataFrame, column: str, *by: str) -> DataFrame:
    """Total and annual return, volatility and Sharpe ratio of a return column; the ratio is NULL without volatility."""
    n, total, vol = F.count(column), F.product(1 + C(column)), F.stddev_pop(column) * F.sqrt(F.lit(252.0))
    annual = F.when(total > 0, F.pow(total, F.try_divide(F.lit(252.0), n)) - 1).when(n > 0, -1.0)
    return daily.groupBy(*by).agg((total - 1).alias("total_return"), annual.alias("annual_return"), vol.alias("annual_vol"), F.when(vol > 0, annual / vol).alias("sharpe"), n.alias("n_days"))


def equal_weight_benchmark(returns: DataFrame, freq: str = "W", column: str = "ret_1d") -> DataFrame:
    """(date, bench_ret): mean return of the names that were present on the last rebalance date before.

    A name is held on a date exactly if the last rebalance date on which it was present is the last one there was."""
    days = returns.select("date").distinct().join(rebalance_dates(returns, freq).withColumn("_r", C("date")), "date", "left")
    last = F.max("_r").over(Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1))
    days = days.select("date", "_r", last.alias("held_from"))
    seen = F.last("_r", ignorenulls=True).over(Window.partitionBy("asset").orderBy("date").rowsBetween(Window.unboundedPreceding, -1))
    rows = returns.join(F.broadcast(days), "date").withColumn("_held", seen == C("held_from"))
    daily = rows.groupBy("date", "held_from", "_r").agg(F.sum(F.when(C("_held"), C(column))).alias("earned"), F.count("*").alias("names"))
    size = daily.where("_r is not null").select(C("_r").alias("held_from"), C("names").alias("k"))
    return daily.join(F.broadcast(size), "held_from", "left").select("date", F.coalesce(C("earned") / C("k"), F.lit(0.0)).alias("bench_ret"))


def benchmark_relative(daily: DataFrame, bench: DataFrame) -> DataFrame:
    from ..core.expr import safe_corr

    both = daily.join(bench, "date").where(C("net").isNotNull() & C("bench_ret").isNotNull())
    return both.agg((F.product(1 + C("net")) - F.product(1 + C("bench_ret"))).alias("excess_return"), safe_corr(C("net"), C("bench_ret")).alias("corr"), (F.stddev_pop(C("net") - C("bench_ret")) * F.sqrt(F.lit(252.0))).alias("active_vol"))
