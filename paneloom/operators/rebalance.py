"""Buffered rebalancing and diagnostics of trades and holdings."""

from __future__ import annotations

from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..core.scratch import written
from .diagnostics import date_index, exact_percentiles, left_on
from .portfolio import performance, rebalance_dates

C = F.col


#: Fixed values of a trade's reason and action, which users of the log match on.
REASONS = ("missing_signal", "not_tradable", "sell_rank_exceeded", "still_in_buy_zone", "in_buffer_zone", "above_max_holding_n", "min_trade_filter", "")
ACTIONS = ("buy", "sell", "keep", "add", "trim")


@dataclass(frozen=True)
class BufferedConfig:
    """Names are bought down to buy_rank and kept down to sell_rank. freq: D, W or M."""

    target_n: int = 50
    buy_rank: int = 50
    sell_rank: int = 100
    min_holding_n: int = 45
    max_holding_n: int = 60
    max_weight: float | None = 0.025
    min_trade_weight: float = 0.003
    require_tradable_for_buy: bool = True
    require_tradable_for_sell: bool = True
    freq: str = "W"
    cost_bps: float = 20.0

    def __post_init__(self):
        if not 0 < self.buy_rank <= self.sell_rank or not 0 < self.min_holding_n <= self.max_holding_n or not self.min_holding_n <= self.target_n <= self.max_holding_n:
            raise ValueError("ranks and holding counts are out of order")
        if self.min_trade_weight < 0 or self.cost_bps < 0 or (self.max_weight is not None and self.max_weight <= 0) or self.freq not in ("D", "W", "M"):
            raise ValueError("weights and costs must not be negative, and the frequency is D, W or M")


def _next_book(day: dict, book: dict[str, float], c: BufferedConfig) -> tuple[dict[str, float], dict[str, str]]:
    """Weights and reasons of one rebalance date. day: asset to (rank, score, is_tradable), as far as it can matter to the policy."""
    worst = (float("inf"), float("-inf"), False)
    place = lambda a: (day.get(a, worst)[0], -day.get(a, worst)[1], a)
    why = {}
    for a in book:
        rank, _, tradable = day.get(a, (None, None, None))
        why[a] = (
            "missing_signal" if rank is None
            else "still_in_buy_zone" if rank <= c.buy_rank
            else "in_buffer_zone" if rank <= c.sell_rank
            else "not_tradable" if c.require_tradable_for_sell and not tradable
            else "sell_rank_exceeded"
        )
    chosen = [a for a in book if why[a] != "sell_rank_exceeded"]
    open_slots = c.target_n if not book else c.target_n - len(chosen) if len(chosen) < c.min_holding_n else 0
    if open_slots > 0:
        fresh = [a for a, (rank, _, tradable) in day.items() if a not in why and rank <= c.buy_rank and (tradable or not c.require_tradable_for_buy)]
        chosen += sorted(fresh, key=place)[:open_slots]
    if len(chosen) > c.max_holding_n:
        chosen.sort(key=place)
        why.update(dict.fromkeys(chosen[c.max_holding_n :], "above_max_holding_n"))
        chosen = chosen[: c.max_holding_n]
    # equal weights stay equal under a cap and are scaled up to 1 again
    goal = dict.fromkeys(chosen, 1 / len(chosen)) if chosen else {}
    if c.min_trade_weight:
        for a in {*goal, *book}:
            if abs(goal.get(a, 0.0) - book.get(a, 0.0)) < c.min_trade_weight:
                goal[a], why[a] = book.get(a, 0.0), "min_trade_filter"
    total = sum(w for w in goal.values() if w > 0)
    return {a: w / total for a, w in goal.items() if w > 0}, why


def _reachable(marked: DataFrame, c: BufferedConfig) -> DataFrame:
    """Rows that a step can use: ranks down to sell_rank, and below it names that may still be held, as they were held at the start (opened)
    or in the buying zone after the last date on which they would have been sold."""
    rank, tradable = C("rank"), C("is_tradable")
    bought = (rank <= c.buy_rank) & (tradable if c.require_tradable_for_buy else F.lit(True))
    sold = (rank > c.sell_rank) & (tradable if c.require_tradable_for_sell else F.lit(True))
    before = Window.partitionBy("asset").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    # a sale is left out as too small only if a weight can be below min_trade_weight; if none can, a sale is certain
    least, k = c.min_trade_weight, c.max_holding_n
    certain = least <= (1 / k - least) / (1 + k * least)
    last = F.last(F.when(bought, True).when(sold, False) if certain else F.when(bought, True), ignorenulls=True).over(before)
    return marked.withColumn("_open", F.coalesce(last, C("opened") if "opened" in marked.columns else F.lit(False))).where((rank <= c.sell_rank) | C("_open")).drop("_open", "opened")


def holdings(log: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """(portfolio_id, date, asset, weight): what each portfolio of a log holds after its last date, at most max_holding_n rows each. A
    portfolio that the log does not have keeps its opening holdings. Saved as a table, it is where a later run goes on."""
    last = log.groupBy("portfolio_id").agg(F.max("date").alias("date"))
    now = log.join(F.broadcast(last), ["portfolio_id", "date"], "left_semi").where("weight > 0").select("portfolio_id", "date", "asset", "weight")
    if opening is None:
        return now
    return now.unionByName(opening.select("portfolio_id", "date", "asset", "weight").join(F.broadcast(last), "portfolio_id", "left_anti"))


def buffered_weights(signal: DataFrame, configs: dict[str, BufferedConfig], opening: DataFrame | None = None, after: str | None = None) -> DataFrame:
    """The trade log (portfolio_id, date, asset, prev_weight, weight, trade_weight, action, reason, rank, score, is_tradable) of the
    rebalance dates: every asset with a signal, and held ones without.

    Only the holdings pass from one date to the next. The recursion over them is one group for each portfolio, of the rows that a
    step can use: about sell_rank for each rebalance date, however many assets there are. All other rows are filled in by a join.

    opening: holdings (portfolio_id, asset, weight) to go on from, as `holdings` gives them; after: only dates after this one. A run after the
    last date of a period that starts from the holdings of that date gives the same rows as one run over all dates.
    """
    steps, full = None, None
    for name, c in configs.items():
        dates = rebalance_dates(signal, c.freq)
        dates = dates if after is None else dates.where(C("date") > F.lit(after).cast("date"))
        marked = signal.join(F.broadcast(dates), "date", "left_semi").select(F.lit(name).alias("portfolio_id"), "date", "asset", "rank", "score", "is_tradable")
        own = None if opening is None else opening.where(C("portfolio_id") == name)
        opened = marked.withColumn("opened", F.lit(False)) if own is None else marked.join(F.broadcast(own.select("asset", F.lit(True).alias("opened"))), "asset", "left")
        mine = _reachable(opened.withColumn("opened", F.coalesce("opened", F.lit(False))), c)
        if own is not None:  # a row without a date for each holding, which comes first
            start = own.select(F.lit(name).alias("portfolio_id"), F.lit(None).cast("date").alias("date"), "asset", F.lit(None).cast("int").alias("rank"), C("weight").alias("score"), F.lit(None).cast("boolean").alias("is_tradable"))
            mine = mine.select("portfolio_id", "date", "asset", C("rank").cast("int").alias("rank"), C("score").cast("double").alias("score"), "is_tradable").unionByName(start)
        steps = mine if steps is None else steps.unionByName(mine)
        full = marked if full is None else full.unionByName(marked)
    plain = {k: asdict(c) for k, c in configs.items()}

    def run(part: pd.DataFrame) -> pd.DataFrame:
        name = part["portfolio_id"].iloc[0]
        c, out = BufferedConfig(**plain[name]), []
        start = part[part["date"].isna()]
        book, part = dict(zip(start["asset"], start["score"])), part[part["date"].notna()]
        for date, day in part.sort_values("date", kind="stable").groupby("date", sort=True):
            told = dict(zip(day["asset"], zip(day["rank"], day["score"], day["is_tradable"])))
            now, why = _next_book(told, book, c)
            out += [(name, date, a, book.get(a, 0.0), now.get(a, 0.0), why.get(a, "")) for a in {*now, *book}]
            book = now
        return pd.DataFrame(out, columns=["portfolio_id", "date", "asset", "prev_weight", "weight", "reason"])

    books = steps.groupBy("portfolio_id").applyInPandas(run, "portfolio_id string, date date, asset string, prev_weight double, weight double, reason string")
    log = full.join(books, ["portfolio_id", "date", "asset"], "full_outer").na.fill(0.0, ["prev_weight", "weight"]).na.fill("", ["reason"])
    before, now = C("prev_weight"), C("weight")
    action = F.when((before == 0) & (now > 0), "buy").when((before > 0) & (now == 0), "sell").when((before > 0) & (F.abs(now - before) >= 1e-12), F.when(now > before, "add").otherwise("trim")).otherwise("keep")
    return log.select("portfolio_id", "date", "asset", "prev_weight", "weight", (now - before).alias("trade_weight"), action.alias("action"), "reason", "rank", "score", "is_tradable")


def buffered_daily(log: DataFrame, returns: DataFrame, cost_bps: float = 5.0, portfolios: list[str] | None = None) -> DataFrame:
    """(portfolio_id, date, gross, turnover, cost, net): weights of a rebalance date earn the returns of the dates after it up to and
    including the next one; turnover costs on its own date. The log is read once: its changes of weight meet the returns in one
    order for each portfolio and asset. portfolios: their names, which are looked up in the log if not given."""
    moves = log.where("weight <> 0 or prev_weight <> 0").select("portfolio_id", "asset", "date", F.lit(1).alias("_k"), "weight", F.abs(C("weight") - C("prev_weight")).alias("moved"))
    names = log.select("portfolio_id").distinct() if portfolios is None else log.sparkSession.createDataFrame([(n,) for n in portfolios], "portfolio_id string")
    books = F.broadcast(names)
    rows = returns.select("asset", "date", F.lit(0).alias("_k"), "ret_1d").join(books).unionByName(moves, allowMissingColumns=True)
    held = F.last("weight", ignorenulls=True).over(Window.partitionBy("portfolio_id", "asset").orderBy("date", "_k").rowsBetween(Window.unboundedPreceding, -1))
    daily = rows.withColumn("held", held).groupBy("portfolio_id", "date").agg(
        F.coalesce(F.sum(F.when(C("_k") == 0, C("held") * C("ret_1d"))), F.lit(0.0)).alias("gross"), F.coalesce(F.sum("moved"), F.lit(0.0)).alias("turnover"))
    return daily.withColumn("cost", C("turnover") * cost_bps / 1e4).withColumn("net", C("gross") - C("cost"))


#: Fixed names of the metrics that a comparison of policies reports.
METRICS = ("total_return", "annual_return", "annual_vol", "sharpe", "max_drawdown", "average_turnover", "total_cost", "n_buy", "n_sell")


def compare_policies(log: DataFrame, daily: DataFrame) -> DataFrame:
    """One row for each portfolio: return figures, average turnover, total cost, and counts of buys and sells."""
    cost = daily.groupBy("portfolio_id").agg(F.avg("turnover").alias("average_turnover"), F.sum("cost").alias("total_cost"))
    trades = log.groupBy("portfolio_id").agg(F.count_if(C("action") == "buy").alias("n_buy"), F.count_if(C("action") == "sell").alias("n_sell"))
    return performance(daily, "net", "portfolio_id").join(cost, "portfolio_id").join(trades, "portfolio_id")


def summary_metrics(comparison: DataFrame, policies: list[str]) -> DataFrame:
    """(metric, one column for each policy): the comparison turned over."""
    long = comparison.select("portfolio_id", *[C(m).cast("double").alias(m) for m in METRICS]).unpivot(["portfolio_id"], list(METRICS), "metric", "value")
    return long.groupBy("metric").pivot("portfolio_id", policies).agg(F.first("value"))


def policy_differences(comparison: DataFrame, policy: str, other: str) -> DataFrame:
    """(metric, value) of a policy against another: differences of returns and ratios, and shares by which turnover, cost and trades fall."""
    at = lambda name, m: F.max(F.when(C("portfolio_id") == name, C(m).cast("double")))
    less = [(f"{m}_diff", at(policy, m) - at(other, m)) for m in ("total_return", "sharpe", "max_drawdown")]
    cut = [(f"{n}_reduction", F.try_divide(at(other, m) - at(policy, m), at(other, m))) for n, m in (("turnover", "average_turnover"), ("cost", "total_cost"), ("buy", "n_buy"), ("sell", "n_sell"))]
    one = comparison.agg(F.array(*[F.struct(F.lit(f"{policy}_vs_{other}_{n}").alias("metric"), v.alias("value")) for n, v in less + cut]).alias("x"))
    return one.select(F.explode("x").alias("x")).select("x.*")


def excess_returns(metrics: DataFrame, policy: str, name: str = "portfolio_id") -> DataFrame:
    """(benchmark, policy_return, benchmark_return, excess_return, outperformed) of a policy against every other curve."""
    own = metrics.where(C(name) == policy).select(C("total_return").alias("policy_return"))
    rest = metrics.where(C(name) != policy).select(C(name).alias("benchmark"), C("total_return").alias("benchmark_return"))
    both = rest.join(F.broadcast(own)).withColumn("excess_return", C("policy_return") - C("benchmark_return"))
    return both.select("benchmark", "policy_return", "benchmark_return", "excess_return", (C("excess_return") > 0).alias("outperformed"))


def index_curve(prices: DataFrame, *by: str) -> DataFrame:
    """(by..., date, gross, net, cumulative_net): returns of an index by rows, 0 on the first; rows without date or close go."""
    w = Window.partitionBy(*by).orderBy("date")
    rows = prices.where(C("date").isNotNull() & C("close").isNotNull())
    gross = F.coalesce(F.try_divide(C("close"), F.lag("close").over(w)) - 1, F.lit(0.0))
    curve = rows.select(*by, "date", gross.alias("gross")).withColumn("net", C("gross"))
    return curve.withColumn("cumulative_net", F.product(1 + C("net")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)


def summarize_trades(trades: DataFrame) -> DataFrame:
    """Counts by action, gross turnover and mean ranks of what was bought and sold, for each date."""
    n = lambda a: F.count_if(C("action") == a).alias(f"n_{a}")
    rank = lambda a: F.avg(F.when(C("action") == a, C("rank"))).alias(f"average_{a}_rank")
    return trades.groupBy("date").agg(*[n(a) for a in ACTIONS], F.count("*").alias("n_total"), F.coalesce(F.sum(F.abs("trade_weight")), F.lit(0.0)).alias("gross_turnover"), rank("buy"), rank("sell"))


def holding_periods(weights: DataFrame) -> DataFrame:
    """(asset, start, n_dates): runs of consecutive dates on which an asset is held."""
    dates = F.broadcast(date_index(weights))
    held = weights.where(C("weight") != 0).join(dates, "date")
    island = held.withColumn("_g", C("i") - F.row_number().over(Window.partitionBy("asset").orderBy("i")))
    return island.groupBy("asset", "_g").agg(F.min("date").alias("start"), F.count("*").alias("n_dates")).drop("_g")


def rank_migration(weights: DataFrame, ranks: DataFrame, bins: tuple[int, ...] = (50, 100, 200)) -> DataFrame:
    """(from_bin, to_bin, n): moves between rank bins from a held row to the asset's next one, zeros included."""
    label = F.lit(f">{bins[-1]}")
    for lo, hi in reversed(list(zip((0, *bins), bins))):
        label = F.when(C("rank") <= hi, f"{lo + 1}-{hi}").otherwise(label)
    names = [f"{lo + 1}-{hi}" for lo, hi in zip((0, *bins), bins)] + [f">{bins[-1]}"]
    rows = weights.where(C("weight") != 0).join(ranks, ["date", "asset"]).where("rank is not null").withColumn("to_bin", label)
    rows = rows.withColumn("from_bin", F.lag("to_bin").over(Window.partitionBy("asset").orderBy("date"))).where("from_bin is not null")
    grid = weights.sparkSession.createDataFrame([(a, b) for a in names for b in names], "from_bin string, to_bin string")
    return grid.join(rows.groupBy("from_bin", "to_bin").agg(F.count("*").alias("n")), ["from_bin", "to_bin"], "left").na.fill(0, ["n"])


def _next_returns(trades: DataFrame, returns: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    """(action, horizon, r): a row for each trade and horizon, with the compounded return of the first rows after it."""
    w = Window.partitionBy("asset").orderBy("date")
    ahead = returns.select("asset", "date", F.lit(0).alias("_k"), F.struct(*[F.coalesce(F.product(1 + C("ret_1d")).over(w.rowsBetween(0, h - 1)), F.lit(1.0)).alias(f"f{h}") for h in horizons]).alias("_f"))
    both = trades.select("asset", "date", "action", F.lit(1).alias("_k")).unionByName(ahead, allowMissingColumns=True)
    # from the last date back, so that the frame runs and costs one step a row
    back = Window.partitionBy("asset").orderBy(C("date").desc(), C("_k").desc())
    hit = both.withColumn("_n", F.last("_f", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))).where("_k = 1")
    return hit.select("action", F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), (C(f"_n.f{h}") - 1).alias("r")) for h in horizons])).alias("x")).select("action", "x.*")


def trade_forward_returns(trades: DataFrame, returns: DataFrame, horizons: tuple[int, ...] = (5, 20)) -> DataFrame:
    """(action, horizon, n, mean_ret, median_ret): compounded returns of the first rows after each trade."""
    long = written(_next_returns(trades, returns, horizons), "after_trades")
    by = ("action", "horizon")
    means = long.groupBy(*by).agg(F.count("r").alias("n"), F.avg("r").alias("mean_ret"))
    middle = exact_percentiles(long, by, "r", {"median_ret": 0.5})
    return left_on(means, middle, by).select(*by, "n", "mean_ret", "median_ret")
