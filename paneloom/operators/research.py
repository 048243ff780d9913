"""Composed research runs: aligned frames, signal quality, candidate suites, factor families, constraint impact, portfolio suites."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..core.expr import qcut_first, require, safe_corr
from ..core.scratch import written
from . import checks, diagnostics, portfolio, signals, universe

C = F.col
KEYS = ("date", "asset")


def aligned(features: DataFrame, signal: str, labels: list[str]) -> tuple[DataFrame, DataFrame]:
    """(date, asset, signal, labels) of the rows that have them all, and one row of what was there before and after."""
    require(features, signal, *labels)
    raw = features.select(*KEYS, C(signal).alias("signal"), *labels)
    whole = C("signal").isNotNull()
    for c in labels:
        whole = whole & C(c).isNotNull()
    kept = lambda c: F.countDistinct(F.when(whole, C(c)))
    stats = raw.agg(F.count("*").alias("n_rows_before"), F.count_if(whole).alias("n_rows_after"), F.coalesce(F.try_divide(F.count_if(whole), F.count("*")), F.lit(0.0)).alias("coverage_ratio"), kept("date").alias("n_dates"), kept("asset").alias("n_assets"))
    return raw.where(whole), stats


def strictly_joined(signal: DataFrame, label: DataFrame, strict: bool = True) -> DataFrame:
    """Signal and label of equal keys; strict: keys that only one side has raise."""
    both = signal.withColumn("_s", F.lit(True)).join(label.withColumn("_l", F.lit(True)), list(KEYS), "full_outer")
    if strict and (odd := both.where("_s is null or _l is null").select(*KEYS).take(3)):
        raise ValueError(f"keys differ: {[tuple(r) for r in odd]}")
    return both.where("_s and _l").drop("_s", "_l")


def momentum_baseline(features: DataFrame) -> DataFrame:
    """(date, asset, signal): percentile rank of the 20-day return."""
    return features.select(*KEYS, signals.rank(C("ret_20d")).alias("signal"))


def global_quantile_spread(returns: DataFrame) -> DataFrame:
    """(date, spread): highest less lowest quantile that stands on any date; NULL where a date lacks either."""
    ends = returns.agg(F.max("quantile").alias("_hi"), F.min("quantile").alias("_lo"))
    at = lambda c: F.max(F.when(C("quantile") == C(c), C("mean_ret")))
    return returns.join(F.broadcast(ends)).groupBy("date").agg((at("_hi") - at("_lo")).alias("spread"))


#: Numbers that one task ranks or pairs: SOME while that takes at most FEW tasks, which a shuffle writes without holding rows, and never more than MOST.
SOME, FEW, MOST = 1 << 21, 200, 1 << 24


def _tasks(numbers: int) -> int:
    return max(min(FEW, -(-numbers // SOME)), -(-numbers // MOST), 1)


def _ranks_in_range(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (id, f, v, there) of one range of values, in order of f and v: r{b} is v's average rank within the range among its rows that
    have b too, n{b} is whether the row is one of them; edge: 1 for a factor's first value in the range, 2 for its last, else 0."""

    def run(batches):
        if not (batches := list(batches)):
            return
        rows = pa.Table.from_batches(batches).combine_chunks()
        f, v = rows["f"].to_numpy(), rows["v"].to_numpy()
        there = rows["there"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(f), k)
        factor = np.append(True, f[1:] != f[:-1])
        fresh = factor | np.append(True, (v[1:] != v[:-1]) & ~(np.isnan(v[1:]) & np.isnan(v[:-1])))
        starts, value = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        own = np.maximum.accumulate(np.where(factor[starts], np.arange(len(starts)), 0))
        edge = np.where(factor[starts], 1, np.where(np.append(factor[starts[1:]], True), 2, 0)).astype(np.int32)[value]
        out = {"id": rows["id"], "f": rows["f"], "v": rows["v"], "part": pa.array(np.full(len(f), TaskContext.get().partitionId(), np.int32)), "edge": pa.array(edge)}
        for b in range(k):
            upto = np.append(0, np.cumsum(there[:, b]))
            less, same = upto[starts] - upto[starts[own]], np.diff(upto[np.append(starts, len(f))])
            out[f"n{b}"] = pa.array(there[:, b])
            out[f"r{b}"] = pa.array((less + (same + 1) / 2)[value], mask=~there[:, b] | (f == b))
        yield from pa.table(out).to_batches(max_chunksize=1 << 14)

    return run


def _pair_ranks(base: DataFrame, k: int, tasks: int) -> DataFrame:
    """(id, f, r0...) of every value of a factor f: r{b} is its average rank among the rows that also have factor b.

    Ranges are cut by value and id, so that a value of very many rows is several tasks'. What stands before a range is added to its ranks;
    a value at its edge may go on in others, and takes its rank from the counts of all of them."""
    there = F.transform("values", lambda v: v.isNotNull())
    long = base.select("id", there.alias("there"), F.posexplode("values").alias("f", "v")).where("v is not null").select("id", "f", "v", "there")
    kind = "id long, f int, v double, part int, edge int, " + ", ".join(f"n{b} boolean, r{b} double" for b in range(k))
    placed = written(long.repartitionByRange(tasks, "f", "v", "id").sortWithinPartitions("f", "v").mapInArrow(_ranks_in_range(k), kind), "ranks")
    # at most three rows for each factor and range
    ends = placed.groupBy("f", "part", "edge").agg(F.max(F.when(C("edge") > 0, C("v"))).alias("v"), *[F.count_if(f"n{b}").alias(f"n{b}") for b in range(k)])
    before, here, one = Window.partitionBy("f").orderBy("part").rangeBetween(Window.unboundedPreceding, -1), Window.partitionBy("f", "part"), Window.partitionBy("f", "v")
    past = [F.coalesce(F.sum(f"n{b}").over(before), F.lit(0)).alias(f"p{b}") for b in range(k)]
    less = [F.when(C("edge") == 2, F.sum(f"n{b}").over(here) - C(f"n{b}")).otherwise(0).alias(f"l{b}") for b in range(k)]
    ends = ends.select("*", *past, *less)
    whole = [F.min(C(f"p{b}") + C(f"l{b}")).over(one) - C(f"l{b}") + (F.sum(f"n{b}").over(one) - C(f"n{b}")) / 2 for b in range(k)]
    add = ends.select("f", "part", "edge", *[F.when(C("edge") > 0, whole[b]).otherwise(C(f"p{b}")).alias(f"a{b}") for b in range(k)])
    return placed.join(F.broadcast(add), ["f", "part", "edge"]).select("id", "f", *[(C(f"r{b}") + C(f"a{b}")).alias(f"r{b}") for b in range(k)])


def rank_correlation(factors: DataFrame, columns: list[str], least: int = 20) -> DataFrame:
    """(a, b, corr, n_obs): Spearman correlation of every pair of factors, pooled, with ranks over the rows that have both; no row for a pair
    without such rows, and none at all for fewer than two factors.

    The table is made long by factor, not by pair: each value gets its ranks beside every other factor at once, and a row's values meet
    again by the row's number. All pairs are then one aggregation. Both dealings take tasks by the number of ranks."""
    k = len(columns)
    if k < 2:
        return factors.sparkSession.createDataFrame([], "a string, b string, corr double, n_obs long")
    values = F.array(*[C(c).cast("double") for c in columns])
    base = written(factors.select(F.monotonically_increasing_id().alias("id"), values.alias("values")), "factors")
    tasks = _tasks(base.count() * k * k)
    pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
    of = lambda i, j: F.max(F.when(C("f") == i, C(f"r{j}")))
    sides = [x for i, j in pairs for x in (of(i, j).alias(f"x{i}_{j}"), of(j, i).alias(f"y{i}_{j}"))]
    wide = _pair_ranks(base, k, tasks).repartition(tasks, "id").groupBy("id").agg(*sides)
    both = lambda i, j: F.count_if(C(f"x{i}_{j}").isNotNull() & C(f"y{i}_{j}").isNotNull())
    stats = wide.agg(*[F.struct(safe_corr(C(f"x{i}_{j}"), C(f"y{i}_{j}")).alias("corr"), both(i, j).alias("n_obs")).alias(f"p{i}_{j}") for i, j in pairs])
    rows = [F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"), C(f"p{i}_{j}.corr").alias("corr"), C(f"p{i}_{j}.n_obs").alias("n_obs")) for i, j in pairs]
    out = stats.select(F.inline(F.array(*rows))).where("n_obs > 0")
    return out.withColumn("corr", F.when(C("n_obs") >= least, C("corr")))


def basic_diagnostics(factors: DataFrame, columns: list[str], label: str | None = None, threshold: float = 0.9, method: str = "spearman", spread: bool = True) -> dict[str, DataFrame]:
    """Coverage, distribution, correlation, pairs of high correlation and, with a label among the columns, IC by date and its summary.
    Outcomes among the factors raise. Without `spread` there is no distribution, whose values are counted and written as it is made."""
    checks.check_factor_columns(factors.select(*columns))
    corr = rank_correlation(factors, columns) if method == "spearman" else diagnostics.factor_correlation(factors, columns)
    out = {"coverage": diagnostics.coverage(factors, columns), "correlation": corr, "high_correlation_pairs": diagnostics.highly_correlated(corr, threshold)}
    if spread:
        out["distribution"] = diagnostics.distribution(factors, columns)
    if label:
        ic = diagnostics.factor_ic(factors.drop(label), columns, factors, label, method)
        out |= {"ic_by_date": ic, "ic_summary": diagnostics.summarize_ic(ic, "factor")}
    return out


def feature_correlation(frame: DataFrame, signal: str, columns: list[str]) -> DataFrame:
    """(date, feature, correlation) of a signal with each feature."""
    long = diagnostics.long_form(frame, columns, ("date", signal), "feature")
    return long.groupBy("date", "feature").agg(safe_corr(C(signal), C("value")).alias("correlation"))


def exposure_summary(frame: DataFrame, signal: str, columns: list[str], cap: str = "market_cap", group: str = "grp") -> DataFrame:
    """(kind, name, mean, std, n_days): exposures to size, to each group and to each feature, over all days."""
    named = lambda df, kind, name, value: df.select(F.lit(kind).alias("kind"), name.cast("string").alias("name"), C(value).alias("v"))
    each = named(diagnostics.size_exposure(frame, signal, cap), "size", F.lit(cap), "size_exposure")
    each = each.unionByName(named(diagnostics.group_exposure(frame, signal, group), "group", C(group), "mean_signal")).unionByName(named(feature_correlation(frame, signal, columns), "feature", C("feature"), "correlation"))
    return each.groupBy("kind", "name").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.count("v").alias("n_days"))


def _quality(long: DataFrame, q: int, *by: str) -> DataFrame:
    """A row for each by: rank IC summary, mean names a date, and the mean over dates of the top quantile's return less that of all
    (quantile_spread) and of the bottom one (top_minus_bottom), from the long form (by, date, asset, value, label) of complete pairs.
    All of it from one dealing by date: quantiles and ranks of the value share one sort."""
    p = (*by, "date")
    placed = long.select(*p, "value", "label", qcut_first(C("value"), q, *p, least=q).alias("quantile"))
    ranked = placed.select(*p, "label", "quantile", diagnostics.avg_rank(C("value"), *p).alias("x")).select("*", diagnostics.avg_rank(C("label"), *p).alias("y"))
    daily = ranked.groupBy(*p).agg(safe_corr(C("x"), C("y")).alias("ic"), F.count("x").alias("n"), *[F.avg(F.when(C("quantile") == k, C("label"))).alias(f"m{k}") for k in range(1, q + 1)])
    held = F.filter(F.array(*[C(f"m{k}") for k in range(1, q + 1)]), lambda m: m.isNotNull())
    mean = F.try_divide(F.aggregate(held, F.lit(0.0), lambda a, m: a + m), F.size(held))
    out = diagnostics.summarize_ic(daily, *by, avg_assets=F.avg("n"), quantile_spread=F.avg(C(f"m{q}") - mean), top_minus_bottom=F.avg(C(f"m{q}") - C("m1")), _placed=F.count(mean))
    return out.where("_placed > 0").drop("_placed")


def signal_quality(features: DataFrame, signal: str, labels: list[str], q: int = 5) -> DataFrame:
    """One row a horizon: rank IC summary and quantile spreads of a signal, over rows that have the signal and all labels."""
    rows, _ = aligned(features, signal, labels)
    long = rows.unpivot([*KEYS, "signal"], labels, "horizon", "label").withColumnRenamed("signal", "value")
    return _quality(long, q, "horizon").drop("avg_assets")


def candidate_suite(features: DataFrame, candidates: dict[str, tuple[str, int]], horizons: list[str], q: int = 5, least_dates: int = 20, least_assets: int = 20) -> DataFrame:
    """A row for each candidate signal and horizon: rank IC summary, spreads, average names a date, and warnings of small samples.
    A candidate or horizon whose column is missing is left out."""
    have = {n: cs for n, cs in candidates.items() if cs[0] in features.columns}
    labels = [h for h in horizons if h in features.columns]
    wide = features.select(*KEYS, *labels, *[(C(c) * sign).cast("double").alias(n) for n, (c, sign) in have.items()])
    long = wide.unpivot([*KEYS, *labels], list(have), "signal_name", "value").unpivot([*KEYS, "signal_name", "value"], labels, "horizon", "label").where("value is not null and label is not null")
    out = _quality(long, q, "signal_name", "horizon")
    few = F.when(C("n_dates") < least_dates, "small sample size")
    thin = F.when(C("avg_assets") < least_assets, "insufficient cross-sectional assets")
    return out.withColumn("warnings", F.concat_ws(";", few, thin))


def risk_diagnostics(features: DataFrame, horizons: list[str], buckets: int = 3) -> DataFrame:
    """A row for each condition (volatility, liquidity, size), bucket and horizon: rank IC of the 20-day return inside the bucket, over
    eligible rows. One long form, so one shuffle for all conditions."""
    keep = features.where(universe.eligibility(features, ["ret_20d"]))
    names = ["vol_20d_z", "liquidity_z", "size_z"]
    exposed = signals.risk_exposures(keep, keep=("ret_20d", *horizons)).select("*", *[F.round(n, 9).alias(f"_{n}") for n in names]).drop(*names).withColumnsRenamed({f"_{n}": n for n in names})
    placed = signals.condition_buckets(exposed, names, buckets)
    long = placed.unpivot([*KEYS, "ret_20d", *horizons], [f"{n}_bucket" for n in names], "condition", "bucket").where("bucket is not null")
    long = long.unpivot([*KEYS, "ret_20d", "condition", "bucket"], horizons, "horizon", "label")
    daily = diagnostics.daily_ic(long, "ret_20d", "label", "spearman", ("condition", "horizon", "bucket", "date"))
    return diagnostics.summarize_ic(daily, "condition", "horizon", "bucket")


def run_coverage(features: DataFrame, columns: list[str]) -> DataFrame:
    """One row: rows before and after the eligibility mask, dates, assets, names a date, and values of each column."""
    ok = universe.eligibility(features, ["ret_20d"])
    dates, inside = F.countDistinct(F.when(ok, C("date"))), F.count_if(ok)
    return features.agg(F.count("*").alias("n_rows_loaded"), inside.alias("n_rows_after_eligibility"), dates.alias("n_dates"), F.countDistinct(F.when(ok, C("asset"))).alias("n_assets"),
                        F.coalesce(F.try_divide(inside, dates), F.lit(0.0)).alias("avg_assets_per_date"), *[F.count(F.when(ok, C(c))).alias(f"{c}_non_null_count") for c in columns])


def run_factor_family(panel: DataFrame, builder: Callable[[DataFrame], DataFrame], columns: list[str], low: float = 0.2) -> DataFrame:
    """A row for each factor of a family: coverage, infinities, moments, and a warning of zero or low coverage or of infinite values."""
    factors = builder(panel)
    checks.check_factor_columns(factors)
    out = checks.summarize_factors(factors, columns)
    zero, few = F.when(C("coverage") == 0, "zero coverage"), F.when((C("coverage") > 0) & (C("coverage") < low), "low coverage")
    return out.withColumn("warnings", F.concat_ws(";", zero, few, F.when(C("n_inf") > 0, "infinite values")))


def constraint_impact(frame: DataFrame, n: int, label: str, freq: str = "M", cost_bps: float = 10.0, slippage_bps: float = 5.0, **constraints) -> DataFrame:
    """One row for each variant, unconstrained and constrained: total return, Sharpe ratio, mean turnover, mean IC of the weights with the
    label, mean size exposure and mean absolute weight of a group.

    The frame and each variant's weights are written once: the weights of rebalance dates are among those of all dates, as each date is
    weighed by itself."""
    frame = written(frame, "impact")
    ends = F.broadcast(portfolio.rebalance_dates(frame.where("signal is not null"), freq))
    out = None
    for name, limits in (("unconstrained", {}), ("constrained", constraints)):
        weights = written(portfolio.build_top_n(frame, n, **limits), name)
        marked = weights.join(ends, "date", "left_semi")
        daily = portfolio.held_backtest(marked, frame.select(*KEYS, "ret_1d"), frame.where("signal is not null"), cost_bps, slippage_bps)
        result = portfolio.performance(daily, "net").select("total_return", "sharpe").join(F.broadcast(daily.agg(F.avg("turnover").alias("turnover"))))
        both = weights.join(frame.select(*KEYS, label, "market_cap", "grp"), list(KEYS))
        by_date = both.groupBy("date").agg(safe_corr(C("weight"), C(label)).alias("ic"), safe_corr(C("weight"), F.when(C("market_cap") > 0, F.log("market_cap"))).alias("size_exposure"))
        groups = both.where("grp is not null").groupBy("date", "grp").agg(F.abs(F.sum("weight")).alias("w")).groupBy("date").agg(F.avg("w").alias("w"))
        row = result.join(F.broadcast(by_date.agg(F.avg("ic").alias("ic"), F.avg("size_exposure").alias("size_exposure")))).join(F.broadcast(groups.agg(F.avg("w").alias("group_exposure"))))
        row = row.select(F.lit(name).alias("variant"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def impact_differences(impact: DataFrame) -> DataFrame:
    """One row: constrained less unconstrained of every figure."""
    at = lambda v, c: F.max(F.when(C("variant") == v, C(c)))
    return impact.agg(*[(at("constrained", c) - at("unconstrained", c)).alias(f"{c}_diff") for c in ("total_return", "sharpe", "turnover", "ic", "size_exposure", "group_exposure")])


def portfolio_suite(features: DataFrame, candidates: dict[str, tuple[str, int]], n: int, costs: list[float], freq: str = "M") -> DataFrame:
    """(strategy_name, cost_bps, date, gross, turnover, cost, net) of every candidate at every cost: weights once for each signal."""
    out, levels = None, F.explode(F.array(*[F.lit(float(c)) for c in costs])).alias("cost_bps")
    for name, (column, sign) in candidates.items():
        frame = features.select(*KEYS, "ret_1d", F.round(signals.rank(C(column) * sign), 9).alias("signal"))
        marked = portfolio.build_top_n(portfolio.on_rebalance_dates(frame, freq), n)
        daily = portfolio.held_backtest(marked, frame, frame.where("signal is not null"), 0.0).select(F.lit(name).alias("strategy_name"), "date", "gross", "turnover")
        out = daily if out is None else out.unionByName(daily)
    out = out.select("*", levels).withColumn("cost", C("turnover") * C("cost_bps") / 1e4)
    return out.withColumn("net", F.coalesce("gross", F.lit(0.0)) - C("cost"))
