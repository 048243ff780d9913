"""Information coefficients, quantile returns, coverage and exposure statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.expr import avg_rank, by_asset, qcut_first, safe_corr
from ..core.scratch import written

C = F.col


def _paired(frame: DataFrame, signal: str, label: str, keys: tuple[str, ...]) -> DataFrame:
    both = C(signal).isNotNull() & C(label).isNotNull()
    return frame.select(*keys, F.when(both, C(signal)).alias("x"), F.when(both, C(label)).alias("y"))


def daily_ic(frame: DataFrame, signal: str, label: str, method: str = "pearson", by: tuple[str, ...] = ("date",), least: int = 2) -> DataFrame:
    """(by..., ic, n): correlation of signal and label within each group, over complete pairs; every group keeps its row."""
    pairs = _paired(frame, signal, label, by)
    if method == "spearman":
        # one after the other, so that the second sort carries no value of the first
        pairs = pairs.select(*by, avg_rank(C("x"), *by).alias("x"), "y").select(*by, "x", avg_rank(C("y"), *by).alias("y"))
    return pairs.groupBy(*by).agg(F.when(F.count("x") >= least, safe_corr(C("x"), C("y"))).alias("ic"), F.count("x").alias("n"))


def summarize_ic(ic: DataFrame, *by: str, **more: Column) -> DataFrame:
    """Figures of the groups' correlations, and more aggregates by name."""
    mean, sd, n = F.avg("ic"), F.stddev_samp("ic"), F.count("ic")
    return ic.groupBy(*by).agg(
        mean.alias("mean_ic"), F.median("ic").alias("median_ic"), sd.alias("std_ic"), F.try_divide(mean, sd).alias("icir"),
        F.try_divide(mean, sd / F.sqrt(n)).alias("t_stat"), F.avg(F.when(C("ic").isNotNull(), (F.round("ic", 12) > 0).cast("double"))).alias("positive_rate"), n.alias("n_dates"),
        *[c.alias(k) for k, c in more.items()],
    )


def ic_summary(frame: DataFrame, signal: str, label: str) -> DataFrame:
    """One row: mean and (population) deviation of the daily correlation and rank correlation, and the days that have one."""
    plain, ranked = daily_ic(frame, signal, label), daily_ic(frame, signal, label, "spearman")
    two = plain.select("date", "ic").join(ranked.select("date", C("ic").alias("rank_ic")), "date")
    return two.agg(F.avg("ic").alias("ic_mean"), F.stddev_pop("ic").alias("ic_std"), F.avg("rank_ic").alias("rank_ic_mean"), F.stddev_pop("rank_ic").alias("rank_ic_std"), F.count("ic").alias("n_days"))


def long_form(frame: DataFrame, columns: list[str], keys: tuple[str, ...] = ("date", "asset"), name: str = "factor") -> DataFrame:
    return frame.select(*keys, *[C(c).cast("double").alias(c) for c in columns]).unpivot(list(keys), columns, name, "value")


def factor_ic(factors: DataFrame, columns: list[str], labels: DataFrame, label: str, method: str = "spearman", least: int = 10) -> DataFrame:
    """(factor, date, ic, n) for many factors with one shuffle of the long form."""
    wide = factors.join(labels.select("date", "asset", label), ["date", "asset"])
    return daily_ic(long_form(wide, columns, ("date", "asset", label)), "value", label, method, ("factor", "date"), least)


def quantile_returns(frame: DataFrame, signal: str, label: str, q: int = 5) -> DataFrame:
    """(date, quantile, mean_ret, n) with equally filled quantiles."""
    full = frame.where(C(signal).isNotNull() & C(label).isNotNull()).withColumn("quantile", qcut_first(C(signal), q, "date", least=q))
    return full.where("quantile is not null").groupBy("date", "quantile").agg(F.avg(label).alias("mean_ret"), F.count("*").alias("n"))


def quantile_spread(returns: DataFrame, q: int = 5) -> DataFrame:
    """One row: top less bottom and top less the mean of all quantiles, with their t statistic."""
    at = lambda k: F.max(F.when(C("quantile") == k, C("mean_ret")))
    daily = returns.groupBy("date").agg((at(q) - at(1)).alias("spread"), (at(q) - F.avg("mean_ret")).alias("top_excess"))
    t = F.try_divide(F.avg("spread"), F.stddev_samp("spread") / F.sqrt(F.count("spread")))
    return daily.agg(F.avg("spread").alias("mean_spread"), F.avg("top_excess").alias("mean_top_excess"), t.alias("t_stat"), F.count("spread").alias("n_dates"))


def edge_quantile_returns(frame: DataFrame, signal: str, label: str, q: int = 5) -> DataFrame:
    """(date, quantile, mean_ret): quantiles by value edges of which equal ones are dropped; dates with fewer than two values go."""
    full = frame.where(C(signal).isNotNull() & C(label).isNotNull())
    w = Window.partitionBy("date")
    edges = F.array_distinct(F.percentile(C(signal), F.array(*[F.lit(i / q) for i in range(q + 1)])).over(w))
    wide = full.withColumn("edges", edges).withColumn("_lo", F.min(signal).over(w)).withColumn("_hi", F.max(signal).over(w))
    cut = wide.where("_lo < _hi").withColumn("quantile", F.greatest(F.lit(1), F.size(F.filter("edges", lambda e: e < C(signal)))))
    return cut.groupBy("date", "quantile").agg(F.avg(label).alias("mean_ret"))


def decay(frame: DataFrame, signal: str, labels: list[str]) -> DataFrame:
    """(horizon, mean_ic, mean_rank_ic, n_dates) for several labels: values and their ranks in one pass over the long form."""
    by = ("horizon", "date")
    pairs = _paired(long_form(frame, labels, ("date", signal), "horizon"), signal, "value", by)
    pairs = pairs.select(*by, "x", "y", avg_rank(C("x"), *by).alias("rx")).select("*", avg_rank(C("y"), *by).alias("ry"))
    daily = pairs.groupBy(*by).agg(*[F.when(F.count("x") >= 2, safe_corr(C(a), C(b))).alias(c) for a, b, c in (("x", "y", "ic"), ("rx", "ry", "rank_ic"))])
    return daily.groupBy("horizon").agg(F.avg("ic").alias("mean_ic"), F.avg("rank_ic").alias("mean_rank_ic"), F.count("ic").alias("n_dates"))


def factor_correlation(factors: DataFrame, columns: list[str], least: int = 20) -> DataFrame:
    """(a, b, corr, n_obs) of every pair of factors, pooled, over complete pairs: one aggregation for all pairs."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    n = lambda a, b: F.count(F.when(C(a).isNotNull() & C(b).isNotNull(), 1))
    one = factors.agg(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.when(n(a, b) >= least, safe_corr(C(a), C(b))).alias("corr"), n(a, b).alias("n_obs")) for a, b in pairs]).alias("p"))
    return one.select(F.explode("p").alias("p")).select("p.*")


def highly_correlated(corr: DataFrame, least: float = 0.9) -> DataFrame:
    return corr.where(F.abs("corr") >= least)


def coverage(factors: DataFrame, columns: list[str]) -> DataFrame:
    long = long_form(factors, columns)
    has = C("value").isNotNull()
    return long.groupBy("factor").agg(F.count("*").alias("n_total"), F.count("value").alias("n_non_null"), (F.count("value") / F.count("*")).alias("coverage"), F.countDistinct(F.when(has, C("date"))).alias("n_dates"), F.countDistinct(F.when(has, C("asset"))).alias("n_assets"))


def left_on(left: DataFrame, right: DataFrame, by: tuple[str, ...], how: str = "left") -> DataFrame:
    """Join in which null keys are equal; the keys are those of the left side."""
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & C(c).eqNullSafe(C(f"_r_{c}"))
    return left.join(right, same, how).drop(*[f"_r_{c}" for c in by])


def exact_percentiles(long: DataFrame, by: tuple[str, ...], value: str, qs: dict[str, float]) -> DataFrame:
    """(by..., a column for each of qs): interpolated percentiles of each group, exact; a group without values has no row.

    Values are counted and dealt by ranges, so that no task holds a group: sums of the ranges tell which of them hold a wanted place, and
    only these are sorted."""
    counts = long.where(C(value).isNotNull()).groupBy(*by, C(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    part = written(counts.repartitionByRange(*by, "_v").withColumn("_part", F.spark_partition_id()), "values")
    up = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    sums = part.groupBy(*by, "_part").agg(F.sum("_n").alias("_s"))
    sums = sums.select(*by, "_part", (F.sum("_s").over(up) - C("_s")).alias("_before"), F.sum("_s").over(up).alias("_end"), F.sum("_s").over(Window.partitionBy(*by)).alias("_all"))
    at = {c: F.lit(q) * (C("_all") - 1) for c, q in qs.items()}
    places = [f(h) for h in at.values() for f in (F.floor, F.ceil)]
    sums = sums.where(F.exists(F.array(*places), lambda k: (k >= C("_before")) & (k < C("_end"))))
    upto = C("_before") + F.sum("_n").over(Window.partitionBy(*by, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    # a row for each group and range of values, of which there are as many as shuffle partitions and groups
    placed = left_on(part, F.broadcast(sums), (*by, "_part"), "inner").select(*by, "_v", "_all", "_n", upto.alias("_upto"))
    here = lambda k: F.max(F.when((k >= C("_upto") - C("_n")) & (k < C("_upto")), C("_v")))
    ends = placed.groupBy(*by, "_all").agg(*[here(f(h)).alias(f"{c}_{n}") for c, h in at.items() for n, f in (("lo", F.floor), ("hi", F.ceil))])
    mix = {c: F.when(F.floor(h) == F.ceil(h), C(f"{c}_lo")).otherwise((F.ceil(h) - h) * C(f"{c}_lo") + (h - F.floor(h)) * C(f"{c}_hi")) for c, h in at.items()}
    return ends.select(*by, *[x.alias(c) for c, x in mix.items()])


def distribution(factors: DataFrame, columns: list[str]) -> DataFrame:
    """(factor, mean, std, min, p01..p99, max), with exact percentiles."""
    long = long_form(written(factors.select(*columns), "factors"), columns, ())
    qs = {f"p{q:02d}": q / 100 for q in (1, 5, 25, 50, 75, 95, 99)}
    moments = long.groupBy("factor").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    return left_on(moments, exact_percentiles(long, ("factor",), "value", qs), ("factor",)).select("factor", "mean", "std", "min", *qs, "max")


def conditioned_ic(frame: DataFrame, bucket: str, signal: str, label: str) -> DataFrame:
    """Rank correlation inside each bucket, summarised for each bucket."""
    daily = daily_ic(frame.where(C(bucket).isNotNull()), signal, label, "spearman", ("date", bucket))
    return summarize_ic(daily, bucket, avg_n_assets=F.avg("n"))


def autocorrelation(frame: DataFrame, signal: str, lag: int = 1) -> DataFrame:
    lagged = frame.select("date", "asset", signal, F.lag(signal, lag).over(by_asset()).alias("before"))
    return lagged.groupBy("date").agg(safe_corr(C(signal), C("before")).alias("autocorr"))


def top_n(frame: DataFrame, signal: str, n: int, ascending: bool = False) -> DataFrame:
    order = C(signal).asc() if ascending else C(signal).desc()
    place = F.row_number().over(Window.partitionBy("date").orderBy(order, "asset"))
    return frame.where(C(signal).isNotNull()).withColumn("_p", place).where(C("_p") <= n).drop("_p")


def date_index(frame: DataFrame) -> DataFrame:
    """(date, i): dates numbered in order; a table of dates only."""
    return frame.select("date").distinct().withColumn("i", F.row_number().over(Window.orderBy("date")))


def date_grid(frame: DataFrame) -> DataFrame:
    """(date, asset): every date with every asset. One row, the list of dates (some thousands), is sent to the distinct assets."""
    days = frame.agg(F.array_sort(F.collect_set("date")).alias("days"))
    return frame.select("asset").distinct().join(F.broadcast(days)).select(F.explode("days").alias("date"), "asset")


def top_n_turnover(frame: DataFrame, signal: str, n: int) -> DataFrame:
    """(date, turnover): share of the top n that was not in it on the date before; 1 on the first date."""
    dates = date_index(frame.where(C(signal).isNotNull()))
    top = top_n(frame, signal, n).select("date", "asset").join(F.broadcast(dates), "date")
    before = top.select((C("i") + 1).alias("i"), "asset", F.lit(1).alias("was"))
    return top.join(before, ["i", "asset"], "left").groupBy("date").agg((1 - F.count("was") / n).alias("turnover"))


def size_exposure(frame: DataFrame, signal: str, cap: str = "market_cap") -> DataFrame:
    return frame.groupBy("date").agg(safe_corr(C(signal), F.when(C(cap) > 0, F.log(cap))).alias("size_exposure"))


def group_exposure(frame: DataFrame, signal: str, group: str = "grp") -> DataFrame:
    return frame.groupBy("date", group).agg(F.avg(signal).alias("mean_signal"))


def portfolio_exposure(weights: DataFrame, exposures: DataFrame, columns: list[str]) -> DataFrame:
    sums = weights.groupBy("date").agg(F.count_if(C("weight") != 0).alias("n_holdings"), F.sum(F.abs("weight")).alias("gross"), F.sum("weight").alias("net"))
    both = weights.join(exposures, ["date", "asset"]).groupBy("date").agg(*[F.sum(C("weight") * C(c)).alias(c) for c in columns])
    return sums.join(both, "date", "full_outer")


def exposure_stability(exposure: DataFrame, columns: list[str]) -> DataFrame:
    long = long_form(exposure, columns, ("date",), "exposure")
    return long.groupBy("exposure").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), *[F.percentile("value", F.lit(q)).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)], F.max("value").alias("max"))
