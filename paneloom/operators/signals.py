"""Cross-sectional transforms: within each date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.expr import avg_rank, qcut_first

C = F.col


def _date():
    return Window.partitionBy("date")


def winsorize(x: Column, lower: float = 0.01, upper: float = 0.99) -> Column:
    low, high = (F.percentile(x, F.lit(q)).over(_date()) for q in (lower, upper))
    return F.when(x.isNotNull(), F.greatest(low, F.least(high, x)))


def zscore(x: Column, ddof: int = 0, flat: float | None = 0.0) -> Column:
    """Standard score; where the date's values do not spread, `flat` for every row of the date."""
    sd = (F.stddev_samp(x) if ddof else F.stddev_pop(x)).over(_date())
    return F.when(F.coalesce(sd, F.lit(0.0)) == 0, F.lit(flat).cast("double")).otherwise((x - F.avg(x).over(_date())) / F.when(sd != 0, sd))


def rank(x: Column, pct: bool = True) -> Column:
    return avg_rank(x, "date", pct=pct)


def neutralize_by_size(x: Column, cap: Column) -> Column:
    """Residual of x on the logarithm of size; a size that does not vary leaves x without its mean; fewer than two pairs give NULL."""
    size = F.log(F.greatest(cap, F.lit(1e-12)))
    both = x.isNotNull() & cap.isNotNull()
    y, s = F.when(both, x), F.when(both, size)
    var = F.var_pop(s).over(_date())
    slope = F.when(F.coalesce(var, F.lit(0.0)) > 1e-18, F.covar_pop(s, y).over(_date()) / F.when(var > 0, var)).otherwise(0.0)
    return F.when(F.count(y).over(_date()) >= 2, y - F.avg(y).over(_date()) - slope * (s - F.avg(s).over(_date())))


def neutralize_by_group(x: Column, group: str = "grp") -> Column:
    return F.when(C(group).isNotNull(), x - F.avg(x).over(Window.partitionBy("date", group)))


def linear_combine(frame: DataFrame, weights: dict[str, float]) -> Column:
    """Weighted sum of signal columns of one frame; a missing one counts as 0 unless all are missing."""
    none = F.lit(True)
    for c in weights:
        none = none & C(c).isNull()
    total = sum((F.coalesce(C(c), F.lit(0.0)) * w for c, w in weights.items()), F.lit(0.0))
    return F.when(~none, total)


TRANSFORMS = {"winsorize": winsorize, "zscore": zscore, "rank": rank, "neutralize_by_size": lambda x, cap="market_cap": neutralize_by_size(x, C(cap)), "neutralize_by_group": neutralize_by_group}


def run_recipe(frame: DataFrame, recipe: dict[str, dict], weights: dict[str, float] | None = None) -> DataFrame:
    """{signal: {"column": c, "steps": [(transform, params), ...]}} to a frame of signals, and their combination as `signal`."""
    out = frame
    for name, spec in recipe.items():
        if spec["column"] not in frame.columns:
            raise KeyError(f"unknown column: {spec['column']}")
        out = out.withColumn(name, C(spec["column"]))
        for step, params in spec.get("steps", ()):
            if step not in TRANSFORMS:
                raise KeyError(f"unknown transform: {step}")
            out = out.withColumn(name, TRANSFORMS[step](C(name), **params))
    if weights:
        if missing := set(recipe) - set(weights):
            raise KeyError(f"no weight for: {', '.join(sorted(missing))}")
        out = out.withColumn("signal", linear_combine(out, weights))
    return out.select("date", "asset", *recipe, *(["signal"] if weights else []))


def demo_alpha(features: DataFrame) -> DataFrame:
    return run_recipe(features, {"mom": {"column": "ret_20d", "steps": [("rank", {})]}, "vol": {"column": "vol_20d", "steps": [("zscore", {})]}}, {"mom": 1.0, "vol": -0.5}).select("date", "asset", "signal")


def signed_candidates(features: DataFrame, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """(signal_name, date, asset, value): percentile rank of each signed column, in one pass over the long form."""
    wide = features.select("date", "asset", *[(C(c) * s).alias(n) for n, (c, s) in columns.items()])
    long = wide.unpivot(["date", "asset"], list(columns), "signal_name", "raw")
    return long.select("signal_name", "date", "asset", avg_rank(C("raw"), "signal_name", "date", pct=True).alias("value"))


def risk_exposures(features: DataFrame, clip: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Standardised volatility, liquidity and size, and the columns to keep; a date without spread is NULL."""
    log = lambda c: F.when(C(c) > 0, F.log(C(c)))
    base = features.select("date", "asset", *keep, C("vol_20d").alias("vol_20d_z"), log("amount_20d").alias("liquidity_z"), log("market_cap").alias("size_z"))
    names = ("vol_20d_z", "liquidity_z", "size_z")
    if clip:
        base = base.select("date", "asset", *keep, *[winsorize(C(n)).alias(n) for n in names])
    return base.select("date", "asset", *keep, *[zscore(C(n), flat=None).alias(n) for n in names])


def condition_buckets(exposures: DataFrame, columns: list[str], n: int = 3) -> DataFrame:
    return exposures.select("*", *[qcut_first(C(c), n, "date", least=n).alias(f"{c}_bucket") for c in columns])
