"""Column expressions that every operator shares: missing values, rolling windows, ranks, safe statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def no_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column; inside the library only NULL means missing."""
    kinds = dict(df.dtypes)
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in df.columns])


def by_asset(*keys: str) -> WindowSpec:
    return Window.partitionBy(*(keys or ("asset",))).orderBy("date")


def rolling(agg, x: Column, n: int, w: WindowSpec | None = None) -> Column:
    """agg of the last n rows, NULL unless all n are present. Present rows are counted by two running frames, which cost one step a row
    where a sliding one costs n."""
    w = w or by_asset()
    upto = lambda end: F.count(x).over(w.rowsBetween(Window.unboundedPreceding, end))
    return F.when(upto(0) - upto(-n) == n, agg(x).over(w.rowsBetween(-(n - 1), 0)))


def change(x: Column, k: int, w: WindowSpec | None = None) -> Column:
    """Relative change over k rows; a missing or zero base gives NULL. Missing values are not padded."""
    return F.try_divide(x, F.lag(x, k).over(w or by_asset())) - 1


def ahead(x: Column, k: int, w: WindowSpec | None = None) -> Column:
    return F.try_divide(F.lead(x, k).over(w or by_asset()), x) - 1


def ieee_div(a: Column, b: Column) -> Column:
    """Division in which a zero divisor shows as an infinity (or NaN for 0/0)."""
    signed = F.when(a > 0, float("inf")).when(a < 0, float("-inf")).when(a == 0, float("nan"))
    return F.when(b == 0, signed).otherwise(F.try_divide(a, b))


def avg_rank(x: Column, *part: str, pct: bool = False) -> Column:
    """Rank with ties averaged, over present values: the mean of a value's first and last place, both from one sort."""
    w = Window.partitionBy(*part).orderBy(x.asc_nulls_last())
    out = (F.rank().over(w) + F.count(x).over(w)) / 2
    if pct:
        out = out / F.count(x).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return F.when(x.isNotNull(), out)


def qcut_first(x: Column, q: int, *part: str, least: int = 2) -> Column:
    """Quantile bucket 1..q of ranks without ties (by value, then asset), exact in integers; NULL for fewer than `least` values."""
    w = Window.partitionBy(*part).orderBy(x.asc_nulls_last(), "asset")
    n = F.count(x).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))  # in the order of the places, so that one sort does
    r = F.row_number().over(w)
    bucket = F.greatest(F.lit(1), F.ceil(F.try_divide((r - 1) * q, n - 1)))
    return F.when(x.isNotNull() & (n >= max(2, least)), bucket.cast("int"))


def safe_corr(x: Column, y: Column) -> Column:
    """Aggregate: correlation over complete pairs; NULL for fewer than two or for a constant side."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.when((F.count(a) >= 2) & (spread > 0), F.try_divide(F.covar_pop(a, b), spread))


def period_end(date: Column, freq: str) -> Column:
    """Start of the period that the date is in, equal for dates of one period: weeks begin on Monday."""
    return F.date_trunc({"W": "week", "M": "month"}[freq], date)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
