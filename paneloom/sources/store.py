"""Partitioned stores of bars, features and margin rows: pruned reads, and the build of a feature store from raw bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.expr import no_nan
from ..operators.features import FEATURES, compute_features
from ..operators.lake import keep_last
from ..operators.normalise import alias_pick, to_day
from . import sinks

C = F.col

# Columns of a daily panel and of a feature store's rows. -----------------------------------------------------------------
PANEL_COLUMNS = ("open", "high", "low", "close", "volume", "amount", "is_tradable")
RAW_NUMBERS = ("open", "high", "low", "close", "volume", "amount", "turnover", "outstanding_share")
FEATURE_ROW = ("trade_date", "ts_code", *RAW_NUMBERS, "ret_1d", "ret_5d", "ret_20d", "vol_20d", "amount_20d", "turnover_5d", "turnover_20d", "market_cap", "fwd_ret_5d", "fwd_ret_20d", "is_tradable")


def ranged(df: DataFrame, date: str, start: str | None = None, end: str | None = None, symbol: str | None = None, symbols: list[str] | None = None) -> DataFrame:
    """Rows of the days from start to end (inclusive) and of the symbols; on a partition column this leaves out whole folders."""
    out = df if start is None else df.where(C(date) >= F.lit(start).cast("date"))
    out = out if end is None else out.where(C(date) <= F.lit(end).cast("date"))
    return out if symbols is None else out.where(C(symbol).isin(*symbols))


def read_daily_panel(spark: SparkSession, root: str, start: str | None = None, end: str | None = None, symbols: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """date, asset and the wanted panel columns of a store of bars with one folder for each trade_date.

    The last row of a key stays (the largest by all columns), rows without a key go, and a column that the store lacks is NULL.
    is_tradable is told by the close where the store does not have it. An unknown column raises."""
    if unknown := [c for c in columns or () if c not in PANEL_COLUMNS]:
        raise ValueError(f"unknown panel columns: {', '.join(unknown)}")
    rows = no_nan(ranged(spark.read.parquet(root), "trade_date", start, end, "ts_code", symbols))
    named = rows.withColumnsRenamed({"trade_date": "date", "ts_code": "asset", "vol": "volume"}).where(C("date").isNotNull() & C("asset").isNotNull())
    if "is_tradable" not in named.columns:
        named = named.withColumn("is_tradable", C("close").isNotNull() if "close" in named.columns else F.lit(False))
    want = [c for c in PANEL_COLUMNS if columns is None or c in columns]
    picked = named.select("date", "asset", *[C(c) if c in named.columns else F.lit(None).cast("double").alias(c) for c in want])
    return keep_last(picked, ["date", "asset"], *[C(c) for c in want]).select("date", "asset", *want)


def read_features(spark: SparkSession, root: str, start: str | None = None, end: str | None = None, symbols: list[str] | None = None) -> DataFrame:
    """date, asset and all features of a feature store with one folder for each trade_date."""
    rows = no_nan(ranged(spark.read.parquet(root), "trade_date", start, end, "ts_code", symbols))
    return rows.withColumnsRenamed({"trade_date": "date", "ts_code": "asset"}).where(C("date").isNotNull() & C("asset").isNotNull())


def read_margin(spark: SparkSession, root: str, start: str, end: str, columns: list[str] | None = None, exchanges: list[str] | None = None) -> DataFrame:
    """Margin rows of a range of days from a store with folders of years and months: months outside are not read."""
    first, last = (F.lit(d).cast("date") for d in (start, end))
    month = C("year") * 12 + C("month")
    rows = spark.read.parquet(root).where(month.between(F.year(first) * 12 + F.month(first), F.year(last) * 12 + F.month(last)))
    rows = no_nan(ranged(rows, "date", start, end, "exchange", exchanges)).drop("year", "month")
    return rows if columns is None else rows.select("date", "asset", *columns)


def feature_rows(raw: DataFrame, day: tuple[str, ...] = ("trade_date", "date", "日期"), code: tuple[str, ...] = ("ts_code", "code", "股票代码")) -> DataFrame:
    """Feature store rows from raw bars: days and numbers are read from text, and windows run over each symbol's rows. Rows without a
    day go; market_cap is close times outstanding shares; tradable rows have a close, an open, a volume and an amount."""
    bars = no_nan(raw.select(to_day(alias_pick(raw, *day)).alias("date"), alias_pick(raw, *code).alias("asset"), *[alias_pick(raw, c, kind="double").alias(c) for c in RAW_NUMBERS])).where("date is not null and asset is not null")
    bars = bars.withColumn("market_cap", C("close") * C("outstanding_share"))
    tradable = C("close").isNotNull() & C("open").isNotNull() & F.coalesce((C("volume") > 0) & (C("amount") > 0), F.lit(False))
    bars = bars.withColumn("is_tradable", tradable)
    rows = compute_features(bars, [n for n in FEATURES], keep=(*RAW_NUMBERS, "is_tradable"))
    return rows.withColumnsRenamed({"date": "trade_date", "asset": "ts_code"}).select(*FEATURE_ROW)


def write_feature_store(features: DataFrame, root: str, log: str | None = None, version: str = "v1", source: str = "daily_bars") -> None:
    """One folder for each date; only dates that are given are replaced. log: a table of the features that were written, with the time."""
    rows = features.withColumnsRenamed({"date": "trade_date", "asset": "ts_code"}) if "date" in features.columns else features
    sinks.write_by_date(rows, root)
    if log:
        names = [(c, version, source) for c in rows.columns if c not in ("trade_date", "ts_code")]
        sinks.append_log(features.sparkSession.createDataFrame(names, "feature_name string, version string, source_dataset string"), log)


def read_feature_log(spark: SparkSession, log: str) -> DataFrame:
    """(feature_name, version, source_dataset, written_at): the last entry of each feature and version."""
    return keep_last(spark.read.parquet(log), ["feature_name", "version"], C("written_at"))


def build_feature_store(raw: DataFrame, root: str, symbols: DataFrame | None = None, start: str | None = None, end: str | None = None, log: str | None = None) -> DataFrame:
    """Writes the feature rows of a range of days, whose windows see the days before too. Returns the symbols that were asked for and
    have no rows. No rows at all raise."""
    rows = feature_rows(raw)
    if symbols is not None:
        rows = rows.join(symbols.select(C("symbol").alias("ts_code")).distinct(), "ts_code", "left_semi").select(*FEATURE_ROW)
    rows = ranged(rows, "trade_date", start, end)
    if rows.isEmpty():
        raise ValueError("no rows for the symbols and days")
    write_feature_store(rows, root, log)
    there = ranged(raw.sparkSession.read.parquet(root), "trade_date", start, end).select(C("ts_code").alias("symbol")).distinct()
    wanted = symbols.select("symbol").distinct() if symbols is not None else there
    return wanted.join(there, "symbol", "left_anti")
