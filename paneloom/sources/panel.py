"""Panels over the given tables: one row for each (date, asset), weekly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.expr import no_nan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; NaN is missing."""
    return no_nan(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _bars(lines: DataFrame, *keys: str) -> DataFrame:
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return lines.groupBy(*keys, F.to_date(F.date_trunc("week", "l_shipdate")).alias("date")).agg(
        F.min_by(price, F.struct(F.col("l_orderkey"), F.col("l_linenumber"), price)).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
        (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("close"), F.sum("l_quantity").alias("volume"), F.sum("l_extendedprice").alias("amount"),
    )


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, asset, open, high, low, close, volume, amount, turnover, market_cap, grp, is_tradable."""
    bars = _bars(table(spark, sf_dir, "lineitem"), "l_suppkey")
    firms = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), (F.col("s_acctbal") + 20000).alias("market_cap"), F.col("s_nationkey").alias("grp"))
    return bars.join(firms, "l_suppkey").select(
        "date", F.col("l_suppkey").cast("string").alias("asset"), "open", "high", "low", "close", "volume", "amount",
        (F.col("volume") / 10000).alias("turnover"), "market_cap", "grp", (F.col("volume") > 0).alias("is_tradable"),
    )


def index_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, index_id (region), close, high, amount, valuation_pe_ttm."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    lines = lines.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return lines.groupBy(F.col("n_regionkey").alias("index_id"), F.to_date(F.date_trunc("week", "l_shipdate")).alias("date")).agg(
        (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("close"), F.max(price).alias("high"), F.sum("l_extendedprice").alias("amount"),
        F.avg(1 + F.col("l_discount") * 100).alias("valuation_pe_ttm"),
    )


def margin_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, d, t = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("asset"), F.to_date(F.date_trunc("week", "l_shipdate")).alias("date")).agg(
        F.sum(p).alias("financing_balance"), F.sum(p * d).alias("financing_buy_amount"), F.sum(p * t).alias("financing_repay_amount"),
        F.sum(p * (1 + t)).alias("margin_total_balance"), F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)).alias("short_sell_volume"),
    )


def member_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """snapshot_date (month end), asset: an asset is a member when it shipped in that month."""
    return table(spark, sf_dir, "lineitem").select(F.last_day("l_shipdate").alias("snapshot_date"), F.col("l_suppkey").cast("string").alias("asset")).distinct()
