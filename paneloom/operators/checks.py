"""Data quality: validation counts, profiles and rule checks that work on any table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

C = F.col


def validate_bars(bars: DataFrame) -> DataFrame:
    """(check_name, failed_rows): one pass for row checks, one grouping for duplicate keys."""
    checks = {
        "null_key": C("date").isNull() | C("asset").isNull(),
        "null_price": C("open").isNull() | C("high").isNull() | C("low").isNull() | C("close").isNull(),
        "ohlc_bounds": (C("high") < F.greatest("open", "low", "close")) | (C("low") > F.least("open", "high", "close")),
        "negative": (C("close") < 0) | (C("volume") < 0) | (C("amount") < 0),
    }
    one = bars.agg(*[F.count_if(v).alias(k) for k, v in checks.items()]).unpivot([], list(checks), "check_name", "failed_rows")
    again = bars.groupBy("date", "asset").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(C("n") - 1), F.lit(0)).alias("failed_rows"))
    return one.unionByName(again.select(F.lit("duplicate_key").alias("check_name"), "failed_rows"))


FORBIDDEN = ("fwd_ret", "label", "future")


def check_factor_columns(factors: DataFrame) -> None:
    """Outcomes must not stand among factors."""
    if bad := [c for c in factors.columns if c.startswith(FORBIDDEN)]:
        raise ValueError(f"forbidden columns: {', '.join(bad)}")


def validate_factors(factors: DataFrame, columns: list[str]) -> DataFrame:
    """(factor, n_rows, n_null, n_inf, all_null)."""
    check_factor_columns(factors)
    long = factors.select(*[C(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "factor", "v")
    return long.groupBy("factor").agg(F.count("*").alias("n_rows"), F.count_if(C("v").isNull()).alias("n_null"), F.count_if(F.abs("v") == float("inf")).alias("n_inf"), (F.count("v") == 0).alias("all_null"))


def summarize_factors(factors: DataFrame, columns: list[str]) -> DataFrame:
    long = factors.select(*[C(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "factor", "v")
    v = F.when(F.abs("v") < float("inf"), C("v"))
    return long.groupBy("factor").agg((F.count("v") / F.count("*")).alias("coverage"), F.count_if(F.abs("v") == float("inf")).alias("n_inf"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))


def profile(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    """One row: rows, distinct keys, duplicate keys, date range and nulls of each column."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(date).alias("_lo"), F.max(date).alias("_hi"), *[F.count_if(C(c).isNull()).alias(f"n_null_{c}") for c in df.columns if c not in keys])
    nulls = [c for c in per_key.columns if c.startswith("n_null_")]
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys"), F.count_if(C("_n") > 1).alias("n_duplicate_keys"), F.min("_lo").alias("min_date"), F.max("_hi").alias("max_date"), *[F.sum(c).alias(c) for c in nulls])


def _row_rule(rule: dict) -> Column:
    """A row breaks the rule. Kinds: required, enum, bool_like (true, false), implies (SQL predicates)."""
    kind = rule["kind"]
    if kind == "implies":
        return F.coalesce(F.expr(rule["if"]), F.lit(False)) & ~F.coalesce(F.expr(rule["then"]), F.lit(False))
    text = F.trim(C(rule["column"]).cast("string"))
    if kind == "required":
        return F.coalesce(text == "", F.lit(True))
    if kind == "enum":
        return ~F.coalesce(text.isin(*rule["values"]), F.lit(False))
    if kind == "bool_like":
        return ~F.coalesce(F.lower(text).isin("true", "false"), F.lit(False))
    raise ValueError(f"unknown kind of rule: {kind}")


def check_rules(df: DataFrame, rules: list[dict], key: str) -> DataFrame:
    """(rule, key, message) of every violation. Rules on rows (see above) are told in one pass; unique groups by its column, and
    must_exist looks for its values. A rule on columns that df lacks is broken once, with the column as its key."""
    known, out = set(df.columns), []
    lost = [(r["name"], r["column"]) for r in rules if "column" in r and r["column"] not in known]
    rules = [r for r in rules if (r["name"], r.get("column")) not in lost]
    if lost:
        out.append(df.sparkSession.createDataFrame(lost, "rule string, key string").withColumn("message", F.lit("missing column")))
    if plain := [r for r in rules if r["kind"] not in ("unique", "must_exist")]:
        told = F.array_compact(F.array(*[F.when(_row_rule(r), F.struct(F.lit(r["name"]).alias("rule"), C(key).cast("string").alias("key"), F.lit(r["kind"]).alias("message"))) for r in plain]))
        out.append(df.select(F.explode(told).alias("x")).select("x.*"))
    for r in (r for r in rules if r["kind"] == "unique"):
        out.append(df.groupBy(C(r["column"]).cast("string").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(r["name"]).alias("rule"), "key", F.lit("not unique").alias("message")))
    for r in (r for r in rules if r["kind"] == "must_exist"):
        want = df.sparkSession.createDataFrame([(v,) for v in r["values"]], "key string")
        there = df.where(C(r["column"]).cast("string").isin(*r["values"])).select(C(r["column"]).cast("string").alias("key")).distinct()
        out.append(want.join(there, "key", "left_anti").select(F.lit(r["name"]).alias("rule"), "key", F.lit("missing").alias("message")))
    return reduce(DataFrame.unionByName, out)


def status_rollup(catalog: DataFrame) -> DataFrame:
    """Counts by api and overall (api NULL) with PASS or FAIL."""
    out = catalog.rollup("api").agg(F.count("*").alias("n"), F.count_if(C("status") == "failed").alias("n_failed"))
    return out.withColumn("verdict", F.when(C("n_failed") == 0, "PASS").otherwise("FAIL"))
