"""Queries of the normalisers, manifests and signal grids, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import diagnostics, normalise
from ..sources import panel as src
from ..sources import sinks
from .registry import _CAND, _LONG, _SC, _SUMM, FEAT, PANEL, _feat, corr, register, rnd, rnk, rounded

C = F.col


def symbols(spark: SparkSession, d: str) -> DataFrame:
    code = F.lpad((C("c_custkey") * 7919 % 1000000).cast("string"), 6, "0")
    raw = F.when(C("c_custkey") % 4 == 0, F.concat(F.lit("sh."), code)).when(C("c_custkey") % 4 == 1, F.concat(code, F.lit(".SZ"))).when(C("c_custkey") % 4 == 2, F.substring(code, 1, 5)).otherwise(code)
    return src.table(spark, d, "customer").select("c_custkey", raw.alias("raw")).select("c_custkey", *[normalise.symbol(C("raw"), k).alias(k) for k in ("dotted", "joined", "vendor", "upper", "plain")])


register("n9_symbols", symbols, """WITH c AS (SELECT c_custkey, lpad((c_custkey * 7919 % 1000000)::VARCHAR, 6, '0') AS code FROM customer),
  m AS (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 2 THEN code END AS code, CASE WHEN c_custkey % 4 = 0 THEN 'SH' WHEN c_custkey % 4 = 1 THEN 'SZ' WHEN code[1:2] IN ('60', '68') THEN 'SH' WHEN code[1:2] IN ('00', '30') THEN 'SZ' ELSE 'BJ' END AS place FROM c)
  SELECT c_custkey, code || '.' || place AS dotted, lower(place) || code AS joined, lower(place) || '.' || code AS vendor, place || code AS upper, code AS plain FROM m""")


def bars(spark: SparkSession, d: str) -> DataFrame:
    """One row for each customer and day: the last order's."""
    orders = src.table(spark, d, "orders").select(C("o_custkey").alias("code"), F.date_format("o_orderdate", "yyyyMMdd").alias("day"), C("o_totalprice").cast("string").alias("close"), "o_orderkey")
    out = normalise.daily_bars(orders, {"ts_code": ("ts_code", "code"), "trade_date": ("trade_date", "day"), "close": ("close",)}, "o_orderkey")
    return out.select("ts_code", "trade_date", F.round("close", 2).alias("close"))


register("n1_daily_bars", bars, "SELECT o_custkey::VARCHAR AS ts_code, o_orderdate::DATE AS trade_date, round(arg_max(o_totalprice, o_orderkey), 2) AS close FROM orders GROUP BY 1, 2")
register("n15_range_audit", lambda s, d: normalise.range_audit(src.table(s, d, "orders").select(F.to_date("o_orderdate").alias("day")), "day", "19960101", "19971231"),
         """SELECT count(*) AS rows_before, min(o_orderdate)::DATE AS min_before, max(o_orderdate)::DATE AS max_before, count(*) FILTER (WHERE k) AS rows_after, (min(o_orderdate) FILTER (WHERE k))::DATE AS min_after,
         (max(o_orderdate) FILTER (WHERE k))::DATE AS max_after FROM (SELECT o_orderdate, o_orderdate::DATE BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AS k FROM orders)""")


def trading_days(spark: SparkSession, d: str) -> DataFrame:
    days = src.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    bounds = days.agg(F.min("day").alias("start"), F.max("day").alias("end"))
    return normalise.calendar(bounds, days).withColumn("back_7", normalise.minus_weekdays(C("day"), 7))


register("n18_calendar", trading_days, """WITH o AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders), a AS (SELECT unnest(generate_series((SELECT min(day) FROM o), (SELECT max(day) FROM o), INTERVAL 1 DAY))::DATE AS day)
  SELECT a.day, o.day IS NOT NULL AS is_open, a.day = last_day(a.day) AND month(a.day) % 3 = 0 AS is_quarter_end,
  (SELECT max(x) FROM (SELECT a.day - (CASE isodow(a.day) WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END)::INTEGER - (CASE WHEN least(isodow(a.day), 5) - 1 >= 2 THEN 9 ELSE 11 END)::INTEGER AS x)) AS back_7 FROM a LEFT JOIN o ON a.day = o.day""")
register("n20_task_keys", lambda s, d: src.table(s, d, "orders").select("o_orderkey", normalise.task_key("o_custkey", "o_orderpriority").alias("task_key")),
         """SELECT o_orderkey, '{"o_custkey":' || o_custkey || ',"o_orderpriority":"' || o_orderpriority || '"}' AS task_key FROM orders""")

_MSG = {"1-URGENT": "Read timed out", "2-HIGH": "KeyError: x", "3-MEDIUM": "Invalid value", "5-LOW": "missing adapter"}


def health_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Orders as ingest results: classes, actions and waves with their counts."""
    status = F.when(C("o_orderstatus") == "F", "success").when(C("o_orderstatus") == "P", "empty").otherwise("failed")
    runs = src.table(spark, d, "orders").select(status.alias("status"), (C("o_orderkey") % 3).alias("rows"), F.try_element_at(F.create_map(*[F.lit(x) for kv in _MSG.items() for x in kv]), C("o_orderpriority")).alias("error_message"))
    out = runs.groupBy(normalise.health().alias("health")).agg(F.count("*").alias("n"))
    return out.select("health", normalise.health_wave(C("health"), 0).alias("action"), normalise.health_wave(C("health"), 1).alias("wave"), "n")


_CLS = " ".join(f"WHEN '{k}' THEN" + " '{}'" for k in normalise.HEALTH)
register("n21_health", health_matrix, f"""WITH h AS (SELECT CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 > 0 THEN 'ready' WHEN o_orderstatus = 'P' OR o_orderstatus = 'F' THEN 'empty_check_later' WHEN o_orderpriority = '5-LOW' THEN 'pending_adapter'
  WHEN o_orderpriority = '1-URGENT' THEN 'unstable_retry_needed' WHEN o_orderpriority = '2-HIGH' THEN 'adapter_defensive_fix_needed' WHEN o_orderpriority = '3-MEDIUM' THEN 'parameter_value_review' ELSE 'manual_review_needed' END AS health FROM orders)
  SELECT health, CASE health {_CLS.format(*[v[0] for v in normalise.HEALTH.values()])} END AS action, CASE health {_CLS.format(*[v[1] for v in normalise.HEALTH.values()])} END AS wave, count(*) AS n FROM h GROUP BY 1""")
register("k3_month_manifest", lambda s, d: sinks.month_manifest(src.daily_panel(s, d)),
         f"WITH {PANEL} SELECT year(date)::INTEGER AS year, month(date)::INTEGER AS month, count(*) AS rows, count(DISTINCT date) AS n_dates, count(DISTINCT asset) AS n_assets FROM panel GROUP BY 1, 2")


def signal_grid(spark: SparkSession, d: str) -> DataFrame:
    """Rank IC of every candidate signal against every horizon, summarised: one shuffle of the long form."""
    wide = _feat(spark, d).select("date", "asset", "fwd_ret_5d", "fwd_ret_20d", *[(C(c) * sign).cast("double").alias(n) for n, (c, sign) in _CAND.items()])
    long = wide.unpivot(["date", "asset", "fwd_ret_5d", "fwd_ret_20d"], list(_CAND), "signal_name", "value")
    long = long.unpivot(["date", "asset", "signal_name", "value"], ["fwd_ret_5d", "fwd_ret_20d"], "horizon", "label")
    return diagnostics.summarize_ic(diagnostics.daily_ic(long, "value", "label", "spearman", ("signal_name", "horizon", "date")), "signal_name", "horizon")


register("d29_signal_grid", lambda s, d: rnd(signal_grid(s, d), ["signal_name", "horizon", "n_dates"], _SC),
         f"""WITH {FEAT}, l AS ({_LONG}), h AS (SELECT signal_name, 'fwd_ret_5d' AS horizon, date, raw, fwd_ret_5d AS y FROM l UNION ALL SELECT signal_name, 'fwd_ret_20d', date, raw, fwd_ret_20d FROM l),
         p AS (SELECT signal_name, horizon, date, CASE WHEN y IS NOT NULL THEN raw END AS x, CASE WHEN raw IS NOT NULL THEN y END AS y FROM h), r AS (SELECT signal_name, horizon, date, {rnk('x', 'signal_name, horizon, date', False)} AS x, {rnk('y', 'signal_name, horizon, date', False)} AS y FROM p),
         i AS (SELECT signal_name, horizon, date, {corr('x', 'y')} AS ic FROM r GROUP BY 1, 2, 3), q AS (SELECT signal_name, horizon, {_SUMM} FROM i GROUP BY 1, 2) SELECT {rounded(_SC, 'signal_name, horizon, n_dates')} FROM q""")
