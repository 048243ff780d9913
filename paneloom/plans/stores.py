"""Queries of readers, sinks and normalisers over stores that are written from the given tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.scratch import scratch
from ..operators import checks, increments, lake, normalise
from ..sources import files, reports, sinks
from ..sources import panel as src
from .lakehouse import _apis, _end, _landed, _orders, _plan_sql, _WEEKDAYS_BACK
from .registry import register

C = F.col
_DAY = "yyyyMMdd"

# --- membership snapshots, repeated in what is written


def _snapshots(s: SparkSession, d: str) -> str:
    path = scratch(s, "snapshots")
    lines = src.table(s, d, "lineitem").select(
        F.concat(F.lit("index_"), C("l_returnflag")).alias("index_name"), F.last_day("l_shipdate").alias("snapshot_date"),
        C("l_suppkey").cast("string").alias("asset"),
    )
    sinks.write_snapshots(lines, path)
    return path


def _written_snapshots(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(_snapshots(s, d)).groupBy("index_name", "year").agg(F.count("*").alias("n_rows"), F.count_distinct("snapshot_date").alias("n_dates"))


_MEMBERS = "m AS (SELECT DISTINCT 'index_' || l_returnflag AS index_name, last_day(l_shipdate)::DATE AS snapshot_date, l_suppkey::VARCHAR AS asset FROM lineitem)"
register(
    "k8_snapshot_sink",
    _written_snapshots,
    f"""WITH {_MEMBERS} SELECT index_name, year(snapshot_date)::INTEGER AS year, count(*) AS n_rows, count(DISTINCT snapshot_date) AS n_dates
        FROM m GROUP BY index_name, year(snapshot_date)""",
)
register(
    "s5_index_snapshots",
    lambda s, d: files.read_snapshots(s, _snapshots(s, d), "index_R", "1995-03-01", "1996-10-31"),
    f"""WITH {_MEMBERS} SELECT index_name, NULL::VARCHAR AS index_code, snapshot_date, asset, NULL::VARCHAR AS asset_name, NULL::VARCHAR AS is_member,
          NULL::VARCHAR AS source, NULL::VARCHAR AS ingested_at
        FROM m WHERE index_name = 'index_R' AND snapshot_date BETWEEN DATE '1995-03-01' AND DATE '1996-10-31'""",
)

# --- partitions: which are selected, one of them read with its sidecar, and a rebuild in order


def _quarters(s: SparkSession, d: str) -> DataFrame:
    """Files of orders by exchange and quarter, with what is selected of them."""
    root = scratch(s, "margin")
    day = F.to_date(F.date_trunc("quarter", "day")).cast("string")
    rows = _orders(s, d).select(C("o_orderkey"), C("o_totalprice"), C("o_orderstatus").alias("exchange"), day.alias("trade_date"))
    rows.hint("rebalance", "exchange", "trade_date").write.partitionBy("exchange", "trade_date").parquet(f"{root}/margin/detail")
    inv = files.selected_partitions(files.inventory(s, root), "exchange", ["f", "O"], "trade_date", "1995-04-01", "1997-06-30")
    part = C("partition")
    return inv.select("family", "api", part["exchange"].alias("exchange"), part["trade_date"].alias("trade_date"), "selected", "reason").distinct()


register(
    "s9_selected_partitions",
    _quarters,
    """WITH q AS (SELECT DISTINCT o_orderstatus AS exchange, date_trunc('quarter', o_orderdate)::DATE AS day FROM orders),
         x AS (SELECT *, exchange IN ('F', 'O') AND day BETWEEN DATE '1995-04-01' AND DATE '1997-06-30' AS selected FROM q)
       SELECT 'margin' AS family, 'detail' AS api, exchange, day::VARCHAR AS trade_date, selected, CASE WHEN selected THEN '' ELSE 'filtered out' END AS reason FROM x""",
)


def _one_partition(s: SparkSession, d: str) -> DataFrame:
    """The rows of one partition, with the row count that its sidecar tells."""
    root = scratch(s, "raw")
    o = _orders(s, d).select("o_orderkey", "o_totalprice", C("o_orderstatus").alias("status"), F.year("day").alias("year"))
    o.hint("rebalance", "status", "year").write.partitionBy("status", "year").parquet(f"{root}/data")
    sidecar = o.where("status = 'F' and year = 1997").agg(F.count("*").alias("sidecar_rows"))
    sidecar.coalesce(1).write.option("multiLine", True).json(f"{root}/metadata/status=F/year=1997/metadata.json")
    told = files.read_partition_metadata(s, f"{root}/metadata", status="F", year="1997").select("sidecar_rows")
    rows = files.read_partition(s, f"{root}/data", status="F", year="1997")
    return rows.withColumn("year", C("year").cast("int")).join(F.broadcast(told))  # one row of metadata


register(
    "s10_partition_point_read",
    _one_partition,
    """SELECT o_orderkey, o_totalprice, o_orderstatus AS status, year(o_orderdate)::INTEGER AS year, count(*) OVER () AS sidecar_rows
       FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1997""",
)


def _rebuilt(s: SparkSession, d: str) -> DataFrame:
    """A store that is written twice, the second time with later prices, and whether each of its files is in the order of keys."""
    path = scratch(s, "bars")
    month = F.to_date(F.date_trunc("month", "day"))
    o = _orders(s, d).select(month.alias("trade_date"), "o_orderkey", C("o_totalprice").alias("price"))
    sinks.write_by_date(o.withColumn("price", F.lit(0.0)), path, order="o_orderkey")
    sinks.write_by_date(o, path, order="o_orderkey")
    rows = s.read.parquet(path).select("trade_date", "o_orderkey", "price", C("_metadata.file_path").alias("file"), C("_metadata.row_index").alias("place"))
    # in order: the keys of a file, taken by their places, are the keys sorted
    pairs = F.array_sort(F.collect_list(F.struct("place", "o_orderkey")))
    keys = F.transform(pairs, lambda p: p["o_orderkey"])
    per_file = rows.groupBy("trade_date", "file", F.floor(C("place") / 4096)).agg((keys == F.array_sort(keys)).alias("ok"), F.count("*").alias("n"), F.sum("price").alias("p"))
    return per_file.groupBy("trade_date").agg(F.sum("n").alias("n_rows"), F.every("ok").alias("in_order"), F.round(F.sum("p"), 2).alias("price"))


register(
    "k2_rebuilt_store",
    _rebuilt,
    """SELECT date_trunc('month', o_orderdate)::DATE AS trade_date, count(*) AS n_rows, true AS in_order, round(sum(o_totalprice), 2) AS price
       FROM orders GROUP BY 1""",
)

# --- texts, registries, lists


def _texts(s: SparkSession, d: str) -> DataFrame:
    """Codes keep their zeros, and empty texts are no nulls."""
    path = scratch(s, "contract")
    rows = src.table(s, d, "customer").select(
        F.lpad(C("c_custkey").cast("string"), 8, "0").alias("code"), F.when(C("c_acctbal") < 0, "").otherwise(C("c_mktsegment")).alias("segment"),
        C("c_nationkey").cast("string").alias("family"),
    )
    sinks.write_csv(rows, path)
    return files.read_texts(s, path, ("code", "segment"))


register(
    "s11_contract_texts",
    _texts,
    """SELECT lpad(c_custkey::VARCHAR, 8, '0') AS code, CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS segment, c_nationkey::VARCHAR AS family
       FROM customer""",
)


def _registry(s: SparkSession, d: str) -> DataFrame:
    """A JSON registry of the pairs of segment and nation, some dozens whatever the number of customers."""
    path = scratch(s, "registry")
    name = F.concat_ws("_", F.lower("c_mktsegment"), C("c_nationkey").cast("string"))
    apis = src.table(s, d, "customer").groupBy(name.alias("api_name")).agg(F.count("*").alias("customers"), F.min("c_custkey").alias("first_key"))
    apis.agg(F.to_json(F.struct(F.collect_list(F.struct("*")).alias("sources")))).write.text(path)
    return files.read_registry(s, path).select("api_name", "customers", "first_key")


register(
    "s11_json_registry",
    _registry,
    "SELECT lower(c_mktsegment) || '_' || c_nationkey::VARCHAR AS api_name, count(*) AS customers, min(c_custkey) AS first_key FROM customer GROUP BY 1",
)


def _trading_days(s: SparkSession, d: str) -> DataFrame:
    """Days of a calendar file in its order, within a range; there are some thousands of days at any scale."""
    path = scratch(s, "calendar")
    days = _orders(s, d).select(F.date_format("day", _DAY).alias("trade_date")).distinct()
    days.coalesce(1).sortWithinPartitions("trade_date").write.option("header", True).csv(path)
    return files.read_days(s, path, "19950101", "19960930")


register(
    "s14_trading_days",
    _trading_days,
    """SELECT place, value FROM (SELECT value, row_number() OVER (ORDER BY value) - 1 AS place FROM (SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS value FROM orders))
       WHERE value BETWEEN '19950101' AND '19960930'""",
)


def _symbols(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s, "symbols")
    code = C("l_suppkey").cast("string")
    line = F.when(C("l_returnflag") == "R", F.concat(code, F.lit(".SH"))).when(C("l_returnflag") == "A", F.concat(F.lit("sz"), code)).otherwise("")
    src.table(s, d, "lineitem").select(line).write.text(path)
    return files.read_symbols(s, path)


register("s15_symbol_set", _symbols, "SELECT DISTINCT lpad(l_suppkey::VARCHAR, 6, '0') AS symbol FROM lineitem WHERE l_returnflag IN ('R', 'A')")


def _ordered_symbols(s: SparkSession, d: str) -> DataFrame:
    """Nations in the order of their first suppliers, each listed twice and kept at its first place."""
    path = scratch(s, "ordered")
    per = src.table(s, d, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("n"), F.min("s_suppkey").alias("first_key"))
    lines = per.select("first_key", F.explode(F.array(F.lit(0), F.lit(1))).alias("turn"), C("s_nationkey").cast("string").alias("value"))
    lines.coalesce(1).sortWithinPartitions("turn", "first_key").select("value").write.text(path)
    return files.read_ordered_symbols(s, path)


register(
    "s15_ordered_symbols",
    _ordered_symbols,
    """SELECT row_number() OVER (ORDER BY min(s_suppkey)) - 1 AS place, lpad(s_nationkey::VARCHAR, 6, '0') AS symbol FROM supplier GROUP BY s_nationkey""",
)

# --- results of runs


def _frames(s: SparkSession, d: str) -> dict[str, DataFrame]:
    o = _orders(s, d)
    by = {"status": C("o_orderstatus"), "priority": C("o_orderpriority"), "year": F.year("day").cast("string"), "month": F.month("day").cast("string")}
    return {name: o.groupBy(key.alias("key")).agg(F.count("*").alias("n_rows"), F.max("o_totalprice").alias("highest")) for name, key in by.items()}


def _outputs(s: SparkSession, d: str) -> DataFrame:
    """Three required tables and two optional ones of a run, of which one was never written."""
    path = scratch(s, "run")
    sinks.write_outputs(_frames(s, d), path)
    got = files.read_outputs(s, path, ("status", "priority", "year"), ("month", "absent"))
    out = None
    for name, df in sorted(got.items()):
        part = df.select(F.lit(name).alias("name"), C("key").cast("string").alias("key"), C("n_rows").cast("long").alias("n_rows"), "highest")
        out = part if out is None else out.unionByName(part)
    return out


register(
    "s12_run_outputs",
    _outputs,
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, {key} AS key, count(*) AS n_rows, max(o_totalprice) AS highest FROM orders GROUP BY 2"
        for name, key in (("status", "o_orderstatus"), ("priority", "o_orderpriority"), ("year", "year(o_orderdate)::VARCHAR"), ("month", "month(o_orderdate)::VARCHAR"))
    ),
)


def _refused(s: SparkSession, d: str) -> DataFrame:
    """A first write of two statuses, then one of all; what both told stands in the table of metadata."""
    path, log = scratch(s, "raw"), scratch(s, "log")
    o = _orders(s, d).select("o_orderkey", "o_totalprice", C("o_orderstatus").alias("status_key"))
    sinks.write_raw_partition(o.where("status_key <> 'P'"), path, ["status_key"], log, run="first")
    sinks.write_raw_partition(o, path, ["status_key"], log, run="second")
    landed = s.read.parquet(path).groupBy(C("status_key").cast("string").alias("status_key")).agg(F.count("*").alias("landed"))
    return s.read.parquet(log).drop("written_at").join(landed, "status_key")


register(
    "k4_refused_partitions",
    _refused,
    """WITH g AS (SELECT o_orderstatus AS status_key, count(*) AS rows FROM orders GROUP BY 1)
       SELECT status_key, rows, 'success' AS status, 'first' AS run, rows AS landed FROM g WHERE status_key <> 'P' UNION ALL
       SELECT status_key, rows, CASE WHEN status_key = 'P' THEN 'success' ELSE 'already_exists' END, 'second', rows FROM g""",
)


def _factor_output(s: SparkSession, d: str) -> DataFrame:
    """A family's factors by month, read back with its summary and what its metadata tells."""
    path = scratch(s, "factors")
    month = F.to_date(F.date_trunc("month", "day"))
    rows = _orders(s, d).groupBy(month.alias("date"), C("o_orderpriority").alias("asset")).agg(F.max("o_totalprice").alias("high_price"), F.when(F.count("*") % 3 > 0, F.count("*").cast("double")).alias("n_orders"))
    factors = ["high_price", "n_orders"]
    sinks.write_factors(rows, checks.summarize_factors(rows, factors), path, "trade", family="trade")
    stored = checks.validate_factors(s.read.parquet(f"{path}/trade/factors"), factors)
    told = s.read.csv(f"{path}/trade/summary", header=True, inferSchema=True).select("factor", F.round("coverage", 6).alias("coverage"), F.round("max", 2).alias("highest"))
    meta = s.read.json(f"{path}/trade/metadata").select("name", "columns")
    return stored.join(told, "factor").join(F.broadcast(meta)).select("factor", "n_rows", "n_null", "coverage", "highest", "name", "columns")


register(
    "k6_factor_output",
    _factor_output,
    """WITH f AS (SELECT date_trunc('month', o_orderdate) AS date, o_orderpriority AS asset, max(o_totalprice) AS high_price, CASE WHEN count(*) % 3 > 0 THEN count(*)::DOUBLE END AS n_orders FROM orders GROUP BY 1, 2),
         l AS (SELECT 'high_price' AS factor, high_price AS v FROM f UNION ALL SELECT 'n_orders', n_orders FROM f)
       SELECT factor, count(*) AS n_rows, count(*) - count(v) AS n_null, round(count(v) / count(*), 6) AS coverage, round(max(v), 2) AS highest, 'trade' AS name,
         'date,asset,high_price,n_orders' AS columns FROM l GROUP BY factor""",
)


def _fetched(s: SparkSession, d: str) -> DataFrame:
    """CSV of a fetch under its sorted keys, each folder held against its metadata."""
    path = scratch(s, "fetch")
    o = _orders(s, d).select("o_orderkey", "o_totalprice", F.year("day").cast("string").alias("year"), C("o_orderstatus").alias("exchange"))
    reports.write_fetch_result(o, path, "orders", ("year", "exchange"), source_name="orders", source_inventory_version="v1")
    rows, told = reports.read_fetch_result(s, path, "orders")
    key = [C("exchange"), C("year").cast("string").alias("year")]
    found = rows.groupBy(*key).agg(F.count("*").alias("n_rows"), F.max(C("o_orderkey").cast("long")).alias("last_key"))
    known = told.select(*key, "row_count", "source_name", F.array_join("raw_columns", ",").alias("raw_columns"))
    return found.join(known, ["exchange", "year"])


register(
    "k7_fetch_result",
    _fetched,
    """SELECT o_orderstatus AS exchange, year(o_orderdate)::VARCHAR AS year, count(*) AS n_rows, max(o_orderkey) AS last_key, count(*) AS row_count,
         'orders' AS source_name, 'o_orderkey,o_totalprice,year,exchange' AS raw_columns FROM orders GROUP BY 1, 2""",
)


def _logs(s: SparkSession, d: str) -> DataFrame:
    """Quality rows of two runs in one log."""
    path = scratch(s, "quality")
    o = _orders(s, d)
    for run, rows in (("all", o), ("late", o.where("day >= '1997-01-01'"))):
        per = rows.groupBy(C("o_orderpriority").alias("dataset")).agg(F.count("*").alias("n_rows"), F.count_if(C("o_totalprice") > 200000).alias("n_high"))
        sinks.append_log(per.withColumn("run", F.lit(run)), path)
    return s.read.parquet(path).where("written_at is not null").drop("written_at")


register(
    "k10_quality_log",
    _logs,
    " UNION ALL ".join(
        f"SELECT o_orderpriority AS dataset, count(*) AS n_rows, count(*) FILTER (WHERE o_totalprice > 200000) AS n_high, '{run}' AS run FROM orders WHERE {cond} GROUP BY 1"
        for run, cond in (("all", "true"), ("late", "o_orderdate >= DATE '1997-01-01'"))
    ),
)


def _run_manifest(s: SparkSession, d: str) -> DataFrame:
    """The manifest of a run over all orders, a row for each of its fields, and its warnings by line."""
    path = scratch(s, "manifest")
    low, high, n = _orders(s, d).agg(F.min("day"), F.max("day"), F.count_distinct("o_custkey")).first()
    sinks.write_run_manifest(s, f"{path}/run", run_id="r1", data_range=f"{low}..{high}", universe=n)
    sinks.write_warnings(s, f"{path}/warnings", [f"{n} customers"])
    manifest = s.read.schema(", ".join(f"{f} string" for f in sinks.MANIFEST_FIELDS)).json(f"{path}/run")
    lines = s.read.text(f"{path}/warnings").where("value like '- %'").select(F.lit("warning").alias("field"), "value")
    return manifest.unpivot([], list(sinks.MANIFEST_FIELDS), "field", "value").unionByName(lines)


register(
    "k11_run_manifest",
    _run_manifest,
    f"""WITH f AS (SELECT unnest({list(sinks.MANIFEST_FIELDS)}) AS field), n AS (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b, count(DISTINCT o_custkey) AS n FROM orders)
        SELECT field, CASE field WHEN 'run_id' THEN 'r1' WHEN 'data_range' THEN a::VARCHAR || '..' || b::VARCHAR WHEN 'universe' THEN n::VARCHAR END AS value FROM f, n
        UNION ALL SELECT 'warning', '- ' || n::VARCHAR || ' customers' FROM n""",
)


def _plan_report(s: SparkSession, d: str) -> DataFrame:
    """The incremental plan as a report of fixed columns, read back as texts."""
    path = scratch(s, "report")
    plan = increments.incremental_plan(_apis(s, d), _landed(s, d), _end(s, d))
    reports.write_report(plan, path, "incremental_plan", ("planned_action",))
    counts = s.read.json(f"{path}/incremental_plan_summary")
    return reports.read_report(s, path, "incremental_plan").join(counts.withColumnRenamed("n_rows", "of_action"), "planned_action")


register(
    "k14_plan_report",
    _plan_report,
    f"""WITH p AS ({_plan_sql(_WEEKDAYS_BACK)})
        SELECT {', '.join(f"coalesce({c}::VARCHAR, '') AS {c}" for c in reports.LAYOUTS['incremental_plan'])}, count(*) OVER (PARTITION BY planned_action) AS of_action FROM p""",
)

# --- normalisers, guards and plans of copies


def _industries(s: SparkSession, d: str) -> DataFrame:
    o = _orders(s, d)
    raw = o.select(
        F.concat(F.lit("sz"), C("o_custkey").cast("string")).alias("股票代码"), C("day").cast("string").alias("计入日期"),
        (C("o_orderkey") % 1000000).cast("string").alias("行业代码"), F.when(C("o_orderkey") % 5 > 0, F.date_format("day", _DAY)).otherwise("none").alias("更新日期"),
    )
    return normalise.industry_history(raw, {"stock_code": "股票代码", "effective_date": "计入日期", "industry_code": "行业代码", "source_update_time": "更新日期"})


register(
    "n6_industry_history",
    _industries,
    """SELECT lpad(o_custkey::VARCHAR, 6, '0') AS stock_code, o_orderdate::DATE AS effective_date, i AS industry_code, i[1:2] AS industry_l1_code, i[1:4] AS industry_l2_code, i[1:6] AS industry_l3_code,
         CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate::DATE END AS source_update_time FROM (SELECT *, lpad((o_orderkey % 1000000)::VARCHAR, 6, '0') AS i FROM orders)""",
)


def _products(s: SparkSession, d: str) -> DataFrame:
    o = _orders(s, d)
    kept = {"F": ["o_orderkey", "o_totalprice"], "O": ["o_orderkey", "o_orderpriority"], "P": ["o_orderkey"]}
    frames = {k: o.where(C("o_orderstatus") == k).select(*columns) for k, columns in kept.items()}
    return normalise.flatten_products(frames, source_api="receipts", exchange="X")


register(
    "n13_flat_products",
    _products,
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority,
         o_orderstatus AS product_key, 'receipts' AS source_api, 'X' AS exchange FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""",
)
register(
    "n22_risk_levels",
    lambda s, d: src.table(s, d, "documents").select("doc_id", normalise.risk_level(C("text")).alias("risk")),
    """SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 'low' WHEN contains(text, '后') OR contains(lower(text), 'post') THEN 'high' ELSE 'medium' END AS risk FROM documents""",
)


def _guarded(s: SparkSession, d: str) -> DataFrame:
    """Which columns of a labelled table may stand among factors, with their values; those that may pass the guard together."""
    o = _orders(s, d).select(
        C("o_totalprice").alias("price"), C("o_custkey").cast("double").alias("labelled"), C("o_totalprice").alias("fwd_ret_5d"),
        F.when(C("o_orderkey") % 3 > 0, C("o_totalprice")).alias("future_price"), C("o_custkey").cast("double").alias("size"),
    )

    def passes(name: str) -> bool:
        try:
            checks.check_factor_columns(o.select(name))
        except ValueError:
            return False
        return True

    allowed = {c: passes(c) for c in o.columns}
    checks.check_factor_columns(o.select(*[c for c, ok in allowed.items() if ok]))
    told = F.element_at(F.create_map(*[F.lit(x) for pair in allowed.items() for x in pair]), C("column"))
    counts = o.agg(*[F.count(c).alias(c) for c in o.columns]).unpivot([], o.columns, "column", "n_values")
    return counts.withColumn("allowed", told)


register(
    "p7_factor_guard",
    _guarded,
    """SELECT c AS "column", CASE c WHEN 'future_price' THEN (SELECT count(*) FROM orders WHERE o_orderkey % 3 > 0) ELSE (SELECT count(*) FROM orders) END AS n_values, c IN ('price', 'size') AS allowed
       FROM (SELECT unnest(['price', 'labelled', 'fwd_ret_5d', 'future_price', 'size']) AS c)""",
)


def _collisions(s: SparkSession, d: str) -> DataFrame:
    """Customers' orders as files of two lakes, with a digest of their keys; the second lacks some and has others of one order less."""
    def lake_of(rows):
        path = F.concat(F.lit("orders/"), C("o_custkey").cast("string"), F.lit(".parquet"))
        return rows.groupBy(path.alias("path")).agg(F.sha2(F.sum("o_orderkey").cast("string"), 256).alias("digest"))

    o = _orders(s, d)
    return lake.collision_plan(lake_of(o), lake_of(o.where("o_custkey % 4 > 0 and o_orderkey % 9 > 0")))


register(
    "l9_collision_plan",
    _collisions,
    """WITH a AS (SELECT o_custkey AS k, sum(o_orderkey) AS n FROM orders GROUP BY 1), b AS (SELECT o_custkey AS k, sum(o_orderkey) AS m FROM orders WHERE o_custkey % 4 > 0 AND o_orderkey % 9 > 0 GROUP BY 1)
       SELECT 'orders/' || k::VARCHAR || '.parquet' AS path, CASE WHEN m IS NULL THEN 'copy_new' WHEN m = n THEN 'skip_identical' ELSE 'block_non_identical' END AS action FROM a LEFT JOIN b USING (k)""",
)
