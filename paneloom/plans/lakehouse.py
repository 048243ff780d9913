"""Queries of the lake's jobs, over stores that are written from the given tables, and the SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.scratch import scratch
from ..operators import features, grids, increments, lake, merge
from ..sources import compaction, footers, sinks
from ..sources import panel as src
from .registry import FEAT, even, even_sql, register

C = F.col
_STATUS = ("F", "O", "P")


def _orders(s: SparkSession, d: str) -> DataFrame:
    return src.table(s, d, "orders").withColumn("day", F.to_date("o_orderdate"))


# --- inventory: a store whose sources have a date column, a text of days, and neither


def _mixed_store(s: SparkSession, d: str) -> str:
    root = scratch(s, "mixed")
    o = _orders(s, d).withColumn("year", F.year("day"))
    kept = {
        "F": [C("o_orderkey"), C("o_totalprice"), C("day").alias("trade_date")],
        "O": [C("o_orderkey"), F.date_format("day", "yyyyMMdd").alias("ann_date")],
        "P": [C("o_orderkey"), C("o_custkey"), C("o_totalprice"), C("o_orderpriority")],
    }
    for status, columns in kept.items():
        o.where(C("o_orderstatus") == status).select(*columns, "year").hint("rebalance", "year").write.partitionBy("year").parquet(f"{root}/sales/orders_{status}")
    return root


def _inventory(s: SparkSession, d: str) -> DataFrame:
    inv = footers.footer_inventory(s, _mixed_store(s, d))
    out = inv.groupBy("family", "api", "bucket_kind", "bucket_value", "date_column", "column_count", "status")
    return out.agg(F.sum("rows").alias("rows"), F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"), F.count_distinct("fingerprint").alias("schemas"))


register(
    "s8_footer_inventory",
    _inventory,
    """SELECT 'sales' AS family, 'orders_' || o_orderstatus AS api, 'year' AS bucket_kind, year(o_orderdate)::VARCHAR AS bucket_value,
         CASE o_orderstatus WHEN 'F' THEN 'trade_date' WHEN 'O' THEN 'ann_date' ELSE 'partition.year' END AS date_column,
         CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 ELSE 4 END::INTEGER AS column_count, 'ok' AS status, count(*) AS rows,
         CASE WHEN o_orderstatus = 'P' THEN make_date(year(o_orderdate), 1, 1) ELSE min(o_orderdate)::DATE END AS min_date,
         CASE WHEN o_orderstatus = 'P' THEN make_date(year(o_orderdate), 12, 31) ELSE max(o_orderdate)::DATE END AS max_date, 1::BIGINT AS schemas
       FROM orders GROUP BY o_orderstatus, year(o_orderdate)""",
)
register(
    "v18_inventory_summary",
    lambda s, d: footers.inventory_summary(footers.footer_inventory(s, _mixed_store(s, d), digests=False)).drop("bytes", "files", "ok_files"),
    """SELECT 'orders_' || o_orderstatus AS api, 0::BIGINT AS unreadable_files, count(*) AS rows,
         CASE WHEN o_orderstatus = 'P' THEN make_date(year(min(o_orderdate)), 1, 1) ELSE min(o_orderdate)::DATE END AS min_date,
         CASE WHEN o_orderstatus = 'P' THEN make_date(year(max(o_orderdate)), 12, 31) ELSE max(o_orderdate)::DATE END AS max_date
       FROM orders GROUP BY o_orderstatus""",
)


def _verified(s: SparkSession, d: str) -> DataFrame:
    """Every file of the store is held against a manifest of its own digests, with one of them changed for each source."""
    from ..sources import files

    inv = footers.footer_inventory(s, _mixed_store(s, d))
    manifest = inv.select("path", F.when(C("bucket_value") == "1996", F.lit("changed")).otherwise(C("digest")).alias("digest"))
    bad = files.verify(inv.select("path", "digest"), manifest)
    return bad.select(F.split("path", "/")[1].alias("api"), F.split("path", "/")[2].alias("folder")).distinct()


register("s7_changed_digests", _verified, "SELECT DISTINCT 'orders_' || o_orderstatus AS api, 'year=1996' AS folder FROM orders WHERE year(o_orderdate) = 1996")


# --- types that differ between files


def _mixed_types(s: SparkSession, d: str) -> DataFrame:
    root = scratch(s, "types")
    o = _orders(s, d)
    kinds = {"F": C("o_custkey").cast("int"), "O": C("o_custkey") + 0.5, "P": F.concat(F.lit("c"), C("o_custkey").cast("string"))}
    for status, value in kinds.items():
        o.where(C("o_orderstatus") == status).select("o_orderkey", value.alias("v"), F.lit(1).alias(f"only_{status}")).write.parquet(f"{root}/f/{status}")
    return footers.read_mixed(s, footers.footer_inventory(s, root, digests=False)).select("o_orderkey", "v", "only_F")


register(
    "n14_mixed_types",
    _mixed_types,
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_custkey::VARCHAR WHEN 'O' THEN (o_custkey + 0.5)::DOUBLE::VARCHAR ELSE 'c' || o_custkey::VARCHAR END AS v,
         CASE WHEN o_orderstatus = 'F' THEN 1 END AS "only_F" FROM orders""",
)


# --- buckets and compaction


def _partitions(s: SparkSession, d: str) -> DataFrame:
    """Orders as folders of a raw lake, whose partition keys differ."""
    day, iso, k = F.date_format("day", "yyyyMMdd"), F.date_format("day", "yyyy-MM-dd"), C("o_orderkey") % 9
    end = F.date_format(F.date_add("day", 40), "yyyyMMdd")
    one = lambda key, value: F.create_map(F.lit(key), value)
    parts = F.when(k == 0, one("snapshot", C("o_orderpriority"))).when(k == 1, one("year", F.date_format("day", "yyyy"))).when(k == 2, one("trade_date", day))
    parts = parts.when(k == 3, one("suspend_date", iso)).when(k == 4, one("report_date", day)).when(k == 5, one("since_date", iso)).when(k == 6, one("symbol", C("o_orderpriority")))
    parts = parts.when(k == 7, F.map_concat(one("start_date", day), one("end_date", end))).otherwise(F.map_concat(one("cal_date", day), one("symbol", C("o_orderpriority"))))
    return _orders(s, d).select("o_orderkey", parts.alias("partition"))


register(
    "n17_buckets",
    lambda s, d: _partitions(s, d).groupBy(lake.partition_bucket("partition", "19920101", "20011231").alias("bucket")).agg(F.count("*").alias("files")),
    """WITH p AS (SELECT o_orderkey % 9 AS k, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%Y%m%d') AS a, strftime(o_orderdate::DATE + 40, '%Y%m%d') AS b, o_orderpriority AS p FROM orders)
       SELECT CASE WHEN k = 0 THEN 'snapshot=' || p WHEN k = 5 THEN 'since=' || a WHEN k = 6 THEN 'scope=run_19920101_20011231'
         WHEN k = 7 AND a[:4] <> b[:4] THEN 'window=' || a || '_' || b ELSE 'year=' || y END AS bucket, count(*) AS files FROM p GROUP BY 1""",
)


def _raw_lake(s: SparkSession, d: str) -> str:
    """A folder a month of orders, one file each, and a folder a nation of suppliers, which have no day."""
    root = scratch(s, "raw")
    o = _orders(s, d).select("o_orderkey", "o_custkey", "o_totalprice", F.date_format(F.trunc("day", "month"), "yyyyMMdd").alias("trade_date"))
    o.repartition("trade_date").write.partitionBy("trade_date").parquet(f"{root}/sales/orders")
    supplier = src.table(s, d, "supplier").select("s_suppkey", "s_acctbal", C("s_nationkey").alias("symbol"))
    supplier.repartition("symbol").write.partitionBy("symbol").parquet(f"{root}/parties/suppliers")
    return root


def _compacted(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return compaction.compact_raw(s, _raw_lake(s, d), scratch(s, "package"), "19920101", "20011231")


_BUCKETS = """b AS (SELECT 'sales' AS source_family, 'orders' AS api_name, 'year' AS bucket_kind, strftime(o_orderdate, '%Y') AS bucket_value, strftime(o_orderdate, '%Y%m') AS folder, 3 AS width FROM orders
  UNION ALL SELECT 'parties', 'suppliers', 'scope', 'run_19920101_20011231', s_nationkey::VARCHAR, 2 FROM supplier)"""
register(
    "l1_compaction_qa",
    lambda s, d: _compacted(s, d)[1].select("source_family", "api_name", "bucket_kind", "bucket_value", "expected_rows", "actual_rows", "actual_columns", "ok"),
    f"WITH {_BUCKETS} SELECT source_family, api_name, bucket_kind, bucket_value, count(*) AS expected_rows, count(*) AS actual_rows, max(width)::INTEGER AS actual_columns, true AS ok FROM b GROUP BY ALL",
)


def _lineage(s: SparkSession, d: str) -> DataFrame:
    rows = _compacted(s, d)[0].groupBy("compact_relative_path", "bucket_kind", "bucket_value")
    whole = F.count_if(F.col("source_sha256").rlike("^[0-9a-f]{64}$"))
    return rows.agg(F.count("*").alias("sources"), whole.alias("digests"), F.sum("source_rows").alias("rows"), F.max(F.json_array_length("source_columns")).alias("columns"))


register(
    "l1_compaction_lineage",
    _lineage,
    f"""WITH {_BUCKETS} SELECT 'data/_source_family=' || source_family || '/_api_name=' || api_name || '/_bucket_kind=' || bucket_kind || '/_bucket_value=' || bucket_value AS compact_relative_path,
         bucket_kind, bucket_value, count(DISTINCT folder) AS sources, count(DISTINCT folder) AS digests, count(*) AS rows, max(width)::INTEGER AS columns FROM b GROUP BY source_family, api_name, bucket_kind, bucket_value""",
)


# --- merge of touched buckets


def _sides(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders before 1999 as a table by year, and later runs: rows of 1996 to 2000, some of them changed in 1997 and repeated in 1998."""
    o = _orders(s, d).select("o_orderkey", "o_custkey", "o_totalprice", F.year("day").alias("year"))
    new = o.where("year between 1996 and 2000 and o_orderkey % 3 < 2")
    price = F.when((C("year") == 1997) & (C("o_orderkey") % 31 == 0), C("o_totalprice") + 1).otherwise(C("o_totalprice"))
    new = new.withColumn("o_totalprice", price)
    return o.where("year < 1999 and o_orderkey % 3 > 0"), new.unionByName(new.where("year = 1998 and o_orderkey % 50 = 0"))


def _merged(s: SparkSession, d: str) -> tuple[str, DataFrame, DataFrame]:
    path = scratch(s, "orders")
    old, new = _sides(s, d)
    old.hint("rebalance", "year").write.partitionBy("year").parquet(path)
    return path, *merge.merge_into(s, path, new, ["o_orderkey"], ["year"])


def _merged_table(s: SparkSession, d: str) -> DataFrame:
    path, _, _ = _merged(s, d)
    return s.read.parquet(path).select("o_orderkey", "o_custkey", "o_totalprice", "year")


_SIDES = """src AS (SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate)::INTEGER AS year FROM orders),
  old AS (SELECT * FROM src WHERE year < 1999 AND o_orderkey % 3 > 0),
  once AS (SELECT o_orderkey, o_custkey, o_totalprice + CASE WHEN year = 1997 AND o_orderkey % 31 = 0 THEN 1 ELSE 0 END AS o_totalprice, year FROM src WHERE year BETWEEN 1996 AND 2000 AND o_orderkey % 3 < 2),
  new AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE year = 1998 AND o_orderkey % 50 = 0),
  k AS (SELECT coalesce(a.year, b.year) AS year, coalesce(a.n, 0) AS n_old, coalesce(b.n, 0) AS n_new, a.row IS NOT DISTINCT FROM b.row AS same
    FROM (SELECT year, o_orderkey, count(*) AS n, any_value((o_custkey, o_totalprice)) AS row FROM old GROUP BY ALL) a
    FULL JOIN (SELECT year, o_orderkey, count(*) AS n, any_value((o_custkey, o_totalprice)) AS row FROM new GROUP BY ALL) b ON a.year = b.year AND a.o_orderkey = b.o_orderkey),
  t AS (SELECT year, sum(n_old)::BIGINT AS old_rows, sum(n_new)::BIGINT AS new_rows, coalesce(sum(n_old) FILTER (WHERE n_old > 1), 0) + coalesce(sum(n_new) FILTER (WHERE n_new > 1), 0) AS dup,
    count(*) FILTER (WHERE n_new = 0) AS oo, count(*) FILTER (WHERE n_old = 0) AS nn, count(*) FILTER (WHERE n_old > 0 AND n_new > 0 AND same) AS ii,
    count(*) FILTER (WHERE n_old > 0 AND n_new > 0 AND NOT same) AS cc FROM k WHERE year IN (SELECT year FROM new) GROUP BY year)"""
register(
    "l3_bucket_merge",
    lambda s, d: _merged(s, d)[1],
    f"""WITH {_SIDES} SELECT year, CASE WHEN dup > 0 OR cc > 0 THEN 'BLOCKED' ELSE 'PASS' END AS status, old_rows, new_rows, CASE WHEN dup > 0 OR cc > 0 THEN 0 ELSE old_rows + nn END AS candidate_rows,
         CASE WHEN dup > 0 THEN 0 ELSE oo END AS old_only_rows, CASE WHEN dup > 0 THEN 0 ELSE nn END AS new_only_rows, CASE WHEN dup > 0 THEN 0 ELSE ii END AS identical_overlap_rows,
         CASE WHEN dup > 0 THEN 0 ELSE cc END AS conflict_rows, dup::BIGINT AS duplicate_key_rows, false AS schema_mismatch,
         CASE WHEN dup > 0 THEN '{merge.DUPLICATES}' WHEN cc > 0 THEN '{merge.CONFLICTS}' ELSE '{merge.MERGED}' END AS reason FROM t""",
)
register(
    "l3_bucket_conflicts",
    lambda s, d: _merged(s, d)[2].select("year", "o_orderkey", C("old.o_totalprice").alias("old_price"), C("new.o_totalprice").alias("new_price")),
    f"WITH {_SIDES} SELECT a.year, a.o_orderkey, a.o_totalprice AS old_price, b.o_totalprice AS new_price FROM old a JOIN once b USING (year, o_orderkey) WHERE year <> 1998 AND a.o_totalprice <> b.o_totalprice",
)
register(
    "l3_merged_table",
    _merged_table,
    f"WITH {_SIDES} SELECT * FROM old UNION ALL SELECT * FROM new WHERE year IN (SELECT year FROM t WHERE dup = 0 AND cc = 0) AND o_orderkey NOT IN (SELECT o_orderkey FROM old)",
)


# --- the plan of fetch windows


def _apis(s: SparkSession, d: str) -> DataFrame:
    """Customers as apis: of three policies, with overlaps of several lengths."""
    k = C("c_custkey")
    return src.table(s, d, "customer").select(
        F.lit("p").alias("provider"), F.concat(F.lit("fam_"), (k % 5).cast("string")).alias("source_family"), k.cast("string").alias("api_name"), F.lit("v1").alias("dataset_version"),
        F.lit("day").alias("query_mode"), F.when(k % 10 == 8, "range").when(k % 10 == 9, "snapshot").otherwise("trade_date").alias("policy"),
        F.date_add(F.lit("1995-01-01").cast("date"), (k % 300).cast("int")).alias("start_date"), (k % 12).cast("int").alias("overlap_days"),
    )


def _landed(s: SparkSession, d: str) -> DataFrame:
    """Orders of a customer and year as files; some are unreadable, some have no dates."""
    o = _orders(s, d).groupBy(C("o_custkey").alias("c"), F.year("day").cast("string").alias("y")).agg(F.count("*").alias("rows"), F.max("day").alias("last"))
    c = C("c")
    kind = F.when(c % 10 == 8, "window").when(c % 10 == 9, "snapshot").otherwise("year")
    return o.select(
        c.cast("string").alias("api_name"), kind.alias("bucket_kind"), F.when(kind == "year", C("y")).otherwise("latest").alias("bucket_value"),
        F.concat_ws("/", c.cast("string"), "y").alias("relative_path"), "rows", F.when(c % 7 > 0, C("last")).alias("max_date"), F.lit(None).cast("date").alias("snapshot_date"),
        F.when(c % 11 == 0, "unreadable").otherwise("ok").alias("status"),
    )


def _calendar(s: SparkSession, d: str) -> DataFrame:
    """Days with orders: open from Monday to Friday but for the first and the tenth of a month."""
    days = _orders(s, d).select("day").distinct()
    return days.select("day", ((F.weekday("day") < 5) & ~F.dayofmonth("day").isin(1, 10)).alias("is_open"))


def _plan_sql(steps: str, more: str = "") -> str:
    return f"""WITH last_day AS (SELECT max(o_orderdate)::DATE AS e, year(max(o_orderdate)) AS y FROM orders), {more}
  a AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 10 = 8 THEN 'range' WHEN c_custkey % 10 = 9 THEN 'snapshot' ELSE 'trade_date' END AS policy,
    (DATE '1995-01-01' + (c_custkey % 300)::INTEGER) AS start_date, (c_custkey % 12)::INTEGER AS ov FROM customer),
  f AS (SELECT o_custkey AS c, year(o_orderdate) AS y, count(*) AS n, CASE WHEN o_custkey % 7 > 0 THEN max(o_orderdate)::DATE END AS last FROM orders WHERE o_custkey % 11 <> 0 GROUP BY o_custkey, year(o_orderdate)),
  h AS (SELECT a.*, f.c IS NOT NULL AS there, f.c::VARCHAR || '/' || f.y::VARCHAR AS path, f.n, f.last,
    EXISTS (SELECT 1 FROM f g WHERE g.c = a.k AND policy = 'trade_date' AND g.y < (SELECT y FROM last_day)) AS closed
    FROM a LEFT JOIN (SELECT f.* FROM f WHERE c % 10 < 8 AND y = (SELECT y FROM last_day) UNION ALL SELECT * FROM f WHERE c % 10 >= 8 QUALIFY row_number() OVER (PARTITION BY c ORDER BY y DESC) = 1) f ON f.c = a.k),
  x AS (SELECT *, make_date((SELECT y FROM last_day), 1, 1) AS y0, {steps} AS back FROM h)
SELECT 'p' AS provider, 'fam_' || (k % 5)::VARCHAR AS source_family, k::VARCHAR AS api_name, 'v1' AS dataset_version,
  CASE policy WHEN 'range' THEN 'stable_latest_range' WHEN 'snapshot' THEN 'stable_latest_snapshot' ELSE 'by_trade_date_open_year' END AS plan_kind, 'day' AS query_mode,
  CASE policy WHEN 'range' THEN start_date WHEN 'snapshot' THEN (SELECT e FROM last_day)
    ELSE CASE WHEN there AND last IS NOT NULL THEN greatest(back, y0) WHEN there OR closed THEN y0 ELSE start_date END END AS fetch_start_date,
  (SELECT e FROM last_day) AS fetch_end_date, CASE policy WHEN 'range' THEN 'window' WHEN 'snapshot' THEN 'snapshot' ELSE 'year' END AS target_bucket_kind,
  CASE WHEN policy = 'trade_date' THEN (SELECT y FROM last_day)::VARCHAR ELSE 'latest' END AS target_bucket_value,
  'raw/p/fam_' || (k % 5)::VARCHAR || '/' || k::VARCHAR || '/v1/' || CASE policy WHEN 'range' THEN 'window=latest' WHEN 'snapshot' THEN 'snapshot=latest' ELSE 'year=' || (SELECT y FROM last_day)::VARCHAR END || '/data.parquet' AS target_relative_path,
  coalesce(path, '') AS existing_relative_path, last AS existing_max_date, n AS existing_rows, (SELECT y FROM last_day)::VARCHAR AS open_year,
  CASE WHEN policy = 'trade_date' THEN CASE WHEN there THEN '{increments.REPLACE_YEAR}' ELSE '{increments.COPY_YEAR}' END WHEN there THEN '{increments.REPLACE_LATEST}' ELSE '{increments.COPY_LATEST}' END AS planned_action,
  CASE policy WHEN 'range' THEN 'stable latest window refresh' WHEN 'snapshot' THEN 'stable latest snapshot refresh'
    ELSE CASE WHEN NOT there THEN '{increments.NO_BUCKET}' WHEN last IS NULL THEN '{increments.NO_DATES}' ELSE '{increments.OVERLAP}' END END AS reason FROM x"""


def _end(s: SparkSession, d: str) -> str:
    return str(_orders(s, d).agg(F.max("day")).first()[0])


_WEEKDAYS_BACK = (
    "CASE WHEN ov = 0 THEN last ELSE (SELECT list_sort(list(dd), 'DESC')[ov] "
    "FROM (SELECT (last - i::INTEGER)::DATE AS dd FROM range(1, 40) r(i)) WHERE isodow(dd) < 6) END"
)
register(
    "l4_incremental_plan",
    lambda s, d: increments.incremental_plan(_apis(s, d), _landed(s, d), _end(s, d)),
    _plan_sql(_WEEKDAYS_BACK),
)
register(
    "l4_plan_open_days",
    lambda s, d: increments.incremental_plan(_apis(s, d), _landed(s, d), _end(s, d), calendar=_calendar(s, d)),
    _plan_sql(
        "CASE WHEN ov = 0 THEN last ELSE (SELECT days[greatest(1, len(list_filter(days, lambda q: q < last)) - ov + 1)] FROM cal) END",
        "cal AS (SELECT list_sort(list(DISTINCT o_orderdate::DATE)) AS days FROM orders WHERE isodow(o_orderdate) < 6 AND day(o_orderdate) NOT IN (1, 10)),",
    ),
)
register(
    "l4_incremental_window",
    lambda s, d: increments.incremental_window(_orders(s, d).select(C("o_orderpriority").alias("api"), C("day").alias("date"))),
    """SELECT api, m AS max_date, greatest((SELECT list_sort(list(dd), 'DESC')[7] FROM (SELECT (m - i::INTEGER)::DATE AS dd FROM range(1, 30) r(i)) WHERE isodow(dd) < 6), date_trunc('year', m)::DATE) AS fetch_from
       FROM (SELECT o_orderpriority AS api, max(o_orderdate)::DATE AS m FROM orders GROUP BY 1)""",
)


# --- expected partitions of specifications


def _specs(s: SparkSession, d: str) -> DataFrame:
    """Customers as sources of all modes; every third has two dimensions. Those by symbol, which take all suppliers, are one in 500."""
    k = C("c_custkey")
    mode = F.element_at(F.array(*[F.lit(m) for m in grids.MODES[:-1]]), (k % 7 + 1).cast("int"))
    start = F.date_add(F.lit("1998-01-15").cast("date"), (k % 400).cast("int"))
    both = F.when(k % 3 == 0, F.array(F.lit("SSE"), F.lit("SZSE"))).otherwise(F.array().cast("array<string>"))
    return src.table(s, d, "customer").select(
        k.cast("string").alias("api_name"), F.when(k % 500 == 1, "symbol").otherwise(mode).alias("mode"), start.alias("start"),
        F.date_add(start, (k % 120).cast("int") - 5).alias("end"), both.alias("dimensions"),
    )


def _expected(s: SparkSession, d: str) -> DataFrame:
    return grids.expected_partitions(_specs(s, d), src.table(s, d, "supplier").select(C("s_suppkey").cast("string").alias("symbol")))


_GRID = f"""spec AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 500 = 1 THEN 'symbol' ELSE {list(grids.MODES[:-1])}[(c_custkey % 7 + 1)::INTEGER] END AS mode, DATE '1998-01-15' + (c_custkey % 400)::INTEGER AS a FROM customer),
  r AS (SELECT *, a + ((k % 120)::INTEGER - 5) AS b FROM spec),
  x AS (SELECT r.*, t.dimension FROM r, (SELECT 'SSE' AS dimension UNION ALL SELECT 'SZSE' UNION ALL SELECT NULL) t WHERE a <= b AND (t.dimension IS NOT NULL) = (k % 3 = 0)),
  cal AS (SELECT (DATE '1997-12-01' + i::INTEGER)::DATE AS dd FROM range(0, 900) q(i)),
  e AS (SELECT k, dimension, NULL::VARCHAR AS symbol, strftime(dd, '%Y%m%d') AS partition, dd AS start_date, dd AS end_date FROM x JOIN cal ON dd BETWEEN a AND b
      WHERE mode = 'day' OR (mode = 'weekday' AND isodow(dd) < 6) OR (mode = 'quarter_end' AND day(dd + 1) = 1 AND month(dd) % 3 = 0)
    UNION ALL SELECT k, dimension, NULL, strftime(dd, '%Y%m'), min(dd), max(dd) FROM x JOIN cal ON dd BETWEEN a AND b WHERE mode = 'month' GROUP BY ALL
    UNION ALL SELECT k, dimension, NULL, strftime(dd, '%Y'), min(dd), max(dd) FROM x JOIN cal ON dd BETWEEN a AND b WHERE mode = 'year' GROUP BY ALL
    UNION ALL SELECT k, dimension, NULL, CASE mode WHEN 'range' THEN strftime(a, '%Y%m%d') || '_' || strftime(b, '%Y%m%d') ELSE 'latest' END, CASE mode WHEN 'range' THEN a ELSE b END, b FROM x WHERE mode IN ('range', 'snapshot')
    UNION ALL SELECT k, dimension, lpad(s_suppkey::VARCHAR, 6, '0'), strftime(a, '%Y%m%d') || '_' || strftime(b, '%Y%m%d'), a, b FROM x, supplier WHERE mode = 'symbol')"""
register("j15_expected_partitions", _expected, f"WITH {_GRID} SELECT k::VARCHAR AS api_name, dimension, symbol, partition, start_date, end_date FROM e")


def _missing(s: SparkSession, d: str) -> DataFrame:
    """What has landed is every partition of a month's first half, and one symbol in two."""
    expected = _expected(s, d)
    return grids.missing_partitions(expected, expected.where("dayofmonth(end_date) < 16 and (symbol is null or cast(symbol as int) % 2 = 0)"))


register("l12_missing_partitions", _missing, f"WITH {_GRID} SELECT k::VARCHAR AS api_name, dimension, symbol, partition, start_date, end_date FROM e WHERE day(end_date) >= 16 OR coalesce(symbol::INTEGER % 2 = 1, false)")


# --- sinks that refuse what is there, and stores by asset


def _symbol_months(s: SparkSession, d: str) -> DataFrame:
    """The catalog of a second run, over all orders, after one over those before 1998."""
    path = scratch(s, "bars")
    o = _orders(s, d).select(C("day").alias("date"), C("o_orderstatus").alias("code"), "o_orderkey", "o_totalprice")
    sinks.write_symbol_months(o.where("date < '1998-01-01'"), path, symbol="code")
    catalog = sinks.write_symbol_months(o, path, symbol="code")
    landed = s.read.parquet(path).groupBy(C("symbol").cast("string").alias("symbol"), "year", "month").agg(F.count("*").alias("landed"))
    catalog = catalog.withColumns({"year": C("year").cast("int"), "month": C("month").cast("int")})
    return catalog.join(landed, ["symbol", "year", "month"]).select("symbol", "adjust", "year", "month", "rows", "status", "landed")


register(
    "k5_symbol_months",
    _symbol_months,
    """SELECT o_orderstatus AS symbol, 'none' AS adjust, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, count(*) AS rows,
         CASE WHEN year(o_orderdate) < 1998 THEN 'already_exists' ELSE 'success' END AS status, count(*) AS landed FROM orders GROUP BY ALL""",
)
_BF = {"ret_1d": 6, "ret_20d": 6, "vol_20d": 6, "fwd_ret_5d": 6}


def _store_by_asset(s: SparkSession, d: str) -> DataFrame:
    """Features over a panel that is stored by asset: no row is shuffled for their windows."""
    panel = sinks.save_by_asset(src.daily_panel(s, d), scratch(s, "panel"), f"panel_{uuid.uuid4().hex}", 16)
    return features.compute_features(panel, list(_BF))


register("s2_store_by_asset", lambda s, d: even(_store_by_asset(s, d), ["date", "asset"], _BF), f"WITH {FEAT} SELECT date, asset, {even_sql({c: (c, n) for c, n in _BF.items()})} FROM feat")
