"""Queries of the catalog and manifest jobs, with orders and events as tasks, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog as jobs
from ..operators import checks, contracts, lake, normalise
from ..sources import panel as src
from .registry import PANEL, even, register, rnd

C = F.col
_STATUS = ("failed", "timeout", "empty", "skipped", "pending_adapter", "already_exists")
TASKS = f"""tasks AS (SELECT o_orderkey AS task_id, o_orderpriority AS source_family, 'api_' || (o_custkey % 20)::VARCHAR AS api_name,
  CASE o_orderkey % 11 {' '.join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_STATUS))} ELSE 'success' END AS status, (o_orderkey % 3 * 10)::BIGINT AS rows, o_totalprice / 1000 AS elapsed_sec,
  CASE WHEN o_orderkey % 7 > 0 THEN 'E' || (o_orderkey % 4)::VARCHAR END AS error_type, o_orderstatus AS error_message, o_orderdate::DATE AS day, o_custkey::VARCHAR AS symbol, strftime(o_orderdate, '%Y-%m') AS partition,
  CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE '/run/' || 'data/' || o_orderkey::VARCHAR || '.parquet' END AS output_path, CASE WHEN o_orderkey % 17 = 0 THEN '/run/metadata/nan/x.json' ELSE '/run/metadata/' || o_orderkey::VARCHAR || '.json' END AS metadata_path FROM orders)"""


def tasks(spark: SparkSession, d: str) -> DataFrame:
    """Orders as the rows of an ingest catalog."""
    k, text = C("o_orderkey"), lambda c: c.cast("string")
    status = F.coalesce(F.try_element_at(F.array(*[F.lit(s) for s in _STATUS]), (k % 11 + 1).cast("int")), F.lit("success"))
    return src.table(spark, d, "orders").select(
        k.alias("task_id"), C("o_orderpriority").alias("source_family"), F.concat(F.lit("api_"), text(C("o_custkey") % 20)).alias("api_name"), status.alias("status"), (k % 3 * 10).cast("long").alias("rows"),
        (C("o_totalprice") / 1000).alias("elapsed_sec"), F.when(k % 7 > 0, F.concat(F.lit("E"), text(k % 4))).alias("error_type"), C("o_orderstatus").alias("error_message"), F.to_date("o_orderdate").alias("day"),
        text(C("o_custkey")).alias("symbol"), F.date_format("o_orderdate", "yyyy-MM").alias("partition"), F.when(k % 13 == 0, "").otherwise(F.concat(F.lit("/run/data/"), text(k), F.lit(".parquet"))).alias("output_path"),
        F.when(k % 17 == 0, "/run/metadata/nan/x.json").otherwise(F.concat(F.lit("/run/metadata/"), text(k), F.lit(".json"))).alias("metadata_path"),
    )


def recovery(spark: SparkSession, d: str) -> DataFrame:
    """Later runs of the tasks of most apis that failed."""
    return tasks(spark, d).where("status in ('failed', 'timeout') and api_name <> 'api_7'").select("task_id", "source_family", "api_name", F.when(C("task_id") % 2 == 0, "success").otherwise("already_exists").alias("status"), "rows")


REC = "rec AS (SELECT task_id, source_family, api_name, CASE WHEN task_id % 2 = 0 THEN 'success' ELSE 'already_exists' END AS status, rows FROM tasks WHERE status IN ('failed', 'timeout') AND api_name <> 'api_7'), good AS (SELECT * FROM rec WHERE status = 'success' OR rows > 0)"
_n = lambda s: f"count(*) FILTER (WHERE status = '{s}')"
_AUD = {"elapsed_sec": 4, "success_rate": 8, "failed_rate": 8, "empty_rate": 8, "avg_elapsed_sec": 6}
register("v14_failure_audit", lambda s, d: even(jobs.failure_audit(tasks(s, d)), ["source_family", "api_name", "total_tasks", *[f"{x}_tasks" for x in jobs.STATUSES], "rows", "review_priority"], _AUD),
         f"""WITH {TASKS}, a AS (SELECT source_family, api_name, count(*) AS total_tasks, {', '.join(f'{_n(s)} AS {s}_tasks' for s in jobs.STATUSES)}, sum(rows)::BIGINT AS rows, sum(elapsed_sec) AS e FROM tasks GROUP BY 1, 2)
         SELECT * EXCLUDE (e), round(e + 1e-7, 4) AS elapsed_sec, round(success_tasks / total_tasks + 1e-11, 8) AS success_rate, round(failed_tasks / total_tasks + 1e-11, 8) AS failed_rate, round(empty_tasks / total_tasks + 1e-11, 8) AS empty_rate, round(e / total_tasks + 1e-9, 6) AS avg_elapsed_sec,
         CASE WHEN failed_tasks + timeout_tasks + pending_adapter_tasks > 0 THEN CASE WHEN failed_tasks / total_tasks >= 0.8 THEN 'P0' WHEN failed_tasks / total_tasks >= 0.3 THEN 'P1' WHEN failed_tasks > 0 THEN 'P2' ELSE 'P3' END END AS review_priority FROM a""")
register("v14_error_summary", lambda s, d: jobs.error_summary(tasks(s, d)),
         f"WITH {TASKS} SELECT source_family, api_name, status, coalesce(error_type, '') AS error_type, coalesce(error_message, '') AS error_message, count(*) AS tasks FROM tasks WHERE status IN ('failed', 'timeout', 'pending_adapter', 'skipped') GROUP BY ALL")
register("v19_failure_backlog", lambda s, d: jobs.failure_backlog(tasks(s, d)).withColumn("elapsed_sec", F.round("elapsed_sec", 6)),
         f"""WITH {TASKS} SELECT source_family, api_name, status, '' AS original_symbol, '' AS akshare_symbol, '' AS params_json, '' AS partition_json, '' AS task_key_json, error_type, error_message, round(elapsed_sec, 6) AS elapsed_sec, output_path FROM tasks
         WHERE status IN ('failed', 'timeout', 'pending_adapter', 'skipped')""")
register("v15_duplicate_partitions", lambda s, d: jobs.duplicate_partitions(tasks(s, d), ("symbol", "partition")), f"WITH {TASKS} SELECT symbol, partition, count(*) AS n FROM tasks GROUP BY 1, 2 HAVING count(*) > 1")


def observed(spark: SparkSession, d: str) -> DataFrame:
    """Events of a user and day as samples of a source's load."""
    day = src.table(spark, d, "events").groupBy(C("event_type").alias("source_key"), (C("user_id") % 3).alias("workload_class"), F.to_date("ts").alias("day"))
    return day.agg(F.count("*").alias("latency_sample_count"), F.countDistinct("user_id").alias("peak_inflight_tasks"), F.median("value").alias("median_task_elapsed_sec"), F.percentile("value", F.lit(0.9)).alias("p90_task_elapsed_sec"))


register("v15_concurrency_review", lambda s, d: rnd(jobs.concurrency_review(observed(s, d), "source_key", "workload_class"), ["source_key", "workload_class", "peak_inflight_tasks", "latency_sample_count"], {"median_task_elapsed_sec": 6, "p90_task_elapsed_sec": 6}),
         """WITH o AS (SELECT event_type AS source_key, user_id % 3 AS workload_class, ts::DATE AS day, count(*) AS n, count(DISTINCT user_id) AS p, median(value) AS m, quantile_cont(value, 0.9) AS q FROM events GROUP BY 1, 2, 3)
         SELECT source_key, workload_class, max(p) AS peak_inflight_tasks, sum(n)::BIGINT AS latency_sample_count, round(median(m), 6) AS median_task_elapsed_sec, round(median(q), 6) AS p90_task_elapsed_sec FROM o GROUP BY 1, 2""")


def policy(spark: SparkSession, d: str) -> DataFrame:
    apis = src.table(spark, d, "customer").select((C("c_custkey") % 24).alias("i")).distinct().select(F.concat(F.lit("api_"), C("i").cast("string")).alias("api_name"), (C("i") % 5 == 0).alias("excluded"), (C("i") % 7 == 0).alias("disabled"))
    return tasks(spark, d).select("source_family").distinct().join(F.broadcast(apis))  # some dozens of apis


register("v17_checklist", lambda s, d: jobs.acquisition_checklist(policy(s, d), tasks(s, d), "task_id"),
         f"""WITH {TASKS}, p AS (SELECT * FROM (SELECT DISTINCT source_family FROM tasks), (SELECT DISTINCT c_custkey % 24 AS i FROM customer)), l AS (SELECT source_family, api_name, arg_max(status, task_id) AS st FROM tasks GROUP BY 1, 2)
         SELECT p.source_family, 'api_' || i::VARCHAR AS api_name, CASE WHEN i % 5 = 0 THEN '排除' WHEN i % 7 = 0 THEN '暂停获取' WHEN st = 'success' THEN '获取' ELSE '暂停获取' END AS acquisition_status FROM p LEFT JOIN l ON l.source_family = p.source_family AND l.api_name = 'api_' || i::VARCHAR""")
register("j11_unrecovered", lambda s, d: jobs.unrecovered(tasks(s, d), recovery(s, d)), f"WITH {TASKS}, {REC} SELECT DISTINCT source_family, api_name FROM tasks t WHERE status IN ('failed', 'timeout') AND NOT EXISTS (SELECT 1 FROM good g WHERE g.source_family = t.source_family AND g.api_name = t.api_name)")
register("j11_effective_catalog", lambda s, d: jobs.effective_catalog(tasks(s, d).select("task_id", "source_family", "api_name", "status", "rows"), recovery(s, d), strict=False),
         f"WITH {TASKS}, {REC} SELECT task_id, source_family, api_name, status, rows FROM tasks WHERE status NOT IN ('failed', 'timeout') UNION ALL SELECT * FROM good")


def _gaps(spark: SparkSession, d: str) -> DataFrame:
    viable = src.table(spark, d, "customer").select(F.concat(F.lit("api_"), (C("c_custkey") % 50).cast("string")).alias("api_name")).distinct()
    events = src.table(spark, d, "events").select(F.concat(F.lit("api_"), (C("user_id") % 37).cast("string")).alias("api_name"))
    return jobs.source_gaps(viable, tasks(spark, d).where("rows = 20 and status = 'success'").select(F.concat(C("api_name"), F.lit("")).alias("api_name")), tasks(spark, d).where("status = 'empty'"), events.where("api_name <> 'api_3'"))


register("j10_source_gaps", _gaps, f"""WITH {TASKS}, v AS (SELECT DISTINCT 'api_' || (c_custkey % 50)::VARCHAR AS api_name FROM customer), e AS (SELECT DISTINCT 'api_' || (user_id % 37)::VARCHAR AS a FROM events WHERE user_id % 37 <> 3),
  m AS (SELECT api_name, api_name IN (SELECT api_name FROM tasks WHERE rows = 20 AND status = 'success') AS r, api_name IN (SELECT api_name FROM tasks WHERE status = 'empty') AS c, api_name IN (SELECT a FROM e) AS u FROM v)
  SELECT api_name, r AS already_in_registry, c AS already_seen_in_catalog, u AS already_audited, NOT r AS missing_from_registry, NOT (c OR u) AS missing_from_coverage_outputs, NOT r AND NOT (c OR u) AS planned_for_expansion FROM m""")
register("j9_universe_filter", lambda s, d: jobs.universe_filter(tasks(s, d), src.table(s, d, "customer").where("c_custkey % 3 = 0").select(C("c_custkey").cast("string").alias("symbol"))),
         f"WITH {TASKS}, u AS (SELECT c_custkey::VARCHAR AS symbol FROM customer WHERE c_custkey % 3 = 0) SELECT partition, count(*) AS rows_before, count(u.symbol) AS rows_after, count(DISTINCT t.symbol) AS symbols_before, count(DISTINCT u.symbol) AS symbols_after, (SELECT count(*) FROM u) - count(DISTINCT u.symbol) AS universe_missing FROM tasks t LEFT JOIN u USING (symbol) GROUP BY 1")
register("v5_field_presence", lambda s, d: jobs.field_presence(tasks(s, d).select("partition", "rows", "error_type"), ["rows", "error_type", "close"]),
         f"WITH {TASKS} SELECT partition, 'rows' AS field, true AS present, count(*) - count(rows) AS null_count, 'bigint' AS dtype FROM tasks GROUP BY 1 UNION ALL SELECT partition, 'error_type', true, count(*) - count(error_type), 'string' FROM tasks GROUP BY 1 UNION ALL SELECT DISTINCT partition, 'close', false, NULL::BIGINT, NULL FROM tasks")


def assets(spark: SparkSession, d: str) -> DataFrame:
    """Orders as files of a lake: one for each customer, month and status."""
    return tasks(spark, d).groupBy(C("symbol").alias("api_name"), C("error_message").alias("bucket_kind"), "partition").agg(F.sum("rows").alias("rows")).select("api_name", F.lit("v1").alias("dataset_version"), "bucket_kind", F.concat_ws("/", "api_name", "bucket_kind", "partition").alias("relative_path"), "rows")


def plan(spark: SparkSession, d: str) -> DataFrame:
    """Every third api's kind of bucket gets its latest file as the only one."""
    latest = assets(spark, d).where("cast(api_name as int) % 3 = 0").groupBy("api_name", "dataset_version", "bucket_kind").agg(F.max("relative_path").alias("target_path"))
    return latest.withColumn("existing_path", F.when(C("bucket_kind") != "P", C("target_path")))


ASSETS = "assets AS (SELECT symbol AS api_name, error_message AS bucket_kind, symbol || '/' || error_message || '/' || partition AS relative_path, sum(rows)::BIGINT AS rows FROM tasks GROUP BY 1, 2, 3), plan AS (SELECT api_name, bucket_kind, max(relative_path) AS target_path FROM assets WHERE api_name::INTEGER % 3 = 0 GROUP BY 1, 2), merged AS (SELECT relative_path, api_name FROM assets WHERE rows = 20)"
_SUP = "a.relative_path IN (SELECT a2.relative_path FROM assets a2 JOIN plan p USING (api_name, bucket_kind) WHERE a2.relative_path <> p.target_path)"
register("j14_superseded", lambda s, d: jobs.superseded(assets(s, d), plan(s, d)).drop("dataset_version"), f"WITH {TASKS}, {ASSETS} SELECT a.* FROM assets a WHERE {_SUP}")
register("l5_active_manifest", lambda s, d: jobs.active_manifest(assets(s, d), plan(s, d), assets(s, d).where("rows = 20").select("relative_path", "api_name")),
         f"""WITH {TASKS}, {ASSETS} SELECT relative_path, api_name, 'keep' AS action FROM assets a WHERE NOT {_SUP} AND relative_path NOT IN (SELECT relative_path FROM merged) AND relative_path NOT IN (SELECT target_path FROM plan)
         UNION ALL SELECT relative_path, api_name, 'merge' FROM merged WHERE relative_path NOT IN (SELECT target_path FROM plan) UNION ALL SELECT target_path, api_name, CASE WHEN bucket_kind <> 'P' THEN 'replace_verified_latest' ELSE 'copy_new_latest' END FROM plan""")


def _versioned_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Files of March cannot be read, those of July are of another version; plans of the third api in four name no existing file but ''."""
    month = F.substring_index("relative_path", "-", -1)
    every = assets(spark, d).withColumns({
        "dataset_version": F.when(month == "07", "v2").otherwise("v1"),
        "status": F.when(month == "03", "unreadable").otherwise("ok"),
    })
    old = F.when(C("api_name").cast("int") % 4 == 3, "").otherwise(C("existing_path"))
    planned = plan(spark, d).withColumn("existing_path", old).withColumn("dataset_version", F.lit("v0"))
    return jobs.active_manifest(every, planned, assets(spark, d).where("rows = 20").select("relative_path", "api_name"), "v1")


register(
    "l5_versioned_manifest",
    _versioned_manifest,
    f"""WITH {TASKS}, {ASSETS} SELECT relative_path, api_name, 'keep' AS action FROM assets a
          WHERE NOT {_SUP} AND relative_path NOT IN (SELECT relative_path FROM merged) AND relative_path NOT IN (SELECT target_path FROM plan)
            AND relative_path NOT LIKE '%-03' AND relative_path NOT LIKE '%-07'
        UNION ALL SELECT relative_path, api_name, 'merge' FROM merged WHERE relative_path NOT IN (SELECT target_path FROM plan)
        UNION ALL SELECT target_path, api_name, CASE WHEN bucket_kind <> 'P' AND api_name::INTEGER % 4 <> 3 THEN 'replace_verified_latest' ELSE 'copy_new_latest' END FROM plan""",
)


def _months(spark: SparkSession, d: str) -> DataFrame:
    rows = tasks(spark, d).select(F.concat(C("source_family"), F.lit("/"), C("api_name"), F.lit("/"), F.year("day").cast("string")).alias("task_key"), C("day").alias("month"), "status", F.date_trunc("year", "day").cast("date").alias("first_month"))
    return rows.withColumn("last_month", F.add_months("first_month", 11))


register("l7_completed_tasks", lambda s, d: jobs.completed_tasks(_months(s, d)),
         f"WITH {TASKS} SELECT source_family || '/' || api_name || '/' || year(day)::VARCHAR AS task_key FROM tasks WHERE status IN ('success', 'already_exists') GROUP BY 1 HAVING count(DISTINCT month(day)) = 12")
register("l10_merge_batch", lambda s, d: jobs.merge_batch(tasks(s, d).where("day < date '1999-01-01'"), tasks(s, d).where("day >= date '1998-06-01'")),
         f"WITH {TASKS} SELECT partition, CASE WHEN min(day) < DATE '1999-01-01' THEN 'skipped_existing' ELSE 'added' END AS action FROM tasks WHERE day >= DATE '1998-06-01' GROUP BY 1")


def _registry(spark: SparkSession, d: str) -> DataFrame:
    """Apis and their families as a registry of sources."""
    return tasks(spark, d).groupBy("source_family", "api_name").agg((F.min("task_id") % 4 + 1).alias("priority")).withColumn("dataset_name", F.concat(C("api_name"), F.lit("_raw")))


REG = "reg AS (SELECT source_family, api_name, min(task_id) % 4 + 1 AS priority, api_name || '_raw' AS dataset_name FROM tasks GROUP BY 1, 2)"
register("l12_backfill_plan", lambda s, d: jobs.backfill_plan(_registry(s, d), "2010-01-01", "2026-12-31"), f"WITH {TASKS}, {REG} SELECT row_number() OVER (ORDER BY priority, source_family, dataset_name, api_name) AS place, priority, source_family, dataset_name, api_name, '2010-01-01' AS backfill_start_date, '2026-12-31' AS backfill_end_date FROM reg")
register("l12_plan_tasks", lambda s, d: jobs.plan_tasks(jobs.backfill_plan(_registry(s, d), "2010-01-01", "2026-12-31")),
         f"WITH {TASKS}, {REG} SELECT dataset_name || '__' || api_name || '__P' || (priority - 1)::VARCHAR AS task_id, dataset_name, source_family, api_name, 'P' || (priority - 1)::VARCHAR AS priority, 'planned' AS status, '2010-01-01' AS planned_start_date, '2026-12-31' AS planned_end_date FROM reg")
register("l12_task_summary", lambda s, d: jobs.task_summary(jobs.filter_cases(jobs.plan_tasks(jobs.backfill_plan(_registry(s, d), "2010-01-01", "2026-12-31")), priority="P1")),
         f"WITH {TASKS}, {REG} SELECT source_family, dataset_name, 'P1' AS priority, count(*) AS task_count FROM reg WHERE priority = 2 GROUP BY 1, 2")
register("l13_plan_differences", lambda s, d: jobs.plan_differences(_registry(s, d), _registry(s, d).withColumn("priority", F.when(C("source_family") == "5-LOW", 9).otherwise(C("priority"))), "source_family", "api_name", "priority"),
         f"WITH {TASKS}, {REG} SELECT source_family, api_name, priority, 'plan' AS side FROM reg WHERE source_family = '5-LOW' UNION ALL SELECT source_family, api_name, 9, 'reviewed' FROM reg WHERE source_family = '5-LOW'")
register("p6_filter_cases", lambda s, d: jobs.filter_cases(tasks(s, d).select("task_id", "source_family", "api_name", "status"), source_family="1-URGENT", status="failed", api_name=None), f"WITH {TASKS} SELECT task_id, source_family, api_name, status FROM tasks WHERE source_family = '1-URGENT' AND status = 'failed'")
register("v16_run_validation", lambda s, d: jobs.run_validation(tasks(s, d), ("success", "empty", "already_exists"), ("api_13",)),
         f"""WITH {TASKS} SELECT 'empty_catalog' AS check_name, (count(*) = 0)::BIGINT AS failed FROM tasks UNION ALL SELECT 'no_rows', (coalesce(sum(rows), 0) <= 0)::BIGINT FROM tasks UNION ALL SELECT 'forbidden_api', count(*) FROM tasks WHERE api_name = 'api_13'
         UNION ALL SELECT 'nan_path', count(*) FROM tasks WHERE output_path LIKE '%/nan/%' OR metadata_path LIKE '%/nan/%' UNION ALL SELECT 'status_not_accepted', count(*) FROM tasks WHERE status NOT IN ('success', 'empty', 'already_exists')
         UNION ALL SELECT 'rows_without_output', count(*) FROM tasks WHERE rows > 0 AND output_path = '' UNION ALL SELECT 'rows_without_metadata', count(*) FROM tasks WHERE rows > 0 AND metadata_path = ''""")


def _counted(spark: SparkSession, d: str) -> DataFrame:
    lines = src.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("file_rows"))
    return lines.select(F.concat(F.lit("/run/data/"), C("l_orderkey").cast("string"), F.lit(".parquet")).alias("output_path"), "file_rows")


register("l2_row_conservation", lambda s, d: jobs.row_conservation(tasks(s, d), _counted(s, d)),
         f"WITH {TASKS}, n AS (SELECT '/run/data/' || l_orderkey::VARCHAR || '.parquet' AS output_path, count(*) AS file_rows FROM lineitem GROUP BY 1), j AS (SELECT rows, file_rows FROM tasks LEFT JOIN n USING (output_path) WHERE rows > 0) SELECT count(*) AS expected_files, count(file_rows) AS found_files, sum(rows)::BIGINT AS expected_rows, sum(file_rows)::BIGINT AS found_rows, count(*) = count(file_rows) AND sum(rows) = sum(file_rows) AS conserved FROM j")
register("l2_compact_catalog", lambda s, d: jobs.compact_catalog(tasks(s, d)).select("task_id", "source_family", "api_label", "relative_output_path", "relative_metadata_path"),
         f"WITH {TASKS} SELECT task_id, source_family, api_name AS api_label, CASE WHEN output_path = '' THEN '' ELSE output_path[6:] END AS relative_output_path, metadata_path[6:] AS relative_metadata_path FROM tasks")
register("v20_state_rollup", lambda s, d: jobs.state_rollup(tasks(s, d).withColumnRenamed("error_type", "reason"), "status", "source_family"),
         f"WITH {TASKS} SELECT status, source_family, count(*) AS items, sum(rows)::BIGINT AS rows, coalesce(string_agg(DISTINCT error_type, ';' ORDER BY error_type), '') AS reasons FROM tasks GROUP BY 1, 2")


def _files(spark: SparkSession, d: str) -> DataFrame:
    return tasks(spark, d).select(C("output_path").alias("path"), C("source_family").alias("family"), C("api_name").alias("api"), F.year("day").alias("year"), "rows", F.when(C("task_id") % 41 == 0, "s2").otherwise("s1").alias("schema"))


register("l1_compact_buckets", lambda s, d: jobs.compact_buckets(_files(s, d)),
         f"WITH {TASKS} SELECT source_family AS family, api_name AS api, year(day)::INTEGER AS year, count(*) AS files, sum(rows)::BIGINT AS rows, count(DISTINCT task_id % 41 = 0) AS schemas, CASE WHEN count(DISTINCT task_id % 41 = 0) > 1 THEN 'BLOCKED' WHEN count(*) > 1 THEN 'COMPACT' ELSE 'KEEP' END AS status FROM tasks GROUP BY 1, 2, 3")
register("l1_lineage", lambda s, d: jobs.lineage(_files(s, d)), f"WITH {TASKS} SELECT output_path AS path, source_family || '/' || api_name || '/year=' || year(day)::VARCHAR AS bucket, rows FROM tasks")


# contracts: order rows as the rows of contract tables -----------------------------------------------------------------------------------

_FAMILY = {0: "technical_liquidity", 1: "fundamental_quality", 2: "margin_leverage", 3: "market_regime"}


def contract(spark: SparkSession, d: str) -> DataFrame:
    """One row for each task, with the columns of every contract."""
    k = C("task_id")
    some = lambda n, text: F.when(k % n == 0, "").otherwise(text)
    family = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in _FAMILY.items() for x in kv]), (k / 1000).cast("int")), F.concat(F.lit("f"), (k % 5000).cast("string")))
    event = F.when(k == 32, F.lit("stock_lhb_detail_em")).when(k == 33, F.lit("stock_restricted_release_detail_em")).otherwise(C("api_name"))
    return tasks(spark, d).withColumns({
        "key": k.cast("string"), "pit_quality": some(19, "good"), "research_value": some(23, "high"), "adapter_function": some(29, "f"), "module": F.lit("m"), "raw_only": F.when(k % 31 == 0, "yes").otherwise("True"), "computes_factors": F.when(k % 37 == 0, "true").otherwise("false"), "parameterized": F.lit("false"),
        "factor_family": family, "current_status": F.when(k % 3 == 0, "builder_v0_exists").otherwise("prototype_source_only"), "source_families": F.lit("x"), "intended_role": some(41, "alpha"), "notes": F.when(k % 2 == 0, "Safety first").otherwise("PIT"),
        "recommended_next_step": F.lit("x"), "priority": some(43, "1"), "builder_readiness": F.when(k % 47 == 0, "soon").when(k % 4 == 0, "ready_for_builder").otherwise("deferred"), "forbidden_field_risks": F.when(k % 5 == 0, "label").otherwise(""),
        "source_api": event, "event_type": some(53, "e"), "primary_event_date": F.lit("d"), "pit_requirement": F.lit("p"), "post_event_outcome_fields": F.when(k == 32, "上榜后1日,上榜后2日,上榜后5日").when(k % 6 == 0, "y").otherwise(""), "forbidden_usage": F.when(k % 12 == 0, "").otherwise("z"),
        "date_field": some(59, "d"), "symbol_field": F.lit("s"), "industry_code_field": F.lit("i"), "asof_rule": F.lit("r"), "usable_for_historical_backtest": some(61, "yes"),
    })


_FAM = " ".join(f"WHEN {i} THEN '{n}'" for i, n in _FAMILY.items())
CON = f"""con AS (SELECT task_id AS k, task_id::VARCHAR AS key, source_family, api_name, status, CASE WHEN task_id % 3 = 0 THEN 'builder_v0_exists' ELSE 'prototype_source_only' END AS current_status, CASE WHEN task_id % 2 = 0 THEN 'safety first' ELSE 'pit' END AS notes,
  coalesce(CASE task_id // 1000 {_FAM} END, 'f' || (task_id % 5000)::VARCHAR) AS factor_family, CASE WHEN task_id % 47 = 0 THEN 'soon' WHEN task_id % 4 = 0 THEN 'ready_for_builder' ELSE 'deferred' END AS ready FROM tasks)"""


def _viol(name: str, test: str, message: str) -> str:
    return f"SELECT '{name}' AS rule, key, '{message}' AS message FROM con WHERE {test}"


_UNIQ = "SELECT 'factor_family is unique' AS rule, factor_family AS key, 'not unique' AS message FROM con GROUP BY factor_family HAVING count(*) > 1"
_EXIST = lambda values: f"SELECT 'families exist' AS rule, v AS key, 'missing' AS message FROM (SELECT unnest({values}) AS v) WHERE v NOT IN (SELECT factor_family FROM con)"


def _contract(name: str, rules: list[dict], parts: list[str]) -> None:
    register(name, lambda s, d: checks.check_rules(contract(s, d), rules, "key"), f"WITH {TASKS}, {CON} " + " UNION ALL ".join(parts))


_contract("v9_source_inventory", contracts.SOURCE_INVENTORY, [_viol("pit_quality is empty", "k % 19 = 0", "required"), _viol("research_value is empty", "k % 23 = 0", "required"), _viol("status is known", "status NOT IN ('success', 'failed')", "enum")])
_contract("v10_adapter_coverage", contracts.ADAPTER_COVERAGE, [_viol("adapter_function is empty", "k % 29 = 0", "required"), _viol("raw_only is true or false", "k % 31 = 0", "bool_like"), _viol("computes_factors stays false", "k % 37 = 0", "implies")])
_contract("v10_family_taxonomy", contracts.FAMILY_TAXONOMY, [_viol("intended_role is empty", "k % 41 = 0", "required"), _UNIQ, _EXIST(["technical_liquidity", "fundamental_quality"]), _viol("technical_liquidity is built", "factor_family = 'technical_liquidity' AND current_status <> 'builder_v0_exists'", "implies"),
                                                                _viol("fundamental_quality is a prototype", "factor_family = 'fundamental_quality' AND current_status <> 'prototype_source_only' AND notes <> 'pit'", "implies")])
_contract("v11_family_readiness", contracts.FAMILY_READINESS, [_viol("priority is empty", "k % 43 = 0", "required"), _UNIQ, _viol("builder_readiness is known", "ready = 'soon'", "enum"), _EXIST(["technical_liquidity", "fundamental_quality"]), _viol("technical_liquidity is ready", "factor_family = 'technical_liquidity' AND ready <> 'ready_for_builder'", "implies"),
                                                                _viol("fundamental_quality is not ready", "factor_family = 'fundamental_quality' AND ready = 'ready_for_builder'", "implies"), _viol("risks need a safety note", "k % 5 = 0 AND ready = 'ready_for_builder' AND notes <> 'safety first'", "implies")])
_contract("v11_builder_coverage", [r for r in contracts.BUILDER_COVERAGE if r.get("column") not in ("builder_function", "allowed_for_real_data_runner", "computes_signals", "runs_backtest") and "stays false" not in r["name"]], [_UNIQ, _EXIST(contracts.BUILT_FAMILIES)])
_contract("v12_industry_contract", contracts.INDUSTRY_CONTRACT, [_viol("date_field is empty", "k % 59 = 0", "required"), _viol("usable_for_historical_backtest is empty", "k % 61 = 0", "required")])
_contract("v12_event_contract", contracts.EVENT_CONTRACT, [_viol("event_type is empty", "k % 53 = 0", "required"), _viol("outcomes are forbidden", "(k = 32 OR k % 6 = 0) AND k % 12 = 0", "implies"), _viol("stock_lhb_detail_em lists its outcomes", "k = 32", "implies"), _viol("stock_restricted_release_detail_em lists its outcomes", "k = 33", "implies"),
                                                             "SELECT 'events exist' AS rule, v AS key, 'missing' AS message FROM (SELECT unnest(['stock_lhb_detail_em', 'stock_restricted_release_detail_em']) AS v, unnest([32, 33]) AS i) WHERE i NOT IN (SELECT k FROM con)"])


# catalogs over time ----------------------------------------------------------------------------------------------------------------------


def _waves(spark: SparkSession, d: str) -> DataFrame:
    return normalise.health_matrix(tasks(spark, d).select("task_id", "source_family", "api_name", "status", "rows", F.when(C("error_type") == "E1", "Read timed out").when(C("error_type") == "E2", "KeyError: x").otherwise(C("error_type")).alias("error_message")))


_HM = """hm AS (SELECT task_id, source_family, api_name, status, rows, CASE WHEN status = 'success' AND rows > 0 THEN 'ready' WHEN status = 'empty' OR (status = 'success' AND rows = 0) THEN 'empty_check_later' WHEN error_type = 'E1' THEN 'unstable_retry_needed' WHEN error_type = 'E2' THEN 'adapter_defensive_fix_needed' ELSE 'manual_review_needed' END AS health_class FROM tasks)"""
_pick = lambda names: "CASE health_class " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"
_HW = f"hw AS (SELECT *, {_pick({k: v[0] for k, v in normalise.HEALTH.items()})} AS recommended_action, {_pick({k: v[1] for k, v in normalise.HEALTH.items()})} AS backfill_wave, {_pick(normalise.HEALTH_REASON)} AS reason FROM hm)"
register("n21_health_matrix", lambda s, d: _waves(s, d).drop("error_message"), f"WITH {TASKS}, {_HM}, {_HW} SELECT * FROM hw")
register("v13_wave_plan", lambda s, d: normalise.wave_plan(_waves(s, d).groupBy("source_family", "api_name").agg(*[F.max_by(c, "task_id").alias(c) for c in ("status", "rows", "recommended_action", "backfill_wave", "reason")])),
         f"WITH {TASKS}, {_HM}, {_HW}, l AS (SELECT * FROM hw QUALIFY row_number() OVER (PARTITION BY source_family, api_name ORDER BY task_id DESC) = 1) SELECT backfill_wave, source_family, api_name, row_number() OVER (ORDER BY backfill_wave, source_family, api_name, rows DESC)::INTEGER AS priority_rank, status, rows, recommended_action, reason, CASE backfill_wave WHEN 'Wave 1' THEN 'small_historical_wave_first' WHEN 'Wave 2' THEN 'retry_or_broaden_window' ELSE 'fix_before_backfill' END AS suggested_backfill_scope FROM l")
register("n20_parse_task_keys", lambda s, d: src.table(s, d, "orders").select("o_orderkey", normalise.parse_task_key(normalise.task_key("o_custkey", "o_orderpriority"), "o_custkey", "o_orderpriority").alias("k")).select("o_orderkey", "k.*"), "SELECT o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderpriority FROM orders")


def _catalog_part(s: SparkSession, d: str, new: bool) -> DataFrame:
    rows = tasks(s, d).where("day >= date '1998-01-01'" if new else "day < date '1998-01-01'")
    return rows.select(C("symbol").alias("task_key"), "task_id", "status")


register("l6_merge_catalog", lambda s, d: lake.merge_catalog(_catalog_part(s, d, False), _catalog_part(s, d, True), ["task_key"], "task_id"),
         f"""WITH {TASKS}, b AS (SELECT symbol AS task_key, task_id, status, day >= DATE '1998-01-01' AS new, status IN ('success', 'empty') AS landed FROM tasks), f AS (SELECT task_key, coalesce(bool_or(NOT new AND landed) AND bool_or(new AND status = 'already_exists') AND NOT bool_or(new AND landed), false) AS stays FROM b GROUP BY 1)
         SELECT task_key, task_id, status FROM b JOIN f USING (task_key) QUALIFY row_number() OVER (PARTITION BY task_key ORDER BY (stays AND NOT new AND landed) DESC, new DESC, task_id DESC) = 1""")
register("l8_partition_states", lambda s, d: lake.partition_states(tasks(s, d).where("status = 'failed'").select(C("symbol").alias("partition")), tasks(s, d).where("status = 'timeout'").select(C("symbol").alias("partition"))),
         f"WITH {TASKS} SELECT symbol AS partition, CASE WHEN count(DISTINCT status) = 2 THEN 'complete' ELSE 'partial' END AS state FROM tasks WHERE status IN ('failed', 'timeout') GROUP BY 1")


def _bars_until(s: SparkSession, d: str, day: str, shift: float) -> DataFrame:
    return src.daily_panel(s, d).where(C("date") < F.lit(day).cast("date")).select("date", "asset", F.round(C("close") + shift + 1e-7, 4).alias("close"))


register("l11_append_since_last", lambda s, d: lake.append_since_last(_bars_until(s, d, "1998-01-01", 0.0), _bars_until(s, d, "1999-01-01", 1000.0)),
         f"WITH {PANEL}, l AS (SELECT asset, max(date) AS last FROM panel WHERE date < DATE '1998-01-01' GROUP BY 1) SELECT p.date, p.asset, CASE WHEN date < DATE '1998-01-01' THEN round(close + 1e-7, 4) ELSE round(close + 1000 + 1e-7, 4) END AS close FROM panel p LEFT JOIN l USING (asset) WHERE date < DATE '1998-01-01' OR (date < DATE '1999-01-01' AND (last IS NULL OR date > last))")
