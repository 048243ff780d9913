"""Jobs over ingest catalogs and asset manifests: a row for each task, file or plan item, so that every job is a join or a grouping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.expr import require

C = F.col

# States of a task, classes of the checklist, columns of the backlog, review priorities. ---------------------------------
STATUSES = ("success", "empty", "failed", "timeout", "skipped", "already_exists", "pending_adapter")
UNFINISHED = ("failed", "timeout", "pending_adapter", "skipped")
BROKEN = ("failed", "timeout")
CHECKLIST = {"excluded": "排除", "paused": "暂停获取", "acquired": "获取"}
BACKLOG = ("source_family", "api_name", "status", "original_symbol", "akshare_symbol", "params_json", "partition_json", "task_key_json", "error_type", "error_message", "elapsed_sec", "output_path")
CATALOG = ("source_family", "api_name", "status", "rows", "output_path", "metadata_path")
PRIORITIES = ((0.8, "P0"), (0.3, "P1"), (0.0, "P2"))


def filter_cases(table: DataFrame, most: int | None = None, **wanted: str | int | None) -> DataFrame:
    """Rows that have every wanted value (None asks for nothing), in the order of all columns where at most `most` are taken."""
    tests = [C(k) == v for k, v in wanted.items() if v is not None]
    out = table.where(reduce(Column.__and__, tests)) if tests else table
    return out if most is None else out.orderBy(*out.columns).limit(most)


def failure_audit(catalog: DataFrame) -> DataFrame:
    """A row for each api: tasks by state, rates, seconds, and a review priority where tasks failed, timed out or wait for an adapter."""
    n = F.count("*")
    counts = catalog.groupBy("source_family", "api_name").agg(
        n.alias("total_tasks"), *[F.count_if(C("status") == s).alias(f"{s}_tasks") for s in STATUSES],
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("elapsed_sec"), F.lit(0.0)).alias("elapsed_sec"),
    )
    rate = lambda s: (C(f"{s}_tasks") / C("total_tasks")).alias(f"{s}_rate")
    share = C("failed_tasks") / C("total_tasks")
    wanted = (C("failed_tasks") > 0) | (C("timeout_tasks") > 0) | (C("pending_adapter_tasks") > 0)
    by_rate = F.when(share >= PRIORITIES[0][0], "P0").when(share >= PRIORITIES[1][0], "P1").when(share > PRIORITIES[2][0], "P2").otherwise("P3")
    return counts.select("*", rate("success"), rate("failed"), rate("empty"), (C("elapsed_sec") / C("total_tasks")).alias("avg_elapsed_sec"), F.when(wanted, by_rate).alias("review_priority"))


def error_summary(catalog: DataFrame) -> DataFrame:
    """Unfinished tasks by api, state and error."""
    keys = ("source_family", "api_name", "status", "error_type", "error_message")
    rows = catalog.where(C("status").isin(*UNFINISHED)).select(*keys[:3], *[F.coalesce(C(k), F.lit("")).alias(k) for k in keys[3:]])
    return rows.groupBy(*keys).agg(F.count("*").alias("tasks"))


def failure_backlog(catalog: DataFrame) -> DataFrame:
    """Unfinished tasks with the columns of a recovery list; a column that the catalog lacks is blank."""
    return catalog.where(C("status").isin(*UNFINISHED)).select(*[C(c) if c in catalog.columns else F.lit("").alias(c) for c in BACKLOG])


def duplicate_partitions(catalog: DataFrame, keys: tuple[str, ...] = ("task_key_json", "partition_json")) -> DataFrame:
    """Logical partitions that stand more than once; a review passes when there are none."""
    return catalog.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def concurrency_review(observed: DataFrame, *by: str) -> DataFrame:
    """Peak of tasks at once, number of samples, median of the medians and of the 90th percentiles, by source and workload."""
    return observed.groupBy(*by).agg(
        F.max("peak_inflight_tasks").alias("peak_inflight_tasks"), F.sum("latency_sample_count").alias("latency_sample_count"),
        F.median("median_task_elapsed_sec").alias("median_task_elapsed_sec"), F.median("p90_task_elapsed_sec").alias("p90_task_elapsed_sec"),
    )


def acquisition_checklist(policy: DataFrame, catalog: DataFrame, order: str) -> DataFrame:
    """(source_family, api_name, acquisition_status) of every api of the policy (excluded, disabled): excluded ones, then disabled ones and
    those whose last task did not succeed, then the rest."""
    last = catalog.groupBy("source_family", "api_name").agg(F.max_by("status", order).alias("last"))
    got = F.when(C("excluded"), CHECKLIST["excluded"]).when(C("disabled"), CHECKLIST["paused"]).when(F.lower("last") == "success", CHECKLIST["acquired"]).otherwise(CHECKLIST["paused"])
    return policy.join(last, ["source_family", "api_name"], "left").select("source_family", "api_name", got.alias("acquisition_status"))


def unrecovered(catalog: DataFrame, recovery: DataFrame) -> DataFrame:
    """(source_family, api_name) that failed or timed out and were not recovered."""
    keys = [F.coalesce(C(c), F.lit("")).alias(c) for c in ("source_family", "api_name")]
    good = recovery.where((C("status") == "success") | ((C("status") == "already_exists") & (C("rows") > 0)))
    return catalog.where(C("status").isin(*BROKEN)).select(*keys).distinct().join(good.select(*keys).distinct(), ["source_family", "api_name"], "left_anti")


def effective_catalog(catalog: DataFrame, recovery: DataFrame, strict: bool = True) -> DataFrame:
    """The catalog with its broken rows left out and the recovered rows added; strict: an api that nothing recovered raises."""
    if strict and (gone := unrecovered(catalog, recovery).take(5)):
        raise ValueError(f"not recovered: {[tuple(r) for r in gone]}")
    good = recovery.where((C("status") == "success") | ((C("status") == "already_exists") & (C("rows") > 0)))
    good = good.select(*[C(c) if c in recovery.columns else F.lit("").alias(c) for c in catalog.columns])
    return catalog.where(~F.coalesce(C("status").isin(*BROKEN), F.lit(False))).unionByName(good)


def source_gaps(viable: DataFrame, registry: DataFrame, catalog: DataFrame, audited: DataFrame) -> DataFrame:
    """viable sources with what is known of them: in the registry, seen in a catalog, audited, and so missing or planned."""
    out = viable
    for name, known in (("already_in_registry", registry), ("already_seen_in_catalog", catalog), ("already_audited", audited)):
        marks = known.where(C("api_name").isNotNull()).select("api_name").distinct().withColumn(name, F.lit(True))
        out = out.join(marks, "api_name", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    out = out.withColumn("missing_from_registry", ~C("already_in_registry")).withColumn("missing_from_coverage_outputs", ~(C("already_seen_in_catalog") | C("already_audited")))
    return out.withColumn("planned_for_expansion", C("missing_from_registry") & C("missing_from_coverage_outputs"))


def universe_filter(rows: DataFrame, universe: DataFrame, symbol: str = "symbol", by: str = "partition") -> DataFrame:
    """For each partition: rows and symbols before and after the filter by universe, and how many of the universe are missing."""
    known = universe.select(C(symbol).alias(symbol)).where(C(symbol).isNotNull()).distinct()
    size = known.agg(F.count("*").alias("_size"))
    marked = rows.join(known.withColumn("_in", F.lit(True)), symbol, "left")
    inside = F.when(C("_in"), C(symbol))
    counts = marked.groupBy(by).agg(F.count("*").alias("rows_before"), F.count("_in").alias("rows_after"), F.countDistinct(symbol).alias("symbols_before"), F.countDistinct(inside).alias("symbols_after"))
    return counts.join(F.broadcast(size)).select("*", (C("_size") - C("symbols_after")).alias("universe_missing")).drop("_size")


def field_presence(rows: DataFrame, fields: list[str], by: str = "partition") -> DataFrame:
    """(partition, field, present, null_count, dtype) of every wanted or given field."""
    every = sorted({*fields, *rows.columns} - {by})
    kinds = dict(rows.dtypes)
    counts = rows.groupBy(by).agg(*[F.count_if(C(f"`{f}`").isNull()).alias(f) for f in every if f in kinds])
    facts = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(f in kinds).alias("present"), (C(f"`{f}`") if f in kinds else F.lit(None)).cast("long").alias("null_count"), F.lit(kinds.get(f)).alias("dtype")) for f in every])
    return counts.select(by, F.explode(facts).alias("x")).select(by, "x.*")


def _readable(assets: DataFrame) -> DataFrame:
    return assets.where("status = 'ok'") if "status" in assets.columns else assets


def _replaced(assets: DataFrame, plan: DataFrame, keys: list[str]) -> DataFrame:
    """Assets for which the plan has another path under the same keys; each once. The least and greatest path of the keys tell it."""
    targets = plan.groupBy(*keys).agg(F.min("target_path").alias("_lo"), F.max("target_path").alias("_hi"))
    return assets.join(targets, keys).where((C("relative_path") != C("_lo")) | (C("relative_path") != C("_hi"))).select(*assets.columns)


def superseded(assets: DataFrame, plan: DataFrame) -> DataFrame:
    """Assets that a plan row of the same api, version and kind of bucket replaces under another path; each once. Where assets have a
    status, those that are not ok are left out."""
    return _replaced(_readable(assets), plan, ["api_name", "dataset_version", "bucket_kind"])


def active_manifest(assets: DataFrame, plan: DataFrame, merged: DataFrame, version: str | None = None) -> DataFrame:
    """(relative_path, api_name, action): assets that stay, merged ones in place of those at their paths, and stable latest ones from the plan.

    Of the assets only those count that are ok (where they have a status) and of the given dataset version. An asset goes where the plan
    has another path for its api and kind of bucket, of whatever version. A path that is planned wins over one that is merged, and a plan
    without an existing path, null or empty, is a new copy."""
    own = _readable(assets) if version is None else _readable(assets).where(C("dataset_version") == version)
    gone = _replaced(own, plan, ["api_name", "bucket_kind"]).select("relative_path")
    planned = plan.select(C("target_path").alias("relative_path"))
    kept = own.join(gone, "relative_path", "left_anti").join(merged.select("relative_path"), "relative_path", "left_anti")
    kept = kept.join(planned, "relative_path", "left_anti").select("relative_path", "api_name", F.lit("keep").alias("action"))
    fresh = merged.join(planned, "relative_path", "left_anti").select("relative_path", "api_name", F.lit("merge").alias("action"))
    there = F.coalesce(C("existing_path"), F.lit("")) != ""
    latest = plan.select(C("target_path").alias("relative_path"), "api_name", F.when(there, "replace_verified_latest").otherwise("copy_new_latest").alias("action"))
    return kept.unionByName(fresh).unionByName(latest)


def completed_tasks(catalog: DataFrame) -> DataFrame:
    """task_key of the tasks that are done: any row succeeded or was there, and, where a task has first_month and last_month
    (dates), every month between them has such a row."""
    done = catalog.where(C("status").isin("success", "already_exists") & (F.coalesce("task_key", F.lit("")) != ""))
    months = F.collect_set(F.date_trunc("month", "month").cast("date"))
    each = done.groupBy("task_key").agg(months.alias("got"), F.max("first_month").alias("a"), F.max("last_month").alias("b"))
    asked = F.transform(F.sequence(F.date_trunc("month", "a").cast("date"), F.date_trunc("month", "b").cast("date"), F.expr("interval 1 month")), lambda m: m.cast("date"))
    return each.where(C("a").isNull() | C("b").isNull() | (F.size(F.array_except(asked, C("got"))) == 0)).select("task_key")


def merge_batch(landed: DataFrame, batch: DataFrame, key: str = "partition") -> DataFrame:
    """(partition, action) of a batch: added where the partition is not there yet, else left as it is."""
    there = landed.select(key).distinct().withColumn("_old", F.lit(True))
    return batch.select(key).distinct().join(there, key, "left").select(key, F.when(C("_old"), "skipped_existing").otherwise("added").alias("action"))


def backfill_plan(registry: DataFrame, start: str, end: str) -> DataFrame:
    """The registry's sources in the order of the plan (priority, family, dataset, api), with the days to fetch."""
    place = F.row_number().over(Window.orderBy("priority", "source_family", "dataset_name", "api_name"))  # one row a source: a small table
    return registry.select(place.alias("place"), "priority", "source_family", "dataset_name", "api_name", F.lit(start).alias("backfill_start_date"), F.lit(end).alias("backfill_end_date"))


def plan_tasks(plan: DataFrame) -> DataFrame:
    """One planned task for each item of the plan."""
    label = F.concat(F.lit("P"), (C("priority") - 1).cast("string"))
    return plan.select(F.concat_ws("__", "dataset_name", "api_name", label).alias("task_id"), "dataset_name", "source_family", "api_name", label.alias("priority"),
                       F.lit("planned").alias("status"), C("backfill_start_date").alias("planned_start_date"), C("backfill_end_date").alias("planned_end_date"))


def task_summary(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("source_family", "dataset_name", "priority").agg(F.count("*").alias("task_count"))


def plan_differences(plan: DataFrame, reviewed: DataFrame, *signature: str) -> DataFrame:
    """Signatures that only one of two plans has; two plans are equal when there are none."""
    a, b = plan.select(*signature), reviewed.select(*signature)
    return a.exceptAll(b).withColumn("side", F.lit("plan")).unionByName(b.exceptAll(a).withColumn("side", F.lit("reviewed")))


def compact_catalog(catalog: DataFrame) -> DataFrame:
    """The catalog as it goes along with compacted files: labels cleaned, paths made relative to the run."""
    clean = lambda c, other: F.when(F.trim(F.coalesce(C(c), F.lit(""))).isin("", "nan"), other).otherwise(F.trim(c))
    relative = lambda c: F.regexp_replace(F.coalesce(C(c), F.lit("")), "^.*?/(data|metadata)/", "$1/")
    return catalog.withColumns({"source_family": clean("source_family", F.lit("unknown_family")), "api_label": clean("api_name", F.lit("unknown_api")), "relative_output_path": relative("output_path"), "relative_metadata_path": relative("metadata_path")})


def run_validation(catalog: DataFrame, accepted: tuple[str, ...], forbidden: tuple[str, ...] = ()) -> DataFrame:
    """(check_name, failed): counts of what makes a run or a compacted asset invalid, in one pass."""
    require(catalog, *CATALOG)
    text = lambda c: F.lower(F.coalesce(C(c).cast("string"), F.lit("")))
    n = F.coalesce(C("rows").try_cast("long"), F.lit(0))
    checks = {
        "empty_catalog": (F.count("*") == 0).cast("long"), "no_rows": (F.coalesce(F.sum(n), F.lit(0)) <= 0).cast("long"),
        "forbidden_api": F.count_if(C("api_name").isin(*forbidden)) if forbidden else F.lit(0).cast("long"), "nan_path": F.count_if(text("output_path").contains("/nan/") | text("metadata_path").contains("/nan/")),
        "status_not_accepted": F.count_if((text("status") != "") & ~text("status").isin(*accepted)), "rows_without_output": F.count_if((n > 0) & (text("output_path") == "")), "rows_without_metadata": F.count_if((n > 0) & (text("metadata_path") == "")),
    }
    one = catalog.agg(F.array(*[F.struct(F.lit(k).alias("check_name"), v.alias("failed")) for k, v in checks.items()]).alias("x"))
    return one.select(F.explode("x").alias("x")).select("x.*")


def row_conservation(catalog: DataFrame, counted: DataFrame) -> DataFrame:
    """One row: what the catalog says and what the files hold (output_path, file_rows) of non-empty outputs, and whether all rows are there."""
    said = catalog.where("rows > 0").join(counted, "output_path", "left")
    out = said.agg(F.count("*").alias("expected_files"), F.count("file_rows").alias("found_files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("expected_rows"), F.coalesce(F.sum("file_rows"), F.lit(0)).alias("found_rows"))
    return out.withColumn("conserved", (C("expected_files") == C("found_files")) & (C("expected_rows") == C("found_rows")))


def state_rollup(rows: DataFrame, *by: str) -> DataFrame:
    """Items, rows and reasons (distinct, in order) by status, action, bucket and the like."""
    return rows.groupBy(*by).agg(F.count("*").alias("items"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.array_join(F.array_sort(F.collect_set("reason")), ";").alias("reasons"))


def compact_buckets(files: DataFrame) -> DataFrame:
    """The buckets that raw files (path, family, api, year, rows, schema) are compacted into, with a status: blocked where their schemas
    differ. `sinks.compact_raw` writes them."""
    out = files.groupBy("family", "api", "year").agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.countDistinct("schema").alias("schemas"))
    return out.withColumn("status", F.when(C("schemas") > 1, "BLOCKED").when(C("files") > 1, "COMPACT").otherwise("KEEP"))


def lineage(files: DataFrame) -> DataFrame:
    """(path, bucket, rows): where each file's rows are after compaction."""
    return files.select("path", F.concat_ws("/", "family", "api", F.concat(F.lit("year="), C("year").cast("string"))).alias("bucket"), "rows")
