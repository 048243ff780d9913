"""Reports of jobs with fixed columns, and results of a fetch with what is known of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import write_csv

C = F.col

# The columns of each report, in their order. -------------------------------------------------------------------------------
LAYOUTS = {
    "drive_inventory": (
        "drive_dwh_root", "path", "relative_path", "provider", "source_family", "api_name", "dataset_version", "bucket_kind", "bucket_value",
        "partitions", "rows", "columns", "column_count", "sha256", "size_bytes", "date_column", "min_date", "max_date", "snapshot_date",
        "metadata_exists", "metadata_keys", "status", "error_message",
    ),
    "incremental_plan": (
        "provider", "source_family", "api_name", "dataset_version", "plan_kind", "query_mode", "fetch_start_date", "fetch_end_date",
        "target_bucket_kind", "target_bucket_value", "target_relative_path", "existing_relative_path", "existing_max_date", "existing_rows",
        "open_year", "planned_action", "reason",
    ),
    "incremental_merge_report": (
        "provider", "source_family", "api_name", "dataset_version", "target_relative_path", "old_relative_path", "new_relative_path",
        "candidate_relative_path", "status", "merge_action", "primary_key", "old_rows", "new_rows", "candidate_rows", "old_only_rows",
        "new_only_rows", "identical_overlap_rows", "conflict_rows", "duplicate_key_rows", "schema_mismatch", "candidate_written", "reason",
    ),
    "stable_latest_report": (
        "api_name", "bucket", "active_relative_path", "existing_relative_path", "old_coverage", "new_coverage", "action", "superseded_count",
        "status", "reason",
    ),
    "raw_backfill_wave_plan": (
        "backfill_wave", "source_family", "api_name", "dataset_name", "priority_rank", "status", "rows", "recommended_action", "reason",
        "suggested_backfill_scope",
    ),
}


def laid_out(df: DataFrame, layout: str) -> DataFrame:
    """df with exactly the columns of a layout, as texts: those it lacks and nulls are empty, nested values are JSON, others are dropped."""
    kinds = dict(df.dtypes)

    def text(name: str):
        if name not in kinds:
            return F.lit("")
        nested = kinds[name].startswith(("map", "array", "struct"))
        return F.coalesce(F.to_json(C(name)) if nested else C(name).cast("string"), F.lit(""))

    return df.select(*[text(c).alias(c) for c in LAYOUTS[layout]])


def write_report(df: DataFrame, path: str, layout: str, by: tuple[str, ...] = ("status",)) -> None:
    """The report as CSV in its layout, and beside it the summary: a line of JSON with the rows of each status (or other columns `by`)."""
    out = laid_out(df, layout)
    write_csv(out, f"{path}/{layout}")
    counts = out.groupBy(*by).agg(F.count("*").alias("n_rows"))
    counts.write.mode("overwrite").json(f"{path}/{layout}_summary")


def read_report(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """The report as texts; columns other than those of its layout raise."""
    out = spark.read.csv(f"{path}/{layout}", header=True, inferSchema=False, nullValue="\0", emptyValue="")
    if tuple(out.columns) != LAYOUTS[layout] and out.columns:
        raise ValueError(f"{path} has not the columns of {layout}")
    return out


def write_fetch_result(df: DataFrame, path: str, dataset: str, keys: tuple[str, ...] = (), **metadata) -> None:
    """What a fetch gave: CSV under dataset_name=/key=value folders, keys in order of their names, and for each of these folders a line of
    JSON with its rows, the raw columns and the given metadata, under folders of the same names."""
    home = f"{path}/data/dataset_name={dataset}"
    write_csv(df, home, keys)
    known = {"raw_columns": F.array(*[F.lit(c) for c in df.columns])} | {k: F.lit(v) for k, v in sorted(metadata.items())}
    rows = df.groupBy(*sorted(keys)).agg(F.count("*").alias("row_count")).withColumns(known)
    w = rows.write.mode("overwrite")
    (w.partitionBy(*sorted(keys)) if keys else w).json(f"{path}/metadata/dataset_name={dataset}")


def read_fetch_result(spark: SparkSession, path: str, dataset: str) -> tuple[DataFrame, DataFrame]:
    """(rows as texts, metadata) of a dataset, each with its keys."""
    data = spark.read.csv(f"{path}/data/dataset_name={dataset}", header=True, inferSchema=False)
    return data, spark.read.json(f"{path}/metadata/dataset_name={dataset}")

