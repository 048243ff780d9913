"""Sinks: partitioned tables, appends that refuse what exists, manifests. All take a path of a shared file system."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.scratch import scratch
from ..operators.lake import keep_last
from .footers import file_system, footer_inventory

C = F.col


def write_by_date(df: DataFrame, path: str, date: str = "trade_date", order: str | None = None) -> None:
    """One folder a day; only the days that df has are replaced. The rows of a day meet in one task, or in several if they are too many
    for one: adaptive execution splits what the rebalance hint allows it to."""
    out = df.hint("rebalance", date)
    out = out if order is None else out.sortWithinPartitions(date, order)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)


def write_by_month(df: DataFrame, path: str, date: str = "date", asset: str = "asset") -> DataFrame:
    """One folder a month, and the manifest: year, month, rows, n_dates, n_assets."""
    out = df.withColumns({"year": F.year(date), "month": F.month(date)})
    out.hint("rebalance", "year", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)
    return month_manifest(df, date, asset)


def month_manifest(df: DataFrame, date: str = "date", asset: str = "asset") -> DataFrame:
    return df.groupBy(F.year(date).alias("year"), F.month(date).alias("month")).agg(F.count("*").alias("rows"), F.countDistinct(date).alias("n_dates"), F.countDistinct(asset).alias("n_assets"))


def _holds_anything(path: str) -> bool:
    from pyarrow import fs

    system, place = file_system(path)
    return bool(system.get_file_info(fs.FileSelector(place, allow_not_found=True)))


def append_new_partitions(df: DataFrame, path: str, keys: list[str], overwrite: bool = False) -> DataFrame:
    """Writes the partitions that are not there yet. Returns the catalog: keys, rows, status success or already_exists."""
    spark = df.sparkSession
    there = _holds_anything(path)
    counts = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    if not there or overwrite:
        catalog = counts.withColumn("status", F.lit("success"))
        fresh = df
    else:
        kinds = dict(df.dtypes)
        old = spark.read.parquet(path).select(*[C(k).cast(kinds[k]).alias(k) for k in keys]).distinct().withColumn("_old", F.lit(True))
        catalog = counts.join(old, keys, "left").withColumn("status", F.when(C("_old"), "already_exists").otherwise("success")).drop("_old")
        fresh = df.join(old, keys, "left_anti")
    at = scratch(spark, "catalog")
    catalog.write.parquet(at)  # fixed before the write changes what is there
    mode = "overwrite" if overwrite else "append"
    fresh.hint("rebalance", *keys).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    return spark.read.parquet(at)


def write_csv(df: DataFrame, path: str, keys: tuple[str, ...] = ()) -> None:
    """CSV under key=value folders, keys in order of their names."""
    w = df.write.mode("overwrite").option("header", True)
    (w.partitionBy(*sorted(keys)) if keys else w).csv(path)


def write_snapshots(df: DataFrame, path: str, keys: tuple[str, ...] = ("index_name", "snapshot_date", "asset")) -> None:
    """Membership snapshots, one row a key, one folder an index and year."""
    out = df.dropDuplicates(list(keys)).withColumn("year", F.year("snapshot_date"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("index_name", "year").parquet(path)


def read_table(spark, path: str) -> DataFrame:
    """The last version of a versioned table."""
    every = spark.read.parquet(path)
    last = every.agg(F.max("version")).first()[0]
    return every.where(C("version") == F.lit(last)).drop("version")


def write_table(df: DataFrame, path: str, version: int = 1) -> None:
    """A version of a table: readers see it once it is written whole, and the one before until then."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def upsert_table(df: DataFrame, path: str, keys: list[str]) -> None:
    """Keyed upsert into the versioned table at path: the new row wins, and the result is the next version."""
    spark = df.sparkSession
    last = spark.read.parquet(path).agg(F.max("version")).first()[0]
    both = read_table(spark, path).withColumn("_turn", F.lit(0)).unionByName(df.withColumn("_turn", F.lit(1)))
    write_table(keep_last(both, keys, C("_turn")).drop("_turn"), path, last + 1)


def compact_raw(spark, raw: str, out: str, keys: tuple[str, ...]) -> DataFrame:
    """The files under raw, with key=value folders, as one table with few files for each of the keys. Returns (path, rows) of what was
    read; a row count that differs from what was written raises."""
    rows = spark.read.option("mergeSchema", True).parquet(raw).withColumn("_path", F.input_file_name())
    rows.drop("_path").hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).parquet(out)
    traced = rows.groupBy(C("_path").alias("path")).agg(F.count("*").alias("rows"))
    if (a := rows.count()) != (b := spark.read.parquet(out).count()):
        raise ValueError(f"{a} rows were read and {b} written")
    return traced


def append_log(df: DataFrame, path: str) -> None:
    """Rows of runs, metadata or quality, appended with the time of writing."""
    df.withColumn("written_at", F.current_timestamp()).write.mode("append").parquet(path)


def write_outputs(frames: dict[str, DataFrame], path: str) -> None:
    """Named result tables as CSV, one folder each."""
    for name, df in frames.items():
        write_csv(df, f"{path}/{name}")


def write_manifest(spark, path: str, **fields) -> None:
    """One row of JSON about a run."""
    spark.createDataFrame([{k: str(v) for k, v in fields.items()}]).coalesce(1).write.mode("overwrite").json(path)


#: Fixed names of a run manifest's fields; those that are not given are null.
MANIFEST_FIELDS = ("run_id", "created_at", "code_commit", "feature_root", "data_range", "universe", "signal_recipe", "portfolio_rule", "rebalance_rule", "execution_assumption", "cost_model", "benchmark", "diagnostics_requested", "known_limitations", "warnings")


def write_run_manifest(spark, path: str, **fields) -> None:
    """One row of JSON with all of MANIFEST_FIELDS, and others that are given."""
    row = {f: None for f in MANIFEST_FIELDS} | {k: None if v is None else str(v) for k, v in fields.items()}
    schema = ", ".join(f"`{k}` string" for k in row)
    spark.createDataFrame([tuple(row.values())], schema).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_warnings(spark, path: str, warnings: list[str]) -> None:
    """A text of a run's warnings, one in a line."""
    lines = ["# Run Warnings", "", *([f"- {w}" for w in warnings] or ["No warnings recorded."])]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_factors(factors: DataFrame, summary: DataFrame, path: str, name: str, **meta) -> None:
    """A family's factors by date, their summary as CSV and what is known of them as JSON, under one folder of its name."""
    write_by_date(factors.withColumnRenamed("date", "trade_date"), f"{path}/{name}/factors")
    write_csv(summary, f"{path}/{name}/summary")
    write_manifest(factors.sparkSession, f"{path}/{name}/metadata", name=name, columns=",".join(factors.columns), **meta)


def write_raw_partition(df: DataFrame, path: str, keys: list[str], log: str, overwrite: bool = False, **meta) -> DataFrame:
    """append_new_partitions, whose catalog is also appended to the table of metadata."""
    catalog = append_new_partitions(df, path, keys, overwrite)
    append_log(catalog.withColumns({k: F.lit(str(v)) for k, v in meta.items()}), log)
    return catalog


def _moved(staging: str, path: str):
    """Staged folders take their place, unless one is there. A task that runs again finds its folder moved, which is a success too."""

    def run(batches):
        from pyarrow import fs

        system, source = file_system(staging)
        target = file_system(path)[1]
        there = lambda at: system.get_file_info(at).type != fs.FileType.NotFound
        for batch in batches:
            status = []
            for folder in batch.column("folder").to_pylist():
                a, b = f"{source}/{folder}", f"{target}/{folder}"
                if not there(a):
                    status.append("success" if there(b) else "failed")
                    continue
                system.create_dir(b.rsplit("/", 1)[0], recursive=True)
                try:
                    if there(b):
                        raise FileExistsError(b)
                    system.move(a, b)
                    status.append("success")
                except OSError:  # another writer was first
                    status.append("already_exists" if there(b) else "failed")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(status, pa.string())], [*batch.schema.names, "status"])

    return run


def append_new_folders(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Writes each partition of df that is not there yet, whole or not at all. Returns the catalog: keys (texts), folder, rows, status (success,
    already_exists or failed).

    Partitions are staged beside the table and renamed into their places by tasks; of two writers of one partition the first to rename it
    wins, and the other's rows stay out. Rows are told by the footers of what was written. Nothing comes to the driver but the catalog's
    path. Renames must be atomic, as on local and distributed file systems, not object stores.
    """
    spark, staging = df.sparkSession, f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    df.hint("rebalance", *keys).write.partitionBy(*keys).parquet(staging)
    inv = footer_inventory(spark, staging, (), digests=False)
    folder = F.expr("left(path, length(path) - length(substring_index(path, '/', -1)) - 1)")
    folders = inv.groupBy(folder.alias("folder"), *[C("partition")[k].alias(k) for k in keys]).agg(F.sum("rows").alias("rows"))
    folders = folders.select(*keys, "folder", "rows")
    schema = ", ".join(f"`{k}` string" for k in keys) + ", folder string, rows long, status string"
    at = scratch(spark, "catalog")
    folders.repartition(spark.sparkContext.defaultParallelism, "folder").mapInArrow(_moved(staging, path), schema).write.parquet(at)
    system, place = file_system(staging)
    system.delete_dir(place)
    return spark.read.parquet(at)


def write_symbol_months(df: DataFrame, path: str, date: str = "date", symbol: str = "symbol", adjust: str = "none") -> DataFrame:
    """Bars under symbol=/adjust=/year=/month= folders; those that are there stay. Returns the catalog of the folders."""
    out = df.withColumnRenamed(symbol, "symbol").withColumns({"adjust": F.lit(adjust), "year": F.year(date), "month": F.month(date)})
    return append_new_folders(out, path, ["symbol", "adjust", "year", "month"])


def save_by_asset(df: DataFrame, path: str, table: str, buckets: int, asset: str = "asset", date: str = "date") -> DataFrame:
    """df as a table bucketed by asset and sorted by asset and date, one file a bucket. What is read from it needs no shuffle for windows over
    an asset's rows, for joins by asset with another table of as many buckets, or for groups by asset."""
    out = df.repartition(buckets, asset).sortWithinPartitions(asset, date)
    out.write.mode("overwrite").bucketBy(buckets, asset).sortBy(asset, date).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Forgets a saved table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
