"""Compaction of a raw lake: many small files of a source become one bucket each, with lineage, and checked by reading the result again."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.scratch import scratch
from .footers import file_system, footer_inventory

C = F.col
#: Files of an inventory up to this count are broadcast to their rows.
MOST_FILES = 1 << 18
LEVELS = ("source_family", "api_name")
_BUCKET = [*LEVELS, "bucket_kind", "bucket_value"]


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _bare(location: Column) -> Column:
    """A location without the scheme and the slashes after it, which are written in several ways."""
    return F.regexp_replace(location, "^[a-z0-9]+:/*", "")


def _first(df: DataFrame, what: str) -> None:
    if row := df.first():
        raise ValueError(what + ": " + "/".join(str(row[c]) for c in df.columns if row[c] is not None))


def compact_raw(spark: SparkSession, raw: str, package: str, start: str, end: str, replace: bool = False) -> tuple[DataFrame, DataFrame]:
    """Compacts the files below raw/source_family/api_name/key=value/... into package/data, one folder for each family, api and bucket (see
    `lake.partition_bucket`; start and end name the scope of files without a day). Returns (lineage, qa), which are also written
    to package/lineage and package/qa.

    Rows and columns stay as they are: nothing is made distinct, normalised or dropped. Files of one bucket must have the same columns and
    types in the same order, or it raises, as it does for an unreadable file, for a raw root without files, and for a package that is there
    already unless `replace`. Each different schema is read once. The result is read again: a bucket whose rows or columns differ
    from what its files' footers told raises. All is written to a folder of its own, which takes the package's name at the end.
    """
    from pyarrow import fs

    system, place = file_system(package)
    there = system.get_file_info(place).type != fs.FileType.NotFound
    if there and not replace:
        raise FileExistsError(f"the package is there already: {package}")
    inv = _saved(footer_inventory(spark, raw, LEVELS, start=start, end=end), "inventory")
    if inv.isEmpty():
        raise FileNotFoundError(f"no Parquet files below {raw}")
    _first(inv.where("status <> 'ok'").select("path", "error_message"), "unreadable file")
    different = inv.groupBy(*_BUCKET).agg(F.countDistinct("fingerprint").alias("n")).where("n > 1").drop("n")
    _first(different, "column mismatch within a bucket")
    few = inv.count() <= MOST_FILES
    staging = f"{package.rstrip('/')}.staging-{uuid.uuid4().hex}"
    names = {b: f"_{b}" for b in _BUCKET}
    for r in inv.groupBy("fingerprint").agg(F.collect_list("location").alias("paths")).toLocalIterator():  # paths, by which the driver plans the read
        rows = spark.read.parquet(*r["paths"])
        mine = inv.where(C("fingerprint") == r["fingerprint"]).select(_bare(C("location")).alias("_uri"), *[C(b).alias(n) for b, n in names.items()])
        rows = rows.withColumn("_uri", _bare(F.url_decode(F.replace(C("_metadata.file_path"), F.lit("+"), F.lit("%2B")))))
        rows = rows.join(F.broadcast(mine) if few else mine, "_uri").drop("_uri").hint("rebalance", *names.values())
        rows.write.mode("append").partitionBy(*names.values()).parquet(f"{staging}/data")

    folder = F.concat_ws("/", F.lit("data"), *[F.concat(F.lit(f"{n}="), C(b)) for b, n in names.items()])
    lineage = inv.select(
        folder.alias("compact_relative_path"), C("path").alias("source_relative_path"), C("digest").alias("source_sha256"), C("rows").alias("source_rows"),
        F.to_json("columns").alias("source_columns"), "bucket_kind", "bucket_value",
    )
    made = footer_inventory(spark, f"{staging}/data", ())
    p = C("partition")
    made = made.groupBy(*[p[n].alias(b) for b, n in names.items()]).agg(
        F.sum("rows").alias("actual_rows"), F.max("column_count").alias("actual_columns"), F.count("*").alias("files"),
        F.first("columns").alias("_columns"), F.count_distinct("columns").alias("_kinds"),
        F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("digest"))), 256).alias("sha256"),
    )
    told = inv.groupBy(*_BUCKET).agg(F.sum("rows").alias("expected_rows"), F.max("column_count").alias("expected_columns"), F.first("columns").alias("_expected"))
    ok = (C("expected_rows") == F.coalesce("actual_rows", F.lit(0))) & (C("_kinds").isNull() | ((C("_columns") == C("_expected")) & (C("_kinds") == 1)))
    ok = ok & (C("_kinds").isNotNull() | (C("expected_rows") == 0))  # a bucket without rows has no file
    qa = told.join(made, _BUCKET, "left").select(
        folder.alias("relative_path"), *_BUCKET, "expected_rows", F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"), "expected_columns",
        F.coalesce("actual_columns", F.lit(0)).alias("actual_columns"), F.coalesce("files", F.lit(0)).alias("files"), "sha256", ok.alias("ok"),
    )
    lineage.write.parquet(f"{staging}/lineage")
    qa.write.parquet(f"{staging}/qa")
    _first(spark.read.parquet(f"{staging}/qa").where("not ok").select("relative_path", "expected_rows", "actual_rows"), "compaction check failed")
    if there:
        system.delete_dir(place)
    system.move(file_system(staging)[1], place)
    return spark.read.parquet(f"{package}/lineage"), spark.read.parquet(f"{package}/qa")
