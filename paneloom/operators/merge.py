"""Verified merges of new rows into a bucketed table, of which only the touched buckets are rewritten."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.scratch import scratch

C = F.col
#: Buckets up to this count are broadcast.
MOST_BUCKETS = 1 << 17

# Reasons of a merge report. ------------------------------------------------------------------------------------------------
KEYS_MISSING = "primary key columns missing: "
DUPLICATES = "duplicate primary-key rows found in candidate inputs"
SCHEMAS = "old and new parquet schemas differ"
CONFLICTS = "non-identical rows share the same primary key"
MERGED = "candidate bucket written locally after verified merge"

_COUNTS = ("candidate_rows", "old_only_rows", "new_only_rows", "identical_overlap_rows", "conflict_rows", "duplicate_key_rows")


def compared(old: DataFrame, new: DataFrame, keys: list[str], bucket: list[str]) -> DataFrame:
    """One row for each key of a bucket: how often either side has it, the row of each side, and whether these are equal. Nulls are equal
    to nulls, in keys too. The rows of old decide the columns; one that new lacks is null there. One shuffle, of both sides by key."""
    values = [c for c in old.columns if c not in keys and c not in bucket]
    row = lambda df: F.struct(F.lit(1).alias("_"), *[(C(f"`{c}`") if c in df.columns else F.lit(None)).cast(old.schema[c].dataType).alias(c) for c in values])
    side = lambda df, i: df.select(*bucket, *keys, F.lit(i).alias("_side"), row(df).alias("_row"))
    of = lambda i: F.when(C("_side") == i, C("_row"))
    both = side(old, 0).unionByName(side(new, 1)).groupBy(*bucket, *keys)
    both = both.agg(
        F.count_if(C("_side") == 0).alias("n_old"), F.count_if(C("_side") == 1).alias("n_new"),
        F.first(of(0), ignorenulls=True).alias("old"), F.first(of(1), ignorenulls=True).alias("new"),
    )
    return both.withColumn("same", C("old").eqNullSafe(C("new")))


def _blocked(old: DataFrame, new: DataFrame, bucket: list[str], reason: str) -> DataFrame:
    sides = old.select(*bucket, F.lit(0).alias("_side")).unionByName(new.select(*bucket, F.lit(1).alias("_side")))
    out = sides.groupBy(*bucket).agg(F.count_if(C("_side") == 0).alias("old_rows"), F.count_if(C("_side") == 1).alias("new_rows"))
    return out.select(
        *bucket, F.lit("BLOCKED").alias("status"), "old_rows", "new_rows", *[F.lit(0).cast("long").alias(c) for c in _COUNTS],
        F.lit(True).alias("schema_mismatch"), F.lit(reason).alias("reason"),
    )


def bucket_report(both: DataFrame, bucket: list[str], same_columns: bool = True) -> DataFrame:
    """One row for each bucket of `compared`: status PASS or BLOCKED, its counts and the reason. Repeated keys block first, then columns
    that differ, then rows that differ under one key; counts that come after a blocking one are zero."""
    one = (C("n_old") > 0) & (C("n_new") > 0)
    again = lambda c: F.sum(F.when(C(c) > 1, C(c)).otherwise(0))
    out = both.groupBy(*bucket).agg(
        F.sum("n_old").alias("old_rows"), F.sum("n_new").alias("new_rows"), (again("n_old") + again("n_new")).alias("duplicate_key_rows"),
        F.count_if(C("n_new") == 0).alias("_old_only"), F.count_if(C("n_old") == 0).alias("_new_only"),
        F.count_if(one & C("same")).alias("_identical"), F.count_if(one & ~C("same")).alias("_conflict"),
    )
    repeated, apart = C("duplicate_key_rows") > 0, F.lit(not same_columns) & (C("old_rows") > 0)
    told = lambda c: F.when(repeated | apart, 0).otherwise(C(c)).cast("long")
    clash = ~repeated & ~apart & (C("_conflict") > 0)
    good = ~repeated & ~apart & ~clash
    return out.select(
        *bucket, F.when(good, "PASS").otherwise("BLOCKED").alias("status"), "old_rows", "new_rows",
        F.when(good, C("old_rows") + C("_new_only")).otherwise(0).cast("long").alias("candidate_rows"),
        told("_old_only").alias("old_only_rows"), told("_new_only").alias("new_only_rows"), told("_identical").alias("identical_overlap_rows"),
        told("_conflict").alias("conflict_rows"), "duplicate_key_rows", (~repeated & apart).alias("schema_mismatch"),
        F.when(repeated, DUPLICATES).when(apart, SCHEMAS).when(clash, CONFLICTS).otherwise(MERGED).alias("reason"),
    )


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MOST_BUCKETS else df


def merge_report(old: DataFrame, new: DataFrame, keys: list[str], bucket: list[str]) -> DataFrame:
    """bucket_report of two tables; only the buckets that new has are looked at, and a missing key column blocks all of them."""
    old = old.join(_small(new.select(*bucket).distinct()), bucket, "left_semi")
    if gone := sorted({k for k in keys if k not in new.columns or k not in old.columns}):
        return _blocked(old, new, bucket, KEYS_MISSING + ", ".join(gone))
    return bucket_report(compared(old, new, keys, bucket), bucket, set(old.columns) == set(new.columns))


def merge_into(spark: SparkSession, path: str, new: DataFrame, keys: list[str], bucket: list[str]) -> tuple[DataFrame, DataFrame]:
    """Merges new into the table at path, which has one folder for each bucket. Returns the report, and the conflicts (bucket, keys, old, new).

    Buckets that new does not have are not read, by partition pruning. Those that pass and gain rows are rewritten whole and put in place of
    their folders when the job commits; all others keep their files. Blocked buckets stay as they are. The rows to be written are saved
    before, so nothing is read from a folder that goes.
    """
    old = spark.read.parquet(path)
    new = new.withColumns({b: C(b).cast(old.schema[b].dataType) for b in bucket})
    if any(k not in new.columns or k not in old.columns for k in keys):
        return merge_report(old, new, keys, bucket), new.limit(0)
    near = old.join(_small(new.select(*bucket).distinct()), bucket, "left_semi")
    at = scratch(spark, "compared")
    compared(near, new, keys, bucket).write.parquet(at)
    both = spark.read.parquet(at)
    report_at = scratch(spark, "report")
    bucket_report(both, bucket, set(old.columns) == set(new.columns)).write.parquet(report_at)
    report = spark.read.parquet(report_at)
    grown = report.where("status = 'PASS' and new_only_rows > 0").select(*bucket)
    kept = F.coalesce("old", "new")
    rows = both.join(_small(grown), bucket, "left_semi").withColumn("_row", kept)
    values = [c for c in old.columns if c not in keys and c not in bucket]
    rows = rows.select(*[C(c) if c in keys or c in bucket else C("_row").getField(c).alias(c) for c in [*keys, *values, *bucket]])
    rows = rows.hint("rebalance", *bucket)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*bucket).parquet(path)
    bad = report.where("conflict_rows > 0").select(*bucket)
    conflicts = both.join(_small(bad), bucket, "left_semi").where("n_old > 0 and n_new > 0 and not same").select(*bucket, *keys, "old", "new")
    return report, conflicts

