"""Table maintenance: keyed merge with conflict detection, catalogs, compaction buckets, gaps and manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import merge

C = F.col


def merge_report(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """One row: old_only, new_only, identical, conflict (keys), duplicate_keys (rows of repeated keys on either side), schema_equal, status.
    NULL equals NULL. A key column that either side lacks is BLOCKED, with no counts. `merge.merge_report` tells the same by bucket."""
    if any(k not in old.columns or k not in new.columns for k in keys):
        counts = old.limit(0).agg(*[F.count("*").alias(c) for c in ("old_only", "new_only", "identical", "conflict", "duplicate_keys")])
        return counts.withColumns({"schema_equal": F.lit(False), "status": F.lit("BLOCKED")})
    both = merge.compared(old, new, keys, [])
    one = (C("n_old") > 0) & (C("n_new") > 0)
    again = lambda c: F.coalesce(F.sum(F.when(C(c) > 1, C(c)).otherwise(0)), F.lit(0))
    out = both.agg(
        F.count_if(C("n_new") == 0).alias("old_only"), F.count_if(C("n_old") == 0).alias("new_only"), F.count_if(one & C("same")).alias("identical"),
        F.count_if(one & ~C("same")).alias("conflict"), (again("n_old") + again("n_new")).alias("duplicate_keys"),
    )
    out = out.withColumn("schema_equal", F.lit(set(old.columns) == set(new.columns)))
    return out.withColumn("status", F.when(C("schema_equal") & (C("conflict") == 0) & (C("duplicate_keys") == 0), "READY").otherwise("BLOCKED"))


def keyed_merge(old: DataFrame, new: DataFrame, keys: list[str], checked: bool = False) -> DataFrame:
    """Old rows and the new rows whose key is new; checked: raises what merge_report does not call READY."""
    if checked and (told := merge_report(old, new, keys).first())["status"] != "READY":
        raise ValueError(f"merge is blocked: {told.asDict()}")
    on = reduce(lambda x, y: x & y, [new[k].eqNullSafe(old[k]) for k in keys])
    return old.unionByName(new.join(old.select(*keys), on, "left_anti"))


def keep_last(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """One row for each key: the last in the given order."""
    w = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order])
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    on = reduce(lambda x, y: x & y, [old[k].eqNullSafe(new[k]) for k in keys])
    return old.join(new.select(*keys), on, "left_anti").unionByName(new)


def append_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return new.join(old.select(*keys).distinct(), keys, "left_anti")


def coverage_gaps(expected: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    return expected.join(landed.select(*keys).distinct(), keys, "left_anti")


def collision_plan(source: DataFrame, target: DataFrame) -> DataFrame:
    """(path, action): copy_new, skip_identical or block_non_identical, by digest."""
    t = target.select("path", C("digest").alias("_d"))
    return source.join(t, "path", "left").select("path", F.when(C("_d").isNull(), "copy_new").when(C("_d") == C("digest"), "skip_identical").otherwise("block_non_identical").alias("action"))


# Partition keys that hold a day, in the order in which they are looked for. ---------------------------------------------
LANDED_DAYS = ("trade_date", "ann_date", "end_date", "report_date", "date")
DAY_KEYS = ("trade_date", "suspend_date", "cal_date", "ann_date", "report_date", "date")


def partition_bucket(parts: str = "partition", start: str = "", end: str = ""):
    """'kind=value' of a partition map: a snapshot, a year, the year of the first of DAY_KEYS, start and end of one year, else their window,
    a since_date, else the scope of the run from start to end (all, without a run). Empty values are as good as none. A day without a year, and a
    since_date other than yyyymmdd, raise."""
    m = C(parts)
    has = lambda k: F.coalesce(m[k] != "", F.lit(False))
    digits = lambda k: F.regexp_replace(m[k], "[^0-9]", "")
    fails = lambda k, what: F.raise_error(F.concat(F.lit(f"partition {k} {what}: "), m[k]))
    year = lambda k: F.when(F.length(digits(k)) >= 4, F.substring(digits(k), 1, 4)).otherwise(fails(k, "does not contain a year"))
    named = lambda kind, value: F.concat(F.lit(f"{kind}="), value)
    out = F.when(has("snapshot"), named("snapshot", m["snapshot"])).when(has("year"), named("year", F.substring(digits("year"), 1, 4)))
    for k in DAY_KEYS:
        out = out.when(has(k), named("year", year(k)))
    window = F.when(year("start_date") == year("end_date"), named("year", year("start_date")))
    out = out.when(has("start_date") & has("end_date"), window.otherwise(named("window", F.concat(digits("start_date"), F.lit("_"), digits("end_date")))))
    since = F.when(F.length(digits("since_date")) == 8, digits("since_date")).otherwise(fails("since_date", "must be YYYYMMDD"))
    return out.when(has("since_date"), named("since", since)).otherwise(F.lit(f"scope=run_{start}_{end}" if start or end else "scope=all"))


def landed_bucket(parts: str = "partition"):
    """'kind=value' of a partition map of a compacted store: what it names itself, else its window, else the year of its day, else unknown."""
    m = C(parts)
    has = lambda k: F.coalesce(m[k] != "", F.lit(False))
    own = [F.when(has(k), F.concat(F.lit(f"{k}="), m[k])) for k in ("year", "window", "snapshot", "scope", "since")]
    window = F.when(has("start_date") & has("end_date"), F.concat(F.lit("window="), m["start_date"], F.lit("_"), m["end_date"]))
    digits = lambda k: F.regexp_replace(m[k], "[^0-9]", "")
    days = [F.when(F.length(digits(k)) >= 4, F.concat(F.lit("year="), F.substring(digits(k), 1, 4))) for k in LANDED_DAYS]
    return F.coalesce(*own, window, *days, F.lit("unknown=unknown"))


def merge_catalog(prior: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key: the last by order, new ones after prior ones; but a prior row that landed (success, empty) stays where
    all that is new is that it already exists."""
    both = prior.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    landed = C("status").isin("success", "empty")
    key = Window.partitionBy(*keys)
    stays = F.max(~C("_new") & landed).over(key) & F.max(C("_new") & (C("status") == "already_exists")).over(key) & ~F.max(C("_new") & landed).over(key)
    first = F.when(F.coalesce(stays, F.lit(False)), ~C("_new") & landed).otherwise(F.lit(False))
    place = F.row_number().over(key.orderBy(C("_first").desc(), C("_new").desc(), C(order).desc()))
    return both.withColumn("_first", first).withColumn("_place", place).where("_place = 1").select(*prior.columns)


def partition_states(data: DataFrame, metadata: DataFrame, key: str = "partition") -> DataFrame:
    """(partition, state): complete with data and metadata, partial with one of them; what is in neither is absent."""
    a, b = data.select(key).distinct().withColumn("_a", F.lit(True)), metadata.select(key).distinct().withColumn("_b", F.lit(True))
    return a.join(b, key, "full_outer").select(key, F.when(C("_a") & C("_b"), "complete").otherwise("partial").alias("state"))


def append_since_last(old: DataFrame, new: DataFrame, asset: str = "asset", date: str = "date") -> DataFrame:
    """The old rows and the new rows of days after an asset's last one; a key stands once, with the new row."""
    last = old.groupBy(asset).agg(F.max(date).alias("_last"))
    fresh = new.join(last, asset, "left").where(C("_last").isNull() | (C(date) > C("_last"))).select(*old.columns)
    return upsert(old, fresh, [asset, date])
