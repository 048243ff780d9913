"""What to fetch next: arithmetic on open days, and the plan of fetch windows from an inventory of what has landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

C = F.col


def weekdays_back(day: Column, k: Column | int) -> Column:
    """The k-th day from Monday to Friday before `day`; the day itself for k = 0."""
    k = F.lit(k) if isinstance(k, int) else k
    here = F.weekday(day)
    start = F.when(here > 4, F.date_add(day, 7 - here)).otherwise(day)  # from a weekend, as from the Monday after it
    at = F.when(here > 4, 0).otherwise(here)
    back = k + 2 * F.ceil(F.greatest(k - at, F.lit(0)) / 5).cast("int")
    return F.when(k <= 0, day).otherwise(F.date_sub(start, back.cast("int")))


def open_day_index(calendar: DataFrame, day: str = "day", is_open: str = "is_open") -> DataFrame:
    """(day, before, place): of every date from the first to the last of the calendar, the number of open days before it, and its own
    number if it is open. Dates that the calendar leaves out are closed; days that stand twice count once. A row for each day of the
    calendar, some thousands whatever the data."""
    days = calendar.groupBy(C(day).cast("date").alias("day")).agg(F.max(C(is_open).cast("boolean")).alias("open"))
    span = days.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a is not null")
    every = span.select(F.explode(F.sequence("a", F.date_add("b", 1))).alias("day"))
    opened = F.coalesce(C("open"), F.lit(False)).cast("long")
    before = F.sum(opened).over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1))
    out = every.join(days, "day", "left").withColumn("before", F.coalesce(before, F.lit(0)))
    return out.select("day", "before", F.when(C("open"), C("before") + 1).alias("place"))


def open_days_back(df: DataFrame, day: str, k: Column, calendar: DataFrame, out: str = "open_day") -> DataFrame:
    """df with the k-th open day before each row's day; the day itself for k = 0, the first open day where there are fewer than k, and
    null for a day beyond the calendar."""
    index = open_day_index(calendar)
    asked = df.withColumn("_k", k).join(F.broadcast(index.select(C("day").alias("_cal_day"), "before")), C(day) == C("_cal_day"), "left")
    asked = asked.withColumn("_place", F.greatest(C("before") - C("_k") + 1, F.lit(1)))
    places = index.where("place is not null").select(C("place").alias("_place"), C("day").alias("_to"))
    found = asked.join(F.broadcast(places), "_place", "left")
    return found.withColumn(out, F.when(C("_k") <= 0, C(day)).when(C("before") > 0, C("_to"))).drop("_k", "_cal_day", "before", "_place", "_to")


def incremental_window(inventory: DataFrame, overlap_days: int = 7) -> DataFrame:
    """(api, max_date, fetch_from): the last date less the overlap in days from Monday to Friday, not before the start of its year."""
    last = inventory.groupBy("api").agg(F.max("date").alias("max_date"))
    return last.withColumn("fetch_from", F.greatest(weekdays_back(C("max_date"), overlap_days), F.trunc("max_date", "year")))


# Kinds, actions and reasons of an incremental plan. ------------------------------------------------------------------------
KINDS = {"trade_date": "by_trade_date_open_year", "range": "stable_latest_range", "snapshot": "stable_latest_snapshot"}
COPY_YEAR, REPLACE_YEAR = "copy_new_open_year", "replace_verified_incremental_candidate"
COPY_LATEST, REPLACE_LATEST = "copy_new_latest", "replace_verified_latest_candidate"
NO_BUCKET = "no current open-year Drive bucket"
NO_DATES = "current open-year bucket has no date range metadata"
OVERLAP = "current open-year bucket found; overlap applied"

PLAN = (
    "provider", "source_family", "api_name", "dataset_version", "plan_kind", "query_mode", "fetch_start_date", "fetch_end_date", "target_bucket_kind",
    "target_bucket_value", "target_relative_path", "existing_relative_path", "existing_max_date", "existing_rows", "open_year", "planned_action", "reason",
)


def target_end(latest_open_day: Column, lag: int) -> Column:
    """The last day that is to be fetched: the latest open day less a lag in days from Monday to Friday."""
    return weekdays_back(latest_open_day, lag)


def incremental_plan(
    apis: DataFrame, inventory: DataFrame, end: str, range_bucket: str = "window=latest", snapshot_bucket: str = "snapshot=latest", calendar: DataFrame | None = None
) -> DataFrame:
    """One row for each api, with the columns of PLAN.

    apis: provider, source_family, api_name, dataset_version, query_mode, policy (trade_date, range or snapshot), start_date, overlap_days.
    inventory: api_name, bucket_kind, bucket_value, relative_path, rows, max_date, snapshot_date, status; rows that are not 'ok' do not count.
    An api by trade date fetches from its open-year bucket's last day less the overlap, but not from before that year; from the year's start
    where the bucket has no dates or only older years have landed; and from the api's start where nothing has. Ranges are fetched whole and
    snapshots of the end day. The overlap counts open days of the calendar, or days from Monday to Friday where none is given. Of several
    assets of one bucket the last by path and rows stands. Days are DATEs.
    """
    last_day = F.lit(end).cast("date")
    open_year = end[:4]
    ok = inventory.where("status = 'ok'")
    shown = F.greatest("max_date", "snapshot_date")
    held = ok.groupBy("api_name", C("bucket_kind").alias("_kind"), C("bucket_value").alias("_value"))
    held = held.agg(F.max(F.struct("relative_path", F.coalesce("rows", F.lit(0)).alias("n"), C("rows").alias("rows"), shown.alias("day"))).alias("asset"))
    closed = ok.where((C("bucket_kind") == "year") & (C("bucket_value") < open_year)).select("api_name").distinct().withColumn("_closed", F.lit(True))
    split = lambda text, i: text.split("=", 1)[i]
    by_policy = lambda i, year: F.when(C("policy") == "range", split(range_bucket, i)).when(C("policy") == "snapshot", split(snapshot_bucket, i)).otherwise(year)
    plan = apis.withColumns({"_kind": by_policy(0, "year"), "_value": by_policy(1, open_year)})
    plan = plan.join(held, ["api_name", "_kind", "_value"], "left").join(closed, "api_name", "left").withColumn("_day", C("asset.day"))
    if calendar is None:
        plan = plan.withColumn("_back", weekdays_back(C("_day"), C("overlap_days")))
    else:
        plan = open_days_back(plan, "_day", C("overlap_days"), calendar, "_back")
    year_start = F.lit(f"{open_year}-01-01").cast("date")
    there, dated, daily = C("asset").isNotNull(), C("_day").isNotNull(), C("policy") == "trade_date"
    by_day = F.when(there & dated, F.greatest("_back", year_start)).when(there | C("_closed"), year_start).otherwise(C("start_date"))
    path = F.concat_ws("/", F.lit("raw"), "provider", "source_family", "api_name", "dataset_version", F.concat("_kind", F.lit("="), "_value"), F.lit("data.parquet"))
    out = plan.withColumns({
        "plan_kind": F.coalesce(*[F.when(C("policy") == p, kind) for p, kind in KINDS.items()]),
        "fetch_start_date": F.when(daily, by_day).when(C("policy") == "snapshot", last_day).otherwise(C("start_date")),
        "fetch_end_date": last_day, "target_bucket_kind": C("_kind"), "target_bucket_value": C("_value"), "target_relative_path": path,
        "existing_relative_path": F.coalesce("asset.relative_path", F.lit("")), "existing_max_date": C("_day"), "existing_rows": C("asset.rows"),
        "open_year": F.lit(open_year),
        "planned_action": F.when(daily, F.when(there, REPLACE_YEAR).otherwise(COPY_YEAR)).otherwise(F.when(there, REPLACE_LATEST).otherwise(COPY_LATEST)),
        "reason": F.when(daily, F.when(~there, NO_BUCKET).when(dated, OVERLAP).otherwise(NO_DATES)).otherwise(F.concat(F.lit("stable latest "), "_kind", F.lit(" refresh"))),
    })
    return out.select(*PLAN)
