"""Eligibility, tradability and point-in-time membership."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.expr import require

C = F.col


def eligibility(features: DataFrame, columns: list[str] = (), tradable: bool = True, floors: dict[str, float] | None = None) -> Column:
    """All of: columns present, tradable (if there is such a column), thresholds reached. NULL counts as not."""
    require(features, *columns, *(floors or {}))
    tests = [C(c).isNotNull() for c in columns] + [C(c) >= v for c, v in (floors or {}).items()]
    if tradable and "is_tradable" in features.columns:
        tests.append(C("is_tradable"))
    return F.coalesce(reduce(lambda a, b: a & b, tests, F.lit(True)), F.lit(False))


def apply_mask(frame: DataFrame, mask: DataFrame) -> DataFrame:
    return frame.join(mask.where("eligible").select("date", "asset"), ["date", "asset"], "left_semi")


def tradability(bars: DataFrame) -> DataFrame:
    o, h, l, c = (C(x) for x in ("open", "high", "low", "close"))
    ohlc = F.coalesce((h >= F.greatest(o, l, c)) & (l <= F.least(o, h, c)) & o.isNotNull() & h.isNotNull() & l.isNotNull() & c.isNotNull(), F.lit(False))
    traded = F.coalesce((C("volume") > 0) & (C("amount") > 0), F.lit(False))
    return bars.select("date", "asset", ohlc.alias("valid_ohlc"), traded.alias("traded"), (ohlc & traded).alias("tradable"))


def members_asof(snapshots: DataFrame, day: str) -> DataFrame:
    """Members of the latest snapshot on or before a day."""
    last = snapshots.where(C("snapshot_date") <= F.lit(day).cast("date")).agg(F.max("snapshot_date").alias("snapshot_date"))
    return snapshots.join(F.broadcast(last), "snapshot_date", "left_semi").select("snapshot_date", "asset")


def snapshot_of_dates(dates: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(date, snapshot_date): the latest snapshot on or before each date; dates before the first drop out. Tables of dates only."""
    marks = snapshots.select(C("snapshot_date").alias("date"), F.lit(0).alias("k"), C("snapshot_date").alias("s")).distinct()
    both = marks.unionByName(dates.select("date", F.lit(1).alias("k"), F.lit(None).cast("date").alias("s")).distinct())
    last = F.last("s", ignorenulls=True).over(Window.orderBy("date", "k").rowsBetween(Window.unboundedPreceding, 0))
    return both.select("date", "k", last.alias("snapshot_date")).where("k = 1 and snapshot_date is not null").select("date", "snapshot_date")


def pit_mask(frame: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Rows whose asset is a member in the latest snapshot on or before their date."""
    last = F.broadcast(snapshot_of_dates(frame, snapshots))
    return frame.join(last, "date").join(snapshots.select("snapshot_date", "asset"), ["snapshot_date", "asset"], "left_semi").select(*frame.columns)


def group_asof(frame: DataFrame, history: DataFrame) -> DataFrame:
    """frame with the group whose start_date is the latest on or before the row's date, for each asset; history: asset, start_date, grp.

    Both are put in one order for each asset, and each row takes the last group before it: no join of ranges."""
    starts = history.select("asset", C("start_date").alias("date"), F.lit(0).alias("_k"), F.struct("grp").alias("_g"))
    both = frame.withColumn("_k", F.lit(1)).unionByName(starts, allowMissingColumns=True)
    last = F.last("_g", ignorenulls=True).over(Window.partitionBy("asset").orderBy("date", "_k").rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("_g", last).where("_k = 1").select(*frame.columns, C("_g.grp").alias("asof_grp"))


def event_window(panel: DataFrame, events: DataFrame, before: int, after: int) -> DataFrame:
    """(asset, event_date, date, offset): the asset's rows from `before` rows before the first row on or after the event to `after` behind.

    The first row's number is one more than the rows before the event in the order of the asset; the rest is joined by number."""
    w = Window.partitionBy("asset").orderBy("date", "_k")
    rows = panel.select("asset", "date", F.lit(1).alias("_k"))
    both = rows.unionByName(events.select("asset", C("event_date").alias("date"), F.lit(0).alias("_k")))
    counted = both.withColumn("i", F.sum("_k").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.sum("_k").over(Window.partitionBy("asset")))
    at = counted.where("_k = 0 and i < n").select("asset", C("date").alias("event_date"), (C("i") + 1).alias("at"))
    reach = at.select("asset", "event_date", "at", F.explode(F.sequence(C("at") - before, C("at") + after)).alias("i"))
    return reach.join(counted.where("_k = 1").select("asset", "i", "date"), ["asset", "i"]).select("asset", "event_date", "date", (C("i") - C("at")).cast("int").alias("offset"))
