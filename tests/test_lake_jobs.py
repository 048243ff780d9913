"""Inventories from footers, compaction with lineage, verified merges of buckets, arithmetic on open days and the plan of fetch windows."""

import glob
import os
from datetime import date, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from paneloom.operators import features, grids, increments, lake, merge
from paneloom.sources import compaction, footers, sinks

C = F.col


def put(root, where, columns, name="data.parquet"):
    folder = os.path.join(str(root), where)
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.table(columns), os.path.join(folder, name))


# --- buckets


@pytest.mark.parametrize(
    "parts,bucket",
    [
        ({"year": "2024"}, "year=2024"),
        ({"trade_date": "20230105"}, "year=2023"),
        ({"report_date": "20221231"}, "year=2022"),
        ({"suspend_date": "2021-02-03"}, "year=2021"),
        ({"cal_date": "20200101"}, "year=2020"),
        ({"date": "2019-01-01"}, "year=2019"),
        ({"start_date": "20240101", "end_date": "20241231"}, "year=2024"),
        ({"start_date": "20231201", "end_date": "20240131"}, "window=20231201_20240131"),
        ({"snapshot": "latest", "year": "2020"}, "snapshot=latest"),
        ({"since_date": "20220101"}, "since=20220101"),
        ({"symbol": "000001"}, "scope=run_20220101_20241231"),
        ({"year": "", "snapshot": "", "trade_date": "20220105"}, "year=2022"),
    ],
)
def test_bucket_of_a_partition(spark, parts, bucket):
    frame = spark.createDataFrame([(parts,)], "partition map<string,string>")
    assert frame.select(lake.partition_bucket("partition", "20220101", "20241231")).first()[0] == bucket


@pytest.mark.parametrize("parts", [{"trade_date": "x1"}, {"since_date": "2022"}, {"start_date": "1", "end_date": "20240101"}])
def test_a_partition_without_a_year_raises(spark, parts):
    with pytest.raises(Exception, match="partition"):
        spark.createDataFrame([(parts,)], "partition map<string,string>").select(lake.partition_bucket()).collect()


# --- inventory


@pytest.fixture()
def mixed_lake(tmp_path):
    root = tmp_path / "lake"
    put(root, "fam/bars/trade_date=20240102", {"trade_date": ["20240102", "2024-01-05"], "v": [1, 2]})
    put(root, "fam/bars/trade_date=20240103", {"ann_date": [None, date(2024, 1, 3)], "trade_date": pa.array([None, None], pa.string()), "v": [1.5, None]})
    put(root, "fam/codes/snapshot=20240110", {"code": ["a"]})
    put(root, "fam/codes/window=20230101_20240201", {"code": ["b"], "v": ["x"]})
    put(root, "other/days/year=2023", {"date": pa.array([], pa.date32())})
    put(root, "other/days/kind=a%3Db", {"end_date": [20231231, 20230630]})
    os.makedirs(root / "other/bad/year=2022")
    (root / "other/bad/year=2022/data.parquet").write_bytes(b"PAR1 this is no footer")
    (root / "other/bad/year=2022/empty.parquet").write_bytes(b"")
    return str(root)


def test_inventory_of_mixed_corrupt_and_undated_files(spark, mixed_lake):
    inv = {r.path: r for r in footers.footer_inventory(spark, mixed_lake).collect()}
    told = {p: (r.family, r.api, r.rows, r.date_column, r.min_date, r.max_date, r.bucket_kind, r.bucket_value) for p, r in inv.items() if r.status == "ok"}
    assert told == {
        "fam/bars/trade_date=20240102/data.parquet": ("fam", "bars", 2, "trade_date", date(2024, 1, 2), date(2024, 1, 5), "year", "2024"),
        "fam/bars/trade_date=20240103/data.parquet": ("fam", "bars", 2, "ann_date", date(2024, 1, 3), date(2024, 1, 3), "year", "2024"),
        "fam/codes/snapshot=20240110/data.parquet": ("fam", "codes", 1, "partition.snapshot", date(2024, 1, 10), date(2024, 1, 10), "snapshot", "20240110"),
        "fam/codes/window=20230101_20240201/data.parquet": ("fam", "codes", 1, "partition.window", date(2023, 1, 1), date(2024, 2, 1), "scope", "all"),
        "other/days/year=2023/data.parquet": ("other", "days", 0, "partition.year", date(2023, 1, 1), date(2023, 12, 31), "year", "2023"),
        "other/days/kind=a%3Db/data.parquet": ("other", "days", 2, "end_date", date(2023, 6, 30), date(2023, 12, 31), "scope", "all"),
    }
    bad = [r for r in inv.values() if r.status != "ok"]
    assert len(bad) == 2 and all(r.status == "unreadable" and r.error_message and r.rows is None for r in bad)
    one = inv["other/days/kind=a%3Db/data.parquet"]
    import hashlib

    assert one.digest == hashlib.sha256(open(f"{mixed_lake}/{one.path}", "rb").read()).hexdigest() and one.partition == {"kind": "a=b"}
    assert one.columns == ["end_date"] and one.types == ["int64"] and one.bytes == os.path.getsize(f"{mixed_lake}/{one.path}")
    total = {r.api: (r.files, r.unreadable_files, r.rows) for r in footers.inventory_summary(footers.footer_inventory(spark, mixed_lake)).collect()}
    assert total == {"bars": (2, 0, 4), "codes": (2, 0, 2), "days": (2, 0, 2), "bad": (2, 2, 0)}
    with pytest.raises(Exception, match="unreadable file"):
        footers.footer_inventory(spark, mixed_lake, strict=True).collect()
    store = footers.footer_inventory(spark, mixed_lake, digests=False, bucket=lake.landed_bucket())
    assert {(r.bucket_kind, r.bucket_value) for r in store.where("api = 'codes'").collect()} == {("snapshot", "20240110"), ("window", "20230101_20240201")}
    mine, others = footers.of_version(footers.footer_inventory(spark, mixed_lake), "bars", "api")
    assert mine.count() == 2 and others == 6


def test_one_column_of_different_types_is_read_as_the_least_common_one(spark, tmp_path):
    for i, values in enumerate([[1, 2], [1.5, None], ["x", "07"], pa.array([None], pa.null())]):
        put(tmp_path, f"f/a/part={i}", {"v": values, "w": pa.array(range(len(values)), pa.int32() if i else pa.int64())})
    inv = footers.footer_inventory(spark, str(tmp_path))
    assert {r["column"]: r.type for r in footers.common_types(inv).collect()} == {"v": "string", "w": "bigint"}
    assert {r["column"]: r.type for r in footers.common_types(inv.where("partition['part'] in ('0', '1', '3')")).collect()}["v"] == "double"
    assert sorted(str(r.v) for r in footers.read_mixed(spark, inv).collect()) == sorted(["1", "2", "1.5", "None", "x", "07", "None"])


# --- compaction


def test_compaction_keeps_rows_and_tells_lineage(spark, tmp_path):
    raw = tmp_path / "raw"
    for where, n in (("trade_date=20220103", 2), ("trade_date=20220506", 3), ("trade_date=20230103", 1), ("symbol=a%3Db", 2)):
        put(raw, f"fam/api/{where}", {"a": list(range(n)), "b": list(range(n)), "year": ["x"] * n})
    put(raw, "fam/other/year=2022", {"z": [1.5, 1.5]})
    package = str(tmp_path / "package")
    lineage, qa = compaction.compact_raw(spark, str(raw), package, "20220101", "20241231")
    told = {(r.source_family, r.api_name, r.bucket_kind, r.bucket_value): (r.expected_rows, r.actual_rows, r.ok) for r in qa.collect()}
    assert told == {
        ("fam", "api", "year", "2022"): (5, 5, True), ("fam", "api", "year", "2023"): (1, 1, True),
        ("fam", "api", "scope", "run_20220101_20241231"): (2, 2, True), ("fam", "other", "year", "2022"): (2, 2, True),
    }
    rows = lineage.collect()
    assert len(rows) == 5 and all(len(r.source_sha256) == 64 for r in rows)
    year = next(r.relative_path for r in qa.collect() if r.api_name == "api" and r.bucket_value == "2022")
    out = spark.read.parquet(f"{package}/{year}")
    assert out.columns == ["a", "b", "year"] and sorted(r.a for r in out.collect()) == [0, 0, 1, 1, 2]
    assert {r.compact_relative_path for r in rows} == {r.relative_path for r in qa.collect()}
    assert not glob.glob(f"{package}.staging-*")
    with pytest.raises(FileExistsError):
        compaction.compact_raw(spark, str(raw), package, "20220101", "20241231")
    put(raw, "fam/other/year=2022", {"z": ["text"]}, "more.parquet")
    with pytest.raises(ValueError, match="column mismatch"):
        compaction.compact_raw(spark, str(raw), package, "20220101", "20241231", replace=True)
    assert spark.read.parquet(f"{package}/qa").count() == 4  # what was there before stays
    (raw / "fam/other/year=2022/more.parquet").write_bytes(b"nothing")
    with pytest.raises(ValueError, match="unreadable"):
        compaction.compact_raw(spark, str(raw), package, "20220101", "20241231", replace=True)
    with pytest.raises(FileNotFoundError):
        os.makedirs(tmp_path / "none")
        compaction.compact_raw(spark, str(tmp_path / "none"), str(tmp_path / "p"), "20220101", "20241231")


# --- merge


def files_of(path):
    return {os.path.relpath(f, path): os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [("a", 1, 20.0, 2022), ("b", 1, None, 2022), ("a", 2, 1.0, 2023), ("b", 2, 2.0, 2023), ("a", 3, 5.0, 2024), (None, 4, 9.0, 2025), ("d", 5, 1.0, 2026), ("d", 5, 1.0, 2026)]
    kind = "code string, day int, mv double, year int"
    spark.createDataFrame(old, kind).write.partitionBy("year").parquet(path)
    before = files_of(path)
    new = [("b", 1, None, 2022), ("c", 1, 3.0, 2022), ("a", 2, 7.0, 2023), ("e", 9, 1.0, 2023), (None, 4, 9.0, 2025), ("x", 6, 1.0, 2026), ("n", 7, 1.0, 2027), ("n", 8, 1.0, 2027)]
    report, conflicts = merge.merge_into(spark, path, spark.createDataFrame(new, kind), ["code", "day"], ["year"])
    told = {r.year: (r.status, r.old_rows, r.new_rows, r.candidate_rows, r.old_only_rows, r.new_only_rows, r.identical_overlap_rows, r.conflict_rows, r.duplicate_key_rows) for r in report.collect()}
    assert told == {
        2022: ("PASS", 2, 2, 3, 1, 1, 1, 0, 0), 2023: ("BLOCKED", 2, 2, 0, 1, 1, 0, 1, 0), 2025: ("PASS", 1, 1, 1, 0, 0, 1, 0, 0),
        2026: ("BLOCKED", 2, 1, 0, 0, 0, 0, 0, 2), 2027: ("PASS", 0, 2, 2, 0, 2, 0, 0, 0),
    }
    assert {r.year: r.reason for r in report.collect()}[2023] == merge.CONFLICTS
    assert [(r.year, r.code, r.day, r.old.mv, r.new.mv) for r in conflicts.collect()] == [(2023, "a", 2, 1.0, 7.0)]
    after = files_of(path)
    for year in (2023, 2024, 2025, 2026):  # blocked, not touched, nothing new
        assert {f: t for f, t in after.items() if f"year={year}" in f} == {f: t for f, t in before.items() if f"year={year}" in f}
    now = sorted((str(r.code), r.day, str(r.mv), r.year) for r in spark.read.parquet(path).collect())
    want = [*old, ("c", 1, 3.0, 2022), ("n", 7, 1.0, 2027), ("n", 8, 1.0, 2027)]
    assert now == sorted((str(a), b, str(c), d) for a, b, c, d in want)


def test_merge_is_blocked_by_columns(spark):
    old = spark.createDataFrame([("a", 1, 2.0, 2022)], "code string, day int, mv double, year int")
    more = old.withColumn("extra", F.lit(1))
    r = merge.merge_report(old, more, ["code", "day"], ["year"]).first()
    assert (r.status, r.reason, r.schema_mismatch, r.old_only_rows) == ("BLOCKED", merge.SCHEMAS, True, 0)
    r = merge.merge_report(old, old.drop("day"), ["code", "day"], ["year"]).first()
    assert (r.status, r.reason, r.old_rows, r.new_rows) == ("BLOCKED", merge.KEYS_MISSING + "day", 1, 1)
    r = merge.merge_report(old, more.unionByName(more), ["code", "day"], ["year"]).first()
    assert (r.reason, r.duplicate_key_rows) == (merge.DUPLICATES, 2)
    assert merge.merge_report(old, old.where("false"), ["code", "day"], ["year"]).collect() == []


# --- open days


def test_weekdays_back_equals_stepping(spark):
    cases = [(date(2024, 1, 1) + timedelta(days=i), k) for i in range(15) for k in range(13)]
    got = spark.createDataFrame(cases, "day date, k int").select("day", "k", increments.weekdays_back(C("day"), C("k")).alias("to")).collect()
    for r in got:
        at, left = r.day, r.k
        while left:
            at -= timedelta(days=1)
            left -= at.weekday() < 5
        assert r.to == at, (r.day, r.k)


def test_open_days_skip_holidays(spark):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(30)]
    is_open = [d.weekday() < 5 and d.day not in (1, 10, 11) for d in days]
    calendar = spark.createDataFrame(list(zip(days, is_open)), "day date, is_open boolean").where("dayofmonth(day) <> 13").unionByName(
        spark.createDataFrame([(days[4], True)], "day date, is_open boolean"))
    cases = [(d, k) for d in [*days, None, date(2030, 1, 1)] for k in (0, 1, 3, 40)]
    got = increments.open_days_back(spark.createDataFrame(cases, "d date, k int"), "d", C("k"), calendar).collect()
    assert len(got) == len(cases)
    for r in got:
        before = [d for d, o in zip(days, is_open) if o and r.d and d < r.d]
        want = r.d if r.k == 0 or not r.d else (before[max(0, len(before) - r.k)] if before and r.d.year == 2024 else None)
        assert r.open_day == want, (r.d, r.k)


def test_incremental_plan(spark):
    api = lambda name, policy, start=date(2020, 1, 1), k=3: ("p", "fam", name, "v1", "m", policy, start, k)
    apis = spark.createDataFrame(
        [api("daily", "trade_date"), api("late", "trade_date", k=30), api("undated", "trade_date"), api("old", "trade_date"), api("fresh", "trade_date"), api("r", "range"), api("s", "snapshot")],
        "provider string, source_family string, api_name string, dataset_version string, query_mode string, policy string, start_date date, overlap_days int",
    )
    asset = lambda name, kind, value, path, n, day, snap=None, status="ok": (name, kind, value, path, n, day, snap, status)
    inv = spark.createDataFrame(
        [
            asset("daily", "year", "2024", "a/1", 5, date(2024, 3, 5)), asset("daily", "year", "2024", "a/2", 7, date(2024, 3, 4)),
            asset("daily", "year", "2024", "a/3", 7, date(2024, 3, 29), status="unreadable"), asset("late", "year", "2024", "b", 1, date(2024, 1, 9)),
            asset("undated", "year", "2024", "c", 2, None), asset("old", "year", "2023", "d", 2, date(2023, 12, 29)),
            asset("s", "snapshot", "latest", "e", 4, None, date(2024, 2, 1)),
        ],
        "api_name string, bucket_kind string, bucket_value string, relative_path string, rows long, max_date date, snapshot_date date, status string",
    )
    plan = {r.api_name: r for r in increments.incremental_plan(apis, inv, "2024-03-06").collect()}
    told = {a: (r.fetch_start_date, r.existing_relative_path, r.existing_rows, r.planned_action, r.reason) for a, r in plan.items()}
    assert told == {
        "daily": (date(2024, 2, 28), "a/2", 7, "replace_verified_incremental_candidate", increments.OVERLAP),
        "late": (date(2024, 1, 1), "b", 1, "replace_verified_incremental_candidate", increments.OVERLAP),
        "undated": (date(2024, 1, 1), "c", 2, "replace_verified_incremental_candidate", increments.NO_DATES),
        "old": (date(2024, 1, 1), "", None, "copy_new_open_year", increments.NO_BUCKET),
        "fresh": (date(2020, 1, 1), "", None, "copy_new_open_year", increments.NO_BUCKET),
        "r": (date(2020, 1, 1), "", None, "copy_new_latest", "stable latest window refresh"),
        "s": (date(2024, 3, 6), "e", 4, "replace_verified_latest_candidate", "stable latest snapshot refresh"),
    }
    assert plan["daily"].target_relative_path == "raw/p/fam/daily/v1/year=2024/data.parquet" and plan["daily"].plan_kind == "by_trade_date_open_year"
    days = spark.createDataFrame([(date(2024, 1, 1) + timedelta(days=i), i % 7 < 5 and i != 58) for i in range(90)], "day date, is_open boolean")
    plan = {r.api_name: r for r in increments.incremental_plan(apis, inv, "2024-03-06", calendar=days).collect()}
    assert plan["daily"].fetch_start_date == date(2024, 2, 27)  # the 28th is a holiday


# --- expected partitions


def test_expected_partitions_of_each_mode(spark):
    row = lambda mode, a, b, dims=None: (mode, mode, a, b, dims)
    a, b = date(2024, 1, 30), date(2024, 4, 2)
    specs = spark.createDataFrame(
        [row("day", a, date(2024, 2, 1), ["SSE", "SZSE"]), row("weekday", date(2024, 2, 2), date(2024, 2, 5)), row("month", a, b), row("quarter_end", a, b), row("year", date(2023, 12, 31), b),
         row("range", a, b), row("snapshot", a, b), row("symbol", a, b), ("none", "day", b, a, None)],
        "api_name string, mode string, start date, end date, dimensions array<string>",
    )
    symbols = spark.createDataFrame([("'1",), ("000001",), ("600000",), (" ",), (None,)], "symbol string")
    got = {}
    for r in grids.expected_partitions(specs, symbols).collect():
        got.setdefault(r.api_name, []).append((r.dimension, r.symbol, r.partition, r.start_date, r.end_date))
    at = lambda d: d.strftime("%Y%m%d")
    whole = f"{at(a)}_{at(b)}"
    days = [date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1)]
    assert {k: sorted(v, key=str) for k, v in got.items()} == {
        "day": sorted([(x, None, at(d), d, d) for x in ("SSE", "SZSE") for d in days], key=str),
        "weekday": [(None, None, at(d), d, d) for d in (date(2024, 2, 2), date(2024, 2, 5))],
        "month": [
            (None, None, "202401", a, date(2024, 1, 31)), (None, None, "202402", date(2024, 2, 1), date(2024, 2, 29)),
            (None, None, "202403", date(2024, 3, 1), date(2024, 3, 31)), (None, None, "202404", date(2024, 4, 1), b),
        ],
        "quarter_end": [(None, None, "20240331", date(2024, 3, 31), date(2024, 3, 31))],
        "year": [(None, None, "2023", date(2023, 12, 31), date(2023, 12, 31)), (None, None, "2024", date(2024, 1, 1), b)],
        "range": [(None, None, whole, a, b)],
        "snapshot": [(None, None, "latest", b, b)],
        "symbol": [(None, "000001", whole, a, b), (None, "600000", whole, a, b)],
    }
    with pytest.raises(Exception, match="unknown mode"):
        grids.expected_partitions(specs.withColumn("mode", F.lit("hourly"))).collect()


# --- a policy in two runs


def test_a_policy_that_goes_on_equals_one_run(spark):
    from paneloom.operators import rebalance

    rng = __import__("random").Random(4)
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(70)]
    rows = []
    for d in days:
        names = [f"a{i}" for i in range(12) if rng.random() > 0.1]
        rng.shuffle(names)
        rows += [(d, a, i + 1, float(-i), rng.random() > 0.2) for i, a in enumerate(names)]
    signal = spark.createDataFrame(rows, "date date, asset string, rank int, score double, is_tradable boolean").cache()
    configs = {k: rebalance.BufferedConfig(4, 3, 6, 2, 5, max_weight=None, min_trade_weight=m, freq="W") for k, m in (("a", 0.0), ("b", 0.05))}
    key = lambda r: (r.portfolio_id, r.date, r.asset)
    whole = sorted(rebalance.buffered_weights(signal, configs).collect(), key=key)
    split = "2024-02-04"  # a Sunday
    first = rebalance.buffered_weights(signal.where(C("date") <= split), configs)
    state = rebalance.holdings(first).cache()
    rest = rebalance.buffered_weights(signal.where(C("date") > split), configs, state, split)
    assert sorted(first.collect() + rest.collect(), key=key) == whole
    assert {r.date for r in state.collect()} == {date(2024, 2, 4)} and state.count() <= 10
    again = rebalance.buffered_weights(signal, configs, state, split)  # days before are passed over
    assert sorted(again.collect(), key=key) == [r for r in whole if str(r.date) > split]
    assert rebalance.holdings(rest.where("false"), state).count() == state.count()


# --- sinks


def test_of_two_writers_of_a_partition_one_wins(spark, tmp_path):
    path = str(tmp_path / "bars")
    kind = "date date, symbol string, v int"
    one = spark.createDataFrame([(date(2024, 1, 2), "a", 1), (date(2024, 1, 3), "a", 1), (date(2024, 2, 1), "a=b", 1)], kind)
    two = spark.createDataFrame([(date(2024, 1, 2), "a", 2), (date(2024, 3, 1), "a", 2)], kind)
    told = lambda df: {(r.symbol, r.month): (r.rows, r.status) for r in df.collect()}
    assert told(sinks.write_symbol_months(one, path)) == {("a", "1"): (2, "success"), ("a=b", "2"): (1, "success")}
    assert told(sinks.write_symbol_months(two, path)) == {("a", "1"): (1, "already_exists"), ("a", "3"): (1, "success")}
    assert sorted((r.symbol, r.month, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1, 1), ("a", 1, 1), ("a", 3, 2), ("a=b", 2, 1)]
    assert not glob.glob(f"{path}.staging-*")
    # a writer that staged its folder before another took the place
    put(tmp_path, "late/symbol=a", {"v": [9]})
    put(tmp_path, "bars/symbol=a/adjust=none/year=2024/month=1", {"v": [1]}, "kept.parquet")
    os.makedirs(tmp_path / "late/symbol=a/adjust=none/year=2024/month=1")
    batch = pa.RecordBatch.from_arrays([pa.array(["symbol=a/adjust=none/year=2024/month=1"])], ["folder"])
    assert [b.column("status").to_pylist() for b in sinks._moved(str(tmp_path / "late"), path)([batch])] == [["already_exists"]]


def test_windows_over_a_store_by_asset_need_no_exchange(spark, tmp_path):
    rows = [(date(2024, 1, 1) + timedelta(days=i), a, float(i + 1), 1.0, 1.0) for i in range(30) for a in "abc"]
    panel = spark.createDataFrame(rows, "date date, asset string, close double, amount double, market_cap double")
    table = sinks.save_by_asset(panel, str(tmp_path / "t"), "panel_by_asset_test", 4)
    made = features.compute_features(table, ["ret_1d", "ret_20d"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan
    want = features.compute_features(panel, ["ret_1d", "ret_20d"])
    assert sorted(map(str, made.collect())) == sorted(map(str, want.collect()))
    sinks.drop_table(spark, "panel_by_asset_test")
