"""Normalisers, file sources and sinks on small cases."""

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from paneloom.operators import catalog, checks, contracts, lake, normalise, research
from paneloom.sources import files, reports, sinks, store

C = F.col


def test_symbols_and_codes(spark):
    df = spark.createDataFrame([("sh.600000",), ("sz000001",), ("300750.SZ",), ("688001",), ("430047",), ("60000",), (None,), ("",)], "c string")
    assert [r[0] for r in df.select(normalise.symbol(C("c"))).collect()] == ["600000.SH", "000001.SZ", "300750.SZ", "688001.SH", "430047.BJ", None, None, None]
    assert [r[0] for r in df.select(normalise.symbol(C("c"), "joined")).collect()][:2] == ["sh600000", "sz000001"]


def test_margin_frames(spark):
    a = spark.createDataFrame([("20250102", 600000, "x", "1.5", "2", "bad", "4", "5", "6")], list(normalise.MARGIN_COLUMNS["SSE"].values()))
    b = spark.createDataFrame([("1", None)], "`证券代码` string, trade_date string")
    one = normalise.margin_frame(a, "sse", "2025-01-01").first()
    assert (one.date, one.asset, one.financing_balance, one.financing_repay_amount, one.has_short_balance) == (date(2025, 1, 2), "600000.SH", 1.5, None, False)
    two = normalise.margin_frame(b, "SZSE", "2025-01-01", strict=False).first()
    assert (two.date, two.asset, two.short_balance, two.has_short_balance) == (date(2025, 1, 1), "000001.SZ", None, True)
    with pytest.raises(ValueError):
        normalise.margin_frame(b, "SZSE", "2025-01-01")


def test_bars_unions_and_classes(spark):
    raw = spark.createDataFrame([("a", "20240102", "1", 1), ("a", "2024-01-02", "2", 2), ("a", "x", "3", 3), ("b", "20240102", "no", 4)], "code string, day string, close string, o int")
    got = normalise.daily_bars(raw, {"ts_code": ("ts_code", "code"), "trade_date": ("day",), "close": ("close",)}, "o").collect()
    assert [(r.ts_code, r.close) for r in got] == [("a", 2.0)]
    mixed = normalise.union_mixed(spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("t",)], "a string"))
    assert mixed.dtypes[0] == ("a", "string") and mixed.count() == 2
    tagged = normalise.flatten_products({"p": spark.range(2), "q": spark.range(1)}, exchange="X")
    assert sorted((r.product_key, r.exchange) for r in tagged.collect()) == [("p", "X"), ("p", "X"), ("q", "X")]
    runs = spark.createDataFrame([("success", 1, ""), ("success", 0, ""), ("missing", 0, ""), ("failed", 0, "Read timed out"), ("failed", 0, "KeyError"), ("failed", 0, "bad 参数"), ("failed", 0, "unexpected keyword argument"), (None, None, None)], "status string, rows int, error_message string")
    assert [r[0] for r in runs.select(normalise.health()).collect()] == [*normalise.HEALTH, "manual_review_needed"]
    days = spark.createDataFrame([(date(2024, 3, 11), 1), (date(2024, 3, 10), 1), (date(2024, 3, 13), 7)], "d date, k int")
    assert [r[0] for r in days.select(normalise.minus_weekdays(C("d"), 1)).collect()] == [date(2024, 3, 8), date(2024, 3, 7), date(2024, 3, 12)]
    risk = spark.createDataFrame([("",), (None,), ("Post x",), ("盘后",), ("y",)], "t string").select(normalise.risk_level(C("t")))
    assert [r[0] for r in risk.collect()] == ["low", "low", "high", "high", "medium"]
    ind = spark.createDataFrame([("1", "2024-01-01", "110101", "bad")], "s string, e string, i string, u string")
    row = normalise.industry_history(ind, {"stock_code": "s", "effective_date": "e", "industry_code": "i", "source_update_time": "u"}).first()
    assert (row.stock_code, row.industry_l1_code, row.industry_l2_code, row.industry_l3_code, row.source_update_time) == ("000001", "11", "1101", "110101", None)


def test_files_and_sinks(spark, tmp_path):
    root = str(tmp_path / "lake")
    df = spark.createDataFrame([(date(2024, 1, 2), "a", 1), (date(2024, 1, 2), "b", 2), (date(2024, 2, 1), "a", 3)], "trade_date date, asset string, v int")
    sinks.write_by_date(df, f"{root}/fam/api", order="asset")
    sinks.write_by_date(df.where("v = 3").withColumn("v", C("v") + 1), f"{root}/fam/api")
    assert sorted(r.v for r in spark.read.parquet(f"{root}/fam/api").collect()) == [1, 2, 4]
    inv = files.bucketed(files.inventory(spark, root)).cache()
    assert {(r.family, r.api, r.bucket) for r in inv.collect()} == {("fam", "api", "year=2024")}
    assert sum(r.rows for r in files.row_counts(spark, root, None).collect()) == 3
    assert files.verify(inv, inv.select("path", "digest")).isEmpty()
    assert files.verify(inv, inv.select("path", F.lit("x").alias("digest"))).count() == inv.count()
    assert files.selected_partitions(inv.withColumn("partition", F.map_concat("partition", F.create_map(F.lit("exchange"), F.lit("sse")))), "exchange", ["SSE"], "trade_date", "2024-01-01", "2024-01-31").where("selected").count() == 1
    assert files.read_partition(spark, f"{root}/fam/api", trade_date="2024-02-01").count() == 1
    path = str(tmp_path / "new")
    assert {r.status for r in sinks.append_new_partitions(df, path, ["asset"]).collect()} == {"success"}
    more = df.unionByName(spark.createDataFrame([(date(2024, 3, 1), "c", 9)], df.schema))
    assert {(r.asset, r.status) for r in sinks.append_new_partitions(more, path, ["asset"]).collect()} == {("a", "already_exists"), ("b", "already_exists"), ("c", "success")}
    assert spark.read.parquet(path).count() == 4
    table = str(tmp_path / "t")
    sinks.write_table(df, table)
    sinks.upsert_table(spark.createDataFrame([(date(2024, 1, 2), "a", 7)], df.schema), table, ["trade_date", "asset"])
    sinks.upsert_table(spark.createDataFrame([(date(2024, 1, 2), "c", 8)], df.schema), table, ["trade_date", "asset"])
    assert sorted(r.v for r in sinks.read_table(spark, table).collect()) == [2, 3, 7, 8]
    traced = sinks.compact_raw(spark, f"{root}/fam/api", str(tmp_path / "compact"), ("asset",))
    assert sorted(r.rows for r in traced.collect()) == [1, 2] and spark.read.parquet(str(tmp_path / "compact")).count() == 3
    assert {(r.year, r.month, r.rows, r.n_assets) for r in sinks.write_by_month(df, str(tmp_path / "m"), "trade_date").collect()} == {(2024, 1, 2, 2), (2024, 2, 1, 1)}
    sinks.write_outputs({"x": df.select("asset", F.lit("").alias("e"))}, str(tmp_path / "csv"))
    assert {r.e for r in files.read_texts(spark, str(tmp_path / "csv" / "x"), ("asset",)).collect()} == {""}
    with pytest.raises(ValueError):
        files.read_texts(spark, str(tmp_path / "csv" / "x"), ("gone",))
    (tmp_path / "reg.json").write_text(json.dumps({"sources": [{"api_name": "a"}, {"api_name": "a"}]}))
    with pytest.raises(ValueError):
        files.read_registry(spark, str(tmp_path / "reg.json"))
    (tmp_path / "sym.txt").write_text("600000.SH\n1\n\n600000\n")
    assert sorted(r.symbol for r in files.read_symbols(spark, str(tmp_path / "sym.txt")).collect()) == ["000001", "600000"]
    snaps = spark.createDataFrame([("i", date(2024, 1, 31), "a"), ("i", date(2024, 1, 31), "a")], "index_name string, snapshot_date date, asset string")
    sinks.write_snapshots(snaps, str(tmp_path / "snap"))
    assert spark.read.parquet(str(tmp_path / "snap")).count() == 1
    sinks.append_log(spark.range(1), str(tmp_path / "log"))
    sinks.append_log(spark.range(1), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    sinks.write_manifest(spark, str(tmp_path / "man"), rows=3, name="x")
    assert spark.read.json(str(tmp_path / "man")).first().rows == "3"
    assert lake.collision_plan(inv.select("path", "digest"), inv.select("path", "digest")).where("action = 'skip_identical'").count() == inv.count()


def test_store_reads_only_what_it_needs(spark, tmp_path):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(30)]
    raw = spark.createDataFrame([(d.strftime("%Y%m%d"), a, str(10.0 + i), "NaN" if a == "b" else "5", "100", "1000") for i, d in enumerate(days) for a in "ab"] + [("bad", "a", "1", "1", "1", "1")], "date string, code string, close string, open string, volume string, amount string")
    root, log = str(tmp_path / "fs"), str(tmp_path / "log")
    gone = store.build_feature_store(raw, root, spark.createDataFrame([("a",), ("b",), ("z",)], "symbol string"), "2024-01-06", "2024-01-25", log)
    assert [r.symbol for r in gone.collect()] == ["z"]
    got = store.read_features(spark, root, "2024-01-10", "2024-01-12", ["a"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan and got.count() == 3
    first = got.orderBy("date").first()
    assert first.ret_5d == pytest.approx(19 / 14 - 1) and first.is_tradable and first.asset == "a"
    assert not store.read_features(spark, root, symbols=["b"]).where("is_tradable or open is not null").count()
    assert store.read_features(spark, root).agg(F.min("date")).first()[0] == date(2024, 1, 6)
    names = {r.feature_name for r in store.read_feature_log(spark, log).collect()}
    assert {"ret_1d", "market_cap", "is_tradable"} <= names
    with pytest.raises(ValueError):
        store.build_feature_store(raw, root, start="2030-01-01")
    bars = spark.createDataFrame([(days[0], "a", 1.0, 5.0), (days[0], "a", 2.0, float("nan")), (days[1], None, 3.0, 1.0), (days[1], "b", None, 1.0)], "trade_date date, ts_code string, close double, vol double")
    sinks.write_by_date(bars, str(tmp_path / "bars"))
    panel = {(r.date, r.asset): r for r in store.read_daily_panel(spark, str(tmp_path / "bars")).collect()}
    assert set(panel) == {(days[0], "a"), (days[1], "b")} and panel[days[0], "a"].close == 2.0 and panel[days[0], "a"].volume is None
    assert not panel[days[1], "b"].is_tradable and panel[days[0], "a"].open is None
    with pytest.raises(ValueError):
        store.read_daily_panel(spark, str(tmp_path / "bars"), columns=["nothing"])


def test_catalog_jobs(spark):
    kinds = "source_family string, api_name string, status string, rows long"
    main = spark.createDataFrame([("f", "a", "success", 3), ("f", "b", "failed", 0), (None, "c", "timeout", 0)], kinds)
    assert {tuple(r) for r in catalog.unrecovered(main, main.limit(0)).collect()} == {("f", "b"), ("", "c")}
    with pytest.raises(ValueError):
        catalog.effective_catalog(main, main.where("api_name = 'a'"))
    good = spark.createDataFrame([("f", "b", "success", 4), (None, "c", "already_exists", 2), ("f", "b", "already_exists", 0)], kinds)
    assert sorted((r.api_name, r.rows) for r in catalog.effective_catalog(main, good).collect()) == [("a", 3), ("b", 4), ("c", 2)]
    tasks = spark.createDataFrame([("t", "success", date(2024, 1, 9), date(2024, 1, 1), date(2024, 2, 1)), ("t", "failed", date(2024, 2, 9), date(2024, 1, 1), date(2024, 2, 1)), ("u", "already_exists", None, None, None), ("", "success", None, None, None)], "task_key string, status string, month date, first_month date, last_month date")
    assert [r.task_key for r in catalog.completed_tasks(tasks).collect()] == ["u"]
    empty = spark.createDataFrame([], "source_family string, api_name string, status string, rows string, output_path string, metadata_path string")
    failed = {r.check_name: r.failed for r in catalog.run_validation(empty, ("success",)).collect()}
    assert failed["empty_catalog"] == failed["no_rows"] == 1 and failed["nan_path"] == 0
    assert catalog.filter_cases(main, 1, status="success").count() == 1 and catalog.plan_differences(main, main, "api_name").isEmpty()


def test_contracts(spark):
    table = spark.createDataFrame([("technical_liquidity", "x", "", "a", "ready_for_builder", "label", "none"), ("fundamental_quality", None, "n", "", "later", "", "")], "factor_family string, current_status string, recommended_next_step string, priority string, builder_readiness string, forbidden_field_risks string, notes string")
    got = {(r.rule, r.key) for r in checks.check_rules(table, contracts.FAMILY_READINESS, "factor_family").collect()}
    assert got == {("current_status is empty", "fundamental_quality"), ("recommended_next_step is empty", "technical_liquidity"), ("priority is empty", "fundamental_quality"), ("builder_readiness is known", "fundamental_quality"), ("risks need a safety note", "technical_liquidity")}
    assert {(r.rule, r.message) for r in checks.check_rules(table.drop("priority"), contracts.FAMILY_READINESS, "factor_family").where("message = 'missing column'").collect()} == {("priority is empty", "missing column")}
    with pytest.raises(ValueError):
        checks.check_rules(table, [{"name": "x", "kind": "odd", "column": "notes"}], "notes").collect()


def test_research_guards(spark):
    frame = spark.createDataFrame([(date(2024, 1, 1), "a", 1.0, 2.0), (date(2024, 1, 1), "b", None, 2.0)], "date date, asset string, s double, fwd_ret_5d double")
    rows, stats = research.aligned(frame, "s", ["fwd_ret_5d"])
    assert rows.count() == 1 and stats.first().coverage_ratio == 0.5
    assert research.aligned(frame.limit(0), "s", ["fwd_ret_5d"])[1].first().coverage_ratio == 0.0
    with pytest.raises(ValueError):
        research.aligned(frame, "s", ["nothing"])
    with pytest.raises(ValueError):
        research.strictly_joined(frame.select("date", "asset", "s"), frame.where("asset = 'a'").select("date", "asset", "fwd_ret_5d"))
    with pytest.raises(ValueError):
        research.basic_diagnostics(frame, ["fwd_ret_5d"])
    with pytest.raises(ValueError):
        normalise.component_codes(frame)
    with pytest.raises(ValueError):
        normalise.universe_sample(frame, 0, 1)


def test_lists_outputs_and_manifests(spark, tmp_path):
    (tmp_path / "u.csv").write_text("name,trade_date\n b ,20240102\n,20240103\na,20240201\n")
    at = str(tmp_path / "u.csv")
    assert [r.value for r in files.read_list(spark, at, "name").orderBy("place").collect()] == ["b", "a"]
    assert [r.value for r in files.read_list(spark, at, "name", [" z ", ""]).collect()] == ["z"]
    assert [r.value for r in files.read_days(spark, at, "20240101", "20240131").orderBy("place").collect()] == ["20240102", "20240103"]
    assert files.report_days("20230701", "20240401") == ["20230930", "20231231", "20240331"]
    with pytest.raises(ValueError):
        files.read_list(spark, at, "nothing")
    (tmp_path / "s.txt").write_text("2\n600000.SH\n2\n1\n")
    assert [r.symbol for r in files.read_ordered_symbols(spark, str(tmp_path / "s.txt")).orderBy("place").collect()] == ["000002", "600000", "000001"]
    sinks.write_outputs({"x": spark.range(3)}, str(tmp_path / "out"))
    assert set(files.read_outputs(spark, str(tmp_path / "out"), ("x",), ("y",))) == {"x"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_outputs(spark, str(tmp_path / "out"), ("y",))
    sinks.write_run_manifest(spark, str(tmp_path / "man"), run_id="r", extra=3)
    row = spark.read.json(str(tmp_path / "man")).first()
    assert row.run_id == "r" and row.extra == "3" and row.universe is None and len(row) == 16
    sinks.write_warnings(spark, str(tmp_path / "warn"), ["few names"])
    assert [r.value for r in spark.read.text(str(tmp_path / "warn")).collect()] == ["# Run Warnings", "", "- few names"]
    factors = spark.createDataFrame([(date(2024, 1, 2), "a", 1.0)], "date date, asset string, f double")
    sinks.write_factors(factors, checks.summarize_factors(factors, ["f"]), str(tmp_path / "fac"), "fam", phase="x")
    assert spark.read.parquet(str(tmp_path / "fac/fam/factors")).count() == 1 and spark.read.json(str(tmp_path / "fac/fam/metadata")).first().phase == "x"
    sinks.write_raw_partition(factors, str(tmp_path / "raw"), ["asset"], str(tmp_path / "meta"), api="q")
    assert spark.read.parquet(str(tmp_path / "meta")).first().api == "q"
    (tmp_path / "lake/a/b/k=1").mkdir(parents=True)
    (tmp_path / "lake/a/b/k=1/metadata.json").write_text('{"rows": 3}')
    assert files.read_partition_metadata(spark, str(tmp_path / "lake/a/b"), k="1").first().rows == 3
    snaps = spark.createDataFrame([("i", date(2024, 1, 31), "a"), ("i", date(2024, 3, 31), "b"), ("j", date(2024, 1, 31), "c")], "index_name string, snapshot_date date, asset string")
    sinks.write_snapshots(snaps, str(tmp_path / "snap"))
    got = files.read_snapshots(spark, str(tmp_path / "snap"), "i", end="2024-02-28")
    assert got.columns == list(files.SNAPSHOT_COLUMNS) and [r.asset for r in got.collect()] == ["a"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_snapshots(spark, str(tmp_path / "snap"), "gone")
    sinks.write_by_date(factors.withColumnRenamed("date", "trade_date").withColumn("report_date", F.lit("20231231")), str(tmp_path / "d/fam/api"))
    inv = files.drive_inventory(spark, str(tmp_path / "d")).first()
    assert (inv.rows, inv.min_date, inv.max_date, inv.bucket) == (1, date(2023, 12, 31), date(2023, 12, 31), "year=2024")


def test_reports_and_fetches(spark, tmp_path):
    rows = spark.createDataFrame([("a", "ok", {"k": "v"}, None, 1), ("b", "bad", {}, "x", 2)], "api_name string, status string, bucket map<string,string>, reason string, other int")
    reports.write_report(rows, str(tmp_path), "stable_latest_report")
    got = {r.api_name: r for r in reports.read_report(spark, str(tmp_path), "stable_latest_report").collect()}
    assert tuple(got["a"].asDict()) == reports.LAYOUTS["stable_latest_report"]
    assert (got["a"].bucket, got["a"].reason, got["a"].action, got["b"].reason) == ('{"k":"v"}', "", "", "x")
    told = spark.read.json(str(tmp_path / "stable_latest_report_summary")).collect()
    assert {(r.status, r.n_rows) for r in told} == {("ok", 1), ("bad", 1)}
    (tmp_path / "stable_latest_report").rename(tmp_path / "incremental_plan")
    with pytest.raises(ValueError):
        reports.read_report(spark, str(tmp_path), "incremental_plan")
    reports.write_fetch_result(rows.select("api_name", "status", "other"), str(tmp_path / "f"), "d", ("status", "api_name"), source="s")
    data, meta = reports.read_fetch_result(spark, str(tmp_path / "f"), "d")
    assert (tmp_path / "f" / "data" / "dataset_name=d" / "api_name=a" / "status=ok").is_dir()
    assert {(r.api_name, r.other) for r in data.collect()} == {("a", "1"), ("b", "2")}
    assert {(r.status, r.row_count, r.source, tuple(r.raw_columns)) for r in meta.collect()} == {(s, 1, "s", ("api_name", "status", "other")) for s in ("ok", "bad")}


def test_rank_correlation_of_all_pairs(spark):
    """Ties, nulls that differ between factors, a constant factor, and one that shares no row with another: as pair by pair in pandas."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(7)
    table = pd.DataFrame({c: rng.integers(0, 12, 400).astype(float) + (i * rng.random(400) if i % 2 else 0) for i, c in enumerate("abcdef")})
    table["b"] += table["a"]
    for c, share in zip("abcd", (0.1, 0.3, 0.0, 0.5)):
        table.loc[rng.random(400) < share, c] = None
    table["g"] = 3.0
    table["e"] = table["e"].where(table["d"].isna())
    names = list(table.columns)
    df = spark.createDataFrame([tuple(None if pd.isna(x) else x for x in r) for r in table.itertuples(index=False)], ", ".join(f"{c} double" for c in names))
    got = {(r.a, r.b): (r.corr, r.n_obs) for r in research.rank_correlation(df, names).collect()}
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            both = table[[a, b]].dropna()
            if both.empty:
                assert (a, b) not in got
                continue
            want = both[a].rank().corr(both[b].rank()) if both[a].nunique() > 1 and both[b].nunique() > 1 else None
            assert got[a, b][1] == len(both) and got[a, b][0] == (None if want is None else pytest.approx(want, abs=1e-9))
    assert research.rank_correlation(df.limit(0), names).isEmpty() and research.rank_correlation(df, ["a"]).isEmpty()
    assert {r.corr for r in research.rank_correlation(df.limit(10), names).collect()} == {None}


def test_active_manifest_by_version_and_status(spark):
    kinds = "relative_path string, api_name string, dataset_version string, bucket_kind string, status string"
    rows = [("a/1", "a", "v1", "window", "ok"), ("a/2", "a", "v1", "year", "ok"), ("a/3", "a", "v1", "year", "error"), ("a/4", "a", "v2", "year", "ok"), ("b/1", "b", "v1", "year", "ok"), ("c/1", "c", "v1", "year", "ok")]
    plan = spark.createDataFrame([("a/new", "a", "v9", "window", ""), ("c/1", "c", "v1", "year", "c/1")], "target_path string, api_name string, dataset_version string, bucket_kind string, existing_path string")
    merged = spark.createDataFrame([("b/1", "b"), ("c/1", "c")], "relative_path string, api_name string")
    assets = spark.createDataFrame(rows, kinds)
    got = {(r.relative_path, r.action) for r in catalog.active_manifest(assets, plan, merged, "v1").collect()}
    assert got == {("a/2", "keep"), ("b/1", "merge"), ("a/new", "copy_new_latest"), ("c/1", "replace_verified_latest")}
    assert catalog.superseded(assets, plan).isEmpty()
    assert [r.relative_path for r in catalog.superseded(assets, plan.withColumn("dataset_version", F.lit("v1"))).collect()] == ["a/1"]
    assert catalog.active_manifest(assets.limit(0), plan.limit(0), merged.limit(0), "v1").isEmpty()
