"""Steps that must not hold a group in one task, or cost more than their share, as tables grow."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom.core import expr
from paneloom.operators import diagnostics, features, grids, rebalance
from paneloom.operators import research as run
from paneloom.plans import lakehouse, raw, registry, research  # noqa: F401  they add to the registry
from paneloom.plans.registry import ORACLE_SQL, QUERIES

duckdb = pytest.importorskip("duckdb")
D = [date(2024, 1, 1) + timedelta(days=i) for i in range(40)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_percentiles_of_a_group_are_exact_without_holding_it(spark):
    rng = np.random.default_rng(5)
    values = [None, *[float(x) for x in rng.integers(0, 40, 300)], *[float(x) for x in rng.normal(size=201)]]
    frame = spark.createDataFrame([(v, -v if v is not None else None, 7.0, None) for v in values], "a double, b double, c double, d double")
    got = {r.factor: r for r in diagnostics.distribution(frame, ["a", "b", "c", "d"]).collect()}
    there = np.array([v for v in values if v is not None])
    for f, v in (("a", there), ("b", -there)):
        assert [got[f][f"p{q:02d}"] for q in (1, 5, 25, 50, 75, 95, 99)] == pytest.approx(np.percentile(v, [1, 5, 25, 50, 75, 95, 99]), abs=1e-12)
        assert (got[f]["mean"], got[f]["min"], got[f]["max"]) == pytest.approx((v.mean(), v.min(), v.max()))
    assert got["c"].p50 == 7.0 and got["d"].p50 is None and got["d"]["mean"] is None
    assert "percentile" not in plan(diagnostics.distribution(frame, ["a", "b"]))


def test_groups_may_be_null(spark):
    frame = spark.createDataFrame([(None, 1.0), (None, 2.0), ("x", 5.0)], "g string, v double")
    assert {r.g: r.m for r in diagnostics.exact_percentiles(frame, ("g",), "v", {"m": 0.5}).collect()} == {None: 1.5, "x": 5.0}


def against_sql(spark, tmp_path, name, tables):
    """Rows of a query and of its SQL over small tables, as sorted texts."""
    con = duckdb.connect()
    for t, df in tables.items():
        df.coalesce(1).write.parquet(str(tmp_path / f"{t}.parquet"))
        con.sql(f"CREATE VIEW {t} AS FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = QUERIES[name](spark, str(tmp_path))
    want = con.sql(ORACLE_SQL[name])
    order = [want.columns.index(c) for c in got.columns]
    return sorted(str(tuple(r)) for r in got.collect()), sorted(str(tuple(r[i] for i in order)) for r in want.fetchall())


def test_margin_of_symbols_with_long_supplier_keys(spark, tmp_path):
    """Codes of an exchange's file are its own whatever their prefix; keys beyond five digits share a code, of which one row stays."""
    keys = [1, 3, 99, 1005, 9999, 10005, 36003, 100001, 100005, 100011]
    lines = [(k, D[i], 10.0 * k + i, 1.0, 0.1, 0.05, "R") for k in keys for i in (0, 8)]
    lineitem = spark.createDataFrame(lines, "l_suppkey long, l_shipdate date, l_extendedprice double, l_quantity double, l_discount double, l_tax double, l_returnflag string")
    got, want = against_sql(spark, tmp_path, "n5_margin_of_symbols", {"lineitem": lineitem, "supplier": spark.createDataFrame([(k,) for k in keys], "s_suppkey long")})
    assert got == want and len(got) == 2 * 8


def test_actions_of_customers_beyond_six_digits_stay_apart(spark, tmp_path):
    orders = [(i, k, D[i % 3], 100.0 + i) for i, k in enumerate([5, 99999, 100000, 399999, 400000, 400001, 400009, 899999, 5], 1)]
    got, want = against_sql(spark, tmp_path, "n7_corporate_actions", {"orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date, o_totalprice double")})
    assert got == want and len(got) == len(orders)


def test_ranks_take_one_sort_and_suites_one_dealing(spark):
    frame = spark.createDataFrame([(D[i % 2], f"a{i}", v, float(i % 7), float(-i)) for i, v in enumerate([3.0, None, -0.0, 0.0, 3.0, 1.0, 3.0, 2.0, None, 5.0, 1.0, 4.0])], "date date, asset string, v double, l1 double, l2 double")
    ranked = frame.select("date", "v", expr.avg_rank(F.col("v"), "date").alias("r"))
    assert plan(ranked).count("Sort [") == 1
    for d in D[:2]:
        here = [(r.v, r.r) for r in ranked.where(F.col("date") == d).collect()]
        there = [v for v, _ in here if v is not None]
        assert all(r is None if v is None else r == sum(x < v for x in there) + (sum(x == v for x in there) + 1) / 2 for v, r in here)
    assert plan(diagnostics.daily_ic(frame, "v", "l1", "spearman")).count("Sort [") == 2
    suite = plan(run.candidate_suite(frame, {"s": ("v", 1), "t": ("v", -1)}, ["l1", "l2"], q=2))
    assert suite.count("hashpartitioning(signal_name") == 2 and suite.count("Sort [") == 2  # by date, then the summary
    assert plan(diagnostics.decay(frame, "v", ["l1", "l2"])).count("hashpartitioning(horizon") == 2


def test_returns_after_trades_take_a_running_frame(spark):
    rets = spark.createDataFrame([(D[i], "a", 0.01 * i) for i in range(0, 12, 2)] + [(D[3], "b", None)], "date date, asset string, ret_1d double")
    trades = spark.createDataFrame([(D[i], a, k) for i, a, k in ((0, "a", "buy"), (1, "a", "buy"), (4, "a", None), (11, "a", "buy"), (0, "b", "sell"), (3, "b", "sell"))], "date date, asset string, action string")
    got = rebalance.trade_forward_returns(trades, rets, (1,))
    assert "unboundedfollowing" not in plan(rebalance._next_returns(trades, rets, (1,))).lower()
    assert {r.action: (r.n, round(r.median_ret, 9)) for r in got.collect()} == {"buy": (2, 0.02), None: (1, 0.06), "sell": (1, 0.0)}


def test_symbol_partitions_are_dealt_over_tasks(spark):
    """One mode is one join key; its product of specifications and symbols must not be one task's."""
    specs = spark.createDataFrame([(f"s{i}", "symbol", D[0], D[5], ["A", "B"] if i % 2 else []) for i in range(20)], "api_name string, mode string, start date, end date, dimensions array<string>")
    out = grids.expected_partitions(specs, spark.range(3000).select(F.col("id").cast("string").alias("symbol")))
    sizes = [r.n for r in out.where("symbol is not null").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 30 * 3000 == out.select("api_name", "dimension", "symbol").distinct().count() and max(sizes) < 0.6 * sum(sizes)
    landed = out.where("symbol < '001500'")
    assert grids.missing_partitions(out, landed.unionByName(landed)).count() == 30 * 1500
    assert plan(grids.missing_partitions(out, landed)).count("Aggregate") == 2 * plan(out).count("Aggregate")


@pytest.mark.parametrize("some", [300, 1 << 21])
def test_values_of_very_many_rows_are_ranked_by_several_tasks(spark, monkeypatch, some):
    """Constant and heavily tied factors, missing values, infinities and both zeros, over many small ranges and over one."""
    pd = pytest.importorskip("pandas")
    monkeypatch.setattr(run, "SOME", some)
    rng = np.random.default_rng(3)
    n = 900
    table = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 3, n) * 1.0, "c": np.full(n, 5.0), "d": rng.choice([0.0, -0.0, 1.0, -np.inf, np.inf], n)})
    table["e"] = table["a"].where(rng.random(n) < 0.05) * rng.choice([1.0, -0.5], n)
    table.loc[rng.random(n) < 0.4, "b"] = None
    table.loc[(table["b"] == 1.0) | (rng.random(n) < 0.1), "d"] = None
    names = list(table.columns)
    frame = spark.createDataFrame([tuple(None if pd.isna(x) else float(x) for x in r) for r in table.itertuples(index=False)], ", ".join(f"{c} double" for c in names)).repartition(4)
    base = frame.select(F.monotonically_increasing_id().alias("id"), F.array(*names).alias("values")).localCheckpoint()
    tasks = run._tasks(n * 25)
    sizes = [r.n for r in run._pair_ranks(base, 5, tasks).where("f = 2").groupBy("r0").agg(F.count("*").alias("n")).collect()]
    assert sizes == [n] and tasks == (75 if some == 300 else 1)  # one rank for all of the constant factor, whatever ranges it is cut into
    got = {(r.a, r.b): (r.corr, r.n_obs) for r in run.rank_correlation(frame, names).collect()}
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            both = table[[a, b]].dropna()
            flat = both[a].nunique() < 2 or both[b].nunique() < 2
            assert got[a, b][1] == len(both) and got[a, b][0] == (None if flat else pytest.approx(both[a].rank().corr(both[b].rank()), abs=1e-9))


def test_tasks_of_ranks_grow_with_the_table():
    """Tasks hold no more numbers as the table grows, up to the number that a shuffle writes without holding rows, and a bounded number beyond."""
    assert [run._tasks(x) for x in (0, 1, 1 << 21, 10 << 21, 100 << 21, 1 << 30)] == [1, 1, 1, 10, 100, 200]
    assert all(x / run._tasks(x) <= run.MOST for x in (1 << 30, 1 << 34, 1 << 38))


def test_long_windows_are_made_of_short_ones(spark):
    """As by pandas over every window, with missing values, huge and constant ones, zeros and short assets; no frame slides over more than five rows."""
    pd = pytest.importorskip("pandas")
    rng = np.random.default_rng(11)
    rows = []
    for a, n in (("a", 200), ("b", 150), ("c", 90), ("d", 30), ("e", 3)):
        close = 50 * np.exp(np.cumsum(rng.normal(0, 0.05, n))) if a != "c" else 100.0 * 0.99 ** np.arange(n)
        for i in range(n):
            x, missing = float(close[i]), rng.random(4) < 0.01 if a == "b" else [False] * 4
            x *= 1e9 if a == "a" and i == 70 else 1
            amount = 0.0 if a == "d" and i < 25 else 7.3 if a == "e" else float(rng.random() * 1e5)
            rows.append((date(2020, 1, 1) + timedelta(days=i), a, *[None if m else v for m, v in zip(missing, (x, x * 1.1, x * 0.9, amount))], float(rng.random())))
    names = ["date", "asset", "close", "high", "low", "amount", "turnover"]
    frame = spark.createDataFrame(rows, "date date, asset string, close double, high double, low double, amount double, turnover double").repartition(3)
    out = features.technical_liquidity(frame)
    text = plan(out)
    assert text.count("Sort [") == 1 and "RowFrame, -4, currentrow" in text and "RowFrame, -19, currentrow" not in text and "RowFrame, -59, currentrow" not in text
    want = []
    for _, g in pd.DataFrame(rows, columns=names).sort_values(["asset", "date"]).groupby("asset"):
        g = g.astype({c: float for c in names[2:]}).reset_index(drop=True)
        g["r"] = g["close"] / g["close"].shift(1) - 1
        g["neg"], g["illiq"] = g["r"].where(g["r"] < 0), g["r"].abs() / g["amount"].where(g["amount"] > 0)
        # each window by itself, since a sliding sum keeps the error of a huge value
        at = lambda c, k, f: pd.Series([f(g[c].iloc[i - k + 1 : i + 1].to_numpy()) if i >= k - 1 else np.nan for i in range(len(g))])
        o = g[["date", "asset"]].copy()
        for k in (5, 20, 60):
            o[f"ret_{k}d"] = g["close"] / g["close"].shift(k) - 1
        for k in (20, 60):
            o[f"momentum_{k}d"] = o[f"ret_{k}d"]
            o[f"realized_vol_{k}d"], o[f"downside_vol_{k}d"] = at("r", k, lambda x: x.std(ddof=1)), at("neg", k, lambda x: x.std(ddof=1))
            o[f"max_drawdown_{k}d"], o[f"amount_mean_{k}d"] = g["close"] / at("close", k, np.max) - 1, at("amount", k, np.mean)
            o[f"turnover_mean_{k}d"], o[f"amihud_illiquidity_{k}d"] = at("turnover", k, np.mean), at("illiq", k, np.mean)
            o[f"high_low_range_{k}d"], o[f"close_to_high_{k}d"] = at("high", k, np.max) / at("low", k, np.min) - 1, g["close"] / at("high", k, np.max) - 1
        for k in (5, 20):
            o[f"reversal_{k}d"] = -o[f"ret_{k}d"]
        for x in ("amount", "turnover"):
            with np.errstate(all="ignore"):
                o[f"{x}_shock_5d_vs_20d"] = at(x, 5, np.mean) / at(x, 20, np.mean)
        want.append(o)
    want = pd.concat(want).reset_index(drop=True)
    got = pd.DataFrame([r.asDict() for r in out.orderBy("asset", "date").collect()])
    assert set(got.columns) == set(want.columns) and len(got) == len(want) and (got["asset"] == want["asset"]).all()
    for c in want.columns[2:]:
        x, y = got[c].astype(float).to_numpy(), want[c].to_numpy()
        assert (np.isnan(x) == np.isnan(y)).all() and np.allclose(x, y, rtol=1e-9, atol=1e-12, equal_nan=True), c
        assert np.isfinite(y).any()
    assert {r.realized_vol_20d for r in features.technical_liquidity(frame.withColumn("close", F.lit(0.1))).where("realized_vol_20d is not null").collect()} == {0.0}


def test_factors_are_compiled_methods(spark):
    """The JVM interprets methods of over 8,000 bytes, several times as slowly; no generated one of the query is that long."""
    frame = spark.createDataFrame([(D[0], "a", 1.0, 1.0, 1.0, 1.0, 1.0)], "date date, asset string, close double, high double, low double, amount double, turnover double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = registry.even(features.technical_liquidity(frame), ["date", "asset"], registry._TC)
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        code = debug.codegenStringSeq(out._jdf.queryExecution().executedPlan())
        assert code.size() > 2 and max(code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
