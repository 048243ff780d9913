"""Hand-worked cases of the panel operators."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom.operators import checks, diagnostics, features, lake, portfolio, rebalance, signals, universe
from paneloom.sources import panel

D = [date(2024, 1, 1) + timedelta(days=i) for i in range(40)]


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_features(spark):
    closes = [10.0, 10.5, 10.0, 11.0, 11.0, 12.0]
    panel = spark.createDataFrame([(D[i], "a", c, 100.0 + 5 * i, 1e6) for i, c in enumerate(closes)], "date date, asset string, close double, amount double, market_cap double")
    out = features.compute_features(panel, ["ret_1d", "fwd_ret_5d", "turnover_5d"]).orderBy("date").collect()
    assert out[1].ret_1d == pytest.approx(0.05)
    assert out[0].fwd_ret_5d == pytest.approx(0.2)
    assert out[4].turnover_5d == pytest.approx(110.0)
    with pytest.raises(KeyError):
        features.compute_features(panel, ["nothing"])


def test_no_look_ahead(spark):
    panel = spark.createDataFrame([(D[i], "a", 10.0 + (i * 7) % 5, 11.0 + (i * 7) % 5, 9.0, 100.0 + i, 1.0 + i) for i in range(30)], "date date, asset string, close double, high double, low double, amount double, turnover double")
    whole = {r.date: r for r in features.technical_liquidity(panel).collect()}
    for r in features.technical_liquidity(panel.where(F.col("date") <= D[24])).collect():
        assert r == whole[r.date]


def test_ic_and_quantiles(spark):
    frame = spark.createDataFrame([(D[0], "a", 1.0, 0.1), (D[0], "b", 2.0, 0.2), (D[1], "a", 1.0, -0.1), (D[1], "b", 2.0, -0.2), (D[2], "a", 1.0, 1.0), (D[2], "b", 1.0, 2.0)], "date date, asset string, signal double, ret double")
    assert [r.ic for r in diagnostics.daily_ic(frame, "signal", "ret").orderBy("date").collect()] == [pytest.approx(1.0), pytest.approx(-1.0), None]
    ranks = frame.select("date", "asset", signals.rank(F.col("signal")).alias("r"))
    assert [r.r for r in ranks.where(F.col("date") == D[0]).orderBy("asset").collect()] == [0.5, 1.0]


def test_portfolio(spark):
    frame = spark.createDataFrame([(D[0], a, s, 1e6, g) for a, s, g in (("a", 4.0, 1), ("b", 3.0, 1), ("c", 2.0, 2), ("d", 1.0, None))], "date date, asset string, signal double, market_cap double, grp int")
    w = {r.asset: r.weight for r in portfolio.build_top_n(frame, 3, max_weight=0.6, group_cap=0.5).collect()}
    assert sum(w.values()) == pytest.approx(1.0) and w["d"] == 0.0 and w["a"] == w["b"]
    held = portfolio.hold_between(spark.createDataFrame([(D[0], "a", 1.0), (D[20], "a", 0.5), (D[29], "b", 1.0)], "date date, asset string, weight double"), "M")
    assert rows(held, "date", "asset", "weight")[-2:] == [(D[29], "a", 0.0), (D[29], "b", 1.0)]
    moves = portfolio.turnover(spark.createDataFrame([(D[0], "a", 1.0), (D[1], "b", 1.0)], "date date, asset string, weight double"))
    assert rows(moves, "date", "turnover") == [(D[0], 1.0), (D[1], 2.0)]
    with pytest.raises(ValueError):
        portfolio.cost_rate(-1)


def test_buffered_policy(spark):
    c = rebalance.BufferedConfig(2, 2, 3, 1, 2, max_weight=None, min_trade_weight=0.0)
    day1 = [(D[0], a, -float(r), r, True) for r, a in enumerate("abcd", 1)]
    day2 = [(D[7], "c", -1.0, 1, True), (D[7], "d", -2.0, 2, True), (D[7], "a", -3.0, 3, True), (D[7], "b", -4.0, 4, True)]
    day3 = [(D[14], "c", -1.0, 1, True), (D[14], "a", -4.0, 4, False)]
    sig = spark.createDataFrame(day1 + day2 + day3, "date date, asset string, score double, rank int, is_tradable boolean")
    out = {(r.date, r.asset): (r.weight, r.reason, r.action) for r in rebalance.buffered_weights(sig, {"p": c}).collect()}
    assert out[D[0], "a"] == (0.5, "", "buy") and out[D[0], "b"] == (0.5, "", "buy") and out[D[0], "d"] == (0.0, "", "keep")
    assert out[D[7], "a"] == (1.0, "in_buffer_zone", "add") and out[D[7], "b"] == (0.0, "sell_rank_exceeded", "sell")
    assert out[D[14], "a"] == (1.0, "not_tradable", "keep") and len(out) == 10
    for bad in ({"buy_rank": 5, "sell_rank": 3}, {"freq": "Q"}, {"max_weight": 0.0}, {"cost_bps": -1.0}):
        with pytest.raises(ValueError):
            rebalance.BufferedConfig(**{"target_n": 2, "buy_rank": 2, "sell_rank": 3, "min_holding_n": 1, "max_holding_n": 2} | bad)


@pytest.mark.parametrize("change", [{}, {"min_trade_weight": 0.08}, {"require_tradable_for_sell": False}, {"require_tradable_for_buy": False, "max_weight": 0.2}])
def test_buffered_policy_sees_all_it_can_use(spark, change):
    """Random signals with gaps and untradable names: the pruned recursion gives what a recursion over every row gives."""
    rng = np.random.default_rng(2)
    c = rebalance.BufferedConfig(**{"target_n": 6, "buy_rank": 5, "sell_rank": 9, "min_holding_n": 4, "max_holding_n": 7, "max_weight": None, "min_trade_weight": 0.01, "freq": "D"} | change)
    rows = []
    for d in D[:25]:
        names = [a for a in range(30) if rng.random() < 0.8]
        rows += [(d, f"a{a}", -float(i), i, bool(rng.random() < 0.7)) for i, a in enumerate(rng.permutation(names), 1)]
    book, want = {}, {}
    for d in D[:25]:
        book, _ = rebalance._next_book({r[1]: (r[3], r[2], r[4]) for r in rows if r[0] == d}, book, c)
        want |= {(d, a): w for a, w in book.items()}
    got = rebalance.buffered_weights(spark.createDataFrame(rows, "date date, asset string, score double, rank int, is_tradable boolean"), {"p": c}).collect()
    assert {(r.date, r.asset): r.weight for r in got if r.weight} == pytest.approx(want) and len(got) >= len(rows)
    signals = spark.createDataFrame(rows, "date date, asset string, score double, rank int, is_tradable boolean")
    assert rebalance._reachable(signals.withColumn("portfolio_id", F.lit("p")), c).count() < len(rows)


def test_illiquid_rows_keep_a_weight_of_zero(spark):
    rows = [(D[0], "a", 3.0, 5.0), (D[0], "b", 2.0, 5.0), (D[31], "a", 3.0, 0.0), (D[31], "b", 2.0, 5.0)]
    frame = spark.createDataFrame(rows, "date date, asset string, signal double, liquidity double")
    weights = portfolio.build_top_n(frame, 1, min_liquidity=1.0)
    assert {(r.date, r.asset): r.weight for r in weights.collect()} == {(D[0], "a"): 1.0, (D[0], "b"): 0.0, (D[31], "a"): 0.0, (D[31], "b"): 1.0}
    assert {(r.date, r.asset): r.weight for r in portfolio.hold_between(weights, "M").where("date = '%s'" % D[31]).collect()} == {(D[31], "a"): 0.0, (D[31], "b"): 1.0}


def test_trades_and_holdings(spark):
    rets = spark.createDataFrame([(D[0], "a", 0.5), (D[1], "a", 0.1), (D[2], "a", 0.1)], "date date, asset string, ret_1d double")
    trades = spark.createDataFrame([(D[0], "a", "buy"), (D[2], "a", "buy")], "date date, asset string, action string")
    got = rebalance.trade_forward_returns(trades, rets, (2,)).first()
    assert got.n == 1 and got.mean_ret == pytest.approx(0.21)
    held = spark.createDataFrame([(D[i], "a", w) for i, w in enumerate((1.0, 1.0, 1.0, 0.0, 1.0))], "date date, asset string, weight double")
    assert sorted(r.n_dates for r in rebalance.holding_periods(held).collect()) == [1, 3]


def test_universe(spark):
    snaps = spark.createDataFrame([(D[0], "a"), (D[10], "b")], "snapshot_date date, asset string")
    frame = spark.createDataFrame([(D[i], a) for i in (0, 5, 10, 15) for a in "ab"], "date date, asset string")
    assert rows(universe.pit_mask(frame, snaps), "date", "asset") == [(D[0], "a"), (D[5], "a"), (D[10], "b"), (D[15], "b")]
    bars = spark.createDataFrame([(D[0], "a", 1.0, 2.0, 0.5, 1.5, 10.0, 10.0), (D[1], "a", 1.0, 2.0, 0.5, 1.5, 0.0, 10.0), (D[2], "a", 1.0, 1.2, 0.5, 1.5, 10.0, 10.0), (D[3], "a", None, 2.0, 0.5, 1.5, 10.0, 10.0)], "date date, asset string, open double, high double, low double, close double, volume double, amount double")
    assert [r.tradable for r in universe.tradability(bars).orderBy("date").collect()] == [True, False, False, False]


def test_lake_and_checks(spark):
    old = spark.createDataFrame([("x", 20.0), ("y", None), ("z", 1.0)], "k string, v double")
    new = spark.createDataFrame([("x", 21.0), ("y", None), ("w", 2.0)], "k string, v double")
    r = lake.merge_report(old, new, ["k"]).first()
    assert (r.old_only, r.new_only, r.identical, r.conflict, r.status) == (1, 1, 1, 1, "BLOCKED")
    twice = lake.merge_report(old, new.where("k = 'w'").unionByName(new.where("k = 'w'")), ["k"]).first()
    assert (twice.new_only, twice.duplicate_keys, twice.status) == (1, 2, "BLOCKED")
    assert lake.merge_report(old, new, ["gone"]).first().status == "BLOCKED"
    with pytest.raises(ValueError, match="blocked"):
        lake.keyed_merge(old, new, ["k"], checked=True)
    assert rows(lake.keyed_merge(old, new, ["k"]), "k") == [("w",), ("x",), ("y",), ("z",)]
    parts = spark.createDataFrame([({"trade_date": "20240105"},), ({"snapshot": "20240105", "year": "2023"},), ({"start_date": "20230101", "end_date": "20240101"},), ({"a": "b"},)], "partition map<string,string>")
    assert [x.b for x in parts.select(lake.partition_bucket().alias("b")).collect()] == ["year=2024", "snapshot=20240105", "window=20230101_20240101", "scope=all"]
    with pytest.raises(ValueError):
        checks.check_factor_columns(spark.createDataFrame([(1.0,)], "fwd_ret_5d double"))


def test_nan_is_missing_at_scans(spark, tmp_path):
    lines = [(1, 1, 1, date(2024, 1, 2), 2.0, 10.0), (2, 1, 1, date(2024, 1, 3), float("nan"), 30.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber long, l_suppkey long, l_shipdate date, l_quantity double, l_extendedprice double").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 5.0, 2)], "s_suppkey long, s_acctbal double, s_nationkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    row = panel.daily_panel(spark, str(tmp_path)).first()
    assert (row.volume, row.high, row.low) == (2.0, 5.0, 5.0) and row.amount == 40.0
