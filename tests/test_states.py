"""States that continue an indicator, stored layers that change in part, guards, routes and the worksheet."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.functions import kernels as K
from barloom.functions import recursion as R
from barloom.operators import bars as B
from barloom.operators import gate as G
from barloom.operators import incremental as N
from barloom.operators import indicators as M
from barloom.operators import ingest as I
from barloom.operators import quality as Q
from barloom.operators import structure as X
from barloom.sources import store

DAYS = [f"20{y:02d}{m:02d}{d:02d}" for y in (1, 2) for m in range(1, 13) for d in range(1, 29)]


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def walks(spark):
    """Closes and flows of instruments of unlike lengths, with unknown flows and market values."""
    r, rows = random.Random(8), []
    for code, n in (("A", 400), ("B", 350), ("C", 12), ("D", 320), *((c, 400) for c in "EFGHIJKL")):
        x = 50.0
        for k, d in enumerate(DAYS[:n]):
            x = max(5.0, x + r.gauss(0, 1) + 2 * math.sin(k / 9))
            big = round(math.sin(k / 7 + len(code)) * 40 + r.gauss(0, 10), 2)
            rows.append((code, d, x, 100.0, max(big, 0.0), 0.0, max(-big, 0.0), 0.0, None if k % 53 == 0 else 200.0, big, None if k < 30 else big * 0.9, None if k % 7 == 0 else 1000.0, 2000.0))
    schema = "ts_code string, trade_date string, close_qfq double, vol double, buy_lg_vol double, buy_elg_vol double, sell_lg_vol double, sell_elg_vol double, total_vol double, net_mf_amount double, net_amount_dc double, circ_mv double, total_mv double"
    return store.staged(spark.createDataFrame(rows, schema))


def values(df, *columns):
    cols = columns or sorted(df.columns)
    return sorted((tuple(round(x, 9) + 0.0 if isinstance(x, float) else x for x in (r[c] for c in cols)) for r in df.collect()), key=repr)


def parts(d):
    """Money flow and quotes."""
    return d.drop("circ_mv", "total_mv"), d.select("ts_code", "trade_date", "close_qfq", "circ_mv", "total_mv")


CUTS = (DAYS[290], DAYS[291], DAYS[310])


def test_appends_one_after_another_equal_a_full_run(walks):
    """Three appends, of one bar and of several, give the rows and the state of a run over all bars."""
    upto = lambda d: walks.where(F.col("trade_date") <= d)
    runs = {
        "macd": (M.macd, M.macd_state, M.continue_macd),
        "dde": (lambda d: M.dde(*parts(d)), lambda d: M.dde_state(*parts(d)), lambda d, s: M.continue_dde(*parts(d), s)),
    }
    for full, first, onward in runs.values():
        state = store.staged(first(upto(CUTS[0])))
        found = []
        for d in (*CUTS[1:], DAYS[-1]):
            rows, state = onward(upto(d), state)
            found += values(rows)
            state = store.staged(state)
        want = full(walks).where((F.col("trade_date") > CUTS[0]) & (F.col("ts_code") != "C"))
        assert sorted(found, key=repr) == values(want) and found
        assert values(state.drop("recent")) == values(first(walks).drop("recent"))


@pytest.mark.parametrize("flow, cut", [(False, DAYS[133]), (True, DAYS[171])])
def test_structure_goes_on_from_its_open_segments(walks, flow, cut):
    close = walks.select("ts_code", "trade_date", F.col("close_qfq").alias("close"))
    lines = store.staged(M.macd(walks).join(close, ["ts_code", "trade_date"]) if not flow else X.flow_lines(M.dde(*parts(walks)), walks))
    want = values(X.divergence_events(lines, flow).where("ts_code != 'C'"))
    assert len(want) > 10
    state = store.staged(X.structure_state(lines.where(F.col("trade_date") <= cut), flow))
    found = [x for x in want if x[4] <= cut]
    for d in (DAYS[172], DAYS[250], DAYS[-1]):
        rows, state = X.continue_structure(lines.where(F.col("trade_date") <= d), state, flow)
        state = store.staged(state)
        found += values(rows.where("ts_code != 'C'"))
    assert sorted(found, key=repr) == want


def test_an_append_reads_new_bars_only(spark, walks, tmp_path):
    walks.write.parquet(f"{tmp_path}/bars")
    bars = spark.read.parquet(f"{tmp_path}/bars")
    rows, _ = M.continue_macd(bars, store.staged(M.macd_state(bars.where(F.col("trade_date") <= DAYS[300]))))
    assert f"GreaterThan(trade_date,{DAYS[300]})" in plan(rows)  # the earliest state's date reaches the scan


def test_guard_names_the_key(spark):
    bars = spark.createDataFrame([("A", "1"), ("A", "2"), ("B", "1")], "ts_code string, trade_date string")
    rows = bars.withColumn("v", F.lit(1))
    assert N.guarded(rows, bars).count() == 3
    cases = {
        "repeated new bar A 2": (rows, bars.union(bars.where("trade_date = '2'"))), "new bar without a result B 1": (rows.where("ts_code = 'A'"), bars),
        "result without a new bar B 1": (rows, bars.where("ts_code = 'A'")), "repeated result A 1": (rows.union(rows.where("ts_code = 'A' and trade_date = '1'")), bars),
    }
    for message, (r, b) in cases.items():
        with pytest.raises(Exception, match=message):
            N.guarded(r, b).collect()


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_merge_and_remove_rewrite_only_what_they_touch(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(c, f"{y}0101", 1.0) for c in "ABCDEFGH" for y in (2001, 2002, 2003)], "ts_code string, trade_date string, v double")
    store.put(rows, path, 4)
    was = files(path)
    change = spark.createDataFrame([("A", "20030101", 2.0), ("A", "20030102", 3.0), ("Z", "19990101", 4.0)], rows.schema)
    for _ in range(2):  # the second time changes nothing
        store.merge(spark, path, change, 4)
        got = {(r.ts_code, r.trade_date): r.v for r in store.stored(spark, path).collect()}
        assert len(got) == 26 and got["A", "20030101"] == 2.0 and got["A", "20030102"] == 3.0 and got["Z", "19990101"] == 4.0 and got["B", "20030101"] == 1.0
    assert sum(f in was and was[f] == t for f, t in files(path).items()) == len(was) - 1  # one partition rewritten, one added
    store.merge(spark, path, change.limit(0), 4)
    assert store.stored(spark, path).count() == 26
    gone = spark.createDataFrame([("Z", "19990101"), ("A", "20030101"), ("Q", "20010101")], "ts_code string, trade_date string")
    assert [store.remove(spark, path, gone, 4) for _ in range(2)] == [2, 0]
    assert store.stored(spark, path).count() == 24 and not [f for f in files(path) if "year=1999" in f]


@pytest.fixture(scope="module")
def market(spark):
    """Raw rows: A changes its factor on the last day, B is calm and trades again after a gap, C is new, D has a stale close."""
    days = ["20240102", "20240103", "20240104", "20240105", "20240108", "20240109", "20240110"]
    have = {"A": days, "B": days[:4] + days[6:], "C": days[6:], "D": days}
    rows = [(c, d, *[10.0 + k + ord(c) % 5] * 4, 100.0, 1000.0, 0.0, 2.0 if c == "A" and d == days[6] else 1.0) for c, ds in have.items() for k, d in enumerate(ds)]
    daily = spark.createDataFrame(rows, "ts_code string, trade_date string, open double, high double, low double, close double, vol double, amount double, pct_chg double, adj_factor double")
    basic = daily.select("ts_code", "trade_date", *[F.lit(1.0).alias(c) for c in B.VALUES])
    flow = daily.select("ts_code", "trade_date", *[F.col("vol").alias(c) for c in ("net_mf_vol", "net_mf_amount", "net_amount_dc", *[f"{s}_{z}_vol" for s in ("buy", "sell") for z in ("sm", "md", "lg", "elg")])])
    cal = spark.createDataFrame([(d, 1, k + 1) for k, d in enumerate(days)], "cal_date string, is_open int, day_idx int")
    return days, daily, basic, flow, cal


def test_refreshed_layers_equal_a_rebuild(spark, market, tmp_path):
    days, daily, basic, flow, cal = market
    past = daily.where(F.col("trade_date") < days[6])
    bars = B.fill_suspensions(B.adjusted_bars(past, basic), past, cal)
    bars = store.staged(bars.withColumn("close_qfq", F.when((F.col("ts_code") == "D") & (F.col("trade_date") == days[1]), 99.0).otherwise(F.col("close_qfq"))))
    paths = [f"{tmp_path}/{n}" for n in ("quotes", "weekly", "flows")]
    for path, rows in zip(paths, (bars, B.weekly_bars(bars), B.daily_moneyflow(flow.where(F.col("trade_date") < days[6])))):
        store.put(rows, path, 8)
    want = B.fill_suspensions(B.adjusted_bars(daily, basic), daily, cal)
    routes = {(r.ts_code, r.trade_date): r.route for r in B.rebuild_incremental(bars, daily, basic, cal, days[6]).collect()}
    assert {c: {r for (code, _), r in routes.items() if code == c} for c in "ABCD"} == {"A": {"full"}, "B": {"kept", "tail"}, "C": {"full"}, "D": {"full"}}
    assert routes["B", days[4]] == "tail" and routes["B", days[3]] == "kept"
    for _ in range(2):
        B.refresh_layers(spark, *paths, daily, basic, flow, cal, days[6], 8)
        for path, rows in zip(paths, (want, B.weekly_bars(want), B.daily_moneyflow(flow))):
            assert values(store.stored(spark, path).select(sorted(rows.columns))) == values(rows)


def test_a_refresh_takes_in_what_is_not_stored_and_drops_what_is_left_out(spark, market, tmp_path):
    days, daily, basic, flow, cal = market
    daily = daily.where(~((F.col("ts_code") == "B") & (F.col("trade_date") == days[6])))  # B is not stored and has no row on the day
    last = (F.col("ts_code") == "A") & (F.col("trade_date") == days[6])
    daily = daily.withColumn("adj_factor", F.when(~last, F.col("adj_factor")))  # A has no factor on the day
    past = daily.where(F.col("trade_date") < days[6])
    bars = store.staged(B.fill_suspensions(B.adjusted_bars(past, basic), past, cal).where("ts_code <> 'B'"))
    paths = [f"{tmp_path}/{n}" for n in ("quotes", "weekly", "flows")]
    for path, rows in zip(paths, (bars, B.weekly_bars(bars), B.daily_moneyflow(flow.where(F.col("trade_date") < days[6])))):
        store.put(rows, path, 8)
    want = B.fill_suspensions(B.adjusted_bars(daily, basic), daily, cal)
    assert {r.ts_code for r in want.collect()} == set("BCD")
    assert values(B.rebuild_incremental(bars, daily, basic, cal, days[6]).select(sorted(want.columns))) == values(want)
    for _ in range(2):
        B.refresh_layers(spark, *paths, daily, basic, flow, cal, days[6], 8)
        for path, rows in zip(paths, (want, B.weekly_bars(want), B.daily_moneyflow(flow))):
            assert values(store.stored(spark, path).select(sorted(rows.columns))) == values(rows)


def test_weeks_are_repaired_once(spark, tmp_path):
    days = ["20240104", "20240105", "20240108", "20240109", "20240112", "20240115"]
    marks = [1, 0, 0, 1, 1, 1]  # the 4th and the 9th wrongly, the 5th not
    dim = spark.createDataFrame([(d, x, k) for k, (d, x) in enumerate(zip(days, marks))], "trade_date string, is_week_end int, day_idx int")
    dim.write.parquet(f"{tmp_path}/dim")
    results = spark.createDataFrame([(c, d, 1.0) for c in "AB" for d in days if d != "20240108"], "ts_code string, trade_date string, v double")
    store.put(results, f"{tmp_path}/ma", 4)
    store.put(results.where("trade_date in ('20240112')"), f"{tmp_path}/dde", 4)
    spark.createDataFrame([("A", "weekly", 1), ("A", "daily", 1)], "ts_code string, freq string, n int").write.partitionBy("freq").parquet(f"{tmp_path}/states")
    report = [tuple(r) for r in B.repair_report(dim, {"ma": results}).collect()]
    assert sorted(report) == sorted([("wrongly_marked", "dim_date", "20240104", 1), ("wrongly_marked", "dim_date", "20240109", 1), ("newly_marked", "dim_date", "20240105", 1), ("orphan", "ma", "20240104", 2), ("orphan", "ma", "20240109", 2)])
    run = lambda: B.repair_weekly(spark, f"{tmp_path}/dim", {"ma": f"{tmp_path}/ma", "dde": f"{tmp_path}/dde"}, f"{tmp_path}/states", 4)
    assert run() == {"dim_date": 3, "ma": 4, "dde": 0}
    assert {r.trade_date: r.is_week_end for r in spark.read.parquet(f"{tmp_path}/dim").collect()} == dict(zip(days, [0, 1, 0, 0, 1, 1]))
    assert {r.trade_date for r in store.stored(spark, f"{tmp_path}/ma").collect()} == {"20240105", "20240112", "20240115"}
    assert [r.freq for r in spark.read.parquet(f"{tmp_path}/states").collect()] == ["daily"]
    assert run() == {"dim_date": 0, "ma": 0, "dde": 0}


def test_slopes_of_what_a_window_has(spark):
    x = [None, 0.0, 5.0, 7.0, None, 9.0, 4.0, 3.0, 0.0, 6.0, 2.0, 8.0, None, None, None, None]
    d = spark.createDataFrame([("A", f"{k:03d}", v) for k, v in enumerate(x)], "ts_code string, trade_date string, x double").withColumn("rn", K.rn())
    got = d.select("trade_date", K.masked_slope("x", 4).alias("s"), K.masked_slope("x", 4, True).alias("l"), K.compacted_strength("x", 8, 0.2).alias("c")).orderBy("trade_date").collect()
    for k, r in enumerate(got):
        for have, log in ((r.s, False), (r.l, True)):
            at = [(j, np.log(x[j]) if log else x[j]) for j in range(max(0, k - 3), k + 1) if x[j] is not None and (x[j] > 0 or not log)]
            assert have == pytest.approx(np.polyfit(*zip(*at), 1)[0] if len(at) > 1 else 0.0, abs=1e-9)
        y = [np.log(v) for v in x[max(0, k - 7) : k + 1] if v]
        if k < 7 or len(y) < 5:
            assert r.c is None
        else:
            m = np.arange(len(y))
            assert r.c == pytest.approx(np.polyfit(m, y, 1, w=np.exp(m * 0.2))[0] / np.mean(np.abs(y)))


def test_worksheet_round_trip_reports_bad_rows(spark, tmp_path):
    events = spark.createDataFrame([("A", "20240102", "top_divergence"), ("B", "20240103", "bottom_divergence")], "ts_code string, trade_date string, label string")
    path = f"{tmp_path}/sheet"
    G.write_worksheet(G.candidates(events, "daily").coalesce(1), path)
    name = next(f for f in os.listdir(path) if f.endswith(".csv"))
    head, *lines = open(f"{path}/{name}").read().splitlines()
    assert head == ",".join(G.SHEET_COLUMNS) and len(lines) == 2
    out = f"{tmp_path}/filled"
    os.mkdir(out)
    rows = ["A,daily,20240102,top_divergence,2024-01-02, TOP_divergence ,seen", "B,daily,20240103,bottom_divergence,-,n/a,", "C,daily,,,20240230,top_divergence,", "D,daily,,,20240105,,", "E,daily,,,20240105,sideways,", "F,daily,,,,top_divergence,", "G,daily,a,b,c,d,e,f,g"]
    open(f"{out}/x.csv", "w").write("\n".join([head, *rows]) + "\n")
    good, bad = G.read_worksheet(spark, out)
    assert [tuple(r) for r in good.collect()] == [("A", "20240102", "daily", "top_divergence")]
    assert {r.ts_code: r.why for r in bad.collect()} == {"C": "no date", "D": "date without a label", "E": "no label", "F": "label without a date", "G": "unreadable row"}


def test_skip_log_batches_and_repeats(spark):
    rows = [("20240102", f"S{k}", "macd", "daily", "fingerprint_match", "x") for k in range(5)] + [("20240102", f"S{k}", "ma", "daily", "fingerprint_match" if k else "no_dwd_data", "x") for k in range(5)]
    skips = spark.createDataFrame(rows, "calc_date string, ts_code string, indicator string, freq string, reason string, detail string")
    new = Q.skip_log(skips, most=4)
    got = sorted((r.indicator, r.ts_code, r.detail) for r in new.collect())
    assert got == [("ma", f"S{k}", "x") for k in range(5)] + [("macd", "__batch__", "batch_skip=5")]
    log = Q.log_skips(new.limit(0), new)
    assert sorted(map(tuple, Q.log_skips(log, new).collect())) == sorted(map(tuple, log.collect()))


def test_missing_days_of_an_instrument_without_rows(spark):
    cal = spark.createDataFrame([("20240101", 0, None)] + [(f"2024010{k}", 1, k) for k in range(2, 8)], "cal_date string, is_open int, day_idx int")
    codes = spark.createDataFrame([("A",), ("B",), ("C",)], "ts_code string")
    rows = spark.createDataFrame([("A", "20240103"), ("A", "20240103"), ("A", "20240106"), ("C", "20240102"), ("C", "20240107"), ("X", "20240104")], "ts_code string, trade_date string")
    got = I.missing_days(codes, rows, cal, "20240103", "20240106")
    assert sorted((r.ts_code, r.day_idx) for r in got.collect()) == [("A", 4), ("A", 5), *[("B", k) for k in range(3, 7)], *[("C", k) for k in range(3, 7)]]
    assert I.missing_days(codes, rows, cal, "20250101", "20250102").count() == 0 and "CartesianProduct" not in plan(got)


def test_windows_of_a_clustered_layer_need_no_exchange(spark, walks):
    table = store.layer(spark, "test", "clustered", lambda: walks, "ts_code")
    for df in (M.moving_averages(store.load(table, DAYS[20])), M.volume(table), M.candlesticks(table.withColumns({c: F.col("close_qfq") for c in ("open_qfq", "high_qfq", "low_qfq", "pct_chg")}), table.select("ts_code", F.lit(0).alias("is_st")).limit(1))):
        assert "hashpartitioning(ts_code" not in plan(df)
    tree = plan(M.macd(table)).split("(1) ")[0]
    assert tree.count("Exchange") == 1 and tree.index("Exchange") < tree.index("MapInArrow")  # behind the map, whose rows Spark does not know to be clustered
    assert f"GreaterThanOrEqual(trade_date,{DAYS[20]})" in plan(M.moving_averages(store.load(table, DAYS[20])))
    codes = spark.createDataFrame([("A",)], "ts_code string")
    assert {r.ts_code for r in store.load(table, DAYS[300], codes).collect()} == {"A"}


def test_partitions_grow_with_the_largest_table(spark, monkeypatch):
    key = "spark.sql.shuffle.partitions"
    monkeypatch.setattr(store, "ROWS", 100)
    own = spark.conf.get(key)
    try:
        for source, n, want in (("size-a", 1001, 11), ("size-b", 5, int(own)), ("size-a", 0, 11)):  # counted once a session
            store.size_shuffles(spark, source, lambda: spark.range(n))
            assert int(spark.conf.get(key)) == want and store.dealt(spark.range(3), "id").rdd.getNumPartitions() == want
        spark.conf.set(key, "7")  # somebody else's number is the one to go by
        store.size_shuffles(spark, "size-b", lambda: spark.range(5))
        assert spark.conf.get(key) == "7"
    finally:
        spark.conf.set(key, own)


def test_weeks_and_structures_take_windows_that_run_one_way(spark, walks):
    """A frame that ends with the last row is summed anew for every row, and each order of rows is a sort of its own."""
    dim = walks.select("trade_date").distinct().selectExpr("trade_date", "cast(substring(trade_date, 7, 2) in ('07', '14', '21', '28') as int) is_week_end", "cast(substring(trade_date, 3, 6) as int) day_idx")
    flow = walks.selectExpr("ts_code", "trade_date", "0.0 net_mf_vol", "net_mf_amount", "buy_lg_vol", "sell_lg_vol", "buy_elg_vol", "sell_elg_vol", "total_vol", "net_amount_dc")
    weeks = B.weekly_moneyflow(flow, walks.select("ts_code", "trade_date"), dim, walks)
    trends = M.weekly_flow_trend(M.flow_frame(flow, walks.withColumn("is_suspended", F.lit(0))), weeks.select("ts_code", F.col("week_end").alias("trade_date")))
    for d in (weeks, trends):
        frames = [w.split("specifiedwindowframe(")[1] for w in plan(d).split("windowspecdefinition(")[1:] if "specifiedwindowframe(" in w]
        assert not [f for f in frames if f.split(")")[0].replace("$", "").startswith(("RowFrame, currentrow", "RangeFrame, currentrow"))]
    lines = walks.select("ts_code", "trade_date", F.col("close_qfq").alias("close"), F.col("net_mf_amount").alias("dif"), F.lit(0.0).alias("dea"), F.col("net_mf_amount").alias("macd_bar"))
    assert plan(X.tops(lines)).split("(1) ")[0].count("Sort") <= 3


def test_clustered_layers_meet_by_instrument_and_date_without_an_exchange(spark, walks):
    store.size_shuffles(spark, "size-keys", lambda: spark.range(1))
    a, b = (store.layer(spark, "test", f"keys_{n}", lambda: walks, "ts_code") for n in "ab")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = a.join(b.select("ts_code", "trade_date", F.col("vol").alias("v")), ["ts_code", "trade_date"])
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined) and " Sort (" not in plan(joined).split("(1) ")[0] and joined.count() == walks.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_trades_are_dealt_once_for_bars_valuations_and_money_flow(spark, tmp_path):
    from datetime import datetime

    from barloom.sources import market as S

    rows = [(o, n, 1 + o % 2, s, 5.0 * n, 100.25 * o + n, "O", datetime(1999, 6, d)) for o in range(1, 9) for n in (1, 2) for s in (7, 250) for d in (14, 15, 16)]
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "Brand#7", "t"), (2, "Brand#8", "t")], "p_partkey long, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    trades = S.trades(spark, str(tmp_path), store.staged(S.trade_cal(spark, str(tmp_path))))
    raw = S.ods(trades)
    exchanges = [line for line in plan(raw).splitlines() if line.startswith("Arguments: hashpartitioning(")]
    assert not [line for line in exchanges if "ts_code" in line and "trade_date" in line]
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "px")
    want = trades.groupBy("trade_date").agg(F.min_by("px", order).alias("open"), F.max_by("px", order).alias("close"), F.sum("l_quantity").alias("vol"), F.round(F.sum("l_extendedprice"), 2).alias("amount"))
    index = raw.where(F.col("ts_code") == S.INDEX)
    assert values(index.select("trade_date", "open", "close", "vol", "amount")) == values(want)
    flows = S.ods_moneyflow(raw)
    assert flows.count() == 3 * 4 and flows.where("net_mf_vol is null").count() == 0 and index.where("net_mf_vol is not null").count() == 0


@pytest.mark.parametrize("flow", [False, True])
def test_events_and_states_of_structures_come_from_one_pass(walks, flow):
    lines = store.staged(walks.select("ts_code", "trade_date", F.col("close_qfq").alias("close"), F.col("net_mf_amount").alias("dif"), F.lit(0.0).alias("dea"), F.col("net_mf_amount").alias("macd_bar")))
    state = store.staged(X.structure_state(lines.where(F.col("trade_date") <= DAYS[171]), flow))
    events, moved = X.continue_structure(lines, state, flow)
    for df in (X.divergence_events(lines, flow), X.structure_state(lines, flow), events, moved):
        tree = plan(df).split("(1) ")[0]
        assert tree.count("Union") == 0
        assert sum(1 for line in plan(df).splitlines() if line.startswith("ReadSchema") and "macd_bar" in line) == 1  # the lines are read once for both signs


def test_a_state_takes_the_last_bars_of_a_series_only(walks):
    run = lambda **more: R.over_series(walks, ["close_qfq"], "ema_12 double, raw_dea double", R.macd_lines, **more)
    every = run()
    want = N.tail(every, 3)
    assert values(run(last=3)) == values(want) and want.count() == 3 * 12
    left = []
    real = R.over_series
    try:
        M.R.over_series = lambda *a, **k: left.append(real(*a, **k)) or left[-1]
        M.macd_state(walks), M.dde_state(*parts(walks))
    finally:
        M.R.over_series = real
    assert [d.groupBy("ts_code").count().agg(F.max("count")).first()[0] for d in left] == [M.MACD_BACK, M.FLOW_BACK]


def test_routed_states_compute_no_results_and_routed_results_lie_by_instrument(spark):
    from barloom.plans import state_queries  # noqa: F401
    from barloom.plans.queries import QUERIES

    source = "/root/testdata/./sf0.001"  # a source of its own: layers are kept by this name
    written = lambda: {k[2]: v for k, v in store._WRITTEN.items() if k[:2] == (spark.sparkContext.applicationId, source)}
    states = QUERIES["n19_routed_states"](spark, source)
    assert {"state_macd", "state_dde", "state_structure"} <= set(written()) and not {"state_lines", "state_flows"} & set(written())
    assert states.groupBy("indicator", "ts_code").count().where("count > 1").isEmpty()
    QUERIES["n19_routed_results"](spark, source)
    found = written()
    assert found["state_lines"].columns == ["ts_code", "trade_date", "close", "dif", "dea", "macd_bar", "zone"] and found["state_flows"].columns == ["ts_code", "trade_date", "label"]
    both = found["state_lines"].join(found["state_flows"], ["ts_code", "trade_date"])
    assert "hashpartitioning(ts_code" not in plan(both.hint("merge"))
