import duckdb
import pytest
from pyspark.sql import functions as F

from barloom.operators import bars as B
from barloom.operators import indicators as M
from barloom.operators import ingest as I
from barloom.plans import further_queries, layer_queries, queries  # noqa: F401

SF = "/root/testdata/sf0.001"
DAILY = "ts_code string, trade_date string, open double, high double, low double, close double, vol double, amount double, pct_chg double, adj_factor double"
BASIC = "ts_code string, trade_date string, total_mv double, circ_mv double, pe_ttm double, turnover_rate double, volume_ratio double"


def daily(spark, rows):
    return spark.createDataFrame([("A", d, c, c, c, c, 100.0, 1000.0, 0.0, f) for d, c, f in rows], DAILY)


def test_forward_adjustment_and_null_factor(spark):
    d = daily(spark, [("20240101", 10.0, 4.0), ("20240102", 11.0, None), ("20240103", 12.0, 2.0)])
    got = B.adjusted_bars(d, spark.createDataFrame([], BASIC)).orderBy("trade_date").collect()
    assert [(r.trade_date, r.close_qfq) for r in got] == [("20240101", 20.0), ("20240103", 12.0)]


def test_suspension_becomes_a_flat_bar(spark):
    d = daily(spark, [("20240101", 10.0, 1.0), ("20240103", 10.5, 1.0)])
    cal = spark.createDataFrame([("20240101", 1, 1), ("20240102", 1, 2), ("20240103", 1, 3)], "cal_date string, is_open int, day_idx int")
    got = {r.trade_date: r for r in B.fill_suspensions(B.adjusted_bars(d, spark.createDataFrame([], BASIC)), d, cal).collect()}
    assert len(got) == 3 and got["20240102"].is_suspended == 1 and got["20240102"].vol == 0 and got["20240102"].close_qfq == 10.0


def test_week_across_the_year(spark):
    days = ["20251229", "20251230", "20251231", "20260101", "20260102"]
    d = daily(spark, [(x, 10.0 + k, 1.0) for k, x in enumerate(days)])
    got = {r.trade_date: r for r in B.weekly_bars(B.adjusted_bars(d, spark.createDataFrame([], BASIC))).collect()}
    assert got["20260102"].active_days == 5 and got["20260102"].open_qfq == 10.0 and got["20251229"].vol == 500.0


def test_histogram_turn_names(spark):
    rows = [("A", f"2024{k // 28 + 1:02d}{k % 28 + 1:02d}", 10 + (k % 9) * 0.3) for k in range(60)]
    got = M.macd(spark.createDataFrame(rows, "ts_code string, trade_date string, close_qfq double")).orderBy("trade_date").collect()
    for a, b, c in zip(got, got[1:], got[2:]):
        want = "downturn_reverse" if c.macd_bar > b.macd_bar < a.macd_bar else "upturn_reverse" if c.macd_bar < b.macd_bar > a.macd_bar else None
        assert c.alert == want


def test_engulfing_bar_and_limit(spark):
    def rows(pct):
        out = [["A", f"2024{k // 28 + 1:02d}{k % 28 + 1:02d}", 11.0, 11.5, 10.5, 11.0, 100.0, 0.0] for k in range(35)]
        out[32][2:6] = [12.0, 12.2, 9.8, 10.0]
        out[33][2:6] = [9.0, 13.2, 8.9, 13.0]
        out[33][7] = pct
        return [tuple(r) for r in out]

    stocks = spark.createDataFrame([("A", 0)], "ts_code string, is_st int")
    schema = "ts_code string, trade_date string, open_qfq double, high_qfq double, low_qfq double, close_qfq double, vol double, pct_chg double"
    for pct, want in ((5.0, 1), (10.0, 0)):
        got = M.candlesticks(spark.createDataFrame(rows(pct), schema), stocks).where("trade_date = '20240206'").first()
        assert got.yang_bao_yin == want and (got.strength is None) == (want == 0)


def test_code_fixing(spark):
    d = spark.createDataFrame([("600000",), (" 000001 ",), ("300001.sz",), ("830001",), ("12",), (None,)], "c string")
    assert [r[0] for r in d.select(I.fix_code(F.col("c"))).collect()] == ["600000.SH", "000001.SZ", "300001.SZ", "830001.BJ", None, None]


def test_merge_ranges(spark):
    d = spark.createDataFrame([("A", 1, 3), ("A", 4, 5), ("A", 2, 9), ("A", 12, 13)], "ts_code string, a int, b int")
    assert sorted((r.a, r.b) for r in I.merge_ranges(d).collect()) == [(1, 9), (12, 13)]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("part", "lineitem", "supplier", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ["d2_dim_date", "b5_weekly_bars", "b19_weekly_flow", "ind_ma_daily", "ind_macd_daily", "ind_dde_daily", "t5_pattern_evaluation", "i11_change_events", "n3_classify", "n6_append_ma", "n6_append_macd", "n6_append_volume", "n7_routed_ma", "m7_weekly_macd", "ind_dde_weekly", "x7_enriched", "g6_within_days"])
def test_queries_equal_their_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    norm = lambda v: round(v, 6) + 0.0 if isinstance(v, float) else v
    rel = duck.execute(queries.ORACLE[name])
    at = [d[0] for d in rel.description]
    assert sorted(at) == cols
    want = sorted((tuple(norm(r[at.index(c)]) for c in cols) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(norm(r[c]) for c in cols) for r in got.collect()), key=repr) == want and want


def test_layers_are_built_once_and_read_once_per_query(spark):
    from barloom.sources.store import layer

    asked = []
    build = lambda: asked.append(1) or spark.range(3)
    first, again = layer(spark, "nowhere", "tiny", build), layer(spark, "nowhere", "tiny", build)
    assert len(asked) == 1 and first.count() == again.count() == 3
    m = queries.Tables(spark, SF)
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan(M.macd(M.daily_panel(m.quotes)))


def test_instruments_grow_with_the_suppliers(spark, tmp_path):
    import datetime

    from barloom.sources import market as S

    day = datetime.datetime(1999, 6, 15)
    spark.createDataFrame([(1, 1, 1, s, 5.0, 100.0 + s, "O", day) for s in (7, 99, 100, 250)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "Brand#7", "t")], "p_partkey long, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(s,) for s in (7, 99, 100, 250)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    rows = S.trades(spark, str(tmp_path), S.trade_cal(spark, str(tmp_path)))
    want = {"B07.XX", "B07-1.XX", "B07-2.XX"}
    assert {r.ts_code for r in rows.collect()} == want == {r.ts_code for r in S.ods_stock_basic(spark, str(tmp_path)).collect()}
    assert {r.ts_code for r in S.ods_daily(rows).collect()} == want | {"INDEX.XX"}


def test_profit_without_a_loss_is_infinite_and_few_returns_are_left_out(spark):
    from barloom.operators import backtest as T

    quotes = [("A", f"2024{k // 28 + 1:02d}{k % 28 + 1:02d}", 10.0 + k, 10.5 + k, 9.5 + k, 10.0 + k, 1.0, 0) for k in range(40)]
    q = spark.createDataFrame(quotes, "ts_code string, trade_date string, open_qfq double, high_qfq double, low_qfq double, close_qfq double, pct_chg double, is_suspended int")
    signals = q.where("trade_date < '20240108'").selectExpr("ts_code", "trade_date", "'p' AS pattern").unionByName(q.where("trade_date < '20240104'").selectExpr("ts_code", "trade_date", "'few' AS pattern"))
    got = T.evaluate(signals, q, q.selectExpr("trade_date", "'bull' AS regime").distinct()).where("holding = 5").collect()
    assert [(r.pattern, r.n, r.win_rate, r.mean_loss, r.profit_factor) for r in got] == [("p", 7, 1.0, 0.0, float("inf"))]
