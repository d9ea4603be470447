"""Registered queries of the serving, backtest, ingest, quality, incremental and gate layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import backtest as T
from barloom.operators import gate as G
from barloom.operators import incremental as N
from barloom.operators import indicators as M
from barloom.operators import ingest as I
from barloom.operators import quality as Q
from barloom.operators import structure as X
from barloom.operators import views as V

from . import panel_sql as P
from .base_sql import sql
from .queries import DATE, query, r6

ALL = P.MA | P.MACD | P.POSITION | P.KPATTERN | P.VOLUME | P.DDE


def panel(body: str, parts: dict, **more: str) -> str:
    return sql(body, "dwd_daily_moneyflow", panel=P.DAILY, **parts, **more)


def wide(m):
    if not hasattr(m, "_wide"):
        p = m.panel
        m._wide = V.wide(m.quotes, m.dim_stock, M.moving_averages(p), M.macd(p), M.candlesticks(p, m.dim_stock), M.volume(p), M.price_position(p), M.dde(m.moneyflow, p))
    return m._wide


_LABEL = """CASE WHEN yang_ke_yin = 1 THEN 'yang_ke_yin' WHEN yang_bao_yin = 1 THEN 'yang_bao_yin' WHEN yin_ke_yang = 1 THEN 'contrarian_yin_ke_yang' WHEN yin_bao_yang = 1 THEN 'contrarian_yin_bao_yang'
    WHEN mu_bei_xian = 1 THEN 'mu_bei_xian' WHEN bi_lei_zhen = 1 THEN 'bi_lei_zhen' WHEN gao_kai_chang_yin = 1 THEN 'gao_kai_chang_yin' END"""
_TEXT = "CASE alignment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.ALIGNMENT_TEXT.items()) + " END"
_WIDE = f"""SELECT 'D' AS freq, q.ts_code, q.trade_date, close_qfq AS close, q.pct_chg, q.vol, s.name AS stock_name, s.sector, s.is_st, {_LABEL} AS kpattern, k.strength AS kpattern_strength, price_position_60d,
    CASE WHEN price_position_60d > 98 AND volume_ratio1 > 1.5 THEN 'breakout_confirmed' WHEN price_position_60d > 85 AND v.zone = 'explosive' AND q.pct_chg BETWEEN -2 AND 2 THEN 'volume_climax'
         WHEN price_position_60d < 15 AND v.zone = 'low_volume' THEN 'volume_dry_up' WHEN c.turning_point = 'golden_cross' AND v.divergence = 'top_divergence' THEN 'golden_cross_weakened'
         WHEN c.turning_point = 'dead_cross' AND v.divergence = 'bottom_divergence' THEN 'dead_cross_weakened' END AS vol_signal,
    c.zone AS macd_zone, c.turning_point AS macd_turning_point, c.trend AS macd_trend, a.alignment, {_TEXT} AS ma_alignment, a.turning_point AS ma_turning_point, v.zone AS vol_zone, d.ddx, d.ddx2, d.trend AS dde_trend
    FROM dwd_daily_quote q LEFT JOIN dim_stock s USING (ts_code) LEFT JOIN kp k USING (ts_code, trade_date) LEFT JOIN position USING (ts_code, trade_date) LEFT JOIN macd c USING (ts_code, trade_date)
    LEFT JOIN ma a USING (ts_code, trade_date) LEFT JOIN (SELECT *, volume_ratio AS volume_ratio1 FROM volume) v USING (ts_code, trade_date) LEFT JOIN dde d USING (ts_code, trade_date)"""
_WIDE_COLS = "freq ts_code trade_date close pct_chg vol stock_name sector is_st kpattern kpattern_strength price_position_60d vol_signal macd_zone macd_turning_point macd_trend alignment ma_alignment ma_turning_point vol_zone ddx ddx2 dde_trend".split()
_WIDE_R = ", ".join(f"round({c}, 6) AS {c}" if c in ("close", "pct_chg", "vol", "kpattern_strength", "price_position_60d", "ddx", "ddx2") else c for c in _WIDE_COLS)

query("w2_wide_daily", panel(f"SELECT {_WIDE_R} FROM wide", ALL, wide=_WIDE))(lambda m: wide(m).select(*_WIDE_COLS))
query("s3_screening", panel(f"SELECT {_WIDE_R} FROM wide WHERE trade_date = (SELECT max(trade_date) FROM wide) AND macd_zone = 'bull' ORDER BY ddx DESC NULLS LAST, ts_code LIMIT 20", ALL, wide=_WIDE))(
    lambda m: V.screening(wide(m), 20, bars=m.quotes, macd_zone="bull").select(*_WIDE_COLS)
)
query("w4_index_wide", panel("SELECT ts_code, trade_date, round(q.close_qfq, 6) AS close, round(pct_chg, 6) AS pct_chg, round(dif, 6) AS dif, round(dea, 6) AS dea, zone, trend, NULL::DOUBLE AS ddx, NULL::DOUBLE AS ddx2 FROM macd LEFT JOIN dwd_daily_quote q USING (ts_code, trade_date) WHERE ts_code = 'INDEX.XX'", P.MACD))(
    lambda m: V.index_wide(m.quotes, M.macd(m.panel.where("ts_code = 'INDEX.XX'")), "INDEX.XX").select("ts_code", "trade_date", "close", "pct_chg", "dif", "dea", "zone", "trend", "ddx", "ddx2")
)


def snapshots(m):
    """Two calculation dates of the position indicator; the second covers the later dates only."""
    p = M.price_position(m.panel).select("ts_code", "trade_date", F.col("price_position_60d").alias("v"))
    return p.withColumn("calc_date", F.lit("20011105")).unionByName(p.where(F.col("trade_date") >= DATE).select("ts_code", "trade_date", (F.col("v") + 1).alias("v"), F.lit("20011106").alias("calc_date")))


_SNAP = f"SELECT ts_code, trade_date, price_position_60d AS v, '20011105' AS calc_date FROM position UNION ALL SELECT ts_code, trade_date, price_position_60d + 1, '20011106' FROM position WHERE trade_date >= '{DATE}'"
query("w1_latest_snapshot", panel("SELECT ts_code, trade_date, round(v, 6) AS v, calc_date FROM snap QUALIFY row_number() OVER (PARTITION BY ts_code, trade_date ORDER BY calc_date DESC) = 1", P.POSITION, snap=_SNAP))(lambda m: V.latest(snapshots(m)))
query("n15_prune", panel("SELECT ts_code, trade_date, round(v, 6) AS v, calc_date FROM snap QUALIFY row_number() OVER (PARTITION BY ts_code, trade_date ORDER BY calc_date DESC) = 1 OR calc_date >= '20011106'", P.POSITION, snap=_SNAP))(lambda m: V.prune(snapshots(m), 1))
query("n14_invalidate", panel(f"SELECT ts_code, trade_date, round(v, 6) AS v, calc_date FROM snap WHERE NOT (ts_code IN ('B01.XX', 'B02.XX') AND trade_date >= '{DATE}')", P.POSITION, snap=_SNAP))(
    lambda m: N.invalidate(snapshots(m), m.dim_stock.where("ts_code in ('B01.XX', 'B02.XX')"), DATE)
)
_FRESH = "SELECT 'daily' AS table_name, count(*) AS n_rows, max(trade_date) AS max_date FROM ods_daily UNION ALL SELECT 'moneyflow', count(*), max(trade_date) FROM ods_moneyflow UNION ALL SELECT 'weekly', count(*), max(trade_date) FROM dwd_weekly_quote"
query("w8_freshness", sql(_FRESH, "dwd_daily_moneyflow"))(lambda m: V.freshness({"daily": m.daily, "moneyflow": m.flow, "weekly": m.weekly}))
query("s4_health", sql("SELECT table_name, max_date, date_diff('day', strptime(max_date, '%Y%m%d')::DATE, DATE '2001-11-03')::INT AS age_days, CASE WHEN date_diff('day', strptime(max_date, '%Y%m%d')::DATE, DATE '2001-11-03') <= 1 THEN 'fresh' ELSE 'stale' END AS status FROM f", "dwd_daily_moneyflow", f=_FRESH))(
    lambda m: V.health(V.freshness({"daily": m.daily, "moneyflow": m.flow, "weekly": m.weekly}), "20011103")
)
query("s2_history", panel("SELECT ts_code, trade_date, round(dif, 6) AS dif, zone FROM macd WHERE ts_code = 'B07.XX' AND trade_date BETWEEN '19990101' AND '20000101'", P.MACD))(
    lambda m: V.history(M.macd(m.panel.where("ts_code = 'B07.XX'")), "B07.XX", "19990101", "20000101", ["dif", "zone"], {"dif", "dea", "zone"})
)
query("s5_newest", panel("SELECT ts_code, trade_date, round(macd_bar, 6) AS macd_bar, zone FROM macd QUALIFY row_number() OVER (PARTITION BY ts_code ORDER BY trade_date DESC) = 1", P.MACD))(
    lambda m: N.tail(M.macd(m.panel), 1).select("ts_code", "trade_date", "macd_bar", "zone")
)
query("s7_export_coverage", sql("SELECT a.n AS n_rows, b.n AS n_listed, a.n >= 0.8 * b.n AS enough FROM (SELECT count(DISTINCT ts_code) AS n FROM dwd_daily_quote) a, (SELECT sum(is_active)::BIGINT AS n FROM dim_stock) b", "dwd_daily_quote"))(
    lambda m: V.export_coverage(m.quotes, m.dim_stock)
)
query("e1_export_frame", panel(f"SELECT a.ts_code, a.trade_date, round(a.ma_5, 2) AS ma_5, coalesce(a.turning_point, '-') AS turning_point, coalesce(a.alignment, 'N/A') AS alignment, round(w.price_position_60d, 6) AS __w__price_position_60d FROM ma a LEFT JOIN dim_stock s USING (ts_code) LEFT JOIN (SELECT * FROM position WHERE trade_date = (SELECT max(trade_date) FROM dim_date WHERE is_week_end = 1 AND trade_date <= (SELECT max(trade_date) FROM ma WHERE trade_date < '{DATE}'))) w USING (ts_code) WHERE a.trade_date = (SELECT max(trade_date) FROM ma WHERE trade_date < '{DATE}') AND coalesce(is_st, 0) = 0", P.MA | P.POSITION))(lambda m: _export(m))


def _export(m):
    ma = M.moving_averages(m.panel).join(m.dim_stock.select("ts_code", "is_st"), "ts_code", "left")
    date = m.panel.where(F.col("trade_date") < DATE).agg(F.max("trade_date")).first()[0]
    end = m.dim_date.where((F.col("is_week_end") == 1) & (F.col("trade_date") <= date)).agg(F.max("trade_date")).first()[0]
    rows = V.export_frame(ma, M.price_position(m.panel).select("ts_code", "trade_date", "price_position_60d"), date, end)
    return V.formatted(rows, {"ma_5": 1.0}, ["turning_point"], ["alignment"]).select("ts_code", "trade_date", "ma_5", "turning_point", "alignment", "__w__price_position_60d")


# Backtest
_REG = "SELECT trade_date, CASE WHEN r > 1.02 THEN 'bull' WHEN r < 0.98 THEN 'bear' ELSE 'sideways' END AS regime FROM (SELECT trade_date, round(close_qfq / avg(close_qfq) OVER (ORDER BY trade_date ROWS 59 PRECEDING), 10) AS r FROM dwd_daily_quote WHERE ts_code = 'INDEX.XX' AND is_suspended = 0)"
_FWD0 = "SELECT ts_code, trade_date, lead(open_qfq) OVER w AS entry, lead(high_qfq) OVER w AS nh, lead(low_qfq) OVER w AS nl, lead(pct_chg) OVER w AS np, " + ", ".join(f"lead(close_qfq, {n}) OVER w AS c{n}" for n in T.HOLDINGS) + " FROM dwd_daily_quote WHERE is_suspended = 0 WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date)"
_FWD = "SELECT ts_code, trade_date, entry, CASE WHEN entry IS NULL THEN 'no_next_bar' WHEN entry = nh AND nh = nl AND np >= 9 THEN 'limit_up' WHEN entry = nh AND nh = nl AND np <= -9 THEN 'limit_down' ELSE 'ok' END AS tradable, " + ", ".join(f"(c{n} - entry) / entry * 100 AS ret_{n}" for n in T.HOLDINGS) + " FROM fwd0"
_SIG = "SELECT ts_code, trade_date, unnest(list_filter([" + ", ".join(f"CASE WHEN {p} = 1 THEN '{p}' END" for p in M.PATTERNS) + "], lambda x: x IS NOT NULL)) AS pattern FROM kp"
_BT = {"reg": _REG, "fwd0": _FWD0, "fwd": _FWD, "sig": _SIG}
_STATS = """SELECT pattern, regime, holding, count(*) AS n, count(*) FILTER (ret > 0) / count(*)::DOUBLE AS win_rate, avg(ret) AS mean_ret, coalesce(avg(ret) FILTER (ret > 0), 0) AS mean_win, coalesce(avg(ret) FILTER (ret < 0), 0) AS mean_loss,
    CASE WHEN sum(ret) FILTER (ret < 0) < 0 THEN coalesce(sum(ret) FILTER (ret > 0), 0) / abs(sum(ret) FILTER (ret < 0)) ELSE 'inf'::DOUBLE END AS profit_factor FROM (SELECT pattern, regime, unnest([1, 3, 5, 10, 20]) AS holding, round(unnest([ret_1, ret_3, ret_5, ret_10, ret_20]), 10) AS ret
    FROM sig JOIN fwd USING (ts_code, trade_date) JOIN reg USING (trade_date) WHERE tradable = 'ok') WHERE ret IS NOT NULL GROUP BY pattern, regime, holding HAVING count(*) >= 5"""
query("t1_regime", sql(_REG, "dwd_daily_quote"))(lambda m: T.market_regime(m.quotes, "INDEX.XX"))
query("t2_forward_frame", sql(f"SELECT {r6('ts_code, trade_date, tradable', 'entry', *[f'ret_{n}' for n in T.HOLDINGS])} FROM fwd", "dwd_daily_quote", fwd0=_FWD0, fwd=_FWD))(lambda m: T.forward_frame(m.quotes))
query("t4_tradability", panel("SELECT pattern, count(*) AS n, round(avg((tradable <> 'ok')::INT), 6) AS untradable FROM sig JOIN fwd USING (ts_code, trade_date) GROUP BY ALL", P.KPATTERN, **_BT))(
    lambda m: T.tradability(T.pattern_signals(M.candlesticks(m.panel, m.dim_stock), M.PATTERNS), m.quotes)
)
_eval = lambda m: T.evaluate(T.pattern_signals(M.candlesticks(m.panel, m.dim_stock), M.PATTERNS), m.quotes, T.market_regime(m.quotes, "INDEX.XX"))
query("t5_pattern_evaluation", panel(f"SELECT {r6('pattern, regime, holding, n', 'win_rate', 'mean_ret', 'mean_win', 'mean_loss', 'profit_factor')} FROM stats", P.KPATTERN, **_BT, stats=_STATS))(_eval)
query("t7_comparison", panel("SELECT pattern, " + ", ".join(f"round(sum(win_rate * n) FILTER (holding = {n}) / sum(n) FILTER (holding = {n}), 6) AS win_{n}" for n in T.HOLDINGS) + " FROM stats GROUP BY pattern", P.KPATTERN, **_BT, stats=_STATS))(lambda m: T.comparison(_eval(m)))
query("t8_combo", panel("SELECT DISTINCT ts_code, trade_date FROM kp JOIN macd c USING (ts_code, trade_date) JOIN ma a USING (ts_code, trade_date) WHERE yang_ke_yin = 1 AND c.zone = 'bull' AND a.alignment = 'bull_strong'", P.KPATTERN | P.MACD | P.MA))(
    lambda m: T.combo_signals(M.candlesticks(m.panel, m.dim_stock), ("yang_ke_yin",), macd=(M.macd(m.panel), "zone", "bull"), ma=(M.moving_averages(m.panel), "alignment", "bull_strong"))
)
query("t9_combo_count", panel("SELECT count(*) AS n FROM (SELECT DISTINCT ts_code, trade_date FROM kp JOIN macd c USING (ts_code, trade_date) WHERE yang_bao_yin = 1 AND c.trend = 'up' AND trade_date BETWEEN '19970101' AND '20001231')", P.KPATTERN | P.MACD))(
    lambda m: T.combo_signals(M.candlesticks(m.panel, m.dim_stock), ("yang_bao_yin",), macd=(M.macd(m.panel), "trend", "up")).where("trade_date between '19970101' and '20001231'").agg(F.count("*").alias("n"))
)

# Ingest: an incoming batch is the daily table with some closes moved, some rows invalid and some new
_DAY = "right(trade_date, 2)::INT"
_IN = f"SELECT * REPLACE (CASE WHEN {_DAY} % 13 = 0 THEN close + 0.01::DOUBLE WHEN {_DAY} % 7 = 0 THEN close + 1e-5::DOUBLE ELSE close END AS close, CASE WHEN {_DAY} = 17 THEN low - 1 WHEN {_DAY} = 19 THEN NULL ELSE high END AS high) FROM ods_daily"
_OLD = f"SELECT * FROM ods_daily WHERE trade_date < '{DATE}'"


def incoming(m):
    day = F.substring("trade_date", 7, 2).cast("int")
    close = F.when(day % 13 == 0, F.col("close") + 0.01).when(day % 7 == 0, F.col("close") + 1e-5).otherwise(F.col("close"))
    return m.daily.withColumns({"close": close, "high": F.when(day == 17, F.col("low") - 1).when(day != 19, F.col("high"))})


def old(m):
    return m.daily.where(F.col("trade_date") < DATE)


_EQ = "CASE WHEN i.{c} IS NULL OR o.{c} IS NULL THEN (i.{c} IS NULL) = (o.{c} IS NULL) ELSE abs(i.{c} - o.{c}) <= CASE WHEN greatest(abs(i.{c}), abs(o.{c}), 1) < 1000 THEN 1e-4::DOUBLE ELSE greatest(1::DOUBLE, greatest(abs(i.{c}), abs(o.{c}), 1) * 1e-5::DOUBLE) END END"
_EV = "SELECT i.ts_code, i.trade_date, 'ods_daily' AS table_name, unnest(list_filter([" + ", ".join(f"CASE WHEN o.ts_code IS NULL OR NOT ({_EQ.format(c=c)}) THEN '{c}' END" for c in ("close", "high", "vol")) + "], lambda x: x IS NOT NULL)) AS column_name, o.ts_code IS NULL AS is_insert FROM inc i LEFT JOIN old o USING (ts_code, trade_date)"
query("i6_validation", sql("SELECT is_valid, count(*) AS n FROM (SELECT high IS NOT NULL AND high >= low AS is_valid FROM inc) GROUP BY ALL", "ods_daily", inc=_IN))(lambda m: I.validated(incoming(m)).groupBy("is_valid").agg(F.count("*").alias("n")))
# One scan for both queries: the stored values of a row are its own before DATE, and none from then on.
_MOVED = {"close": f"CASE WHEN {_DAY} % 13 = 0 THEN close + 0.01::DOUBLE WHEN {_DAY} % 7 = 0 THEN close + 1e-5::DOUBLE ELSE close END", "high": f"CASE WHEN {_DAY} = 17 THEN low - 1 WHEN {_DAY} = 19 THEN NULL ELSE high END", "vol": "vol"}
_BOTH = f"SELECT ts_code, trade_date, trade_date >= '{DATE}' AS is_new, " + ", ".join(f"{x} AS i_{c}, CASE WHEN trade_date < '{DATE}' THEN {c} END AS o_{c}" for c, x in _MOVED.items()) + " FROM ods_daily"
_SAME = _EQ.replace("i.{c}", "i_{c}").replace("o.{c}", "o_{c}")
query("i10_changed_rows", sql(f"SELECT ts_code, trade_date, is_new OR NOT ({_SAME.format(c='close')}) OR NOT ({_SAME.format(c='high')}) AS is_changed FROM both_", "ods_daily", both_=_BOTH))(
    lambda m: I.changed_rows(incoming(m), old(m), ["close", "high"]).select("ts_code", "trade_date", "is_changed")
)
query("i11_change_events", sql("SELECT ts_code, trade_date, 'ods_daily' AS table_name, column_name, is_new AS is_insert FROM (" + " UNION ALL ".join(f"SELECT *, '{c}' AS column_name FROM both_ WHERE is_new OR NOT ({_SAME.format(c=c)})" for c in _MOVED) + ")", "ods_daily", both_=_BOTH))(
    lambda m: I.change_events(incoming(m), old(m), ["close", "high", "vol"], "ods_daily")
)
query("i12_change_summary", sql("SELECT table_name, count(DISTINCT ts_code) AS n_codes, count(DISTINCT (ts_code, trade_date)) AS n_rows, array_to_string(list_sort(list(DISTINCT column_name)), ',') AS columns FROM ev GROUP BY ALL", "ods_daily", inc=_IN, old=_OLD, ev=_EV))(
    lambda m: I.summary(I.change_events(incoming(m), old(m), ["close", "high", "vol"], "ods_daily"))
)
query("i13_upsert", sql("SELECT ts_code, trade_date, round(close, 6) AS close, round(high, 6) AS high FROM inc UNION ALL SELECT ts_code, trade_date, round(close, 6), round(high, 6) FROM old ANTI JOIN inc USING (ts_code, trade_date)", "ods_daily", inc=f"SELECT * FROM ({_IN}) WHERE trade_date >= '19990101'", old=_OLD))(
    lambda m: I.upsert(old(m), incoming(m).where("trade_date >= '19990101'"), "ts_code", "trade_date").select("ts_code", "trade_date", "close", "high")
)
query("i14_null_patch", sql("SELECT ts_code, trade_date, round(coalesce(net_amount_dc, net_mf_amount), 6) AS net_amount_dc, net_amount_dc IS NULL AND net_mf_amount IS NOT NULL AS is_patched FROM ods_moneyflow", "ods_moneyflow"))(
    lambda m: I.patch_nulls(m.flow, m.flow.select("ts_code", "trade_date", F.col("net_mf_amount").alias("net_amount_dc")), "net_amount_dc").select("ts_code", "trade_date", "net_amount_dc", "is_patched")
)
query("i15_null_patch_insert", sql(f"SELECT ts_code, trade_date, round(coalesce(o.circ_mv, p.total_mv), 6) AS circ_mv, o.circ_mv IS NULL AND p.total_mv IS NOT NULL AS is_patched FROM (SELECT * FROM ods_daily_basic WHERE trade_date < '{DATE}') o FULL JOIN ods_daily_basic p USING (ts_code, trade_date)", "ods_daily_basic"))(
    lambda m: I.patch_nulls(m.basic.where(F.col("trade_date") < DATE), m.basic.select("ts_code", "trade_date", F.col("total_mv").alias("circ_mv")), "circ_mv", True).select("ts_code", "trade_date", "circ_mv", "is_patched")
)
query("i17_active", sql("SELECT ts_code FROM ods_stock_basic WHERE coalesce(delist_date, '') = ''", "ods_stock_basic"))(lambda m: m.dim_stock.where("is_active = 1").select("ts_code"))
_MISS = "SELECT s.ts_code, c.cal_date AS trade_date, c.day_idx FROM ods_stock_basic s, ods_trade_cal c ANTI JOIN ods_daily d ON d.ts_code = s.ts_code AND d.trade_date = c.cal_date WHERE is_open = 1 AND cal_date BETWEEN '19980101' AND '20001231'"
_miss = lambda m: I.missing_days(m.dim_stock, m.daily, m.cal, "19980101", "20001231")
query("i18_uncovered_dates", sql("SELECT c.cal_date AS trade_date FROM ods_trade_cal c LEFT JOIN (SELECT trade_date, count(DISTINCT ts_code) AS n FROM ods_daily WHERE ts_code <> 'INDEX.XX' GROUP BY ALL) d ON d.trade_date = c.cal_date WHERE is_open = 1 AND coalesce(n, 0) < (SELECT count(*) FROM ods_stock_basic)", "ods_stock_basic"))(
    lambda m: I.uncovered_dates(m.daily, m.dim_stock, m.cal)
)
query("i20_missing_days", sql(_MISS, "ods_stock_basic"))(_miss)
query("i21_drop_interior", sql(f"SELECT x.* FROM ({_MISS}) x LEFT JOIN (SELECT ts_code, min(trade_date) AS lo, max(trade_date) AS hi FROM ods_daily WHERE trade_date BETWEEN '19990101' AND '19991231' GROUP BY ALL) e USING (ts_code) WHERE lo IS NULL OR trade_date < lo OR trade_date > hi", "ods_stock_basic"))(
    lambda m: I.drop_interior(_miss(m), m.daily.where("trade_date between '19990101' and '19991231'"))
)
_RNG = f"SELECT ts_code, min(trade_date) AS start, max(trade_date) AS \"end\", count(*) AS n_days, min(day_idx) AS a, max(day_idx) AS b FROM (SELECT *, day_idx - row_number() OVER (PARTITION BY ts_code ORDER BY day_idx) AS g FROM ({_MISS})) GROUP BY ts_code, g"
query("i22_day_ranges", sql(f"SELECT ts_code, start, \"end\", n_days FROM ({_RNG})", "ods_stock_basic"))(lambda m: I.to_ranges(_miss(m)))
query("i23_merge_ranges", sql(f"SELECT ts_code, min(a) AS a, max(b) AS b FROM (SELECT *, sum(nw) OVER (PARTITION BY ts_code ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN up IS NULL OR a > up + 1 THEN 1 ELSE 0 END AS nw FROM (SELECT *, max(b) OVER (PARTITION BY ts_code ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS up FROM (SELECT ts_code, day_idx - 1 AS a, day_idx + 2 AS b FROM ({_MISS}))))) GROUP BY ts_code, g", "ods_stock_basic"))(
    lambda m: I.merge_ranges(_miss(m).select("ts_code", (F.col("day_idx") - 1).alias("a"), (F.col("day_idx") + 2).alias("b")))
)

# Quality
query("h1_raw_rules", sql("SELECT 'dup_keys' AS rule, (SELECT count(*) FROM (SELECT 1 FROM ods_daily GROUP BY ts_code, trade_date HAVING count(*) > 1)) AS n_bad UNION ALL SELECT 'high_low', count(*) FILTER (high < low) FROM inc UNION ALL SELECT 'null_high', count(*) FILTER (high IS NULL) FROM inc UNION ALL SELECT 'factor', count(*) FILTER (adj_factor IS NULL OR adj_factor <= 0) FROM inc UNION ALL SELECT 'negative_volume', count(*) FILTER (vol < 0) FROM inc", "ods_daily", inc=_IN))(
    lambda m: (lambda i: Q.rule_counts({"dup_keys": (Q.duplicate_keys(m.daily, "ts_code", "trade_date"), "true"), "high_low": (i, "high < low"), "null_high": (i, "high is null"), "factor": (i, "adj_factor is null or adj_factor <= 0"), "negative_volume": (i, "vol < 0")}))(incoming(m))
)
query("h2_bar_rules", sql("SELECT 'ohlc' AS rule, count(*) FILTER (greatest(open_qfq, close_qfq) > high_qfq + 1e-9 OR least(open_qfq, close_qfq) < low_qfq - 1e-9) AS n_bad FROM dwd_daily_quote UNION ALL SELECT 'suspended_volume', count(*) FILTER (is_suspended = 1 AND vol <> 0) FROM dwd_daily_quote", "dwd_daily_quote"))(
    lambda m: Q.rule_counts({"ohlc": (m.quotes, "greatest(open_qfq, close_qfq) > high_qfq + 1e-9 or least(open_qfq, close_qfq) < low_qfq - 1e-9"), "suspended_volume": (m.quotes, "is_suspended = 1 and vol <> 0")})
)
query("h3_week_rules", sql("SELECT 'active_days' AS rule, count(*) FILTER (active_days NOT BETWEEN 1 AND 5) AS n_bad FROM dwd_weekly_quote UNION ALL SELECT 'full_weeks', count(*) FILTER (active_days = 5) FROM dwd_weekly_quote", "dwd_weekly_quote"))(
    lambda m: Q.rule_counts({"active_days": (m.weekly, "active_days not between 1 and 5"), "full_weeks": (m.weekly, "active_days = 5")})
)
query("h6_orphans", sql("SELECT count(*) AS n_orphans FROM dwd_daily_quote ANTI JOIN dim_stock USING (ts_code)", "dwd_daily_quote"))(lambda m: Q.orphans(m.quotes, m.dim_stock, "ts_code", "ts_code"))
query("h7_week_ends", sql("SELECT year, week_of_year, sum(is_week_end)::BIGINT AS n FROM dim_date GROUP BY ALL HAVING sum(is_week_end) <> 1", "dim_date"))(lambda m: Q.week_ends_per_week(m.dim_date))
query("h9_fill_rate", sql("SELECT trade_date, n, u, n >= least(u::DOUBLE, greatest(u * 0.8, CASE WHEN u >= 4000 THEN 4000 ELSE 0 END)) AS enough FROM (SELECT trade_date, count(DISTINCT ts_code) AS n FROM dwd_weekly_quote JOIN dim_date USING (trade_date) WHERE is_week_end = 1 GROUP BY ALL), (SELECT count(*) FILTER (is_active = 1) AS u FROM dim_stock WHERE list_date < (SELECT trade_date FROM dim_date WHERE is_week_end = 1 ORDER BY trade_date DESC LIMIT 1 OFFSET 119))", "dwd_weekly_quote"))(
    lambda m: Q.fill_rate(m.weekly, m.dim_date, m.dim_stock)
)
query("q1_completeness", sql("SELECT ts_code, d.n AS n_daily, coalesce(w.n, 0) AS n_weekly, CASE WHEN d.n >= 1000 AND coalesce(w.n, 0) >= 1100 THEN 'ok' WHEN d.n >= 1000 THEN 'missing_weekly' WHEN coalesce(w.n, 0) >= 1100 THEN 'missing_daily' ELSE 'missing_both' END AS status FROM (SELECT ts_code, count(*) AS n FROM adjusted GROUP BY ALL) d LEFT JOIN (SELECT ts_code, count(*) AS n FROM dwd_weekly_quote GROUP BY ALL) w USING (ts_code)", "dwd_weekly_quote"))(
    lambda m: Q.completeness(m.adjusted, m.weekly, 1000, 1100)
)
query("q2_stale_codes", sql("SELECT s.ts_code, d.last FROM dim_stock s LEFT JOIN (SELECT ts_code, max(trade_date) AS last FROM ods_daily GROUP BY ALL) d USING (ts_code) WHERE is_active = 1 AND coalesce(d.last, '') < (SELECT max(trade_date) FROM ods_daily)", "dim_stock"))(
    lambda m: Q.stale_codes(m.dim_stock, m.daily, m.daily.agg(F.max("trade_date")).first()[0])
)
query("q8_row_gate", sql("SELECT ts_code, i.indicator, n AS n_rows, 'insufficient_rows' AS reason FROM (SELECT ts_code, count(*) AS n FROM ods_daily WHERE trade_date < '19950210' GROUP BY ALL), (VALUES ('macd', 27), ('ma', 11), ('kpattern', 30), ('dde', 10), ('volume', 5), ('position', 2)) i(indicator, need) WHERE n < need", "ods_daily"))(
    lambda m: Q.row_gate(m.daily.where("trade_date < '19950210'"), M.LEAST_ROWS)
)
query("h12_label_audit", panel("SELECT 'alignment' AS column_name, count(*) AS n, count(*) FILTER (alignment = 'tangle') AS n_diff, CASE WHEN count(*) FILTER (alignment = 'tangle') / count(*)::DOUBLE > 0.01 THEN 'fail' WHEN count(*) FILTER (alignment = 'tangle') / count(*)::DOUBLE > 0.001 THEN 'warn' ELSE 'ok' END AS verdict FROM ma", P.MA))(
    lambda m: (lambda a: Q.label_audit(a.withColumn("alignment", F.when(F.col("alignment") == "tangle", "sideways").otherwise(F.col("alignment"))), a, ["alignment"]))(M.moving_averages(m.panel))
)

# Incremental: the state is that of an earlier date, with one instrument's history changed and one of an old version


def state(m):
    p = m.panel.where((F.col("trade_date") < DATE) & (F.col("ts_code") != "B09.XX"))
    s = N.signature(p, "close_qfq", upto=DATE)
    fp = F.when(F.col("ts_code") == "B03.XX", F.lit("0")).otherwise(F.col("history_fp"))
    return s.select("ts_code", fp.alias("history_fp"), "last_trade_date", F.when(F.col("ts_code") == "B04.XX", "v1").otherwise("v2").alias("spec_version"))


query("n3_classify", panel(f"SELECT ts_code, CASE WHEN ts_code IN ('B09.XX', 'B03.XX', 'B04.XX') THEN 'FULL' WHEN count(*) FILTER (trade_date > l) = 0 THEN 'SKIP' ELSE 'APPEND' END AS mode, count(*) FILTER (l IS NULL OR trade_date > l) AS new_bars FROM panel LEFT JOIN (SELECT ts_code, max(trade_date) AS l FROM panel WHERE trade_date < '{DATE}' AND ts_code <> 'B09.XX' GROUP BY ALL) USING (ts_code) GROUP BY ts_code", {}))(
    lambda m: N.classify(m.panel, state(m), "close_qfq", "v2")
)
query("n6_append_ma", panel(f"SELECT ts_code, trade_date, alignment, turning_point, round(ma_5, 6) AS ma_5, round(ma10_slope, 6) AS ma10_slope FROM ma WHERE trade_date >= '{DATE}'", P.MA))(
    lambda m: N.append(M.moving_averages, m.panel, m.panel.where(F.col("trade_date") < DATE).groupBy("ts_code").agg(F.max("trade_date").alias("last_trade_date")), 60).select("ts_code", "trade_date", "alignment", "turning_point", "ma_5", "ma10_slope")
)
query("n5_seeds", panel(f"SELECT ts_code, trade_date, round(ema_12, 6) AS ema_12, round(dea, 6) AS dea FROM macd WHERE trade_date < '{DATE}' QUALIFY row_number() OVER (PARTITION BY ts_code ORDER BY trade_date DESC) = 1", P.MACD))(
    lambda m: N.seeds(M.macd(m.panel), DATE, "ema_12", "dea")
)
query("n2_recalc_start", sql(f"SELECT cal_date AS start FROM ods_trade_cal WHERE is_open = 1 AND day_idx = (SELECT max(day_idx) - 245 FROM ods_trade_cal WHERE cal_date <= '{DATE}')", "ods_trade_cal"))(lambda m: N.recalc_start(m.cal, DATE, 245))
query("i3_tail", panel("SELECT ts_code, trade_date, round(close_qfq, 6) AS close_qfq FROM panel QUALIFY row_number() OVER (PARTITION BY ts_code ORDER BY trade_date DESC) <= 245", {}))(lambda m: N.tail(m.panel, 245).select("ts_code", "trade_date", "close_qfq"))
_ROUTES = "SELECT i.indicator, f.freq, v AS expected_version FROM (VALUES ('macd', 'v3'), ('ma', 'v2'), ('kpattern', 'v1'), ('dde', 'v3'), ('volume', 'v2'), ('position', 'v1')) i(indicator, v), (VALUES ('daily'), ('weekly')) f(freq)"
_STATE = "SELECT ts_code, indicator, freq, CASE WHEN ts_code < 'B10' THEN 'v1' ELSE 'v2' END AS spec_version FROM dim_stock, routes WHERE NOT (ts_code = 'B07.XX' AND freq = 'weekly')"


def states(m):
    rows = m.dim_stock.select("ts_code").join(F.broadcast(N.routes(m.spark)))
    return rows.where("not (ts_code = 'B07.XX' and freq = 'weekly')").select("ts_code", "indicator", "freq", F.when(F.col("ts_code") < "B10", "v1").otherwise("v2").alias("spec_version"))


query("n9_missing_state", sql("SELECT ts_code, indicator, freq FROM dim_stock, routes ANTI JOIN state s ON s.ts_code = dim_stock.ts_code AND s.indicator = routes.indicator AND s.freq = routes.freq".replace("dim_stock, routes ANTI", "(SELECT * FROM dim_stock, routes) x ANTI").replace("dim_stock.ts_code", "x.ts_code").replace("routes.indicator", "x.indicator").replace("routes.freq", "x.freq"), "dim_stock", routes=_ROUTES, state=_STATE))(
    lambda m: N.missing_state(m.dim_stock, states(m), N.routes(m.spark))
)
query("w10_spec_freshness", sql("SELECT indicator, freq, count(*) AS n_total, count(*) FILTER (spec_version = expected_version) AS n_ok, count(*) FILTER (spec_version <> expected_version) AS n_stale FROM state JOIN routes USING (indicator, freq) GROUP BY ALL", "dim_stock", routes=_ROUTES, state=_STATE))(
    lambda m: N.spec_freshness(states(m), N.routes(m.spark))
)
query("w9_availability", sql("SELECT x.ts_code, x.indicator, x.freq, s.reason, CASE WHEN s.reason IS NULL THEN 'available' ELSE 'skipped' END AS status FROM (SELECT * FROM dim_stock, routes WHERE is_active = 1) x LEFT JOIN (SELECT ts_code, 'macd' AS indicator, 'daily' AS freq, 'short' AS reason FROM dim_stock WHERE is_st = 1) s USING (ts_code, indicator, freq)", "dim_stock", routes=_ROUTES))(
    lambda m: N.availability(m.dim_stock, N.routes(m.spark), m.dim_stock.where("is_st = 1").select("ts_code", F.lit("macd").alias("indicator"), F.lit("daily").alias("freq"), F.lit("short").alias("reason"), F.lit("20011105").alias("calc_date"))).select("ts_code", "indicator", "freq", "reason", "status")
)
_DEPS = "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{i}')" for i, cols in N.READS.items() for c in cols) + ") t(column_name, indicator)"
query("n12_affected", sql("SELECT ts_code, array_to_string(list_sort(list(DISTINCT indicator)), ',') AS indicators FROM (SELECT ts_code, indicator FROM ev JOIN deps USING (column_name) UNION ALL SELECT ts_code, d.indicator FROM ev, (SELECT DISTINCT indicator FROM deps) d WHERE is_insert) GROUP BY ALL", "ods_daily", inc=_IN, old=_OLD, ev=_EV, deps=_DEPS))(
    lambda m: N.affected(I.change_events(incoming(m), old(m), ["close", "high", "vol"], "ods_daily"), m.spark)
)
query("n24_rows_per_day", panel("SELECT trade_date, count(*) AS n_rows FROM panel GROUP BY ALL", {}))(lambda m: N.new_bar_counts(m.panel))

# Gate
_GOLD = "SELECT ts_code, trade_date, CASE WHEN right(trade_date, 2)::INT % 9 = 0 THEN ' ' || upper(alignment) || ' ' WHEN right(trade_date, 2)::INT % 10 = 0 THEN 'N/A' WHEN right(trade_date, 2)::INT % 7 = 0 THEN 'sideways' ELSE alignment END AS alignment, coalesce(turning_point, '-') AS turning_point FROM ma"


def golden(m):
    day = F.substring("trade_date", 7, 2).cast("int")
    label = F.when(day % 9 == 0, F.concat(F.lit(" "), F.upper("alignment"), F.lit(" "))).when(day % 10 == 0, "N/A").when(day % 7 == 0, "sideways").otherwise(F.col("alignment"))
    return M.moving_averages(m.panel).select("ts_code", "trade_date", label.alias("alignment"), F.coalesce("turning_point", F.lit("-")).alias("turning_point"))


_DIFF = "SELECT m.ts_code, m.trade_date, f.field, CASE WHEN f.field = 'alignment' THEN m.alignment ELSE m.turning_point END AS ours, CASE WHEN f.field = 'alignment' THEN CASE WHEN lower(trim(g.alignment)) = 'n/a' THEN NULL ELSE lower(trim(g.alignment)) END ELSE nullif(g.turning_point, '-') END AS theirs FROM ma m JOIN gold g USING (ts_code, trade_date), (VALUES ('alignment'), ('turning_point')) f(field)"
query("g4_field_diff", panel(f"SELECT * FROM ({_DIFF}) WHERE ours IS DISTINCT FROM theirs", P.MA, gold=_GOLD))(lambda m: G.field_diff(M.moving_averages(m.panel), golden(m), ["alignment", "turning_point"]))
query("g4_diff_summary", panel(f"SELECT field, count(*) AS n_diff, count(DISTINCT ts_code) AS n_codes FROM ({_DIFF}) WHERE ours IS DISTINCT FROM theirs GROUP BY ALL", P.MA, gold=_GOLD))(lambda m: G.diff_summary(G.field_diff(M.moving_averages(m.panel), golden(m), ["alignment", "turning_point"])))
_EVT = "SELECT ts_code, turning_point AS label, trade_date FROM ma WHERE turning_point LIKE '%_cross'"
_events = lambda m: M.moving_averages(m.panel).where("turning_point like '%_cross'").select("ts_code", F.col("turning_point").alias("label"), "trade_date")
query("g6_within_days", panel("SELECT g.ts_code, g.label, g.trade_date, EXISTS (SELECT 1 FROM evt e WHERE e.ts_code = g.ts_code AND e.label = g.label AND abs(date_diff('day', strptime(g.trade_date, '%Y%m%d')::DATE, strptime(e.trade_date, '%Y%m%d')::DATE)) <= 3) AS is_hit FROM (SELECT ts_code, 'golden_cross' AS label, trade_date FROM panel WHERE right(trade_date, 2) = '15') g", P.MA, evt=_EVT))(
    lambda m: G.matched_within(m.panel.where("substring(trade_date, 7, 2) = '15'").select("ts_code", F.lit("golden_cross").alias("label"), "trade_date"), _events(m), 3)
)
query("g7_round_robin", sql("SELECT ts_code, sector, turn::INT AS turn FROM (SELECT ts_code, sector, row_number() OVER (PARTITION BY sector ORDER BY ts_code) AS turn FROM dim_stock) ORDER BY turn, sector LIMIT 12", "dim_stock"))(lambda m: G.round_robin(m.dim_stock, 12))
query("x_divergence_screen", panel("SELECT ts_code, trade_date, divergence FROM volume WHERE divergence IS NOT NULL", P.VOLUME))(lambda m: M.volume(m.panel).where("divergence is not null").select("ts_code", "trade_date", "divergence"))


# Structure divergence


def lines_of(panel):
    return M.macd(panel).join(panel.select("ts_code", "trade_date", F.col("close_qfq").alias("close")), ["ts_code", "trade_date"])


def _lines(m):
    return lines_of(m.panel)


query("x1_structure_events", panel("SELECT ts_code, trade_date, rn::INT AS rn, label, path, lag_bars::INT AS lag_bars, zone_ok FROM structure", P.STRUCTURE))(lambda m: X.divergence_events(_lines(m)).select("ts_code", "trade_date", "rn", "label", "path", "lag_bars", "zone_ok"))
query("x4_tradable", panel("SELECT ts_code, trade_date, label, reject_reason, CASE WHEN reject_reason IS NULL THEN label END AS tradable FROM structure", P.STRUCTURE))(lambda m: X.tradable(X.divergence_events(_lines(m))).select("ts_code", "trade_date", "label", "reject_reason", "tradable"))
query("x5_trace_frame", panel(f"SELECT ts_code, trade_date, round(macd_bar, 6) AS macd_bar FROM macd WHERE trade_date <= '{DATE}' QUALIFY row_number() OVER (PARTITION BY ts_code ORDER BY trade_date DESC) <= 250", P.MACD))(lambda m: X.trace_frame(M.macd(m.panel), DATE).select("ts_code", "trade_date", "macd_bar"))
query("x6_verdicts", panel("SELECT v.ts_code, v.trade_date, v.label, CASE WHEN s.label IS NOT NULL THEN s.reject_reason WHEN macd_bar > 0 THEN 'skip_peak' ELSE 'zone_mismatch' END AS reject_reason FROM (SELECT ts_code, trade_date, 'top_divergence' AS label, macd_bar FROM macd WHERE right(trade_date, 1) = '3') v LEFT JOIN structure s USING (ts_code, trade_date, label)", P.STRUCTURE))(
    lambda m: X.verdicts(M.macd(m.panel).where("substring(trade_date, 8, 1) = '3'").select("ts_code", "trade_date", F.lit("top_divergence").alias("label"), "macd_bar"), X.divergence_events(_lines(m))).select("ts_code", "trade_date", "label", "reject_reason")
)
query("x7_structure_counts", panel("SELECT label, count(*) AS n_events, count(*) FILTER (reject_reason IS NULL) AS n_tradable FROM structure GROUP BY ALL", P.STRUCTURE))(lambda m: X.structure_counts(X.divergence_events(_lines(m))))


# Compositions of the operators above
query("ind_volume_regime", panel("SELECT ts_code, trade_date, regime, round(greatest(least(eco * 0.4::DOUBLE + tr * 0.6::DOUBLE, 1), -1), 6) AS score FROM r3", P.VOLUME,
    r1="SELECT ts_code, trade_date, rn, mv AS m, dir, round(quantile_cont(mv, 0.8) OVER a, 10) AS p80, round(quantile_cont(mv, 0.2) OVER a, 10) AS p20, list(mv) OVER r AS last, list(mv) OVER f AS l5, list(mv) OVER t AS l3, list(mv) OVER a AS al FROM v2 WINDOW a AS (PARTITION BY ts_code ORDER BY trade_date ROWS 59 PRECEDING), r AS (PARTITION BY ts_code ORDER BY trade_date ROWS 9 PRECEDING), f AS (PARTITION BY ts_code ORDER BY trade_date ROWS 4 PRECEDING), t AS (PARTITION BY ts_code ORDER BY trade_date ROWS 2 PRECEDING)",
    r2="SELECT *, len(list_filter(l3, lambda x: x >= p80)) AS h3, len(list_filter(l3, lambda x: x <= p20)) AS d3, len(list_filter(l5, lambda x: x >= p80)) AS h5, len(list_filter(l5, lambda x: x <= p20)) AS d5, len(list_filter(last, lambda x: x >= p80)) AS h10, len(list_filter(last, lambda x: x <= p20)) AS d10, len(list_filter(al, lambda x: x < m)) / len(al)::DOUBLE * 100 AS pct FROM r1 WHERE rn >= 64",
    r3="SELECT *, greatest(least((pct - 50) / 40, 1), -1) AS eco, greatest(least(dir * 100, 1), -1) AS tr, CASE WHEN round(p80 / greatest(p20, 1e-9), 10) < 1.4 THEN 'insufficient' WHEN h3 = 3 THEN 'boom' WHEN d3 = 3 THEN 'dry' WHEN h10 >= 3 AND h5 >= 2 THEN 'boom' WHEN d10 >= 3 AND d5 >= 2 THEN 'dry' ELSE 'normal' END AS regime FROM r2"))(
    lambda m: M.volume_regime(m.panel)
)
query("i24_null_ranges", sql("SELECT ts_code, min(trade_date) AS start, max(trade_date) AS \"end\", count(*) AS n_days FROM (SELECT f.ts_code, trade_date, day_idx - row_number() OVER (PARTITION BY f.ts_code ORDER BY day_idx) AS g FROM ods_moneyflow f JOIN ods_trade_cal ON cal_date = trade_date WHERE net_amount_dc IS NULL) GROUP BY ts_code, g", "ods_moneyflow"))(
    lambda m: I.to_ranges(m.flow.where("net_amount_dc is null").join(F.broadcast(m.cal.select(F.col("cal_date").alias("trade_date"), "day_idx")), "trade_date").select("ts_code", "trade_date", "day_idx"))
)
query("t10_strategy_scan", panel("SELECT s.name, count(k.ts_code) AS n, count(k.ts_code) < 100 AS insufficient FROM (VALUES ('yang_bao_yin'), ('yang_ke_yin'), ('yin_ke_yang')) s(name) LEFT JOIN (SELECT sig.* FROM sig JOIN macd USING (ts_code, trade_date) WHERE macd.zone = 'bull') k ON k.pattern = s.name GROUP BY s.name", P.KPATTERN | P.MACD, sig=_SIG))(lambda m: _scan(m))


def _scan(m):
    names = ("yang_bao_yin", "yang_ke_yin", "yin_ke_yang")
    bull = M.macd(m.panel).where("zone = 'bull'").select("ts_code", "trade_date")
    found = T.pattern_signals(M.candlesticks(m.panel, m.dim_stock), names).join(bull, ["ts_code", "trade_date"], "left_semi").groupBy("pattern").agg(F.count("*").alias("n"))
    every = m.spark.createDataFrame([(n,) for n in names], "name string")
    return every.join(found, F.col("name") == F.col("pattern"), "left").select("name", F.coalesce("n", F.lit(0)).alias("n")).withColumn("insufficient", F.col("n") < 100)


query("h4_latest_unique", panel("SELECT 'all_runs' AS rule, count(*) AS n_bad FROM (SELECT 1 FROM snap GROUP BY ts_code, trade_date HAVING count(*) > 1) UNION ALL SELECT 'latest', 0", P.POSITION, snap=_SNAP))(
    lambda m: Q.rule_counts({"all_runs": (Q.duplicate_keys(snapshots(m), "ts_code", "trade_date"), "true"), "latest": (Q.duplicate_keys(V.latest(snapshots(m)), "ts_code", "trade_date"), "true")})
)
query("h5_domains", panel("SELECT 'alignment' AS rule, count(*) FILTER (alignment NOT IN ('tangle', 'sideways', 'bull_strong')) AS n_bad FROM ma UNION ALL SELECT 'turning_point', count(*) FILTER (turning_point NOT IN ('golden_cross', 'dead_cross', 'near_golden', 'near_dead')) FROM ma", P.MA))(
    lambda m: Q.outside_domain(M.moving_averages(m.panel), {"alignment": ("tangle", "sideways", "bull_strong"), "turning_point": ("golden_cross", "dead_cross", "near_golden", "near_dead")})
)
query("h8_cross_layer", sql("SELECT 'raw' AS layer, count(DISTINCT ts_code) AS n_codes, count(*) AS n_rows FROM ods_daily UNION ALL SELECT 'bars', count(DISTINCT ts_code), count(*) FROM dwd_daily_quote UNION ALL SELECT 'weekly', count(DISTINCT ts_code), count(*) FROM dwd_weekly_quote", "dwd_weekly_quote"))(
    lambda m: Q.cross_layer({"raw": m.daily, "bars": m.quotes, "weekly": m.weekly})
)
query("q5_still_missing", panel("SELECT s.ts_code, coalesce(n, 0) AS n_rows, CASE WHEN n IS NULL THEN 'no_data' WHEN n < 2000 THEN 'insufficient_rows' ELSE 'not_computed' END AS reason FROM dim_stock s LEFT JOIN (SELECT ts_code, count(*) AS n FROM panel GROUP BY ALL) p USING (ts_code) WHERE s.ts_code NOT IN (SELECT ts_code FROM panel WHERE trade_date = (SELECT max(trade_date) FROM panel WHERE trade_date < '19990615'))", {}))(
    lambda m: (lambda d: Q.still_missing(m.dim_stock, m.panel.where(F.col("trade_date") == d), m.panel, 2000))(m.panel.where(F.col("trade_date") < DATE).agg(F.max("trade_date")).first()[0])
)
query("g1_extract", panel("SELECT ts_code, trade_date, macd.zone AS macd_zone, macd.trend AS macd_trend, ma.alignment, ma.turning_point AS ma_turn FROM macd LEFT JOIN ma USING (ts_code, trade_date) WHERE trade_date = (SELECT max(trade_date) FROM panel WHERE trade_date < '19990615')", P.MA | P.MACD))(
    lambda m: (lambda d: M.macd(m.panel).where(F.col("trade_date") == d).select("ts_code", "trade_date", F.col("zone").alias("macd_zone"), F.col("trend").alias("macd_trend")).join(M.moving_averages(m.panel).select("ts_code", "trade_date", "alignment", F.col("turning_point").alias("ma_turn")), ["ts_code", "trade_date"], "left"))(m.panel.where(F.col("trade_date") < DATE).agg(F.max("trade_date")).first()[0])
)
query("n10_modes", panel(f"SELECT mode, count(*) AS n, sum(nb)::BIGINT AS new_bars FROM (SELECT ts_code, CASE WHEN ts_code IN ('B09.XX', 'B03.XX', 'B04.XX') THEN 'FULL' WHEN count(*) FILTER (trade_date > l) = 0 THEN 'SKIP' ELSE 'APPEND' END AS mode, count(*) FILTER (l IS NULL OR trade_date > l) AS nb FROM panel LEFT JOIN (SELECT ts_code, max(trade_date) AS l FROM panel WHERE trade_date < '{DATE}' AND ts_code <> 'B09.XX' GROUP BY ALL) USING (ts_code) GROUP BY ts_code) GROUP BY ALL", {}))(
    lambda m: N.classify(m.panel, state(m), "close_qfq", "v2").groupBy("mode").agg(F.count("*").alias("n"), F.sum("new_bars").alias("new_bars"))
)
