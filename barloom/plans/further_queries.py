"""Registered queries of the weekly indicators, flow structure, planning, state and export operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import backtest as T
from barloom.operators import bars as B
from barloom.operators import dims as D
from barloom.operators import gate as G
from barloom.operators import incremental as N
from barloom.operators import indicators as M
from barloom.operators import ingest as I
from barloom.operators import quality as Q
from barloom.operators import structure as X
from barloom.operators import views as V
from barloom.sources import layers
from barloom.sources.store import staged

from . import layer_queries as L
from . import panel_sql as P
from .base_sql import sql
from .queries import _LATEST, _STORED, DATE, query, r6, stored

TRADED = "vol * active_days / 5"


def weekly(body: str, parts: dict, **more: str) -> str:
    return sql(body, "dwd_daily_moneyflow", panel=P.WEEKLY, **parts, **more)


def week_macd(m):
    return M.weekly_macd(m.panel_w, B.resample_weekly(m.quotes))


def week_dde(m):
    weeks = B.weekly_moneyflow(m.moneyflow, m.weekly, m.dim_date, m.basic)
    ends = weeks.select("ts_code", F.col("week_end").alias("trade_date"))
    return M.weekly_dde(weeks, M.weekly_flow_trend(M.flow_frame(m.moneyflow, m.quotes), ends))


# Weekly half
query("m7_weekly_macd", weekly(f"SELECT {r6('ts_code, trade_date, zone, alert, trend, turning_point', 'ema_12', 'ema_26', 'dif', 'dea', 'macd_bar', 'trend_strength')} FROM macdw", P.WEEK_MACD))(week_macd)
query("ind_kpattern_weekly", weekly("SELECT * REPLACE (round(strength, 6) AS strength) FROM kp", P.KPATTERN))(lambda m: M.candlesticks(m.panel_w, m.dim_stock))
query("ind_volume_weekly", weekly(f"SELECT {r6('ts_code, trade_date, trend, zone, divergence', 'ma_vol_5', 'volume_ratio', 'pct_vol_rank', 'trend_strength')} FROM volume", P.WEEK_VOLUME))(lambda m: M.volume(m.panel_w, 30, TRADED))
query("ind_dde_weekly", weekly(f"SELECT {r6('ts_code, trade_date, trend, alert', 'ddx', 'ddx2', 'trend_strength')} FROM ddew", P.WEEK_DDE))(week_dde)
query("i5_trend_frame", weekly(f"SELECT {r6('ts_code, trade_date', 'net_mf_amount', 'net_amount_dc', 'circ_mv', 'total_mv')} FROM fd", P.WEEK_DDE))(
    lambda m: M.flow_frame(m.moneyflow, m.quotes).select("ts_code", "trade_date", "net_mf_amount", "net_amount_dc", "circ_mv", "total_mv")
)
query("f6_legacy_trend", L.panel(f"SELECT ts_code, trade_date, CASE WHEN s > 1e-4 THEN 'up' WHEN s < -1e-4 THEN 'down' WHEN s IS NOT NULL THEN 'flat' END AS trend FROM (SELECT ts_code, trade_date, {P.slope('ddx2', 8, 0.2)} AS s FROM dde)", P.DDE))(
    lambda m: M.legacy_flow_trend(M.dde(m.moneyflow, m.panel))
)
_WIDE_W = L._WIDE.replace("'D' AS freq", "'W' AS freq").replace("dwd_daily_quote q", "panel q").replace("LEFT JOIN macd c", "LEFT JOIN macdw c").replace("LEFT JOIN dde d", "LEFT JOIN ddew d")


def wide_weekly(m):
    p = m.panel_w
    return V.wide(p, m.dim_stock, M.moving_averages(p), week_macd(m), M.candlesticks(p, m.dim_stock), M.volume(p, 30, TRADED), M.price_position(p), week_dde(m), "W").select(*L._WIDE_COLS)


query("w3_wide_weekly", weekly(f"SELECT {L._WIDE_R} FROM wide", P.MA | P.WEEK_MACD | P.POSITION | P.KPATTERN | P.WEEK_VOLUME | P.WEEK_DDE, wide=_WIDE_W))(wide_weekly)
query("w4_index_wide_weekly", weekly("SELECT ts_code, trade_date, round(q.close_qfq, 6) AS close, round(pct_chg, 6) AS pct_chg, round(dif, 6) AS dif, round(dea, 6) AS dea, zone, trend, NULL::DOUBLE AS ddx, NULL::DOUBLE AS ddx2 FROM macdw LEFT JOIN panel q USING (ts_code, trade_date) WHERE ts_code = 'INDEX.XX'", P.WEEK_MACD))(
    lambda m: V.index_wide(m.panel_w, week_macd(m), "INDEX.XX").select("ts_code", "trade_date", "close", "pct_chg", "dif", "dea", "zone", "trend", "ddx", "ddx2")
)


# Structure of the money flow, and both structures together
def _flow_events(m):
    return X.divergence_events(X.flow_lines(M.dde(m.moneyflow, m.panel), m.panel), True)


def _both(m):
    return X.all_events(L._lines(m), X.flow_lines(M.dde(m.moneyflow, m.panel), m.panel))


_TWO = P.STRUCTURE | P.FLOW_STRUCTURE | {"both_": "SELECT *, 'macd' AS indicator FROM structure UNION ALL BY NAME SELECT *, 'dde' AS indicator FROM flow_structure"}
_EVENT = "ts_code, trade_date, rn::INT AS rn, label, path, lag_bars::INT AS lag_bars, zone_ok"
query("x2_flow_events", L.panel(f"SELECT {_EVENT} FROM flow_structure", P.FLOW_STRUCTURE))(lambda m: _flow_events(m).select("ts_code", "trade_date", "rn", "label", "path", "lag_bars", "zone_ok"))
_FLOW_W = P.WEEK_DDE | {"dde": "SELECT * FROM ddew"} | {k: v for k, v in P.FLOW_STRUCTURE.items() if k not in P.DDE}
query("x2_flow_events_weekly", weekly(f"SELECT {_EVENT} FROM flow_structure", _FLOW_W))(
    lambda m: X.divergence_events(X.flow_lines(week_dde(m), m.panel_w), True).select("ts_code", "trade_date", "rn", "label", "path", "lag_bars", "zone_ok")
)
query("x10_all_events", L.panel(f"SELECT {_EVENT}, indicator FROM both_", _TWO))(lambda m: _both(m).select("ts_code", "trade_date", "rn", "label", "path", "lag_bars", "zone_ok", "indicator"))
_PICK = ", ".join(f"min({c}) FILTER (indicator = '{i}') AS {i}_{n}" for i in ("macd", "dde") for c, n in (("label", "divergence"), ("CASE WHEN reject_reason IS NULL THEN label END", "tradable"), ("reject_reason", "reject")))
query("x7_enriched", L.panel(f"SELECT ts_code, trade_date, e.* EXCLUDE (ts_code, trade_date) FROM panel LEFT JOIN (SELECT ts_code, trade_date, {_PICK} FROM both_ GROUP BY ALL) e USING (ts_code, trade_date)", _TWO))(
    lambda m: X.enriched(m.panel.select("ts_code", "trade_date"), _both(m))
)
query("x8_screen", L.panel("SELECT ts_code, label, indicator, reject_reason FROM both_ WHERE trade_date = (SELECT max(trade_date) FROM both_)", _TWO))(
    lambda m: (lambda e: X.screen(e, e.agg(F.max("trade_date")).first()[0]).select("ts_code", "label", "indicator", "reject_reason"))(staged(_both(m)))
)
_CASE = lambda c, texts: "CASE " + c + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in texts.items()) + " END"
query("x9_in_words", L.panel(f"SELECT ts_code, trade_date, indicator, CASE WHEN reject_reason IS NULL THEN {_CASE('label', {'top_divergence': '顶背离', 'bottom_divergence': '底背离'})} END AS label_text, {_CASE('reject_reason', {'skip_peak': '隔峰', 'tg_lag': '滞后', 'zone_mismatch': '区域'})} AS reason_text FROM both_", _TWO))(
    lambda m: X.in_words(_both(m)).select("ts_code", "trade_date", "indicator", "label_text", "reason_text")
)

# Backtest
_IDX = ", ".join(f"round(a.ret_{n}, 6) AS ret_{n}, round(b.ret_{n}, 6) AS index_{n}" for n in T.HOLDINGS)
query("t3_index_returns", sql(f"SELECT a.ts_code, a.trade_date, {_IDX} FROM fwd a JOIN fwd b ON b.ts_code = 'INDEX.XX' AND b.trade_date = a.trade_date WHERE a.ts_code <> 'INDEX.XX'", "dwd_daily_quote", fwd0=L._FWD0, fwd=L._FWD))(lambda m: T.index_returns(m.quotes, "INDEX.XX"))
_COMBOS = ", ".join(f"('{name}', '{p}', '{c}', '{v}')" for name, (p, c, v) in T.COMBOS.items())
query("t10_combos", L.panel(f"""SELECT name, count(d.ts_code) AS n, count(d.ts_code) < 100 AS insufficient FROM (VALUES {_COMBOS}) k(name, pattern, col, val)
    LEFT JOIN (SELECT sig.*, x.col, x.val FROM sig JOIN (SELECT ts_code, trade_date, 'macd_turning_point' AS col, turning_point AS val FROM macd UNION ALL SELECT ts_code, trade_date, 'dde_trend', trend FROM dde
               UNION ALL SELECT DISTINCT ts_code, trade_date, indicator || '_divergence', label FROM both_ WHERE reject_reason IS NULL) x USING (ts_code, trade_date)) d
    ON d.pattern = k.pattern AND d.col = k.col AND d.val = k.val GROUP BY name""", P.KPATTERN | _TWO, sig=L._SIG))(lambda m: _combos(m))


def _combos(m):
    days = M.candlesticks(m.panel, m.dim_stock).join(M.macd(m.panel).select("ts_code", "trade_date", F.col("turning_point").alias("macd_turning_point")), ["ts_code", "trade_date"], "left")
    days = days.join(M.dde(m.moneyflow, m.panel).select("ts_code", "trade_date", F.col("trend").alias("dde_trend")), ["ts_code", "trade_date"], "left")
    both = X.enriched(days, _both(m)).drop("macd_divergence", "dde_divergence")
    return T.combo_scan(both.withColumnsRenamed({"macd_tradable": "macd_divergence", "dde_tradable": "dde_divergence"}))


# Ingest
query("i1_scan", sql("SELECT ts_code, trade_date, round(close, 6) AS close FROM ods_daily WHERE trade_date >= '19990101' AND ts_code IN (SELECT ts_code FROM dim_stock WHERE is_st = 1)", "dim_stock"))(
    lambda m: layers.scan(m.spark, m.daily.inputFiles()[0].rsplit("/", 1)[0], "ods_daily", "19990101", m.dim_stock.where("is_st = 1")).select("ts_code", "trade_date", "close")
)
query("i7_attach_factor", sql("SELECT ts_code, trade_date, round(close, 6) AS close, round(CASE WHEN right(trade_date, 2)::INT % 3 > 0 THEN adj_factor END, 6) AS adj_factor FROM ods_daily", "ods_daily"))(
    lambda m: I.attach(m.daily.select("ts_code", "trade_date", "close"), m.daily.where("cast(substring(trade_date, 7, 2) as int) % 3 > 0"), "adj_factor")
)
query("i8_attach_net_amount", sql("SELECT ts_code, trade_date, round(net_mf_amount, 6) AS net_mf_amount, round(net_amount_dc, 6) AS net_amount_dc FROM ods_moneyflow", "ods_moneyflow"))(
    lambda m: I.attach(m.flow.select("ts_code", "trade_date", "net_mf_amount"), m.flow, "net_amount_dc")
)
query("i16_reference_rows", sql("SELECT ts_code, '{\"ts_code\":\"' || ts_code || '\",\"name\":\"' || name || '\"}' AS raw_json FROM ods_stock_basic WHERE delist_date IS NULL UNION ALL SELECT ts_code, 'old' FROM ods_stock_basic WHERE delist_date IS NOT NULL", "ods_stock_basic"))(
    lambda m: I.upsert(m.stock_basic.select("ts_code", F.lit("old").alias("raw_json")), layers.reference_rows(m.stock_basic.where("delist_date is null").select("ts_code", "name")).select("ts_code", "raw_json"), "ts_code")
)
query("i19_calendar_slice", sql("SELECT cal_date AS trade_date FROM ods_trade_cal WHERE is_open = 1 AND cal_date BETWEEN '19980101' AND '19981231'", "ods_trade_cal"))(
    lambda m: I.calendar_slice(m.cal, "19980101", "19981231").unionByName(I.calendar_slice(m.cal, "19800101", "19981231"))
)
for _by in ("trade_date", "ts_code"):
    query(f"i25_backfill_{_by}", sql(f"SELECT DISTINCT {_by}, 'net_amount_dc' AS needs FROM ods_moneyflow WHERE trade_date BETWEEN '19960601' AND '19970301' AND net_amount_dc IS NULL UNION ALL SELECT DISTINCT d.{_by}, 'circ_mv' FROM ods_daily d LEFT JOIN ods_daily_basic b USING (ts_code, trade_date) WHERE d.trade_date BETWEEN '19960601' AND '19970301' AND circ_mv IS NULL", "ods_moneyflow"))(
        lambda m, _by=_by: I.needing_backfill(m.flow, m.daily, m.basic, "19960601", "19970301", _by)
    )
query("i26_required_ranges", sql(f"""SELECT ts_code, start, "end", expected::INT AS expected, actual FROM (SELECT x.*, (SELECT count(*) FROM ods_trade_cal c WHERE is_open = 1 AND cal_date BETWEEN start AND "end") AS expected,
    (SELECT count(DISTINCT trade_date) FROM ods_daily d WHERE d.ts_code = x.ts_code AND d.trade_date BETWEEN start AND "end") AS actual
    FROM (SELECT s.ts_code, e AS "end", greatest(list_date, (SELECT min(cal_date) FROM (SELECT cal_date FROM ods_trade_cal WHERE is_open = 1 AND cal_date <= '{DATE}' ORDER BY cal_date DESC LIMIT 20))) AS start
          FROM (SELECT *, CASE WHEN coalesce(delist_date, '') <> '' AND delist_date < '{DATE}' THEN delist_date ELSE '{DATE}' END AS e FROM dim_stock) s) x) WHERE NOT (actual > 0 AND actual >= expected)""", "dim_stock"))(
    lambda m: I.required_ranges(m.dim_stock, m.daily, m.cal, DATE, 20)
)
query("i27_fixed_codes", sql("SELECT ts_code, symbol || CASE WHEN symbol[1] IN ('6', '9') THEN '.SH' WHEN symbol[1] IN ('0', '2', '3') THEN '.SZ' WHEN symbol[1] IN ('4', '8') THEN '.BJ' END AS fixed FROM dim_stock", "dim_stock"))(
    lambda m: m.dim_stock.select("ts_code", I.fix_code(F.concat(F.lit(" "), "symbol")).alias("fixed"))
)
query("i28_projected", sql("SELECT ts_code, trade_date, round(total_mv, 6) AS total_mv, NULL::DOUBLE AS circ_mv, NULL::DOUBLE AS pe_ttm, NULL::DOUBLE AS turnover_rate, NULL::DOUBLE AS volume_ratio FROM ods_daily_basic", "ods_daily_basic"))(
    lambda m: layers.conform(m.basic.select("trade_date", "ts_code", "total_mv"), "ods_daily_basic")
)
query("i29_patch_both", sql(f"SELECT ts_code, trade_date, round(coalesce(b.circ_mv, CASE WHEN trade_date = (SELECT max(trade_date) FROM ods_daily WHERE trade_date < '{DATE}') THEN b.total_mv END), 6) AS circ_mv, round(b.pe_ttm, 6) AS pe_ttm FROM ods_daily_basic b", "ods_daily_basic"))(
    lambda m: I.patch_both(m.basic.select("ts_code", "trade_date", "circ_mv", "pe_ttm"), m.basic.select("ts_code", "trade_date", F.col("total_mv").alias("circ_mv"), "pe_ttm"), m.daily.where(F.col("trade_date") < DATE).agg(F.max("trade_date")).first()[0], ("circ_mv", "pe_ttm"))
)
query("d8_range_report", sql("SELECT cal_date AS trade_date, count(d.ts_code) AS n_rows, CASE WHEN count(d.ts_code) > 0 THEN 'ok' ELSE 'failed' END AS status FROM ods_trade_cal c LEFT JOIN (SELECT * FROM ods_daily WHERE ts_code = 'B07.XX') d ON d.trade_date = cal_date WHERE is_open = 1 AND cal_date BETWEEN '19980101' AND '19981231' GROUP BY cal_date", "ods_daily"))(
    lambda m: D.range_report(m.daily.where("ts_code = 'B07.XX'"), m.cal, "19980101", "19981231")
)
query("b9_needing_refresh", sql(f"SELECT DISTINCT ts_code FROM (SELECT ts_code FROM stored JOIN latest l USING (ts_code, trade_date) WHERE abs(close_qfq - l.close * l.adj_factor / latest) > 1e-6 UNION ALL SELECT ts_code FROM (SELECT *, lag(adj_factor) OVER (PARTITION BY ts_code ORDER BY trade_date) AS before FROM ods_daily) WHERE before IS NOT NULL AND adj_factor IS DISTINCT FROM before AND trade_date = (SELECT max(trade_date) FROM ods_daily WHERE trade_date < '{DATE}') UNION ALL SELECT ts_code FROM ods_daily d WHERE trade_date = (SELECT max(trade_date) FROM ods_daily WHERE trade_date < '{DATE}') AND ts_code = 'B05.XX')", "adjusted", stored=_STORED, latest=_LATEST))(
    lambda m: B.needing_refresh(m.daily, stored(m), m.daily.where(F.col("trade_date") < DATE).agg(F.max("trade_date")).first()[0])
)


# Quality
def _cut(rows, code):
    return rows.where(f"not (ts_code = '{code}' and trade_date >= '{DATE}')")


_LASTDAY = "(SELECT max(trade_date) FROM ods_daily)"
query("q3_stale_bars", sql(f"SELECT DISTINCT ts_code FROM ods_daily WHERE trade_date = {_LASTDAY} AND (ts_code IN ('B02.XX', 'B04.XX') OR (ts_code = 'B06.XX' AND EXISTS (SELECT 1 FROM ods_moneyflow f WHERE f.ts_code = 'B06.XX' AND f.trade_date = {_LASTDAY})) OR ts_code NOT IN (SELECT ts_code FROM dwd_daily_quote WHERE trade_date = {_LASTDAY}) OR ts_code NOT IN (SELECT ts_code FROM dwd_weekly_quote WHERE trade_date = {_LASTDAY}))", "dwd_weekly_quote"))(
    lambda m: Q.stale_bars(m.daily, m.flow, m.daily.agg(F.max("trade_date")).first()[0], quotes=_cut(m.quotes, "B02.XX"), weekly=_cut(m.weekly, "B04.XX"), moneyflow=_cut(m.moneyflow, "B06.XX"))
)
query("q4_to_compute", sql("SELECT ts_code FROM dim_stock WHERE NOT (coalesce(delist_date, '') <> '' AND delist_date < '20010101' AND ts_code IN (SELECT ts_code FROM dwd_daily_quote))", "dwd_daily_quote"))(lambda m: Q.to_compute(m.dim_stock, m.quotes, "20010101"))
query("q7_latest_steps", "SELECT step_name, day, count(*) AS n_runs, arg_max(duration_s, (ts, duration_s, row_count)) AS duration_s, arg_max(row_count, (ts, duration_s, row_count)) AS row_count FROM (SELECT event_type AS step_name, strftime(ts, '%Y%m%d') AS day, ts, trunc(value)::BIGINT AS duration_s, (props->>'$.k')::BIGINT AS row_count FROM events) GROUP BY ALL")(
    lambda m: Q.latest_steps(Q.step_log(m.spark.read.parquet(f"{m.sf_dir}/events.parquet").select(F.col("event_type").alias("step_name"), F.col("ts").alias("started_at"), F.expr("timestampadd(SECOND, cast(value as int), ts)").alias("finished_at"), F.replace("props", F.lit('"k"'), F.lit('"rows"')).alias("audit"))))
)
_MARK = "right(trade_date, 2)::INT % 9 = 0"
_AUD = lambda c: f"SELECT '{c}' AS column_name, count(*) AS n, count(*) FILTER ({_MARK} AND {c} IS NOT NULL) AS n_diff, CASE WHEN count(*) FILTER ({_MARK} AND {c} IS NOT NULL) / count(*)::DOUBLE > 0.01 THEN 'fail' WHEN count(*) FILTER ({_MARK} AND {c} IS NOT NULL) / count(*)::DOUBLE > 0.001 THEN 'warn' ELSE 'ok' END AS verdict FROM macd WHERE trade_date >= '{DATE}'"
query("h13_macd_audit", L.panel(f"{_AUD('trend')} UNION ALL {_AUD('turning_point')}", P.MACD))(
    lambda m: (lambda a: Q.label_audit(a.withColumns({c: F.when(F.substring("trade_date", 7, 2).cast("int") % 9 != 0, F.col(c)) for c in ("trend", "turning_point")}), a, ["trend", "turning_point"]))(M.macd(m.panel).where(F.col("trade_date") >= DATE).select("ts_code", "trade_date", "trend", "turning_point"))
)

# Incremental
query("n1_recalc_bars", L.panel("SELECT ts_code, indicator, least(n, need) AS bars FROM (SELECT ts_code, count(*) AS n FROM panel GROUP BY ALL), (VALUES ('macd', 286), ('ma', 25), ('kpattern', 75), ('dde', 265), ('volume', 130), ('position', 250), ('all', 291)) w(indicator, need)", {}))(lambda m: N.recalc_bars(m.panel))
query("n6_append_macd", L.panel(f"SELECT {r6('ts_code, trade_date', 'ema_12', 'ema_26', 'dif', 'dea', 'macd_bar')} FROM macd WHERE trade_date >= '{DATE}'", P.MACD))(
    lambda m: M.append_macd(m.panel, M.macd(m.panel.where(F.col("trade_date") < DATE)))
)
query("n6_append_volume", L.panel(f"SELECT {r6('ts_code, trade_date, trend, zone, divergence', 'ma_vol_5', 'volume_ratio', 'pct_vol_rank', 'trend_strength')} FROM volume WHERE trade_date >= '{DATE}'", P.VOLUME))(
    lambda m: M.append_volume(m.panel, M.volume(m.panel.where(F.col("trade_date") < DATE)))
)
query("n4_spare_unchanged", L.panel("SELECT DISTINCT ts_code, CASE WHEN ts_code < 'B10' AND ts_code <> 'B01.XX' THEN 'SKIP' ELSE 'FULL' END AS mode FROM panel", {}))(lambda m: _spare(m))


def _spare(m):
    prints = N.fingerprint(m.panel, "close_qfq")
    modes = prints.select("ts_code", F.lit("FULL").alias("mode"), F.when(F.col("ts_code") < "B10", 0).otherwise(3).alias("new_bars"))
    return N.spare_unchanged(modes, prints, prints.withColumn("fp", F.when(F.col("ts_code") == "B01.XX", F.lit("0")).otherwise(F.col("fp")))).select("ts_code", "mode")


query("k16_fingerprint", L.panel("SELECT ts_code, sha256(concat_ws('|', printf('%.4f', min(close_qfq)), printf('%.4f', max(close_qfq)), count(close_qfq)::VARCHAR, max(trade_date))) AS fp FROM panel GROUP BY ALL", {}))(lambda m: N.fingerprint(m.panel, "close_qfq"))
_ROWS8 = f"SELECT ts_code, indicator, freq, '{DATE}' AS last_trade_date, 'a' AS history_fp, 'v1' AS spec_version FROM dim_stock, routes"
query("n8_upsert_state", sql(f"SELECT ts_code, indicator, freq, CASE WHEN indicator = 'macd' AND ts_code >= 'B10' THEN '20000101' ELSE last_trade_date END AS last_trade_date, CASE WHEN indicator = 'macd' AND ts_code >= 'B10' THEN 'b' ELSE 'a' END AS history_fp, CASE WHEN indicator = 'macd' AND ts_code >= 'B10' THEN 'v2' ELSE 'v1' END AS spec_version FROM ({_ROWS8})", "dim_stock", routes=L._ROUTES))(lambda m: _upserted(m))


def _state8(m):
    return m.dim_stock.select("ts_code").join(F.broadcast(N.routes(m.spark).select("indicator", "freq"))).select("ts_code", "indicator", "freq", F.lit(DATE).alias("last_trade_date"), F.lit("a").alias("history_fp"), F.lit("v1").alias("spec_version"))


def _upserted(m):
    late = F.col("ts_code") >= "B10"
    new = _state8(m).where("indicator = 'macd'").withColumns({"last_trade_date": F.when(late, "20000101").otherwise(F.col("last_trade_date")), "history_fp": F.when(late, "b").otherwise("a"), "spec_version": F.lit("v2")})
    return N.upsert_state(_state8(m), new)


query("n13_may_skip", sql(f"SELECT 0::BIGINT AS n_written, s.n_stale, o.n_old_spec::BIGINT AS n_old_spec, p.n_snapshots, s.n_stale = 0 AND o.n_old_spec = 0 AND p.n_snapshots > 0 AS may_skip FROM (SELECT count(DISTINCT ts_code) AS n_stale FROM ods_daily WHERE trade_date = {_LASTDAY} AND (ts_code NOT IN (SELECT ts_code FROM dwd_daily_quote WHERE trade_date = {_LASTDAY}) OR ts_code NOT IN (SELECT ts_code FROM dwd_weekly_quote WHERE trade_date = {_LASTDAY}))) s, (SELECT count(*) FILTER (spec_version <> expected_version) AS n_old_spec FROM state JOIN routes USING (indicator, freq)) o, (SELECT count(*) AS n_snapshots FROM dwd_daily_quote WHERE is_suspended = 0 AND trade_date >= {_LASTDAY}) p", "dwd_weekly_quote", routes=L._ROUTES, state=L._STATE))(lambda m: _may_skip(m))


def _may_skip(m):
    day = m.daily.agg(F.max("trade_date")).first()[0]
    written = I.changed_rows(m.daily, m.daily, ["close", "vol"]).where("is_changed")
    stale = Q.stale_bars(m.daily, m.flow, day, quotes=m.quotes, weekly=m.weekly, moneyflow=m.moneyflow)
    return N.may_skip(written, stale, N.spec_freshness(L.states(m), N.routes(m.spark)), m.panel, day)


_BJ = "SELECT CASE WHEN exchange = 'BJ' THEN left(ts_code, 3) || '.BJ' ELSE ts_code END AS ts_code FROM dim_stock"
query("n16_refresh_scope", sql("SELECT indicator, freq, n AS n_codes, n * 5 AS n_work FROM (SELECT indicator, freq, CASE WHEN indicator = 'dde' THEN (SELECT count(*) FROM bj WHERE ts_code NOT LIKE '%.BJ') ELSE (SELECT count(*) FROM bj) END AS n FROM routes WHERE indicator IN ('macd', 'dde'))", "dim_stock", routes=L._ROUTES, bj=_BJ))(
    lambda m: N.refresh_scope(m.dim_stock.select(F.when(F.col("exchange") == "BJ", F.concat(F.substring("ts_code", 1, 3), F.lit(".BJ"))).otherwise(F.col("ts_code")).alias("ts_code")), N.routes(m.spark), 5, ("macd", "dde"))
)
query("n18_settled", sql("SELECT ts_code, count(*) FILTER (s.spec_version = expected_version AND NOT (ts_code < 'B05' AND freq = 'daily')) = 12 AS settled FROM (SELECT ts_code, indicator, freq, CASE WHEN ts_code < 'B10' THEN expected_version ELSE 'v2' END AS spec_version FROM dim_stock, routes) s JOIN routes USING (indicator, freq) GROUP BY ALL", "dim_stock", routes=L._ROUTES))(
    lambda m: N.settled(_state8(m).join(F.broadcast(N.routes(m.spark)), ["indicator", "freq"]).select("ts_code", "indicator", "freq", F.when((F.col("ts_code") < "B05") & (F.col("freq") == "daily"), "19950101").otherwise(DATE).alias("last_trade_date"), F.when(F.col("ts_code") < "B10", F.col("expected_version")).otherwise("v2").alias("spec_version")), N.routes(m.spark), DATE)
)
query("n22_chosen", L.panel("SELECT ts_code, trade_date FROM panel WHERE ts_code IN ('B09.XX', 'B03.XX', 'B04.XX')", {}))(lambda m: N.chosen(m.panel, N.classify(m.panel, L.state(m), "close_qfq", "v2"), "FULL").select("ts_code", "trade_date"))
query("n7_routed_ma", L.panel("SELECT ts_code, trade_date, alignment, turning_point, round(ma_5, 6) AS ma_5, round(ma10_slope, 6) AS ma10_slope FROM ma", P.MA))(
    lambda m: N.routed(M.moving_averages, m.panel, N.classify(m.panel, L.state(m), "close_qfq", "v2"), M.moving_averages(m.panel.where(F.col("trade_date") < DATE)), 60).select("ts_code", "trade_date", "alignment", "turning_point", "ma_5", "ma10_slope")
)
query("w11_stale_indicators", sql("SELECT indicator, count(*) FILTER (spec_version <> expected_version) AS n_stale FROM state JOIN routes USING (indicator, freq) GROUP BY ALL HAVING n_stale > 0", "dim_stock", routes=L._ROUTES, state=L._STATE))(
    lambda m: N.stale_indicators(N.spec_freshness(L.states(m), N.routes(m.spark)))
)

# Serving and export
query("s1_latest_analysis", L.panel(f"SELECT {L._WIDE_R} FROM wide WHERE ts_code = 'B07.XX' ORDER BY trade_date DESC LIMIT 1", L.ALL, wide=L._WIDE))(lambda m: V.latest_analysis(L.wide(m), "B07.XX").select(*L._WIDE_COLS))
_WORDS = lambda c: f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in {"bull": "above zero", "bear": "below zero", "up": "rising", "down": "falling", "flat": "flat"}.items()) + f" ELSE {c} END"
query("e4_translated", L.panel(f'SELECT ts_code AS code, trade_date AS date, {_WORDS("zone")} AS "MACD zone", {_WORDS("trend")} AS "MACD trend" FROM macd', P.MACD))(
    lambda m: V.translated(M.macd(m.panel).select("ts_code", "trade_date", F.col("zone").alias("macd_zone"), F.col("trend").alias("macd_trend")), ["macd_zone", "macd_trend"])
)
query("e5_sheet", L.panel("SELECT ts_code, stock_name, trade_date, vol_signal, round(close, 6) AS close FROM wide WHERE vol_signal IS NOT NULL", L.ALL, wide=L._WIDE))(
    lambda m: V.laid_out(L.wide(m), ["ts_code", "stock_name"], ["trade_date", "vol_signal", "close"], ["close"], True)
)
query("e6_stamped", L.panel(f"SELECT ts_code, trade_date, round(ma_5, 6) AS ma_5, alignment, left(sha256(coalesce(printf('%.4f', ma_5), '') || '|' || coalesce(alignment, '')), 16) AS input_fingerprint, '20011105' AS calc_date, 'v2' AS spec_version FROM ma WHERE trade_date >= '{DATE}'", P.MA))(
    lambda m: V.stamped(M.moving_averages(m.panel).select("ts_code", "trade_date", "ma_5", "alignment"), DATE, "20011105", "v2")
)
query("e8_views", sql("SELECT ts_code, count(*) AS n_rows, max(trade_date) AS last FROM ods_daily_basic GROUP BY ALL", "ods_daily_basic"))(lambda m: _views(m))


def _views(m):
    layers.create_views({"ods_daily_basic": m.basic})
    return m.spark.sql("SELECT ts_code, count(*) AS n_rows, max(trade_date) AS last FROM ods_daily_basic GROUP BY ts_code")


query("e9_export_audit", L.panel("SELECT count(*) AS n_rows, '{\"zone\":' || count(zone) || ',\"alert\":' || count(alert) || '}' AS audit FROM macd", P.MACD))(lambda m: V.export_audit(M.macd(m.panel), ["zone", "alert"]))

# Gate
_THEIRS = "SELECT ts_code, trade_date, CASE WHEN zone = 'bull' THEN ' UP ' WHEN zone = 'bear' THEN 'Down' ELSE '-' END AS zone_text FROM macd"
query("g2_mapped", L.panel("SELECT ts_code, trade_date, zone AS macd_zone FROM macd", P.MACD))(
    lambda m: G.mapped(M.macd(m.panel).select(F.col("ts_code").alias("code"), F.col("trade_date").alias("date"), F.when(F.col("zone") == "bull", " UP ").when(F.col("zone") == "bear", "Down").otherwise("-").alias("zone_text")), {"code": "ts_code", "date": "trade_date", "zone_text": "macd_zone"}, {"macd_zone": {"up": "bull", "down": "bear"}})
)
query("g5_verified", L.panel(f"SELECT trade_date, count(*) AS n_rows, sum(bad)::BIGINT AS n_diff, sum(bad) = 0 AS passed FROM (SELECT g.trade_date, (SELECT count(*) FROM ({L._DIFF}) d WHERE d.ts_code = g.ts_code AND d.trade_date = g.trade_date AND d.ours IS DISTINCT FROM d.theirs) AS bad FROM gold g) GROUP BY ALL", P.MA, gold=L._GOLD))(
    lambda m: G.verified(M.moving_averages(m.panel), L.golden(m), ["alignment", "turning_point"])
)
query("g6_worksheet", L.panel("SELECT DISTINCT ts_code, trade_date, label FROM (SELECT ts_code, trade_date, label FROM evt WHERE trade_date < '19990101' UNION ALL SELECT ts_code, trade_date, label FROM evt WHERE label = 'golden_cross')", P.MA, evt=L._EVT))(
    lambda m: (lambda e: G.worksheet(e.where("trade_date < '19990101'"), e.select("ts_code", "trade_date", F.when(F.col("label") == "golden_cross", F.concat(F.lit(" "), F.upper("label"))).otherwise("n/a").alias("label"))))(L._events(m))
)
