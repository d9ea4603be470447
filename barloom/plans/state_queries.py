"""Registered queries of stored states, stored layers, guards, routes and the full gate, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barloom.functions import kernels as K
from barloom.operators import backtest as T
from barloom.operators import bars as B
from barloom.operators import gate as G
from barloom.operators import incremental as N
from barloom.operators import indicators as M
from barloom.operators import quality as Q
from barloom.operators import structure as X
from barloom.operators import views as V
from barloom.sources import store

from . import further_queries as U
from . import layer_queries as L
from . import panel_sql as P
from .base_sql import CTES, sql
from .queries import _TO, DATE, UPTO, query, r6, stored_before


def state(m, name: str, build, by: str | None = None):
    """A state of the day before DATE, written as runs before would have left it; results, which are many rows, ``by`` instrument."""
    return store.layer(m.spark, m.sf_dir, f"state_{name}", build, by)


def _before(rows):
    return rows.where(F.col("trade_date") < DATE)


def _close(m):
    return m.panel.select("ts_code", "trade_date", F.col("close_qfq").alias("close"))


def _macd_state(m):
    return state(m, "macd", lambda: M.macd_state(_before(m.panel)))


def _dde_state(m):
    return state(m, "dde", lambda: M.dde_state(_before(m.moneyflow), _before(m.panel)))


def _structure_state(m, lines=None):
    return state(m, "structure", lambda: X.structure_state(_before(L._lines(m) if lines is None else lines)))


def _flow_structure_state(m):
    return state(m, "flow_structure", lambda: X.structure_state(_before(X.flow_lines(M.dde(m.moneyflow, m.panel), m.panel)), True))


def _new_macd(m, s):
    return M.continue_macd(m.panel, s)


def _new_lines(m):
    """The MACD lines after DATE, from the state, with their closes."""
    return _new_macd(m, _macd_state(m))[0].join(_close(m).where(F.col("trade_date") >= DATE), ["ts_code", "trade_date"])


# Appends from stored states
_LONG = f"ts_code IN (SELECT ts_code FROM panel WHERE trade_date < '{DATE}' GROUP BY ts_code HAVING count(*) >= 27)"
_FLOWN = f"ts_code IN (SELECT ts_code FROM f0 WHERE trade_date < '{DATE}' GROUP BY ts_code HAVING count(*) >= 10 AND count(ddx) >= 5)"
_MACD = r6("ts_code, trade_date, zone, alert, trend, turning_point", "ema_12", "ema_26", "dif", "dea", "macd_bar", "trend_strength")
_EVENT = "ts_code, trade_date, rn::INT AS rn, label, path, lag_bars::INT AS lag_bars, zone_ok"
_EVENTS = ("ts_code", "trade_date", "rn", "label", "path", "lag_bars", "zone_ok")
query("n6_append_macd_labels", L.panel(f"SELECT {_MACD} FROM macd WHERE trade_date >= '{DATE}' AND {_LONG}", P.MACD))(lambda m: _new_macd(m, _macd_state(m))[0])
query("n6_append_dde", L.panel(f"SELECT {r6('ts_code, trade_date, trend, alert', 'ddx', 'ddx2', 'trend_strength')} FROM dde WHERE trade_date >= '{DATE}' AND {_FLOWN}", P.DDE))(
    lambda m: M.continue_dde(m.moneyflow, m.panel, _dde_state(m))[0]
)
query("n6_append_structure", L.panel(f"SELECT {_EVENT} FROM structure WHERE trade_date >= '{DATE}' AND {_LONG}", P.STRUCTURE))(
    lambda m: X.continue_structure(_new_lines(m), _structure_state(m))[0].select(*_EVENTS)
)
query("n6_append_flow_structure", L.panel(f"SELECT {_EVENT} FROM flow_structure WHERE trade_date >= '{DATE}' AND {_FLOWN}", P.FLOW_STRUCTURE))(
    lambda m: X.continue_structure(X.flow_lines(M.continue_dde(m.moneyflow, m.panel, _dde_state(m))[0], m.panel.where(F.col("trade_date") >= DATE)), _flow_structure_state(m), True)[0].select(*_EVENTS)
)
query("m8_guarded_append", L.panel(f"SELECT {r6('ts_code, trade_date, zone', 'dif', 'dea')} FROM macd WHERE trade_date >= '{DATE}' AND {_LONG}", P.MACD))(
    lambda m: N.guarded(_new_macd(m, _macd_state(m))[0], N.after(m.panel, _macd_state(m))).select("ts_code", "trade_date", "zone", "dif", "dea")
)

def _last(m):
    return _before(m.panel).groupBy("ts_code").agg(F.max("trade_date").alias("last_trade_date"))


query("n6_append_kpattern", L.panel(f"SELECT * REPLACE (round(strength, 6) AS strength) FROM kp WHERE trade_date >= '{DATE}'", P.KPATTERN))(
    lambda m: N.append(lambda rows: M.candlesticks(rows, m.dim_stock), m.panel, _last(m), 75)
)
query("n6_append_position", L.panel(f"SELECT {r6('ts_code, trade_date', 'price_position_60d', 'price_position_120d', 'price_position_250d')} FROM position WHERE trade_date >= '{DATE}'", P.POSITION))(
    lambda m: N.append(M.price_position, m.panel, _last(m), 250)
)

# Mixed routes
_MODE = "CASE WHEN ts_code LIKE 'B1%' THEN 'SKIP' WHEN ts_code IN ('B03.XX', 'B22.XX', 'INDEX.XX') THEN 'FULL' ELSE 'APPEND' END"


def _modes(m):
    code = F.col("ts_code")
    mode = F.when(code.startswith("B1"), "SKIP").when(code.isin("B03.XX", "B22.XX", "INDEX.XX"), "FULL").otherwise("APPEND")
    return m.panel.select("ts_code").distinct().select("ts_code", mode.alias("mode"))


def _routes(m, results: bool = True):
    """(indicator, results, states) of three indicators, each by its instruments' modes; results have the indicator's ``label``. Where only states are asked for, nothing else is computed."""
    some = lambda rows, codes: rows.join(codes, "ts_code", "left_semi")
    labelled = lambda rows, c: rows.select("ts_code", "trade_date", F.col(c).alias("label"))
    modes = state(m, "modes", lambda: _modes(m))
    lines = state(m, "lines", lambda: L._lines(m).select("ts_code", "trade_date", "close", "dif", "dea", "macd_bar", "zone"), "ts_code") if results else None  # the stored results
    flow = state(m, "flows", lambda: labelled(M.dde(m.moneyflow, m.panel), "trend"), "ts_code") if results else None
    events = X.divergence_events(lines) if results else None
    anew = lambda c: L.lines_of(some(m.panel, c)) if lines is None else some(lines, c)

    def route(name, column, stored, known, full, fresh, onward):
        def on(s):
            rows, states = onward(s)
            return labelled(rows, column), states

        return name, *N.run_route(modes, None if stored is None else _before(stored), known, lambda c: labelled(full(c), column), fresh, on)

    yield route("macd", "zone", labelled(lines, "zone") if results else None, _macd_state(m), lambda c: M.macd(some(m.panel, c)), lambda c: M.macd_state(some(m.panel, c)), lambda s: _new_macd(m, s))
    yield route("dde", "trend", flow, _dde_state(m), lambda c: M.dde(some(m.moneyflow, c), some(m.panel, c)), lambda c: M.dde_state(some(m.moneyflow, c), some(m.panel, c)), lambda s: M.continue_dde(m.moneyflow, m.panel, s))
    yield route(
        "structure", "label", labelled(events, "label") if results else None, _structure_state(m, lines), lambda c: X.divergence_events(anew(c)), lambda c: X.structure_state(anew(c)), lambda s: X.continue_structure(_new_lines(m), s)
    )


def _union(parts):
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_ROUTED = " UNION ALL ".join(f"SELECT '{i}' AS indicator, ts_code, trade_date, {c} AS label, {_MODE} AS mode FROM {t}" for i, c, t in (("macd", "zone", "macd"), ("dde", "trend", "dde"), ("structure", "label", "structure")))
query("n19_routed_results", L.panel(f"SELECT * FROM ({_ROUTED}) WHERE mode <> 'SKIP' OR trade_date < '{DATE}'", P.STRUCTURE | P.DDE))(
    lambda m: _union(rows.select(F.lit(i).alias("indicator"), "ts_code", "trade_date", "label", "mode") for i, rows, _ in _routes(m))
)
_ENDS = f"SELECT ts_code, max(trade_date) FILTER (trade_date < '{DATE}' OR {_MODE} <> 'SKIP') AS last_trade_date FROM {{}} GROUP BY ts_code HAVING count(*) >= {{}}"
query("n19_routed_states", L.panel(" UNION ALL ".join(f"SELECT '{i}' AS indicator, * FROM ({_ENDS.format(t, n)})" for i, t, n in (("macd", "macd", 27), ("dde", "f0", 10), ("structure", "macd", 27))), P.MACD | P.DDE))(
    lambda m: _union(states.select(F.lit(i).alias("indicator"), "ts_code", "last_trade_date").distinct() for i, _, states in _routes(m, results=False))
)

# Stored layers
def _refreshed(m, name: str):
    """The stored layers of the day before DATE, brought up to the next trading day on disk, and one of them read again."""
    root = f"{store.shared_dir(m.spark)}/b13-{uuid.uuid4().hex}"
    paths = {n: f"{root}/{n}" for n in ("quotes", "weekly", "flows")}
    bars = store.staged(stored_before(m))
    store.put(bars, paths["quotes"], 8)
    store.put(B.weekly_bars(bars), paths["weekly"], 8)
    store.put(_before(m.moneyflow), paths["flows"], 8)
    day = m.daily.where(F.col("trade_date") >= DATE).agg(F.min("trade_date")).first()[0]
    B.refresh_layers(m.spark, *paths.values(), m.daily, m.basic, m.flow, m.cal, day, 8)
    return store.stored(m.spark, paths[name])


_WEEK13 = CTES["dwd_weekly_quote"].replace("dwd_daily_quote", "quote13")
query("b13_refreshed_weekly", sql(f"SELECT {r6('ts_code, trade_date', 'open_qfq', 'high_qfq', 'low_qfq', 'close_qfq', 'vol', 'pct_chg')}, active_days FROM week13", "dwd_weekly_quote", **UPTO, week13=_WEEK13))(
    lambda m: _refreshed(m, "weekly").select("ts_code", "trade_date", "open_qfq", "high_qfq", "low_qfq", "close_qfq", "vol", "pct_chg", "active_days")
)


def _marked(m):
    """The calendar with some week-ends marked wrongly and some not at all."""
    mark = F.when(F.col("day_idx") % 50 == 3, 1).when(F.col("day_idx") % 35 == 0, 0).otherwise(F.col("is_week_end"))
    return m.dim_date.withColumn("is_week_end", mark)


_MARKED = "SELECT * REPLACE (CASE WHEN day_idx % 50 = 3 THEN 1 WHEN day_idx % 35 = 0 THEN 0 ELSE is_week_end END AS is_week_end), is_week_end AS was FROM dim_date"
_STORED = {"quotes": "dwd_daily_quote", "weekly": "dwd_weekly_quote", "flows": "dwd_daily_moneyflow"}
query("b14_rebuilt_layers", sql(" UNION ALL ".join(f"SELECT '{n}' AS layer, ts_code, count(*) AS n_rows, max(trade_date) AS last FROM {t} GROUP BY ts_code" for n, t in _STORED.items()), "dwd_daily_moneyflow"))(lambda m: _rebuilt(m))


def _rebuilt(m):
    root = f"{store.shared_dir(m.spark)}/b14-{uuid.uuid4().hex}"
    paths = {n: f"{root}/{n}" for n in _STORED}
    B.rebuild_all(m.spark, *paths.values(), m.daily, m.basic, m.flow, m.cal, 8)
    ends = (store.stored(m.spark, p).groupBy("ts_code").agg(F.count("*").alias("n_rows"), F.max("trade_date").alias("last")).withColumn("layer", F.lit(n)) for n, p in paths.items())
    return _union(ends)


query("b17_repair_report", sql("""SELECT CASE WHEN is_week_end > was THEN 'wrongly_marked' ELSE 'newly_marked' END AS kind, 'dim_date' AS table_name, trade_date, 1 AS n FROM marked WHERE is_week_end <> was
    UNION ALL SELECT 'orphan', 'bars', trade_date, count(*) FROM dwd_weekly_quote JOIN marked USING (trade_date) WHERE is_week_end = 1 AND was = 0 GROUP BY trade_date
    UNION ALL SELECT 'orphan', 'position', trade_date, count(*) FROM (SELECT *, count(*) OVER (PARTITION BY ts_code) AS k FROM dwd_weekly_quote JOIN marked USING (trade_date) WHERE is_week_end = 1) WHERE k >= 2 AND was = 0 GROUP BY trade_date""",
    "dwd_weekly_quote", marked=_MARKED))(lambda m: _report(m))


def _report(m):
    panel = M.weekly_panel(m.weekly, _marked(m))
    return B.repair_report(_marked(m), {"bars": panel, "position": M.price_position(panel)})


# Slopes of what a window has
_GAPS = "SELECT * REPLACE (CASE WHEN right(trade_date, 2)::INT % 6 = 0 THEN 0 WHEN right(trade_date, 2)::INT % 11 = 0 THEN NULL ELSE vol END AS vol) FROM panel"


def _gaps(m):
    """Bars with some volumes zero and some missing; from the tenth on more than half of the days."""
    day = F.substring("trade_date", 7, 2).cast("int")
    return m.panel.withColumn("vol", F.when(day % 6 == 0, 0.0).when(day % 11 != 0, F.col("vol")))


_FOLD = """SELECT ts_code, trade_date, rn, l, len(l) AS m, list_avg(list_transform(l, lambda x: abs(x))) AS scale,
    list_transform(range(len(l)), lambda i: exp(0.4::DOUBLE * i)) AS w FROM (SELECT ts_code, trade_date, row_number() OVER p AS rn, list_filter(list(CASE WHEN vol > 0 THEN ln(vol) END) OVER (p ROWS 9 PRECEDING), lambda x: x IS NOT NULL) AS l
    FROM (SELECT *, count(*) OVER (PARTITION BY ts_code) AS n FROM gaps) WHERE n >= 5 WINDOW p AS (PARTITION BY ts_code ORDER BY trade_date))"""
_CENTER = "SELECT *, list_sum(list_transform(range(m), lambda i: w[i + 1] * i)) / list_sum(w) AS x FROM fold"
query("v5_compacted_strength", L.panel("""SELECT ts_code, trade_date, round(CASE WHEN rn >= 10 AND m >= 5 THEN CASE WHEN scale < 1e-6 THEN 0
    ELSE list_sum(list_transform(range(m), lambda i: w[i + 1] * (i - x) * l[i + 1])) / list_sum(list_transform(range(m), lambda i: w[i + 1] * (i - x) * (i - x))) / scale END END, 6) AS trend_strength FROM center""",
    {}, gaps=_GAPS, fold=_FOLD, center=_CENTER))(lambda m: M.volume(_gaps(m)).select("ts_code", "trade_date", "trend_strength"))
_K6 = "CASE WHEN count({y}) OVER w < 2 THEN 0 ELSE round(regr_slope({y}, rn) OVER w, 6) END AS {n}"
query("k6_masked_slopes", L.panel(f"""SELECT ts_code, trade_date, {_K6.format(y="CASE WHEN vol > 0 THEN ln(vol) END", n="log_slope")}, {_K6.format(y="vol", n="slope")}
    FROM (SELECT *, {P.RN} AS rn FROM thin) WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date ROWS 4 PRECEDING)""", {}, gaps=_GAPS, thin="SELECT * REPLACE (CASE WHEN right(trade_date, 2)::INT < 20 THEN vol END AS vol) FROM gaps"))(
    lambda m: _gaps(m).withColumns({"vol": F.when(F.substring("trade_date", 7, 2).cast("int") < 20, F.col("vol")), "rn": K.rn()}).select("ts_code", "trade_date", K.masked_slope("vol", 5, True).alias("log_slope"), K.masked_slope("vol", 5).alias("slope"))
)

# Gate
_DAY = f"(SELECT max(trade_date) FROM panel0 WHERE trade_date < '{DATE}')"
_CELLS = {"macd": ("trend AS {0}macd_trend", "turning_point AS {0}macd_zone", "alert AS {0}macd_alert"), "ma": ("alignment AS {0}ma_alignment",), "dde": ("trend AS {0}dde_trend", "alert AS {0}dde_alert"), "volume": ("trend AS {0}vol_trend",)}


def _gate_sql() -> str:
    """Both frequencies' indicators over their own panels, seven labels of each beside one another."""
    daily = P.MA | P.MACD | P.VOLUME | P.DDE
    weekly = P.MA | P.WEEK_MACD | P.WEEK_VOLUME | P.WEEK_DDE
    named = {"": ("macd", "ma", "dde", "volume"), "w_": ("macdw", "ma", "ddew", "volume")}
    parts = {"panel0": P.DAILY}
    for prefix, source, texts in (("d", P.DAILY, daily), ("w", P.WEEKLY, weekly)):
        texts = {"panel": source} | texts
        for k, v in texts.items():
            parts[f"{prefix}_{k}"] = _renamed(v, texts, prefix)
    joins = ""
    for prefix, tag, day in (("", "d", _DAY), ("w_", "w", f"(SELECT max(trade_date) FROM dim_date WHERE is_week_end = 1 AND trade_date <= {_DAY})")):
        for table, cells in zip(named[prefix], _CELLS.values()):
            joins += f" LEFT JOIN (SELECT ts_code, {', '.join(cells).format(prefix)} FROM {tag}_{table} WHERE trade_date = {day}) USING (ts_code)"
    return sql(f"SELECT p.ts_code, p.trade_date, (SELECT max(trade_date) FROM dim_date WHERE is_week_end = 1 AND trade_date <= {_DAY}) AS week_end, {', '.join(G.FIELDS)} FROM (SELECT ts_code, trade_date FROM panel0 WHERE trade_date = {_DAY}) p{joins}", "dwd_daily_moneyflow", **parts)


def _renamed(text: str, names, prefix: str) -> str:
    """A query with the tables of one frequency under names of their own."""
    import re

    every = "|".join(map(re.escape, names))
    text = re.sub(rf"\b(FROM|JOIN)(\s+)({every})\b", rf"\1\2{prefix}_\3", text)
    return re.sub(rf"(?<![\w.])({every})\.", rf"{prefix}_\1.", text)


query("g1_gate_extract", _gate_sql())(lambda m: _gate(m))


def _gate(m):
    date = _before(m.panel).agg(F.max("trade_date")).first()[0]
    p, w = m.panel, m.panel_w
    daily = {"macd": M.macd(p), "ma": M.moving_averages(p), "dde": M.dde(m.moneyflow, p), "volume": M.volume(p)}
    weekly = {"macd": U.week_macd(m), "ma": M.moving_averages(w), "dde": U.week_dde(m), "volume": M.volume(w, 30, U.TRADED)}
    return G.extract(p, m.dim_date, date, daily, weekly)


# Names of a reference's volume trends.
_TRENDS = {"Up": "expanding", "Down": "shrinking", "Flat": "flat"}
_RAW = "CASE WHEN k = 0 THEN 'zone·' || t WHEN k = 1 THEN 'narrow · ' || t WHEN k = 2 THEN ' narrow·odd' WHEN k = 3 THEN t WHEN k = 4 THEN ' - ' WHEN k = 5 THEN 'zone·odd' END"
query("g3_compound", L.panel(f"""SELECT ts_code, trade_date, CASE WHEN k IN (0, 1, 3) THEN trend WHEN k = 2 THEN 'flat' WHEN k = 5 THEN 'zone·odd' END AS label
    FROM (SELECT ts_code, trade_date, trend, right(trade_date, 2)::INT % 7 AS k FROM volume WHERE trend IS NOT NULL)""", P.VOLUME))(lambda m: _compound(m))


def _compound(m):
    k = F.substring("trade_date", 7, 2).cast("int") % 7
    theirs = F.create_map(*[F.lit(x) for ours, name in ((v, n) for n, v in _TRENDS.items()) for x in (ours, name)])[F.col("trend")]
    raw = F.when(k == 0, F.concat(F.lit("zone·"), theirs)).when(k == 1, F.concat(F.lit("narrow · "), theirs)).when(k == 2, " narrow·odd").when(k == 3, theirs).when(k == 4, " - ").when(k == 5, "zone·odd")
    return M.volume(m.panel).where("trend is not null").select("ts_code", "trade_date", G.compound(raw, _TRENDS, "narrow").alias("label"))


query("g6_per_instrument", L.panel("SELECT s.ts_code, count(e.label) AS n_events, count(*) FILTER (label = 'top_divergence') AS n_top, count(*) FILTER (label = 'bottom_divergence') AS n_bottom FROM dim_stock s LEFT JOIN structure e USING (ts_code) GROUP BY ALL", P.STRUCTURE))(
    lambda m: G.per_instrument(X.divergence_events(L._lines(m)), m.dim_stock)
)
query("g6b_worksheet_round_trip", L.panel(f"SELECT ts_code, trade_date, 'daily' AS freq, label FROM structure WHERE trade_date >= '{DATE}' AND right(trade_date, 1) = '5'", P.STRUCTURE))(lambda m: _round_trip(m))


def _round_trip(m):
    """Candidates of the structure's events as a worksheet, of which some rows are filled in, read again."""
    rows = G.candidates(X.divergence_events(L._lines(m)).where(F.col("trade_date") >= DATE), "daily")
    seen = F.col("impl_trade_date").endswith("5")
    filled = rows.withColumns({"golden_trade_date": F.when(seen, F.col("impl_trade_date")).otherwise(""), "golden_divergence": F.when(seen, F.concat(F.lit(" "), F.upper("impl_divergence"))).otherwise("")})
    path = f"{store.shared_dir(m.spark)}/worksheet-{uuid.uuid4().hex}"
    G.write_worksheet(filled, path)
    return G.read_worksheet(m.spark, path)[0]


# Quality
_SKIPS = "SELECT ts_code, x.indicator, CASE WHEN x.indicator = 'macd' THEN 'fingerprint_match' WHEN ts_code < 'B2' THEN 'fingerprint_match' ELSE 'insufficient_rows' END AS reason FROM (SELECT DISTINCT ts_code FROM ods_daily), (VALUES ('macd'), ('dde')) x(indicator)"


def _skips(m):
    codes = m.daily.select("ts_code").distinct().select("ts_code", F.explode(F.array(F.lit("macd"), F.lit("dde"))).alias("indicator"))
    reason = F.when((F.col("indicator") == "macd") | (F.col("ts_code") < "B2"), "fingerprint_match").otherwise("insufficient_rows")
    return codes.select(F.lit(DATE).alias("calc_date"), "ts_code", "indicator", F.lit("daily").alias("freq"), reason.alias("reason"), F.lit("same").alias("detail"))


query("q5_skip_log", sql(f"""SELECT '{DATE}' AS calc_date, ts_code, indicator, 'daily' AS freq, reason, 'same' AS detail FROM skips WHERE indicator = 'dde' OR (SELECT count(*) FROM skips WHERE indicator = 'macd') <= 20
    UNION ALL SELECT '{DATE}', '__batch__', 'macd', 'daily', 'fingerprint_match', 'batch_skip=' || count(*) FROM skips WHERE indicator = 'macd' HAVING count(*) > 20""", "ods_daily", skips=_SKIPS))(
    lambda m: (lambda new: Q.log_skips(Q.log_skips(new.limit(0), new), new))(Q.skip_log(_skips(m), most=20))
)
_NONE = "SELECT s.ts_code, count(d.ts_code) AS n FROM (SELECT CASE WHEN exchange = 'BJ' THEN left(ts_code, 3) || '.BJ' ELSE ts_code END AS ts_code, ts_code AS own FROM dim_stock) s LEFT JOIN ods_daily d ON d.ts_code = s.own AND s.ts_code = s.own AND d.trade_date >= '20000101' AND s.own NOT LIKE 'B2%' GROUP BY s.ts_code"
query("q5_missing_reasons", sql(f"SELECT '{DATE}' AS calc_date, ts_code, 'macd' AS indicator, 'daily' AS freq, CASE WHEN n = 0 AND ts_code LIKE '%.BJ' THEN 'source_unavailable' WHEN n = 0 THEN 'no_dwd_data' ELSE 'insufficient_rows' END AS reason, 'rows=' || n AS detail FROM ({_NONE})", "dim_stock"))(
    lambda m: Q.missing_reasons(_without(m), DATE, "macd", "daily")
)


def _without(m):
    bj = F.col("exchange") == "BJ"
    codes = m.dim_stock.select(F.when(bj, F.concat(F.substring("ts_code", 1, 3), F.lit(".BJ"))).otherwise(F.col("ts_code")).alias("ts_code"))
    n = m.daily.where("trade_date >= '20000101' and not startswith(ts_code, 'B2')").groupBy("ts_code").agg(F.count("*").alias("n_rows"))
    return codes.distinct().join(n, "ts_code", "left").fillna(0, ["n_rows"])


_ODD = "SELECT * REPLACE (CASE WHEN right(trade_date, 2)::INT % 8 = 0 THEN 'bear_weakening' WHEN right(trade_date, 2)::INT % 5 = 0 THEN 'bull_strong' ELSE alignment END AS alignment) FROM ma"
query("h10_contradictions", L.panel("SELECT ts_code, trade_date, CASE WHEN alignment = 'bear_weakening' THEN 'bear_weakening with MA10 rising' ELSE 'bull_strong with MA5 flat and MA10 rising' END AS rule FROM odd WHERE ma10_slope > 0.08 AND (alignment = 'bear_weakening' OR (alignment = 'bull_strong' AND ma5_slope BETWEEN -0.08 AND 0.08))", P.MA, odd=_ODD))(
    lambda m: (lambda day: N.contradictions(M.moving_averages(m.panel).withColumn("alignment", F.when(day % 8 == 0, "bear_weakening").when(day % 5 == 0, "bull_strong").otherwise(F.col("alignment")))))(F.substring("trade_date", 7, 2).cast("int"))
)
query("h10_spec_contradictions", sql("SELECT indicator, freq, count(*) FILTER (spec_version <> expected_version) AS n_stale FROM state JOIN routes USING (indicator, freq) WHERE indicator IN ('ma', 'macd', 'volume') GROUP BY ALL HAVING n_stale > 0", "dim_stock", routes=L._ROUTES, state=L._STATE))(
    lambda m: N.spec_contradictions(N.spec_freshness(L.states(m), N.routes(m.spark)))
)
_BAD = "right(trade_date, 2)::INT % 9 = 0 AND trend IS NOT NULL"
query("h11_flow_trend_audit", L.panel(f"SELECT 'trend' AS column_name, count(*) AS n, count(*) FILTER ({_BAD}) AS n_diff, CASE WHEN count(*) FILTER ({_BAD}) / count(*)::DOUBLE > 0.01 THEN 'fail' WHEN count(*) FILTER ({_BAD}) / count(*)::DOUBLE > 0.001 THEN 'warn' ELSE 'ok' END AS verdict FROM dde", P.DDE))(
    lambda m: (lambda d: Q.label_audit(d.withColumn("trend", F.when(F.substring("trade_date", 7, 2).cast("int") % 9 != 0, F.col("trend"))), d, ["trend"]))(M.dde(m.moneyflow, m.panel))
)
query("n11_stale_instruments", sql("SELECT DISTINCT ts_code, indicator, freq FROM (SELECT * FROM state UNION ALL SELECT ts_code, indicator, freq, CASE WHEN ts_code LIKE 'B22%' THEN 'v0' ELSE expected_version END FROM dim_stock, routes) JOIN routes USING (indicator, freq) WHERE spec_version <> expected_version AND indicator IN ('ma', 'macd')", "dim_stock", routes=L._ROUTES, state=L._STATE))(
    lambda m: N.stale_instruments(L.states(m), _newest(m), N.routes(m.spark), ("ma", "macd"))
)


def _newest(m):
    every = m.dim_stock.select("ts_code").join(F.broadcast(N.routes(m.spark)))
    return every.select("ts_code", "indicator", "freq", F.when(F.col("ts_code").startswith("B22"), "v0").otherwise(F.col("expected_version")).alias("spec_version"))


# Backtest and serving
query("t8_tradable_combo", L.panel("SELECT DISTINCT k.ts_code, k.trade_date, s.reject_reason IS NULL AS tradable FROM kp k JOIN structure s USING (ts_code, trade_date) WHERE label = 'top_divergence' AND (yang_ke_yin = 1 OR yin_ke_yang = 1)", P.KPATTERN | P.STRUCTURE))(lambda m: _combos(m))


def _combos(m):
    kp = M.candlesticks(m.panel, m.dim_stock)
    events = X.divergence_events(L._lines(m)).withColumn("indicator", F.lit("macd"))
    found = lambda p, judged: T.combo_signals(kp, (p,), events, {"macd": "top_divergence"}, judged)
    every = found("yang_ke_yin", False).unionByName(found("yin_ke_yang", False))
    good = found("yang_ke_yin", True).unionByName(found("yin_ke_yang", True)).withColumn("tradable", F.lit(True)).distinct()
    return every.distinct().join(good, ["ts_code", "trade_date"], "left").fillna(False, ["tradable"])


_TEXTS = {"ma_5": "mean of five closes", "alignment": "order of the averages", "turning_point": "crossing of the averages"}
query("e7_glossary", L.panel(" UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS description, count({c}) AS n_filled FROM ma" for c, t in _TEXTS.items()), P.MA))(
    lambda m: V.described(M.moving_averages(m.panel).select(*_TEXTS), _TEXTS)
)
