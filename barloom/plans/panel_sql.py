"""DuckDB SQL of the indicators, over the market expressions."""

from __future__ import annotations

from barloom.functions.kernels import slope_weights

BY = "PARTITION BY ts_code ORDER BY trade_date"


def lag(c: str, n: int = 1) -> str:
    return f"lag({c}, {n}) OVER ({BY})"


def over(f: str, n: int) -> str:
    return f"{f} OVER ({BY} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


RN = f"row_number() OVER ({BY})"
ALL_N = "count(*) OVER (PARTITION BY ts_code)"


def slope(c: str, n: int, decay: float = 0.0) -> str:
    return "(" + " + ".join(f"{lag(c, n - 1 - k)} * {x!r}::DOUBLE" for k, x in enumerate(slope_weights(n, decay))) + ")"


def sma(c: str, n: int) -> str:
    return f"CASE WHEN {RN} >= {n} THEN {over(f'avg({c})', n)} END"


def up(a: str, b: str) -> str:
    return f"({lag(a)} <= {lag(b)} AND {a} > {b})"


def down(a: str, b: str) -> str:
    return f"({lag(a)} >= {lag(b)} AND {a} < {b})"


DAILY = "SELECT * FROM dwd_daily_quote WHERE is_suspended = 0"
WEEKLY = "SELECT w.* FROM dwd_weekly_quote w JOIN dim_date d USING (trade_date) WHERE is_week_end = 1"

MA = {
    "m0": f"SELECT * FROM (SELECT ts_code, trade_date, close_qfq, {ALL_N} AS n FROM panel) WHERE n >= 11",
    "m1": f"SELECT *, round({sma('close_qfq', 5)}, 10) AS ma_5, round({sma('close_qfq', 10)}, 10) AS ma_10, {RN} AS rn FROM m0",
    "m2": f"""SELECT *, (close_qfq - ma_5) / ma_5 * 100 AS bias_ma5, (close_qfq - ma_10) / ma_10 * 100 AS bias_ma10,
              round({slope('ma_5', 5)} / nullif(ma_5, 0) * 100, 10) AS s5, round({slope('ma_10', 5)} / nullif(ma_10, 0) * 100, 10) AS s10,
              coalesce({up('ma_5', 'ma_10')}, false) AS up, coalesce({down('ma_5', 'ma_10')}, false) AS down, abs(ma_5 - ma_10) AS gap FROM m1""",
    "m3": f"""SELECT *, {over('sum((up OR down)::INT)', 10)} AS crosses, {lag('ma_10')} IS NOT NULL AS ready,
              round(CASE WHEN rn >= 3 THEN CASE WHEN {lag('gap', 2)} IS NULL THEN gap - {lag('gap')} ELSE (gap - {lag('gap', 2)}) / 2 END END, 10) AS gs FROM m2""",
    "ma": """SELECT ts_code, trade_date, ma_5, ma_10, bias_ma5, bias_ma10, s5 AS ma5_slope, s10 AS ma10_slope,
        CASE WHEN s5 IS NULL OR s10 IS NULL THEN NULL
             WHEN round(gap / ma_10, 10) < 0.0299 AND crosses >= 2 THEN 'tangle'
             WHEN abs(s5) < 0.08 AND abs(s10) < 0.08 THEN 'sideways'
             WHEN ma_5 > ma_10 THEN CASE
               WHEN s5 > 0.08 AND s10 > 0.08 THEN 'bull_strong' WHEN s5 > 0.08 AND s10 < -0.08 THEN 'bull_building'
               WHEN s5 < -0.08 AND s10 > 0.08 THEN 'bull_weakening' WHEN s5 < -0.08 AND s10 < -0.08 THEN 'bull_rolling'
               WHEN (s5 > 0.08 AND abs(s10) < 0.08) OR (abs(s5) < 0.08 AND s10 > 0.08) THEN 'bull_building'
               WHEN (s5 < -0.08 AND abs(s10) < 0.08) OR (abs(s5) < 0.08 AND s10 < -0.08) THEN 'bull_weakening' END
             ELSE CASE
               WHEN s5 < -0.08 AND s10 < -0.08 THEN 'bear_strong' WHEN s5 < -0.08 AND s10 > 0.08 THEN 'bear_building'
               WHEN s5 > 0.08 AND s10 < -0.08 THEN 'bear_weakening' WHEN s5 > 0.08 AND s10 > 0.08 THEN 'bear_rolling'
               WHEN (s5 < -0.08 AND abs(s10) < 0.08) OR (abs(s5) < 0.08 AND s10 > 0.08) THEN 'bear_building'
               WHEN s5 > 0.08 AND abs(s10) < 0.08 THEN 'bear_weakening' WHEN abs(s5) < 0.08 AND s10 < -0.08 THEN 'bear_strong' END END AS alignment,
        CASE WHEN NOT ready OR ma_10 IS NULL THEN NULL WHEN up THEN 'golden_cross' WHEN down THEN 'dead_cross'
             WHEN round(gap / ma_10, 10) < 0.005 OR (-gs > 1e-9 AND round(gap / -gs, 10) < 3) THEN CASE WHEN ma_5 < ma_10 THEN 'near_golden' ELSE 'near_dead' END END AS turning_point
        FROM m3""",
}

MACD = {
    "c0": f"SELECT ts_code, trade_date, close_qfq AS c, rn FROM (SELECT ts_code, trade_date, close_qfq, {ALL_N} AS n, {RN} AS rn FROM panel) WHERE n >= 27",
    "rec": """
        SELECT ts_code, rn, c AS s, c AS e12, c AS e26, 0.0::DOUBLE AS dif, 0.0::DOUBLE AS sd, 0.0::DOUBLE AS dea, c AS f10, c AS f20, 0.0::DOUBLE AS bd, 0.0::DOUBLE AS bdea FROM c0 WHERE rn = 1
        UNION ALL
        SELECT ts_code, rn, s, e12, e26, e12 - e26, sd + (e12 - e26), CASE WHEN rn <= 9 THEN (sd + (e12 - e26)) / rn ELSE 0.2::DOUBLE * (e12 - e26) + 0.8::DOUBLE * dea END,
               f10, f20, f10 - f20, 0.25::DOUBLE * (f10 - f20) + 0.75::DOUBLE * bdea
        FROM (SELECT c0.ts_code, c0.rn, s + c AS s, sd, dea, bdea,
                     CASE WHEN c0.rn <= 12 THEN (s + c) / c0.rn ELSE 2.0::DOUBLE / 13 * c + 11.0::DOUBLE / 13 * e12 END AS e12,
                     CASE WHEN c0.rn <= 26 THEN (s + c) / c0.rn ELSE 2.0::DOUBLE / 27 * c + 25.0::DOUBLE / 27 * e26 END AS e26,
                     2.0::DOUBLE / 11 * c + 9.0::DOUBLE / 11 * f10 AS f10, 2.0::DOUBLE / 21 * c + 19.0::DOUBLE / 21 * f20 AS f20
              FROM rec JOIN c0 ON c0.ts_code = rec.ts_code AND c0.rn = rec.rn + 1)""",
    "x0": """SELECT c0.ts_code, c0.trade_date, e12 AS ema_12, e26 AS ema_26, round(dif, 10) AS dif, round(dea, 10) AS dea, round(2 * (dif - dea), 10) AS macd_bar,
             round(bd, 10) AS b_dif, round(bdea, 10) AS b_dea, round(2 * (bd - bdea), 10) AS b_bar FROM rec JOIN c0 USING (ts_code, rn)""",
    "x1": f"""SELECT *, {RN} AS rn, {lag('macd_bar')} AS h1, {lag('macd_bar', 2)} AS h0, {lag('b_dif')} AS d1, {lag('b_dea')} AS a1,
              CASE WHEN {over('count(macd_bar)', 5)} = 5 THEN {over('avg(abs(macd_bar))', 5)} END AS sc, {slope('macd_bar', 5, 0.15)} AS sl, round({slope('b_bar', 5, 0.15)}, 10) AS s5,
              CASE WHEN {RN} >= 20 THEN greatest({over('stddev_pop(b_dif)', 20)}, {over('stddev_pop(b_dea)', 20)}) ELSE greatest(abs(b_dif), abs(b_dea)) END * 0.1::DOUBLE AS lim FROM x0""",
    "macd": """SELECT ts_code, trade_date, ema_12, ema_26, dif, dea, macd_bar, CASE WHEN macd_bar > 0 THEN 'bull' WHEN macd_bar < 0 THEN 'bear' END AS zone,
        CASE WHEN sc < 1e-6 THEN 0.0 ELSE sl / sc END AS trend_strength,
        CASE WHEN macd_bar > h1 AND h1 < h0 THEN 'downturn_reverse' WHEN macd_bar < h1 AND h1 > h0 THEN 'upturn_reverse' END AS alert,
        CASE WHEN abs(s5) < 0.001 THEN 'flat' WHEN s5 > 0 THEN 'up' WHEN s5 < 0 THEN 'down' END AS trend,
        CASE WHEN d1 <= a1 AND b_dif > b_dea THEN 'golden_cross' WHEN d1 >= a1 AND b_dif < b_dea THEN 'dead_cross'
             WHEN rn >= 3 AND round(abs(b_dif - b_dea), 10) < round(abs(d1 - a1), 10) AND round(abs(b_dif - b_dea), 10) < round(lim, 10) AND b_dif < b_dea AND d1 < a1 THEN 'near_golden'
             WHEN rn >= 3 AND round(abs(b_dif - b_dea), 10) < round(abs(d1 - a1), 10) AND round(abs(b_dif - b_dea), 10) < round(lim, 10) AND b_dif > b_dea AND d1 > a1 THEN 'near_dead' END AS turning_point
        FROM x1""",
}

_PP = ", ".join(
    f"CASE WHEN rn >= 2 AND {over('max(close_qfq)', n)} > {over('min(close_qfq)', n)} THEN (close_qfq - {over('min(close_qfq)', n)}) / ({over('max(close_qfq)', n)} - {over('min(close_qfq)', n)}) * 100 END AS price_position_{n}d"
    for n in (60, 120, 250)
)
POSITION = {"pp0": f"SELECT *, {RN} AS rn, {ALL_N} AS n FROM panel", "position": f"SELECT ts_code, trade_date, {_PP} FROM pp0 WHERE n >= 2"}

_VOL = lambda by: f"CASE WHEN mv > 0 THEN least(v / mv / {by}, 1) ELSE least(v / CASE WHEN v1 > 0 THEN v1 ELSE 1 END / {by}, 1) END"
_UP, _DN = "CASE WHEN rg > 0 THEN (c - l) / rg ELSE 0.5 END", "CASE WHEN rg > 0 THEN 1 - (c - l) / rg ELSE 0.5 END"
_ENG = "CASE WHEN abs(c1 - o1) > 0 THEN least(body / abs(c1 - o1) / 2.0, 1) ELSE 0 END"
_SHADOW = "CASE WHEN body > 0 THEN least(us / body / 4.0, 1) WHEN rg > 0 THEN least(us / rg / 0.8, 1) ELSE 1 END"
_CONF = "CASE WHEN gain20 THEN 1.0 WHEN high60 THEN 0.6 ELSE 0.0 END"
_LONG = "CASE WHEN body > 0 THEN round(us, 10) >= round(3.0 * body, 10) ELSE rg > 0 AND round(us / nullif(rg, 0), 10) > 0.6 END"
KPATTERN = {
    "k0": f"SELECT ts_code, trade_date, round(open_qfq, 10) AS o, round(high_qfq, 10) AS h, round(low_qfq, 10) AS l, round(close_qfq, 10) AS c, vol AS v, pct_chg, coalesce(is_st, 0) AS is_st, {ALL_N} AS n FROM panel LEFT JOIN dim_stock USING (ts_code)",
    "k1": f"""SELECT *, {RN} AS rn, {lag('o')} AS o1, {lag('c')} AS c1, {lag('v')} AS v1, {lag('c', 10)} AS c10, {lag('c', 20)} AS c20, {sma('v', 5)} AS mv, round({sma('c', 10)}, 10) AS ma10,
              {over('max(h)', 60)} AS h60, abs(c - o) AS body, h - l AS rg, h - greatest(o, c) AS us FROM k0 WHERE n >= 30""",
    "k2": "SELECT *, rn >= 60 AND c >= round(h60 * 0.9::DOUBLE, 10) AS high60, coalesce(round((c - c20) / c20, 10) > 0.15, false) AS gain20, rn >= 2 AND abs(pct_chg) < CASE WHEN is_st = 1 THEN 4.9 ELSE 9.9 END AS ok FROM k1",
    "k3": f"""SELECT *, coalesce(ok AND c1 < o1 AND c >= o AND o <= c1 AND c >= o1 AND body > 0, false)::INT AS yang_bao_yin,
        coalesce(ok AND c1 < o1 AND v > round(mv * 1.2::DOUBLE, 10) AND greatest(o, c) > greatest(o1, c1) AND c > ma10, false)::INT AS yang_ke_yin,
        coalesce(ok AND (high60 OR gain20) AND (round(body / c1, 10) < 0.005 OR coalesce(round(body / nullif(rg, 0), 10) < 0.1, false)) AND {_LONG}, false)::INT AS mu_bei_xian,
        coalesce(ok AND (high60 OR gain20) AND round(body / nullif(rg, 0), 10) < 0.2 AND round((least(o, c) + body / 2 - l) / nullif(rg, 0), 10) < 1.0::DOUBLE / 3 AND {_LONG}, false)::INT AS bi_lei_zhen,
        coalesce(ok AND round((c - c10) / c10, 10) > 0.15 AND o > c1 AND c < o AND round(body / o, 10) >= 0.05 AND v > round(mv * 1.5::DOUBLE, 10), false)::INT AS gao_kai_chang_yin,
        coalesce(ok AND c1 >= o1 AND c < o AND o >= c1 AND c <= o1 AND body > 0, false)::INT AS yin_bao_yang,
        coalesce(ok AND c1 >= o1 AND v > round(mv * 1.2::DOUBLE, 10) AND least(o, c) < least(o1, c1) AND c < ma10, false)::INT AS yin_ke_yang FROM k2""",
    "kpattern": f"""SELECT ts_code, trade_date, yang_bao_yin, yang_ke_yin, mu_bei_xian, bi_lei_zhen, gao_kai_chang_yin, yin_bao_yang, yin_ke_yang,
        least(greatest(CASE WHEN yang_bao_yin = 1 THEN 0.5::DOUBLE * {_ENG} + 0.3::DOUBLE * {_VOL(1.5)} + 0.2::DOUBLE * {_UP}
          WHEN yang_ke_yin = 1 THEN 0.4::DOUBLE * least((greatest(o, c) - greatest(o1, c1)) / greatest(o1, c1) / 0.02::DOUBLE, 1) + 0.4::DOUBLE * {_VOL(1.5)} + 0.2::DOUBLE * {_UP}
          WHEN mu_bei_xian = 1 THEN 0.4::DOUBLE * {_SHADOW} + 0.3::DOUBLE * (1 - least(body / c1 / 0.005::DOUBLE, 1)) + 0.3::DOUBLE * {_CONF}
          WHEN bi_lei_zhen = 1 THEN 0.4::DOUBLE * {_SHADOW} + 0.3::DOUBLE * coalesce(1 - (c - l) / nullif(rg, 0), 0) + 0.3::DOUBLE * {_CONF}
          WHEN gao_kai_chang_yin = 1 THEN 0.3::DOUBLE * least(body / o / 0.08::DOUBLE, 1) + 0.3::DOUBLE * {_VOL(2.5)} + 0.2::DOUBLE * least((o - c1) / c1 / 0.03::DOUBLE, 1) + 0.2::DOUBLE * coalesce(least((c - c10) / c10 / 0.25::DOUBLE, 1), 0)
          WHEN yin_bao_yang = 1 THEN 0.5::DOUBLE * {_ENG} + 0.3::DOUBLE * {_VOL(1.5)} + 0.2::DOUBLE * {_DN}
          WHEN yin_ke_yang = 1 THEN 0.4::DOUBLE * least((least(o1, c1) - least(o, c)) / least(o1, c1) / 0.02::DOUBLE, 1) + 0.4::DOUBLE * {_VOL(1.5)} + 0.2::DOUBLE * {_DN} END, 0), 1)
        AS strength_raw, yang_bao_yin + yang_ke_yin + mu_bei_xian + bi_lei_zhen + gao_kai_chang_yin + yin_bao_yang + yin_ke_yang AS fired FROM k3""",
}

VOLUME = {
    "v0": f"SELECT ts_code, trade_date, round(close_qfq, 10) AS c, vol AS v, {RN} AS rn FROM (SELECT *, {ALL_N} AS n FROM panel) WHERE n >= 5",
    "v1": f"SELECT *, round({sma('v', 5)}, 10) AS mv, CASE WHEN v > 0 THEN ln(v) END AS lv, {over('list(c)', 60)} AS cs, {over('list(v)', 60)} AS ss FROM v0",
    "v2": f"""SELECT *, {over('list(mv)', 120)} AS ms, CASE WHEN {over('count(lv)', 10)} = 10 THEN {over('avg(abs(lv))', 10)} END AS sc, {slope('lv', 10, 0.2)} AS sl,
              round({slope('v', 5)} / ({over('avg(abs(v))', 5)} + 1e-9::DOUBLE), 10) AS dir FROM v1""",
    "v3": """SELECT *, CASE WHEN rn >= 120 AND mv IS NOT NULL THEN round(len(list_filter(ms, lambda x: x IS NOT NULL AND x <= mv)) / len(list_filter(ms, lambda x: x IS NOT NULL))::DOUBLE * 100, 10) END AS pr,
             list_max(cs) AS chi, list_min(cs) AS clo, list_max(ss) AS shi, list_min(ss) AS slo FROM v2""",
    "zr": """
        SELECT ts_code, rn, pr, NULL::DOUBLE AS p1, NULL::DOUBLE AS p2, NULL::DOUBLE AS p3, NULL::DOUBLE AS p4, 'normal' AS st FROM v3 WHERE rn = 1
        UNION ALL
        SELECT ts_code, rn, pr, p1, p2, p3, p4,
               CASE WHEN pr IS NULL THEN ist
                    WHEN st1 = 'explosive' AND pr < 75 AND p1 < 75 THEN 'normal' WHEN st1 = 'low_volume' AND pr > 25 AND p1 > 25 THEN 'normal' ELSE st1 END
        FROM (SELECT v3.ts_code, v3.rn, v3.pr, zr.pr AS p1, zr.p1 AS p2, zr.p2 AS p3, zr.p3 AS p4, zr.st AS ist,
                     CASE WHEN zr.st <> 'normal' THEN zr.st WHEN v3.pr > 90 AND zr.pr > 90 THEN 'explosive'
                          WHEN v3.pr < 10 AND zr.pr < 10 AND zr.p1 < 10 AND zr.p2 < 10 AND zr.p3 < 10 THEN 'low_volume' ELSE 'normal' END AS st1
              FROM zr JOIN v3 ON v3.ts_code = zr.ts_code AND v3.rn = zr.rn + 1)""",
    "ev": """SELECT ts_code, rn, unnest(list_filter([CASE WHEN list_position(ss, shi) < 60 AND shi <> 0 AND v < shi AND c >= round(chi * 0.98::DOUBLE, 10) THEN 'top_divergence' END,
                CASE WHEN list_position(ss, slo) < 60 AND slo <> 0 AND v > slo AND round((v - slo) / abs(nullif(slo, 0)), 10) > 0.1 AND 60 - list_position(cs, clo) >= 3 AND c <= round(clo * 1.02::DOUBLE, 10) THEN 'bottom_divergence' END],
                lambda x: x IS NOT NULL)) AS label FROM v3 WHERE rn >= 60""",
    "kept": """SELECT ts_code, label, min(rn) AS rn FROM ev GROUP BY ALL
        UNION ALL
        SELECT kept.ts_code, kept.label, (SELECT min(e.rn) FROM ev e WHERE e.ts_code = kept.ts_code AND e.label = kept.label AND e.rn > kept.rn + 5) FROM kept
        WHERE EXISTS (SELECT 1 FROM ev e WHERE e.ts_code = kept.ts_code AND e.label = kept.label AND e.rn > kept.rn + 5)""",
    "volume": """SELECT ts_code, trade_date, mv AS ma_vol_5, CASE WHEN mv > 0 THEN v / mv END AS volume_ratio, pr AS pct_vol_rank,
        CASE WHEN rn >= 64 THEN CASE WHEN dir > 0.001 THEN 'expanding' WHEN dir < -0.001 THEN 'shrinking' ELSE 'flat' END END AS trend,
        CASE WHEN sc < 1e-6 THEN 0.0 ELSE sl / sc END AS trend_strength, CASE WHEN v3.pr IS NOT NULL THEN st END AS zone, d.divergence
        FROM v3 LEFT JOIN (SELECT ts_code, rn, st FROM zr) USING (ts_code, rn) LEFT JOIN (SELECT ts_code, rn, min(label) AS divergence FROM kept GROUP BY ALL) d USING (ts_code, rn)""",
}

DDE = {
    "f0": """SELECT ts_code, trade_date, net_mf_amount, (buy_lg_vol + buy_elg_vol - sell_lg_vol - sell_elg_vol) / nullif(total_vol, 0) AS ddx,
             coalesce(net_amount_dc, net_mf_amount) / nullif(coalesce(circ_mv, total_mv), 0) * 100 AS flow FROM dwd_daily_moneyflow JOIN panel USING (ts_code, trade_date)""",
    "f1": f"SELECT * FROM (SELECT *, {RN} AS rn, {ALL_N} AS n, count(ddx) OVER (PARTITION BY ts_code) AS nx FROM f0) WHERE n >= 10",
    "fr": """
        SELECT ts_code, rn, ddx AS s, CASE WHEN ddx IS NULL THEN 0 ELSE 1 END AS k, ddx AS e, flow AS w, 1.0::DOUBLE AS old FROM f1 WHERE rn = 1
        UNION ALL
        SELECT f1.ts_code, f1.rn, CASE WHEN ddx IS NULL THEN s ELSE coalesce(s, 0) + ddx END, k + CASE WHEN ddx IS NULL THEN 0 ELSE 1 END,
               CASE WHEN ddx IS NULL THEN e WHEN k + 1 <= 5 THEN (coalesce(s, 0) + ddx) / (k + 1) ELSE ddx / 3 + e * 2 / 3 END,
               CASE WHEN flow IS NULL THEN w WHEN w IS NULL THEN flow ELSE (old * 59.0::DOUBLE / 61 * w + 2.0::DOUBLE / 61 * flow) / (old * 59.0::DOUBLE / 61 + 2.0::DOUBLE / 61) END,
               CASE WHEN flow IS NULL AND w IS NOT NULL THEN old * 59.0::DOUBLE / 61 ELSE 1.0 END
        FROM fr JOIN f1 ON f1.ts_code = fr.ts_code AND f1.rn = fr.rn + 1""",
    "f2": "SELECT f1.ts_code, f1.trade_date, round(ddx, 10) AS ddx, round(CASE WHEN nx >= 5 THEN e END, 10) AS ddx2, round(w * 60.1953::DOUBLE, 10) AS sm FROM fr JOIN f1 USING (ts_code, rn)",
    "f3": f"SELECT *, CASE WHEN {over('count(sm)', 10)} = 10 THEN {over('avg(sm)', 10)} END AS m10, round({slope('ddx2', 2)}, 10) AS turn FROM f2",
    "f4": f"SELECT *, round({slope('m10', 5)}, 10) AS sl, CASE WHEN {over('count(ddx2)', 5)} = 5 THEN {over('avg(abs(ddx2))', 5)} END AS sc, {slope('ddx2', 5, 0.2)} AS s2, {lag('turn')} AS was FROM f3",
    "dde": """SELECT ts_code, trade_date, ddx, ddx2, CASE WHEN sl > 0 THEN 'up' WHEN sl < 0 THEN 'down' WHEN sl = 0 THEN 'flat' END AS trend, CASE WHEN sc > 0 THEN s2 / sc END AS trend_strength,
        CASE WHEN was < 0 AND turn > 0 THEN 'upturn_reverse' WHEN was > 0 AND turn < 0 THEN 'downturn_reverse' END AS alert FROM f4""",
}
KPATTERN["kp"] = "SELECT * EXCLUDE (strength_raw, fired), CASE WHEN fired > 0 THEN strength_raw END AS strength FROM kpattern"

_PART = "CASE WHEN {ref} IS NULL OR {ref} = 0 THEN 0 ELSE trunc({v} / pow(10.0::DOUBLE, trunc(log10(abs({ref}))) - 1))::BIGINT END"
_RUN = "OVER (PARTITION BY ts_code, gc ORDER BY rn ROWS UNBOUNDED PRECEDING)"


def _tops(k: str, sign: int) -> dict[str, str]:
    """Structure tops of the signed series, as expressions with prefix ``k``."""
    prior = lambda c: f"CASE WHEN gc IS NOT NULL THEN first({c}) {_RUN} END"
    part = lambda v, ref: _PART.format(v=v, ref=ref)
    return {
        f"{k}0": f"SELECT ts_code, trade_date, round(close_qfq * {sign}, 10) AS c, round(dif * {sign}, 10) AS f, round(dea * {sign}, 10) AS s, round(macd_bar * {sign}, 10) AS b, {RN} AS rn FROM macd JOIN panel USING (ts_code, trade_date)",
        f"{k}1": f"SELECT *, max(CASE WHEN {up('f', 's')} THEN rn END) OVER ({BY} ROWS UNBOUNDED PRECEDING) AS gc FROM (SELECT *, {lag('f')} AS f0, {lag('s')} AS s0 FROM {k}0)".replace(up("f", "s"), "f0 <= s0 AND f > s"),
        f"{k}2": f"SELECT *, CASE WHEN gc IS NOT NULL THEN max(c) {_RUN} END AS h1, CASE WHEN gc IS NOT NULL THEN max(f) {_RUN} END AS f1, CASE WHEN gc IS NOT NULL THEN max(CASE WHEN b > 0 THEN b END) {_RUN} END AS b1, arg_max(rn, c) {_RUN} AS peak FROM {k}1",
        f"{k}3": f"SELECT *, {prior('ph')} AS h2, {prior('pf')} AS f2, {prior('pb')} AS b2 FROM (SELECT *, {lag('h1')} AS ph, {lag('f1')} AS pf, {lag('b1')} AS pb FROM {k}2)",
        f"{k}4": f"SELECT *, {prior('qh')} AS h3, {prior('qf')} AS f3, {prior('qb')} AS b3 FROM (SELECT *, {lag('h2')} AS qh, CASE WHEN {lag('h2')} IS NOT NULL THEN {lag('f2')} END AS qf, CASE WHEN {lag('h2')} IS NOT NULL THEN {lag('b2')} END AS qb FROM {k}3)",
        f"{k}5": f"SELECT *, h1 IS NOT NULL AND f2 IS NOT NULL AS ok, CASE WHEN h1 IS NOT NULL AND f2 IS NOT NULL THEN {part('f', 'f2')} END AS m2, CASE WHEN h1 IS NOT NULL AND f2 IS NOT NULL THEN {part('f', 'f3')} END AS m3, coalesce(b > 0 AND {lag('b')} > 0, false) AS red FROM {k}4",
        f"{k}6": f"""SELECT *, {lag('m2')} AS l2, {lag('m3')} AS l3, coalesce(ok AND h1 > h2 AND m2 < {part('f2', 'f2')} AND red AND m2 >= {lag('m2')} AND b1 < b2, false) AS t1,
            coalesce(ok AND h1 > h3 AND h3 > h2 AND m3 < {part('f3', 'f3')} AND red AND m3 >= {lag('m3')} AND b1 < b3, false) AS t2 FROM {k}5""",
        f"{k}7": f"SELECT *, coalesce({lag('t1')}, false) AS w1, coalesce({lag('t2')}, false) AS w2 FROM {k}6",
        f"{k}8": f"SELECT ts_code, trade_date, rn, '{'top' if sign > 0 else 'bottom'}_divergence' AS label, CASE WHEN w1 THEN 'direct' ELSE 'skip_peak' END AS path, rn - peak AS lag_bars, b > 0 AS zone_ok FROM {k}7 WHERE ok AND coalesce(CASE WHEN w1 THEN m2 < l2 WHEN w2 THEN m3 < l3 END, false) AND NOT ((w1 AND f1 >= f2) OR (w2 AND coalesce(f1 >= f3, false)))",
    }


STRUCTURE = MACD | _tops("st", 1) | _tops("sb", -1) | {
    "sev": "SELECT * FROM st8 UNION ALL SELECT * FROM sb8",
    "skept": """SELECT ts_code, label, min(rn) AS rn FROM sev GROUP BY ALL
        UNION ALL
        SELECT s.ts_code, s.label, (SELECT min(e.rn) FROM sev e WHERE e.ts_code = s.ts_code AND e.label = s.label AND e.rn > s.rn + 10) FROM skept s
        WHERE EXISTS (SELECT 1 FROM sev e WHERE e.ts_code = s.ts_code AND e.label = s.label AND e.rn > s.rn + 10)""",
    "structure": "SELECT sev.*, CASE WHEN path = 'skip_peak' THEN 'skip_peak' WHEN lag_bars > 1 THEN 'tg_lag' WHEN NOT zone_ok THEN 'zone_mismatch' END AS reject_reason FROM sev SEMI JOIN skept k ON k.ts_code = sev.ts_code AND k.label = sev.label AND k.rn = sev.rn",
}


def _flow_tops(k: str, sign: int) -> dict[str, str]:
    """Structure tops of the signed money-flow lines; a peak is judged on the list of its segment's flows."""
    top = "list_max(l)"
    around = f"l[greatest(1, list_position(l, {top}) - 2):least(len(l), list_position(l, {top}) + 2)]"
    alone = f"len(list_filter({around}, lambda x: x >= {top} * 0.8::DOUBLE)) < 2" if sign > 0 else f"{top} <= 0"
    return _tops(k, sign) | {
        f"{k}0": f"SELECT ts_code, trade_date, round(close_qfq * {sign}, 10) AS c, round(ddx * {sign}, 10) AS f, round(ddx2 * {sign}, 10) AS s, round(ddx * {sign}, 10) AS b, {RN} AS rn FROM dde JOIN panel USING (ts_code, trade_date)",
        f"{k}2": f"""SELECT *, CASE WHEN f1 > 0 THEN f1 END AS b1 FROM (SELECT *, CASE WHEN whole THEN hh END AS h1, CASE WHEN whole AND NOT ({alone}) THEN {top} END AS f1
            FROM (SELECT *, gc IS NOT NULL AND count(f) {_RUN} = count(*) {_RUN} AS whole, max(c) {_RUN} AS hh, list(f) {_RUN} AS l, arg_max(rn, c) {_RUN} AS peak FROM {k}1))""",
    }


FLOW_STRUCTURE = DDE | _flow_tops("gt", 1) | _flow_tops("gb", -1) | {
    k.replace("s", "g", 1): v.replace("st8", "gt8").replace("sb8", "gb8").replace("sev", "gev").replace("skept", "gkept") for k, v in STRUCTURE.items() if k in ("sev", "skept", "structure")
}
FLOW_STRUCTURE["flow_structure"] = FLOW_STRUCTURE.pop("gtructure")


def sunday(c: str) -> str:
    return f"strftime(date_trunc('week', strptime({c}, '%Y%m%d')) + INTERVAL 6 DAY, '%Y%m%d')"


_SHORT = " ".join(f"WHEN {RN} = {n} THEN round({slope('b_bar', n, 0.15)}, 10)" for n in (2, 3, 4))
WEEK_MACD = MACD | {
    "wk0": f"SELECT *, row_number() OVER (PARTITION BY ts_code ORDER BY week) AS rn, count(*) OVER (PARTITION BY ts_code) AS n FROM (SELECT ts_code, {sunday('trade_date')} AS week, arg_max(close_qfq, trade_date) AS c FROM dwd_daily_quote WHERE is_suspended = 0 GROUP BY ALL)",
    "wrec": """SELECT ts_code, rn, c AS f1, c AS f2, 0.0::DOUBLE AS bd, 0.0::DOUBLE AS bdea FROM wk0 WHERE rn = 1
        UNION ALL
        SELECT ts_code, rn, f1, f2, f1 - f2, 0.2::DOUBLE * (f1 - f2) + 0.8::DOUBLE * bdea
        FROM (SELECT wk0.ts_code, wk0.rn, 2.0::DOUBLE / 13 * c + 11.0::DOUBLE / 13 * f1 AS f1, 2.0::DOUBLE / 27 * c + 25.0::DOUBLE / 27 * f2 AS f2, bdea FROM wrec JOIN wk0 ON wk0.ts_code = wrec.ts_code AND wk0.rn = wrec.rn + 1)""",
    "wx0": "SELECT ts_code, week AS trade_date, n, round(bd, 10) AS b_dif, round(bdea, 10) AS b_dea, round(2 * (bd - bdea), 10) AS b_bar FROM wrec JOIN wk0 USING (ts_code, rn) WHERE n >= 2",
    "wx1": f"""SELECT *, {RN} AS rn, {lag('b_dif')} AS d1, {lag('b_dea')} AS a1, CASE {_SHORT} ELSE round({slope('b_bar', 5, 0.15)}, 10) END AS s5,
        CASE WHEN {RN} >= 10 THEN greatest({over('stddev_pop(b_dif)', 10)}, {over('stddev_pop(b_dea)', 10)}) ELSE greatest(abs(b_dif), abs(b_dea)) END * 0.15::DOUBLE AS lim FROM wx0""",
    "wt": """SELECT ts_code, trade_date AS week, CASE WHEN abs(s5) < 0.001 THEN 'flat' WHEN s5 > 0 THEN 'up' WHEN s5 < 0 THEN 'down' END AS trend,
        CASE WHEN d1 <= a1 AND b_dif > b_dea THEN 'golden_cross' WHEN d1 >= a1 AND b_dif < b_dea THEN 'dead_cross'
             WHEN rn >= 3 AND round(abs(b_dif - b_dea), 10) < round(abs(d1 - a1), 10) AND round(abs(b_dif - b_dea), 10) < round(lim, 10) AND b_dif < b_dea AND d1 < a1 THEN 'near_golden'
             WHEN rn >= 3 AND round(abs(b_dif - b_dea), 10) < round(abs(d1 - a1), 10) AND round(abs(b_dif - b_dea), 10) < round(lim, 10) AND b_dif > b_dea AND d1 > a1 THEN 'near_dead' END AS turning_point FROM wx1""",
    "macdw": f"SELECT m.* EXCLUDE (trend, turning_point), wt.trend, wt.turning_point FROM macd m LEFT JOIN wt ON wt.ts_code = m.ts_code AND wt.week = {sunday('m.trade_date')}",
}
WEEK_VOLUME = VOLUME | {
    "v0": VOLUME["v0"].replace("vol AS v,", "vol AS v, vol * active_days / 5 AS tv,"),
    "v2": VOLUME["v2"].replace(slope("v", 5), slope("tv", 5)).replace("avg(abs(v))", "avg(abs(tv))"),
    "volume": VOLUME["volume"].replace("rn >= 64", "rn >= 34"),
}
_BIG = "sum(coalesce(buy_lg_vol, 0)) + sum(coalesce(buy_elg_vol, 0)) - sum(coalesce(sell_lg_vol, 0)) - sum(coalesce(sell_elg_vol, 0))"
WEEK_DDE = {
    "ends": "SELECT ts_code, trade_date, coalesce(lag(trade_date) OVER (PARTITION BY ts_code ORDER BY trade_date), strftime(strptime(trade_date, '%Y%m%d') - INTERVAL 7 DAY, '%Y%m%d')) AS prev FROM dwd_weekly_quote JOIN dim_date USING (trade_date) WHERE is_week_end = 1",
    "wf0": f"""SELECT e.ts_code, e.trade_date, CASE WHEN count(DISTINCT f.trade_date) >= 0.6 * (SELECT count(*) FROM dim_date d WHERE d.trade_date > e.prev AND d.trade_date <= e.trade_date) THEN ({_BIG}) / nullif(sum(f.total_vol), 0) END AS ddx
        FROM ends e JOIN dwd_daily_moneyflow f ON f.ts_code = e.ts_code AND f.trade_date > e.prev AND f.trade_date <= e.trade_date GROUP BY e.ts_code, e.trade_date, e.prev""",
    "wf1": f"SELECT * FROM (SELECT *, {RN} AS rn, {ALL_N} AS n, count(ddx) OVER (PARTITION BY ts_code) AS nx FROM wf0) WHERE n >= 2",
    "wfr": """SELECT ts_code, rn, ddx AS s, CASE WHEN ddx IS NULL THEN 0 ELSE 1 END AS k, ddx AS e FROM wf1 WHERE rn = 1
        UNION ALL
        SELECT wf1.ts_code, wf1.rn, CASE WHEN ddx IS NULL THEN s ELSE coalesce(s, 0) + ddx END, k + CASE WHEN ddx IS NULL THEN 0 ELSE 1 END,
               CASE WHEN ddx IS NULL THEN e WHEN k + 1 <= 5 THEN (coalesce(s, 0) + ddx) / (k + 1) ELSE ddx / 3 + e * 2 / 3 END
        FROM wfr JOIN wf1 ON wf1.ts_code = wfr.ts_code AND wf1.rn = wfr.rn + 1""",
    "wf2": "SELECT ts_code, trade_date, round(ddx, 10) AS ddx, round(CASE WHEN nx >= 5 THEN e END, 10) AS ddx2 FROM wfr JOIN wf1 USING (ts_code, rn)",
    "wf3": f"SELECT *, round({slope('ddx2', 2)}, 10) AS turn, CASE WHEN {over('count(ddx2)', 5)} = 5 THEN {over('avg(abs(ddx2))', 5)} END AS sc, {slope('ddx2', 5, 0.2)} AS s2 FROM wf2",
    "wf4": f"SELECT *, {lag('turn')} AS was FROM wf3",
    "fd": "SELECT f.*, q.circ_mv, q.total_mv FROM dwd_daily_moneyflow f LEFT JOIN (SELECT ts_code, trade_date, circ_mv, total_mv FROM dwd_daily_quote WHERE is_suspended = 0) q USING (ts_code, trade_date)",
    "fw0": f"SELECT ts_code, {sunday('trade_date')} AS trade_date, sum(coalesce(net_amount_dc, 0)) AS net, arg_max(circ_mv, fd.trade_date) FILTER (circ_mv IS NOT NULL) AS mv FROM fd WHERE ts_code IN (SELECT ts_code FROM fd WHERE net_amount_dc IS NOT NULL) GROUP BY ts_code, {sunday('fd.trade_date')}".replace("strptime(trade_date", "strptime(fd.trade_date"),
    "fw1": f"SELECT ts_code, trade_date, net / mv * 100 AS ddx, {RN} AS rn FROM fw0 WHERE mv > 0",
    "fwr": "SELECT ts_code, rn, ddx AS w FROM fw1 WHERE rn = 1 UNION ALL SELECT fw1.ts_code, fw1.rn, 59.0::DOUBLE / 61 * w + 2.0::DOUBLE / 61 * ddx FROM fwr JOIN fw1 ON fw1.ts_code = fwr.ts_code AND fw1.rn = fwr.rn + 1",
    "fw2": f"SELECT *, CASE WHEN rn >= 10 THEN {over('avg(sm)', 10)} END AS a FROM (SELECT fw1.*, w * 60.1953::DOUBLE AS sm FROM fwr JOIN fw1 USING (ts_code, rn))",
    "fw3": "SELECT *, CASE WHEN count(a) OVER (PARTITION BY ts_code) > 0 THEN a ELSE ddx END AS sma FROM fw2",
    "fw4": f"SELECT ts_code, trade_date, rn, CASE WHEN rn < 4 THEN NULL WHEN sl > 0 THEN 'up' WHEN sl < 0 THEN 'down' ELSE 'flat' END AS trend FROM (SELECT *, round({slope('sma', 4)}, 10) AS sl FROM fw3)",
    "wtr": """SELECT a.ts_code, a.trade_date, CASE WHEN a.trade_date = max(a.trade_date) OVER (PARTITION BY a.ts_code) OR nx.trade_date IS NULL THEN l.trend ELSE nx.trend END AS trend
        FROM wf0 a ASOF LEFT JOIN fw4 nx ON a.ts_code = nx.ts_code AND a.trade_date <= nx.trade_date LEFT JOIN (SELECT ts_code, arg_max(struct_pack(t := trend), trade_date).t AS trend FROM fw4 GROUP BY ALL) l ON l.ts_code = a.ts_code""",
    "ddew": """SELECT wf4.ts_code, wf4.trade_date, ddx, ddx2, CASE WHEN sc > 0 THEN s2 / sc END AS trend_strength,
        CASE WHEN was < 0 AND turn > 0 THEN 'upturn_reverse' WHEN was > 0 AND turn < 0 THEN 'downturn_reverse' END AS alert, wtr.trend FROM wf4 LEFT JOIN wtr USING (ts_code, trade_date)""",
}
