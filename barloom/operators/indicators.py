"""The six indicators, for daily or weekly bars: one select chain each over a shared window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import kernels as K
from barloom.functions import recursion as R
from barloom.functions.kernels import back, by_date, crossed_down, crossed_up, r10, rn, sma, weighted_slope
from barloom.operators.incremental import after, append, newest
from barloom.sources.store import dealt

# Rows an instrument needs, flat zone of a slope, gap of a tangle.
LEAST_ROWS = {"macd": 27, "ma": 11, "kpattern": 30, "dde": 10, "volume": 5, "position": 2}


def daily_panel(bars: DataFrame) -> DataFrame:
    return bars.where("is_suspended = 0")


def weekly_panel(weekly: DataFrame, dim: DataFrame) -> DataFrame:
    """Week-to-date bars at calendar week-ends."""
    return weekly.join(F.broadcast(dim.where("is_week_end = 1").select("trade_date")), "trade_date")


def enough_rows(panel: DataFrame, least: int) -> DataFrame:
    n = F.count("*").over(Window.partitionBy("ts_code"))
    return panel.withColumn("_n", n).where(F.col("_n") >= least).drop("_n")


def moving_averages(panel: DataFrame) -> DataFrame:
    """MA5, MA10, bias, slopes, alignment and turning point."""
    d = enough_rows(panel, LEAST_ROWS["ma"]).select("ts_code", "trade_date", "close_qfq")
    d = d.select("*", r10(sma("close_qfq", 5)).alias("ma_5"), r10(sma("close_qfq", 10)).alias("ma_10"), rn().alias("rn"))
    d = d.select(
        "*",
        ((F.col("close_qfq") - F.col("ma_5")) / F.col("ma_5") * 100).alias("bias_ma5"),
        ((F.col("close_qfq") - F.col("ma_10")) / F.col("ma_10") * 100).alias("bias_ma10"),
        r10(weighted_slope("ma_5", 5) / F.nullif("ma_5", F.lit(0.0)) * 100).alias("ma5_slope"),
        r10(weighted_slope("ma_10", 5) / F.nullif("ma_10", F.lit(0.0)) * 100).alias("ma10_slope"),
        F.coalesce(crossed_up("ma_5", "ma_10"), F.lit(False)).alias("up"),
        F.coalesce(crossed_down("ma_5", "ma_10"), F.lit(False)).alias("down"),
        F.abs(F.col("ma_5") - F.col("ma_10")).alias("gap"),
    )
    crosses = F.sum((F.col("up") | F.col("down")).cast("int")).over(back(10))
    g0, g1, g2 = F.lag("gap", 2).over(by_date()), F.lag("gap").over(by_date()), F.col("gap")
    slope = F.when(F.col("rn") >= 3, F.when(g0.isNull(), g2 - g1).otherwise((g2 - g0) / 2))
    d = d.select("*", crosses.alias("crosses"), r10(slope).alias("gap_slope"), F.lag("ma_10").over(by_date()).isNotNull().alias("ready"))
    return d.select("ts_code", "trade_date", "ma_5", "ma_10", "bias_ma5", "bias_ma10", "ma5_slope", "ma10_slope", _alignment().alias("alignment"), _ma_turn().alias("turning_point"))


def _alignment() -> Column:
    a, s5, s10 = F.col("ma_5") > F.col("ma_10"), F.col("ma5_slope"), F.col("ma10_slope")
    flat5, flat10 = F.abs(s5) < 0.08, F.abs(s10) < 0.08
    up5, dn5, up10, dn10 = s5 > 0.08, s5 < -0.08, s10 > 0.08, s10 < -0.08
    known = F.col("ma_5").isNotNull() & F.col("ma_10").isNotNull() & s5.isNotNull() & s10.isNotNull()
    label = F.when(~known, F.lit(None)).when((r10(F.col("gap") / F.col("ma_10")) < 0.0299) & (F.col("crosses") >= 2), "tangle").when(flat5 & flat10, "sideways")
    table = [  # (above, condition, label): both slopes first, then one of them flat
        (True, up5 & up10, "bull_strong"), (True, up5 & dn10, "bull_building"), (True, dn5 & up10, "bull_weakening"), (True, dn5 & dn10, "bull_rolling"),
        (False, dn5 & dn10, "bear_strong"), (False, dn5 & up10, "bear_building"), (False, up5 & dn10, "bear_weakening"), (False, up5 & up10, "bear_rolling"),
        (True, (up5 & flat10) | (flat5 & up10), "bull_building"), (True, (dn5 & flat10) | (flat5 & dn10), "bull_weakening"),
        (False, (dn5 & flat10) | (flat5 & up10), "bear_building"), (False, up5 & flat10, "bear_weakening"), (False, flat5 & dn10, "bear_strong"),
    ]
    for above, cond, name in table:
        label = label.when((a if above else ~a) & cond, name)
    return label


def _ma_turn() -> Column:
    near = F.when(F.col("ma_5") < F.col("ma_10"), "near_golden").otherwise("near_dead")
    speed = -F.col("gap_slope")
    return (
        F.when(~F.col("ready") | F.col("ma_10").isNull(), F.lit(None))
        .when(F.col("up"), "golden_cross")
        .when(F.col("down"), "dead_cross")
        .when(r10(F.col("gap") / F.col("ma_10")) < 0.005, near)
        .when((speed > 1e-9) & (r10(F.col("gap") / speed) < 3), near)
    )


_MACD = ", ".join(f"{c} double" for c in ("ema_12", "ema_26", "dif", "dea", "macd_bar", "b_dif", "b_dea", "b_bar"))
_ROUNDED = ("dif", "dea", "macd_bar", "b_dif", "b_dea", "b_bar")
#: Bars before a new one that the labels of MACD and of the flow look at.
MACD_BACK, FLOW_BACK = 19, 13


def macd(panel: DataFrame, n_std: int = 20, frac: float = 0.1) -> DataFrame:
    """EMA lines, zone, strength, alert on the histogram's turn, trend and turning point of the (10, 20, 7) lines."""
    d = R.over_series(enough_rows(panel, LEAST_ROWS["macd"]), ["close_qfq"], _MACD, R.macd_lines)
    return _macd_labels(dealt(d.withColumns({c: r10(F.col(c)) for c in _ROUNDED})), n_std, frac)


def _macd_labels(d: DataFrame, n_std: int, frac: float, *more: str) -> DataFrame:
    h0, h1, h2 = F.lag("macd_bar", 2).over(by_date()), F.lag("macd_bar").over(by_date()), F.col("macd_bar")
    scale = K.mean_abs("macd_bar", 5)
    trend, turn = _turns(n_std, frac)
    return d.select(
        "ts_code", "trade_date", "ema_12", "ema_26", "dif", "dea", "macd_bar",
        F.when(F.col("macd_bar") > 0, "bull").when(F.col("macd_bar") < 0, "bear").alias("zone"),
        F.when(scale < 1e-6, 0.0).otherwise(weighted_slope("macd_bar", 5, 0.15) / scale).alias("trend_strength"),
        F.when((h2 > h1) & (h1 < h0), "downturn_reverse").when((h2 < h1) & (h1 > h0), "upturn_reverse").alias("alert"),
        trend.alias("trend"), turn.alias("turning_point"), *more,
    )


def macd_state(panel: DataFrame) -> DataFrame:
    """What continues the MACD of every instrument that has one: the recursions' values at its last bar, and the lines of the last ones."""
    return _state(dealt(_macd_from(enough_rows(panel, LEAST_ROWS["macd"]), last=MACD_BACK)), R.MACD_STATE, ("dif", "dea", "macd_bar", "b_dif", "b_dea", "b_bar"), MACD_BACK, {"dea": "raw_dea", "b_dea": "raw_b_dea"})


def _macd_from(rows: DataFrame, seeds: tuple[str, ...] = (), last: int | None = None) -> DataFrame:
    more = [c for c in R.MACD_STATE if c not in ("ema_12", "ema_26", "dea", "b_dea")] + ["raw_dea", "raw_b_dea"]
    d = R.over_series(rows, ["close_qfq"], f"{_MACD}, {', '.join(f'{c} double' for c in more)}", R.macd_lines, seeds, last=last)
    return d.withColumns({c: r10(F.col(c)) for c in _ROUNDED})


def _state(lines: DataFrame, carried: tuple[str, ...], shown: tuple[str, ...], back: int, named: dict[str, str] = {}) -> DataFrame:
    """``(ts_code, last_trade_date, seed_..., recent)``: what recursions carry at the last bar, and the last bars' lines, ``back`` of them."""
    last = Window.partitionBy("ts_code").orderBy(F.desc("trade_date"))
    rows = lines.withColumn("_r", F.row_number().over(last)).where(F.col("_r") <= back)
    here = lambda c: F.max(F.when(F.col("_r") == 1, F.col(named.get(c, c))))
    recent = F.array_sort(F.collect_list(F.struct("trade_date", *shown)))
    moved = [F.max("fresh").alias("moved")] if "fresh" in lines.columns else []
    return rows.groupBy("ts_code").agg(F.max("trade_date").alias("last_trade_date"), *[here(c).alias(f"seed_{c}") for c in carried], recent.alias("recent"), *moved)


def _since(rows: DataFrame, state: DataFrame, carried: tuple[str, ...]) -> DataFrame:
    """The rows after each instrument's state, with what continues it; rows of instruments without one are left to a full run."""
    return after(rows, state, *[f"seed_{c}" for c in carried])


def _after_recent(new: DataFrame, state: DataFrame) -> DataFrame:
    """New lines behind the last stored ones of their instruments, ``fresh`` telling them apart."""
    fields = [f.name for f in state.schema["recent"].dataType.elementType]
    old = state.select("ts_code", F.explode("recent").alias("x"))
    return old.select("ts_code", *[f"x.{c}" for c in fields], F.lit(False).alias("fresh")).unionByName(new.withColumn("fresh", F.lit(True)), allowMissingColumns=True).transform(dealt)


def continue_macd(panel: DataFrame, state: DataFrame, n_std: int = 20, frac: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """MACD with all its labels for the bars after a state (:func:`macd_state`), and the state after them.

    Equal to a full run's rows of those bars. No bar up to the state's date is read: recursions go on from its values,
    windows look at the lines that it keeps. Dates at or before the state's, repeated or lost ones are for
    :func:`barloom.operators.incremental.guarded` to tell.
    """
    new = _macd_from(_since(panel.select("ts_code", "trade_date", "close_qfq"), state, R.MACD_STATE), tuple(f"seed_{c}" for c in R.MACD_STATE))
    both = _after_recent(new, state)
    found = _macd_labels(both, n_std, frac, "fresh").where("fresh").drop("fresh")
    return found, _next_state(both, state, R.MACD_STATE, _ROUNDED, MACD_BACK, {"dea": "raw_dea", "b_dea": "raw_b_dea"})


def _next_state(both: DataFrame, state: DataFrame, carried: tuple[str, ...], shown: tuple[str, ...], back: int, named: dict[str, str] = {}) -> DataFrame:
    """The states after an append; instruments without new bars keep theirs."""
    return newest(state, _state(both, carried, shown, back, named).where("moved").drop("moved"), "ts_code")


def _turns(n_std: int, frac: float, short: bool = False) -> tuple[Column, Column]:
    """Trend and turning point of the lines ``b_dif``, ``b_dea``, ``b_bar``; with ``short`` a trend from two bars on."""
    slope = r10(weighted_slope("b_bar", 5, 0.15))
    if short:
        for n in (4, 3, 2):
            slope = F.when(rn() == n, r10(weighted_slope("b_bar", n, 0.15))).otherwise(slope)
    trend = F.when(F.abs(slope) < 0.001, "flat").when(slope > 0, "up").when(slope < 0, "down")
    gap, gap1 = F.abs(F.col("b_dif") - F.col("b_dea")), F.abs(F.lag("b_dif").over(by_date()) - F.lag("b_dea").over(by_date()))
    std = F.greatest(F.stddev_pop("b_dif").over(back(n_std)), F.stddev_pop("b_dea").over(back(n_std)))
    limit = F.when(rn() >= n_std, std).otherwise(F.greatest(F.abs("b_dif"), F.abs("b_dea"))) * frac
    below, was_below = F.col("b_dif") < F.col("b_dea"), F.lag("b_dif").over(by_date()) < F.lag("b_dea").over(by_date())
    above, was_above = F.col("b_dif") > F.col("b_dea"), F.lag("b_dif").over(by_date()) > F.lag("b_dea").over(by_date())
    close_in = (rn() >= 3) & (r10(gap) < r10(gap1)) & (r10(gap) < r10(limit))
    turn = (
        F.when(crossed_up("b_dif", "b_dea"), "golden_cross").when(crossed_down("b_dif", "b_dea"), "dead_cross")
        .when(below & was_below & close_in, "near_golden").when(above & was_above & close_in, "near_dead")
    )
    return trend, turn


def sunday(date: str) -> Column:
    """The Sunday that ends a date's calendar week."""
    return F.date_format(F.date_add(F.date_trunc("week", F.to_date(date, "yyyyMMdd")).cast("date"), 6), "yyyyMMdd")


def weekly_macd(panel: DataFrame, weeks: DataFrame) -> DataFrame:
    """MACD of week-end bars with the trend and turning point of the calendar weeks' (12, 26, 9) lines.

    ``weeks`` are the resampled closes ``(ts_code, week, close, last_date)`` of all daily bars.
    """
    d = weeks.select("ts_code", F.col("week").alias("trade_date"), "close")
    d = dealt(R.over_series(d, ["close"], "b_dif double, b_dea double, b_bar double", R.trend_lines(12, 26, 9)))
    d = d.select("ts_code", "trade_date", *[r10(F.col(c)).alias(c) for c in ("b_dif", "b_dea", "b_bar")], F.count("*").over(Window.partitionBy("ts_code")).alias("n"))
    trend, turn = _turns(10, 0.15, short=True)
    d = d.select("ts_code", F.col("trade_date").alias("week"), "n", trend.alias("trend"), turn.alias("turning_point")).where("n >= 2").drop("n")
    own = macd(panel).drop("trend", "turning_point").withColumn("week", sunday("trade_date"))
    return own.join(d, ["ts_code", "week"], "left").drop("week")


def append_macd(panel: DataFrame, stored: DataFrame) -> DataFrame:
    """MACD lines of the bars after each instrument's last stored result, continued from it; equal to a full run."""
    last = stored.groupBy("ts_code").agg(F.max_by(F.struct("trade_date", "ema_12", "ema_26", "dea"), "trade_date").alias("s"))
    last = last.select("ts_code", F.col("s.trade_date").alias("_last"), F.col("s.ema_12").alias("seed_ema_12"), F.col("s.ema_26").alias("seed_ema_26"), F.col("s.dea").alias("seed_dea"))
    new = panel.select("ts_code", "trade_date", "close_qfq").join(last, "ts_code").where("trade_date > _last").drop("_last")
    new = new.withColumn("seed_n", F.lit(26.0))  # a stored result is past the means' first bars
    d = R.over_series(new, ["close_qfq"], "ema_12 double, ema_26 double, dif double, dea double, macd_bar double", R.macd_lines, ["seed_n", "seed_ema_12", "seed_ema_26", "seed_dea"])
    return d.withColumns({c: r10(F.col(c)) for c in ("dif", "dea", "macd_bar")})


def price_position(panel: DataFrame) -> DataFrame:
    """Place of the close between the smallest and largest close of 60, 120 and 250 rows, in percent."""
    d = enough_rows(panel, LEAST_ROWS["position"])
    out = []
    for n in (60, 120, 250):
        lo, hi = F.min("close_qfq").over(back(n)), F.max("close_qfq").over(back(n))
        out.append(F.when((rn() >= 2) & (hi > lo), (F.col("close_qfq") - lo) / (hi - lo) * 100).alias(f"price_position_{n}d"))
    return d.select("ts_code", "trade_date", *out)


# The parameters of the candlestick patterns.
LIMIT, LIMIT_ST = 9.9, 4.9
HIGH_60, GAIN_20, GAIN_10 = 0.90, 0.15, 0.15
DOJI_PREV, DOJI_BODY, SMALL_BODY, LOWER = 0.005, 0.10, 0.20, 1.0 / 3.0
SHADOW_BODY, SHADOW_RANGE, VOL_OVER, VOL_GAP, BEAR_BODY = 3.0, 0.60, 1.2, 1.5, 0.05
PATTERNS = ("yang_bao_yin", "yang_ke_yin", "mu_bei_xian", "bi_lei_zhen", "gao_kai_chang_yin", "yin_bao_yang", "yin_ke_yang")


def candlesticks(panel: DataFrame, stocks: DataFrame) -> DataFrame:
    """Seven candlestick flags from two bars with volume and trend context, and the strength of the first that fires."""
    o, h, l, c, v = (F.col(x) for x in ("open_qfq", "high_qfq", "low_qfq", "close_qfq", "vol"))
    lag = lambda x, n=1: F.lag(x, n).over(by_date())
    d = enough_rows(panel, LEAST_ROWS["kpattern"]).join(stocks.select("ts_code", "is_st"), "ts_code", "left")
    d = d.select("ts_code", "trade_date", *[r10(F.col(x)).alias(x) for x in ("open_qfq", "high_qfq", "low_qfq", "close_qfq")], "vol", "pct_chg", F.coalesce("is_st", F.lit(0)).alias("is_st"))
    d = d.select(
        "*", rn().alias("rn"), lag(o).alias("o1"), lag(c).alias("c1"), lag(v).alias("v1"), lag(c, 10).alias("c10"), lag(c, 20).alias("c20"),
        sma("vol", 5).alias("mv"), r10(sma("close_qfq", 10)).alias("ma10"), F.max(h).over(back(60)).alias("h60"), F.abs(c - o).alias("body"), (h - l).alias("range"),
    )
    top, low = F.greatest(o, c), F.least(o, c)
    col = F.col
    d = d.select("*", (h - top).alias("upper"), ((col("rn") >= 60) & (c >= r10(col("h60") * HIGH_60))).alias("high60"), F.coalesce(r10((c - col("c20")) / col("c20")) > GAIN_20, F.lit(False)).alias("gain20"))
    bull, bear, bull1, bear1 = c >= o, c < o, col("c1") >= col("o1"), col("c1") < col("o1")
    open_ = (col("rn") >= 2) & (F.abs("pct_chg") < F.when(col("is_st") == 1, LIMIT_ST).otherwise(LIMIT))
    rising = col("high60") | col("gain20")
    share = F.when(col("range") > 0, r10(col("body") / col("range")))
    long_upper = F.when(col("body") > 0, r10(col("upper")) >= r10(SHADOW_BODY * col("body"))).otherwise((col("range") > 0) & (r10(col("upper") / F.nullif("range", F.lit(0.0))) > SHADOW_RANGE))
    doji = (r10(col("body") / col("c1")) < DOJI_PREV) | F.coalesce(share < DOJI_BODY, F.lit(False))
    center = r10((low + col("body") / 2 - l) / F.nullif("range", F.lit(0.0))) < LOWER
    flags = {
        "yang_bao_yin": bear1 & bull & (o <= col("c1")) & (c >= col("o1")) & (col("body") > 0),
        "yang_ke_yin": bear1 & (v > r10(col("mv") * VOL_OVER)) & (top > F.greatest("o1", "c1")) & (c > col("ma10")),
        "mu_bei_xian": rising & doji & long_upper,
        "bi_lei_zhen": rising & (share < SMALL_BODY) & center & long_upper,
        "gao_kai_chang_yin": (r10((c - col("c10")) / col("c10")) > GAIN_10) & (o > col("c1")) & bear & (r10(col("body") / o) >= BEAR_BODY) & (v > r10(col("mv") * VOL_GAP)),
        "yin_bao_yang": bull1 & bear & (o >= col("c1")) & (c <= col("o1")) & (col("body") > 0),
        "yin_ke_yang": bull1 & (v > r10(col("mv") * VOL_OVER)) & (low < F.least("o1", "c1")) & (c < col("ma10")),
    }
    d = d.select("*", *[F.coalesce((open_ & x), F.lit(False)).cast("int").alias(k) for k, x in flags.items()])
    cap = lambda x: F.least(x, F.lit(1.0))
    body1 = F.abs(col("c1") - col("o1"))
    engulf = F.when(body1 > 0, cap(col("body") / F.nullif(body1, F.lit(0.0)) / 2.0)).otherwise(0.0)
    vol = lambda by: F.when(col("mv") > 0, cap(v / F.nullif("mv", F.lit(0.0)) / by)).otherwise(cap(v / F.when(col("v1") > 0, col("v1")).otherwise(1.0) / by))
    pos = F.when(col("range") > 0, (c - l) / F.nullif("range", F.lit(0.0)))
    up_pos, dn_pos = F.coalesce(pos, F.lit(0.5)), F.coalesce(1 - pos, F.lit(0.5))
    shadow = F.when(col("body") > 0, cap(col("upper") / F.nullif("body", F.lit(0.0)) / 4.0)).when(col("range") > 0, cap(col("upper") / F.nullif("range", F.lit(0.0)) / 0.8)).otherwise(1.0)
    confirm = F.when(col("gain20"), 1.0).when(col("high60"), 0.6).otherwise(0.0)
    t1, b1 = F.greatest("o1", "c1"), F.least("o1", "c1")
    scores = {
        "yang_bao_yin": 0.5 * engulf + 0.3 * vol(1.5) + 0.2 * up_pos,
        "yang_ke_yin": 0.4 * cap((top - t1) / t1 / 0.02) + 0.4 * vol(1.5) + 0.2 * up_pos,
        "mu_bei_xian": 0.4 * shadow + 0.3 * (1 - cap(col("body") / col("c1") / 0.005)) + 0.3 * confirm,
        "bi_lei_zhen": 0.4 * shadow + 0.3 * F.coalesce(1 - pos, F.lit(0.0)) + 0.3 * confirm,
        "gao_kai_chang_yin": 0.3 * cap(col("body") / o / 0.08) + 0.3 * vol(2.5) + 0.2 * cap((o - col("c1")) / col("c1") / 0.03) + 0.2 * F.coalesce(cap((c - col("c10")) / col("c10") / 0.25), F.lit(0.0)),
        "yin_bao_yang": 0.5 * engulf + 0.3 * vol(1.5) + 0.2 * dn_pos,
        "yin_ke_yang": 0.4 * cap((b1 - low) / b1 / 0.02) + 0.4 * vol(1.5) + 0.2 * dn_pos,
    }
    strength = None
    for k in PATTERNS:
        strength = (strength if strength is not None else F).when(col(k) == 1, F.least(F.greatest(scores[k], F.lit(0.0)), F.lit(1.0)))
    return d.select("ts_code", "trade_date", *PATTERNS, strength.alias("strength"))


def volume(panel: DataFrame, anchor: int = 60, traded: str = "vol") -> DataFrame:
    """MA5 volume, ratio, percentile rank, zone, trend, strength and divergence from price.

    The trend is that of ``traded``: for weekly bars, whose volume is scaled to five
    days, ``vol * active_days / 5``.
    """
    d = _volume_rows(panel, anchor, traded)
    return _zoned(d, ["pct_vol_rank", "top", "bottom"])


def append_volume(panel: DataFrame, stored: DataFrame, anchor: int = 60, traded: str = "vol") -> DataFrame:
    """:func:`volume` of the bars after each instrument's last stored result; equal to a full run.

    The windows reach over 130 bars before the new ones; the zone and the spacing of
    divergences go on from the stored ones. Instruments without a stored result have no rows.
    """
    code = lambda c, names: F.array_position(F.array(*map(F.lit, names)), F.col(c)) - 1
    label = F.when(F.col("divergence") == "bottom_divergence", 2).when(F.col("divergence") == "top_divergence", 1).otherwise(0)
    was = stored.select("ts_code", "trade_date", F.lit(1).alias("old"), code("zone", R.ZONES).alias("old_zone"), label.alias("old_label"))

    def on_tail(rows: DataFrame) -> DataFrame:
        d = _volume_rows(rows, anchor, traded)
        return _zoned(d.join(was, ["ts_code", "trade_date"], "left"), ["pct_vol_rank", "top", "bottom", "old", "old_zone", "old_label"])

    return append(on_tail, panel, stored.groupBy("ts_code").agg(F.max("trade_date").alias("last_trade_date")), 130)


def _zoned(d: DataFrame, values: list[str]) -> DataFrame:
    """Volume rows with the names of their zone and of the divergence that counts."""
    kept = ["ma_vol_5", "volume_ratio", "pct_vol_rank", "trend", "trend_strength"]
    d = R.over_series(d, values, "zone long, top boolean, bottom boolean", R.volume_zone(), keep=kept)
    zone = F.when(F.col("zone") >= 0, F.element_at(F.array(*map(F.lit, R.ZONES)), (F.col("zone") + 1).cast("int")))
    label = F.when(F.col("bottom"), "bottom_divergence").when(F.col("top"), "top_divergence")
    return d.select("ts_code", "trade_date", *kept, zone.alias("zone"), label.alias("divergence"))


def _volume_rows(panel: DataFrame, anchor: int, traded: str) -> DataFrame:
    """The part of the volume measures that windows give, and where price and volume part."""
    d = enough_rows(panel, LEAST_ROWS["volume"]).select("ts_code", "trade_date", "close_qfq", "vol", F.expr(traded).alias("traded"), rn().alias("rn"))
    d = d.withColumn("ma_vol_5", r10(sma("vol", 5)))
    d = d.select("*", r10(K.pct_rank("ma_vol_5", 120)).alias("pct_vol_rank"))
    direction = r10(weighted_slope("traded", 5) / (F.avg(F.abs("traded")).over(back(5)) + 1e-9))
    trend = F.when(F.col("rn") >= anchor + 4, F.when(direction > 0.001, "expanding").when(direction < -0.001, "shrinking").otherwise("flat"))
    d = parted(d, "vol").withColumn("lv", F.when(F.col("vol") > 0, F.ln("vol")))
    scale = K.mean_abs("lv", 10)
    whole = F.when(scale < 1e-6, 0.0).otherwise(weighted_slope("lv", 10, 0.20) / scale)
    return d.select(
        "ts_code", "trade_date", "ma_vol_5", F.when(F.col("ma_vol_5") > 0, F.col("vol") / F.col("ma_vol_5")).alias("volume_ratio"), "pct_vol_rank",
        trend.alias("trend"), F.coalesce(whole, K.compacted_strength("vol", 10, 0.20)).alias("trend_strength"), "top", "bottom",
    )


def volume_regime(panel: DataFrame, anchor: int = 60, recent: int = 10) -> DataFrame:
    """Regime of the five-row volume mean within the 20th to 80th percentile of ``anchor`` values, and a score from -1 to 1."""
    d = enough_rows(panel, LEAST_ROWS["volume"]).select("ts_code", "trade_date", "vol", rn().alias("rn")).withColumn("m", r10(sma("vol", 5)))
    d = d.select(
        "*", r10(F.percentile("m", F.lit(0.8)).over(back(anchor))).alias("p80"), r10(F.percentile("m", F.lit(0.2)).over(back(anchor))).alias("p20"),
        F.collect_list("m").over(back(recent)).alias("last"), F.collect_list("m").over(back(anchor)).alias("all"),
        r10(weighted_slope("vol", 5) / (F.avg(F.abs("vol")).over(back(5)) + 1e-9)).alias("dir"),
    ).where(F.col("rn") >= anchor + 4)
    high = lambda n: F.size(F.filter(F.slice("last", -n, n), lambda x: x >= F.col("p80")))
    low = lambda n: F.size(F.filter(F.slice("last", -n, n), lambda x: x <= F.col("p20")))
    regime = (
        F.when(r10(F.col("p80") / F.greatest(F.col("p20"), F.lit(1e-9))) < 1.4, "insufficient").when(high(3) == 3, "boom").when(low(3) == 3, "dry")
        .when((high(recent) >= 3) & (high(5) >= 2), "boom").when((low(recent) >= 3) & (low(5) >= 2), "dry").otherwise("normal")
    )
    clip = lambda x: F.greatest(F.least(x, F.lit(1.0)), F.lit(-1.0))
    below = F.size(F.filter("all", lambda x: x < F.col("m"))) / F.size("all") * 100
    score = clip(clip((below - 50) / 40) * 0.4 + clip(F.col("dir") * 100) * 0.6)
    return d.select("ts_code", "trade_date", regime.alias("regime"), score.alias("score"))


def parted(d: DataFrame, signal: str, window: int = 60) -> DataFrame:
    """``d`` (with ``rn``) and whether price and signal part within a window at a row: ``top``, ``bottom``."""
    over = back(window)
    d = d.withColumns({"_c": r10(F.col("close_qfq")), "_s": F.col(signal)})
    low = F.min(F.struct("_c", "rn")).over(over)  # the first of the lowest closes
    d = d.select("*", F.max("_c").over(over).alias("_chi"), low["_c"].alias("_clo"), low["rn"].alias("_at"), F.max("_s").over(over).alias("_shi"), F.min("_s").over(over).alias("_slo"))
    col, whole = F.col, F.col("rn") >= window
    top = (col("_shi") != 0) & (col("_s") < col("_shi")) & (col("_c") >= r10(col("_chi") * 0.98))
    back_up = r10((col("_s") - col("_slo")) / F.abs(F.nullif("_slo", F.lit(0.0)))) > 0.1
    bottom = (col("_slo") != 0) & (col("_s") > col("_slo")) & back_up & (col("rn") - col("_at") >= 3) & (col("_c") <= r10(col("_clo") * 1.02))
    no = F.lit(False)
    return d.withColumns({"top": F.coalesce(whole & top, no), "bottom": F.coalesce(whole & bottom, no)}).drop("_c", "_s", "_chi", "_clo", "_at", "_shi", "_slo")


_DDE = "ddx double, ddx2 double, smoothed double"


def dde(flow: DataFrame, quotes: DataFrame) -> DataFrame:
    """Large-order flow ``ddx`` and its mean, trend of the smoothed net inflow, strength and slope alert."""
    return _flow_labels(dealt(_flow_from(enough_rows(_flow_rows(flow, quotes), LEAST_ROWS["dde"]), _DDE)))


def _flow_rows(flow: DataFrame, quotes: DataFrame) -> DataFrame:
    rows = flow.join(quotes.select("ts_code", "trade_date", "circ_mv", "total_mv"), ["ts_code", "trade_date"])
    big = F.col("buy_lg_vol") + F.col("buy_elg_vol") - F.col("sell_lg_vol") - F.col("sell_elg_vol")
    mv = F.nullif(F.coalesce("circ_mv", "total_mv"), F.lit(0.0))
    return rows.select("ts_code", "trade_date", (big / F.nullif("total_vol", F.lit(0.0))).alias("ddx"), (F.coalesce("net_amount_dc", "net_mf_amount") / mv * 100).alias("flow"))


def _flow_from(rows: DataFrame, out: str, seeds: tuple[str, ...] = (), last: int | None = None) -> DataFrame:
    d = R.over_series(rows, ["ddx", "flow"], out, R.flow_lines, seeds, last=last)
    return d.withColumns({"ddx": r10(F.col("ddx")), "ddx2": r10(F.col("ddx2")), "smooth": r10(F.col("smoothed") * 60.1953)})


def _flow_labels(d: DataFrame, *more: str) -> DataFrame:
    d = d.withColumn("sma10", F.when(F.count("smooth").over(back(10)) == 10, F.avg("smooth").over(back(10))))
    slope = r10(weighted_slope("sma10", 5))
    scale = K.mean_abs("ddx2", 5)
    d = d.withColumn("turn", r10(weighted_slope("ddx2", 2)))
    was = F.lag("turn").over(by_date())
    return d.select(
        "ts_code", "trade_date", "ddx", "ddx2", F.when(slope > 0, "up").when(slope < 0, "down").when(slope == 0, "flat").alias("trend"),
        F.when(scale > 0, weighted_slope("ddx2", 5, 0.20) / F.nullif(scale, F.lit(0.0))).alias("trend_strength"),
        F.when((was < 0) & (F.col("turn") > 0), "upturn_reverse").when((was > 0) & (F.col("turn") < 0), "downturn_reverse").alias("alert"), *more,
    )


_FLOW_ALL = ", ".join(f"{c} double" for c in ("ddx", "ddx2", *R.FLOW_STATE))


def dde_state(flow: DataFrame, quotes: DataFrame) -> DataFrame:
    """What continues the flow indicator: the mean, the smoothed flow with its decayed weight, and the last bars' lines.

    An instrument with fewer than ten bars or five known flows has none: more bars would change its stored rows, so it is computed anew.
    """
    lines = dealt(_flow_from(enough_rows(_flow_rows(flow, quotes), LEAST_ROWS["dde"]), _FLOW_ALL, last=FLOW_BACK))
    return _state(lines, R.FLOW_STATE, ("ddx", "ddx2", "smooth"), FLOW_BACK).where("seed_k >= 5")


def continue_dde(flow: DataFrame, quotes: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The flow indicator of the bars after a state (:func:`dde_state`), equal to a full run's, and the state after them.

    Flow and quotes up to each state's date are dropped before they are joined.
    """
    new = _flow_from(_since(_flow_rows(after(flow, state), after(quotes, state)), state, R.FLOW_STATE), _FLOW_ALL, tuple(f"seed_{c}" for c in R.FLOW_STATE))
    both = _after_recent(new, state)
    return _flow_labels(both, "fresh").where("fresh").drop("fresh"), _next_state(both, state, R.FLOW_STATE, ("ddx", "ddx2", "smooth"), FLOW_BACK)


def flow_frame(flow: DataFrame, quotes: DataFrame) -> DataFrame:
    """Every day of money flow with the market value of its bar, null where there is none: the frame of flow trends."""
    return flow.join(quotes.where("is_suspended = 0").select("ts_code", "trade_date", "circ_mv", "total_mv"), ["ts_code", "trade_date"], "left")


def legacy_flow_trend(lines: DataFrame) -> DataFrame:
    """Trend of ``ddx2`` over eight bars, flat within 1e-4: the measure before the smoothed inflow."""
    slope = r10(weighted_slope("ddx2", 8, 0.20))
    return lines.select("ts_code", "trade_date", F.when(slope > 1e-4, "up").when(slope < -1e-4, "down").when(slope.isNotNull(), "flat").alias("trend"))


def weekly_flow_trend(frame: DataFrame, ends: DataFrame, n: int = 4) -> DataFrame:
    """Trend at the given week-ends of the weekly net inflow by market value, smoothed; from ``n`` weeks on.

    Calendar weeks sum the second source's net amount and take the last float market
    value; a week without one is none. A week-end takes the week it lies in or the next
    there is, the last one of an instrument the last week.
    """
    known = F.count("net_amount_dc").over(Window.partitionBy("ts_code")) > 0
    days = frame.withColumns({"week": sunday("trade_date"), "_known": known}).where("_known")
    weeks = days.groupBy("ts_code", "week").agg(F.sum(F.coalesce("net_amount_dc", F.lit(0.0))).alias("net"), F.max_by("circ_mv", F.when(F.col("circ_mv").isNotNull(), F.col("trade_date"))).alias("mv"))
    weeks = weeks.where("mv > 0").select("ts_code", F.col("week").alias("trade_date"), (F.col("net") / F.col("mv") * 100).alias("ddx"))
    d = dealt(R.over_series(weeks, ["ddx"], "smooth double", R.weekly_smooth, keep=["ddx"]))
    d = d.withColumn("sma", F.when(F.count("*").over(back(10)) == 10, F.avg(F.col("smooth") * 60.1953).over(back(10))))
    d = d.withColumn("sma", F.when(F.count("sma").over(Window.partitionBy("ts_code")) > 0, F.col("sma")).otherwise(F.col("ddx")))
    slope = r10(weighted_slope("sma", n))
    d = d.select("ts_code", "trade_date", F.struct(F.when(rn() >= n, F.when(slope > 0, "up").when(slope < 0, "down").otherwise("flat")).alias("trend")).alias("t"))
    both = d.unionByName(ends.select("ts_code", "trade_date", F.lit(1).alias("asked")), allowMissingColumns=True)
    order = Window.partitionBy("ts_code").orderBy(F.desc("trade_date"), F.asc("asked"))  # from the last week back
    last = F.max_by("t", F.when(F.col("t").isNotNull(), F.col("trade_date"))).over(Window.partitionBy("ts_code"))
    later = F.last("t", True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    final = F.col("trade_date") == F.max(F.when(F.col("asked") == 1, F.col("trade_date"))).over(Window.partitionBy("ts_code"))
    found = both.select("ts_code", "trade_date", "asked", F.when(final, last).otherwise(F.coalesce(later, last)).alias("t")).where("asked = 1")
    return found.select("ts_code", "trade_date", F.col("t.trend").alias("trend"))


def weekly_dde(weeks: DataFrame, trends: DataFrame) -> DataFrame:
    """Large-order flow of whole weeks: ``ddx`` is null in a week with too few days; trend as given."""
    d = weeks.withColumnRenamed("week_end", "trade_date")
    d = d.withColumn("_n", F.count("*").over(Window.partitionBy("ts_code"))).where("_n >= 2")
    big = F.col("buy_lg_vol") + F.col("buy_elg_vol") - F.col("sell_lg_vol") - F.col("sell_elg_vol")
    d = d.select("ts_code", "trade_date", F.when(F.col("is_skipped") == 0, big / F.nullif("total_vol", F.lit(0.0))).alias("ddx"), F.lit(None).cast("double").alias("flow"))
    d = dealt(R.over_series(d, ["ddx", "flow"], "ddx double, ddx2 double", R.flow_lines)).select("ts_code", "trade_date", r10(F.col("ddx")).alias("ddx"), r10(F.col("ddx2")).alias("ddx2"))
    scale, turn = K.mean_abs("ddx2", 5), r10(weighted_slope("ddx2", 2))
    d = d.withColumns({"turn": turn, "trend_strength": F.when(scale > 0, weighted_slope("ddx2", 5, 0.20) / F.nullif(scale, F.lit(0.0)))})
    was = F.lag("turn").over(by_date())
    alert = F.when((was < 0) & (F.col("turn") > 0), "upturn_reverse").when((was > 0) & (F.col("turn") < 0), "downturn_reverse")
    return d.withColumn("alert", alert).drop("turn").join(trends, ["ts_code", "trade_date"], "left")
