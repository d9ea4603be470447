"""Incremental recompute: signatures, routes, seeds, append equal to full, state and narrowing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# The twelve routes' versions, and the columns that each indicator reads.
VERSIONS = {"macd": "v3", "ma": "v2", "kpattern": "v1", "dde": "v3", "volume": "v2", "position": "v1"}
READS = {
    "macd": ("close",), "ma": ("close",), "kpattern": ("open", "high", "low", "close", "vol", "pct_chg"), "volume": ("close", "vol"), "position": ("close",),
    "dde": ("net_mf_amount", "net_amount_dc", "buy_lg_vol", "sell_lg_vol", "buy_elg_vol", "sell_elg_vol", "circ_mv", "total_mv"),
}


def routes(spark) -> DataFrame:
    rows = [(i, f, v) for i, v in VERSIONS.items() for f in ("daily", "weekly")]
    return spark.createDataFrame(rows, "indicator string, freq string, expected_version string")


def tail(panel: DataFrame, n: int) -> DataFrame:
    """The last ``n`` bars of every instrument."""
    w = Window.partitionBy("ts_code").orderBy(F.desc("trade_date"))
    return panel.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def signature(panel: DataFrame, column: str, n: int = 245, upto: str | None = None) -> DataFrame:
    """Per instrument a hash of its last values in order, rounded: equal history, equal signature."""
    rows = tail(panel.where(F.col("trade_date") <= upto) if upto else panel, n)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("trade_date", F.format_string("%.4f", F.col(column)).alias("v")))), lambda x: F.concat_ws(":", x["trade_date"], x["v"]))
    out = rows.groupBy("ts_code").agg(F.substring(F.sha2(F.array_join(texts, "|").cast("binary"), 256), 1, 16).alias("history_fp"), F.max("trade_date").alias("last_trade_date"))
    return out


def fingerprint(panel: DataFrame, column: str) -> DataFrame:
    """Per instrument a content fingerprint of least, largest, count and last date."""
    parts = [F.format_string("%.4f", F.min(column)), F.format_string("%.4f", F.max(column)), F.count(column).cast("string"), F.max("trade_date")]
    return panel.groupBy("ts_code").agg(F.sha2(F.concat_ws("|", *parts).cast("binary"), 256).alias("fp"))


def classify(panel: DataFrame, state: DataFrame, column: str, version: str) -> DataFrame:
    """Route per instrument: FULL without state, by version or changed history; SKIP without new bars; else APPEND."""
    s = state.withColumnsRenamed({"history_fp": "_fp", "last_trade_date": "_last", "spec_version": "_v"})
    upto = panel.join(s.select("ts_code", "_last"), "ts_code").where("trade_date <= _last").drop("_last")
    now = signature(upto, column).select("ts_code", "history_fp")
    bars = panel.join(s.select("ts_code", "_last"), "ts_code", "left").groupBy("ts_code").agg(F.count_if(F.expr("_last is null or trade_date > _last")).alias("new_bars"))
    out = bars.join(s, "ts_code", "left").join(now, "ts_code", "left")
    mode = (
        F.when(F.col("_fp").isNull(), "FULL").when(F.col("_v") != version, "FULL").when(~F.col("history_fp").eqNullSafe(F.col("_fp")), "FULL")
        .when(F.col("new_bars") == 0, "SKIP").otherwise("APPEND")
    )
    return out.select("ts_code", mode.alias("mode"), "new_bars")


def append(operator, panel: DataFrame, last: DataFrame, lookback: int) -> DataFrame:
    """An operator on new bars only: it runs on each instrument's tail with ``lookback`` bars before them."""
    rows = panel.join(last.select("ts_code", "last_trade_date"), "ts_code")
    new = F.sum(F.when(F.col("trade_date") > F.col("last_trade_date"), 1).otherwise(0)).over(Window.partitionBy("ts_code"))
    rn = F.row_number().over(Window.partitionBy("ts_code").orderBy(F.desc("trade_date")))
    cut = rows.withColumn("_new", new).withColumn("_rn", rn).where(F.col("_rn") <= F.col("_new") + lookback)
    out = operator(cut.drop("_new", "_rn", "last_trade_date"))
    return out.join(last.select("ts_code", "last_trade_date"), "ts_code").where("trade_date > last_trade_date").drop("last_trade_date")


def after(rows: DataFrame, state: DataFrame, *more: str) -> DataFrame:
    """The rows after each instrument's ``last_trade_date`` in a stored state, with ``more`` of its columns; none without a state.

    The earliest of these dates, read first, goes to the scan as a filter.
    """
    floor = state.agg(F.min("last_trade_date")).first()[0]
    since = state.select("ts_code", F.col("last_trade_date").alias("_last"), *more)
    return rows.where(F.col("trade_date") > F.lit(floor)).join(since, "ts_code").where("trade_date > _last").drop("_last")


def newest(state: DataFrame, moved: DataFrame, *keys: str) -> DataFrame:
    """The stored states with those that moved on in their place; what moved is computed once."""
    new = moved.select(*keys, F.struct(*[c for c in moved.columns if c not in keys]).alias("_new"))
    here = F.col("_new").isNotNull()
    return state.join(new, list(keys), "left").select(*[c if c in keys else F.when(here, F.col("_new")[c]).otherwise(F.col(c)).alias(c) for c in moved.columns])


def seeds(results: DataFrame, before: str, *columns: str) -> DataFrame:
    """The last stored values of every instrument before a date."""
    return results.where(F.col("trade_date") < before).groupBy("ts_code").agg(F.max_by(F.struct("trade_date", *columns), "trade_date").alias("s")).select("ts_code", "s.*")


def missing_state(codes: DataFrame, state: DataFrame, all_routes: DataFrame) -> DataFrame:
    """(instrument, route) without a state row; the routes are twelve rows."""
    return codes.select("ts_code").join(F.broadcast(all_routes.select("indicator", "freq"))).join(state, ["ts_code", "indicator", "freq"], "left_anti")


def spec_freshness(state: DataFrame, all_routes: DataFrame) -> DataFrame:
    """Per route: state rows, those of the expected version and stale ones."""
    rows = state.join(F.broadcast(all_routes), ["indicator", "freq"])
    return rows.groupBy("indicator", "freq").agg(
        F.count("*").alias("n_total"), F.count_if(F.col("spec_version") == F.col("expected_version")).alias("n_ok"), F.count_if(~F.col("spec_version").eqNullSafe(F.col("expected_version"))).alias("n_stale")
    )


def affected(events: DataFrame, spark) -> DataFrame:
    """Per instrument the indicators that its changed columns feed; an inserted row feeds all."""
    deps = spark.createDataFrame([(c, i) for i, cols in READS.items() for c in cols], "column_name string, indicator string")
    some = events.join(F.broadcast(deps), "column_name").select("ts_code", "indicator")
    every = events.where("is_insert").select("ts_code").distinct().join(F.broadcast(spark.createDataFrame([(i,) for i in READS], "indicator string")))
    return some.unionByName(every).distinct().groupBy("ts_code").agg(F.array_join(F.sort_array(F.collect_set("indicator")), ",").alias("indicators"))


def recalc_start(cal: DataFrame, date: str, n: int) -> DataFrame:
    """The trading day ``n`` before the last one at or before a date."""
    days = cal.where((F.col("is_open") == 1) & (F.col("cal_date") <= date)).select("cal_date", "day_idx")
    last = days.agg(F.max("day_idx").alias("hi"))
    return days.join(F.broadcast(last)).where(F.col("day_idx") == F.greatest(F.col("hi") - n, F.lit(1))).select(F.col("cal_date").alias("start"))


def invalidate(snapshots: DataFrame, codes: DataFrame, since: str) -> DataFrame:
    """Snapshots without the rows of given instruments from a date on."""
    return snapshots.join(codes.select("ts_code", F.lit(since).alias("_s")), (snapshots.ts_code == codes.ts_code) & (F.col("trade_date") >= F.col("_s")), "left_anti")


def availability(stocks: DataFrame, all_routes: DataFrame, skips: DataFrame) -> DataFrame:
    """Active instruments by route with the newest skip reason, if any."""
    w = Window.partitionBy("ts_code", "indicator", "freq").orderBy(F.desc("calc_date"))
    newest = skips.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("ts_code", "indicator", "freq", "reason")
    rows = stocks.where("is_active = 1").select("ts_code").join(F.broadcast(all_routes.select("indicator", "freq")))
    return rows.join(newest, ["ts_code", "indicator", "freq"], "left").withColumn("status", F.when(F.col("reason").isNull(), "available").otherwise("skipped"))


def new_bar_counts(panel: DataFrame) -> DataFrame:
    return panel.groupBy("trade_date").agg(F.count("*").alias("n_rows"))


# Bars an indicator looks back on, seeds from, keeps for events and must have; the margin of a recomputation.
WIDTHS = {"macd": (250, 26, 10, 27), "ma": (10, 10, 5, 11), "kpattern": (60, 10, 5, 30), "dde": (250, 5, 10, 10), "volume": (120, 5, 5, 5), "position": (250, 0, 0, 2)}
SAFETY = 5


def recalc_bars(panel: DataFrame) -> DataFrame:
    """``(ts_code, indicator, bars)``: how many of its bars each instrument loads for an indicator, and for ``all`` of them."""
    need = {i: sum(w[:3]) for i, w in WIDTHS.items()}
    need["all"] = max(need.values()) + SAFETY
    rows = F.array(*[F.struct(F.lit(i).alias("indicator"), F.least(F.col("n"), F.lit(n).cast("long")).alias("bars")) for i, n in need.items()])
    return panel.groupBy("ts_code").agg(F.count("*").alias("n")).select("ts_code", F.inline(rows))


def spare_unchanged(modes: DataFrame, prints: DataFrame, stored: DataFrame) -> DataFrame:
    """Routes with FULL turned to SKIP where the domain's fingerprint is the stored one and no bar is new."""
    same = prints.join(stored.select("ts_code", F.col("fp").alias("_fp")), "ts_code").where("fp = _fp").select("ts_code", F.lit(True).alias("_same"))
    out = modes.join(same, "ts_code", "left")
    spare = (F.col("mode") == "FULL") & F.col("_same") & (F.col("new_bars") == 0)
    return out.withColumn("mode", F.when(spare, "SKIP").otherwise(F.col("mode"))).drop("_same")


def upsert_state(state: DataFrame, new: DataFrame) -> DataFrame:
    """State rows by (instrument, indicator, frequency), new ones first; one with the same date and fingerprint stays as it is."""
    keys = ["ts_code", "indicator", "freq"]
    both = state.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    group = Window.partitionBy(*keys)
    same = (F.size(F.collect_set(F.struct("last_trade_date", "history_fp")).over(group)) == 1) & (F.count("*").over(group) > 1)
    first = F.row_number().over(group.orderBy(F.when(F.col("_same"), F.col("_new")).otherwise(-F.col("_new"))))
    return both.withColumn("_same", same).withColumn("_r", first).where("_r = 1").drop("_r", "_new", "_same")


def may_skip(written: DataFrame, stale: DataFrame, freshness: DataFrame, snapshots: DataFrame, date: str) -> DataFrame:
    """One row: whether a run may skip bars and indicators, as nothing was written, nothing is stale and results exist."""
    one = written.agg(F.count("*").alias("n_written")).join(stale.agg(F.count("*").alias("n_stale")))
    one = one.join(freshness.agg(F.coalesce(F.sum("n_stale"), F.lit(0)).alias("n_old_spec"))).join(snapshots.agg(F.count_if(F.col("trade_date") >= date).alias("n_snapshots")))
    ok = (F.col("n_written") == 0) & (F.col("n_stale") == 0) & (F.col("n_old_spec") == 0) & (F.col("n_snapshots") > 0)
    return one.withColumn("may_skip", ok)


def refresh_scope(stocks: DataFrame, all_routes: DataFrame, n_dates: int, indicators: tuple[str, ...] | None = None) -> DataFrame:
    """Per chosen route the instruments to refresh (dde has none of the Beijing exchange) and the work over the dates."""
    routes_ = all_routes if indicators is None else all_routes.where(F.col("indicator").isin(*indicators))
    n = stocks.agg(F.count("*").alias("_all"), F.count_if(~F.col("ts_code").endswith(".BJ")).alias("_flow"))
    codes = F.when(F.col("indicator") == "dde", F.col("_flow")).otherwise(F.col("_all"))
    return routes_.join(F.broadcast(n)).select("indicator", "freq", codes.alias("n_codes"), (codes * n_dates).alias("n_work"))


def settled(state: DataFrame, all_routes: DataFrame, date: str) -> DataFrame:
    """Per instrument whether its state alone lets a run of that date pass: all routes there, of the date and of the expected version."""
    rows = state.join(F.broadcast(all_routes), ["indicator", "freq"])
    fine = (F.col("last_trade_date") >= date) & (F.col("spec_version") == F.col("expected_version"))
    n = all_routes.count()
    return rows.groupBy("ts_code").agg(F.count_if(fine).alias("n_fine")).select("ts_code", (F.col("n_fine") == n).alias("settled"))


def chosen(panel: DataFrame, modes: DataFrame, *wanted: str) -> DataFrame:
    """The bars of instruments whose route is one of the wanted modes."""
    return panel.join(modes.where(F.col("mode").isin(*wanted)).select("ts_code"), "ts_code", "left_semi")


def routed(operator, panel: DataFrame, modes: DataFrame, stored: DataFrame, lookback: int) -> DataFrame:
    """Results brought up to date by mode: SKIP keeps what is stored, APPEND adds new bars, FULL computes anew."""
    full = operator(chosen(panel, modes, "FULL"))
    kept = stored.join(modes.where("mode != 'FULL'").select("ts_code"), "ts_code", "left_semi")
    last = kept.groupBy("ts_code").agg(F.max("trade_date").alias("last_trade_date"))
    return full.unionByName(kept).unionByName(append(operator, chosen(panel, modes, "APPEND"), last, lookback))


def guarded(results: DataFrame, bars: DataFrame) -> DataFrame:
    """Results of an append, which fails with the key of the first row that does not fit its new bars.

    Every new bar must stand once in ``bars`` and have one result, every result a bar. The tests are part of the plan, so they
    run with the append and not as a job of their own.
    """
    keys = ["ts_code", "trade_date"]
    own = results.withColumn("_results", F.count("*").over(Window.partitionBy(*keys)))
    asked = bars.groupBy(*keys).agg(F.count("*").alias("_bars"))
    both = own.join(asked, keys, "full")
    why = F.when(F.col("_bars").isNull(), "result without a new bar").when(F.col("_bars") > 1, "repeated new bar").when(F.col("_results").isNull(), "new bar without a result").when(F.col("_results") > 1, "repeated result")
    fine = F.assert_true(why.isNull(), F.concat_ws(" ", why, "ts_code", "trade_date")).isNull()
    return both.where(fine).select(*results.columns)


def run_route(modes: DataFrame, stored: DataFrame | None, state: DataFrame, full, fresh_state, onward) -> tuple[DataFrame | None, DataFrame]:
    """One indicator's results and states for instruments of mixed routes, ``mode`` telling each row's.

    SKIP keeps stored results and states, APPEND keeps the results and goes on from the states (``onward``: state to new rows
    and next state), FULL computes both anew (``full`` and ``fresh_state``: a filter on instruments to rows). An
    APPEND instrument without a state goes the FULL way, so no row is lost. Without stored results only the states are brought up to date.
    """
    mode = modes.select("ts_code", "mode").join(state.select("ts_code").distinct().withColumn("_has", F.lit(True)), "ts_code", "left")
    mode = mode.withColumn("mode", F.when((F.col("mode") == "APPEND") & F.col("_has").isNull(), "FULL").otherwise(F.col("mode"))).drop("_has")
    of = lambda *wanted: mode.where(F.col("mode").isin(*wanted))
    anew = of("FULL").select("ts_code")
    new, moved = onward(state.join(of("APPEND").select("ts_code"), "ts_code", "left_semi"))
    rows = None if stored is None else stored.join(of("SKIP", "APPEND"), "ts_code").unionByName(new.withColumn("mode", F.lit("APPEND"))).unionByName(full(anew).withColumn("mode", F.lit("FULL")))
    states = state.join(of("SKIP").select("ts_code"), "ts_code", "left_semi").unionByName(moved).unionByName(fresh_state(anew).select(*state.columns))
    return rows, states


# Contradictions of labels, as (rule, alignment, least and largest slope of MA5 in between, slope of MA10 over).
CONTRADICTIONS = (("bear_weakening with MA10 rising", "bear_weakening", None, None, 0.08), ("bull_strong with MA5 flat and MA10 rising", "bull_strong", -0.08, 0.08, 0.08))


def contradictions(ma: DataFrame) -> DataFrame:
    """``(ts_code, trade_date, rule)`` of averages whose alignment contradicts their slopes, by a table of rules joined to the labels."""
    rules = ma.sparkSession.createDataFrame(list(CONTRADICTIONS), "rule string, alignment string, lo5 double, hi5 double, over10 double")
    hit = (F.col("lo5").isNull() | F.col("ma5_slope").between(F.col("lo5"), F.col("hi5"))) & (F.col("ma10_slope") > F.col("over10"))
    return ma.join(F.broadcast(rules), "alignment").where(hit).select("ts_code", "trade_date", "rule")


def spec_contradictions(freshness: DataFrame, watched: tuple[str, ...] = ("ma", "macd", "volume")) -> DataFrame:
    """Routes of the watched indicators with results of an old version."""
    return freshness.where(F.col("indicator").isin(*watched) & (F.col("n_stale") > 0)).select("indicator", "freq", "n_stale")


def stale_instruments(state: DataFrame, latest: DataFrame, all_routes: DataFrame, indicators: tuple[str, ...] | None = None) -> DataFrame:
    """``(ts_code, indicator, freq)`` of old versions by their state or by their newest result, each once."""
    out = state.select("ts_code", "indicator", "freq", "spec_version").unionByName(latest.select("ts_code", "indicator", "freq", "spec_version"))
    out = out.join(F.broadcast(all_routes), ["indicator", "freq"]).where(~F.col("spec_version").eqNullSafe(F.col("expected_version")))
    out = out.where(F.col("indicator").isin(*indicators)) if indicators is not None else out
    return out.select("ts_code", "indicator", "freq").distinct()


def stale_indicators(freshness: DataFrame) -> DataFrame:
    """The indicators to refresh, as some of their results are of an old version."""
    return freshness.groupBy("indicator").agg(F.sum("n_stale").alias("n_stale")).where("n_stale > 0")
