"""Structure divergence of price and MACD lines, by windows alone, and the tradable verdict on its events.

A segment starts where the fast line crosses the slow one; its running extremes are
compared with those at the end of the segment before, and of the one before that.
A bottom is a top of the negated series, so one definition serves both: bars stand twice, by their sign, behind
the crossings, and one order by segment serves all that follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.kernels import by_date, r10, rn, scaled_part, thinned

from .incremental import after, newest

GAP, MOST_LAG = 10, 1
LABELS = {1: "top_divergence", -1: "bottom_divergence"}

#: What an open segment carries on: the last bar, the last crossing, running extremes, those of the two segments before, and the last tests.
_CARRIED = (
    dict.fromkeys(("rn", "gc", "peak"), "int") | dict.fromkeys(("f", "s", "b", "f_back", "top_c", "top_f", "top_b"), "double") | dict.fromkeys(("known", "t1", "t2"), "boolean")
    | dict.fromkeys((f"{c}{n}" for c in "hfb" for n in (1, 2, 3)), "double") | dict.fromkeys(("m2", "m3"), "bigint")
    | {"p": "struct<rn:int,f:double,p1:double,p2:double,n1:double,n2:double>"}
)
_STATE = f"struct<{','.join(f'{c}:{t}' for c, t in _CARRIED.items())}>"


def in_order():
    """An instrument's bars of a sign by segment and number, which is their order by date: one sort serves these windows and those of segments."""
    return Window.partitionBy("ts_code", "sign").orderBy("gc", "rn")


def _flow_peak(inside: Column, known: Column) -> Column:
    """Running largest flow of a segment, while all its flows are known. A top that stands alone, fewer than two of
    the five flows around it at 0.8 of it or more, is none; a bottom needs a flow below zero."""
    p = F.col("p")
    high = lambda c, ok: F.when(ok & (p[c] >= p["f"] * 0.8), 1).otherwise(0)
    n = F.when(p["f"] >= p["f"] * 0.8, 1).otherwise(0) + high("p1", F.lit(True)) + high("p2", F.lit(True)) + high("n1", F.col("rn") > p["rn"]) + high("n2", F.col("rn") > p["rn"] + 1)
    return F.when(inside & known, F.when(F.col("sign") < 0, F.when(F.col("top_f") > 0, F.col("top_f"))).when(n >= 2, p["f"]))


def _peak_bar(run, open_: Column) -> Column:
    """The segment's bar of largest flow with its neighbours; a carried one gets those that came since."""
    z = F.col("z")
    lag = lambda n: F.when(F.col("local") > n, F.col(f"f_{n}")).otherwise(F.when(F.col("local") == n, z["f"]).otherwise(z["f_back"]))
    back1, back2 = (F.when(F.col("rn") - n >= F.col("gc"), lag(n)) for n in (1, 2))
    here = F.struct(F.col("rn").alias("rn"), F.col("f").alias("f"), back1.alias("p1"), back2.alias("p2"), F.col("f_next1").alias("n1"), F.col("f_next2").alias("n2"))
    whole = in_order().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, second, old = F.nth_value("f", 1).over(whole), F.nth_value("f", 2).over(whole), z["p"]
    n1 = F.when(old["rn"] == z["rn"], first).otherwise(old["n1"])
    n2 = F.when(old["rn"] == z["rn"], second).when(old["rn"] == z["rn"] - 1, first).otherwise(old["n2"])
    carried = F.when(open_ & old.isNotNull(), F.struct(old["rn"].alias("rn"), old["f"].alias("f"), old["p1"].alias("p1"), old["p2"].alias("p2"), n1.alias("n1"), n2.alias("n2")))
    return F.coalesce(F.last(F.when(F.col("first_f"), here), ignorenulls=True).over(run), carried)


def _signed(lines: DataFrame, state: DataFrame | None) -> DataFrame:
    """Every bar for tops and for bottoms, by ``sign``, with the number of its segment's first bar; ``z`` is what a state carries, null without one."""
    values = {"c": "close", "f": "dif", "s": "dea", "b": "macd_bar"}
    d = lines.select("ts_code", "trade_date", *[r10(F.col(c)).alias(a) for a, c in values.items()])
    if state is None:
        d = d.withColumns({f"z{sign}": F.lit(None).cast(_STATE) for sign in LABELS})
    else:
        d = d.join(state.groupBy("ts_code").agg(*[F.first(F.when(F.col("sign") == sign, F.col("z")), True).alias(f"z{sign}") for sign in LABELS]), "ts_code")
    near = {f"{c}_{n}": F.lag(c, n).over(by_date()) for c, n in (("f", 1), ("f", 2), ("s", 1), ("b", 1))} | {f"f_next{n}": F.lead("f", n).over(by_date()) for n in (1, 2)}
    d, past, every = d.withColumns({"local": rn()} | near), by_date().rowsBetween(Window.unboundedPreceding, 0), []
    for sign in LABELS:
        z = F.col(f"z{sign}")
        was = {c: F.when(F.col("local") == 1, z[c]).otherwise(F.col(f"{c}_1") * sign) for c in "fs"}
        crossed = (was["f"] <= was["s"]) & (F.col("f") * sign > F.col("s") * sign)
        at = F.coalesce(z["rn"], F.lit(0)) + F.col("local")
        every.append(F.struct(F.lit(sign).alias("sign"), z.alias("z"), at.alias("rn"), F.coalesce(F.last(F.when(crossed, at), ignorenulls=True).over(past), z["gc"]).alias("gc")))
    signed = [*values, *near]
    d = d.select("ts_code", "trade_date", "local", *signed, F.array(*every).alias("every")).select("ts_code", "trade_date", "local", *signed, F.inline("every"))
    return d.withColumns({c: F.col(c) * F.col("sign") + 0.0 for c in signed})  # no negative zeros


def _followed(lines: DataFrame, flow: bool, state: DataFrame | None) -> DataFrame:
    """The bars of both signs with their segments' running extremes and tests."""
    d, z = _signed(lines, state), F.col("z")
    lag = lambda c: F.when(F.col("local") == 1, z[c]).otherwise(F.col(f"{c}_1") if c in "fb" else F.lag(c).over(in_order()))
    seg = Window.partitionBy("ts_code", "sign", "gc").orderBy("rn")
    run, before = seg.rowsBetween(Window.unboundedPreceding, 0), seg.rowsBetween(Window.unboundedPreceding, -1)
    inside, open_ = F.col("gc").isNotNull(), z.isNotNull() & F.col("gc").eqNullSafe(z["gc"])
    most = lambda x, c, w=run: F.greatest(F.max(x).over(w), F.when(open_, z[c]))
    d = d.withColumns({
        "top_c": most("c", "top_c"), "top_f": most("f", "top_f"), "top_b": most(F.when(F.col("b") > 0, F.col("b")), "top_b"),
        "known": (F.count("f").over(run) == F.count("*").over(run)) & F.coalesce(F.when(open_, z["known"]), F.lit(True)),
        "new": F.coalesce(F.col("c") > most("c", "top_c", before), F.lit(True)),
    })
    if flow:
        d = d.withColumn("first_f", F.coalesce(F.col("f") > most("f", "top_f", before), F.col("f").isNotNull()))
        d = d.withColumn("p", _peak_bar(run, open_))
        d = d.withColumn("f1", _flow_peak(inside, F.col("known")))
        d = d.withColumns({"b1": F.when(F.col("f1") > 0, F.col("f1")), "h1": F.when(inside & F.col("known"), F.col("top_c"))})
    else:
        d = d.withColumns({f"{k}1": F.when(inside, F.col(f"top_{c}")) for k, c in zip("hfb", "cfb")}).withColumn("p", z["p"])
    d = d.withColumn("peak", F.coalesce(F.last(F.when(F.col("new"), F.col("rn")), ignorenulls=True).over(run), F.when(open_, z["peak"])))
    prior = lambda c, k: F.when(inside, F.when(open_, z[k]).otherwise(F.first(F.col(c)).over(run)))
    d = d.withColumns({f"_{c}": lag(f"{c}1") for c in "hfb"}).withColumns({f"{c}2": prior(f"_{c}", f"{c}2") for c in "hfb"})
    d = d.withColumns({f"_{c}": F.when(lag("h2").isNotNull(), lag(f"{c}2")) for c in "hfb"}).withColumns({f"{c}3": prior(f"_{c}", f"{c}3") for c in "hfb"})
    valid = F.col("h1").isNotNull() & F.col("f2").isNotNull()
    part = lambda ref: F.when(valid, scaled_part(F.col("f"), F.col(ref)))
    d = d.withColumns({"m2": part("f2"), "m3": part("f3"), "red": F.coalesce((F.col("b") > 0) & (lag("b") > 0), F.lit(False)), "valid": valid})
    t1 = (F.col("h1") > F.col("h2")) & (F.col("m2") < scaled_part(F.col("f2"), F.col("f2"))) & F.col("red") & (F.col("m2") >= lag("m2")) & (F.col("b1") < F.col("b2"))
    t2 = (F.col("h1") > F.col("h3")) & (F.col("h3") > F.col("h2")) & (F.col("m3") < scaled_part(F.col("f3"), F.col("f3"))) & F.col("red") & (F.col("m3") >= lag("m3")) & (F.col("b1") < F.col("b3"))
    d = d.withColumns({"t1": F.coalesce(valid & t1, F.lit(False)), "t2": F.coalesce(valid & t2, F.lit(False))})
    return d.withColumns({"w1": F.coalesce(lag("t1"), F.lit(False)), "w2": F.coalesce(lag("t2"), F.lit(False)), "l2": lag("m2"), "l3": lag("m3"), "f_back": lag("f")})


def tops(lines: DataFrame, sign: int = 1, flow: bool = False, state: DataFrame | None = None) -> DataFrame:
    """Events ``(ts_code, trade_date, rn, path, lag_bars, zone_ok)`` before spacing; ``lines`` has close, dif, dea and bar.

    With ``flow`` the lines are ddx, ddx2 and ddx again: peaks are :func:`_flow_peak`. With a state the lines are those of later bars.
    """
    d = _followed(lines, flow, state).where(F.col("sign") == sign)
    return d.where(_hit()).select("ts_code", *_event())


def _hit() -> Column:
    """Whether a bar is an event."""
    turned = F.when(F.col("w1"), F.col("m2") < F.col("l2")).when(F.col("w2"), F.col("m3") < F.col("l3"))
    over = (F.col("w1") & (F.col("f1") >= F.col("f2"))) | (F.col("w2") & F.coalesce(F.col("f1") >= F.col("f3"), F.lit(False)))
    return F.col("valid") & F.coalesce(turned, F.lit(False)) & ~over


def _event() -> list[Column]:
    path = F.when(F.col("w1"), "direct").otherwise("skip_peak")
    return [F.col("rn"), F.col("trade_date"), path.alias("path"), (F.col("rn") - F.col("peak")).alias("lag_bars"), (F.col("b") > 0).alias("zone_ok")]


def structure_state(lines: DataFrame, flow: bool = False) -> DataFrame:
    """``(ts_code, sign, last_trade_date, z, kept)``: for tops and bottoms the open segment at the last bar, and the last event that counts."""
    return _structure(lines, flow, None)[1]


def continue_structure(lines: DataFrame, state: DataFrame, flow: bool = False) -> tuple[DataFrame, DataFrame]:
    """Events of the bars after a state (:func:`structure_state`), equal to a full run's, and the state after them.

    ``lines`` may hold later bars only; earlier ones are dropped and those of instruments without a state left to a full run.
    """
    events, moved = _structure(after(lines, state.where("sign = 1")), flow, state)
    return events, newest(state, moved, "ts_code", "sign")


def _structure(lines: DataFrame, flow: bool, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Events that count and the states after the bars, both from one row an instrument and sign."""
    d = _followed(lines, flow, state)
    one = d.groupBy("ts_code", "sign").agg(
        F.max("trade_date").alias("last_trade_date"), F.max_by(F.struct(*_CARRIED), "trade_date").alias("z"), F.array_sort(F.collect_list(F.when(_hit(), F.struct(*_event())))).alias("all")
    )
    before = F.lit(None).cast("int")
    if state is not None:
        one, before = one.join(state.select("ts_code", "sign", F.col("kept").alias("_kept")), ["ts_code", "sign"], "left"), F.col("_kept")
    label = F.when(F.col("sign") == 1, LABELS[1]).otherwise(LABELS[-1]).alias("label")
    found = thinned(one.where(F.size("all") > 0), "all", GAP, before)
    events = found.select("ts_code", label, F.inline("all"))
    ends = thinned(one, "all", GAP, before).select("ts_code", "sign", "last_trade_date", "z", F.coalesce(F.try_element_at("all", F.lit(-1))["rn"], before).alias("kept"))
    return events, ends


def flow_lines(dde: DataFrame, panel: DataFrame) -> DataFrame:
    """Money-flow lines as :func:`tops` takes them."""
    own = dde.select("ts_code", "trade_date", F.col("ddx").alias("dif"), F.col("ddx2").alias("dea"), F.col("ddx").alias("macd_bar"))
    return own.join(panel.select("ts_code", "trade_date", F.col("close_qfq").alias("close")), ["ts_code", "trade_date"])


def all_events(macd_lines: DataFrame, flow_rows: DataFrame) -> DataFrame:
    """Events of both indicators, each with its name."""
    return divergence_events(macd_lines).withColumn("indicator", F.lit("macd")).unionByName(divergence_events(flow_rows, True).withColumn("indicator", F.lit("dde")))


def enriched(wide: DataFrame, events: DataFrame) -> DataFrame:
    """Wide rows with the divergence label, tradable label and reject reason of each indicator's event on that day."""
    e = tradable(events)
    pick = lambda c: [F.min(F.when(F.col("indicator") == i, F.col(c))).alias(f"{i}_{n}") for i in ("macd", "dde") for n in (NAMES[c],)]
    by_day = e.groupBy("ts_code", "trade_date").agg(*pick("label"), *pick("tradable"), *pick("reject_reason"))
    return wide.join(by_day, ["ts_code", "trade_date"], "left")


NAMES = {"label": "divergence", "tradable": "tradable", "reject_reason": "reject"}
# Display texts of verdicts and labels.
REASON_TEXT = {"skip_peak": "隔峰", "tg_lag": "滞后", "zone_mismatch": "区域"}
LABEL_TEXT = {"top_divergence": "顶背离", "bottom_divergence": "底背离"}


def in_words(events: DataFrame) -> DataFrame:
    """Tradable events with their label and reject reason as display texts."""
    words = lambda c, texts: F.create_map(*[F.lit(x) for kv in texts.items() for x in kv])[F.col(c)]
    return tradable(events).withColumns({"label_text": words("tradable", LABEL_TEXT), "reason_text": words("reject_reason", REASON_TEXT)})


def screen(events: DataFrame, date: str, only_tradable: bool = False) -> DataFrame:
    """The events of a day with their verdicts."""
    found = tradable(events).where(F.col("trade_date") == date)
    return found.where("tradable is not null") if only_tradable else found


def divergence_events(lines: DataFrame, flow: bool = False) -> DataFrame:
    """Top and bottom divergences, each label at most once in GAP bars after one that counts, with their trace."""
    return _structure(lines, flow, None)[0]


def tradable(events: DataFrame) -> DataFrame:
    """Events with ``reject_reason``: an indirect path, a late turn, a bar on the wrong side; null passes."""
    why = F.when(F.col("path") == "skip_peak", "skip_peak").when(F.col("lag_bars") > MOST_LAG, "tg_lag").when(~F.col("zone_ok"), "zone_mismatch")
    return events.withColumn("reject_reason", why).withColumn("tradable", F.when(F.col("reject_reason").isNull(), F.col("label")))


def trace_frame(rows: DataFrame, upto: str, n: int = 250) -> DataFrame:
    """The last bars of every instrument up to a date."""
    w = Window.partitionBy("ts_code").orderBy(F.desc("trade_date"))
    return rows.where(F.col("trade_date") <= upto).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def verdicts(labels: DataFrame, events: DataFrame) -> DataFrame:
    """Verdict per stored label: its event's, or by the bar's side alone where the trace does not give it again."""
    e = tradable(events).select("ts_code", "trade_date", "label", "reject_reason", F.lit(True).alias("_found"))
    side = F.when(F.col("label") == "top_divergence", F.col("macd_bar") > 0).otherwise(F.col("macd_bar") < 0)
    fallback = F.when(side, "skip_peak").otherwise("zone_mismatch")
    out = labels.join(e, ["ts_code", "trade_date", "label"], "left")
    return out.withColumn("reject_reason", F.when(F.col("_found"), F.col("reject_reason")).otherwise(fallback)).drop("_found")


def structure_counts(events: DataFrame) -> DataFrame:
    return tradable(events).groupBy("label").agg(F.count("*").alias("n_events"), F.count("tradable").alias("n_tradable"))
