"""Adjusted daily bars, suspension filling, week-to-date bars, money flow, and their repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.kernels import by_date
from barloom.sources import store

from .dims import as_date, roll_back

PRICES = ("open", "high", "low", "close")
VALUES = ("total_mv", "circ_mv", "pe_ttm", "turnover_rate", "volume_ratio")


def with_latest_factor(daily: DataFrame) -> DataFrame:
    """Daily rows with the adjustment factor at their instrument's last date."""
    last = daily.groupBy("ts_code").agg(F.max_by(F.coalesce("adj_factor", F.lit(0.0)), "trade_date").alias("latest"))
    return daily.join(last, "ts_code")


def adjusted_bars(daily: DataFrame, basic: DataFrame) -> DataFrame:
    """Forward-adjusted bars with valuations; rows without factor are left out."""
    rows = with_latest_factor(daily).where("adj_factor is not null and latest <> 0")
    px = [(F.col(p) * F.col("adj_factor") / F.col("latest")).alias(f"{p}_qfq") for p in PRICES]
    rows = rows.select("ts_code", "trade_date", *px, "vol", "amount", "pct_chg")
    return rows.join(basic.select("ts_code", "trade_date", *VALUES), ["ts_code", "trade_date"], "left").withColumn("is_suspended", F.lit(0))


def excluded_rows(daily: DataFrame) -> DataFrame:
    return with_latest_factor(daily).agg(F.count_if(F.expr("adj_factor is null or latest = 0")).alias("n_excluded"))


def gap_stocks(bars: DataFrame, cal: DataFrame) -> DataFrame:
    """Instruments with fewer bars than trading days between their first and last bar; no range join."""
    idx = F.broadcast(cal.where("is_open = 1").select(F.col("cal_date").alias("trade_date"), "day_idx"))
    found = bars.join(idx, "trade_date").groupBy("ts_code").agg(F.count("*").alias("n_rows"), (F.max("day_idx") - F.min("day_idx") + 1).alias("n_days"))
    return found.where("n_rows < n_days")


def fill_suspensions(bars: DataFrame, daily: DataFrame, cal: DataFrame) -> DataFrame:
    """Bars with each missing trading day, up to the last raw day, as a flat bar at the previous close.

    Only the gaps are expanded: each bar knows the next one's day index, and the days between are exploded.
    """
    days = cal.where("is_open = 1").select(F.col("cal_date").alias("trade_date"), F.col("day_idx").cast("int").alias("day_idx"))
    end = daily.groupBy("ts_code").agg(F.max("trade_date").alias("hi")).join(F.broadcast(days.withColumnsRenamed({"trade_date": "hi", "day_idx": "hi_idx"})), "hi")
    rows = bars.join(F.broadcast(days), "trade_date").join(end.select("ts_code", "hi_idx"), "ts_code")
    upto = F.coalesce(F.lead("day_idx").over(by_date()) - 1, F.col("hi_idx"))
    gaps = rows.withColumn("upto", upto).where("upto > day_idx")
    gaps = gaps.withColumn("missing", F.explode(F.sequence(F.col("day_idx") + 1, F.col("upto"))))
    flat = gaps.drop("trade_date", "day_idx").join(F.broadcast(days), F.col("missing") == F.col("day_idx"))
    zero = F.lit(0.0)
    flat = flat.select(
        "ts_code", "trade_date", *[F.col("close_qfq").alias(f"{p}_qfq") for p in PRICES], zero.alias("vol"), zero.alias("amount"), zero.alias("pct_chg"), *VALUES, F.lit(1).alias("is_suspended")
    )
    return bars.unionByName(flat)


def weekly_bars(bars: DataFrame) -> DataFrame:
    """Week-to-date bar for every trading day; volume and amount scaled to five days."""
    week = Window.partitionBy("ts_code", F.date_trunc("week", as_date("trade_date"))).orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    n = F.count("*").over(week)
    keep = [c for c in VALUES if c != "circ_mv"]
    return bars.where("is_suspended = 0").select(
        "ts_code", "trade_date", F.first("open_qfq").over(week).alias("open_qfq"), F.max("high_qfq").over(week).alias("high_qfq"), F.min("low_qfq").over(week).alias("low_qfq"), "close_qfq",
        (F.sum("vol").over(week) / n * 5).alias("vol"), (F.sum("amount").over(week) / n * 5).alias("amount"), F.sum("pct_chg").over(week).alias("pct_chg"), *keep, n.alias("active_days"),
    )


def daily_moneyflow(flow: DataFrame) -> DataFrame:
    total = sum((F.coalesce(f"buy_{s}_vol", F.lit(0.0)) for s in ("sm", "md", "lg", "elg")), F.lit(0.0))
    return flow.select("ts_code", "trade_date", "net_mf_vol", "net_mf_amount", "buy_lg_vol", "sell_lg_vol", "buy_elg_vol", "sell_elg_vol", total.alias("total_vol"), "net_amount_dc")


def factor_changed(daily: DataFrame, date: str) -> DataFrame:
    """Instruments whose last two factors up to a date, the last on it, differ."""
    w = by_date()
    rows = daily.where(F.col("trade_date") <= date).withColumn("before", F.lag("adj_factor").over(w))
    return rows.where((F.col("trade_date") == date) & ~F.col("adj_factor").eqNullSafe(F.col("before")) & F.col("before").isNotNull()).select("ts_code")


def drifted(stored: DataFrame, daily: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Instruments whose stored adjusted close differs from the recomputed one."""
    now = with_latest_factor(daily).where("latest <> 0").select("ts_code", "trade_date", (F.col("close") * F.col("adj_factor") / F.col("latest")).alias("now"))
    return stored.join(now, ["ts_code", "trade_date"]).where(F.abs(F.col("close_qfq") - F.col("now")) > tolerance).select("ts_code").distinct()


def new_listings(daily: DataFrame, bars: DataFrame, date: str) -> DataFrame:
    """Instruments with a raw row on a date and no earlier bar."""
    return daily.where(F.col("trade_date") == date).select("ts_code").join(bars.where(F.col("trade_date") < date).select("ts_code"), "ts_code", "left_anti")


def behind(daily: DataFrame, bars: DataFrame, date: str) -> DataFrame:
    """Instruments with a raw row on a date whose last bar is older."""
    last = bars.groupBy("ts_code").agg(F.max("trade_date").alias("last"))
    return daily.where(F.col("trade_date") == date).select("ts_code").join(last, "ts_code").where(F.col("last") < date)


def needing_refresh(daily: DataFrame, stored: DataFrame, date: str) -> DataFrame:
    """Union of changed factors, drift and new listings."""
    return factor_changed(daily, date).union(drifted(stored, daily)).union(new_listings(daily, stored, date)).distinct()


def refresh_prices(stored: DataFrame, daily: DataFrame) -> DataFrame:
    """Stored bars with prices re-adjusted where the raw rows give a new value."""
    new = with_latest_factor(daily).where("adj_factor is not null and latest <> 0")
    new = new.select("ts_code", "trade_date", *[(F.col(p) * F.col("adj_factor") / F.col("latest")).alias(f"_{p}") for p in PRICES])
    out = stored.join(new, ["ts_code", "trade_date"], "left").withColumns({f"{p}_qfq": F.coalesce(f"_{p}", f"{p}_qfq") for p in PRICES})
    return out.drop(*[f"_{p}" for p in PRICES])


def tail_bars(daily: DataFrame, basic: DataFrame, cal: DataFrame, stored: DataFrame) -> DataFrame:
    """Bars of the raw rows after each instrument's last stored bar, days without one filled from that bar on."""
    names = [c for c in stored.columns if c != "ts_code"]
    last = stored.groupBy("ts_code").agg(F.max_by(F.struct(*names), "trade_date").alias("x")).select("ts_code", "x.*")
    since = last.select("ts_code", F.col("trade_date").alias("_last"))
    new = daily.join(since, "ts_code").where("trade_date > _last").drop("_last")
    bars = adjusted_bars(new, basic)
    return fill_suspensions(last.select(*bars.columns).unionByName(bars), new, cal).join(since, "ts_code").where("trade_date > _last").drop("_last")


def incremental_parts(stored: DataFrame, daily: DataFrame, basic: DataFrame, cal: DataFrame, date: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What brings stored bars up to a date: instruments to compute anew, all their bars, and the new bars of the others.

    An instrument without a stored bar is computed anew whether or not it has a raw row on that date.
    """
    upto = daily.where(F.col("trade_date") <= date)
    absent = upto.select("ts_code").distinct().join(stored.select("ts_code"), "ts_code", "left_anti")
    codes = needing_refresh(upto, stored, date).union(absent).distinct()
    full = fill_suspensions(adjusted_bars(upto.join(codes, "ts_code", "left_semi"), basic), upto, cal)
    calm = lambda d: d.join(codes, "ts_code", "left_anti")
    return codes, full, tail_bars(calm(upto), basic, cal, calm(stored))


def rebuild_incremental(stored: DataFrame, daily: DataFrame, basic: DataFrame, cal: DataFrame, date: str) -> DataFrame:
    """Stored bars brought up to a date: refreshed instruments from all raw rows, others with the new tail only; ``route`` says which."""
    codes, full, tail = incremental_parts(stored, daily, basic, cal, date)
    route = lambda d, r: d.withColumn("route", F.lit(r))
    return route(stored.join(codes, "ts_code", "left_anti"), "kept").unionByName(route(tail, "tail")).unionByName(route(full, "full"))


def rebuild_all(spark: SparkSession, quotes: str, weekly: str, flows: str, daily: DataFrame, basic: DataFrame, flow: DataFrame, cal: DataFrame, buckets: int = 64) -> None:
    """Write the three stored layers anew: daily bars first, as the weekly ones come from them."""
    store.put(fill_suspensions(adjusted_bars(daily, basic), daily, cal), quotes, buckets)
    store.put(weekly_bars(store.stored(spark, quotes)), weekly, buckets)
    store.put(daily_moneyflow(flow), flows, buckets)


def refresh_layers(spark: SparkSession, quotes: str, weekly: str, flows: str, daily: DataFrame, basic: DataFrame, flow: DataFrame, cal: DataFrame, date: str, buckets: int = 64) -> None:
    """Bring the stored layers (paths of daily bars, weekly bars and money flow) up to a date.

    Daily bars: instruments with a changed factor, drifted or not stored from all raw rows, others by their tail. Weekly bars:
    all weeks of the former, the weeks that the tail touches of the others; what the former no longer have goes. Money flow: its tail.
    Only partitions with a changed row are written; a second run changes nothing.
    """
    codes, full, tail = (store.staged(d) for d in incremental_parts(store.stored(spark, quotes), daily, basic, cal, date))
    for path, anew in ((quotes, full), (weekly, full.where("is_suspended = 0"))):
        old = store.stored(spark, path).join(codes, "ts_code", "left_semi")
        store.remove(spark, path, old.join(anew.select(*store.KEYS), list(store.KEYS), "left_anti"), buckets)
    store.merge(spark, quotes, full.unionByName(tail), buckets)
    monday = F.date_format(F.date_trunc("week", as_date("first")), "yyyyMMdd")
    since = tail.groupBy("ts_code").agg(F.min("trade_date").alias("first")).select("ts_code", monday.alias("monday"))
    weeks = store.stored(spark, quotes).join(since, "ts_code").where("trade_date >= monday").drop("monday")
    store.merge(spark, weekly, weekly_bars(full).unionByName(weekly_bars(weeks)), buckets)
    last = store.stored(spark, flows).groupBy("ts_code").agg(F.max("trade_date").alias("_last"))
    new = flow.where(F.col("trade_date") <= date).join(last, "ts_code", "left").where("_last is null or trade_date > _last").drop("_last")
    store.merge(spark, flows, daily_moneyflow(new), buckets)


def sync_meta(stored: DataFrame, fresh: DataFrame, columns: list[str]) -> DataFrame:
    """Stored rows with the given columns taken from ``fresh`` where they differ; ``n_changed`` counts them per row."""
    new = fresh.select("ts_code", "trade_date", *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_there"))
    out = stored.join(new, ["ts_code", "trade_date"], "left")
    n = sum((F.when(F.col("_there") & ~F.col(c).eqNullSafe(F.col(f"_{c}")), 1).otherwise(0) for c in columns), F.lit(0))
    out = out.withColumn("n_changed", n).withColumns({c: F.when(F.col("_there"), F.col(f"_{c}")).otherwise(F.col(c)) for c in columns})
    return out.drop("_there", *[f"_{c}" for c in columns])


def orphan_weeks(weekly_rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Weekly result rows on days that are no week-ends any more."""
    return weekly_rows.join(F.broadcast(dim.where("is_week_end = 1").select("trade_date")), "trade_date", "left_anti")


def right_week_ends(dim: DataFrame) -> DataFrame:
    """The last trading day of every calendar week, whatever is marked."""
    return dim.groupBy(F.date_trunc("week", as_date("trade_date")).alias("week")).agg(F.max("trade_date").alias("trade_date")).select("trade_date")


def mark_changes(dim: DataFrame) -> DataFrame:
    """``(kind, trade_date)``: week-ends marked wrongly, and ones not marked; a day marked twice is wrong once."""
    marked, right = dim.where("is_week_end = 1").select("trade_date"), right_week_ends(dim)
    kind = lambda d, k: d.select(F.lit(k).alias("kind"), "trade_date")
    return kind(marked.exceptAll(right), "wrongly_marked").unionByName(kind(right.exceptAll(marked), "newly_marked"))


def repair_report(dim: DataFrame, results: dict[str, DataFrame]) -> DataFrame:
    """``(kind, table_name, trade_date, n)``: marks to change, and per weekly table the rows on days that are no week-ends."""
    right = F.broadcast(right_week_ends(dim))
    out = mark_changes(dim).select("kind", F.lit("dim_date").alias("table_name"), "trade_date", F.lit(1).cast("long").alias("n"))
    for name, rows in results.items():
        gone = rows.join(right, "trade_date", "left_anti").groupBy("trade_date").agg(F.count("*").alias("n"))
        out = out.unionByName(gone.select(F.lit("orphan").alias("kind"), F.lit(name).alias("table_name"), "trade_date", "n"))
    return out


def repair_weekly(spark: SparkSession, dim: str, results: dict[str, str], states: str, buckets: int = 64) -> dict[str, int]:
    """Mark the right week-ends in the stored calendar, delete orphan rows of the stored weekly tables, and drop the
    weekly states (a folder by frequency) if anything changed. Returns the number of changes by table; a second run makes none."""
    days = store.staged(spark.read.parquet(dim))
    done = {"dim_date": mark_changes(days).count()}
    if days.isEmpty():
        return done
    right = right_week_ends(days).withColumn("_right", F.lit(1))
    if done["dim_date"]:
        fixed = days.join(F.broadcast(right), "trade_date", "left").withColumn("is_week_end", F.coalesce("_right", F.lit(0))).select(*days.columns)
        fixed.coalesce(1).write.mode("overwrite").parquet(dim)  # a calendar
    for name, path in results.items():
        done[name] = store.remove(spark, path, store.stored(spark, path).join(F.broadcast(right), "trade_date", "left_anti"), buckets)
    if any(done.values()):
        store.drop_folder(spark, f"{states}/freq=weekly")
    return done


def resample_weekly(bars: DataFrame) -> DataFrame:
    """Calendar weeks labelled by their Sunday with the last close that is not null; empty weeks do not appear."""
    sunday = F.date_format(F.date_add(F.date_trunc("week", as_date("trade_date")).cast("date"), 6), "yyyyMMdd")
    rows = bars.where("is_suspended = 0 and close_qfq is not null")
    return rows.groupBy("ts_code", sunday.alias("week")).agg(F.max_by("close_qfq", "trade_date").alias("close"), F.max("trade_date").alias("last_date"))


def weekly_moneyflow(flow: DataFrame, weekly: DataFrame, dim: DataFrame, basic: DataFrame, share: float = 0.6) -> DataFrame:
    """Money flow summed over (previous week-end, week-end] of the instrument's own week-ends.

    Each flow day goes to the instrument's next week-end: a window that runs back from the last day instead of a
    range join. A first week reaches back seven days. ``is_skipped`` marks weeks with
    under ``share`` of the trading days.
    """
    ends = weekly.join(F.broadcast(dim.where("is_week_end = 1").select("trade_date")), "trade_date").select("ts_code", "trade_date")
    ends = ends.withColumn("prev", F.lag("trade_date").over(by_date()))
    ends = ends.withColumn("prev", F.coalesce("prev", F.date_format(F.date_sub(as_date("trade_date"), 7), "yyyyMMdd")))
    both = flow.unionByName(ends.select("ts_code", "trade_date", F.col("trade_date").alias("week_end"), "prev"), allowMissingColumns=True)
    ahead = Window.partitionBy("ts_code").orderBy(F.desc("trade_date")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = both.withColumns({"week_end": F.last("week_end", True).over(ahead), "prev": F.last("prev", True).over(ahead)}).where("total_vol is not null and trade_date > prev")
    sums = ["net_mf_vol", "net_mf_amount", "buy_lg_vol", "sell_lg_vol", "buy_elg_vol", "sell_elg_vol", "total_vol"]
    week = rows.groupBy("ts_code", "week_end", "prev").agg(*[F.sum(F.coalesce(c, F.lit(0.0))).alias(c) for c in sums], F.countDistinct("trade_date").alias("active_days"))
    idx = dim.select("trade_date", "day_idx")
    end_idx = F.broadcast(idx.withColumnsRenamed({"trade_date": "week_end", "day_idx": "e"}))
    days = dim.select(F.col("trade_date").alias("cal_date"), F.lit(1).alias("is_open"))
    upto = roll_back(ends.select("prev").distinct(), days, "prev").join(F.broadcast(idx), "trade_date", "left")
    upto = F.broadcast(upto.select("prev", F.coalesce("day_idx", F.lit(0)).alias("p")))  # one row a date
    weeks = week.join(end_idx, "week_end").join(upto, "prev").withColumn("expected_days", F.col("e") - F.col("p")).drop("e", "p")
    mv = basic.select("ts_code", F.col("trade_date").alias("week_end"), "circ_mv", "total_mv")
    return weeks.join(mv, ["ts_code", "week_end"], "left").withColumn("is_skipped", (F.col("active_days") < share * F.col("expected_days")).cast("int"))
