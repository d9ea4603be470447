"""Ingest: validation, change capture, keyed upserts and gap planning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.kernels import values_equal

from .dims import roll_back, trading_days_between

KEYS = ["ts_code", "trade_date"]
REQUIRED = ("open", "high", "low", "close", "vol", "amount")


def validated(rows: DataFrame) -> DataFrame:
    """Rows with ``is_valid``: required fields numeric and present, high not below low."""
    numeric = [F.expr(f"try_cast({c} as double)").isNotNull() for c in REQUIRED]
    ok = reduce(lambda a, b: a & b, numeric) & F.coalesce(F.expr("try_cast(high as double) >= try_cast(low as double)"), F.lit(False))
    return rows.withColumn("is_valid", ok)


def fix_code(code: Column) -> Column:
    """Six digits with the exchange's suffix; anything else is null."""
    c = F.upper(F.trim(code))
    six = F.regexp_extract(c, r"^(\d{6})(\.(SH|SZ|BJ))?$", 1)
    suffix = F.when(six.rlike("^[69]"), ".SH").when(six.rlike("^[023]"), ".SZ").when(six.rlike("^[48]"), ".BJ")
    return F.when(c.rlike(r"^\d{6}\.(SH|SZ|BJ)$"), c).when(six != "", F.concat(six, suffix))


def attach(rows: DataFrame, other: DataFrame, *columns: str) -> DataFrame:
    return rows.join(other.select(*KEYS, *columns), KEYS, "left")


def _against(incoming: DataFrame, stored: DataFrame, columns: list[str]) -> DataFrame:
    old = stored.select(*KEYS, *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_there"))
    return incoming.join(old, KEYS, "left")


def change_events(incoming: DataFrame, stored: DataFrame, columns: list[str], table: str) -> DataFrame:
    """``(ts_code, trade_date, table_name, column_name, is_insert)`` for each column that differs beyond tolerance."""
    rows = _against(incoming, stored, columns)
    new = F.col("_there").isNull()
    each = F.array_compact(F.array(*[F.when(new | ~values_equal(F.col(c), F.col(f"_{c}")), F.lit(c)) for c in columns]))
    return rows.select(*KEYS, F.lit(table).alias("table_name"), F.explode(each).alias("column_name"), new.alias("is_insert"))


def changed_rows(incoming: DataFrame, stored: DataFrame, columns: list[str]) -> DataFrame:
    """Incoming rows with ``is_changed``."""
    rows = _against(incoming, stored, columns)
    differs = reduce(lambda a, b: a | b, [~values_equal(F.col(c), F.col(f"_{c}")) for c in columns])
    return rows.withColumn("is_changed", F.col("_there").isNull() | differs).select(*incoming.columns, "is_changed")


def upsert(stored: DataFrame, incoming: DataFrame, *keys: str) -> DataFrame:
    """Union by key; incoming rows win."""
    w = Window.partitionBy(*keys).orderBy("_p")
    both = stored.withColumn("_p", F.lit(1)).unionByName(incoming.withColumn("_p", F.lit(0)))
    return both.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_p", "_r")


def summary(events: DataFrame) -> DataFrame:
    """Per table: changed instruments, rows and the columns affected."""
    return events.groupBy("table_name").agg(
        F.countDistinct("ts_code").alias("n_codes"), F.countDistinct(*KEYS).alias("n_rows"), F.array_join(F.sort_array(F.collect_set("column_name")), ",").alias("columns")
    )


def patch_nulls(stored: DataFrame, patch: DataFrame, column: str, insert: bool = False) -> DataFrame:
    """Stored rows with a column filled where it is null; with ``insert`` also the patch's missing keys."""
    new = patch.select(*KEYS, F.col(column).alias("_new"))
    out = stored.join(new, KEYS, "full" if insert else "left")
    return out.withColumn("is_patched", F.col(column).isNull() & F.col("_new").isNotNull()).withColumn(column, F.coalesce(column, "_new")).drop("_new")


def missing_days(codes: DataFrame, rows: DataFrame, cal: DataFrame, start: str, end: str) -> DataFrame:
    """Trading days of a range without a row, per instrument.

    Each row knows the day index of the instrument's next one, and only the days between are expanded; a row before the range
    stands for its beginning, so an instrument without rows misses all days.
    """
    days = cal.where((F.col("is_open") == 1) & F.col("cal_date").between(start, end)).select(F.col("cal_date").alias("trade_date"), F.col("day_idx").cast("int").alias("day_idx"))
    ends = days.agg((F.min("day_idx") - 1).alias("at"), (F.max("day_idx") + 1).alias("stop")).where("at is not null")  # one row
    have = rows.select(*KEYS).join(codes.select("ts_code"), "ts_code", "left_semi").join(F.broadcast(days), "trade_date").select("ts_code", F.col("day_idx").alias("at")).distinct()
    both = codes.select("ts_code").distinct().join(F.broadcast(ends.select("at"))).unionByName(have).join(F.broadcast(ends.select("stop")))
    ahead = F.coalesce(F.lead("at").over(Window.partitionBy("ts_code").orderBy("at")), F.col("stop"))
    gaps = both.withColumn("next", ahead).where("next > at + 1")
    return gaps.select("ts_code", F.explode(F.sequence(F.col("at") + 1, F.col("next") - 1)).alias("day_idx")).join(F.broadcast(days), "day_idx").select("ts_code", "trade_date", "day_idx")


def drop_interior(missing: DataFrame, rows: DataFrame) -> DataFrame:
    """Missing days before the first or after the last stored day; all where nothing is stored."""
    ends = rows.groupBy("ts_code").agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    return missing.join(ends, "ts_code", "left").where("lo is null or trade_date < lo or trade_date > hi").drop("lo", "hi")


def to_ranges(days: DataFrame) -> DataFrame:
    """Days as ranges contiguous on the trading-day index: gaps and islands."""
    island = F.col("day_idx") - F.row_number().over(Window.partitionBy("ts_code").orderBy("day_idx"))
    rows = days.withColumn("_i", island)
    return rows.groupBy("ts_code", "_i").agg(F.min("trade_date").alias("start"), F.max("trade_date").alias("end"), F.count("*").alias("n_days")).drop("_i")


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """Union of overlapping or adjacent index ranges ``(ts_code, a, b)``."""
    w = Window.partitionBy("ts_code").orderBy("a", "b")
    upto = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = ranges.withColumn("_new", (upto.isNull() | (F.col("a") > upto + 1)).cast("int"))
    rows = rows.withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("ts_code", "_g").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("_g")


def uncovered_dates(rows: DataFrame, codes: DataFrame, cal: DataFrame) -> DataFrame:
    """Open days on which not all target instruments have rows."""
    n = codes.agg(F.countDistinct("ts_code").alias("n_all"))
    done = rows.join(codes.select("ts_code"), "ts_code", "left_semi").groupBy("trade_date").agg(F.countDistinct("ts_code").alias("n")).join(F.broadcast(n)).where("n >= n_all")
    return cal.where("is_open = 1").select(F.col("cal_date").alias("trade_date")).join(done, "trade_date", "left_anti")


def calendar_slice(cal: DataFrame, start: str, end: str) -> DataFrame:
    """The open days of a range, if the stored calendar spans it; else none."""
    span = cal.agg(((F.min("cal_date") <= start) & (F.max("cal_date") >= end)).alias("_spans"))
    return cal.join(F.broadcast(span)).where((F.col("is_open") == 1) & F.col("cal_date").between(start, end) & F.col("_spans")).select(F.col("cal_date").alias("trade_date"))


def needing_backfill(flow: DataFrame, daily: DataFrame, basic: DataFrame, start: str, end: str, by: str) -> DataFrame:
    """Days (``by`` trade_date) or instruments (``by`` ts_code) of a range with a missing net amount or market value."""
    inside = F.col("trade_date").between(start, end) & ~F.col("ts_code").endswith(".BJ")
    net = flow.where(inside & F.col("net_amount_dc").isNull()).select(by)
    value = daily.where(inside).select(*KEYS).join(basic.select(*KEYS, "circ_mv"), KEYS, "left").where("circ_mv is null").select(by)
    return net.withColumn("needs", F.lit("net_amount_dc")).unionByName(value.withColumn("needs", F.lit("circ_mv"))).distinct()


def required_ranges(stocks: DataFrame, rows: DataFrame, cal: DataFrame, date: str, bars: int) -> DataFrame:
    """``(ts_code, start, end)`` of the history each instrument needs and does not have whole.

    It ends at the date or the delisting, begins ``bars`` trading days before or at the listing.
    """
    days = cal.where("is_open = 1").select("cal_date", "day_idx")
    end = F.when((F.coalesce("delist_date", F.lit("")) != "") & (F.col("delist_date") < date), F.col("delist_date")).otherwise(date)
    s = stocks.select("ts_code", "list_date", end.alias("end"))
    at = roll_back(s.select("end").distinct(), cal, "end").join(days.withColumnRenamed("cal_date", "trade_date"), "trade_date")  # one row a date
    first = F.greatest(F.col("day_idx") - (bars - 1), F.lit(1).cast("long")).alias("day_idx")
    at = at.select("end", first).join(days.withColumnRenamed("cal_date", "first"), "day_idx").select("end", "first")
    s = s.join(at, "end").select("ts_code", F.greatest("list_date", "first").alias("start"), "end")
    expected = trading_days_between(s.select("start", "end").distinct(), cal).select("start", "end", F.greatest(F.col("n_days"), F.lit(0)).cast("int").alias("expected"))
    s = s.join(expected, ["start", "end"])
    have = rows.select(*KEYS).distinct().join(s.select("ts_code", "start", "end"), "ts_code").where("trade_date between start and end").groupBy("ts_code").agg(F.count("*").alias("actual"))
    s = s.join(have, "ts_code", "left").fillna(0, ["actual"])
    return s.where("not (actual > 0 and actual >= expected)").select("ts_code", "start", "end", "expected", "actual")


def patch_both(stored: DataFrame, patch: DataFrame, date: str, columns: tuple[str, ...]) -> DataFrame:
    """A day's null-only patch of several columns; other days stay."""
    new = patch.where(F.col("trade_date") == date).select(*KEYS, *[F.col(c).alias(f"_{c}") for c in columns])
    out = stored.join(new, KEYS, "left").withColumns({c: F.coalesce(c, f"_{c}") for c in columns})
    return out.drop(*[f"_{c}" for c in columns])
