"""Dimensions: instruments, trading calendar, concepts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_date(c: str | Column) -> Column:
    return F.to_date(c, "yyyyMMdd")


def dim_stock(basic: DataFrame) -> DataFrame:
    """Exchange and sector names, listing state and special treatment of every instrument."""
    two = F.substring("symbol", 1, 2)
    return basic.select(
        "ts_code", F.substring("ts_code", 1, 3).alias("stock_code"), "symbol", "name",
        F.when(F.col("exchange") == "SSE", "SH").when(F.col("exchange") == "SZSE", "SZ").otherwise("BJ").alias("exchange"),
        F.when(two.isin("60", "00"), "main").when(two == "30", "growth").when(two == "68", "star").otherwise("beijing").alias("sector"),
        "industry", "list_date", "delist_date",
        (F.coalesce("delist_date", F.lit("")) == "").cast("int").alias("is_active"), F.col("name").contains("ST").cast("int").alias("is_st"),
    )


def dim_date(cal: DataFrame) -> DataFrame:
    """Open days with flags for the last trading day of week, month and year; a table of one row a day."""
    d = as_date("cal_date")
    last = lambda key: (F.col("cal_date") == F.max("cal_date").over(Window.partitionBy(key))).cast("int")
    return cal.where("is_open = 1").select(
        F.col("cal_date").alias("trade_date"), F.lit(1).alias("is_trade_day"), last(F.date_trunc("week", d)).alias("is_week_end"),
        last(F.substring("cal_date", 1, 6)).alias("is_month_end"), last(F.substring("cal_date", 1, 4)).alias("is_year_end"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.floor((F.dayofyear(d) - 1 + 7 - F.weekday(d)) / 7).cast("int").alias("week_of_year"), "day_idx",
    )


def dim_concept(detail: DataFrame) -> DataFrame:
    """Concepts numbered by name; so many rows as there are concepts."""
    return detail.select("concept_name").distinct().withColumn("concept_id", F.row_number().over(Window.orderBy("concept_name")))


def concept_stock(detail: DataFrame, concepts: DataFrame) -> DataFrame:
    return detail.join(concepts, "concept_name").select("concept_id", "ts_code")


def roll_back(dates: DataFrame, cal: DataFrame, column: str = "date") -> DataFrame:
    """Each date with the nearest trading day at or before it: an as-of join by one sorted pass over both."""
    both = dates.select(F.col(column).alias("d"), F.lit(1).alias("asked"), F.lit(None).cast("string").alias("t")).unionByName(
        cal.where("is_open = 1").select(F.col("cal_date").alias("d"), F.lit(0).alias("asked"), F.col("cal_date").alias("t"))
    )
    w = Window.partitionBy(F.lit(0)).orderBy("d", "asked").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("trade_date", F.last("t", ignorenulls=True).over(w)).where("asked = 1").select(F.col("d").alias(column), "trade_date")


def week_end_before(dates: DataFrame, dim: DataFrame, column: str = "date") -> DataFrame:
    """Each date with the latest week-end trading day at or before it."""
    ends = dim.where("is_week_end = 1").select(F.col("trade_date").alias("cal_date"), F.lit(1).alias("is_open"))
    return roll_back(dates, ends, column).withColumnRenamed("trade_date", "week_end")


def range_report(rows: DataFrame, cal: DataFrame, start: str, end: str) -> DataFrame:
    """Per trading day of a range the rows there are, and whether there are any: one job for the range."""
    days = cal.where((F.col("is_open") == 1) & F.col("cal_date").between(start, end)).select(F.col("cal_date").alias("trade_date"))
    n = rows.where(F.col("trade_date").between(start, end)).groupBy("trade_date").agg(F.count("*").alias("n_rows"))
    return days.join(n, "trade_date", "left").fillna(0, ["n_rows"]).withColumn("status", F.when(F.col("n_rows") > 0, "ok").otherwise("failed"))


def trading_days_between(spans: DataFrame, cal: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Number of open days in each closed span, from the day index at its ends."""
    ends = roll_back(spans.select(F.col(end).alias("date")).unionByName(spans.select(F.date_format(F.date_sub(as_date(start), 1), "yyyyMMdd").alias("date"))).distinct(), cal)
    idx = ends.join(cal.select(F.col("cal_date").alias("trade_date"), "day_idx"), "trade_date", "left").select("date", F.coalesce("day_idx", F.lit(0)).alias("i"))
    a = idx.select(F.col("date").alias("_a"), F.col("i").alias("_ia"))
    b = idx.select(F.col("date").alias("_b"), F.col("i").alias("_ib"))
    before = F.date_format(F.date_sub(as_date(start), 1), "yyyyMMdd")
    return spans.join(b, F.col(end) == F.col("_b")).join(a, before == F.col("_a")).select(*spans.columns, (F.col("_ib") - F.col("_ia")).alias("n_days"))
