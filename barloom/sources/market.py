"""Market tables (ODS layer) derived from the order tables, so that every operator runs on given data.

An instrument is a part brand at a hundred suppliers, so instruments grow with the
data, plus one pseudo-instrument ``INDEX.XX`` over all rows; a trading day is a weekday on which something shipped; prices are the line
items' unit prices with a slow triangle trend.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import dealt

SIZES = {"sm": (0, 10), "md": (10, 25), "lg": (25, 40), "elg": (40, 1e9)}
INDEX = "INDEX.XX"
#: List dates, most of them before all rows.
LISTED = ("19950101", "19950101", "19950101", "19980601", "20010301")
#: Moves amounts off the middle between two rounded ones, where sums in another order would round elsewhere.
TICK = 2.3e-8


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _code(supplier: str):
    """``B07.XX`` for the first hundred suppliers, ``B07-3.XX`` for a later hundred."""
    group = F.expr(f"{supplier} div 100")
    return F.concat(F.lit("B"), F.lpad(F.substring_index("p_brand", "#", -1), 2, "0"), F.when(group > 0, F.concat(F.lit("-"), group.cast("string"))).otherwise(""), F.lit(".XX"))


def trade_cal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(cal_date, is_open, pretrade_date, day_idx)``: one row per shipping date, open on weekdays."""
    day = read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct()
    w = Window.orderBy("cal_date")  # a calendar: one row per date, whatever the size of the data
    cal = day.select(F.date_format("d", "yyyyMMdd").alias("cal_date"), (F.weekday("d") < 5).cast("int").alias("is_open"))
    opened = cal.where("is_open = 1").select("cal_date", F.row_number().over(w).alias("day_idx"), F.lag("cal_date").over(w).alias("pretrade_date"))
    return cal.join(opened, "cal_date", "left").select("cal_date", "is_open", "pretrade_date", "day_idx")


def trades(spark: SparkSession, sf_dir: str, cal: DataFrame) -> DataFrame:
    """Line items on trading days with instrument code, date, unit price and day index."""
    cal = F.broadcast(cal.where("is_open = 1").select(F.col("cal_date").alias("trade_date"), "day_idx"))
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    rows = read(spark, sf_dir, "lineitem").withColumn("trade_date", F.date_format("l_shipdate", "yyyyMMdd"))
    cents = F.round(F.col("l_extendedprice") * 100).cast("long") % 200
    px = F.lit(20.0) + cents / F.lit(100.0) + F.abs(F.col("day_idx") % 120 - 60) / F.lit(20.0)
    return rows.join(cal, "trade_date").join(part, "l_partkey").select(
        _code("l_suppkey").alias("ts_code"), "trade_date", "day_idx", px.alias("px"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_linestatus",
    )


#: Columns of daily bars, of valuations and of money flow, as :func:`ods` gives them in one table.
DAILY = ("ts_code", "trade_date", "open", "high", "low", "close", "vol", "amount", "pct_chg", "adj_factor", "day_idx")
BASIC = ("ts_code", "trade_date", "total_mv", "circ_mv", "pe_ttm", "turnover_rate", "volume_ratio")
FLOW = ("ts_code", "trade_date", *[f"{side}_{size}_{what}" for side in ("buy", "sell") for size in SIZES for what in ("vol", "amount")], "net_mf_vol", "net_mf_amount", "net_amount_dc")


def _bars(rows: DataFrame) -> DataFrame:
    """Bars and money flow of the trades, a row an instrument and day.

    The trades are dealt by instrument as they are: partial sums of the rows a task happens to read are as many and wider.
    """
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "px")
    return dealt(rows).groupBy("ts_code", "trade_date").agg(
        F.min(order).alias("first"), F.max(order).alias("last"), F.max("px").alias("high"), F.min("px").alias("low"),
        F.sum("l_quantity").alias("vol"), F.sum("l_extendedprice").alias("amount"), F.first("day_idx").alias("day_idx"), *_flow_sums(),
    )


def ods(rows: DataFrame) -> DataFrame:
    """The raw layer of the trades in one table: daily bars with adjustment factors, valuations and money flow.

    The index comes from the instruments' bars, summed to one row a day before anything else; it has no money flow. Some market values are missing by date.
    """
    bars = _bars(rows)
    index = bars.groupBy("trade_date").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"), F.min("low").alias("low"), F.sum("vol").alias("vol"), F.sum("amount").alias("amount"), F.first("day_idx").alias("day_idx")
    )
    both = bars.unionByName(dealt(index.withColumn("ts_code", F.lit(INDEX))), allowMissingColumns=True)
    w = Window.partitionBy("ts_code").orderBy("trade_date")
    both = both.withColumns({"open": F.col("first.px"), "close": F.col("last.px"), "amount": F.round("amount", 2), "total_mv": F.sum("vol").over(w.rowsBetween(Window.unboundedPreceding, 0)) * 10})
    pct = F.round((F.col("close") / F.lag("close").over(w) - 1) * 100, 6)
    factor = F.lit(1.0) + F.lit(0.05) * (F.substring("trade_date", 1, 4).cast("int") - 1995)
    both = both.withColumns({
        "pct_chg": F.coalesce(pct, F.lit(0.0)), "adj_factor": F.when(F.col("day_idx") % 97 != 0, factor), "circ_mv": F.when(F.col("day_idx") % 7 != 0, F.col("total_mv") * 0.6), "pe_ttm": F.lit(10.0) + F.col("day_idx") % 30,
        "turnover_rate": F.col("vol") / 100, "volume_ratio": F.lit(1.0), "net_amount_dc": F.when(F.col("trade_date") >= "19970101", F.col("net_mf_amount") * 0.9),
    })
    return both.select(*DAILY, *BASIC[2:], *FLOW[2:])


def ods_daily(rows: DataFrame) -> DataFrame:
    """Raw daily bars of the trades with adjustment factors, and those of the index."""
    return ods(rows).select(*DAILY)


def ods_moneyflow(raw: DataFrame) -> DataFrame:
    """The money flow of the raw layer; the index has none."""
    return raw.where(F.col("ts_code") != INDEX).select(*FLOW)


def _flow_sums() -> list:
    """Money flow of the trades by side and trade size.

    Half of a trade counts by its size, half as a large one. The share that buys follows a slow triangle of the
    days and is zero on a few, on which flow by volume is unknown; it is a multiple of 1/32, so sums are exact in any order.
    """
    q, ext, sums = F.col("l_quantity"), F.col("l_extendedprice"), []
    buys = F.when(F.col("day_idx") % 211 != 0, (F.abs(F.col("day_idx") % 48 - 24) / 2 + 2) / 16).otherwise(0.0)
    for side, share in (("buy", buys), ("sell", 1 - buys)):
        for size, (lo, hi) in SIZES.items():
            part = share * (F.when((q > lo) & (q <= hi), 0.5).otherwise(0.0) + (0.5 if size == "lg" else 0.0))
            sums += [F.sum(q * part).alias(f"{side}_{size}_vol"), F.round(F.sum(ext * part) + TICK, 8).alias(f"{side}_{size}_amount")]
    net = buys * 2 - 1
    return sums + [F.sum(q * net).alias("net_mf_vol"), F.round(F.sum(ext * net) + TICK, 8).alias("net_mf_amount")]


def ods_stock_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instruments: listed on LISTED's dates in turn, one delisted, some under special treatment, codes spread over the exchanges' prefixes."""
    part = _brands(spark, sf_dir)
    n = F.substring_index("p_brand", "#", -1).cast("int")
    symbol = F.concat(F.element_at(F.array(*map(F.lit, ("60", "00", "30", "68", "83"))), n % 5 + 1), F.lpad(((n + F.expr("supplier div 100") * 100) % 10000).cast("string"), 4, "0"))
    return part.select(
        _code("supplier").alias("ts_code"), symbol.alias("symbol"),
        F.when(n % 11 == 0, F.concat(F.lit("ST "), "p_brand")).otherwise(F.col("p_brand")).alias("name"), F.lit("area").alias("area"), "industry",
        F.element_at(F.array(*map(F.lit, ("SSE", "SZSE", "BSE"))), n % 3 + 1).alias("exchange"), F.element_at(F.array(*map(F.lit, LISTED)), n % len(LISTED) + 1).alias("list_date"),
        F.when(n == 13, "20000101").alias("delist_date"),
    )


def ods_concept_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept membership: part types by brand."""
    part = read(spark, sf_dir, "part").select("p_type", "p_brand").distinct()
    return part.join(_brands(spark, sf_dir), "p_brand").select(F.col("p_type").alias("concept_name"), _code("supplier").alias("ts_code"))


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(p_brand, industry, supplier)``: each brand with the first supplier of every hundred; the brands are a short list."""
    brand = read(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_type").alias("industry"))
    hundred = read(spark, sf_dir, "supplier").select((F.expr("s_suppkey div 100") * 100).alias("supplier")).distinct()
    brand = brand.agg(F.collect_list(F.struct("p_brand", "industry")).alias("b"))
    return hundred.join(F.broadcast(brand)).select("supplier", F.inline("b"))
