"""Layer tables: schemas, scans with pushed-down filters, views over checked DataFrames, record projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(strings: str, doubles: str = "", ints: str = "") -> T.StructType:
    kinds = ((strings, T.StringType()), (doubles, T.DoubleType()), (ints, T.IntegerType()))
    return T.StructType([T.StructField(n, k) for names, k in kinds for n in names.split()])


_FLOW = " ".join(f"{side}_{size}_{what}" for side in ("buy", "sell") for size in ("sm", "md", "lg", "elg") for what in ("vol", "amount"))
#: Columns of the raw layer; dates are sortable yyyyMMdd strings.
SCHEMAS = {
    "ods_stock_basic": _schema("ts_code symbol name area industry exchange list_date delist_date raw_json fetched_at"),
    "ods_daily": _schema("ts_code trade_date", "open high low close vol amount pct_chg adj_factor"),
    "ods_daily_basic": _schema("ts_code trade_date", "total_mv circ_mv pe_ttm turnover_rate volume_ratio"),
    "ods_moneyflow": _schema("ts_code trade_date", f"{_FLOW} net_mf_vol net_mf_amount net_amount_dc"),
    "ods_trade_cal": _schema("cal_date pretrade_date", "", "is_open"),
    "ods_concept_detail": _schema("concept_name ts_code"),
    "dws_calc_state": _schema("ts_code freq indicator last_trade_date history_fp spec_version updated_calc_date", "quote_latest_adj"),
}


def scan(spark: SparkSession, path: str, table: str, start: str | None = None, codes: DataFrame | None = None) -> DataFrame:
    """A layer table from Parquet with its schema; the date floor is pushed down, codes are a semi-join."""
    rows = spark.read.schema(SCHEMAS[table]).parquet(path)
    if start:
        rows = rows.where(F.col("trade_date") >= start)
    return rows.join(codes.select("ts_code"), "ts_code", "left_semi") if codes is not None else rows


def conform(rows: DataFrame, table: str) -> DataFrame:
    """Rows projected to a table's columns and types; missing columns are null."""
    have = set(rows.columns)
    return rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[table]])


def create_views(tables: dict[str, DataFrame]) -> None:
    """Temporary views of all tables, each with its schema where it has one."""
    for name, rows in tables.items():
        (conform(rows, name) if name in SCHEMAS else rows).createOrReplaceTempView(name)


def reference_rows(rows: DataFrame) -> DataFrame:
    """Instrument rows with their whole content as JSON text, for keyed upserts."""
    return rows.withColumn("raw_json", F.to_json(F.struct(*rows.columns)))
