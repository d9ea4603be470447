"""Latest snapshots, wide analysis views, serving queries and export frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dims import as_date

KEYS = ["ts_code", "trade_date"]
# Display texts of the alignment codes.
ALIGNMENT_TEXT = {
    "bull_strong": "both averages rising", "bull_building": "MA5 rising, MA10 still falling", "bull_weakening": "MA5 falling first", "bull_rolling": "both falling, cross near",
    "bear_strong": "both averages falling", "bear_building": "MA10 inertia after the cross", "bear_weakening": "MA5 trying to rise", "bear_rolling": "both rising, cross near",
    "sideways": "both slopes near zero", "tangle": "crossing to and fro",
}


def latest(snapshots: DataFrame) -> DataFrame:
    """The newest calculation of every (instrument, date)."""
    w = Window.partitionBy(*KEYS).orderBy(F.desc("calc_date"))
    return snapshots.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def text_map(column: str, texts: dict[str, str]):
    """Enum codes as display texts by a map literal; unknown codes are null."""
    return F.create_map(*[F.lit(x) for kv in texts.items() for x in kv])[F.col(column)]


def kpattern_label():
    order = [("yang_ke_yin", ""), ("yang_bao_yin", ""), ("yin_ke_yang", "contrarian_"), ("yin_bao_yang", "contrarian_"), ("mu_bei_xian", ""), ("bi_lei_zhen", ""), ("gao_kai_chang_yin", "")]
    label = F
    for name, prefix in order:
        label = label.when(F.col(name) == 1, prefix + name)
    return label


def volume_signal(turn: str = "macd_turning_point", divergence: str = "vol_divergence"):
    pos, c = F.col("price_position_60d"), F.col
    return (
        F.when((pos > 98) & (c("volume_ratio") > 1.5), "breakout_confirmed")
        .when((pos > 85) & (c("vol_zone") == "explosive") & c("pct_chg").between(-2, 2), "volume_climax")
        .when((pos < 15) & (c("vol_zone") == "low_volume"), "volume_dry_up")
        .when((c(turn) == "golden_cross") & (c(divergence) == "top_divergence"), "golden_cross_weakened")
        .when((c(turn) == "dead_cross") & (c(divergence) == "bottom_divergence"), "dead_cross_weakened")
    )


def wide(quotes: DataFrame, stocks: DataFrame, ma: DataFrame, macd: DataFrame, kp: DataFrame, vol: DataFrame, pos: DataFrame, dde: DataFrame, freq: str = "D") -> DataFrame:
    """One row per bar with instrument data and all indicators: left joins on one key, so one shuffle of each side."""
    named = lambda d, **names: d.withColumnsRenamed(names)
    out = quotes.select(*KEYS, F.col("close_qfq").alias("close"), "pct_chg", "vol", "amount", "total_mv", "pe_ttm", "turnover_rate")
    out = out.join(stocks.select("ts_code", "stock_code", F.col("name").alias("stock_name"), "exchange", "sector", "industry", "is_st"), "ts_code", "left")
    for d in (
        named(kp, strength="kpattern_strength"),
        pos,
        named(macd, zone="macd_zone", turning_point="macd_turning_point", alert="macd_alert", trend="macd_trend", trend_strength="macd_trend_strength"),
        named(ma, turning_point="ma_turning_point"),
        named(vol, zone="vol_zone", trend="vol_trend", trend_strength="vol_trend_strength", divergence="vol_divergence"),
        named(dde, trend="dde_trend", trend_strength="dde_trend_strength", alert="dde_alert"),
    ):
        out = out.join(d, KEYS, "left")
    return out.withColumns({"freq": F.lit(freq), "kpattern": kpattern_label(), "vol_signal": volume_signal(), "ma_alignment": text_map("alignment", ALIGNMENT_TEXT)})


def index_wide(quotes: DataFrame, macd: DataFrame, code: str) -> DataFrame:
    """The index: driven by its macd rows, flow columns null."""
    q = quotes.where(F.col("ts_code") == code).select(*KEYS, F.col("close_qfq").alias("close"), "pct_chg")
    return macd.where(F.col("ts_code") == code).join(q, KEYS, "left").withColumns({"ddx": F.lit(None).cast("double"), "ddx2": F.lit(None).cast("double")})


def freshness(tables: dict[str, DataFrame], column: str = "trade_date") -> DataFrame:
    """Rows and last date of every table."""
    parts = [d.agg(F.count("*").alias("n_rows"), F.max(column).alias("max_date")).select(F.lit(n).alias("table_name"), "n_rows", "max_date") for n, d in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def health(fresh: DataFrame, today: str, days: int = 1) -> DataFrame:
    age = F.datediff(as_date(F.lit(today)), as_date("max_date"))
    return fresh.select("table_name", "max_date", age.alias("age_days"), F.when(age <= days, "fresh").otherwise("stale").alias("status"))


def screening(wide_rows: DataFrame, n: int = 20, *, bars: DataFrame | None = None, **equal: str) -> DataFrame:
    """The top ``n`` by ddx of the latest date, with filters on label columns.

    The date is that of ``bars``, if the bars behind the wide rows are given: then rows are joined for one date only.
    """
    last = (wide_rows if bars is None else bars).agg(F.max("trade_date")).first()[0]
    rows = wide_rows.where(F.col("trade_date") == last)
    for c, v in equal.items():
        rows = rows.where(F.col(c) == v)
    return rows.orderBy(F.desc_nulls_last("ddx"), "ts_code").limit(n)


def history(rows: DataFrame, code: str, start: str, end: str, columns: list[str], allowed: set[str]) -> DataFrame:
    """History of one instrument, of allowed columns only."""
    bad = set(columns) - allowed
    if bad:
        raise ValueError(f"columns not served: {sorted(bad)}")
    return rows.where((F.col("ts_code") == code) & F.col("trade_date").between(start, end)).select(*KEYS, *columns).orderBy("trade_date")


def export_frame(daily: DataFrame, weekly: DataFrame, date: str, week_end: str, skip_st: bool = True) -> DataFrame:
    """Daily rows of a date with the weekly rows of the latest week-end, weekly columns prefixed ``__w__``."""
    d = daily.where(F.col("trade_date") == date)
    if skip_st:
        d = d.where("coalesce(is_st, 0) = 0")
    w = weekly.where(F.col("trade_date") == week_end).drop("trade_date")
    return d.join(w.select("ts_code", *[F.col(c).alias(f"__w__{c}") for c in w.columns if c != "ts_code"]), "ts_code", "left")


def formatted(rows: DataFrame, units: dict[str, float], event_columns: list[str], state_columns: list[str]) -> DataFrame:
    """Numbers in units with two places; null events as ``-``, null states as ``N/A``."""
    out = rows.withColumns({c: F.round(F.col(c) / u, 2) for c, u in units.items()})
    return out.withColumns({c: F.coalesce(c, F.lit("-")) for c in event_columns} | {c: F.coalesce(c, F.lit("N/A")) for c in state_columns})


def export_coverage(rows: DataFrame, stocks: DataFrame, share: float = 0.8) -> DataFrame:
    """Exported rows against the listed instruments."""
    a, b = rows.agg(F.countDistinct("ts_code").alias("n_rows")), stocks.agg(F.sum("is_active").alias("n_listed"))
    return a.join(b).withColumn("enough", F.col("n_rows") >= share * F.col("n_listed"))


def snapshot_sink(rows: DataFrame, path: str, calc_date: str, spec_version: str) -> None:
    """Write rows as the snapshot of one calculation date; writing it again replaces that date only."""
    out = rows.withColumns({"calc_date": F.lit(calc_date), "spec_version": F.lit(spec_version)})
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("calc_date").parquet(path)


def prune(snapshots: DataFrame, keep_runs: int) -> DataFrame:
    """Snapshots of the last runs, and the newest row of every key whatever its run."""
    runs = snapshots.select("calc_date").distinct().orderBy(F.desc("calc_date")).limit(keep_runs)
    w = Window.partitionBy(*KEYS).orderBy(F.desc("calc_date"))
    rows = snapshots.withColumn("_r", F.row_number().over(w)).join(F.broadcast(runs.withColumn("_k", F.lit(1))), "calc_date", "left")
    return rows.where("_r = 1 or _k = 1").drop("_r", "_k")


def latest_analysis(wide_rows: DataFrame, code: str) -> DataFrame:
    """The newest wide row of one instrument."""
    return wide_rows.where(F.col("ts_code") == code).orderBy(F.desc("trade_date")).limit(1)


# Display names of columns and of coded values.
COLUMN_TEXT = {"ts_code": "code", "trade_date": "date", "macd_zone": "MACD zone", "macd_trend": "MACD trend", "vol_zone": "volume zone"}
VALUE_TEXT = {"bull": "above zero", "bear": "below zero", "up": "rising", "down": "falling", "flat": "flat", "explosive": "high volume", "low_volume": "low volume", "normal": "normal volume"}


def translated(rows: DataFrame, coded: list[str]) -> DataFrame:
    """Rows with coded values and column names in words; unknown values stay."""
    return rows.withColumns({c: F.coalesce(text_map(c, VALUE_TEXT), c) for c in coded}).withColumnsRenamed({c: t for c, t in COLUMN_TEXT.items() if c in rows.columns})


def laid_out(rows: DataFrame, basic: list[str], daily: list[str], weekly: list[str], signals_only: bool = False) -> DataFrame:
    """Columns in sheet order: basic, daily, weekly (prefixed); with ``signals_only`` the rows on which a signal stands."""
    names = [*basic, *daily, *(f"__w__{c}" for c in weekly)]
    rows = rows.select(*[c for c in names if c in rows.columns])
    return rows.where("vol_signal is not null") if signals_only else rows


def glossary(spark, texts: dict[str, str]) -> DataFrame:
    """Description of every column and of its weekly form."""
    rows = [(c, t) for c, t in texts.items()] + [(f"__w__{c}", f"{t} (weekly)") for c, t in texts.items() if c not in KEYS]
    return spark.createDataFrame(rows, "column_name string, description string")


def described(rows: DataFrame, texts: dict[str, str]) -> DataFrame:
    """``(column_name, description, n_filled)`` of every described column of ``rows``: the glossary with what the data holds."""
    names = [c for c in rows.columns if c in texts]
    filled = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_filled")) for c in names])
    counts = rows.agg(*[F.count(c).alias(c) for c in names]).select(F.inline(filled))
    return F.broadcast(glossary(rows.sparkSession, texts)).join(counts, "column_name").select("column_name", "description", "n_filled")


def export_audit(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of an export and how many have each of the given labels, as log rows with JSON."""
    counts = F.to_json(F.struct(*[F.count(c).alias(c) for c in columns]))
    return rows.agg(F.count("*").alias("n_rows"), counts.alias("audit"))


def stamped(rows: DataFrame, start: str, calc_date: str, spec_version: str) -> DataFrame:
    """Rows from a write date on, NaN as null, with calculation date, version and a fingerprint of their values."""
    clean = {c: F.when(~F.isnan(c), F.col(c)) for c, t in rows.dtypes if t == "double"}
    values = [c for c in rows.columns if c not in KEYS]
    out = rows.where(F.col("trade_date") >= start).withColumns(clean)
    text = F.concat_ws("|", *[F.coalesce(F.format_string("%.4f", c) if t == "double" else F.col(c).cast("string"), F.lit("")) for c, t in rows.dtypes if c in values])
    return out.withColumns({"input_fingerprint": F.substring(F.sha2(text.cast("binary"), 256), 1, 16), "calc_date": F.lit(calc_date), "spec_version": F.lit(spec_version)})
