"""The registered queries: adapter, operator, rounded result; and the SQL of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators import bars as B
from barloom.operators import dims as D
from barloom.operators import indicators as M
from barloom.sources import market as S
from barloom.sources.store import layer, size_shuffles

from . import panel_sql as P
from .base_sql import CTES, sql

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
DATE = "19990615"


def query(name: str, text: str | None = None):
    """Register ``fn(m)``, m giving the tables of one run, under a name with its SQL."""

    def keep(fn):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(Tables(spark, sf_dir)))
        if text:
            ORACLE[name] = text
        return fn

    return keep


def rounded(df: DataFrame) -> DataFrame:
    """Floating results to six places, as both engines sum in orders of their own."""
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r6(columns: str, *floats: str) -> str:
    return ", ".join([columns, *(f"round({c}, 6) AS {c}" for c in floats)])


#: Layers that are written once a session and read from then on: the raw one and the bars.
LAYERS = ("cal", "raw", "adjusted", "quotes", "weekly")


class Tables:
    """The layer tables of one run, built lazily from the given data."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str):
        build = {
            "cal": lambda: S.trade_cal(self.spark, self.sf_dir),
            "trades": lambda: S.trades(self.spark, self.sf_dir, self.cal),
            "raw": lambda: S.ods(self.trades),
            "daily": lambda: self.raw.select(*S.DAILY),
            "basic": lambda: self.raw.select(*S.BASIC),
            "flow": lambda: S.ods_moneyflow(self.raw),
            "stock_basic": lambda: S.ods_stock_basic(self.spark, self.sf_dir),
            "concepts": lambda: S.ods_concept_detail(self.spark, self.sf_dir),
            "dim_stock": lambda: D.dim_stock(self.stock_basic),
            "dim_date": lambda: D.dim_date(self.cal),
            "adjusted": lambda: B.adjusted_bars(self.daily, self.basic),
            "quotes": lambda: B.fill_suspensions(self.adjusted, self.daily, self.cal),
            "weekly": lambda: B.weekly_bars(self.quotes),
            "moneyflow": lambda: B.daily_moneyflow(self.flow),
            "panel": lambda: M.daily_panel(self.quotes),
            "panel_w": lambda: M.weekly_panel(self.weekly, self.dim_date),
        }.get(name)
        if build is None:
            raise AttributeError(name)
        if name in (*LAYERS, "trades"):
            size_shuffles(self.spark, self.sf_dir, lambda: S.read(self.spark, self.sf_dir, "lineitem"))
        value = layer(self.spark, self.sf_dir, name, build, None if name == "cal" else "ts_code") if name in LAYERS else build()
        setattr(self, name, value)
        return value


_Q = r6("ts_code, trade_date", "open_qfq", "high_qfq", "low_qfq", "close_qfq", "vol", "amount", "pct_chg", "total_mv", "circ_mv", "pe_ttm", "turnover_rate", "volume_ratio") + ", is_suspended"
_W = r6("ts_code, trade_date", "open_qfq", "high_qfq", "low_qfq", "close_qfq", "vol", "amount", "pct_chg", "total_mv", "pe_ttm", "turnover_rate", "volume_ratio") + ", active_days"

query("d1_dim_stock", sql("SELECT * FROM dim_stock", "dim_stock"))(lambda m: m.dim_stock)
query("d2_dim_date", sql("SELECT * FROM dim_date", "dim_date"))(lambda m: m.dim_date)
query("d3_dim_concept", sql("SELECT concept_name, row_number() OVER (ORDER BY concept_name)::INT AS concept_id FROM (SELECT DISTINCT concept_name FROM ods_concept_detail)", "ods_concept_detail"))(
    lambda m: D.dim_concept(m.concepts)
)
query("d4_concept_stock", sql("SELECT dense_rank() OVER (ORDER BY concept_name)::INT AS concept_id, ts_code FROM ods_concept_detail", "ods_concept_detail"))(
    lambda m: D.concept_stock(m.concepts, D.dim_concept(m.concepts))
)
query("d5_roll_back", sql("SELECT cal_date AS date, max(CASE WHEN is_open = 1 THEN cal_date END) OVER (ORDER BY cal_date) AS trade_date FROM ods_trade_cal", "ods_trade_cal"))(
    lambda m: D.roll_back(m.cal.select(F.col("cal_date").alias("date")), m.cal)
)
query("d6_week_end", sql("SELECT cal_date AS date, max(CASE WHEN is_week_end = 1 THEN trade_date END) OVER (ORDER BY cal_date) AS week_end FROM ods_trade_cal LEFT JOIN dim_date ON trade_date = cal_date", "dim_date"))(
    lambda m: D.week_end_before(m.cal.select(F.col("cal_date").alias("date")), m.dim_date)
)
query("d7_trading_days", sql("SELECT a.ts_code, a.lo AS start, a.hi AS \"end\", count(*) AS n_days FROM (SELECT ts_code, min(trade_date) AS lo, max(trade_date) AS hi FROM ods_daily GROUP BY ALL) a JOIN ods_trade_cal c ON is_open = 1 AND cal_date BETWEEN lo AND hi GROUP BY ALL", "ods_daily"))(
    lambda m: D.trading_days_between(m.daily.groupBy("ts_code").agg(F.min("trade_date").alias("start"), F.max("trade_date").alias("end")), m.cal)
)
query("b1_adjusted_bars", sql(f"SELECT {_Q} FROM adjusted", "adjusted"))(lambda m: m.adjusted)
query("b2_excluded_rows", sql("SELECT count(*) FILTER (adj_factor IS NULL OR latest = 0) AS n_excluded FROM (SELECT *, arg_max(coalesce(adj_factor, 0), trade_date) OVER (PARTITION BY ts_code) AS latest FROM ods_daily)", "ods_daily"))(
    lambda m: B.excluded_rows(m.daily)
)
query("b3_gap_stocks", sql("SELECT ts_code, count(*) AS n_rows, max(day_idx) - min(day_idx) + 1 AS n_days FROM adjusted JOIN ods_trade_cal ON cal_date = trade_date GROUP BY ts_code HAVING count(*) < max(day_idx) - min(day_idx) + 1", "adjusted"))(
    lambda m: B.gap_stocks(m.adjusted, m.cal)
)
query("b4_suspension_fill", sql(f"SELECT {_Q} FROM dwd_daily_quote", "dwd_daily_quote"))(lambda m: m.quotes)
query("b5_weekly_bars", sql(f"SELECT {_W} FROM dwd_weekly_quote", "dwd_weekly_quote"))(lambda m: m.weekly)
query("b6_moneyflow", sql("SELECT * REPLACE (round(net_amount_dc, 6) AS net_amount_dc) FROM dwd_daily_moneyflow", "dwd_daily_moneyflow"))(lambda m: m.moneyflow)

_STORED = f"SELECT * REPLACE (CASE WHEN hash_day % 11 = 0 THEN close_qfq + 0.01::DOUBLE ELSE close_qfq END AS close_qfq) FROM (SELECT *, right(trade_date, 2)::INT AS hash_day FROM adjusted WHERE trade_date < '{DATE}' AND ts_code <> 'B05.XX')"


def stored(m: Tables, date: str = DATE) -> DataFrame:
    """Earlier bars as they might be stored: up to a date, one instrument missing, some closes stale."""
    day = F.substring("trade_date", 7, 2).cast("int")
    return m.adjusted.where((F.col("trade_date") < date) & (F.col("ts_code") != "B05.XX")).withColumn("close_qfq", F.when(day % 11 == 0, F.col("close_qfq") + 0.01).otherwise(F.col("close_qfq")))


#: The bars of all rows up to the first day from DATE on, as a full rebuild of that day gives them.
_TO = f"(SELECT min(trade_date) FROM ods_daily WHERE trade_date >= '{DATE}')"
UPTO = {
    "daily13": f"SELECT * FROM ods_daily WHERE trade_date <= {_TO}", "adjusted13": CTES["adjusted"].replace("FROM ods_daily)", "FROM daily13)"),
    "quote13": CTES["dwd_daily_quote"].replace("FROM ods_daily ", "FROM daily13 ").replace("adjusted", "adjusted13"),
}


def stored_before(m: Tables) -> DataFrame:
    """Bars as they were stored before DATE, when no later row was known: some instruments with stale closes, one not yet there."""
    daily = m.daily.where((F.col("trade_date") < DATE) & (F.col("ts_code") != "B05.XX"))
    bars = B.fill_suspensions(B.adjusted_bars(daily, m.basic), daily, m.cal)
    stale = F.col("ts_code").startswith("B1") & (F.substring("trade_date", 7, 2).cast("int") % 11 == 0) & (F.col("is_suspended") == 0)
    return bars.withColumn("close_qfq", F.when(stale, F.col("close_qfq") + 0.01).otherwise(F.col("close_qfq")))


_LATEST = "SELECT *, arg_max(coalesce(adj_factor, 0), trade_date) OVER (PARTITION BY ts_code) AS latest FROM ods_daily"
query("b7_factor_changed", sql("SELECT ts_code, trade_date FROM (SELECT *, lag(adj_factor) OVER (PARTITION BY ts_code ORDER BY trade_date) AS before FROM ods_daily) WHERE before IS NOT NULL AND adj_factor IS DISTINCT FROM before AND trade_date = (SELECT min(trade_date) FROM ods_daily WHERE trade_date >= '19990101')", "ods_daily"))(
    lambda m: (lambda d: B.factor_changed(m.daily, d).withColumn("trade_date", F.lit(d)))(m.daily.where("trade_date >= '19990101'").agg(F.min("trade_date")).first()[0])
)
query("b8_drifted", sql("SELECT DISTINCT ts_code FROM stored JOIN latest l USING (ts_code, trade_date) WHERE abs(close_qfq - l.close * l.adj_factor / latest) > 1e-6", "adjusted", stored=_STORED, latest=_LATEST))(
    lambda m: B.drifted(stored(m), m.daily)
)
query("b10_new_listings", sql(f"SELECT ts_code FROM ods_daily d WHERE trade_date = (SELECT max(trade_date) FROM ods_daily WHERE trade_date < '{DATE}') AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.ts_code = d.ts_code AND s.trade_date < d.trade_date)", "adjusted", stored=_STORED))(
    lambda m: B.new_listings(m.daily, stored(m), m.daily.where(F.col("trade_date") < DATE).agg(F.max("trade_date")).first()[0])
)
query("b11_behind", sql(f"SELECT d.ts_code, s.last FROM ods_daily d JOIN (SELECT ts_code, max(trade_date) AS last FROM stored GROUP BY ALL) s USING (ts_code) WHERE trade_date = (SELECT min(trade_date) FROM ods_daily WHERE trade_date >= '{DATE}') AND s.last < trade_date", "adjusted", stored=_STORED))(
    lambda m: B.behind(m.daily, stored(m), m.daily.where(F.col("trade_date") >= DATE).agg(F.min("trade_date")).first()[0])
)
query("b12_refresh_prices", sql(f"SELECT {r6('ts_code, trade_date', 'open_qfq', 'high_qfq', 'low_qfq', 'close_qfq')} FROM (SELECT ts_code, trade_date, coalesce(l.open * l.adj_factor / latest, s.open_qfq) AS open_qfq, coalesce(l.high * l.adj_factor / latest, s.high_qfq) AS high_qfq, coalesce(l.low * l.adj_factor / latest, s.low_qfq) AS low_qfq, coalesce(l.close * l.adj_factor / latest, s.close_qfq) AS close_qfq FROM stored s LEFT JOIN latest l USING (ts_code, trade_date))", "adjusted", stored=_STORED, latest=_LATEST))(
    lambda m: B.refresh_prices(stored(m), m.daily).select("ts_code", "trade_date", "open_qfq", "high_qfq", "low_qfq", "close_qfq")
)
query("b13_incremental", sql(f"SELECT {_Q}, CASE WHEN ts_code IN (SELECT ts_code FROM drift13) OR ts_code = 'B05.XX' THEN 'full' WHEN trade_date <= last THEN 'kept' ELSE 'tail' END AS route FROM quote13 LEFT JOIN (SELECT ts_code, max(trade_date) AS last FROM ods_daily WHERE trade_date < '{DATE}' GROUP BY ALL) USING (ts_code)", "dwd_daily_quote", **UPTO, **{
    "drift13": f"SELECT ts_code FROM adjusted13 WHERE ts_code LIKE 'B1%' AND ts_code <> 'B05.XX' AND trade_date < '{DATE}' AND right(trade_date, 2)::INT % 11 = 0 GROUP BY ALL"}))(
    lambda m: (lambda d: B.rebuild_incremental(stored_before(m), m.daily, m.basic, m.cal, d))(m.daily.where(F.col("trade_date") >= DATE).agg(F.min("trade_date")).first()[0])
)
query("b15_rebuild_week", sql(f"SELECT {_W} FROM dwd_weekly_quote WHERE date_trunc('week', strptime(trade_date, '%Y%m%d')) = date_trunc('week', strptime('{DATE}', '%Y%m%d'))", "dwd_weekly_quote"))(
    lambda m: B.weekly_bars(m.quotes.where(F.date_trunc("week", D.as_date("trade_date")) == F.date_trunc("week", D.as_date(F.lit(DATE)))))
)
query("b16_sync_meta", sql("SELECT ts_code, trade_date, CASE WHEN b.circ_mv IS DISTINCT FROM s.circ_mv THEN 1 ELSE 0 END AS n_changed, round(b.circ_mv, 6) AS circ_mv FROM (SELECT * REPLACE (CASE WHEN hash_day % 5 = 0 THEN NULL ELSE circ_mv END AS circ_mv) FROM stored) s JOIN ods_daily_basic b USING (ts_code, trade_date)", "adjusted", stored=_STORED))(
    lambda m: B.sync_meta(stored(m).withColumn("circ_mv", F.when(F.substring("trade_date", 7, 2).cast("int") % 5 != 0, F.col("circ_mv"))), m.basic, ["circ_mv"]).select("ts_code", "trade_date", "n_changed", "circ_mv")
)
query("b17_orphan_weeks", sql("SELECT w.ts_code, w.trade_date FROM dwd_weekly_quote w ANTI JOIN (SELECT trade_date FROM dim_date WHERE is_week_end = 1) d USING (trade_date)", "dwd_weekly_quote"))(
    lambda m: B.orphan_weeks(m.weekly.select("ts_code", "trade_date"), m.dim_date).select("ts_code", "trade_date")
)
query("b18_resample", sql("SELECT ts_code, strftime(date_trunc('week', strptime(trade_date, '%Y%m%d')) + INTERVAL 6 DAY, '%Y%m%d') AS week, round(arg_max(close_qfq, trade_date), 6) AS close, max(trade_date) AS last_date FROM dwd_daily_quote WHERE is_suspended = 0 GROUP BY ALL", "dwd_daily_quote"))(
    lambda m: B.resample_weekly(m.quotes)
)
query("b19_weekly_flow", sql("""SELECT e.ts_code, e.trade_date AS week_end, e.prev, sum(f.net_mf_vol) AS net_mf_vol, round(sum(f.net_mf_amount), 6) AS net_mf_amount, sum(coalesce(f.buy_lg_vol, 0)) AS buy_lg_vol, sum(coalesce(f.sell_lg_vol, 0)) AS sell_lg_vol,
        sum(coalesce(f.buy_elg_vol, 0)) AS buy_elg_vol, sum(coalesce(f.sell_elg_vol, 0)) AS sell_elg_vol, sum(f.total_vol) AS total_vol, count(DISTINCT f.trade_date) AS active_days,
        (SELECT count(*) FROM dim_date d WHERE d.trade_date > e.prev AND d.trade_date <= e.trade_date) AS expected_days, round(any_value(b.circ_mv), 6) AS circ_mv, round(any_value(b.total_mv), 6) AS total_mv,
        CASE WHEN count(DISTINCT f.trade_date) < 0.6 * (SELECT count(*) FROM dim_date d WHERE d.trade_date > e.prev AND d.trade_date <= e.trade_date) THEN 1 ELSE 0 END AS is_skipped
        FROM ends e JOIN dwd_daily_moneyflow f ON f.ts_code = e.ts_code AND f.trade_date > e.prev AND f.trade_date <= e.trade_date LEFT JOIN ods_daily_basic b ON b.ts_code = e.ts_code AND b.trade_date = e.trade_date GROUP BY e.ts_code, e.trade_date, e.prev""",
        "dwd_daily_moneyflow", ends="SELECT ts_code, trade_date, coalesce(lag(trade_date) OVER (PARTITION BY ts_code ORDER BY trade_date), strftime(strptime(trade_date, '%Y%m%d') - INTERVAL 7 DAY, '%Y%m%d')) AS prev FROM dwd_weekly_quote JOIN dim_date USING (trade_date) WHERE is_week_end = 1"))(
    lambda m: B.weekly_moneyflow(m.moneyflow, m.weekly, m.dim_date, m.basic)
)


def _panel(name: str, text: str, parts: dict, columns: str, op) -> None:
    query(f"{name}_daily", sql(f"SELECT {columns} FROM {text}", "dwd_daily_moneyflow", panel=P.DAILY, **parts))(lambda m: op(m, m.panel))


_panel("ind_ma", "ma", P.MA, r6("ts_code, trade_date, alignment, turning_point", "ma_5", "ma_10", "bias_ma5", "bias_ma10", "ma5_slope", "ma10_slope"), lambda m, p: M.moving_averages(p))
_panel("ind_macd", "macd", P.MACD, r6("ts_code, trade_date, zone, alert, trend, turning_point", "ema_12", "ema_26", "dif", "dea", "macd_bar", "trend_strength"), lambda m, p: M.macd(p))
_panel("ind_position", "position", P.POSITION, r6("ts_code, trade_date", "price_position_60d", "price_position_120d", "price_position_250d"), lambda m, p: M.price_position(p))
_panel("ind_kpattern", "kp", P.KPATTERN, "* REPLACE (round(strength, 6) AS strength)", lambda m, p: M.candlesticks(p, m.dim_stock))
_panel("ind_volume", "volume", P.VOLUME, r6("ts_code, trade_date, trend, zone, divergence", "ma_vol_5", "volume_ratio", "pct_vol_rank", "trend_strength"), lambda m, p: M.volume(p))
_panel("ind_dde", "dde", P.DDE, r6("ts_code, trade_date, trend, alert", "ddx", "ddx2", "trend_strength"), lambda m, p: M.dde(m.moneyflow, p))
for _n, _parts, _cols, _op in (
    ("ma", P.MA, r6("ts_code, trade_date, alignment, turning_point", "ma_5", "ma_10", "bias_ma5", "bias_ma10", "ma5_slope", "ma10_slope"), lambda p: M.moving_averages(p)),
    ("position", P.POSITION, r6("ts_code, trade_date", "price_position_60d", "price_position_120d", "price_position_250d"), lambda p: M.price_position(p)),
    ("macd", P.MACD, r6("ts_code, trade_date, zone, alert", "ema_12", "ema_26", "dif", "dea", "macd_bar", "trend_strength"), lambda p: M.macd(p).drop("trend", "turning_point")),
):
    query(f"ind_{_n}_weekly", sql(f"SELECT {_cols} FROM {_n}", "dwd_daily_moneyflow", panel=P.WEEKLY, **_parts))(lambda m, _op=_op: _op(m.panel_w))
