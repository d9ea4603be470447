"""Data-quality rules, completeness and audits; each rule is a count, all rules one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rule_counts(rules: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(rule, n_bad)``: rules over the same table are counted in one pass of it."""
    by_table: dict[int, tuple[DataFrame, list]] = {}
    for name, (table, cond) in rules.items():
        by_table.setdefault(id(table), (table, []))[1].append((name, cond))
    parts = []
    for table, conds in by_table.values():
        one = table.agg(*[F.count_if(F.coalesce(F.expr(c), F.lit(False))).alias(n) for n, c in conds])
        parts.append(one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_bad")) for n, _ in conds])).alias("x")).select("x.*"))
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(table: DataFrame, *keys: str) -> DataFrame:
    return table.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(rows: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Number of rows without a parent."""
    return rows.join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti").agg(F.count("*").alias("n_orphans"))


def week_ends_per_week(dim: DataFrame) -> DataFrame:
    """Weeks that do not have exactly one week-end."""
    return dim.groupBy("year", "week_of_year").agg(F.sum("is_week_end").alias("n")).where("n <> 1")


def stale_codes(stocks: DataFrame, rows: DataFrame, date: str) -> DataFrame:
    """Listed instruments whose last row is before a date or missing."""
    last = rows.groupBy("ts_code").agg(F.max("trade_date").alias("last"))
    return stocks.where("is_active = 1").select("ts_code").join(last, "ts_code", "left").where(F.coalesce(F.col("last"), F.lit("")) < date)


def completeness(rows: DataFrame, weekly: DataFrame, need_daily: int, need_weekly: int) -> DataFrame:
    """Per instrument whether its daily and weekly history suffice."""
    d = rows.groupBy("ts_code").agg(F.count("*").alias("n_daily"))
    w = weekly.groupBy("ts_code").agg(F.count("*").alias("n_weekly"))
    out = d.join(w, "ts_code", "full").fillna(0, ["n_daily", "n_weekly"])
    ok_d, ok_w = F.col("n_daily") >= need_daily, F.col("n_weekly") >= need_weekly
    return out.withColumn("status", F.when(ok_d & ok_w, "ok").when(ok_d, "missing_weekly").when(ok_w, "missing_daily").otherwise("missing_both"))


def row_gate(panel: DataFrame, least: dict[str, int]) -> DataFrame:
    """``(ts_code, indicator, n_rows, reason)`` of instruments too short for an indicator."""
    n = panel.groupBy("ts_code").agg(F.count("*").alias("n_rows"))
    need = F.array(*[F.struct(F.lit(k).alias("indicator"), F.lit(v).alias("need")) for k, v in least.items()])
    rows = n.withColumn("x", F.explode(need)).select("ts_code", "x.indicator", "n_rows", "x.need")
    return rows.where("n_rows < need").select("ts_code", "indicator", "n_rows", F.lit("insufficient_rows").alias("reason"))


def fill_rate(weekly: DataFrame, dim: DataFrame, stocks: DataFrame, back: int = 120) -> DataFrame:
    """Per week-end: instruments with a bar against the mature ones (listed before the 120th week-end back), and the threshold."""
    ends = dim.where("is_week_end = 1").select("trade_date")
    have = weekly.join(F.broadcast(ends), "trade_date").groupBy("trade_date").agg(F.countDistinct("ts_code").alias("n"))
    nth = ends.withColumn("_k", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("trade_date")))).where(F.col("_k") == back).select(F.col("trade_date").alias("_since"))
    u = stocks.join(F.broadcast(nth)).where(F.col("list_date") < F.col("_since")).agg(F.count_if(F.col("is_active") == 1).alias("u"))
    floor = F.least(F.col("u").cast("double"), F.greatest(F.col("u") * 0.8, F.when(F.col("u") >= 4000, 4000.0).otherwise(0.0)))
    return have.join(F.broadcast(u)).withColumn("enough", F.col("n") >= floor)


def label_audit(stored: DataFrame, fresh: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows compared, rows that differ, and their rate."""
    new = fresh.select("ts_code", "trade_date", *[F.col(c).alias(f"_{c}") for c in columns])
    both = stored.join(new, ["ts_code", "trade_date"], "full")
    sums = both.agg(F.count("*").alias("n"), *[F.count_if(~F.col(c).eqNullSafe(F.col(f"_{c}"))).alias(c) for c in columns])
    rows = sums.select("n", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_diff")) for c in columns])).alias("x"))
    rate = F.col("x.n_diff") / F.col("n")
    return rows.select("x.column_name", "n", "x.n_diff", F.when(rate > 0.01, "fail").when(rate > 0.001, "warn").otherwise("ok").alias("verdict"))


def still_missing(codes: DataFrame, done: DataFrame, panel_rows: DataFrame, least: int) -> DataFrame:
    """Instruments without a result and why: no rows at all, too few rows, or not computed."""
    n = panel_rows.groupBy("ts_code").agg(F.count("*").alias("n_rows"))
    rows = codes.select("ts_code").join(done.select("ts_code").distinct(), "ts_code", "left_anti").join(n, "ts_code", "left").fillna(0, ["n_rows"])
    return rows.withColumn("reason", F.when(F.col("n_rows") == 0, "no_data").when(F.col("n_rows") < least, "insufficient_rows").otherwise("not_computed"))


#: Of one reason alone, more rows than this are one batch row.
BATCH = 100


def missing_reasons(missing: DataFrame, calc_date: str, indicator: str, freq: str) -> DataFrame:
    """Skip rows of instruments still without results (``ts_code, n_rows``): source unavailable, no bars, or too few."""
    none = F.col("n_rows") == 0
    reason = F.when(none & F.col("ts_code").endswith(".BJ"), "source_unavailable").when(none, "no_dwd_data").otherwise("insufficient_rows")
    detail = F.concat(F.lit("rows="), F.col("n_rows"))
    return missing.select(F.lit(calc_date).alias("calc_date"), "ts_code", F.lit(indicator).alias("indicator"), F.lit(freq).alias("freq"), reason.alias("reason"), detail.alias("detail"))


def skip_log(skips: DataFrame, only: str = "fingerprint_match", most: int = BATCH) -> DataFrame:
    """Log rows of skips ``(calc_date, ts_code, indicator, freq, reason, detail)``: every detail, or one ``__batch__`` row
    with their number where ``only`` is the one reason of over ``most`` rows. Both levels come from one aggregate by grouping sets."""
    run = ["calc_date", "indicator", "freq"]
    sets = [[*run, "ts_code", "reason", "detail"], run]
    level = skips.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in sets[0]]).agg(
        F.grouping("ts_code").alias("_whole"), F.count("*").alias("_n"), F.count_if(F.col("reason") != only).alias("_others")
    )
    # One row a run, which decides for its details.
    batch = level.where("_whole = 1").select(*run, ((F.col("_n") > most) & (F.col("_others") == 0)).alias("_batch"))
    rows = level.join(F.broadcast(batch), run).where((F.col("_whole") == 1) == F.col("_batch"))
    text = lambda c, v: F.when(F.col("_whole") == 1, v).otherwise(F.col(c)).alias(c)
    return rows.select("calc_date", text("ts_code", F.lit("__batch__")), "indicator", "freq", text("reason", F.lit(only)), text("detail", F.concat(F.lit("batch_skip="), F.col("_n"))))


def log_skips(log: DataFrame, new: DataFrame) -> DataFrame:
    """The log with new rows in place of those of the same date, instrument, indicator and frequency; adding a batch again adds nothing."""
    keys = ["calc_date", "ts_code", "indicator", "freq"]
    return log.join(new.select(*keys), keys, "left_anti").unionByName(new.dropDuplicates(keys))


def cross_layer(tables: dict[str, DataFrame]) -> DataFrame:
    """Instruments and rows of every layer, side by side."""
    parts = [d.agg(F.countDistinct("ts_code").alias("n_codes"), F.count("*").alias("n_rows")).select(F.lit(n).alias("layer"), "n_codes", "n_rows") for n, d in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def outside_domain(rows: DataFrame, domains: dict[str, tuple[str, ...]]) -> DataFrame:
    """Per column the rows whose value is not in its domain; nulls are allowed."""
    return rule_counts({c: (rows, f"{c} is not null and {c} not in ({', '.join(repr(v) for v in vs)})") for c, vs in domains.items()})


def stale_bars(daily: DataFrame, raw_flow: DataFrame, date: str, **layers: DataFrame) -> DataFrame:
    """Instruments with a raw row on a date and a layer (``quotes``, ``weekly``, ``moneyflow``) that ends before; the
    flow layer counts only where there is raw flow on the date."""
    out = daily.where(F.col("trade_date") == date).select("ts_code").distinct()
    for name, rows in layers.items():
        out = out.join(rows.groupBy("ts_code").agg(F.max("trade_date").alias(f"_{name}")), "ts_code", "left")
    has_flow = raw_flow.where(F.col("trade_date") == date).select("ts_code", F.lit(True).alias("_has")).distinct()
    out = out.join(has_flow, "ts_code", "left")
    behind = [F.coalesce(F.col(f"_{n}") < date, F.lit(True)) & (F.lit(True) if n != "moneyflow" else F.coalesce("_has", F.lit(False))) for n in layers]
    return out.where(reduce(lambda a, b: a | b, behind)).select("ts_code")


def to_compute(stocks: DataFrame, results: DataFrame, date: str) -> DataFrame:
    """All instruments but those delisted before a date that already have results."""
    gone = stocks.where((F.coalesce("delist_date", F.lit("")) != "") & (F.col("delist_date") < date)).select("ts_code")
    return stocks.select("ts_code").join(gone.join(results.select("ts_code").distinct(), "ts_code", "left_semi"), "ts_code", "left_anti")


def step_log(runs: DataFrame) -> DataFrame:
    """Log rows ``(step_name, day, started_at, finished_at, duration_s, row_count)`` of steps, from their start times and JSON audit."""
    audit = F.get_json_object("audit", "$.rows").cast("long")
    return runs.select("step_name", F.date_format("started_at", "yyyyMMdd").alias("day"), "started_at", "finished_at", (F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")).alias("duration_s"), audit.alias("row_count"))


def latest_steps(log: DataFrame) -> DataFrame:
    """Of every step and day the run that started last, with the number of its runs."""
    return log.groupBy("step_name", "day").agg(F.count("*").alias("n_runs"), F.max_by(F.struct("duration_s", "row_count"), F.struct("started_at", "duration_s", "row_count")).alias("x")).select("step_name", "day", "n_runs", "x.*")
