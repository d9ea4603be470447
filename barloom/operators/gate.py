"""Comparison against reference labels: normalisation, field diffs, tolerance matching, stratified samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dims import as_date

# Texts that count as missing.
NULLISH = ("", "-", "n/a", "none", "null", "nan")


def normalized(label: Column, names: dict[str, str] | None = None) -> Column:
    c = F.lower(F.trim(label))
    c = F.when(c.isin(*NULLISH), F.lit(None)).otherwise(c)
    return F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[c], c) if names else c


def compound(label: Column, names: dict[str, str], head: str, otherwise: str = "flat") -> Column:
    """A label of two parts joined by ``·`` by what its second part is called; behind ``head`` an unknown one is ``otherwise``.

    Any other label goes by ``names`` as a whole; unknown ones stay.
    """
    c = F.trim(label)
    c = F.when(F.lower(c).isin(*NULLISH), F.lit(None)).otherwise(c)
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    parts = F.split(c, "·", 2)
    tail = table[F.trim(parts[1])]
    two = F.when(F.trim(parts[0]) == head, F.coalesce(tail, F.lit(otherwise))).otherwise(tail)
    return F.coalesce(F.when(F.size(parts) == 2, two), table[c], c)


#: The gate's labels: by indicator the columns that are read and what they are called.
GATE = {
    "macd": {"trend": "macd_trend", "turning_point": "macd_zone", "alert": "macd_alert"}, "ma": {"alignment": "ma_alignment"},
    "dde": {"trend": "dde_trend", "alert": "dde_alert"}, "volume": {"trend": "vol_trend"},
}


FIELDS = [prefix + name for prefix in ("", "w_") for names in GATE.values() for name in names.values()]


def extract(panel: DataFrame, dim: DataFrame, date: str, daily: dict[str, DataFrame], weekly: dict[str, DataFrame]) -> DataFrame:
    """``(ts_code, trade_date, week_end)``, seven daily labels of a date and the seven weekly ones (``w_``) of the last week-end up to it.

    All indicators' rows of the two days are stacked as cells and turned into columns by one aggregate, not by a join each.
    """
    end = dim.where((F.col("is_week_end") == 1) & (F.col("trade_date") <= date)).agg(F.max("trade_date").alias("week_end"))  # one row
    cells = None
    for prefix, frames in (("", daily), ("w_", weekly)):
        for indicator, rows in frames.items():
            rows = rows.where(F.col("trade_date") == date) if not prefix else rows.join(F.broadcast(end), F.col("trade_date") == F.col("week_end"))
            pairs = F.array(*[F.struct(F.lit(prefix + name).alias("field"), F.col(c).alias("label")) for c, name in GATE[indicator].items()])
            rows = rows.select("ts_code", F.inline(pairs))
            cells = rows if cells is None else cells.unionByName(rows)
    wide = cells.groupBy("ts_code").agg(*[F.max(F.when(F.col("field") == f, F.col("label"))).alias(f) for f in FIELDS])
    asked = panel.where(F.col("trade_date") == date).select("ts_code", "trade_date").join(F.broadcast(end))
    return asked.join(wide, "ts_code", "left")


def field_diff(ours: DataFrame, theirs: DataFrame, columns: list[str]) -> DataFrame:
    """``(ts_code, trade_date, field, ours, theirs)`` of fields that differ after normalisation."""
    t = theirs.select("ts_code", "trade_date", *[F.col(c).alias(f"_{c}") for c in columns])
    both = ours.join(t, ["ts_code", "trade_date"])
    cells = F.array(*[F.struct(F.lit(c).alias("field"), normalized(F.col(c)).alias("ours"), normalized(F.col(f"_{c}")).alias("theirs")) for c in columns])
    rows = both.select("ts_code", "trade_date", F.explode(cells).alias("x")).select("ts_code", "trade_date", "x.*")
    return rows.where(~F.col("ours").eqNullSafe(F.col("theirs")))


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("field").agg(F.count("*").alias("n_diff"), F.countDistinct("ts_code").alias("n_codes"))


def matched_within(golden: DataFrame, events: DataFrame, days: int) -> DataFrame:
    """Golden labels with ``is_hit``: an event of the label within some days, found by joining on blocks of days."""
    n = 2 * days + 1
    num = lambda c: F.datediff(as_date(c), F.lit("1970-01-01").cast("date"))
    g = golden.withColumn("_d", num("trade_date"))
    e = events.select("ts_code", "label", num("trade_date").alias("_e")).withColumn("_b", F.floor(F.col("_e") / n))
    probes = g.withColumn("_b", F.explode(F.array_distinct(F.array(F.floor((F.col("_d") - days) / n), F.floor((F.col("_d") + days) / n)))))
    hits = probes.join(e, ["ts_code", "label", "_b"]).where(F.abs(F.col("_d") - F.col("_e")) <= days).select("ts_code", "label", "trade_date").distinct()
    return golden.join(hits.withColumn("is_hit", F.lit(True)), ["ts_code", "label", "trade_date"], "left").fillna(False, ["is_hit"])


def round_robin(stocks: DataFrame, n: int) -> DataFrame:
    """``n`` instruments, taken from the sectors in turn."""
    w = Window.partitionBy("sector").orderBy("ts_code")
    return stocks.withColumn("turn", F.row_number().over(w)).orderBy("turn", "sector").limit(n).select("ts_code", "sector", "turn")


def mapped(rows: DataFrame, columns: dict[str, str], names: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """A reference's rows under our column names, labels normalised by maps of their own per field."""
    names = names or {}
    return rows.select(*[(normalized(F.col(theirs), names.get(ours)) if ours not in ("ts_code", "trade_date") else F.col(theirs)).alias(ours) for theirs, ours in columns.items()])


def verified(ours: DataFrame, golden: DataFrame, columns: list[str]) -> DataFrame:
    """Per date: golden rows, fields that differ, and whether it passes."""
    n = golden.groupBy("trade_date").agg(F.count("*").alias("n_rows"))
    bad = field_diff(ours, golden, columns).groupBy("trade_date").agg(F.count("*").alias("n_diff"))
    return n.join(bad, "trade_date", "left").fillna(0, ["n_diff"]).withColumn("passed", F.col("n_diff") == 0)


def per_instrument(events: DataFrame, codes: DataFrame) -> DataFrame:
    """Events of every given instrument by label, zero where it has none."""
    n = events.groupBy("ts_code").agg(F.count("*").alias("n_events"), F.count_if(F.col("label") == "top_divergence").alias("n_top"), F.count_if(F.col("label") == "bottom_divergence").alias("n_bottom"))
    return codes.select("ts_code").join(n, "ts_code", "left").fillna(0, ["n_events", "n_top", "n_bottom"])


#: A worksheet's columns: what was found, what a reader fills in, and the row as it was where it cannot be read.
WORKSHEET = "ts_code string, freq string, impl_trade_date string, impl_divergence string, golden_trade_date string, golden_divergence string, note string, bad string"
SHEET_COLUMNS = [part.split()[0] for part in WORKSHEET.split(", ")][:-1]


def candidates(events: DataFrame, freq: str) -> DataFrame:
    """Worksheet rows of events, with room for what a reader sees."""
    blank = [F.lit("").alias(c) for c in SHEET_COLUMNS[4:]]
    return events.select("ts_code", F.lit(freq).alias("freq"), F.col("trade_date").alias("impl_trade_date"), F.col("label").alias("impl_divergence"), *blank)


def write_worksheet(rows: DataFrame, path: str) -> None:
    """Worksheet rows as CSV with a header, ordered by instrument and date within each file."""
    rows.select(*SHEET_COLUMNS).sortWithinPartitions("ts_code", "impl_trade_date").write.mode("overwrite").option("header", True).csv(path)


def read_worksheet(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """A worksheet as filled in: labels ``(ts_code, trade_date, freq, label)``, and the rows that cannot be used with the reason.

    A row is bad if it has other columns than a worksheet, a date that is none or a label that is no divergence, or only
    one of the two; rows left blank are neither.
    """
    rows = spark.read.schema(WORKSHEET).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "bad").option("columnPruning", False).csv(path)
    label, day = normalized(F.col("golden_divergence")), normalized(F.col("golden_trade_date"))
    date = F.replace(day, F.lit("-"), F.lit(""))
    why = (
        F.when(F.col("bad").isNotNull(), "unreadable row").when(label.isNull() & day.isNull(), "blank").when(label.isNull(), "date without a label").when(day.isNull(), "label without a date")
        .when(~date.rlike(r"^\d{8}$") | F.try_to_timestamp(date, F.lit("yyyyMMdd")).isNull(), "no date").when(~label.isin("top_divergence", "bottom_divergence"), "no label")
    )
    rows = rows.select("*", why.alias("why"), date.alias("trade_date"), label.alias("label"))
    good = rows.where("why is null").select("ts_code", "trade_date", "freq", "label")
    return good, rows.where("why is not null and why != 'blank'").select("ts_code", "golden_trade_date", "golden_divergence", F.coalesce("bad", F.lit("")).alias("record"), "why")


def worksheet(golden: DataFrame, filled: DataFrame) -> DataFrame:
    """Golden labels with a worksheet's filled rows merged in, without doubling a label of an instrument and day."""
    rows = filled.where(normalized(F.col("label")).isNotNull()).select("ts_code", "trade_date", normalized(F.col("label")).alias("label"))
    return golden.select("ts_code", "trade_date", "label").unionByName(rows).distinct()
