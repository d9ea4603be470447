"""Numerical kernels over an instrument's series: Column functions on shared windows, and one fold for recursions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def by_date():
    """An instrument's rows in order; one spec for all windows, so one exchange and sort serve them."""
    return Window.partitionBy("ts_code").orderBy("trade_date")


def back(n: int):
    """The window of the current row and the ``n - 1`` rows before it."""
    return by_date().rowsBetween(1 - n, 0)


def rn() -> Column:
    return F.row_number().over(by_date())


def r10(c: Column) -> Column:
    """Rounded to ten places before a comparison with a threshold."""
    return F.round(c, 10)


def sma(c: str, n: int) -> Column:
    """Mean of the values among the last ``n`` rows; null until ``n`` rows."""
    return F.when(rn() >= n, F.avg(c).over(back(n)))


def slope_weights(n: int, decay: float) -> list[float]:
    """Coefficients, oldest first, whose sum with ``n`` values is their weighted least-squares slope (weights exp(x*decay), squared)."""
    w = [math.exp(k * decay) ** 2 for k in range(n)]
    mean = sum(k * x for k, x in enumerate(w)) / sum(w)
    down = sum(x * (k - mean) ** 2 for k, x in enumerate(w))
    return [x * (k - mean) / down for k, x in enumerate(w)]


def weighted_slope(c: str, n: int, decay: float = 0.0) -> Column:
    """Slope over the last ``n`` rows; null if one is missing. Lags with constant factors, no Python."""
    parts = [F.lag(c, n - 1 - k).over(by_date()) * x for k, x in enumerate(slope_weights(n, decay))]
    return sum(parts[1:], parts[0])


def masked_slope(c: str, n: int, log: bool = False, at: str = "rn") -> Column:
    """Least-squares slope over the last ``n`` rows of the values there are, each at its row number ``at``; with ``log`` of their
    logarithms, positive ones only. Fewer than two give 0."""
    y = F.when(F.col(c) > 0, F.ln(c)) if log else F.when(~F.isnan(c), F.col(c))
    return F.when(F.count(y).over(back(n)) < 2, 0.0).otherwise(F.regr_slope(y, F.col(at)).over(back(n)))


def compacted_strength(c: str, n: int, decay: float, least: int = 5) -> Column:
    """Weighted slope of the logarithms of the positive values among the last ``n`` rows, by their mean magnitude.

    Others are left out and the rest moved together; fewer than ``least`` give null, a mean magnitude near zero gives 0.
    """
    y = F.when(F.col(c) > 0, F.ln(c))
    logs = F.collect_list(y).over(back(n))
    factors = F.element_at(F.array(*[F.array(*map(F.lit, slope_weights(m, decay))) for m in range(2, n + 1)]), F.size(logs) - 1)
    slope = F.aggregate(F.zip_with(logs, factors, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    count, scale = F.count(y).over(back(n)), F.avg(F.abs(y)).over(back(n))
    return F.when((rn() >= n) & (count >= least), F.when(scale < 1e-6, 0.0).otherwise(slope / scale))


def mean_abs(c: str, n: int) -> Column:
    return F.when(F.count(c).over(back(n)) == n, F.avg(F.abs(c)).over(back(n)))


def crossed_up(a: str, b: str) -> Column:
    return (F.lag(a).over(by_date()) <= F.lag(b).over(by_date())) & (F.col(a) > F.col(b))


def crossed_down(a: str, b: str) -> Column:
    return (F.lag(a).over(by_date()) >= F.lag(b).over(by_date())) & (F.col(a) < F.col(b))


def last_cross(cross: Column) -> Column:
    """Row number of the last crossing at or before each row; the crossing as a Column of its own."""
    return F.last(F.when(cross, F.col("rn")), ignorenulls=True).over(by_date().rowsBetween(Window.unboundedPreceding, 0))


def pct_rank(c: str, n: int) -> Column:
    """Share in percent of the last ``n`` rows' values that are at most the current one; two values at least."""
    values = F.collect_list(c).over(back(n))
    at_most = F.size(F.filter(values, lambda x: x <= F.col(c)))
    return F.when((rn() >= n) & F.col(c).isNotNull() & (F.size(values) >= 2), at_most / F.size(values) * 100)


def values_equal(a: Column, b: Column) -> Column:
    """Equality with tolerance: nulls alike; absolute difference by scale."""
    scale = F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
    gap = F.abs(a - b)
    near = (gap <= 1e-12) | F.when(scale < 1000, gap <= 1e-4).otherwise(gap <= F.greatest(F.lit(1.0), scale * 1e-5))
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(near)


def scaled_part(value: Column, ref: Column) -> Column:
    """Integer part of value / 10^(order of ref - 1), zero where ref is null or zero."""
    power = F.pow(F.lit(10.0), F.log10(F.abs(ref)).cast("int") - 1)
    return F.when(ref.isNull() | (ref == 0), 0).otherwise((value / power).cast("bigint"))


def thinned(rows: DataFrame, events: str, gap: int, last: Column) -> DataFrame:
    """Rows whose list ``events`` of structs, in order by their ``rn``, is without those within ``gap`` rows after one that was kept, ``last`` being the
    number of the last one kept so far, if any: a fold over each list."""
    start = F.array_compact(F.array(last)).cast("array<int>")
    kept = F.aggregate(F.col(f"{events}.rn"), start, lambda a, x: F.when((F.size(a) == 0) | (x - F.element_at(a, -1) > gap), F.concat(a, F.array(x))).otherwise(a))
    return rows.withColumn("_at", kept).withColumn(events, F.filter(events, lambda x: F.array_contains("_at", x["rn"]))).drop("_at")


def spaced(events: DataFrame, gap: int, *keys: str, before: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Events ``(keys, rn)``, with the columns ``carry``, without those within ``gap`` rows after one that was kept.

    ``before`` may give the last event kept of a key so far, in the same columns.
    """
    lists, last = events.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rn", *carry))).alias("all")), F.lit(None).cast("int")
    if before is not None:
        lists, last = lists.join(before.select(*keys, F.col("rn").alias("_last")), list(keys), "left"), F.col("_last")
    return thinned(lists, "all", gap, last).select(*keys, F.inline("all"))
