import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.functions import kernels as K
from barloom.functions import recursion as R


def series(spark, values, code="A"):
    return spark.createDataFrame([(code, f"2000{k // 28 + 1:02d}{k % 28 + 1:02d}", v) for k, v in enumerate(values)], "ts_code string, trade_date string, x double")


def column(df, name):
    return [r[name] for r in df.orderBy("trade_date").collect()]


def test_constant_series_has_a_constant_mean():
    assert R.ema_array([10.0] * 30, 12)[11] == 10.0


def test_ewm_lets_the_weight_decay_over_a_gap():
    assert R.ewm_array([1.0, 2.0, None, 4.0], 3)[-1] == pytest.approx(3.1667, abs=1e-4)


def test_seeded_mean_continues_the_full_one():
    x = [random.Random(3).random() for _ in range(60)]
    full = R.ema_array(x, 12)
    assert R.ema_array(x[40:], 12, full[39]) == pytest.approx(full[40:])


@pytest.mark.parametrize("n,decay", [(5, 0.0), (5, 0.15), (10, 0.2)])
def test_weighted_slope_is_polyfit(spark, n, decay):
    x = [random.Random(n).gauss(0, 1) for _ in range(40)]
    got = column(series(spark, x).select("trade_date", K.weighted_slope("x", n, decay).alias("s")), "s")
    w = np.exp(np.arange(n) * decay)
    for k in range(40):
        if k < n - 1:
            assert got[k] is None
        else:
            assert got[k] == pytest.approx(np.polyfit(np.arange(n), x[k - n + 1 : k + 1], 1, w=w)[0])


def test_sma_and_pct_rank(spark):
    x = [float(v) for v in (3, 1, 2, 5, 4, 4)]
    d = series(spark, x)
    assert column(d.select("trade_date", K.sma("x", 3).alias("s")), "s") == [None, None, 2.0, pytest.approx(8 / 3), pytest.approx(11 / 3), pytest.approx(13 / 3)]
    assert column(d.select("trade_date", K.pct_rank("x", 3).alias("s")), "s")[2:] == [pytest.approx(v) for v in (200 / 3, 100, 200 / 3, 200 / 3)]


def test_tolerant_equality(spark):
    rows = [(49841.46, 49841.4609375, True), (1.0, 1.0002, False), (None, None, True), (None, 1.0, False), (1.0, 1.00005, True)]
    d = spark.createDataFrame(rows, "a double, b double, want boolean")
    assert d.where(K.values_equal(F.col("a"), F.col("b")) != F.col("want")).count() == 0


def test_scaled_part(spark):
    d = spark.createDataFrame([(0.123, 0.456), (-0.05, -0.08), (1.0, None), (1.0, 0.0)], "v double, r double")
    got = [r[0] for r in d.select(K.scaled_part(F.col("v"), F.col("r"))).collect()]
    assert got == [int(0.123 / 10 ** (int(math.log10(0.456)) - 1)), int(-0.05 / 10 ** (int(math.log10(0.08)) - 1)), 0, 0]


def test_spaced_events_keep_a_gap_after_kept_ones(spark):
    d = spark.createDataFrame([("A", r) for r in (1, 4, 6, 7, 12, 13, 30)], "ts_code string, rn int")
    assert sorted(r.rn for r in K.spaced(d, 5, "ts_code").collect()) == [1, 7, 13, 30]


def test_zone_hysteresis():
    rank = [None, 95, 95, 80, 74, 74, 50, 9, 9, 9, 9, 9, 20, 26, 26]
    assert R.zones(rank) == [None, "normal", "explosive", "explosive", "explosive", "normal", "normal", "normal", "normal", "normal", "normal", "low_volume", "low_volume", "low_volume", "normal"]
    assert R.zones([80], "explosive") == ["explosive"]


def test_spaced_events_carry_columns(spark):
    d = spark.createDataFrame([("A", n, f"d{n}") for n in (3, 9, 14, 15)] + [("B", 4, "x")], "ts_code string, rn int, day string")
    got = K.spaced(d, 10, "ts_code", carry=("day",)).collect()
    assert sorted(tuple(r) for r in got) == [("A", 3, "d3"), ("A", 14, "d14"), ("B", 4, "x")]
