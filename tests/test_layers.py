from pyspark.sql import functions as F

from barloom.operators import views as V
from barloom.sources import layers, store
from barloom.streaming import microbatch


def test_scan_conforms_and_pushes_down(spark, tmp_path):
    rows = spark.createDataFrame([("A", "20240101", 1.0), ("A", "20240105", 2.0), ("B", "20240105", 3.0)], "ts_code string, trade_date string, close double")
    layers.conform(rows, "ods_daily").write.parquet(str(tmp_path / "t"))
    got = layers.scan(spark, str(tmp_path / "t"), "ods_daily", "20240102", rows.where("ts_code = 'A'"))
    assert [(r.ts_code, r.close, r.open) for r in got.collect()] == [("A", 2.0, None)]
    plan = got._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(trade_date,20240102)" in plan


def test_snapshot_sink_replaces_one_date(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = spark.createDataFrame([("A", "20240101", 1.0)], "ts_code string, trade_date string, v double")
    V.snapshot_sink(rows, path, "20240102", "v2")
    V.snapshot_sink(rows.withColumn("v", F.lit(2.0)), path, "20240103", "v2")
    V.snapshot_sink(rows.withColumn("v", F.lit(3.0)), path, "20240103", "v2")
    back = spark.read.parquet(path)
    assert back.count() == 2 and V.latest(back).first().v == 3.0


def test_stream_of_bars(spark, tmp_path):
    """Batches with new, repeated and late changed bars give what one run over all bars gives."""
    from barloom.functions.kernels import r10, sma

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "ts_code string, trade_date string, close double, arrived long"
    day = lambda k: f"2024{k // 28 + 1:02d}{k % 28 + 1:02d}"
    batches = [
        [(c, day(k), float(k * k % 17), 1) for c in "AB" for k in range(12)] + [("A", day(3), 99.0, 2)],
        [("A", day(k), float(k), 3) for k in range(12, 20)] + [("C", day(15), 1.0, 3)],
        [("A", day(9), 50.0, 4), ("B", day(12), 7.0, 4)],
    ]
    compute = lambda bars: bars.select("ts_code", "trade_date", "close", r10(sma("close", 5)).alias("ma"))
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        microbatch.incremental_sink(stream, out, compute, str(tmp_path / "cp"), lookback=5).trigger(availableNow=True).start().awaitTermination()
    all_ = {}
    for rows in batches:
        for c, d, x, n in sorted(rows, key=lambda r: r[3]):
            all_[c, d] = x
    full = compute(spark.createDataFrame([(*k, v) for k, v in all_.items()], "ts_code string, trade_date string, close double"))
    got = microbatch.newest(spark.read.parquet(f"{out}/results"))
    read = lambda d: sorted((r.ts_code, r.trade_date, r.close, r.ma) for r in d.collect() if r.ma is not None or r.ts_code == "C")
    assert read(got) == read(full) and spark.read.parquet(f"{out}/results").where("batch_id = 1 and ts_code = 'B'").count() == 0


def test_screening_joins_rows_for_the_last_bars_date_only(spark):
    bars = spark.createDataFrame([(c, d, float(k)) for k, c in enumerate("ABC") for d in ("20240101", "20240102")], "ts_code string, trade_date string, ddx double")
    wide = bars.withColumn("zone", F.lit("bull"))
    got = V.screening(wide, 2, bars=bars, zone="bull")
    assert [(r.ts_code, r.trade_date) for r in got.collect()] == [("C", "20240102"), ("B", "20240102")] == [(r.ts_code, r.trade_date) for r in V.screening(wide, 2, zone="bull").collect()]
    assert V.screening(wide.limit(0), 2, bars=bars.limit(0)).count() == 0


def test_a_scan_reads_a_bounded_number_of_rows_a_task(spark, tmp_path, monkeypatch):
    key, path = "spark.sql.files.maxPartitionBytes", f"{tmp_path}/rows"
    was = spark.conf.get(key)
    spark.range(3_000_000).selectExpr("id", "hash(id) as x").coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(path)
    monkeypatch.setattr(store, "SCANNED", 300_000)
    try:
        store.size_shuffles(spark, path, lambda: spark.read.parquet(path))
        sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 3_000_000 and max(sizes) < 600_000
    finally:
        spark.conf.set(key, was)
