"""Incremental recompute over a stream of bars: each micro-batch is stored, routed and upserted by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from barloom.operators.incremental import append


#: Folders by a hash of the instrument in which stored bars lie.
BUCKETS = 64


def keep_latest(bars: DataFrame) -> DataFrame:
    """Of rows with one key in a micro-batch, the one that came last."""
    w = Window.partitionBy("ts_code", "trade_date").orderBy(F.desc("arrived"))
    return bars.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def incremental_sink(stream: DataFrame, path: str, compute: Callable[[DataFrame], DataFrame], checkpoint: str, lookback: int = 0) -> DataStreamWriter:
    """A writer that stores each micro-batch's bars and the results they change, under ``path/bars`` and ``path/results``.

    Bars lie in folders by a hash of their instrument; a batch reads those of its instruments only, and joins them
    before anything is sorted. A batch's instruments are computed anew from the first bar that the batch brings,
    with ``lookback`` stored bars before it: an append where bars are new, a repair
    where an old bar changed; instruments without new bars are passed over. Results are
    then those of a run over all bars, as far as ``compute`` looks back no further.
    Writing a batch again replaces it, so a restarted query repeats nothing; readers
    take the newest batch of a key. Keys are upserted, so late rows need no watermark.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        bars, results = f"{path}/bars", f"{path}/results"
        bucket = F.pmod(F.hash("ts_code"), F.lit(BUCKETS))
        _put(keep_latest(batch).drop("arrived").withColumn("bucket", bucket), bars, epoch, "bucket")
        known = spark.read.parquet(bars).where(F.col("batch_id") <= epoch)
        first = known.where(F.col("batch_id") == epoch).groupBy("bucket", "ts_code").agg(F.min("trade_date").alias("first"))
        touched = F.broadcast(first.select("bucket").distinct())  # BUCKETS rows at most; the scan skips all other folders
        panel = newest(known.join(touched, "bucket", "left_semi").drop("bucket").join(first.drop("bucket"), "ts_code"))
        # The last bar before the first that came; an instrument without one begins with the batch.
        before = F.coalesce(F.max(F.when(F.col("trade_date") < F.col("first"), F.col("trade_date"))), F.lit(""))
        last = panel.groupBy("ts_code").agg(before.alias("last_trade_date"))
        _put(append(compute, panel.drop("first"), last, lookback), results, epoch)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def _put(rows: DataFrame, path: str, epoch: int, *parts: str) -> None:
    rows.withColumn("batch_id", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", *parts).parquet(path)


def newest(rows: DataFrame) -> DataFrame:
    """The newest batch's row of every key."""
    w = Window.partitionBy("ts_code", "trade_date").orderBy(F.desc("batch_id"))
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "batch_id")
