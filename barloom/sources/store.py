"""Layers as tables: what a layer's operators give is written once a session and read by all that need it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("ts_code", "trade_date")
_WRITTEN: dict[tuple, DataFrame] = {}
#: Rows of the largest table for a partition of a shuffle: a task's sorts then stay as large as they are, however large the table.
ROWS = 1 << 17
#: Rows of that table for a task that scans it: its bars are aggregated by sorting within the task, before any shuffle.
SCANNED = 1 << 20
_ROWS: dict[tuple, int] = {}
_SET: dict[str, tuple[int, int]] = {}
_PARTITIONS = "spark.sql.shuffle.partitions"
#: Unless off, a join by instrument and date deals rows anew that lie by instrument already.
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
#: If on, a layer's buckets, one sorted file each, are read as sorted by instrument and date: windows and joins over them sort nothing.
_IN_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); a temporary one where all is one process."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found and not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not found:
        found = tempfile.mkdtemp(prefix="barloom-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def size_shuffles(spark: SparkSession, source: str, largest: Callable[[], DataFrame]) -> None:
    """Give the session's shuffles a partition for every ROWS rows of the largest table under ``source``, and no fewer than the session asks for.

    Counted once a session, from the files' footers. A number that somebody else sets is the one to go by from then on.
    Joins by instrument and date take rows as they lie by instrument, and in the order they lie in.
    """
    spark.conf.set(_ALL_KEYS, "false")
    spark.conf.set(_IN_ORDER, "true")
    app = spark.sparkContext.applicationId
    if (app, source) not in _ROWS:
        rows = largest()
        _ROWS[app, source] = rows.count()
        _bound_scans(spark, rows, _ROWS[app, source])
    now = int(spark.conf.get(_PARTITIONS))
    own, last = _SET.get(app, (now, now))
    own = own if now == last else now
    n = max(own, -(-_ROWS[app, source] // ROWS))
    if n != now:
        spark.conf.set(_PARTITIONS, str(n))
    _SET[app] = own, n


def _bound_scans(spark: SparkSession, rows: DataFrame, n: int) -> None:
    """Let a scan's task read at most about SCANNED of the ``n`` rows of these files, where the session's split holds more."""
    hadoop, key, size = spark.sparkContext._jvm.org.apache.hadoop.fs, "spark.sql.files.maxPartitionBytes", 0
    for name in rows.inputFiles():
        path = hadoop.Path(name)
        size += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    split = max(1 << 20, size * SCANNED // max(n, 1))
    if split < now:
        spark.conf.set(key, str(split))


def dealt(rows: DataFrame, by: str = "ts_code") -> DataFrame:
    """Rows dealt by a column over as many partitions as a layer has buckets, none of them merged: they meet a layer's rows, or windows, without another exchange."""
    return rows.repartition(int(rows.sparkSession.conf.get(_PARTITIONS)), by)


def layer(spark: SparkSession, source: str, name: str, build: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
    """The layer ``name`` of the tables under ``source``: built and written by the first that asks in a session.

    Parquet in the shared folder survives lost executors, has column statistics for
    pushed-down filters, and goes when the driver ends. With ``by`` it is a table in as many
    buckets of that column as a shuffle has partitions, one file each and sorted by date:
    windows, joins and grouped maps by that column need no exchange.
    """
    key = spark.sparkContext.applicationId, source, name
    if key not in _WRITTEN:
        rows, tag = build(), uuid.uuid4().hex
        path = f"{shared_dir(spark)}/layer-{name}-{tag}"
        if by:
            n = int(spark.conf.get(_PARTITIONS))
            dealt(rows, by).write.bucketBy(n, by).sortBy(by, "trade_date").option("path", path).saveAsTable(f"barloom_{name}_{tag}")
            table = spark.table(f"barloom_{name}_{tag}")
        else:
            rows.write.parquet(path)
            table = spark.read.schema(rows.schema).parquet(path)
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
        _WRITTEN[key] = table
    return _WRITTEN[key]


def load(rows: DataFrame, start: str | None = None, codes: DataFrame | None = None, ends: DataFrame | None = None) -> DataFrame:
    """A bar layer's rows from a date on, which the scan gets as a filter, of given instruments and (weekly) of given days only."""
    if start:
        rows = rows.where(F.col("trade_date") >= start)
    if codes is not None:
        rows = rows.join(codes.select("ts_code"), "ts_code", "left_semi")
    return rows.join(F.broadcast(ends.select("trade_date")), "trade_date", "left_semi") if ends is not None else rows  # a calendar


# Stored layers: Parquet in partitions by a hash of the instrument and by year, so that a change rewrites few of them.
PARTS = ("bucket", "year")


def _parts(buckets: int) -> dict[str, Column]:
    return {"bucket": F.pmod(F.hash("ts_code"), F.lit(buckets)), "year": F.substring("trade_date", 1, 4).cast("int")}


def put(rows: DataFrame, path: str, buckets: int = 64) -> None:
    """Write a layer anew."""
    rows.withColumns(_parts(buckets)).repartition(*PARTS).write.mode("overwrite").partitionBy(*PARTS).parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """A stored layer without its partition columns."""
    return spark.read.parquet(path).drop(*PARTS)


def _touched(spark: SparkSession, path: str, keys: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """The given keys with their partitions, and the stored rows of those partitions; the scan skips all others."""
    placed = keys.withColumns(_parts(buckets))
    parts = placed.select(*PARTS).distinct()  # at most as many rows as the layer has partitions
    return placed, spark.read.parquet(path).join(F.broadcast(parts), list(PARTS), "left_semi")


def staged(rows: DataFrame) -> DataFrame:
    """Rows written to the shared folder and read again: what several steps use is computed once."""
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(rows.schema).parquet(path)


def _overwrite(rows: DataFrame, path: str) -> None:
    """Replace the partitions of ``rows``; they may come from the same layer, as its files go when the job commits."""
    rows.repartition(*PARTS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(path)


def merge(spark: SparkSession, path: str, changed: DataFrame, buckets: int = 64) -> None:
    """Put ``changed`` rows into a stored layer, in place of those with their keys: read, merge and rewrite only the
    partitions that they touch. Running it again changes nothing."""
    changed = staged(changed)
    placed, old = _touched(spark, path, changed, buckets)
    kept = old.join(changed.select(*KEYS), list(KEYS), "left_anti")
    _overwrite(kept.unionByName(placed.select(*kept.columns)), path)


def remove(spark: SparkSession, path: str, gone: DataFrame, buckets: int = 64) -> int:
    """Take the rows with the keys of ``gone`` out of a stored layer, and drop partitions left empty; returns how many rows went."""
    gone = staged(gone.select(*KEYS).distinct())
    placed, old = _touched(spark, path, gone, buckets)
    n = old.join(gone, list(KEYS), "left_semi").count()
    if n:
        rest = staged(old.join(gone, list(KEYS), "left_anti"))
        _overwrite(rest, path)
        empty = placed.select(*PARTS).distinct().join(rest.select(*PARTS).distinct(), list(PARTS), "left_anti")
        for bucket, year in empty.collect():  # numbers of partitions, as many as the layer has at most
            drop_folder(spark, f"{path}/bucket={bucket}/year={year}")
    return n


def drop_folder(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
