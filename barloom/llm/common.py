"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a maximal run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only where the session names none and runs in one process, as in tests, a
    temporary folder is set; executors elsewhere would not see it, so there it is an error.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found and not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not found:
        found = tempfile.mkdtemp(prefix="barloom-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, which cuts its lineage.

    The files survive the loss of executors and go when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/barloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def ranked(rows: DataFrame, tree: str, order: list[str], numbered: bool = False) -> DataFrame:
    """``rows`` with ``lo`` (from 0) and ``n``: each row's rank in its tree by ``order``, and the tree's size;
    ``numbered`` adds ``tree_no``, the rank of the tree among all, nulls first.

    Rows are dealt by range, sorted and written with their place in their range; what earlier ranges hold of a tree
    is added to it. So a tree of any size is ranked in parallel. Rows alike in every column of the order are told
    apart by a number, so a hot one is split as well.
    """
    by = [F.asc_nulls_first(c) for c in (tree, *order, "tie")]
    dealt = materialize(rows.withColumn("tie", F.monotonically_increasing_id()))
    dealt = dealt.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("place", F.monotonically_increasing_id())
    dealt = materialize(dealt.withColumn("part", F.expr("shiftright(place, 33)")).drop("tie"))
    held = dealt.groupBy(tree, "part").agg(F.count("*").alias("rows"), F.min("place").alias("start"))
    whole = Window.partitionBy(tree)
    before = F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    held = materialize(held.select(F.col(tree).alias("of"), F.col("part").alias("at"), "start", F.coalesce(before, F.lit(0)).alias("before"), F.sum("rows").over(whole).alias("n")))
    if numbered:
        trees = ranked(held.where("before = 0").select(F.lit(0).alias("all"), F.col("of").alias("value")), "all", ["value"])
        held = materialize(held.join(trees.select("value", F.col("lo").alias("tree_no")), F.col("of").eqNullSafe(F.col("value"))).drop("value"))
    placed = dealt.join(held, F.col(tree).eqNullSafe(F.col("of")) & (F.col("part") == F.col("at")))
    return placed.withColumn("lo", F.col("before") + F.col("place") - F.col("start")).drop("part", "place", "of", "at", "before", "start")


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that :func:`materialize` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        target = jvm.org.apache.hadoop.fs.Path(name)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python by rows and bytes, where the session leaves the default.

    The default of 10,000 rows may hold gigabytes where texts are long.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text):
    """``text`` with only A-Z lower-cased; null counts as empty.

    Texts of ASCII alone take the fast built-in; ``translate`` leaves all other letters as they are.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
