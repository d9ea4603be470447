"""Connected components over edge tables that are too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node on an edge, component being the smallest node reachable.

    Alternates large-star and small-star steps: each node's neighbours are linked
    to its smallest neighbour until nothing changes, in about log(n) rounds.
    Every step is a grouped minimum (combined before the shuffle) and one join
    that Spark may split where a node is hot. Each round is written to the shared
    folder, so lineage stays short and lost executors cost one round at most.
    Edges with a null end and loops are left out.
    """
    e = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    was = _state(e)
    while was[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        old, e = e, materialize(small)
        now = _state(e)
        drop_table(old)
        if now == was:
            break
        was = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
