"""Exact top-k search over binary codes by incremental multi-index hashing."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Code length in bits.
BITS = 64


def sign_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, code)``: bit i of the code is one where component i is positive.

    A vector of more than BITS components is an error; missing, null and NaN ones
    count as zero bits; a null or empty vector has code zero.
    """
    v = F.coalesce(F.col(vector_col), F.array().cast(vectors.schema[vector_col].dataType))
    bits = "transform(v, (x, i) -> if(x > 0 and not isnan(x), shiftleft(1L, i), 0L))"
    code = F.expr(f"aggregate({bits}, 0L, (a, x) -> a | x)")
    code = F.when(F.size("v") > BITS, F.raise_error(F.lit(f"a vector has more than {BITS} components"))).otherwise(code)
    return vectors.select(F.col(id_col).alias("id"), v.alias("v")).select("id", code.alias("code"))


def _cuts(n: int) -> list[tuple[int, int]]:
    """Start and width of the segments for ``n`` codes: values a little fewer than codes, so a value's list of codes stays short."""
    m = round(BITS / max(8.0, math.log2(max(n, 1)) - 3))
    ends = [BITS * s // m for s in range(m + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def _part(word: str, start: int, width: int) -> str:
    return f"shiftrightunsigned({word}, {start}) & {(1 << width) - 1}L"


def _probes(open_: DataFrame, cuts: list[tuple[int, int]], r: int) -> DataFrame:
    """``(q, far, last, seg, val)``: for every open query and segment that its bound still asks for, the values at exactly ``r`` bits."""
    need = [F.when(F.lit(len(cuts) * r + s) <= F.col("far"), F.struct(F.lit(s).alias("seg"), F.expr(_part("q", *c)).alias("val"), F.lit(c[1]).alias("width"))) for s, c in enumerate(cuts)]
    rows = open_.select("q", "far", "last", F.explode(F.array_compact(F.array(*need))).alias("p")).select("q", "far", "last", "p.*").withColumn("bit", F.lit(-1))
    for _ in range(r):  # one more bit to flip, above the last one
        rows = rows.where("bit + 1 < width").withColumn("bit", F.explode(F.expr("sequence(bit + 1, width - 1)")))
        rows = rows.withColumn("val", F.expr("val ^ shiftleft(1L, bit)"))
    return rows.select("q", "far", "last", "seg", "val")


def hamming_top_k(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``(query_id, rank, id, distance)``: the k nearest rows of every query by Hamming distance, ties by id.

    ``codes`` and ``queries`` are ``(id, code)``. Equal codes are merged first: a code
    keeps its k smallest ids, which are all that a result can name, so a group of
    copies costs one entry. Codes are cut into m segments, of about as many bits as
    the number of codes has. In round r every open query looks up, segment by
    segment, the values at exactly r differing bits from its own. A code not found in
    rounds before r nor in the first s segments of round r differs in at least
    m*r + s bits; so a query whose kth verified distance is below that needs no
    further segment, ties included. A code counts where it is found first, which its
    segments' own distances tell, and only if it comes before the query's kth so far:
    both tests are part of the join, so a round gives on only what improves a result.
    Nothing is approximate and no limit drops a candidate. With k codes or fewer all
    are in every result and nothing is searched.

    Defined cases: rows with null id or code take no part; a query finds itself if it
    is a row; repeated rows count once; fewer than k rows give fewer results; empty
    tables give no rows; other columns are ignored.
    """
    rows = codes.where("id is not null and code is not null").select("id", "code").distinct()
    kind = rows.schema["id"].dataType.simpleString()
    place = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    members = materialize(rows.withColumn("place", place).where(F.col("place") <= k).select("code", "id", "place"))
    known = members.where("place = 1").select("code", F.col("id").alias("low"))
    asked = queries.where("id is not null and code is not null").select(F.col("id").alias("query_id"), F.col("code").alias("q")).distinct()
    n = known.count()
    if n <= k:
        every = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(i).alias("low")) for c, i in known.collect()]).cast(f"array<struct<code:bigint,low:{kind}>>")
        best = asked.select("q").distinct().select("q", F.explode(every).alias("c")).select("q", "c.code", F.expr("bit_count(q ^ c.code)").alias("distance"))
        return _named(asked, best, members, k)
    cuts = _cuts(n)
    of = F.array(*[F.struct(F.lit(s).alias("seg"), F.expr(_part("code", *c)).alias("val")) for s, c in enumerate(cuts)])
    index = materialize(known.withColumn("p", F.explode(of)).select("p.seg", "p.val", "code", "low"))
    # Until a query has k codes, a row without code stands for what is missing, farther than any.
    best = materialize(asked.select("q").distinct().select("q", F.lit(None).cast("long").alias("code"), F.lit(None).cast(kind).alias("low"), F.lit(BITS + 1).alias("distance"), F.lit(BITS + 1).alias("far"), F.lit(None).cast(kind).alias("last"), F.lit(1).alias("place")))
    by, whole = Window.partitionBy("q").orderBy("distance", F.asc_nulls_last("low")), Window.partitionBy("q")
    closed, r = [], 0
    while not best.isEmpty():
        probes = _probes(best.where("place = 1"), cuts, r)
        distance = F.bit_count(F.expr("q ^ code"))
        fresh = reduce(lambda a, b: a & b, [F.bit_count(F.expr(_part("(q ^ code)", *c))) >= r + (F.lit(s) < F.col("p.seg")).cast("int") for s, c in enumerate(cuts)])
        nearer = (distance < F.col("far")) | ((distance == F.col("far")) & (F.col("i.low") <= F.col("last")))
        same = (F.col("p.seg") == F.col("i.seg")) & (F.col("p.val") == F.col("i.val"))
        # Merged: a broadcast of the probes would grow with the queries, and Spark sees only the rows they come from.
        found = probes.alias("p").hint("merge").join(index.alias("i"), same & fresh & nearer).select("q", "code", "low", distance.alias("distance"))
        now = best.select("q", "code", "low", "distance").unionByName(found).withColumn("place", F.row_number().over(by)).where(F.col("place") <= k)
        full = F.count("code").over(whole) == k
        far = F.when(full, F.max("distance").over(whole)).otherwise(BITS + 1)
        last = F.when(full, F.max_by("low", "place").over(whole))
        now = materialize(now.select("q", "code", "low", "distance", far.alias("far"), last.alias("last"), "place"))
        r += 1
        closed.append(now.where(F.col("far") < len(cuts) * r).select("q", "code", "distance"))
        best = now.where(F.col("far") >= len(cuts) * r)
    return _named(asked, reduce(DataFrame.unionByName, closed, best.select("q", "code", "distance")), members, k)


def _named(asked: DataFrame, best: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """The results by id: of each query's nearest codes the members, ranked."""
    order = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    found = asked.join(best, "q").join(members.select("code", "id"), "code").withColumn("rank", order).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "id", F.col("distance").cast("int").alias("distance"))
