"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, drop_table, materialize

#: Chunks are cut at the first sentence or line end that follows 512 characters, at 8192 characters at the latest.
CHUNK = r"(?s).{512,8192}?(?:[.!?][ \n]|\n|$)|.{1,8192}"


def chunked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text_sha256, chunks)`` of every row: the normalised text cut where its content says so."""
    text = ascii_lower(F.col(text_col))
    return docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id",
        F.sha2(F.col("t").cast("binary"), 256).alias("text_sha256"),
        F.expr(f"regexp_extract_all(t, r'{CHUNK}', 0)").alias("chunks"),
    )


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_chunk=F.xxhash64) -> DataFrame:
    """``(id, text_sha256, recipe)``: each text as the ordered list of its chunks' verified identifiers.

    All chunk texts are grouped by hash *and* text, moving each text once and
    merging repeats before the shuffle. A hash under which one text stands is that
    chunk's identifier. Where several texts share a hash, they are numbered, and
    the numbers go into the recipes of the documents that hold such a chunk
    (``patch``). Two recipes are therefore equal just when the texts are.
    """
    rows = chunked(docs, id_col, text_col)
    lists = rows.select(
        "id", "text_sha256", F.transform("chunks", lambda c: hash_chunk(c)).alias("ids"), "chunks"
    )
    chunk = rows.select(F.explode("chunks").alias("chunk"))
    known = chunk.groupBy(hash_chunk(F.col("chunk")).alias("h"), "chunk").agg(F.count("*").alias("n"))
    clash = materialize(known.groupBy("h").agg(F.count("*").alias("texts")).where("texts > 1").select("h"))
    if clash.isEmpty():
        drop_table(clash)
        return lists.select("id", "text_sha256", F.struct("ids", F.lit(None).cast("string").alias("patch")).alias("recipe"))
    number = F.row_number().over(Window.partitionBy("h").orderBy("chunk"))
    numbered = known.join(clash, "h", "left_semi").select("h", "chunk", number.alias("no"))
    at = lists.select("id", "text_sha256", F.posexplode("chunks").alias("pos", "chunk"))
    at = at.withColumn("h", hash_chunk(F.col("chunk"))).join(numbered, ["h", "chunk"])
    places = F.array_sort(F.collect_set(F.struct("pos", "no")))
    patch = at.groupBy("id", "text_sha256").agg(places.cast("string").alias("patch"))
    joined = lists.alias("l").join(
        patch.alias("p"),
        F.col("l.id").eqNullSafe(F.col("p.id")) & (F.col("l.text_sha256") == F.col("p.text_sha256")),
        "left",
    )
    return joined.select("l.id", "l.text_sha256", F.struct("l.ids", "p.patch").alias("recipe"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``(id, keep_id, group_size, kept, text_sha256)``.

    Texts are equal when identical after lower-casing A-Z; of equal texts the row
    with the largest id stays. Defined cases: a null text counts as empty, all
    empty texts are one group; a null id loses against every other and a group of
    null ids alone has a null ``keep_id`` and keeps its rows; rows that repeat both
    id and text all carry ``kept``, as they are the same document; an empty table
    gives no rows; a text of any length is cut and compared whole; other columns are ignored.

    Only recipes move in the second shuffle, written once for both readers: the count
    and the largest id per recipe are combined before it and written too, so the join
    back is one of two plain tables, which Spark may split where one recipe is hot.
    """
    rows = materialize(recipes(docs, id_col, text_col))
    best = materialize(rows.groupBy("recipe").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")))
    return rows.join(best, "recipe").select(
        F.col("id"), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
