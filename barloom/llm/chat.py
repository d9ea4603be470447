"""Preference formatting: chosen and rejected conversations as one prompt and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize


def conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv, turns array<struct<role,text>>)``: every conversation's turns in order.

    Ties of the turn number go by role and text; rows that repeat all four columns
    count once; a null text is empty, a null role is ``user``; a null turn number
    comes first; rows without conversation are left out. A conversation is one
    record by nature: its turns meet in one row.
    """
    one = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("user")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    of = turns.where(F.col(conv_col).isNotNull()).groupBy(F.col(conv_col).alias("conv")).agg(F.collect_set(one).alias("t"))
    return of.select("conv", F.transform(F.array_sort("t"), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def opening_pairs(convs: DataFrame) -> DataFrame:
    """``(chosen, rejected)``: per first turn, the smallest conversation as chosen with every other as rejected.

    The pairs grow with the conversations, however many share a first turn: the
    smallest id per first turn is combined before the shuffle, written, and joined
    back by a join of plain tables, which Spark may split where a first turn is hot.
    """
    opened = convs.where(F.size("turns") > 0).select("conv", F.element_at("turns", 1).alias("first"))
    best = materialize(opened.groupBy("first").agg(F.min("conv").alias("chosen")))
    return opened.join(best, "first").where("conv != chosen").select("chosen", F.col("conv").alias("rejected"))


def worse_endings(convs: DataFrame) -> DataFrame:
    """``convs`` with each last assistant turn replaced by the first one's text, where those differ: a stale answer to reject."""
    answer = F.transform("turns", lambda x, i: F.when(x["role"] == "assistant", i))
    last = F.array_max(answer)
    first = F.element_at(F.filter("turns", lambda x: x["role"] == "assistant"), 1)["text"]
    marked = convs.withColumns({"last": last}).where("last is not null").withColumn("stale", first)
    turns = F.transform("turns", lambda x, i: F.struct(x["role"].alias("role"), F.when(i == F.col("last"), F.col("stale")).otherwise(x["text"]).alias("text")))
    return marked.where(F.element_at("turns", F.col("last") + 1)["text"] != F.col("stale")).select("conv", turns.alias("turns"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), turn["role"], F.lit("\n"), turn["text"], F.lit("<|im_end|>\n"))


def _completion(turns: Column) -> Column:
    """Text of the turns, and the spans of it (in code points) to learn: the words and the end mark of assistant turns."""
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(done: Column, turn: Column) -> Column:
        end = done["n"] + F.length(_rendered(turn))
        head = F.length(turn["role"]) + len("<|im_start|>\n")
        span = F.struct((done["n"] + head).alias("start"), (end - 1).alias("end"))
        spans = F.when(turn["role"] == "assistant", F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct(end.alias("n"), spans.alias("spans"))

    text = F.array_join(F.transform(turns, _rendered), "")
    return F.struct(text.alias("text"), F.aggregate(turns, start, add, lambda x: x["spans"]).alias("mask"))


def format_preferences(convs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(chosen, rejected, n_prompt, prompt, chosen_completion, rejected_completion)`` of every pair.

    ``convs`` as :func:`conversations` gives it, ``pairs`` of ids ``(chosen,
    rejected)``. The prompt is the longest common prefix of whole turns, rendered
    once and never learnt; a completion is a struct of the rest's text and of the
    spans of it to learn (assistant turns; mask). Where one conversation is a prefix
    of the other, its completion is empty. Defined cases: a pair with an unknown or
    null id is left out; repeated pairs repeat; texts of any length are taken whole; empty tables give no rows.
    """
    a = convs.select(F.col("conv").alias("chosen"), F.col("turns").alias("a"))
    b = convs.select(F.col("conv").alias("rejected"), F.col("turns").alias("b"))
    both = pairs.select("chosen", "rejected").join(a, "chosen").join(b, "rejected")
    same = F.zip_with("a", "b", lambda x, y: x.eqNullSafe(y) & x.isNotNull())
    n = F.when(F.array_position(same, False) > 0, F.array_position(same, False) - 1).otherwise(F.size(same)).cast("int")
    cut = both.withColumn("n", n)
    rest = lambda c: F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    return cut.select(
        "chosen",
        "rejected",
        F.col("n").alias("n_prompt"),
        F.array_join(F.transform(F.slice("a", 1, F.col("n")), _rendered), "").alias("prompt"),
        _completion(rest("a")).alias("chosen_completion"),
        _completion(rest("b")).alias("rejected_completion"),
    )
