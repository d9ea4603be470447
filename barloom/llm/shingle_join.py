"""Exact links of texts whose sets of word shingles are alike, by prefixes of the sets (no pair of that similarity is left out)."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialize
from .graph import connected_components

SEED = 42
#: Texts are alike whose shared shingles are at least 4 of 5 of all their shingles.
PART, WHOLE = 4, 5
#: About so many documents tell which shingles are frequent: those in FREQUENT of them or more. Only the order depends on it, never the result.
SAMPLE, FREQUENT = 20_000, 4
#: A prefix is longer by one of so many shingles of the set, so that alike sets share more than one there.
MORE = 20
#: Sets that share a shingle are compared pair by pair up to this many; more are told apart around a centre, in so many rounds at most.
GROUP, ROUNDS = 8, 4


def shingles(text: str | None, width: int) -> np.ndarray:
    """The set of the ``width``-word shingles as sorted XXH64 values; fewer words make one shingle, none an empty set."""
    words = (text or "").encode().lower().split()  # bytes: A-Z alone change, ASCII white space splits
    if not words:
        return np.empty(0, np.uint64)
    of = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((of(b" ".join(words[k : k + width]), SEED) for k in range(max(1, len(words) - width + 1))), np.uint64))


def _mapped(rows: DataFrame, width: int, schema: str, cells) -> DataFrame:
    """``(id, *cells(set))`` of the rows ``(id, text)`` that have a shingle."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for b in batches:
            found = [(i, cells(s)) for i, t in zip(b.column(0).to_pylist(), b.column(1)) if len(s := shingles(t.as_py(), width))]
            if found:
                yield pa.record_batch([pa.array([i for i, _ in found], b.column(0).type), *(pa.array(list(c)) for c in zip(*(x for _, x in found)))], ["id", *names])

    bounded_batches(rows.sparkSession)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {schema}")


def frequent(rows: DataFrame, width: int) -> np.ndarray:
    """Shingles of at least FREQUENT of about SAMPLE documents, the rarest first: a bounded list, whatever the size of the table."""
    n = max(1, rows.count() // SAMPLE)
    some = rows.where(F.pmod(F.xxhash64("id"), F.lit(n)) == 0)
    each = _mapped(some, width, "token array<bigint>", lambda s: (s.view(np.int64),)).select(F.explode("token").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= FREQUENT).toPandas()
    return often.sort_values(["n", "token"])["token"].to_numpy(np.int64).view(np.uint64)


def prefixes(rows: DataFrame, width: int) -> DataFrame:
    """``(id, size, digest, prefix)``: of every set, in one order of all shingles with frequent ones last, the first fifth, one more and a MORE-th.

    Of two sets that are alike, each lacks at most a fifth of its shingles in the other, so their prefixes share one more than a MORE-th of the smaller set.
    """
    last = frequent(rows, width)
    at = np.argsort(last)
    ordered = rows.sparkSession.sparkContext.broadcast((last[at], at))

    def cells(s):
        known, rank = ordered.value
        where = np.minimum(np.searchsorted(known, s), max(len(known) - 1, 0))
        place = np.where(known[where] == s, rank[where] + 1, 0) if len(known) else np.zeros(len(s), np.int64)
        first = s[np.lexsort((s, place))][: len(s) - -(-PART * len(s) // WHOLE) + 1 + len(s) // MORE]
        return len(s), xxhash.xxh128_digest(s.tobytes(), SEED), first.view(np.int64)

    return _mapped(rows, width, "size bigint, digest binary, prefix array<bigint>", cells)


def _whole(rows: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``(id, tokens)``: the whole sets of these ids, made anew from their texts. The ids are written first: if they are few, no text is shuffled."""
    ids = materialize(ids.select("id").distinct())
    return materialize(_mapped(rows.join(ids, "id", "left_semi"), width, "tokens array<bigint>", lambda s: (s.view(np.int64),)))


def _ends() -> Column:
    """The length of the prefix of a set of ``size``."""
    return F.expr(f"size - ({PART} * size + {WHOLE - 1}) div {WHOLE} + 1 + size div {MORE}")


def _enough(tokens: DataFrame) -> DataFrame:
    """The rows of sets that share as much with other classes as alike sets share of their prefixes, as :func:`_met` has them.

    An alike set is four fifths as large at least. What goes takes shingles from others, hence two rounds.
    """
    for _ in range(2):
        own = F.count("*").over(Window.partitionBy("id"))
        least = F.expr(f"1 + (({PART} * size + {WHOLE - 1}) div {WHOLE}) div {MORE}")
        tokens = _met(tokens.withColumn("own", own).where(F.col("own") >= least).drop("own", "n"))
    return tokens


def _reordered(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """``(id, class, size, pos, token)``: the prefixes of these sets in an order of their own, by exact counts among them.

    Shingles of one class alone stand first and are left out, as they meet no other class; then come those of few sets.
    ``nodes`` has ``(id, class, size)``, ``sets`` their ``(id, tokens)``.
    """
    each = materialize(nodes.join(sets, "id").select("id", "class", "size", F.explode("tokens").alias("token")))
    several = each.groupBy("token").agg(F.count("*").alias("n"), F.min("class").alias("a"), F.max("class").alias("b")).where("a < b").select("token", "n")
    shared = F.sort_array(F.collect_list(F.struct("n", "token"))).alias("shared")
    order = each.join(several, "token").groupBy("id", "class", "size").agg(shared).withColumn("first", F.col("size") - F.size("shared"))
    ends = _ends()
    order = order.where(F.col("first") < ends).withColumn("shared", F.slice("shared", F.lit(1), (ends - F.col("first")).cast("int")))
    order = order.select("id", "class", "size", "first", F.posexplode("shared").alias("at", "key"))
    return order.select("id", "class", "size", (F.col("first") + F.col("at")).alias("pos"), "key.token")


def _met(tokens: DataFrame) -> DataFrame:
    """The rows whose token stands in sets of several classes, with ``n``, the number of those sets."""
    of, cls = Window.partitionBy("token"), F.col("class")
    told = tokens.withColumn("several", F.min(cls).over(of) < F.max(cls).over(of)).withColumn("n", F.count("*").over(of))
    return materialize(told.where("several").drop("several"))


def _sides(rows: DataFrame, by: list[str]) -> tuple:
    """``rows`` twice, all columns but ``by`` named for the side."""
    return tuple(rows.select(*by, *[F.col(c).alias(f"{c}_{side}") for c in rows.columns if c not in by]) for side in "xy")


def _around(led: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges to the centres, pairs to compare and ``(id, centre)`` of sets that need not meet the others of that centre again.

    ``led`` has ``(id, class, size, centre, class_c, size_c)``, ``sets`` the whole sets as ``(id, tokens)``. A set is told by its difference from the centre, so a pair's distance is that of its
    differences. Two sets alike with the centre are joined by it. In any other alike pair the differences must share shingles: with d and e of them
    and sizes s and t at least (d + e - (s + t) / 9) / 2, which is over (d - (s + c) / 9) / 2 where the other, and over (d + (c - s) / 9) / 2
    where this one is alike with a centre of size c. Their prefixes, rarest first around the centre, then share one. By the triangle inequality a set
    of similarity under 0.4 with the centre is alike with none of 0.6 or more, so those under 0.6 go on to another centre and those from 0.4 stay.
    """
    led = led.where(F.least("size", "size_c") * 5 >= F.greatest("size", "size_c") * 2).distinct()
    both = led.join(sets, "id").join(sets.select(F.col("id").alias("centre"), F.col("tokens").alias("tokens_c")), "centre")
    apart = F.concat(F.array_except("tokens", "tokens_c"), F.array_except("tokens_c", "tokens"))
    apart = both.where("id != centre").withColumn("apart", apart).drop("tokens", "tokens_c").withColumn("d", F.size("apart").cast("long"))
    total = F.col("size") + F.col("size_c")  # of similarity p / q or more: q - p of q + p parts of both sizes differ at most
    apart = materialize(apart.where(F.col("d") * 7 <= total * 3).withColumn("near", F.col("d") * (WHOLE + PART) <= total * (WHOLE - PART)))
    edges = apart.where("near and class != class_c").select(F.col("class").alias("a"), F.col("class_c").alias("b"))
    close = apart.where(F.col("d") * 4 <= total).select("id", "centre")
    each = apart.select("centre", "id", F.explode("apart").alias("token"))
    often = each.groupBy("centre", "token").agg(F.count("*").alias("n")).where("n > 1")
    order = each.join(often, ["centre", "token"]).groupBy("centre", "id").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("shared"))
    least = F.when(F.col("near"), F.expr("(9 * d + size_c - size) div 18 + 1")).otherwise(F.expr("(9 * d - size - size_c + 17) div 18"))
    known = apart.drop("apart").join(order, ["centre", "id"]).withColumn("first", F.col("d") - F.size("shared"))  # shingles of one set alone stand first
    known = known.select("centre", "id", "class", "size", "d", "near", "first", least.alias("least"), F.posexplode("shared").alias("at", "key"))
    known = known.select("centre", "key.token", "id", "class", "size", "d", "near", "least", (F.col("first") + F.col("at")).alias("pos"))
    x, y = _sides(materialize(known.where("d - pos >= least").drop("least")), ["centre", "token"])
    fit = F.least("size_x", "size_y") * WHOLE >= F.greatest("size_x", "size_y") * PART
    from_here = F.expr("18 * least(d_x - pos_x, d_y - pos_y) >= 9 * (d_x + d_y) - size_x - size_y")  # holds at the first shared place
    pairs = x.join(y, ["centre", "token"]).where(F.expr("id_x < id_y and class_x != class_y and not (near_x and near_y)") & fit & from_here)
    return edges, pairs.select("id_x", "id_y", "class_x", "class_y"), close


def compared(nodes: DataFrame, rows: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Edges ``(a, b)`` told already and pairs ``(id_x, id_y, class_x, class_y)`` still to be told by their whole sets.

    ``nodes`` has ``(id, class, size, prefix)``. Sets that share a shingle of their prefixes meet if they are of different classes and
    their sizes, the places of shared ones and their number in the prefixes allow enough. Sets that share too few with other
    classes go first (:func:`_enough`). Sets that share one with over GROUP sets get
    another prefix, by exact counts among such sets (:func:`_reordered`): most of them then meet few or none. Where still over GROUP sets share one, each is
    first compared with a centre (:func:`_around`), which grows with the group and not with its square; what is unlike it goes on to another one.
    Only what ROUNDS centres of a shingle leave over is compared pair by pair as well, so no pair is left out: an alike pair shares a shingle
    of at most GROUP sets in the first order, or both its sets have a prefix in the second one, where again they share a shingle.
    """
    tokens = _enough(_met(nodes.select("id", "class", "size", F.posexplode("prefix").alias("pos", "token"))))
    direct, rest, edges, found = tokens.where(F.col("n") <= GROUP).withColumn("turn", F.lit(1)), tokens.where(F.col("n") > GROUP), [], []
    if not rest.isEmpty():
        many = materialize(rest.select("id", "class", "size").distinct())
        sets = _whole(rows, many, width)
        tokens = _enough(_met(_reordered(many, sets)))
        direct, rest = direct.unionByName(tokens.where(F.col("n") <= GROUP).withColumn("turn", F.lit(2))), tokens.where(F.col("n") > GROUP)
    for _ in range(ROUNDS):
        if rest.isEmpty():
            break
        lead = rest.groupBy("id").agg(F.min("pos").alias("lead"))  # few rare shingles: near the middle, and chosen for most of its shingles
        centre = rest.join(lead, "id").groupBy("token").agg(F.min(F.struct("lead", "id", "class", "size")).alias("c"))
        led = rest.join(centre, "token").withColumn("centre", F.col("c.id")).withColumn("class_c", F.col("c.class")).withColumn("size_c", F.col("c.size"))
        led = materialize(led.drop("c", "n"))
        told, pairs, close = _around(led.drop("token", "pos"), sets)
        edges.append(materialize(told.distinct()))
        found.append(materialize(pairs.distinct()))
        again = _met(led.where("id != centre").join(close, ["id", "centre"], "left_anti").drop("centre", "class_c", "size_c"))
        direct, rest = direct.unionByName(again.where(F.col("n") <= GROUP).withColumn("turn", F.lit(2))), again.where(F.col("n") > GROUP)
    x, y = _sides(direct.unionByName(rest.withColumn("turn", F.lit(2))).drop("n"), ["token", "turn"])
    need = (F.col("size_x") + F.col("size_y")) * PART  # of shared shingles, times PART + WHOLE
    fit = F.least("size_x", "size_y") * WHOLE >= F.greatest("size_x", "size_y") * PART
    pairs = x.join(y, ["token", "turn"]).where(F.expr("id_x < id_y and class_x != class_y") & fit)
    from_here = F.max(F.least(F.expr("size_x - pos_x"), F.expr("size_y - pos_y"))).alias("from_here")  # from the first shared place on
    pairs = pairs.groupBy("turn", "id_x", "id_y", "class_x", "class_y", "size_x", "size_y").agg(F.count("*").alias("n"), from_here)
    behind = [F.expr(f"({PART} * {c} + {WHOLE - 1}) div {WHOLE} - 1 - {c} div {MORE}") for c in ("size_x", "size_y")]  # one of the prefixes ends first: what is shared after that is behind it
    most = F.least("from_here", F.col("n") + F.greatest(*behind))  # too low only for pairs that also share a shingle told in the second order or around a centre
    pairs = pairs.where(most * (PART + WHOLE) >= need).select("id_x", "id_y", "class_x", "class_y")
    none = pairs.sparkSession.createDataFrame([], "a bigint, b bigint")
    return reduce(DataFrame.unionByName, edges, none), materialize(reduce(DataFrame.unionByName, found, pairs).distinct())


def alike(docs: DataFrame, classes: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Edges ``(a, b)`` between classes of documents that join the classes as all alike documents of theirs would.

    ``classes`` has ``(id, class)`` for each id. Equal sets are one node. What :func:`compared` finds is told by whole sets, made anew from
    the texts of these documents only. A frequent shingle meets others only in texts of which over 4 of 5 shingles are as frequent.
    """
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    sets = materialize(prefixes(rows, width).join(classes, "id"))
    equal = sets.groupBy("digest").agg(F.min(F.struct("id", "class")).alias("least"))
    same = sets.join(equal, "digest").select(F.col("class").alias("a"), F.col("least.class").alias("b")).where("a != b")
    nodes = sets.join(equal.select(F.col("least.id").alias("id"), "digest"), ["id", "digest"])
    edges, pairs = compared(nodes, rows, width)
    whole = _whole(rows, pairs.select(F.explode(F.array("id_x", "id_y")).alias("id")), width)
    side = lambda s: whole.select(F.col("id").alias(f"id_{s}"), F.col("tokens").alias(f"tokens_{s}"))
    both = pairs.join(side("x"), "id_x").join(side("y"), "id_y").withColumn("shared", F.size(F.array_intersect("tokens_x", "tokens_y")))
    told = both.where(F.col("shared") * (PART + WHOLE) >= (F.size("tokens_x") + F.size("tokens_y")) * PART)
    return same.unionByName(edges).unionByName(told.select(F.col("class_x").alias("a"), F.col("class_y").alias("b"))).distinct()


def joined_classes(docs: DataFrame, found: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``found``, rows of ``(id, component_id)`` and more, with the components joined that hold documents alike by 0.8 or more."""
    classes = found.where("id is not null").groupBy("id").agg(F.min("component_id").alias("class"))
    comp = connected_components(alike(docs, classes, width, id_col, text_col), "a", "b").select(F.col("node").alias("component_id"), "component")
    return found.join(comp, "component_id", "left").withColumn("component_id", F.coalesce("component", "component_id")).select(*found.columns)
