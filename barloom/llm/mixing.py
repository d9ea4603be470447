"""Mixing overlapping sources to target weights by min-cost flow."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, drop_table, materialize, ranked
from .graph import connected_components

#: Ranges into which each pattern's seeded order is cut to find where a quota ends.
BINS = 4096
#: Rows up to which a table of patterns or sources, whose rows have been counted, is broadcast.
SMALL = 20_000


def water_fill(sizes: dict, weights: dict, total: float, ceiling: float = 2.0) -> dict:
    """Targets that share ``total`` by weight; none above ``ceiling`` times its size, the excess reshared by weight."""
    fixed: dict = {}
    while True:
        free = [s for s in sizes if s not in fixed]
        left = total - sum(fixed[s] for s in sizes if s in fixed)
        whole = sum(weights[s] for s in free)
        share = {s: left * weights[s] / whole for s in free} if whole else {}
        above = [s for s in free if share[s] > ceiling * sizes[s]]
        if not above:
            return {s: float(fixed[s] if s in fixed else share.get(s, 0.0)) for s in sizes}
        fixed |= {s: ceiling * sizes[s] for s in above}


def min_cost_flow(supply: dict, quota: dict, member: dict, costs: list[int]) -> dict:
    """Words that each pattern gives to each source: ``(pattern, source) -> words``.

    ``member[pattern]`` names its sources. A pattern gives its words once at
    ``costs[0]`` a word, once more at ``costs[1]``, and so on; the costs rise, so a
    second repetition is used only where no first one can be routed. Successive
    shortest paths over whole words fill as much of the quotas as can be filled, at
    least cost. The graph has a node per pattern and per source, never per document.
    """
    names = ["s", *(("p", p) for p in supply), *(("q", q) for q in quota), "t"]
    node = {x: i for i, x in enumerate(names)}
    edges, out = [], [[] for _ in names]  # an edge is [to, room, cost]; its reverse is at index ^ 1

    def add(a, b, room, cost):
        for u, v, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            out[node[u]].append(len(edges))
            edges.append([node[v], r, c])

    for p, n in supply.items():
        for c in costs:
            add("s", ("p", p), n, c)
    inner = {}
    for p in supply:
        for q in member[p]:
            inner[p, q] = len(edges)
            add(("p", p), ("q", q), supply[p] * len(costs), 0)
    for q, n in quota.items():
        add(("q", q), "t", n, 0)
    height = [0] * len(names)
    while True:
        far, via, heap = [float("inf")] * len(names), [-1] * len(names), [(0, node["s"])]
        far[node["s"]] = 0
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for k in out[u]:
                v, room, cost = edges[k]
                if room and d + cost + height[u] - height[v] < far[v]:
                    far[v], via[v] = d + cost + height[u] - height[v], k
                    heapq.heappush(heap, (far[v], v))
        if far[node["t"]] == float("inf"):
            return {pq: edges[k ^ 1][1] for pq, k in inner.items()}
        height = [h + min(d, far[node["t"]]) for h, d in zip(height, far)]
        path, v = [], node["t"]
        while v != node["s"]:
            path.append(via[v])
            v = edges[via[v] ^ 1][0]
        push = min(edges[k][1] for k in path)
        for k in path:
            edges[k][1] -= push
            edges[k ^ 1][1] += push


def source_targets(sizes: dict, weight_cycle: tuple[float, ...], total: float, ceiling: float) -> dict:
    """Targets of a short list of sources in code-point order, null last, with the weights of the cycle in turn."""
    names = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weights = {s: weight_cycle[k % len(weight_cycle)] for k, s in enumerate(names)}
    return water_fill({s: sizes[s] for s in names}, weights, total, ceiling)


def target_table(sizes: DataFrame, weight_cycle: tuple[float, ...], total: float, ceiling: float) -> DataFrame:
    """``sizes`` (``source, size``) with ``no``, the place in code-point order, null last, and ``target``: :func:`source_targets`
    of any number of sources. A round reads two sums; the sources stay in Spark."""
    placed = ranked(sizes.select(F.lit(0).alias("all"), F.col("source").isNull().alias("last"), "source", "size"), "all", ["last", "source"])
    weights = F.array(*[F.lit(float(w)) for w in weight_cycle])
    rows = placed.select("source", "size", F.col("lo").alias("no"), F.get(weights, (F.col("lo") % len(weight_cycle)).cast("int")).alias("weight"), F.lit(None).cast("double").alias("fixed"))
    rows = materialize(rows)
    while True:
        used, whole = rows.agg(F.coalesce(F.sum("fixed"), F.lit(0.0)), F.sum(F.when(F.col("fixed").isNull(), F.col("weight")))).first()
        share = F.lit((total - used) if whole else 0.0) * F.col("weight") / F.lit(whole or 1.0)
        above = F.col("fixed").isNull() & (share > ceiling * F.col("size"))
        if rows.where(above).isEmpty():
            return rows.select("source", "size", "no", F.coalesce("fixed", share).alias("target"))
        old, rows = rows, materialize(rows.withColumn("fixed", F.when(above, ceiling * F.col("size")).otherwise(F.col("fixed"))))
        drop_table(old)


def routed(patterns: DataFrame, plan: DataFrame, repeats: int) -> DataFrame:
    """``(_mix_p, words, give)``: the words that every pattern gives.

    A pattern (``_mix_p, words, sources``) whose source is in no other one gives what the source asks for. Sources that share
    patterns are a component, and each component's flow is routed in a task of its own, patterns in order of name.
    """
    of = patterns.select("_mix_p", "words", F.explode("sources").alias("s")).join(plan.select(F.col("source").alias("of"), "no", "target"), F.col("s").eqNullSafe(F.col("of")))
    of = materialize(of.select("_mix_p", "words", "no", F.round("target").cast("long").alias("quota"), F.min("no").over(Window.partitionBy("_mix_p")).alias("low")))
    found = connected_components(of.where("low != no").select("low", "no"), "low", "no")
    of = of.join(found, of["no"] == found["node"], "left").drop("node")
    alone = of.where("component is null").select("_mix_p", "words", F.least(F.col("quota"), F.lit(repeats) * F.col("words")).alias("give"))

    def route(g):
        g = g.sort_values(["_mix_p", "no"])
        supply = {p: int(n) for p, n in zip(g["_mix_p"], g["words"])}
        quota = {int(q): int(n) for q, n in zip(g["no"], g["quota"])}
        member: dict = {}
        for p, q in zip(g["_mix_p"], g["no"]):
            member.setdefault(p, []).append(int(q))
        flow = min_cost_flow(supply, quota, member, list(range(repeats)))
        return pd.DataFrame([(p, supply[p], sum(flow[p, q] for q in member[p])) for p in supply], columns=["_mix_p", "words", "give"])

    shared = of.where("component is not null").select("component", "_mix_p", "words", "no", "quota")
    return alone.unionByName(shared.groupBy("component").applyInPandas(route, "_mix_p string, words long, give long"))


def mix(
    docs: DataFrame,
    sources: Column,
    weight_cycle: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    added: tuple[str, str] = ("mix_size", "mix_copies"),
) -> tuple[DataFrame, DataFrame]:
    """``(rows, plan)``: ``docs`` with ``mix_size`` and ``mix_copies`` (or other names); ``(source, size, target)`` of every source.

    ``sources`` gives the array of a row's sources as strings; null is a source of
    its own. A size is a number of words. The sources share ``share`` times all
    words by weight; no target exceeds ``repeats`` times its source's size.
    Documents are aggregated by their set of sources (pattern), and a min-cost flow routes the patterns' words to the sources'
    quotas, at costs that rise by repetition: by components of sources that share patterns, of which a task holds one, a figure
    of the source catalogue and not of the documents. Each pattern then gives whole documents in a
    seeded order until its flow is met; ``mix_copies`` (0 to ``repeats``) says how
    often each. A pattern ends within half a place of its flow.

    The order is by hash; where in it a flow ends is found from sums over BINS ranges and then in that one range
    from hashes and sizes alone, so a hot source is never sorted as a whole and no text is moved. Defined
    cases: null and wordless texts have size zero; a null id has its place in the order by its text; rows that repeat id
    and text share a place and all go in or not; texts of any length are counted whole; an empty table gives no rows
    and no sources, a row without sources has no copies; the other columns pass, whatever their names, but for the
    two that are added, which are an error.
    """
    taken = {c.lower() for c in added} & {c.lower() for c in docs.columns}
    if taken:
        raise ValueError(f"columns that the mix adds are there already: {sorted(taken)}")
    pattern = F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>"))))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    place = F.struct(*[F.xxhash64(F.lit(k), F.col(id_col), F.col(text_col)).alias(f"h{k}") for k in (seed, seed + 1)])
    rows = docs.select(F.struct(*docs.columns).alias("row"), size.alias("mix_size"), F.to_json(pattern).alias("_mix_p"), pattern.alias("sources"), place.alias("place"))
    bin_ = F.shiftrightunsigned(F.col("place")[f"h{seed}"], 64 - BINS.bit_length() + 1).cast("int")
    keys = materialize(rows.select("_mix_p", "sources", "place", bin_.alias("bin"), "mix_size"))
    bins = materialize(keys.groupBy("_mix_p", "bin").agg(F.sum("mix_size").alias("words"), F.first("sources").alias("sources")))
    patterns = materialize(bins.groupBy("_mix_p").agg(F.sum("words").alias("words"), F.first("sources").alias("sources")))
    sizes = patterns.select("words", F.explode("sources").alias("source")).groupBy("source").agg(F.sum("words").alias("size"))
    total = share * (patterns.agg(F.sum("words")).first()[0] or 0)
    plan = materialize(target_table(sizes, weight_cycle, total, repeats))
    give = patterns.select("_mix_p", "words").join(routed(patterns, plan, repeats).select("_mix_p", "give"), "_mix_p", "left").fillna(0, ["give"])
    give = materialize(give)

    full = F.when(F.col("words") > 0, F.least(F.lit(repeats), F.expr("cast(give div words as int)"))).otherwise(0)
    give = give.withColumn("full", full).select("_mix_p", "full", (F.col("give") - F.col("full") * F.col("words")).alias("rest"))
    upto = Window.partitionBy("_mix_p").orderBy("bin")
    ends = bins.select("_mix_p", "bin", "words").join(give, "_mix_p").withColumn("upto", F.sum("words").over(upto)).where("rest > upto - words and rest <= upto")
    ends = materialize(ends.groupBy("_mix_p").agg(F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"), "rest")).alias("e")).select("_mix_p", "e.*"))
    border = keys.join(ends, ["_mix_p", "bin"]).groupBy("_mix_p", "place").agg(F.sum("mix_size").alias("words"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    so_far = F.sum("words").over(Window.partitionBy("_mix_p").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    inside = F.col("before") + F.coalesce(so_far, F.lit(0)) + F.col("words") / 2 <= F.col("rest")
    last = border.withColumn("inside", inside).where("inside").groupBy("_mix_p").agg(F.max("place").alias("last"))
    cuts = give.join(ends.select("_mix_p", F.col("bin").alias("cut")), "_mix_p", "left").join(last, "_mix_p", "left").select("_mix_p", "full", "cut", "last")
    cuts = materialize(cuts)
    small = cuts.count() <= SMALL
    known = rows.withColumn("bin", bin_).join(F.broadcast(cuts) if small else cuts, "_mix_p")
    more = F.coalesce((F.col("bin") < F.col("cut")) | ((F.col("bin") == F.col("cut")) & (F.col("place") <= F.col("last"))), F.lit(False))
    found = known.select("row.*", F.col("mix_size").alias(added[0]), (F.col("full") + more.cast("int")).alias(added[1]))
    plan = plan.select("source", "size", "target")
    return found, F.broadcast(plan) if small and plan.count() <= SMALL else plan
