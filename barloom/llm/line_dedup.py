"""Line deduplication by pairwise alignment of overlapping documents."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places of two sequences by patience diff.

    Values that occur once in each are matched in their longest increasing order;
    between matches the same is done again, and equal neighbours of a match join it.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        lo, hi, lo2, hi2 = todo.pop()
        while lo < hi and lo2 < hi2 and a[lo] == b[lo2]:
            out.append((lo, lo2))
            lo, lo2 = lo + 1, lo2 + 1
        while lo < hi and lo2 < hi2 and a[hi - 1] == b[hi2 - 1]:
            hi, hi2 = hi - 1, hi2 - 1
            out.append((hi, hi2))
        if lo >= hi or lo2 >= hi2:
            continue
        once = {x for x, n in Counter(a[lo:hi]).items() if n == 1}
        at = {x: k for k, x in enumerate(b[lo2:hi2], lo2)}
        n2 = Counter(b[lo2:hi2])
        pairs = [(k, at[x]) for k, x in enumerate(a[lo:hi], lo) if x in once and n2[x] == 1]
        tops: list[int] = []  # longest increasing run of the second places
        last: list[int] = []
        back: list[int] = []
        for k, (_, y) in enumerate(pairs):
            d = bisect_left(tops, y)
            back.append(last[d - 1] if d else -1)
            tops[d : d + 1], last[d : d + 1] = [y], [k]
        k, chain = last[-1] if last else -1, []
        while k >= 0:
            chain.append(pairs[k])
            k = back[k]
        for x, y in reversed(chain):
            if x < lo or y < lo2:
                continue
            todo.append((lo, x, lo2, y))
            lo, lo2 = x, y
            while lo < hi and lo2 < hi2 and a[lo] == b[lo2]:
                out.append((lo, lo2))
                lo, lo2 = lo + 1, lo2 + 1
        if chain:
            todo.append((lo, hi, lo2, hi2))
    return sorted(out)


def runs(h: list[int], n: list[int], least: int) -> list[tuple[int, int, int]]:
    """``(start, end, hash)`` of the shortest runs of lines with ``least`` characters, from each line on and back from each.

    Every line of a block of ``least`` or more characters lies in a run within the
    block, so two documents that share the block share runs that cover it.
    """
    raw, size = np.asarray(h, np.int64).tobytes(), np.asarray(n, np.int64)
    total = np.concatenate(([0], np.cumsum(size)))
    on = np.searchsorted(total, total[:-1] + least)
    back = np.searchsorted(total, total[1:] - least, side="right") - 1
    places = np.arange(len(size))
    found = {(x, y) for x, y, ok in zip(places.tolist(), on.tolist(), on <= len(size)) if ok}
    found |= {(x, y + 1) for x, y, ok in zip(back.tolist(), places.tolist(), back >= 0) if ok}
    return [(x, y, xxhash.xxh64_intdigest(raw[8 * x : 8 * y]) - (1 << 63)) for x, y in sorted(found)]


#: Alignments of a pair in which runs that cross are told apart; what is left then is aligned run by run.
ROUNDS = 16


def _seeds(least: int):
    """Per document the distinct hashes of its runs, with the place of the first line of each."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 100):
                part = b.slice(at, 100)
                found = [{x: k for k, _, x in reversed(runs(h, n, least))} for h, n in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                rows = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
                seeds, places = pa.array([x for xs in found for x in xs], pa.int64()), pa.array([k for xs in found for k in xs.values()], pa.int32())
                yield pa.record_batch([part.column(0).take(rows), part.column(1).take(rows), seeds, places], ["id", "tag", "seed", "at"])

    return run


def aligned(early: list[int], late: list[int]) -> set[int]:
    """The values of ``late`` that alignment with ``early`` finds; both without repeats.

    A patience diff finds what stands in one order; what crosses it is aligned in further rounds.
    """
    found: set[int] = set()
    for _ in range(ROUNDS):
        pairs = patience(early, late)
        if not pairs:
            return found
        found.update(late[y] for _, y in pairs)
        early, late = [x for x in early if x not in found], [x for x in late if x not in found]
    left = set(late)
    return found | {x for x in early if x in left}


def _aligned(least: int):
    """Per document the places of its lines in blocks aligned with an earlier one, and the number of those it was aligned with.

    ``shared`` has for every run that an earlier document holds first that document and the run's place in it.
    """

    def run(batches):
        for b in batches:
            found, partners = [], []
            for lines, sizes, shared in zip(*(c.to_pylist() for c in b.columns[2:])):
                mine, pairs, places = runs(lines, sizes, least), {}, set()
                for x in shared:
                    pairs.setdefault((x["id"], x["tag"]), []).append((x["at"], x["seed"]))
                for of in pairs.values():
                    early = [x for _, x in sorted(of)]
                    here = set(early)
                    took = aligned(early, list(dict.fromkeys(x for _, _, x in mine if x in here)))
                    # A block aligned once is gone wherever it stands in this document.
                    places.update(k for x, y, r in mine if r in took for k in range(x, y))
                found.append(sorted(places))
                partners.append(len(pairs))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int32())), pa.array(partners, pa.int64())], ["id", "tag", "removed", "partners"])

    return run


def dedup_lines(
    docs: DataFrame, least_chars: int = 40, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``(id, n_lines, removed array<int>, kept string, partners long)``.

    Lines are what stands between ``\\n``, compared after trimming. A line is removed
    if it lies in a block of lines in a row, of at least ``least_chars`` characters,
    that stands in a document with a smaller id. Seeds are hashes of the shortest runs
    of lines of that length, whatever their frequency. Each seed links a document to
    the first document (by id) that holds it, never to all: the links are as many as
    the seeds, without a cap on partners, and a link carries the seed and its place in that document, not
    that document's lines. Every linked pair is aligned by patience diff over its shared runs, blocks that cross
    in further rounds, so each seed is settled with its first holder and no further holder can add a line.
    ``removed`` has the places of the removed lines, ``kept`` the other lines.

    Lines are hashed once; only hashes are shuffled until the kept lines are cut from
    the text at the end. Links are counted and reduced to the first holder before the
    shuffle, and joins are ones that Spark may split where a first document is hot.
    Defined cases: a null text counts as empty (one empty line); a null id is not
    compared and stays whole; equal ids with different texts are not compared with
    each other; repeated rows have the same result; an empty table gives no rows;
    other columns are ignored; texts of any length are taken whole. Ids are whole numbers.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.select("id", "t", F.xxhash64("t").alias("tag"))
    line = F.transform(F.split("t", "\n", -1), lambda x: F.trim(x))
    lean = rows.where("id is not null").select(
        "id", "tag", F.transform(line, lambda x: F.xxhash64(x)).alias("h"), F.transform(line, lambda x: F.length(x)).alias("n")
    )
    seeds = materialize(lean.mapInArrow(_seeds(least_chars), f"id {rows.schema['id'].dataType.simpleString()}, tag long, seed long, at int"))
    firsts = materialize(seeds.groupBy("seed").agg(F.min(F.struct("id", "tag", "at")).alias("first"), F.count("*").alias("df")).where("df > 1").drop("df"))
    links = seeds.drop("at").join(firsts, "seed").where("first.id < id").distinct()
    shared = links.groupBy("id", "tag").agg(F.collect_list(F.struct(F.col("first.id").cast("long").alias("id"), "first.tag", "first.at", "seed")).alias("shared"))
    pairs = shared.join(lean.dropDuplicates(["id", "tag"]), ["id", "tag"]).select(F.col("id").cast("long"), "tag", "h", "n", "shared")
    gone = pairs.mapInArrow(_aligned(least_chars), "id long, tag long, removed array<int>, partners long")
    none = F.array().cast("array<int>")
    out = rows.join(gone, ["id", "tag"], "left")
    lines = F.split("t", "\n", -1)
    removed = F.coalesce("removed", none)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
    kept = F.transform(stay, lambda k: F.get(F.col("lines"), k))
    return out.withColumn("lines", lines).select(
        "id", F.size(lines).cast("long").alias("n_lines"), removed.alias("removed"), F.when(F.size(removed) == 0, F.col("t")).otherwise(F.array_join(kept, "\n")).alias("kept"), F.coalesce("partners", F.lit(0)).cast("long").alias("partners")
    )
