"""Hard negatives by exact integer inner products of tiles of anchors and candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialize

#: Rows of a tile on average: so many anchors by so many candidates.
ANCHORS, CANDIDATES = 512, 4096
#: Below this side a product is taken directly.
LEAF = 64
#: Scores stay below this, so that a hundred times one fits 64 bits.
LARGEST = (1 << 63) // 100


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices by Strassen's seven products, exact.

    Odd sides get a row or column of zeros at each level; sides below ``leaf`` are multiplied directly. Sums
    may wrap around 2**64 on the way, which leaves a result that fits int64 exact.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) < max(leaf, 2):
        return a @ b
    a = np.pad(a, ((0, m & 1), (0, k & 1)))
    b = np.pad(b, ((0, k & 1), (0, n & 1)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    p1, p2, p3 = strassen(a11 + a22, b11 + b22, leaf), strassen(a21 + a22, b11, leaf), strassen(a11, b12 - b22, leaf)
    p4, p5 = strassen(a22, b21 - b11, leaf), strassen(a11 + a12, b22, leaf)
    p6, p7 = strassen(a21 - a11, b11 + b12, leaf), strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * t), np.int64)
    out[:r, :t], out[:r, t:] = p1 + p4 - p5 + p7, p3 + p5
    out[r:, :t], out[r:, t:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def quantized(vectors: DataFrame, label: str, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``(id, label, v)``: distinct rows with an id, a label and a vector of finite numbers, each component
    as the whole number floor(scale * x); ``label`` is an SQL expression for the label."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.expr(label).cast("long").alias("label"), v.alias("v"))
    whole = "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    rows = rows.where(f"id is not null and label is not null and v is not null and {whole}")
    return rows.withColumn("v", F.expr(f"transform(v, x -> floor({scale} * x))")).distinct()


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """The lists as rows of one matrix, short ones filled up with zeros."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = values.value_lengths().to_numpy(zero_copy_only=False)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _scores(anchors: pa.Table, rows: pa.Table) -> tuple:
    """Scores of a tile, candidates by id, with their ids, labels, and which of them have the anchor's length."""
    rows = rows.sort_by("id")
    sizes = [np.asarray(pa.compute.list_value_length(t["v"])) for t in (anchors, rows)]
    width = int(max(sizes[0].max(), sizes[1].max(), 1))
    a, b = _matrix(anchors["v"], width), _matrix(rows["v"], width)
    bound = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * width
    if bound >= LARGEST:
        raise ValueError("components are too large for exact scores in 64 bits")
    alike = None if (sizes[0][0] == sizes[0]).all() and (sizes[1] == sizes[0][0]).all() else sizes[0][:, None] == sizes[1]
    return strassen(a, np.ascontiguousarray(b.T)), rows["id"].to_numpy(), rows["label"].to_numpy(), alike


def _tiles(anchors: DataFrame, rows: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the number of every tile in which they meet: blocks of anchors by blocks of candidates, chosen
    by hash of the id; ``sizes`` has the number of both in every part."""
    blocks = materialize(sizes.select("part", *(F.expr(f"cast((n_{s} + {most - 1}) div {most} as int) as {s}_blocks") for s, most in (("a", ANCHORS), ("r", CANDIDATES)))))
    block, every = "cast(pmod(xxhash64(id, {}), {}_blocks) as int)", "explode(sequence(0, {}_blocks - 1))"
    a = anchors.join(blocks, "part").withColumn("a", F.expr(block.format(1, "a"))).withColumn("r", F.expr(every.format("r")))
    r = rows.join(blocks, "part").withColumn("r", F.expr(block.format(2, "r"))).withColumn("a", F.expr(every.format("a")))
    return a.drop("a_blocks", "r_blocks"), r.drop("a_blocks", "r_blocks")


def _counted(anchors: DataFrame, rows: DataFrame) -> DataFrame:
    """``(part, n_a, n_r)`` of the parts in which there are both."""
    n = [x.groupBy("part").agg(F.count("*").alias(c)) for x, c in ((anchors, "n_a"), (rows, "n_r"))]
    return n[0].join(n[1], "part")


def _met(anchors: DataFrame, rows: DataFrame, run, schema: str) -> DataFrame:
    keys = ["part", "a", "r"]
    return anchors.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(run, schema)


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of every key by score, ties by id: heaps of single tiles merged, partly before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def _positives(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = ([], [], [])
        if len(anchors) and len(rows):
            score, ids, _, alike = _scores(anchors, rows)
            for i, own in enumerate(anchors["id"].to_pylist()):
                take = np.flatnonzero(ids != own if alike is None else (ids != own) & alike[i])
                s = score[i, take]
                if len(take) > k:  # those that reach the kth score; ties beyond it go by the stable order of ids
                    near = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                    take, s = take[near], s[near]
                first = np.argsort(-s, kind="stable")[:k]
                out[0].append(np.full(len(first), own))
                out[1].append(ids[take[first]])
                out[2].append(s[first])
        flat = [np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in out]
        return pa.table(flat, ["anchor", "id", "score"])

    return run


def _negatives(k: int, low: int, high: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = ([], [], [], [], [])
        if len(anchors) and len(rows):
            score, ids, labels, alike = _scores(anchors, rows)
            kinds, asked = anchors["label"].to_pylist(), anchors["asked"].to_pylist()
            for i, own in enumerate(anchors["id"].to_pylist()):
                other = labels != kinds[i] if alike is None else (labels != kinds[i]) & alike[i]
                s100 = score[i] * 100
                top = max(high * p["score"] for p in asked[i])
                bottom = min(low * p["score"] for p in asked[i])
                take = np.flatnonzero(other & (s100 <= top) & (s100 >= bottom))
                take = take[np.argsort(-s100[take], kind="stable")]
                s = -s100[take]
                for p in asked[i]:
                    start, end = np.searchsorted(s, -high * p["score"], "left"), np.searchsorted(s, -low * p["score"], "right")
                    first = take[start : max(start, min(end, start + k))]
                    out[0].append(np.full(len(first), own))
                    out[1].append(np.full(len(first), p["id"]))
                    out[2].append(np.full(len(first), p["score"]))
                    out[3].append(ids[first])
                    out[4].append(score[i, first])
        flat = [np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in out]
        return pa.table(flat, ["anchor", "positive", "positive_score", "id", "score"])

    return run


def mine_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` and ``anchors`` are ``(id, label, v)`` as :func:`quantized` makes them. Scores are integer inner products,
    higher ones first, ties by smaller id. An anchor's positives are the first ``positives`` other rows of its label;
    for each, the first ``negatives`` rows of other labels with ``low``% to ``high``% of its score are returned.

    Anchors and candidates are cut into blocks by hash; two blocks meet in one task, whose memory a tile bounds.
    First only blocks of one label meet, and every tile gives each anchor's best; merged, these set the
    windows in which the second pass looks, over all labels. Nothing is approximate, no row is left out.

    Defined cases: an anchor without other rows of its label, or without rows in a window, gives no row, as does a
    negative positive score, whose window is empty; vectors of other lengths than the anchor's are not
    compared; an id that stands with several vectors counts once for each, and an anchor never meets its own id; scores
    that might not fit are an error; empty tables give no rows; other columns are ignored.
    """
    bounded_batches(rows.sparkSession)
    rows, anchors = materialize(rows.select("id", "label", "v")), materialize(anchors.select("id", "label", "v"))
    of_label = [x.withColumn("part", F.col("label")) for x in (anchors, rows)]
    near = _met(*_tiles(*of_label, _counted(*of_label)), _positives(positives), "anchor long, id long, score long")
    windows = materialize(_best(near, ["anchor"], positives))
    asked = windows.groupBy("anchor").agg(F.array_sort(F.collect_set(F.struct("id", "score"))).alias("asked"))
    ready = materialize(anchors.join(asked.withColumnRenamed("anchor", "id"), "id"))
    whole = [x.withColumn("part", F.lit(0).cast("long")) for x in (ready, rows)]
    far = _met(*_tiles(*whole, _counted(*whole)), _negatives(negatives, low, high), "anchor long, positive long, positive_score long, id long, score long")
    return _best(far, ["anchor", "positive", "positive_score"], negatives).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
