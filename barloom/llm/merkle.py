"""A Merkle manifest of a dataset, its tree kept as nested intervals of leaf ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ranked

#: Children of a node.
FANOUT = 8


def _field(name: str | Column) -> Column:
    value = (F.col(name) if isinstance(name, str) else name).cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(*fields: str | Column) -> Column:
    """SHA-256 over the fields, each as its UTF-8 byte count, a colon and its text, ``-`` if null: no two rows give one input."""
    return F.sha2(F.concat(*map(_field, fields)).cast("binary"), 256)


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    """The nodes one level up, ``(tree, level, lo, hi, n, digest, kids)``, of all trees that hold more than one."""
    span = FANOUT**level
    kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest")))
    up = nodes.where("n > 1").groupBy("tree", F.expr(f"lo div {span}").alias("bucket")).agg(kids.alias("kids"), F.first("n").alias("n"))
    return up.select(
        "tree", F.lit(level).alias("level"), F.expr("kids[0].lo").alias("lo"), F.expr("element_at(kids, -1).hi").alias("hi"),
        F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"),
        F.sha2(F.array_join(F.col("kids.digest"), "").cast("binary"), 256).alias("digest"), "kids",
    )


def _grown(leaves: DataFrame) -> list[DataFrame]:
    """The levels above ``leaves`` (``tree, lo, hi, n, digest``), each written; the last of a tree has ``n`` one."""
    nodes, levels = leaves.select("tree", "lo", "hi", "n", "digest"), []
    most = leaves.agg(F.max("n")).first()[0] or 0
    while FANOUT ** len(levels) < most:
        nodes = materialize(_parents(nodes, len(levels) + 1))
        levels.append(nodes)
    return levels


def _attached(nodes: DataFrame, above: DataFrame, level: int) -> DataFrame:
    """``nodes`` with ``path``: the siblings beside each node and beside its ancestors, bottom up, by left and right.

    ``above`` holds the nodes of ``level`` with their children, paths and subroot. A node joins the one that contains
    its interval, in the bucket that this level's span makes of its rank; what that one holds beside the node's own
    interval are its siblings.
    """
    bucket = F.expr(f"lo div {FANOUT**level}")
    a = above.select(F.col("tree").alias("a_tree"), bucket.alias("bucket"), F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"), F.col("kids").alias("around"), F.col("path").alias("beyond"), "subroot")
    inside = (F.col("tree") == F.col("a_tree")) & (bucket == F.col("bucket")) & (F.col("a_lo") <= F.col("lo")) & (F.col("hi") <= F.col("a_hi"))
    side = "array_join(transform(filter(around, k -> {}), k -> k.digest), '') as {}"
    beside = F.expr(f"array(struct({side.format('k.hi < lo', 'left')}, {side.format('k.lo > hi', 'right')}))")
    return nodes.join(a, inside).withColumn("path", F.concat(beside, "beyond")).drop("a_tree", "bucket", "a_lo", "a_hi", "around", "beyond")


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The nodes of the first level with their paths; ``tops`` has ``(tree, path, subroot)`` for the root of each tree."""
    below = None
    for level in range(len(levels), 0, -1):
        nodes = levels[level - 1].where("n = 1").join(tops, "tree")
        if below is not None:
            nodes = nodes.unionByName(_attached(levels[level - 1].where("n > 1"), below, level + 1))
        below = materialize(nodes)
    return below


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its way up."""
    return F.aggregate(path, leaf, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 over all siblings on the way up, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", tree_col: str = "lang", changed: dict | None = None, when: Column | None = None) -> DataFrame:
    """One row per input row: ``(id, leaf, changed_leaf, subroot, root, path)``.

    ``leaf`` is the digest of the row's ``fields``; ``changed_leaf`` is that with the columns of ``changed`` in place of
    fields, where ``when`` holds, else ``leaf``. The leaves of one value of ``tree_col`` stand in order of id, every
    FANOUT consecutive nodes (fewer at the end) become one until one is left, the subroot; subroots in
    order of that value (null first, then by UTF-8 bytes) give the root likewise. ``path`` lists the siblings of
    the leaf and of every ancestor, bottom up, as the digests to the left and to the right.

    Texts are read once and leave only digests. A node is labelled by the interval of leaf ranks that it covers;
    ancestors are attached from the top by joins on the bucket of the level and containment, so that paths
    are carried by an eighth of the rows at most until the last join.

    Defined cases: a null id stands before all others; rows that repeat an id stand in order of their leaves; a null
    tree value is a tree of its own; null fields and empty texts differ; texts of any length are hashed whole; a
    tree of one leaf has that as its subroot, a table of one tree the subroot as its root, and siblings are
    then none; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    other = [(changed or {}).get(f, f) for f in fields]
    mark = F.lit(False) if when is None else F.coalesce(when, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.col(tree_col).alias("value"), leaf_digest(*fields).alias("digest"), F.when(mark, leaf_digest(*other)).alias("changed"))
    placed = ranked(rows, "value", ["id", "digest"], numbered=True)
    leaves = materialize(placed.select(F.col("tree_no").alias("tree"), "lo", F.col("lo").alias("hi"), "n", "id", "digest", "changed"))
    levels = _grown(leaves)
    roots = leaves.where("n = 1").select("tree", "digest")
    for nodes in levels:
        roots = roots.unionByName(nodes.where("n = 1").select("tree", "digest"))
    size = F.lit(roots.count()).cast("long")
    subroots = materialize(roots.select(F.lit(0).alias("tree"), F.col("tree").alias("lo"), F.col("tree").alias("hi"), size.alias("n"), "digest"))
    upper = _grown(subroots)
    root = (upper[-1] if upper else subroots).select("digest").first()  # one row
    nowhere = F.expr("cast(array() as array<struct<left:string,right:string>>)")
    start = docs.sparkSession.range(1).select(F.lit(0).alias("tree"), nowhere.alias("path"), F.lit("").alias("subroot"))
    tops = _attached(subroots, _paths(upper, start), 1).drop("subroot", "tree") if upper else subroots.withColumn("path", nowhere)
    tops = materialize(tops.select(F.col("lo").alias("tree"), "path", F.col("digest").alias("subroot")))
    found = leaves.where("n = 1").join(tops, "tree")
    if levels:
        found = found.unionByName(_attached(leaves.where("n > 1"), _paths(levels, tops), 1))
    root = F.lit(root[0] if root else None).cast("string")
    return found.select("id", F.col("digest").alias("leaf"), F.coalesce("changed", "digest").alias("changed_leaf"), "subroot", root.alias("root"), "path")
