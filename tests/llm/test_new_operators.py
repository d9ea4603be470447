"""Operators 11 to 13 against brute-force versions with nulls, empties, ties, repeats, odd columns and small blocks."""

import hashlib
import random
import zlib
from collections import defaultdict
from math import floor, isfinite, sqrt

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import merkle, negatives, pivots, queries

VECS = "vec_id long, embedding array<float>, label int, id long, v string, kind string, norm double"
ODD = (5, "x", "k", 1.0)


def near(r, v, cosine):
    """A vector at the given cosine from ``v``."""
    v = np.asarray(v, float)
    g = r.normal(size=len(v))
    g -= g @ v / (v @ v) * v
    return (cosine * v / np.linalg.norm(v) + sqrt(1 - cosine**2) * g / np.linalg.norm(g)).tolist()


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(3)
    rows = [(k, r.normal(size=64).tolist(), k % 4) for k in range(400)]
    rows += [(1000 + k, near(r, rows[k][1], 0.935 + 0.001 * (k % 60)), k % 4) for k in range(300)]
    center = r.normal(size=64)
    rows += [(2000 + k, near(r, center, 0.985), 1) for k in range(150)]  # one large class of near copies
    rows += [(3000 + k, (np.array(rows[k][1]) * 2**k).tolist(), rows[k][2]) for k in range(9)]  # one direction, other lengths
    rows += [(3100 + k, rows[7][1], 3) for k in range(12)] + [(3200, rows[7][1], 2)]
    rows += [(4000, None, 1), (4001, [], 1), (4002, [0.0] * 64, 1), (4003, [None] + [1.0] * 63, 1), (4004, [float("nan")] * 64, 1)]
    rows += [(4005, [float("inf")] * 64, 1), (4006, rows[1][1], None), (4007, rows[1][1][:32], 1), (4008, rows[1][1][:32], 1), (None, rows[1][1], 1)]
    rows += [(4009, rows[2][1], 2)] * 3 + [(4010, (np.array(rows[2][1]) * 1e-40).tolist(), 2)]
    return rows


def frame(spark, rows, schema=VECS):
    return spark.createDataFrame([(*x, *ODD) for x in rows], schema).repartition(5)


def brute_links(rows, least=0.93):
    live = {}
    for i, v, k in rows:
        if i is not None and k is not None and v and all(x is not None and isfinite(x) for x in v):
            v = np.float32(v).astype(float)
            if v.any():
                live[i] = (k, v / np.linalg.norm(v / np.abs(v).max()) / np.abs(v).max())
    links = defaultdict(set)
    ids = sorted(live)
    for a in ids:
        for b in ids:
            if a < b and live[a][0] == live[b][0] and len(live[a][1]) == len(live[b][1]) and live[a][1] @ live[b][1] >= least:
                links[a].add(b)
                links[b].add(a)
    low = {i: i for i in ids}
    for _ in ids:
        new = {i: min([low[i], *(low[j] for j in links[i])]) for i in ids}
        if new == low:
            break
        low = new
    return links, low


@pytest.mark.parametrize("dense, tile", [(128, 2048), (2, 16)])
def test_embedding_components(spark, vectors, monkeypatch, dense, tile):
    monkeypatch.setattr(pivots, "DENSE", dense)
    monkeypatch.setattr(pivots, "TILE", tile)
    links, low = brute_links(vectors)
    got = pivots.embedding_components(frame(spark, vectors)).collect()
    assert len(got) == len(vectors)
    found = sum(x.n_links for x in got if x.id != 4009) + next(x.n_links for x in got if x.id == 4009)
    want = sum(map(len, links.values()))
    assert found >= 0.99 * want
    for x in got:
        assert x.n_links <= len(links[x.id]) and x.kept == (x.id is not None and x.component_id == x.id)
        if x.n_links == len(links[x.id]):
            assert x.component_id is None if x.id is None else x.component_id >= low.get(x.id, x.id)
    exact = [x for x in got if x.n_links == len(links[x.id]) and x.component_id == low.get(x.id, x.id)]
    assert len(exact) >= 0.97 * len(got)
    copies = [x for x in got if x.id in (7, 3007, *range(3100, 3112))]
    assert len({x.component_id for x in copies}) == 1 and all(x.n_links >= 13 for x in copies)
    assert pivots.embedding_components(frame(spark, [])).count() == 0


def test_pair_in_many_lists_counts_once(spark, monkeypatch):
    """Recall of pairs at the threshold itself, by lists of either kind; nothing is counted twice."""
    r = np.random.default_rng(9)
    rows = [(k, r.normal(size=64).tolist(), 0) for k in range(1500)]
    rows += [(5000 + k, near(r, rows[k][1], 0.9301), 0) for k in range(1500)]
    got = {x.id: x.n_links for x in pivots.embedding_components(frame(spark, rows)).collect()}
    assert max(got.values()) == 1 and sum(got.values()) >= 0.97 * 3000


def test_pivots_are_apart(spark):
    v = [1.0] + [0.0] * 7
    nodes = spark.createDataFrame([(k, v, 1.0) for k in range(500)], "node long, v array<double>, norm double")
    p = pivots.choose_pivots(nodes, 500)
    assert p.shape == (67, 8) and np.allclose(np.linalg.norm(p, axis=1), 1) and (p @ np.array(v) >= 0.999).sum() == 1


def test_op11_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    links, low = brute_links(rows)
    got = sorted(tuple(x) for x in queries.op11_pivots(spark, d).select("vec_id", "n_links", "component_id", "kept").collect())
    assert got == sorted((i, len(links[i]), low[i], low[i] == i) for i, _, _ in rows)


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def fields(*values):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in values))


def lower(t):
    return t if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text); the contract's columns by whole lists."""
    trees = defaultdict(list)
    for doc, source, lang, n, text in rows:
        leaf = fields(doc, source, lang, n, text)
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        trees[lang].append((doc, leaf, fields(doc, source, lang, n, lower(text)) if hit else leaf))

    def climb(digests):
        """The root, and for every place its siblings by level: (left, right)."""
        paths, at = [[] for _ in digests], list(range(len(digests)))
        while len(digests) > 1:
            for k, place in enumerate(at):
                s = place // 8 * 8
                paths[k].append(("".join(digests[s:place]), "".join(digests[place + 1 : s + 8])))
            digests, at = [sha("".join(digests[s : s + 8])) for s in range(0, len(digests), 8)], [p // 8 for p in at]
        return digests[0], paths

    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    of = {}
    for name in names:
        trees[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        of[name] = climb([x[1] for x in trees[name]])
    root, tops = climb([of[name][0] for name in names]) if names else (None, [])
    out = []
    for name, top in zip(names, tops):
        subroot, paths = of[name]
        for (doc, leaf, changed), path in zip(trees[name], paths):
            d = changed
            for left, right in path + top:
                d = sha(left + d + right)
            out.append((doc, leaf, subroot, root, sha("".join(a + b for a, b in path + top)), d, d == root))
    return out


DOCS = "doc_id long, source string, lang string, n_chars int, text string, tree int, lo int, hi int, path string, place int"


@pytest.mark.parametrize("case", ["many", "one", "single", "trees", "none"])
def test_manifest(spark, tmp_path, case):
    r = random.Random(5)
    text = lambda: "".join(r.choice("abcXYZ äÖ中😀\n") for _ in range(r.randint(0, 30)))
    rows = [(k, r.choice(["s", None, "ü"]), r.choice(["en", "en", "en", "de", "ÿ", "zz", "中", None]), r.choice([None, 3]), r.choice([text(), None, ""])) for k in r.sample(range(-500, 2000), 700)]
    rows += [(7, "s", "en", 1, "A"), (7, "s", "en", 1, "B"), (7, "s", "en", 1, "B"), (None, None, None, None, None), (None, "s", "en", 1, "Ab"), (5000, "s", "solo", 1, "Ab " * 200_000)]
    if case == "one":
        rows = [(*x[:2], "en", *x[3:]) for x in rows]
    if case == "single":
        rows = [(1, "s", "en", 4, "Text")]
    if case == "trees":
        rows = [(*x[:2], f"t{k}", *x[3:]) for k, x in enumerate(rows[:100])]
    if case == "none":
        rows = []
    path = str(tmp_path)
    spark.createDataFrame([(*x, 1, 2, 3, "p", 4) for x in rows], DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    got = [tuple(x) for x in queries.op12_merkle(spark, path).collect()]
    assert sorted(got, key=repr) == sorted(brute_manifest(rows), key=repr)


def test_manifest_ranks_repeated_rows_in_parallel(spark):
    rows = spark.range(4000).select(F.lit("en").alias("lang"), F.lit(1).alias("doc_id"), F.lit("same").alias("text"))
    found = merkle.manifest(rows, ["doc_id", "text"])
    assert found.agg(F.countDistinct("path"), F.countDistinct("leaf"), F.countDistinct("root")).first()[1:] == (1, 1) and found.count() == 4000


def brute_negatives(rows, positives=5, count=10):
    live = {}
    for i, v, k in rows:
        if i is not None and k is not None and v is not None and all(x is not None and isfinite(x) for x in v):
            live.setdefault(i, ((k + 1) % 10 if i % 7 == 0 else k, [floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for a, (label, v) in live.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, k) for i, (k, w) in live.items() if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            hits = [(i, -n) for n, i, k in scored if k != label and 30 * -s <= 100 * -n <= 90 * -s][:count]
            out += [(a, p, rank, i, -s, n) for rank, (i, n) in enumerate(hits, 1)]
    return out


@pytest.mark.parametrize("sizes", [(512, 4096), (3, 20)])
def test_hard_negatives(spark, tmp_path, monkeypatch, sizes):
    monkeypatch.setattr(negatives, "ANCHORS", sizes[0])
    monkeypatch.setattr(negatives, "CANDIDATES", sizes[1])
    r = np.random.default_rng(4)
    rows = [(k, (r.normal(size=24) + (k % 3)).tolist(), int(r.choice([1, 2, 3, 40]))) for k in range(0, 3000, 6)]
    rows += [(k, (np.zeros(24) + k % 5).tolist(), int(k % 2)) for k in range(3000, 3100)]  # ties
    rows += [(3200, [0.0] * 24, 1), (3201, rows[0][1], None), (3300, None, 1), (3400, [float("nan")] * 24, 1), (3500, [None] * 24, 1), (3600, [1.0] * 5, 1), (3601, [2.0] * 5, 2), (3602, [2.0] * 5, 1)]
    rows += [(None, rows[0][1], 1), (3700, [], 1), (3800, (r.normal(size=24)).tolist(), 77), rows[5], rows[5], rows[50]]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = [tuple(x) for x in queries.op13_negatives(spark, str(tmp_path)).collect()]
    want = brute_negatives(rows)
    assert len(want) > 300 and sorted(got) == sorted(want)


def test_hard_negatives_of_nothing(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.op13_negatives(spark, str(tmp_path)).count() == 0


def test_op13_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(tuple(x) for x in queries.op13_negatives(spark, d).collect()) == sorted(brute_negatives(rows))


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (64, 64, 64), (65, 33, 130), (200, 16, 90)])
def test_strassen(shape):
    r = np.random.default_rng(sum(shape))
    m, k, n = shape
    a, b = r.integers(-(1 << 30), 1 << 30, (m, k)), r.integers(-(1 << 30), 1 << 30, (k, n))
    assert (negatives.strassen(a, b, 4) == a @ b).all()


def test_scores_that_might_not_fit(spark):
    rows = frame(spark, [(100, [1e12, 1.0], 1), (101, [1e12, 1.0], 1)])
    with pytest.raises(Exception, match="too large for exact scores"):
        rows = negatives.quantized(rows, "label")
        negatives.mine_negatives(rows, rows.where("id % 100 = 0")).collect()
