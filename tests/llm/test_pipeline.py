"""Each stage of the corpus pipeline against a brute-force version on the stage's own input."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import mixing, queries, shingle_join, toxicity
from barloom.llm.common import materialize, table

from .test_operators import brute_copies, lower

SF = "/root/testdata/sf0.001"


def similar(rows):
    """Pairs of ids whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    sets = {}
    for i, t in rows:
        w = lower(t).encode().split()
        if i is not None and len(w) > 4:
            sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    return [(x, y) for x in sets for y in sets if x < y and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])]


def test_stages(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.default_model())
    docs = table(spark, SF, "documents")
    docs = materialize(docs.unionByName(docs.limit(1).selectExpr("cast(null as long) doc_id", "cast(null as string) text", "lang", "source", "n_chars")))
    seen = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "exact_dedup", "simhash", "mixing", "sentencepiece"]

    model = toxicity.train(docs, table(spark, SF, "labels"))
    was, docs = docs.collect(), materialize(steps["toxicity"](spark, docs, SF))
    assert docs.columns == seen
    scores = model.score([r.text for r in was])
    assert Counter(docs.collect()) == Counter(r for r, s in zip(was, scores) if s < 0.5)

    was, docs = docs.collect(), materialize(steps["exact_dedup"](spark, docs, SF))
    best = {}
    for r in was:
        best[lower(r.text)] = max((x for x in (r.doc_id, best.get(lower(r.text))) if x is not None), default=None)
    assert docs.columns == seen and Counter(docs.collect()) == Counter(r for r in was if best[lower(r.text)] == r.doc_id)

    was, docs = docs.collect(), materialize(steps["simhash"](spark, docs, SF))
    comp = brute_copies([(r.doc_id, r.text) for r in was])
    assert docs.columns == seen and Counter(docs.collect()) == Counter(r for r in was if comp.get(r.doc_id) == r.doc_id and (r.doc_id is not None or all((x.text or "").strip() or x.doc_id is None for x in was)))
    near, kept = similar([(r.doc_id, r.text or "") for r in was]), {r.doc_id for r in docs.collect()}
    assert near and sum(not {x, y} <= kept for x, y in near) > 0.9 * len(near)  # of real near copies one goes

    was, docs = docs.collect(), materialize(steps["mixing"](spark, docs, SF))
    sizes, taken = Counter(), Counter()
    for r in was:
        sizes[r.source] += len((r.text or "").encode().split())
    for r in docs.collect():
        taken[r.source] += len((r.text or "").encode().split())
    targets = mixing.source_targets(dict(sizes), (3, 1, 2), 1.5 * sum(sizes.values()), 2)
    most = max(len((r.text or "").encode().split()) for r in was)
    assert docs.columns == seen and all(abs(taken[s] - t) <= most / 2 + 1 for s, t in targets.items())
    assert max(Counter(docs.collect()).values()) <= 2 and set(docs.collect()) <= set(was)

    want = Counter()
    for r in docs.collect():
        ids = sp.encode(r.text or "")
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in steps["sentencepiece"](spark, docs, SF).collect()) == want


def test_empty_tables(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF))
        assert docs.count() == 0


@pytest.mark.parametrize("sample, frequent", [(20_000, 4), (100, 2)])
def test_every_near_copy_of_the_least_similarity_goes(spark, sample, frequent, monkeypatch):
    monkeypatch.setattr(shingle_join, "SAMPLE", sample)
    monkeypatch.setattr(shingle_join, "FREQUENT", frequent)
    r, texts = random.Random(5), []
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    common = [word() for _ in range(60)]  # a passage that many texts hold
    for k in range(150):
        base = (common if k % 3 == 0 else []) + [word() for _ in range(r.randint(6, 300))]
        changed = list(base)
        n = len(base) - 4
        at, cost = len(base) // 2, max(0, int(n / 9) - 1)  # n - d of n + d shingles stay if d change
        for i in range(cost // 5):
            changed[(at + 7 * i) % len(base)] = word()
        texts += [" ".join(base), " ".join(changed + [word() for _ in range(cost % 5)])]
    texts += [texts[0].upper(), " ".join([texts[2]] * 3), "one", "one two", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near = similar([(i, t or "") for i, t in enumerate(texts)])
    found = {x.doc_id for x in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()}
    assert len(near) > 100 and not [p for p in near if set(p) <= found]
    classes = docs.selectExpr("doc_id id", "doc_id class")
    edges = {tuple(sorted(e)) for e in shingle_join.alike(docs, classes, 5).collect()}
    one = {i: min([x for x, y in near if y == i and (x, y) in edges], default=i) for i in range(len(texts))}
    assert edges <= set(near) and all((x, y) in edges or one[x] == one[y] for x, y in near)


@pytest.mark.parametrize("group, rounds", [(8, 4), (8, 1), (32, 4)])
def test_a_cluster_of_near_copies_is_compared_around_a_centre(spark, group, rounds, monkeypatch):
    monkeypatch.setattr(shingle_join, "GROUP", group)
    monkeypatch.setattr(shingle_join, "ROUNDS", rounds)
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))

    def changed(base, n):
        at = set(r.sample(range(len(base)), n))
        return [word() if i in at else w for i, w in enumerate(base)]

    texts, passage = [], [word() for _ in range(120)]
    for _ in range(2):  # two clusters around one passage: many copies alike with the middle, many with no other text
        base = passage + [word() for _ in range(180)]
        texts += [base] + [changed(base, r.randint(1, 15)) for _ in range(120)]
        texts += [changed(texts[-1 - k], 2) for k in range(0, 60, 3)]  # alike with one copy, some not with the middle
    texts += [passage + [word() for _ in range(k)] for k in range(25)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    near = similar([(i, " ".join(t)) for i, t in enumerate(texts)])
    rows = docs.selectExpr("doc_id id", "text t")
    nodes = materialize(shingle_join.prefixes(rows, 5).withColumn("class", F.col("id")))
    edges, pairs = shingle_join.compared(nodes, rows, 5)
    assert pairs.count() < len(near) + 4 * len(texts)  # not all pairs of a cluster

    def classes(pairs):
        least = list(range(len(texts)))
        while any(least[x] != least[y] for x, y in pairs):
            for x, y in pairs:
                least[x] = least[y] = min(least[x], least[y])
        return least

    found = {tuple(sorted(e)) for e in shingle_join.alike(docs, docs.selectExpr("doc_id id", "doc_id class"), 5).collect()}
    assert found <= set(near) and classes(found) == classes(near)
    assert len(set(classes(near))) > 20


@pytest.mark.parametrize("shared", [20, 150])
def test_texts_that_share_a_passage_meet_no_centre(spark, shared, monkeypatch):
    monkeypatch.setattr(shingle_join, "FREQUENT", 10**6)  # as if the sample told none of the passage

    def around(*_):
        raise AssertionError("compared with a centre")

    monkeypatch.setattr(shingle_join, "_around", around)
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(shared)]
    texts = [passage + [word() for _ in range(300 - shared)] for _ in range(40)]
    texts.append(texts[0][:-6] + [word() for _ in range(6)])
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    near = similar([(i, " ".join(t)) for i, t in enumerate(texts)])
    found = shingle_join.alike(docs, docs.selectExpr("doc_id id", "doc_id class"), 5).collect()
    assert near == [(0, 40)] and {tuple(sorted(e)) for e in found} == set(near)
