"""Every operator against a brute-force version on small tables with nulls, empties, ties, repeats and odd columns."""

import hashlib
import html
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.llm import chat, exact_dedup, hamming, line_dedup, mixing, queries, sentencepiece_bpe, simhash, suffix_dedup, toxicity, wrapper
from barloom.llm.graph import connected_components

DOCS = "doc_id long, text string, source string, id long, t string"
R = random.Random(11)
WORDS = ["alpha", "Beta", "gamma", "delta", "eps", "Zeta.", "eta", "theta\n", "ÄÖ", "éa"]


def rows_of(texts):
    return [(i, t, f"s{(i or 0) % 3}" if (i or 0) % 7 else None, 5, "x") for i, t in texts]


@pytest.fixture(scope="module")
def texts():
    out = [(k, " ".join(R.choice(WORDS) for _ in range(R.randint(0, 60)))) for k in range(60)]
    out += [(100 + k, out[k][1]) for k in range(15)] + [(200 + k, out[k][1].swapcase()) for k in range(8)]
    out += [(300 + k, out[k + 20][1] + " tail") for k in range(10)]
    long = " ".join(R.choice(WORDS) for _ in range(6000))
    out += [(400, long), (401, long + " end"), (402, None), (403, ""), (404, " \t\n"), (None, "alpha Beta"), (None, None), (7, out[7][1])]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(rows_of(texts), DOCS).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_exact_dedup(docs, none, texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[lower(t)].append(i)
    want = []
    for i, t in texts:
        ids = groups[lower(t)]
        keep = max((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    for options in ({}, {"hash_chunk": lambda c: F.length(c).cast("long")}):  # the second: many texts under one hash
        got = exact_dedup.recipes(docs, **options).select("id", F.dense_rank().over(Window.orderBy("recipe")).alias("g"), "text_sha256").collect()
        by = defaultdict(set)
        for r in got:
            by[r.g].add(r.text_sha256)
        assert len(got) == len(texts) and len(by) == len(groups) and all(len(x) == 1 for x in by.values())
    got = [tuple(r) for r in exact_dedup.exact_dedup(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert exact_dedup.exact_dedup(none).count() == 0


def brute_fingerprint(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    if not w:
        return 0
    s = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(fps):
    """fps: list of (id, fp); smallest id reachable over three or fewer bits."""
    ids = {}
    for i, f in fps:
        if i is not None:
            ids[f] = min(i, ids.get(f, i))
    names = list(ids)
    up = {f: f for f in names}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for a in range(len(names)):
        for b in range(a):
            if (names[a] ^ names[b]).bit_count() <= 3:
                x, y = sorted((root(names[a]), root(names[b])), key=lambda f: ids[f])
                up[y] = x
    return {f: ids[root(f)] for f in names}


def test_simhash(docs, none, texts):
    fps = [(i, brute_fingerprint(t)) for i, t in texts]
    comp = brute_components(fps)
    got = [tuple(r) for r in simhash.simhash_components(docs).collect()]
    assert sorted(got, key=repr) == sorted(((i, f"{f:016x}", comp.get(f)) for i, f in fps), key=repr)
    assert simhash.simhash_components(none).count() == 0


@pytest.mark.parametrize("group", [2048, 4])
def test_simhash_links_connect_what_close_pairs_connect(spark, group, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", group)  # 4: most groups go on to the finer keys
    r = random.Random(5)
    centers = [r.getrandbits(64) for _ in range(12)]
    fps = {c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for c in centers for _ in range(15)}
    fps = list(enumerate(fps))
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in fps], "node long, fp long")
    comp = {x.node: x.component for x in connected_components(simhash.links(nodes), "a", "b").collect()}
    want = brute_components(fps)
    assert all(comp.get(i, i) == want[f] for i, f in fps)


@pytest.mark.parametrize("group", [2048, 4])
def test_simhash_links_of_a_larger_radius(spark, group, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", group)
    r = random.Random(7)
    fps = [0, (1 << 64) - 1]
    for _ in range(40):
        fps.append(r.choice(fps) ^ sum(1 << b for b in r.sample(range(64), r.randint(3, 7))))
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "node long, fp long")
    comp = {x.node: x.component for x in connected_components(simhash.links(nodes, 5), "a", "b").collect()}
    want = list(range(len(fps)))
    for _ in fps:
        want = [min(want[j] for j, g in enumerate(fps) if (f ^ g).bit_count() <= 5) for f in fps]
    assert [comp.get(i, i) for i in range(len(fps))] == want


def brute_copies(rows):
    """Class by id: the smallest id reachable over pairs within the radius that share a block."""
    fp = {i: simhash.fingerprint(t, 5, 4) for i, t in rows if i is not None}
    block = {f: {(k, b, w >> 12 * b & 4095) for k, w in enumerate(f) for b in range(5)} for f in fp.values()}
    want = {}
    for i in sorted(fp):
        near = {want[j] for j in want if block[fp[i]] & block[fp[j]] and sum((x ^ y).bit_count() for x, y in zip(fp[i], fp[j])) <= simhash.COPY_RADIUS}
        want = {j: min(near) if c in near else c for j, c in want.items()} | {i: min(near, default=i)}
    return want


@pytest.mark.parametrize("group", [16384, 8])
def test_simhash_of_several_words(spark, group, monkeypatch):
    monkeypatch.setattr(simhash, "LARGE_GROUP", group)  # 8: some blocks go on in pairs
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    texts = []
    for k in range(40):
        base = [word() for _ in range(r.randint(120, 400))]
        for _ in range(4):
            texts.append((len(texts), " ".join(word() if r.random() < 0.008 else w for w in base)))
    texts += [(1000 + k, " ".join(word() for _ in range(k))) for k in range(30)] + [(2000, None), (2001, "  "), (None, texts[0][1])]
    got = {x.id: x for x in simhash.simhash_components(spark.createDataFrame(rows_of(texts), DOCS), radius=simhash.COPY_RADIUS, width=5, words=4).collect()}
    assert len(got) == len(texts) and all(len(x.fingerprint) == 64 for x in got.values())
    want = brute_copies(texts)
    found = {i: x.component_id for i, x in got.items() if i is not None}
    assert all(want[i] == want[c] for i, c in found.items())
    assert found == want if group > 8 else sum(found[i] == want[i] for i in want) > 0.9 * len(want)
    assert sum(found[k] == k // 4 * 4 for k in range(160)) > 150 and all(found[1000 + k] == 1000 + k for k in range(1, 30))
    assert found[2001] == found[2000] == found[1000] == 1000 and got[None].component_id == 0
    w = texts[5][1].split()
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 5]).encode(), 42) for k in range(len(w) - 4)]
    assert simhash.fingerprint(texts[5][1], 5, 4)[0] == sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def similar_pairs(r, n):
    """Pairs of texts of five-word similarity 0.80 to 0.87."""
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    out = []
    while len(out) < n:
        base = [word() for _ in range(r.randint(150, 400))]
        other = [word() if r.random() < 0.02 else w for w in base]
        a, b = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (base, other))
        if 0.80 <= len(a & b) / len(a | b) <= 0.87:
            out.append((" ".join(base), " ".join(other)))
    return out


@pytest.mark.parametrize("large", [16384, 1])
def test_near_copies_of_the_least_similarity(spark, large, monkeypatch):
    """Recall at similarity 0.80 to 0.87, also where every group counts as large and is compared in tiles."""
    monkeypatch.setattr(simhash, "LARGE_GROUP", large)
    pairs = similar_pairs(random.Random(17), 300)
    rows = [(2 * k + side, t) for k, p in enumerate(pairs) for side, t in enumerate(p)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x.id: x.component_id for x in simhash.simhash_components(docs, radius=simhash.COPY_RADIUS, width=5, words=4).collect()}
    assert sum(got[2 * k + 1] == 2 * k for k in range(300)) >= 0.9 * 300
    assert all(got[i] // 2 == i // 2 for i in got)


@pytest.mark.parametrize("n", [1, 10**6, 10**9])
def test_keys_of_any_number_of_fingerprints_find_as_many_pairs(n):
    bits = simhash._key_bits(n, 4)
    assert n > 1 or bits == [[64 * k + 12 * b + i for i in range(12)] for k in range(4) for b in range(5)]
    assert 2 ** len(bits[0]) >= n / 128 and len({len(b) for b in bits}) == 1
    r = np.random.default_rng(1)
    differ = r.random((2000, 256)) > 0.85
    assert np.mean([any(not row[at].any() for at in bits) for row in differ]) >= 0.91


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(40)] + [(1000, 1000 + k) for k in range(1, 50)] + [(3, None), (5, 5)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert got == {k: 0 for k in range(41)} | {1000 + k: 1000 for k in range(50)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_sentencepiece(docs, none, texts):
    import sentencepiece

    path = queries.default_model()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = [(r.id, list(r.ids), r.decoded) for r in sentencepiece_bpe.encode_decode(docs, path).collect()]
    assert sorted(got, key=repr) == sorted(((i, sp.encode(t or ""), sp.decode(sp.encode(t or ""))) for i, t in texts), key=repr)
    assert sentencepiece_bpe.encode_decode(none, path).count() == 0


def test_sentencepiece_on_odd_strings():
    import sentencepiece

    path = queries.default_model()
    sp, bpe = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_bpe.Bpe(sentencepiece_bpe.load_model(path))
    r = random.Random(2)
    pieces = list(bpe.id)
    for _ in range(4000):
        s = "".join(r.choice(pieces) if r.random() < 0.6 else r.choice("abeinrst \n▁é€😀\x00,.012") for _ in range(r.randint(0, 9))).replace("▁", " " if r.random() < 0.7 else "▁")
        assert bpe.encode(s) == sp.encode(s) and bpe.decode(bpe.encode(s)) == sp.decode(sp.encode(s)), repr(s)
    assert bpe.encode("a" * 20000) == sp.encode("a" * 20000)
    assert [bpe.decode([i]) for i in range(3, 300)] == [sp.decode([i]) for i in range(3, 300)]


def brute_repeats(rows):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - 49) if i is not None else ():
            first[b[s : s + 50]] = min(i, first.get(b[s : s + 50], i))
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 49) if i is not None else ():
            if first[b[s : s + 50]] < i:
                gone[s : s + 50] = b"\1" * 50
        runs = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        yield i, len(b), tuple(runs), bytes(x for x, g in zip(b, gone) if not g)


def test_suffix_dedup(spark, docs, none, texts):
    r = random.Random(3)
    make = lambda n: "".join(r.choice("abcdefgh é") for _ in range(n))
    shared = [make(r.randint(40, 200)) for _ in range(5)]
    more = []
    for i in range(120):
        s = ""
        for _ in range(r.randint(0, 5)):
            p = r.choice(shared)
            s += make(r.randint(0, 60)) if r.random() < 0.5 else p[r.randint(0, 20) : r.randint(30, len(p))]
        more.append((i * 7 % 121 if r.random() < 0.97 else None, s))
    more += [(5, "a" * 500), (6, "a" * 300), (7, None), (5, "b" * 100), (5, "a" * 500), (400, "ab" * 200), (401, "ab" * 80)]
    for rows, d in ((texts, docs), (more, spark.createDataFrame(rows_of(more), DOCS).repartition(4)), ([], none)):
        got = [(x.id, x.n_bytes, tuple((s.start, s.end) for s in x.spans), bytes(x.kept)) for x in suffix_dedup.remove_repeats(d).collect()]
        assert sorted(got, key=repr) == sorted(brute_repeats(rows), key=repr)


@pytest.mark.parametrize("hot, bucket", [(4, 1 << 22), (12, 1 << 12)])
def test_suffix_dedup_hot_runs(spark, monkeypatch, hot, bucket):
    """Runs, contexts and strings that most documents share meet in many groups, with the same result."""
    r = random.Random(hot)
    make = lambda n: "".join(r.choice("abcdefgh é") for _ in range(n))
    run, passage, line = make(20), make(60), make(150)
    rows = [(i * 11 % 300, make(r.randint(0, 80)) + r.choice([run, passage, line, "-" * 70, run + line[:70]]) + make(r.randint(0, 80))) for i in range(300)]
    rows += [(3, line), (3, line + line), (None, line), (None, passage), (301, "-" * 3000), (302, None), (303, line[10:70])]
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    kinds = []
    monkeypatch.setattr(suffix_dedup, "_send_contexts", lambda buckets, runs, f=suffix_dedup._send_contexts: kinds.append(len(runs)) or f(buckets, runs))
    got = [(x.id, x.n_bytes, tuple((s.start, s.end) for s in x.spans), bytes(x.kept)) for x in suffix_dedup.remove_repeats(spark.createDataFrame(rows_of(rows), DOCS).repartition(3)).collect()]
    assert kinds[0] > 0
    assert sorted(got, key=repr) == sorted(brute_repeats(rows), key=repr)


def test_longest_previous_factors():
    import numpy as np

    text = np.frombuffer(b"abracadabra_abracadabraX" + b"\0" * 8, np.uint8)
    n = len(text) - 8
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, 8)[:n]).view(">u8").astype(np.uint64)
    got = suffix_dedup.longest_previous(words, np.arange(n))
    raw = bytes(text)
    for i in range(n):
        want = max((next((k for k in range(8) if raw[i + k] != raw[j + k]), 8) for j in range(i)), default=0)
        assert got[i] == want


def test_line_dedup(spark, none):
    a = [f"the {k}th line of the first document has some length" for k in range(8)]
    b = ["something of its own that stands at the head of it", *a[2:6], "and an end that nobody else has in this table"]
    rows = [(1, "\n".join(a)), (2, "\n".join(b)), (3, "\n".join(a)), (4, None), (5, ""), (None, "\n".join(a)), (6, "short\nlines\n\nonly"), (3, "\n".join(a))]
    got = {(r.id, r.n_lines): r for r in line_dedup.dedup_lines(spark.createDataFrame(rows_of(rows), DOCS)).collect()}
    assert len(got) == 6 + 1
    assert got[1, 8].kept == "\n".join(a) and got[3, 8].kept == "" and list(got[3, 8].removed) == list(range(8))
    assert got[2, 6].kept == "\n".join([b[0], b[-1]]) and list(got[2, 6].removed) == [1, 2, 3, 4]
    assert got[None, 8].kept == "\n".join(a) and got[4, 1].kept == "" and got[6, 4].kept == rows[6][1]
    assert line_dedup.dedup_lines(none).count() == 0


def test_line_dedup_removes_lines_that_many_documents_share(spark):
    hot = "a notice that very many of the documents carry somewhere within them"
    rows = [(k, f"own line {k} at the head of the document\n{hot}\nown line {k} at its end") for k in range(100)]
    got = {r.id: list(r.removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows_of(rows), DOCS)).collect()}
    assert got == {k: [1] if k else [] for k in range(100)}


def test_line_dedup_finds_every_shared_block(spark):
    x, y = "one long line that stands by itself in documents", "another long line that stands in the same documents"
    short = ["twenty five characters ab", "twenty five characters cd"]
    rows = [(1, f"{x}\nown line of the first\n{y}"), (2, f"{y}\n{x}"), (3, f"{y}\n{x}"), (4, "\n".join(short)), (5, "\n".join(["own", *short]))]
    got = {r.id: list(r.removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows_of(rows), DOCS)).collect()}
    assert got == {1: [], 2: [0, 1], 3: [0, 1], 4: [], 5: [1, 2]}
    r = random.Random(8)
    words = ["", "a", "four", "fifteen letters", "about twenty letters", "a line that has forty letters or more in it"]
    rows = [(k % 55, "\n".join(r.choice(words) for _ in range(r.randint(0, 12)))) for k in range(60)]
    split, want = [(i, t.split("\n")) for i, t in rows], Counter()
    for i, lines in split:
        gone = set()
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(map(len, lines[a:b])) >= 40 and any(j < i and lines[a:b] == u[k : k + b - a] for j, u in split for k in range(len(u))):
                    gone.update(range(a, b))
        want[i, len(lines), tuple(sorted(gone))] += 1
    got = line_dedup.dedup_lines(spark.createDataFrame(rows_of(rows), DOCS).repartition(3)).collect()
    assert Counter((x.id, x.n_lines, tuple(x.removed)) for x in got) == want


def test_patience_alignment():
    assert line_dedup.patience([1, 2, 3, 4, 5], [9, 2, 3, 8, 5]) == [(1, 1), (2, 2), (4, 4)]
    assert line_dedup.patience([1, 1, 2], [1, 2, 1]) == [(0, 0), (2, 1)]
    r = random.Random(4)
    for _ in range(200):
        a, b = ([r.randint(0, 6) for _ in range(r.randint(0, 9))] for _ in range(2))
        got = line_dedup.patience(a, b)
        assert all(a[x] == b[y] for x, y in got) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


def test_line_dedup_removes_what_alignment_finds(spark, monkeypatch):
    r = random.Random(6)
    line = lambda: " ".join(r.choice(WORDS).strip() for _ in range(9))
    blocks = ["\n".join(line() for _ in range(3)) for _ in range(40)]
    mixed = blocks[:]
    r.shuffle(mixed)
    rows = [(1, "\n".join(blocks)), (2, "\n".join(mixed[:35] + [line()])), (3, "\n".join(reversed(blocks)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.id: len(x.removed) for x in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: 0, 2: 105, 3: 120}
    h = list(range(50))
    assert line_dedup.aligned(h, h[::-1]) == set(h) and line_dedup.aligned(h[:25], h[20:]) == set(range(20, 25))
    monkeypatch.setattr(line_dedup, "patience", lambda a, b: [])
    assert line_dedup.aligned(h, h) == set()  # nothing goes that alignment does not find


@pytest.mark.parametrize("overlap", [False, True])
def test_mixing(spark, docs, none, overlap):
    sources = F.array("source", F.lit("all")) if overlap else F.array("source")
    rows, plan = mixing.mix(docs, sources)
    got, again = ([tuple(r) for r in d.orderBy("doc_id", "text", "mix_copies").collect()] for d in (rows, mixing.mix(docs.repartition(3), sources)[0]))
    assert got == again and len(got) == docs.count()
    plan = {r.source: (r["size"], r.target) for r in plan.collect()}
    assert all(t <= 2 * s + 1e-9 for s, t in plan.values())
    at = {c: k for k, c in enumerate(rows.columns)}
    assert all(0 <= r[at["mix_copies"]] <= 2 for r in got)
    if not overlap:
        total = sum(s for s, _ in plan.values())
        assert sum(t for _, t in plan.values()) == pytest.approx(1.5 * total)
        most = max(r[at["mix_size"]] for r in got)
        for source, (_, target) in plan.items():
            assert abs(sum(r[at["mix_size"]] * r[at["mix_copies"]] for r in got if r[at["source"]] == source) - target) <= most / 2 + 1
    assert mixing.mix(none, F.array("source"))[0].count() == 0


def test_water_filling():
    got = mixing.water_fill({"a": 10, "b": 100, "c": 100}, {"a": 3, "b": 1, "c": 2}, 315.0)
    assert got == {"a": 20.0, "b": pytest.approx(295 / 3), "c": pytest.approx(590 / 3)}


def test_min_cost_flow_prefers_first_copies():
    flow = mixing.min_cost_flow({"x": 10, "y": 10, "xy": 10}, {"x": 20, "y": 15}, {"x": ["x"], "y": ["y"], "xy": ["x", "y"]}, [0, 1])
    assert flow["x", "x"] + flow["xy", "x"] == 20 and flow["y", "y"] + flow["xy", "y"] == 15
    assert sum(max(0, sum(v for (p, _), v in flow.items() if p == q) - 10) for q in ("x", "y", "xy")) == 5


def test_toxicity_on_held_out_rows(spark):
    r = random.Random(9)
    clean = ["river", "stone", "paper", "window", "garden", "letter", "number", "music"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = [r.choice(clean) + r.choice(["", "s", "ly"]) for _ in range(r.randint(5, 120))]
        for _ in range(3 if toxic else 0):
            words.insert(r.randint(0, len(words)), "nasty" + r.choice(["", "ness", "est", "ish"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame(rows_of(rows + [(9000, None), (9001, ""), (None, "river")]), DOCS)
    model = toxicity.train(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = [(x.id, x.score, x.held) for x in toxicity.score(d, model).withColumn("held", toxicity.held_out(F.col("id"))).collect()]
    assert len(got) == 603 and all(0 <= s <= 1 for _, s, _ in got)
    assert all((s >= 0.5) == (i is not None and i < 600 and i % 4 == 0) for i, s, h in got)
    assert sum(bool(h) for _, _, h in got) > 80
    assert toxicity.score(d.limit(0), model).count() == 0
    empty = toxicity.train(d, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(x.score < 0.5 for x in toxicity.score(d, empty).collect())


def test_toxicity_reads_long_letter_runs_to_their_end():
    r = random.Random(6)
    glue = lambda n: "".join(r.choice(["river", "stone", "paper", "window"]) for _ in range(n))
    texts = [f"{glue(r.randint(10, 30))}{'nastiness' if i % 3 == 0 else ''}{glue(r.randint(0, 9))}" for i in range(300)]
    model = toxicity.fit(texts[:200], [int(i % 3 == 0) for i in range(200)])
    assert [s >= 0.5 for s in model.score(texts[200:])] == [i % 3 == 0 for i in range(200, 300)]
    for n in range(200):
        w = "".join(r.choice("abcdefg") for _ in range(n))
        pieces = toxicity.words_of(w)
        assert all(len(p) <= 40 for p in pieces) and (pieces == [w] or n > 40 or not n)
        assert all(any(w[i : i + 6] in p for p in pieces) for i in range(n - 5))


def test_toxicity_score_is_the_largest_of_all_windows():
    import numpy as np

    r = random.Random(13)
    clean, bad = ["river", "stone", "paper", "window"], ["nasty", "nastiness", "vile"]
    texts = [" ".join(r.choice(clean + bad * (i % 2)) for _ in range(r.randint(1, 90))) for i in range(240)]
    model = toxicity.fit(texts[:160], [i % 2 for i in range(160)])
    start = toxicity.ToxicityModel({}, {}, toxicity.BiGru()).word_rows
    assert len(model.word_rows) > 1 and np.abs(model.word_rows[1:, 1:]).max() > 0.3 and np.isfinite(model.char_rows).all() and start.shape == (1, toxicity.HALF)
    p = {k: v.astype(float) for k, v in model.net.p.items()}
    sig = lambda x: 1 / (1 + np.exp(-x))

    def one_window(words):
        """The network over one window, word by word."""
        x = [np.asarray(model.vector(w), float) for w in words] + [np.asarray(model.vectors[0], float)] * (toxicity.WINDOW - len(words))
        states = {}
        for d in "fb":
            h, k = np.zeros(toxicity.STATE), toxicity.STATE
            for t in range(len(x)) if d == "f" else reversed(range(len(x))):
                g, u = x[t] @ p[f"W{d}"] + p[f"c{d}"], h @ p[f"U{d}"]
                z, q = sig(g[:k] + u[:k]), sig(g[k : 2 * k] + u[k : 2 * k])
                h = z * h + (1 - z) * np.tanh(g[2 * k :] + q * u[2 * k :])
                states[t, d] = h
        s = [np.concatenate([states[t, "f"], states[t, "b"]]) for t in range(len(x))]
        a = np.exp([v @ p["att"] - (30 if t >= len(words) else 0) for t, v in enumerate(s)])
        return sig((sum(w * v for w, v in zip(a, s)) / a.sum()) @ p["out"] + p["bias"][0])

    for text in [*texts[160:190], "", None, "river"]:
        words = re.findall("[a-z]+", text or "")
        at = [0]
        while at[-1] + toxicity.WINDOW < len(words):
            at.append(at[-1] + toxicity.STRIDE)
        want = max(one_window(words[k : k + toxicity.WINDOW]) for k in at)
        assert model.score([text])[0] == pytest.approx(want, abs=1e-4)


def test_network_gradient():
    import numpy as np

    net = toxicity.BiGru()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(0)
    x, mask = r.standard_normal((7, 3, toxicity.WIDTH)), np.ones((7, 3))
    mask[5:, 1] = 0
    logit, memo = net.forward(x, mask)
    grad, inputs = net.backward(np.ones(3), memo)
    for at in ((0, 0, 0), (4, 1, 3), (6, 2, 7)):
        was, sums = x[at], []
        for step in (1e-5, -1e-5):
            x[at] = was + step
            sums.append(net.forward(x, mask)[0].sum())
        x[at] = was
        assert inputs[at] == pytest.approx((sums[0] - sums[1]) / 2e-5, rel=2e-3, abs=2e-4)
    for name in ("Wf", "Ub", "att", "out", "cf", "bias"):
        at = tuple(0 for _ in net.p[name].shape)
        was, step = net.p[name][at], 1e-5
        net.p[name][at] = was + step
        up = net.forward(x, mask)[0].sum()
        net.p[name][at] = was - step
        down = net.forward(x, mask)[0].sum()
        net.p[name][at] = was
        assert grad[name][at] == pytest.approx((up - down) / (2 * step), rel=2e-3, abs=2e-4), name


def page(body, k, side=True):
    menu = "".join(f"<li><a href='/{k}/{j}'>Go {k} {j}</a></li>" for j in range(4))
    return (
        f"<!DOCTYPE html><html><head><title>T{k}</title><style>p{{x:1}}</style><script>var a='</p><p>no';</script></head><body class='page'>"
        f"<header id=top><h1>Site</h1></header><nav><ul>{menu}</ul></nav><!-- <p>no</p> --><div class='cookie-notice'>We use cookies {k}</div>"
        + (f"<aside><p>Side {k}</p></aside>" if side else "")
        + f"<div class='post'>{body}<div class='share'>Share {k}</div><div class='more'><p>Read more on our site every day.</p></div></div>"
        f"<form><input><p>Sign up {k}</p></form><section class='comments'><p>Reader {k} says no</p></section><footer>&copy; {k}</footer></body></html>"
    )


def test_wrapper_induction(spark):
    rows, want = [], {}
    for k in range(12):
        body = f"<h2>Title&nbsp;{k} &amp; more</h2><p>First   paragraph of {k}<br>goes <b>on</b>\n<p>Second &lt;{k * 7}&gt;"
        rows.append((k, f"http://a.example.com/{k}", page(body, k, k % 3 > 0)))
        want[k] = f"Title {k} & more\nFirst paragraph of {k} goes on\nSecond <{k * 7}>"
    rows += [(50, None, None), (51, "http://b.example.com", ""), (52, "not a url", "<p>Only text"), (53, "http://c.example.com/x", "<article><h1>A</h1><p>B &#233;</article><p>outside")]
    rows += [(54, "http://d.example.com/", "<div class='layout has-sidebar'><div id=sidebar-2>no</div><article><div class='entry-header'><h1>T</h1></div><p>Body</p><div class='user_comments'>no</div></article></div>")]
    rows += [(60 + k, "http://copy.example.com/1", f"<nav>{k}</nav><article><h1>Same</h1><p>Words that all copies have.</p></article>") for k in range(8)]
    want |= {50: "", 51: "", 52: "Only text", 53: "A\nB é", 54: "T\nBody"} | {60 + k: "Same\nWords that all copies have." for k in range(8)}
    d = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, host string").repartition(3)
    got = {r.page_id: r.text for r in wrapper.extract_articles(d).collect()}
    assert got == want
    assert wrapper.extract_articles(d.limit(0)).count() == 0


def test_wrapper_learns_from_all_pages_of_a_host(spark):
    plain = lambda k: f"<div class=top>Our daily paper</div><div class=text><p>Words {k}</div>"
    other = lambda k: f"<section><p class=slogan>All the news</p><p class=story>Story {k}</p></section>"
    rows = [(0, "http://a.example.com/0", None)] + [(k, f"http://a.example.com/{k}", (plain if k % 2 else other)(k)) for k in range(1, 13)]
    rows += [(20 + k, f"http://b.example.com/{k}", plain(20 + k)) for k in range(2)]
    rows += [(30 + k, "http://c.example.com/", "<div class=text><p>Same words</div>") for k in range(3)] + [(40, "http://c.example.com/x", other(40))]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in wrapper.extract_articles(d).collect()}
    want = {0: "", 20: "Words 20", 21: "Words 21", 40: "All the news\nStory 40"} | {k: f"Words {k}" if k % 2 else f"Story {k}" for k in range(1, 13)}
    assert got == want | {30 + k: "Same words" for k in range(3)}


def test_wrapper_reads_large_and_deep_pages_whole(spark):
    odd = lambda k, j: "".join("abcdefghij"[int(c)] for c in f"{k}{j}")
    wide = lambda k: "".join(f"<div class=w{odd(k, j)}><p>Part {k} {j}</p></div>" for j in range(5000))
    tail = "<section><p>Some constant words at the end.</p></section>"
    rows = [(k, "http://a.example.com/", wide(k) + tail) for k in range(2)]
    rows += [(10 + k, "http://b.example.com/", f"<p>First of {k}</p><p>Tell us what you think.</p><p>Last of {k}</p>") for k in range(6)]
    rows += [(20 + k, "http://c.example.com/", "<div>" * 3000 + f"Deep {k}") for k in range(2)]
    got = {r.page_id: r.text for r in wrapper.extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {k: "\n".join(f"Part {k} {j}" for j in range(5000)) for k in range(2)}
    assert got == want | {10 + k: f"First of {k}\nLast of {k}" for k in range(6)} | {20 + k: f"Deep {k}" for k in range(2)}


def test_wrapper_keeps_the_text_of_articles(spark):
    """Linked paragraphs, headings by any id, names that only sound like boilerplate, a form around the page, articles in parts."""
    linked = lambda k: f"<h1>Title {k}</h1><p>Plain words {k}</p><p><a href=x>A paragraph {k} that is one long link to something else</a></p><h2>Heading {k}</h2>"
    rows = [(k, "http://a.example.com/", linked(k)) for k in range(4)]
    want = {k: f"Title {k}\nPlain words {k}\nA paragraph {k} that is one long link to something else\nHeading {k}" for k in range(4)}
    names = "<h2 id=search>Search {k}</h2><h2 id=legal>Legal</h2><h2 id=related-work>Related {k}</h2><section id=notice-periods><p>Notice {k}</p></section><div class='market-share'>Share {k}</div><figure class=ad-hoc>Ad hoc {k}</figure>"
    gone = "<div class='ad-slot'>Buy {k}</div><div class='share-bar'>Share it</div><div id=comments><p>I say {k}</p></div><ul class=related-links><li>See {k}</li></ul>"
    rows += [(10 + k, "http://b.example.com/", f"<article>{(names + gone).replace('{k}', str(k))}</article>") for k in range(3)]
    want |= {10 + k: f"Search {k}\nLegal\nRelated {k}\nNotice {k}\nShare {k}\nAd hoc {k}" for k in range(3)}
    menu = "<div><a>Home</a> <a>News</a> <a>About us</a></div><ul><li><a>One {k}</a></li><li><a>Two {k}</a></li></ul>"
    rows += [(20 + k, "http://c.example.com/", f"{menu.replace('{k}', str(k))}<div class='article-header'><h1>Head {k}</h1></div><p>Body {k} <a>linked</a></p><ul><li>Point {k}</li><li><a>two</a></li></ul>") for k in range(3)]
    want |= {20 + k: f"Head {k}\nBody {k} linked\nPoint {k}\ntwo" for k in range(3)}
    rows += [(30 + k, "http://d.example.com/", f"<form id=aspnet><div><p>All the words of page {k} lie in it.</p></div></form><form><p>Mail {k}</p></form>") for k in range(3)]
    want |= {30 + k: f"All the words of page {k} lie in it." for k in range(3)}
    rows += [(40 + k, "http://e.example.com/", f"<article><p>First part {k}</p></article><p>between</p><article><p>Second part {k}, longer</p></article>") for k in range(3)]
    want |= {40 + k: f"First part {k}\nSecond part {k}, longer" for k in range(3)}
    got = {r.page_id: r.text for r in wrapper.extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    # A block that all pages of the host have in one place is template, as "Legal" and "two" are.
    assert got == {k: t.replace("\nLegal", "").removesuffix("\ntwo") for k, t in want.items()}


def test_simple_tree_matching():
    tree = lambda form: wrapper.Tree("\n".join(form.split(",")), 1)
    a, b = tree("0 r,1 x,2 p,1 y,1 z"), tree("0 r,1 x,2 q,2 p,1 z")
    assert wrapper.align(a, b) == [0, 1, 3, -1, 4]
    assert wrapper.align(tree("0 r"), tree("0 s")) == [-1]
    b.merge(a)
    assert b.text() == "0 2 r\n1 2 x\n2 1 q\n2 2 p\n1 1 y\n1 2 z"
    assert wrapper.Tree(b.text()).text(2) == "0 2 r\n1 2 x\n2 2 p\n1 2 z"

    def brute(a, x, b, y):  # the largest match by the table of prefixes
        if a.label[x] != b.label[y]:
            return 0
        rows = [[0] * (len(b.kids[y]) + 1)]
        for i in a.kids[x]:
            row = [0]
            for k, j in enumerate(b.kids[y]):
                row.append(max(rows[-1][k + 1], row[k], rows[-1][k] + brute(a, i, b, j)))
            rows.append(row)
        return rows[-1][-1] + 1

    r = random.Random(12)
    for _ in range(300):
        one, two = (wrapper.Tree("0 r", 1) for _ in range(2))
        for t in (one, two):
            for _ in range(r.randint(0, 12)):
                t.add(r.randrange(len(t.label)), r.choice("abc"), 1)
        got = wrapper.align(one, two)
        assert sum(x >= 0 for x in got) == brute(one, 0, two, 0)
        up = {k: n for t in (two,) for n, ks in enumerate(t.kids) for k in ks}
        for n, ks in enumerate(one.kids):
            there = [got[k] for k in ks if got[k] >= 0]
            assert all(up[k] == got[n] for k in there) and there == sorted(there, key=two.kids[got[n]].index if there else None)
        size = len(two.label)
        two.merge(one)
        assert len(two.label) == size + sum(x < 0 for x in got) and sum(two.pages) == len(one.label) + size


def test_wrapper_trees_merge_in_groups(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "FAN", 2)
    forms = [f"0 html\n1 div a\n1 div {c}\n1 p" for c in "bcdefghij"] * 3
    d = spark.createDataFrame([("h", f) for f in forms], "host string, form string")
    got = wrapper.wrappers(d).collect()
    tree = wrapper.Tree(got[0].tree)
    assert len(got) == 1 and sorted(zip(tree.label, tree.pages)) == sorted([("html", 27), ("div a", 27), ("p", 27)] + [(f"div {c}", 3) for c in "bcdefghij"])


def test_wrapper_drops_what_is_not_shown(spark):
    body = "<p>Words <span class='ad-slot'>Buy <b>now</b></span>of {k}<i hidden>no</i> here</p><div style='color:red; display: none'>no</div><p class=x style='visibility:hidden'>no</p>"
    rows = [(k, "http://a.example.com/", body.replace("{k}", str(k)) + "<script>İİİİ</SCRIPT>" + "İ" * 30 + "<script>x</script><p>Important text after") for k in range(3)]
    rows.append((9, "http://b.example.com/", "<div>" * 10_000 + "Deep" + "</div>" * 10_000))
    got = {r.page_id: r.text for r in wrapper.extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "Deep" and got[1].split("\n")[0] == "Words of 1 here" and "no" not in got[1] and wrapper.article(wrapper.parse(rows[1][2]), {})[-1] == "Important text after"


def test_preferences(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", "more"), (1, 3, "assistant", "ok"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (2, 2, "user", "else"), (2, 3, "assistant", "no")]
    turns += [(3, 0, "user", "hi"), (4, 0, None, None), (1, 3, "assistant", "ok"), (None, 0, "user", "hi")]
    convs = chat.conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = {(r.chosen, r.rejected): r for r in chat.format_preferences(convs, chat.opening_pairs(convs)).collect()}
    assert set(got) == {(1, 2), (1, 3)}
    r = got[1, 2]
    assert r.n_prompt == 2 and r.prompt == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    for side, answer in ((r.chosen_completion, "ok"), (r.rejected_completion, "no")):
        assert [side.text[m.start : m.end] for m in side["mask"]] == [answer + "<|im_end|>"]
    assert got[1, 3].n_prompt == 1 and got[1, 3].rejected_completion.text == "" and len(got[1, 3].chosen_completion["mask"]) == 2
    stale = {r.conv: r.turns for r in chat.worse_endings(convs).collect()}
    assert set(stale) == {1, 2} and stale[1][3].text == "yo"


@pytest.mark.parametrize("spread", [64, 5])
def test_hamming_search(spark, spread):
    r = random.Random(spread)
    base = r.getrandbits(64)
    codes = [(i, base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, min(spread, 40))))) for i in range(150)]
    codes += [(1000 + i, codes[0][1]) for i in range(30)]
    signed = [(i, c - (1 << 64) if c >> 63 else c) for i, c in codes] + [(None, 0), (7777, None)]
    d = spark.createDataFrame(signed, "id long, code long").repartition(3)
    got = [tuple(x) for x in hamming.hamming_top_k(d, d.where("id % 20 = 0"), 7).collect()]
    want = []
    for q, c in codes:
        if q % 20 == 0:
            want += [(q, k + 1, i, n) for k, (n, i) in enumerate(sorted(((c ^ x).bit_count(), i) for i, x in codes)[:7])]
    assert sorted(got) == sorted(want)
    assert hamming.hamming_top_k(d.limit(0), d.limit(0)).count() == 0


@pytest.mark.parametrize("n,k", [(5, 10), (10, 10), (11, 10), (40, 3)])
def test_hamming_search_with_few_codes(spark, n, k):
    r = random.Random(n)
    codes = [(i, r.getrandbits(63)) for i in range(n)] + [(0, 0)]
    d = spark.createDataFrame([(str(i), c, "q") for i, c in codes], "id string, code long, q string")
    got = [tuple(x) for x in hamming.hamming_top_k(d, d.where("id = '3'"), k).collect()]
    c = dict(codes)[3]
    at = sorted(((c ^ x).bit_count(), str(i)) for i, x in codes)
    assert sorted(got) == [("3", j + 1, i, m) for j, (m, i) in enumerate(at[:k])]


def test_sign_codes(spark):
    d = spark.createDataFrame([(1, [1.0, -1.0, 2.0]), (2, None), (3, []), (4, [float("nan"), None, 0.5])], "vec_id long, embedding array<float>")
    assert {r.id: r.code for r in hamming.sign_codes(d).collect()} == {1: 5, 2: 0, 3: 0, 4: 4}


def test_sign_codes_refuse_longer_vectors(spark):
    d = spark.createDataFrame([(1, [1.0] * 64), (2, [1.0] * 65)], "vec_id long, embedding array<float>")
    assert [r.code for r in hamming.sign_codes(d.where("vec_id = 1")).collect()] == [-1]
    with pytest.raises(Exception, match="more than 64 components"):
        hamming.sign_codes(d).collect()


def test_pages_of_the_given_table(spark):
    def article(h):
        m = re.search(r"<article>(.*?)</article>", h or "", re.S)
        parts = re.split(r"</?(?:p|h1)>", m[1]) if m else []
        lines = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " " if "<br>" in x else "", x))).strip() for x in parts]
        return "\n".join(x for x in lines if x)

    d = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = Counter((r.page_id, r.text) for r in wrapper.extract_articles(d).collect())
    assert got == Counter((r.page_id, article(r.html)) for r in d.collect())


def test_registered_queries_give_the_contract_columns(spark, tmp_path):
    """Each query over written tables with nulls, empty texts, repeats and columns whose names clash with its own."""
    r = random.Random(17)
    line = lambda: " ".join(r.choice(WORDS).strip() for _ in range(12))
    shared = line() + line()
    docs = [(i, "\n".join([line(), shared] if i % 3 else [line()]), "src" + str(i % 2) if i % 5 else None, "x", 1, 2.0, 3, 4) for i in range(30)]
    docs += [(100, None, "src0", "x", 1, 2.0, 3, 4), (101, "", None, "x", 1, 2.0, 3, 4), (102, "".join(c.swapcase() if c.isascii() else c for c in docs[1][1]), "src1", "x", 1, 2.0, 3, 4)]
    sf = str(tmp_path)
    write = lambda name, rows, schema, **more: spark.createDataFrame(rows, schema).withColumns({c: F.lit(v) for c, v in more.items()}).write.parquet(f"{sf}/{name}.parquet")
    write("documents", docs, "doc_id long, text string, source string, id string, s int, target double, source_size int, size int", lang="en", n_chars=7)
    write("labels", [(i, 0, int(i % 4 == 0)) for i in range(30)] + [(None, 0, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    write("pages", [(1, "http://a.x/", "<article><p>One &amp; two</p></article>", "h", "t"), (2, None, None, "h", "t"), (3, "http://a.x/", "", "h", "t")], "page_id long, url string, html string, host string, text string")
    write("embeddings", [(i, [r.gauss(0, 1) for _ in range(64)], 5) for i in range(45)] + [(60, None, 5), (None, [1.0], 5)], "vec_id long, embedding array<double>, id long", label=3, kept=True, rank=0)
    write("conversations", [(c, k, "user" if k % 2 == 0 else "assistant", f"turn {k} {c if k > 1 else ''}", 1) for c in range(6) for k in range(4)] + [(9, 0, None, None, 1), (None, 0, "user", "x", 1)], "conv_id long, turn int, role string, text string, chosen int")
    run = {n: q(spark, sf) for n, q in queries.QUERIES.items()}
    rows = {n: q.collect() for n, q in run.items()}
    kinds = {n: dict(q.dtypes) for n, q in run.items()}
    expected = {
        "op2_wrapper": "page_id bigint url string text string n_chars bigint",
        "op3_sentencepiece": "doc_id bigint n_tokens bigint ids_sha256 string decoded_sha256 string",
        "op4_suffix_dedup": "doc_id bigint n_bytes bigint n_removed bigint n_spans bigint kept_sha256 string",
        "op5_toxicity": "doc_id bigint held_out boolean score double predicted int",
        "op6_mixing": "doc_id bigint size bigint source_size bigint target double taken bigint",
        "op7_exact_dedup": "doc_id bigint keep_id bigint group_size bigint kept boolean text_sha256 string",
        "op10_simhash": "doc_id bigint fingerprint string component_id bigint",
        "op11_pivots": "vec_id bigint n_links bigint component_id bigint kept boolean",
        "op12_merkle": "doc_id bigint leaf string subroot string root string proof_sha256 string folded_root string verified boolean",
        "op13_negatives": "anchor_id bigint positive_id bigint rank int negative_id bigint positive_score bigint negative_score bigint",
    }
    for name, want in expected.items():
        want = want.split()
        assert {c: kinds[name][c] for c in want[::2]} == dict(zip(want[::2], want[1::2])), name
    ids = sorted(d[0] for d in docs)
    for name in ("op1_line_dedup", "op3_sentencepiece", "op4_suffix_dedup", "op5_toxicity", "op6_mixing", "op7_exact_dedup", "op10_simhash", "op12_merkle"):
        assert sorted(x.doc_id for x in rows[name]) == ids, name
    assert sorted((x.page_id, x.text, x.n_chars) for x in rows["op2_wrapper"]) == [(1, "One & two", 9), (2, "", 0), (3, "", 0)]
    assert {(x.doc_id, x.keep_id) for x in rows["op7_exact_dedup"]} >= {(1, 102), (102, 102), (100, 101)}
    text = {d[0]: d[1] or "" for d in docs}
    first = min(i for i in range(30) if i % 3)
    for x in rows["op4_suffix_dedup"]:
        assert x.n_bytes == len(text[x.doc_id].encode()) and (x.n_removed > 0) == (x.doc_id < 30 and x.doc_id % 3 > 0 and x.doc_id != first), x
    for x in rows["op1_line_dedup"]:
        assert x.n_lines == text[x.doc_id].count("\n") + 1
    by = Counter()
    for x in rows["op6_mixing"]:
        assert x["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text[x.doc_id])) and x.taken <= 2 * x["size"]
        by[x.source_size, x.target] += x.taken
    assert all(abs(n - t) <= 30 for (_, t), n in by.items())
    assert all(x.held_out == (__import__("zlib").crc32(str(x.doc_id).encode()) % 5 == 0) and x.predicted == (x.score >= 0.5) for x in rows["op5_toxicity"])
    assert Counter(x.query_id for x in rows["op9_hamming"]) == {0: 10, 20: 10, 40: 10, 60: 10}
    assert {(x.chosen, x.rejected) for x in rows["op8_preferences"] if not x.stale} == {(0, c) for c in range(1, 6)}


def test_mixing_of_many_sources(spark):
    """20,000 sources, some of which share documents: targets as over one list, and each source's words near its own."""
    r = random.Random(3)
    rows = [(i, "w " * r.randint(1, 9), f"s{i:05d}") for i in range(20_000)] + [(30_000 + i, "w " * 5, None) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got, plan = mixing.mix(docs, F.array("source"))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = mixing.water_fill(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}, 1.5 * sum(sizes.values()))
    assert {x.source: pytest.approx(x.target) for x in plan.collect()} == want
    taken = Counter()
    for x in got.collect():
        taken[x.source] += x.mix_size * x.mix_copies
    assert all(abs(taken[s] - want[s]) <= max(9, sizes[s]) / 2 + 1 for s in sizes)


def test_mixing_routes_each_component(spark):
    """Sources that share patterns are routed together, others alone; the flow of all at once has the same total and cost."""
    sets = [["a"], ["a", "b"], ["b"], ["c"], ["d", "e"], ["e"], [None, "f"], ["g"], []]
    docs = spark.createDataFrame([(k * 100 + i, "w " * (1 + i % 4), s) for k, s in enumerate(sets) for i in range(20 * (k + 1))], "doc_id long, text string, s array<string>")
    rows, plan = mixing.mix(docs, F.col("s"))
    plan = {x.source: x.target for x in plan.collect()}
    supply, give = Counter(), Counter()
    for x in rows.collect():
        supply[tuple(x.s)] += x.mix_size
        give[tuple(x.s)] += x.mix_size * x.mix_copies
    assert give.pop(()) == 0
    flow = mixing.min_cost_flow({p: n for p, n in supply.items() if p}, {s: round(t) for s, t in plan.items()}, {p: list(p) for p in supply if p}, [0, 1])
    whole = Counter()
    for (p, _), n in flow.items():
        whole[p] += n
    assert sum(whole.values()) == pytest.approx(sum(give.values()), abs=2 * len(sets))
    cost = lambda g: sum(max(0, n - supply[p]) for p, n in g.items())
    assert cost(give) == pytest.approx(cost(whole), abs=2 * len(sets))


def test_mixing_passes_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 1, 2, 3)], "doc_id long, text string, source string, bin int, place int, _mix_p int")
    assert mixing.mix(docs, F.array("source"))[0].columns == [*docs.columns, "mix_size", "mix_copies"]
    with pytest.raises(ValueError, match="there already"):
        mixing.mix(docs.withColumn("mix_size", F.lit(1)), F.array("source"))


def test_flow_is_the_cheapest():
    """All ways to give whole words, at each pattern and source, against the flow's cost."""
    from itertools import product

    r = random.Random(4)
    for _ in range(12):
        supply = {p: r.randint(0, 2) for p in ("a", "b", "ab")}
        quota, member = {"x": r.randint(0, 3), "y": r.randint(0, 3)}, {"a": ["x"], "b": ["y"], "ab": ["x", "y"]}
        flow = mixing.min_cost_flow(supply, quota, member, [0, 1])
        cost = lambda give: sum(max(0, n - supply[p]) for p, n in give.items())
        best = None
        for a, b, x, y in product(range(5), repeat=4):
            give = {"a": a, "b": b, "ab": x + y}
            if all(n <= 2 * supply[p] for p, n in give.items()) and a + x <= quota["x"] and b + y <= quota["y"]:
                best = min(best or (9, 9), (-(a + b + x + y), cost(give)))
        assert best == (-sum(flow.values()), cost({p: sum(v for (q, _), v in flow.items() if q == p) for p in supply}))


def test_long_conversation(spark):
    turns = [(c, k, "user" if k % 2 == 0 else "assistant", f"text {k}" * 5 + (str(c) if k == 700 else "")) for c in (1, 2) for k in range(1500)]
    convs = chat.conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    r = chat.format_preferences(convs, chat.opening_pairs(convs)).first()
    assert r.n_prompt == 700 and len(r.chosen_completion["mask"]) == 400 and r.chosen_completion.text.endswith("<|im_end|>\n")
    assert chat.format_preferences(convs.limit(0), chat.opening_pairs(convs.limit(0))).count() == 0
