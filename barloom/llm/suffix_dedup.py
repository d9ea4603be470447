"""Removal of repeated byte strings by longest-previous-factor arrays over anchored suffixes.

A byte goes if a string of LEAST bytes that covers it also starts in a document
with a smaller id. Sorting every suffix of the corpus would move LEAST times its
size, so suffixes are told apart by *anchors* first:

1. Every string of LEAST bytes has at least one anchor, the smallest hash among
   its runs of RUN bytes; equal strings have equal anchors. Around an anchor lies
   its context, all strings of LEAST bytes that hold it.
2. Anchors meet by hash. A context whose equal stands in a document with a
   smaller id goes as a whole. What is left to compare are the first holders of
   each context among those that share an anchor: where shared passages begin and
   end. A run of bytes that stands in the corpus very often (HOT) meets by its
   contexts instead, and of what is left of those the strings meet one by one;
   each slice of documents asks for a context or string once.
3. Of those contexts the bytes are gathered, and the suffixes of the strings that
   may repeat are sorted. Previous and next smaller documents in suffix order,
   with the common prefixes up to them, give the longest previous factor of each
   suffix; from LEAST bytes on it is a repeat.
4. Each document's repeats are joined back to its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize

LEAST, RUN = 50, 16
#: Bytes of a context before and from its anchor on; starts of strings within it.
BEFORE, FROM = LEAST - RUN, LEAST
CONTEXT, STARTS = BEFORE + FROM, LEAST - RUN + 1
#: Bytes of text handled together in a task, and bytes of text whose anchors meet in one group.
SLICE, BUCKET = 4 << 20, 1 << 22
#: Times that a run must stand in the corpus, and in a slice to be counted there, to be met by contexts and strings.
HOT, HOT_IN_SLICE = 1 << 16, 4


def _slide(v: np.ndarray, w: int, f) -> np.ndarray:
    """``f`` (minimum or maximum) over every window of ``w`` values."""
    m, n = v, 1
    while 2 * n <= w:
        m = f(m[:-n], m[n:])
        n *= 2
    return f(m[: len(v) - w + 1], m[w - n :]) if w > n else m


def _run_hash(words: list[np.ndarray]) -> np.ndarray:
    """Hash of runs of RUN bytes, given as columns of eight bytes each."""
    x = np.zeros(len(words[0]), np.uint64)
    for word in words:
        x ^= word
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


def _among(x: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Which values stand in a sorted array."""
    if not len(few):
        return np.zeros(len(x), bool)
    return few[np.minimum(np.searchsorted(few, x), len(few) - 1)] == x


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of a text: the runs whose hash is the smallest of some string of LEAST bytes."""
    n = len(text) - RUN + 1
    if len(text) < LEAST:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    word = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    x = _run_hash([word[s : s + n] for s in range(0, RUN, 8)])
    rank = (x >> np.uint64(32)).astype(np.uint32)
    least = _slide(rank, STARTS, np.minimum)
    edge = np.zeros(STARTS - 1, np.uint32)
    places = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), STARTS, np.maximum) == rank)
    return places, x[places]


def _slices(batches):
    """Runs of rows of about SLICE bytes: lists of (id, text, tag)."""
    rows, n = [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1)):
            t = (t.as_py() or "").encode()
            rows.append((i, t, xxhash.xxh64_intdigest(t) - (1 << 63)))
            n += len(t)
            if n >= SLICE:
                yield rows
                rows, n = [], 0
    yield rows


def _count_runs(batches):
    """Per slice the anchors' hashes that stand there several times."""
    for rows in _slices(batches):
        found = [anchors(t)[1] for i, t, _ in rows if i is not None and len(t) >= LEAST]
        if found:
            h, n = np.unique(np.concatenate(found), return_counts=True)
            keep = n >= HOT_IN_SLICE
            yield pa.record_batch([pa.array(h[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], ["h", "n"])


def _grouped(at: np.ndarray, d: np.ndarray, ids: np.ndarray, tags: np.ndarray):
    """Per bucket: its number, ids and tags of its documents, the positions that fall there and whose they are."""
    order = np.argsort(at, kind="stable")
    cuts = np.flatnonzero(np.diff(at[order])) + 1
    for pick in np.split(order, cuts) if len(order) else ():
        own, k = np.unique(d[pick], return_inverse=True)
        yield int(at[pick[0]]), ids[own].tobytes(), tags[own].tobytes(), pick, _as_planes(k)


def _seen(ids: np.ndarray, *key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose key stands here with a smaller id as well, and a position of the smallest id for each."""
    order = np.lexsort((ids, *key[::-1]))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in key])
    first = order[new][np.cumsum(new) - 1]
    later = ids[order] > ids[first]
    return order[later], first[later]


def _send_anchors(buckets: int, hot: np.ndarray):
    """Per slice and bucket one row with the anchors that fall there: hash, context hash, document, place.

    There are three kinds of buckets: by the anchor's hash; by the context's hash, for hot anchors; and for hot
    contexts that an earlier document of the slice has too, which are repeats already.
    """

    def run(batches):
        of = xxhash.xxh3_64_intdigest
        for rows in _slices(batches):
            rows = [r for r in rows if r[0] is not None and len(r[1]) >= LEAST]
            if not rows:
                continue
            parts = []
            for k, (_, t, _) in enumerate(rows):
                p, h = anchors(t)
                c = [of(t[max(0, q - BEFORE) : q + FROM]) for q in p.tolist()]
                parts.append((h, np.array(c, np.uint64), np.full(len(p), k, np.uint32), p.astype(np.uint32)))
            h, c, d, p = (np.concatenate(x) for x in zip(*parts))
            at = (h >> np.uint64(40)).astype(np.int64) % buckets
            ids, tags = (np.array([r[k] for r in rows], np.int64) for k in (0, 2))
            often = np.flatnonzero(_among(h, hot))
            if len(often):
                at[often] = buckets + (c[often] % np.uint64(buckets)).astype(np.int64)
                at[often[_seen(ids[d[often]], h[often], c[often])[0]]] = 2 * buckets + int(tags[0]) % buckets
            out = [[], [], [], [], [], [], []]
            for b, own, tag, pick, k in _grouped(at, d, ids, tags):
                hb = h[pick].view(np.uint8).reshape(-1, 8)[:, :5]  # the bucket stands for more bits of the hash
                for x, y in zip(out, (b, own, tag, hb.tobytes(), c[pick].tobytes(), k, _as_planes(p[pick]))):
                    x.append(y)
            yield pa.record_batch([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], ["bucket", "ids", "tags", "h", "c", "d", "p"])

    return run


def _as_planes(numbers: np.ndarray) -> bytes:
    """Unsigned numbers as four planes of bytes, which compress better than rows of four."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _planes(raw: bytes) -> np.ndarray:
    """Unsigned numbers that were stored as four planes of bytes."""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _lists(key_a, key_b, values: list[tuple[str, np.ndarray]]) -> pa.Table:
    """One row per (id, tag), rows given in that order, with the values of each as lists."""
    new = np.r_[True, (key_a[1:] != key_a[:-1]) | (key_b[1:] != key_b[:-1])] if len(key_a) else np.empty(0, bool)
    starts = np.flatnonzero(new)
    ends = pa.array(np.append(starts, len(key_a)), pa.int32())
    cols = {"id": pa.array(key_a[starts]), "tag": pa.array(key_b[starts])}
    return pa.table(cols | {n: pa.ListArray.from_arrays(ends, pa.array(v)) for n, v in values})


def _met(table: pa.Table, kind: int) -> pa.Table:
    """Per document of a bucket: places of anchors whose context repeats an earlier one, and of those to compare."""
    cols = {n: table.column(n).to_pylist() for n in ("ids", "tags", "h", "c", "d", "p")}
    h, c, ids, tags, p = [], [], [], [], []
    for i, t, hb, cb, db, pb in zip(*cols.values()):
        hh = np.zeros((len(hb) // 5, 8), np.uint8)
        hh[:, :5] = np.frombuffer(hb, np.uint8).reshape(-1, 5)
        d = _planes(db)
        h.append(hh.view("<u8").ravel())
        c.append(np.frombuffer(cb, "<u8"))
        ids.append(np.frombuffer(i, np.int64)[d])
        tags.append(np.frombuffer(t, np.int64)[d])
        p.append(_planes(pb))
    del cols
    h, c, ids, tags, p = map(np.concatenate, (h, c, ids, tags, p))
    order = np.lexsort((ids, c, h))
    h, c, ids = h[order], c[order], ids[order]
    new_h = np.r_[True, h[1:] != h[:-1]]
    new_c = new_h | np.r_[True, c[1:] != c[:-1]]
    first = ids[new_c][np.cumsum(new_c) - 1]
    of, at = np.cumsum(new_h) - 1, np.flatnonzero(new_h)
    spread = np.minimum.reduceat(ids, at) != np.maximum.reduceat(ids, at)
    several = np.add.reduceat(new_c.astype(np.int64), at) > 1
    whole = (ids > first) | (kind == 2)
    check = ~whole & ((spread & several)[of] | (kind == 1))
    tags, p = tags[order], p[order]
    keep = np.flatnonzero(whole | check)
    keep = keep[np.lexsort((p[keep], tags[keep], ids[keep]))]
    sign = np.where(whole[keep], p[keep].astype(np.int64), -1 - p[keep].astype(np.int64))
    return _lists(ids[keep], tags[keep], [("found", sign)])


def _meet(buckets: int):
    return lambda table: _met(table, table.column("bucket")[0].as_py() // buckets)


def longest_previous(words: np.ndarray, doc: np.ndarray, least: int = 1) -> np.ndarray:
    """Longest previous factor of each suffix, in bytes up to the given length.

    ``words`` are the suffixes' bytes as rows of big-endian numbers; a previous
    factor starts in a smaller ``doc``. In suffix order, the nearest suffixes of
    smaller documents on both sides have the longest common prefixes with a suffix
    among all of smaller documents. They are found by following links, each step
    doubling the reach; a link ends where the common prefix falls below ``least``,
    so shorter factors count as none.
    """
    n = len(doc)
    order = np.lexsort((doc, *words.T[::-1]))
    d = doc[order]
    lcp = np.full(max(n - 1, 0), 8 * words.shape[1], np.int64)
    for k in range(words.shape[1] - 1, -1, -1):
        x = words[order, k]
        x = x[1:] ^ x[:-1]
        same = sum((x < np.uint64(1 << 8 * b)).astype(np.int64) for b in range(1, 8))  # leading bytes alike
        lcp = np.where(x > 0, 8 * k + same, lcp)
    best = np.zeros(n, np.int64)
    for way in (1, -1):
        dd = d if way == 1 else d[::-1]
        reach = np.concatenate([[0], lcp if way == 1 else lcp[::-1]])  # common prefix with the suffix linked to
        link = np.arange(-1, n - 1)
        far = np.arange(n)
        while len(far):
            far = far[(link[far] >= 0) & (reach[far] >= least)]
            far = far[dd[link[far]] >= dd[far]]
            to = link[far]
            reach[far], link[far] = np.minimum(reach[far], reach[to]), link[to]
        got = np.where((link >= 0) & (reach >= least), reach, 0)
        best = np.maximum(best, got if way == 1 else got[::-1])
    out = np.empty(n, np.int64)
    out[order] = best
    return out


def _inside(text: np.ndarray) -> np.ndarray:
    """Which strings of the contexts lie wholly in their documents."""
    start = np.arange(STARTS)
    return (start >= text[:, CONTEXT, None]) & (start + LEAST <= CONTEXT - text[:, CONTEXT + 1, None].astype(np.int64))


_POWER = np.cumprod(np.full(CONTEXT + 1, 0x9E3779B97F4A7C15, np.uint64))


def _words(strings: np.ndarray) -> np.ndarray:
    """Rows of LEAST bytes as rows of big-endian numbers."""
    padded = np.zeros((len(strings), -(-LEAST // 8) * 8), np.uint8)
    padded[:, :LEAST] = strings
    return padded.view(">u8").astype(np.uint64)


def _compare(buckets: int):
    return lambda table: _compared(table, table.column("bucket")[0].as_py() // buckets)


def _compared(table: pa.Table, kind: int) -> pa.Table:
    """Per document of a bucket: the anchors to compare and which of their strings repeat (bits)."""
    z = zstandard.ZstdDecompressor()
    width = (CONTEXT + 2, LEAST, LEAST)[kind]
    cols = {n: table.column(n).to_pylist() for n in ("ids", "tags", "d", "p", "text")}
    ids, tags, p, text = [], [], [], []
    for i, t, db, pb, x in zip(*cols.values()):
        d = _planes(db)
        ids.append(np.frombuffer(i, np.int64)[d])
        tags.append(np.frombuffer(t, np.int64)[d])
        p.append(_planes(pb))
        text.append(np.frombuffer(z.decompress(x), np.uint8).reshape(-1, width))
    del cols
    ids, tags, p, text = map(np.concatenate, (ids, tags, p, text))
    n = len(ids)
    if kind:  # single strings; those of kind 2 are known to repeat
        keep = np.flatnonzero(longest_previous(_words(text), ids, LEAST) >= LEAST) if kind == 1 else np.arange(n)
        keep = keep[np.lexsort((tags[keep], ids[keep]))]
        return _lists(ids[keep], tags[keep], [("place", p[keep].astype(np.int64) + BEFORE), ("bits", np.ones(len(keep), np.int64))])
    key = np.zeros((n, STARTS), np.uint64)
    for at in range(0, n, 8192):
        part = text[at : at + 8192, :CONTEXT].astype(np.uint64) + np.uint64(1)
        sums = np.zeros((len(part), CONTEXT + 1), np.uint64)
        np.cumsum(part * _POWER[:CONTEXT], axis=1, out=sums[:, 1:])
        hashed = (sums[:, LEAST:] - sums[:, :STARTS]) * _POWER[STARTS - 1 :: -1][:STARTS]
        hashed ^= hashed >> np.uint64(29)
        key[at : at + 8192] = hashed * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
    key[~_inside(text)] = 0
    flat = key.ravel()
    order = np.argsort(flat)
    same = flat[order[1:]] == flat[order[:-1]]
    may = np.zeros(len(flat), bool)
    may[order[1:][same]] = may[order[:-1][same]] = True
    may &= flat > 0
    del key, order, same
    pick = np.flatnonzero(may)
    row, off = pick // STARTS, pick % STARTS
    bits = np.zeros(n, np.int64)
    if len(pick):
        words = _words(np.lib.stride_tricks.sliding_window_view(text[:, :CONTEXT], LEAST, axis=1)[row, off])
        del flat, may
        repeat = longest_previous(words, ids[row], LEAST) >= LEAST
        np.bitwise_or.at(bits, row[repeat], np.int64(1) << off[repeat])
    keep = np.flatnonzero(bits)
    keep = keep[np.lexsort((tags[keep], ids[keep]))]
    return _lists(ids[keep], tags[keep], [("place", p[keep].astype(np.int64)), ("bits", bits[keep])])


def _pack(batches):
    """Rows with their text compressed, as it is about to be shuffled."""
    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        for at in range(0, b.num_rows, 512):
            part = b.slice(at, 512)
            texts = [(t.as_py() or "").encode() for t in part.column(1)]
            tags = [xxhash.xxh64_intdigest(t) - (1 << 63) for t in texts]
            yield pa.record_batch([part.column(0), pa.array(tags, pa.int64()), pa.array([z.compress(t) for t in texts], pa.binary())], ["id", "tag", "body"])


def _send_contexts(buckets: int, hot: np.ndarray):
    """Contexts to compare by their anchor's bucket; of hot anchors the strings, by the strings' own hash."""

    def run(batches):
        z, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        edge = b"\0" * CONTEXT

        def rows(at, d, p, text, ids, tags):
            out = [[], [], [], [], [], []]
            for k, own, tag, pick, dd in _grouped(at, d, ids, tags):
                for x, y in zip(out, (k, own, tag, dd, _as_planes(p[pick]), pack.compress(text[pick].tobytes()))):
                    x.append(y)
            return pa.record_batch([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], ["bucket", "ids", "tags", "d", "p", "text"])

        def strings(d, p, text, ids, tags):
            row, off = np.nonzero(_inside(text))
            start = p[row].astype(np.int64) - BEFORE + off
            _, once = np.unique(d[row].astype(np.int64) << 32 | start, return_index=True)
            row, off, start = row[once], off[once], start[once]
            text = np.lib.stride_tricks.sliding_window_view(text[:, :CONTEXT], LEAST, axis=1)[row, off]
            raw = text.tobytes()
            h = np.array([xxhash.xxh3_64_intdigest(raw[x : x + LEAST]) for x in range(0, len(raw), LEAST)], np.uint64)
            at = buckets + (h % np.uint64(buckets)).astype(np.int64)
            later, first = _seen(ids[d[row]], h)
            at[later[(text[later] == text[first]).all(axis=1)]] = 2 * buckets + int(tags[0]) % buckets
            return rows(at, d[row], start, text, ids, tags)

        def send(parts, ids, tags):
            d, p, text = (np.concatenate(x) for x in zip(*parts))
            ids, tags = np.array(ids, np.int64), np.array(tags, np.int64)
            h = _run_hash([np.ascontiguousarray(text[:, BEFORE + s : BEFORE + s + 8]).view("<u8").ravel() for s in range(0, RUN, 8)])
            often = _among(h, hot)
            some = np.flatnonzero(~often)
            yield rows((h[some] & np.uint64(0xFFFFFFFF)).astype(np.int64) % buckets, d[some], p[some], text[some], ids, tags)
            often = np.flatnonzero(often)
            for at in range(0, len(often), 20_000):
                some = often[at : at + 20_000]
                yield strings(d[some], p[some], text[some], ids, tags)

        parts, ids, tags, n = [], [], [], 0
        for b in batches:
            for i, tag, body, found in zip(*(c.to_pylist() for c in b.columns)):
                places = sorted({-1 - x for x in found or () if x < 0})
                if not places:
                    continue
                t = z.decompress(body)
                padded = np.frombuffer(edge + t + edge, np.uint8)
                q = np.array(places)
                text = np.empty((len(q), CONTEXT + 2), np.uint8)
                text[:, :CONTEXT] = padded[(q + CONTEXT - BEFORE)[:, None] + np.arange(CONTEXT)]
                text[:, CONTEXT] = np.maximum(BEFORE - q, 0)
                text[:, CONTEXT + 1] = np.maximum(q + FROM - len(t), 0)
                parts.append((np.full(len(q), len(ids), np.uint32), q, text))
                ids.append(i)
                tags.append(tag)
                n += len(q)
                if n >= 200_000:
                    yield from send(parts, ids, tags)
                    parts, ids, tags, n = [], [], [], 0
        if parts:
            yield from send(parts, ids, tags)

    return run


def _cut(batches):
    """Spans to remove and the bytes that stay of every document."""
    z = zstandard.ZstdDecompressor()
    bit = np.arange(STARTS)
    for b in batches:
        for at in range(0, b.num_rows, 256):
            ids, n_bytes, spans, kept = [], [], [], []
            for i, body, found, place, bits in zip(*(c.to_pylist() for c in b.slice(at, 256).columns)):
                t = z.decompress(body)
                edge = np.zeros(len(t) + 1, np.int32)
                q = np.array([x for x in found or () if x >= 0], np.int64)
                if len(q):
                    np.add.at(edge, np.maximum(q - BEFORE, 0), 1)
                    np.add.at(edge, np.minimum(q + FROM, len(t)), -1)
                if place:
                    rows = [(p, m) for ps, ms in zip(place, bits) for p, m in zip(ps, ms)]
                    q, m = (np.array(x, np.int64) for x in zip(*rows))
                    k, off = np.nonzero((m[:, None] >> bit) & 1)
                    start = q[k] - BEFORE + off
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + LEAST, -1)
                gone = np.cumsum(edge) > 0
                turn = np.flatnonzero(np.diff(np.r_[False, gone[:-1], False].astype(np.int8)))
                s, e = turn[::2].tolist(), turn[1::2].tolist()
                spans.append([{"start": x, "end": y} for x, y in zip(s, e)])
                kept.append(b"".join(t[x:y] for x, y in zip([0, *e], [*s, len(t)])))
                ids.append(i)
                n_bytes.append(len(t))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``(id, n_bytes, spans array<struct<start,end>>, kept binary)``.

    ``spans`` are the maximal runs of removed bytes, ``kept`` the bytes that stay.
    Defined cases: a null text counts as empty; texts under LEAST bytes stay whole;
    a row with a null id comes neither before nor after any other and stays whole;
    rows that share an id do not match each other; an empty table gives no rows;
    other columns are ignored. Ids are whole numbers. A context counts as equal to
    another by 104 bits of hash, which over 10**12 contexts errs with a chance of
    about 10**-7; where a passage ends is compared byte by byte.

    Text is shuffled once, compressed. The number of groups in which anchors meet
    follows the size of the input, so a group's size does not. Of a passage that
    many documents share, each slice of documents sends what it has of it in one
    row, and only the first holders of a context are compared byte by byte. Runs
    that stand HOT times or more (or once in 2**24 bytes, so that their hashes are
    16 MB at most where anchors are not denser than usual) are spread over groups
    by context and string; a run not counted as hot has fewer occurrences than
    that, and HOT_IN_SLICE - 1 in each slice, in its group.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    buckets = max(1, min(total // BUCKET, 65536), total // (16 * BUCKET))
    counts = rows.mapInArrow(_count_runs, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    often = counts.where(F.col("n") >= max(HOT, total >> 24)).select("h").collect()
    hot = np.sort(np.array([r["h"] for r in often], np.int64).view(np.uint64))
    sent = rows.mapInArrow(_send_anchors(buckets, hot), "bucket int, ids binary, tags binary, h binary, c binary, d binary, p binary")
    met = materialize(sent.groupBy("bucket").applyInArrow(_meet(buckets), "id long, tag long, found array<long>"))
    found = met.groupBy("id", "tag").agg(F.flatten(F.collect_list("found")).alias("found"))
    packed = rows.mapInArrow(_pack, "id long, tag long, body binary").repartition("id", "tag")
    joined = packed.join(found, ["id", "tag"], "left")
    # Documents without anchors to compare are passed over in the function: a filter here would make Spark shuffle the texts anew.
    contexts = joined.select("id", "tag", "body", "found").mapInArrow(
        _send_contexts(buckets, hot), "bucket int, ids binary, tags binary, d binary, p binary, text binary"
    )
    repeats = contexts.groupBy("bucket").applyInArrow(_compare(buckets), "id long, tag long, place array<long>, bits array<long>")
    repeats = repeats.groupBy("id", "tag").agg(F.collect_list(F.struct("place", "bits")).alias("r"))
    repeats = repeats.select("id", "tag", F.col("r.place").alias("place"), F.col("r.bits").alias("bits"))
    return joined.join(repeats, ["id", "tag"], "left").select("id", "body", "found", "place", "bits").mapInArrow(
        _cut, "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    )
