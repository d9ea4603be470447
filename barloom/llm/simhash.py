"""SimHash near-duplicate classes found through pigeonhole blocks."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize
from .graph import connected_components

SEED = 42
#: A group of fingerprints under one key is compared in memory up to this size; larger ones go by finer keys.
GROUP = 2048
#: The same for fingerprints of several words: larger groups are compared in tiles of about that many, every pair of them.
LARGE_GROUP = 16384
#: Bits of a key of such fingerprints at least; with more of them keys get longer, so that groups stay about as large as with 2**FEW.
BLOCK, FEW = 12, 18
#: The share of equal bits in a pair of similarity 0.8, on average, and how many of such pairs share a key at least.
ALIKE, FOUND = 0.85, 0.929
#: For near copies, words of a fingerprint, and the bits of it in which texts of similarity 0.8 differ, 38.7 on average, and a deviation more.
COPY_WORDS, COPY_RADIUS = 4, 44


def fingerprint(text: str | None, width: int = 3, words: int = 1) -> tuple[int, ...]:
    """The SimHash of the ``width``-word shingles, repeats included, as ``words`` numbers of 64 bits; zero for a text without words.

    A bit is one if it is set in over half of the shingles' values: the first word's
    value is the XXH64 value, the others' are mixed from it. Fewer words than ``width``
    make one shingle.
    """
    n_words = words
    words = (text or "").encode().lower().split()  # bytes: A-Z alone change, ASCII white space splits
    if not words:
        return (0,) * n_words
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: 1 - width or None], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    of = xxhash.xxh64_intdigest
    counts, n = np.zeros(64 * n_words, np.int64), len(starts)
    for at in range(0, n, 65536):  # so many at a time, for bounded memory with very long texts
        h = np.array([of(line[s:e], SEED) for s, e in zip(starts[at : at + 65536].tolist(), ends[at : at + 65536].tolist())], np.uint64)
        h = np.stack([_mixed(h, k) for k in range(n_words)], 1)
        for row in range(0, len(h), 255):  # so many bits add up within a byte
            bits = np.unpackbits(h[row : row + 255].view(np.uint8), axis=1, bitorder="little")
            counts += bits.sum(0, dtype=np.uint8)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return tuple(bits.view(np.uint64).tolist())


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The values themselves for word 0; for word k other values that follow from them."""
    if k:
        h = h + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ h >> np.uint64(shift)) * np.uint64(by)
        h ^= h >> np.uint64(31)
    return h


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, words: int = 1) -> DataFrame:
    """``(id, fp)`` of every row, fp as a signed long; of several words ``(id, fp, fp1, ...)``."""
    names = _names(words)

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(x.as_py(), width, words) for x in b.column(1)], np.uint64).reshape(-1, words).view(np.int64)
            yield pa.record_batch([b.column(0), *(pa.array(fp[:, k]) for k in range(words))], ["id", *names])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {', '.join(f'{n} long' for n in names)}")


def _names(words: int) -> list[str]:
    return ["fp", *(f"fp{k}" for k in range(1, words))]


def _masks(bits: list[int], blocks: int, same: int) -> list[int]:
    """Every choice of ``same`` out of ``blocks`` runs of the given bit positions, as a mask."""
    parts = np.array_split(np.array(bits), blocks)
    return [sum(1 << int(i) for part in pick for i in part) for pick in combinations(parts, same)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _near(fp: np.ndarray, node: np.ndarray, radius: int):
    """Edges that connect the fingerprints of one group just as all its close pairs would: each
    unreached fingerprint in turn reaches all close ones, breadth first, so n - 1 edges at most."""
    left = np.arange(len(fp))
    out_a, out_b = [], []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            close = np.bitwise_count(fp[left] ^ fp[i]).sum(1, dtype=np.int64) <= radius
            if close.any():
                got = left[close]
                out_a += [node[i]] * len(got)
                out_b += node[got].tolist()
                queue += got.tolist()
                left = left[~close]
    return out_a, out_b


def _edges(keyed: DataFrame, radius: int, most: int | None, words: int = 1) -> DataFrame:
    """Edges within each group of equal ``(mask, key)``; rows without ``b`` where a group is larger than ``most``.

    Rows arrive sorted by key. Memory holds one Arrow batch and at most that many rows
    of an open group; the rows of a larger group are passed on one by one.
    """
    names = _names(words)

    def run(batches):
        mask, key, node = (np.empty(0, np.int64) for _ in range(3))
        fp = np.empty((0, words), np.int64)
        big = None  # (mask, key) of the group now being passed on

        def out(a, b, m, f, n):
            if len(a) or len(n):
                k = len(a)
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate([np.asarray(a, np.int64), n])),
                        pa.array([*b, *[None] * len(n)], pa.int64()),
                        pa.array([*[None] * k, *m.tolist()], pa.int64()),
                        *(pa.array([*[None] * k, *f[:, w].tolist()], pa.int64()) for w in range(words)),
                    ],
                    ["a", "b", "mask", *names],
                )

        def flush(last: bool):
            nonlocal mask, key, fp, node, big
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            bounds = [0, *cut.tolist(), len(mask)]
            a, b, over = [], [], []
            for s, e in zip(bounds[:-1], bounds[1:]):
                if s == e:
                    continue
                open_end = e == len(mask) and not last
                if big == (mask[s], key[s]) or most is not None and e - s > most:
                    over.append(np.arange(s, e))
                    big = (mask[s], key[s])
                elif not open_end:
                    x, y = _near(fp[s:e].view(np.uint64), node[s:e], radius) if e - s > 1 else ((), ())
                    a += x
                    b += y
                if open_end:
                    keep = slice(e, e) if big == (mask[s], key[s]) else slice(s, e)
            over = np.concatenate(over) if over else np.empty(0, np.int64)
            yield from out(a, b, mask[over], fp[over], node[over])
            if not last and len(mask):
                mask, key, fp, node = mask[keep], key[keep], fp[keep], node[keep]

        for batch in batches:
            new = [np.asarray(c) for c in batch.columns]
            mask, key, node = (np.concatenate(x) for x in zip((mask, key, node), new))
            fp = np.concatenate((fp, np.stack(new[3:], 1)))
            yield from flush(False)
        yield from flush(True)

    parts = keyed.repartition("mask", "key").sortWithinPartitions("mask", "key", *names)
    return parts.select("mask", "key", "node", *names).mapInArrow(run, f"a long, b long, mask long, {', '.join(f'{n} long' for n in names)}")


def links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """Edges ``(a, b)`` that join distinct fingerprints at ``radius`` or fewer differing bits.

    The result connects the nodes as all close pairs would, without listing all
    pairs of a group. The 64 bits are split into six blocks; of close fingerprints
    at least three blocks agree, so every choice of three blocks is a key (32 bits).
    Fingerprints of a key group larger than GROUP are told apart by further keys
    over the bits that the first left free, again three of six blocks, after which
    at most 17 bits are free: no group then exceeds 131,072 distinct fingerprints,
    whatever the size of the input. A radius over 3 takes radius + 3 blocks, of which
    three agree likewise; its keys are more and shorter, and that bound on a group
    does not hold.
    """
    if not 0 <= radius <= 61:
        raise ValueError("64 bits make 64 blocks at most, for a radius of 61")
    blocks = max(6, radius + 3)
    first = _masks(list(range(64)), blocks, 3)
    array = F.array(*[F.lit(_signed(m)) for m in first])
    keyed = nodes.select("fp", "node", F.explode(array).alias("mask")).withColumn("key", F.expr("fp & mask"))
    found = materialize(_edges(keyed, radius, GROUP))
    over = found.where("b is null").select(F.col("a").alias("node"), "fp", "mask")
    if not over.isEmpty():
        finer = {_signed(m): [_signed(m | x) for x in _masks([i for i in range(64) if not m >> i & 1], blocks, 3)] for m in first}
        pick = F.create_map(*[x for m, more in finer.items() for x in (F.lit(m), F.array(*map(F.lit, more)))])
        again = over.select("fp", "node", F.explode(pick[F.col("mask")]).alias("mask")).withColumn("key", F.expr("fp & mask")).distinct()
        found = found.unionByName(materialize(_edges(again, radius, None)))
    return found.where("b is not null").select("a", "b")


def _key_bits(n: int, words: int) -> list[list[int]]:
    """The bits of every key for ``n`` fingerprints: as few keys as find FOUND of the pairs whose bits are equal with chance ALIKE.

    First the runs of bits that a word is cut into, then seeded choices of as many bits.
    """
    width, size = max(BLOCK, BLOCK + max(n, 1).bit_length() - FEW), 64 * words
    equal = np.arange(width, size + 1)
    chance = np.array([math.exp(math.lgamma(size + 1) - math.lgamma(e + 1) - math.lgamma(size - e + 1) + e * math.log(ALIKE) + (size - e) * math.log(1 - ALIKE)) for e in equal])
    alike = np.prod([(equal - i) / (size - i) for i in range(width)], axis=0)  # the chance that one key of such a pair is alike
    count = 1
    while chance @ (1 - (1 - alike) ** count) < FOUND:
        count += 1
    runs = [[64 * k + b * width + i for i in range(width)] for k in range(words) for b in range(64 // width)][:count]
    r = np.random.default_rng(SEED)
    return runs + [sorted(r.choice(64 * words, width, replace=False).tolist()) for _ in range(count - len(runs))]


def _keyed(nodes: DataFrame, bits: list[list[int]], names: list[str]) -> DataFrame:
    """Every fingerprint with each of its keys, ``mask`` being the key's number."""

    def run(batches):
        for b in batches:
            fp = np.stack([c.to_numpy() for c in b.columns[1:]], 1)
            ones = np.unpackbits(np.ascontiguousarray(fp).view(np.uint8), axis=1, bitorder="little")
            keys = np.stack([ones[:, at].astype(np.int64) @ (1 << np.arange(len(at))) for at in bits], 1)
            at = np.repeat(np.arange(len(b)), len(bits))
            yield pa.record_batch(
                [pa.array(np.tile(np.arange(len(bits)), len(b))), pa.array(keys.ravel()), b.column(0).take(pa.array(at)), *(pa.array(fp[at, w]) for w in range(len(names)))],
                ["mask", "key", "node", *names],
            )

    bounded_batches(nodes.sparkSession)
    return nodes.select("node", *names).mapInArrow(run, f"mask long, key long, node long, {', '.join(f'{n} long' for n in names)}")


def long_links(nodes: DataFrame, radius: int, words: int) -> DataFrame:
    """Edges ``(a, b)`` between fingerprints of several words that share a key and differ in ``radius`` or fewer bits.

    A key is the value of some of the bits (:func:`_key_bits`). Of pairs of similarity 0.8, whose bits are equal with chance ALIKE, 93 in 100
    share a key, of closer ones more, at any number of fingerprints: where keys get longer they get more (12 bits: 20, 16: 46, 24: 234).
    All pairs of a group are compared: a group of over LARGE_GROUP fingerprints in tiles, each pair of its parts
    in a task of its own, so no group is held or passed on by one task and none is left out. Edges connect
    a group's fingerprints as all its close pairs would, without listing them.
    """
    names = _names(words)
    keyed = _keyed(nodes, _key_bits(nodes.count(), words), names)
    part = max(1, LARGE_GROUP // 2)
    large = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > LARGE_GROUP)
    large = materialize(large.select("mask", "key", F.expr(f"cast((n + {part - 1}) div {part} as int)").alias("parts")))
    found = materialize(_edges(keyed.join(large, ["mask", "key"], "left_anti"), radius, None, words))
    if not large.isEmpty():
        own = F.expr("cast(pmod(xxhash64(node), parts) as int)")
        tiles = keyed.join(large, ["mask", "key"]).withColumn("own", own).withColumn("other", F.expr("explode(sequence(0, parts - 1))"))
        tile = F.xxhash64("mask", "key", F.least("own", "other"), F.greatest("own", "other"))
        found = found.unionByName(materialize(_edges(tiles.select("node", *names, "mask", tile.alias("key")), radius, None, words)))
    return found.where("b is not null").select("a", "b")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, width: int = 3, words: int = 1
) -> DataFrame:
    """One row per input row: ``(id, fingerprint, component_id)``.

    ``fingerprint`` is 16 lowercase hex digits a word; links of one word are exact
    (:func:`links`), those of several words are found by blocks (:func:`long_links`); ``component_id`` is the smallest id
    reachable over links of ``radius`` or fewer differing bits, itself included.
    Equal fingerprints are merged before the search, so a group of copies costs one
    node. Defined cases: null and wordless texts have the fingerprint zero and link
    like any other; a row with a null id keeps its fingerprint and takes the
    component of its fingerprint, null if no row with an id has that fingerprint;
    repeated rows and ties change nothing; an empty table gives no rows; other
    columns are ignored. Ids are whole numbers.
    """
    names = _names(words)
    fps = materialize(fingerprints(docs, id_col, text_col, width, words))
    nodes = materialize(fps.where("id is not null").groupBy(*names).agg(F.min("id").alias("node")))
    pairs = links(nodes, radius) if words == 1 else long_links(nodes, radius, words)
    comp = connected_components(pairs, "a", "b")
    named = nodes.join(comp, "node", "left").select(*names, F.coalesce("component", "node").alias("component_id"))
    digits = F.concat(*(F.lpad(F.lower(F.hex(n)), 16, "0") for n in names))
    return fps.join(named, names, "left").select("id", digits.alias("fingerprint"), "component_id")
