"""Exact merge-type SentencePiece encoding and decoding by backtracking."""

from __future__ import annotations

import re
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

SPACE = "▁"
INF = float("inf")
#: Entries of the encoder's memory of segments; when full it is emptied.
MEMORY = 300_000


def load_model(path: str) -> dict:
    """The parts of a BPE model that encoding and decoding need, small enough to go to every task."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    if sp.encode("  a  ", out_type=str)[0] != SPACE * 2 or sp.decode(sp.encode("  a  b")) != "  a  b":
        raise ValueError("only models that keep white space and put one mark before the text are supported")
    n = sp.get_piece_size()
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
    return {
        "pieces": [sp.id_to_piece(i) for i in range(n)],
        "scores": [sp.get_score(i) for i in range(n)],
        "special": special,
        "bytes": {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)},
    }


class Bpe:
    """Encoder and decoder of one model."""

    def __init__(self, model: dict):
        self.pieces = model["pieces"]
        self.byte_id = model["bytes"]
        self.id_byte = {i: bytes([b]) for b, i in self.byte_id.items()}
        normal = [i for i, s in enumerate(model["special"]) if not s]
        order = sorted(normal, key=lambda i: -model["scores"][i])
        self.rank = {self.pieces[i]: r for r, i in enumerate(order)}  # a smaller rank merges earlier
        self.id = {self.pieces[i]: i for i in normal}
        self.chars = {p for p in self.id if len(p) == 1}
        self.trees: dict[str, tuple | None] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        self.memory: dict[str, tuple[int, ...]] = {}
        inner = any(SPACE in p.lstrip(SPACE) for p in self.id)
        # No piece has a mark after another character, or a line break: merges never cross those places.
        line = "" if any("\n" in p for p in self.id) else "\n"
        self.segments = re.compile("(?s).+" if inner else f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+" + ("|\n+" if line else "")).findall
        self.matcher = ahocorasick.Automaton()  # over the pieces that merging can make
        self.shorter: dict[str, str] = {}  # the next shorter piece that starts a piece, or a stem of one
        for p in filter(self.tree, self.id):
            self.matcher.add_word(p, len(p))
        self.matcher.make_automaton()
        for p in self.matcher.keys():
            for n in range(len(p), 0, -1):
                if p[:n] not in self.shorter:
                    self.shorter[p[:n]] = next((p[:k] for k in range(n - 1, 0, -1) if self.matcher.exists(p[:k])), "")
        self.longest = {stem: stem if self.matcher.exists(stem) else self.shorter[stem] for stem in self.shorter}
        self.deepest = max(map(len, self.longest), default=0)
        self.text = [self.id_byte.get(i, p.replace(SPACE, " ").encode()) for i, p in enumerate(self.pieces)]

    def tree(self, piece: str):
        """``(time, left, right)`` of the merge that makes the piece, None if merging never makes it.

        The time is the largest rank among the merges below: merging takes the
        smallest rank at hand, so a merge happens once the parts exist and its rank is due.
        """
        if piece not in self.trees:
            parts = list(piece)
            while len(parts) > 1:
                ranks = [self.rank.get(a + b, INF) for a, b in zip(parts, parts[1:])]
                k = min(range(len(ranks)), key=ranks.__getitem__)
                if ranks[k] == INF:
                    break
                last = parts[k], parts[k + 1]
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            if len(parts) > 1:
                self.trees[piece] = None
            elif len(piece) == 1:
                self.trees[piece] = (-1, None, None)
            else:
                below = [self.tree(p) for p in last]
                self.trees[piece] = None if None in below else (max(self.rank[piece], below[0][0], below[1][0]), *last)
        return self.trees[piece]

    def spine(self, piece: str, side: int) -> list[str]:
        """The pieces at one edge (1 left, 2 right) of the merge tree, from the single character up."""
        out = [piece]
        while (down := self.tree(out[-1])[side]) is not None:
            out.append(down)
        return out[::-1]

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging the characters of ``a + b`` gives back a and b: re-merges both edges in
        order of time and looks for a merge across the border that is due first."""
        known = self.pairs.get(a, {}).get(b)
        if known is None:
            left, right, i, j, known = self.spine(a, 2), self.spine(b, 1), 0, 0, True
            while True:
                cross = self.rank.get(left[i] + right[j], INF)
                due_l = self.tree(left[i + 1])[0] if i + 1 < len(left) else INF
                due_r = self.tree(right[j + 1])[0] if j + 1 < len(right) else INF
                if cross < due_l and cross <= due_r and cross < INF:
                    known = False
                    break
                if due_l == due_r == INF:
                    break
                if due_l <= due_r:
                    i += 1
                else:
                    j += 1
            if self.n_pairs >= 2 * MEMORY:
                self.pairs.clear()
                self.n_pairs = 0
            self.pairs.setdefault(a, {})[b] = known
            self.n_pairs += 1
        return known

    def _run(self, s: str) -> list[int]:
        """Ids of a run of known characters, by backtracking over the longest matches."""
        open_ = bytearray(b"\1") * (len(s) + 1)  # places not yet known to fail
        depth, longest, deepest, pairs = self.matcher.longest_prefix, self.longest, self.deepest, self.pairs
        at, taken, last, size, none = 0, [], "", len(s), {}
        stem = s[:deepest]
        piece = longest[stem[: depth(stem)]]
        while True:
            end = at + len(piece)
            if open_[end]:
                if not last:
                    fits = True
                elif (fits := pairs.get(last, none).get(piece)) is None:
                    fits = self.compatible(last, piece)
                if fits:
                    taken.append(piece)
                    if end == size:
                        return [self.id[p] for p in taken]
                    at, last = end, piece
                    stem = s[at : at + deepest]
                    piece = longest[stem[: depth(stem)]]
                    continue
            piece = self.shorter[piece]
            if not piece:
                open_[at] = 0
                piece = taken.pop()
                at -= len(piece)
                last = taken[-1] if taken else ""

    def _segment(self, s: str) -> tuple[int, ...]:
        if self.chars.issuperset(s):
            ids = self._run(s)
        else:
            ids, run = [], 0
            for k, c in enumerate(s):
                if c not in self.chars:  # such a character is spelt in bytes and nothing merges with it
                    ids += self._run(s[run:k]) if k > run else []
                    ids += [self.byte_id[b] for b in c.encode()]
                    run = k + 1
            ids += self._run(s[run:]) if len(s) > run else []
        if len(s) > 64:
            return tuple(ids)
        if len(self.memory) >= MEMORY:
            self.memory.clear()
        self.memory[s] = ids = tuple(ids)
        return ids

    def encode_parts(self, text: str) -> list[tuple[int, ...]]:
        if not text:
            return []
        known, segment = self.memory.get, self._segment
        return [known(s) or segment(s) for s in self.segments(SPACE + text.replace(" ", SPACE))]

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; none for an empty one."""
        return list(chain.from_iterable(self.encode_parts(text)))

    def decode(self, ids) -> str:
        """Text of ids: pieces joined, marks as spaces without the first, byte pieces as UTF-8."""
        text = self.text
        out = b"".join([text[i] for i in ids])
        if out[:1] == b" " and self.pieces[ids[0]][:1] == SPACE:
            out = out[1:]
        return out.decode("utf-8", "replace")


_ready: list[Bpe] = []


def ready(model: dict) -> Bpe:
    """The encoder of a model; a Python worker keeps the last one, with its memory."""
    if not _ready or _ready[0].pieces != model["pieces"]:
        _ready[:] = [Bpe(model)]
    return _ready[0]


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>, decoded string)`` of every row, ids exactly as the library's encode gives them.

    A map over rows without a shuffle. The model goes along with the tasks (its
    size is the vocabulary's), so only the driver opens the file. A segment between
    white space is encoded once and remembered in a memory of bounded size.
    Defined cases: a null or empty text has no ids and decodes to the empty text; a
    null id is passed through; repeated rows repeat; an empty table gives no rows; a text of
    any length is encoded whole; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(load_model(model_path))

    def run(batches):
        bpe = ready(model.value)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                flat, ends, decoded = [], [0], []
                for x in part.column(1):
                    ids = np.fromiter(chain.from_iterable(bpe.encode_parts(x.as_py() or "")), np.int32)
                    flat.append(ids)
                    ends.append(ends[-1] + len(ids))
                    decoded.append(bpe.decode(ids.tolist()))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat)))
                yield pa.record_batch([part.column(0), lists, pa.array(decoded, pa.string())], ["id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, decoded string")
