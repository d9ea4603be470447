"""Toxicity scores by a bidirectional gated recurrent network over word and character inputs."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches

#: A word of letters in a lower-cased text.
LETTERS = re.compile(r"[^\W\d_]+")
#: Letters of a word, letters that the pieces of a longer one share: a character input lies in one piece whole.
LONG, SHARED = 40, 5
#: Words of a window, words between the starts of overlapping windows.
WINDOW, STRIDE = 32, 16
#: Width of a word's own embedding and of that of its characters, of both together, and of each direction's state.
HALF, WIDTH, STATE = 4, 8, 8
#: Labelled rows of each class that are learnt from at most, and under which none is kept from choosing words; vocabulary sizes.
SAMPLE, FEW, WORDS, GRAMS = 1500, 200, 4000, 8000


def words_of(text: str | None) -> list[str]:
    """The words of a text, lower-cased; a run of over LONG letters, as in scripts without spaces, as overlapping pieces."""
    found = LETTERS.findall((text or "").lower())
    if max(map(len, found), default=0) <= LONG:
        return found
    return [w[i : i + LONG] for w in found for i in range(0, max(len(w) - SHARED, 1), LONG - SHARED)]


def grams(word: str) -> list[str]:
    """Character inputs of a word: its runs of four to six letters, with marks at both ends."""
    w = f"^{word}$"
    return [w[i : i + n] for n in (4, 5, 6) for i in range(len(w) - n + 1)]


def gram_numbers(word: str) -> np.ndarray:
    return np.array([zlib.crc32(g.encode()) for g in grams(word)], np.uint32)


def _weights(toxic: list[np.ndarray], clean, n1: int, n0: int, most: int, least_z: float) -> list[tuple[int, float]]:
    """Log odds of the inputs (numbers) that mark the toxic rows most surely, from each row's own inputs."""
    marks, a = np.unique(np.concatenate(toxic), return_counts=True)
    marks, a = marks[a >= 3], a[a >= 3]
    if not len(marks):
        return []
    c = np.zeros(len(marks), np.int64)
    for row in clean:
        at = np.minimum(np.searchsorted(marks, row), len(marks) - 1)
        c[at[marks[at] == row]] += 1
    base, n = n1 / (n1 + n0), a + c
    z = (a - n * base) / np.sqrt(n * base * (1 - base))
    odds = np.log((a + 0.5) / (n1 + 1)) - np.log((c + 0.5) / (n0 + 1))
    pick = np.lexsort((marks, -z))
    pick = pick[z[pick] >= least_z][:most]
    return list(zip(marks[pick].tolist(), odds[pick].tolist()))


class BiGru:
    """Gated recurrent units over a window in both directions, attention pooling, one logit; plain numpy."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        w = lambda *s: (r.standard_normal(s) * 0.3).astype(np.float32)
        self.p = {"att": w(2 * STATE), "out": w(2 * STATE), "bias": np.full(1, -2, np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": w(WIDTH, 3 * STATE), f"U{d}": w(STATE, 3 * STATE), f"c{d}": np.zeros(3 * STATE, np.float32)}

    @staticmethod
    def _sig(x):
        return 0.5 * np.tanh(0.5 * x) + 0.5

    def _way(self, x, d):
        """States of one direction over ``x`` (time, window, input), and what the gradient needs."""
        p, k = self.p, STATE
        gates = x @ p[f"W{d}"] + p[f"c{d}"]
        h, states, kept = np.zeros((x.shape[1], k), np.float32), [None] * len(x), [None] * len(x)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            g = gates[t]
            u = h @ p[f"U{d}"]
            z, r = self._sig(g[:, :k] + u[:, :k]), self._sig(g[:, k : 2 * k] + u[:, k : 2 * k])
            n = np.tanh(g[:, 2 * k :] + r * u[:, 2 * k :])
            kept[t] = (h, z, r, n, u[:, 2 * k :])
            h = z * h + (1 - z) * n
            states[t] = h
        return np.stack(states), kept

    def forward(self, x, mask):
        """Logits of windows ``x`` (time, window, input); ``mask`` is 1 where a word stands."""
        f, kf = self._way(x, "f")
        b, kb = self._way(x, "b")
        s = np.concatenate([f, b], 2)
        a = s @ self.p["att"] + (mask - 1) * 30
        a = np.exp(a - a.max(0))
        a /= a.sum(0)
        pooled = (a[..., None] * s).sum(0)
        return pooled @ self.p["out"] + self.p["bias"], (x, s, a, pooled, kf, kb)

    def backward(self, dlogit, memo):
        """Gradients of the parameters by name, and of the inputs."""
        x, s, a, pooled, kf, kb = memo
        p, k, grad, inputs = self.p, STATE, {}, np.zeros_like(x)
        grad["bias"], grad["out"] = dlogit.sum(keepdims=True), pooled.T @ dlogit
        dpool = dlogit[:, None] * p["out"]
        da = (s * dpool).sum(2)
        da = a * (da - (a * da).sum(0))
        ds = a[..., None] * dpool + da[..., None] * p["att"]
        grad["att"] = np.einsum("tw,twk->k", da, s)
        for d, kept, part in (("f", kf, ds[..., :k]), ("b", kb, ds[..., k:])):
            W, U, c, dh = np.zeros_like(p[f"W{d}"]), np.zeros_like(p[f"U{d}"]), np.zeros_like(p[f"c{d}"]), 0
            for t in range(len(x) - 1, -1, -1) if d == "f" else range(len(x)):
                h, z, r, n, un = kept[t]
                dh = dh + part[t]
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                dg = np.concatenate([dz, dr, dn], 1)
                du = np.concatenate([dz, dr, dn * r], 1)
                W += x[t].T @ dg
                inputs[t] += dg @ p[f"W{d}"].T
                c += dg.sum(0)
                U += h.T @ du
                dh = dh * z + du @ p[f"U{d}"].T
            grad |= {f"W{d}": W, f"U{d}": U, f"c{d}": c}
        return grad, inputs


class ToxicityModel:
    """Word and character vocabularies, each with learnt embeddings, and the network over them.

    Row 0 of the word embeddings stands for every word outside the vocabulary.
    """

    def __init__(self, words: dict[str, float], chars: dict[str, float], net: BiGru, seed: int = 7):
        """Vocabularies come with log odds, at which each embedding's first place starts; the others start at random."""
        r = np.random.default_rng(seed)
        self.words = {w: k for k, w in enumerate(words, 1)}
        self.chars = {g: k for k, g in enumerate(chars)}
        start = lambda odds: np.column_stack([np.array(odds, np.float32) / 4, r.standard_normal((len(odds), HALF - 1)) * 0.1]).astype(np.float32)
        self.word_rows, self.char_rows = start([0.0, *words.values()]), start([*chars.values()])
        self.net = net
        self.start()

    def start(self):
        self.memory: dict[str, int] = {}
        self.vectors = [np.concatenate([self.word_rows[0], np.zeros(HALF, np.float32)])]  # number 0: a word that no input marks
        self.table = np.stack(self.vectors)

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("words", "chars", "word_rows", "char_rows", "net")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.start()

    def rows(self, word: str) -> tuple[int, list[int]]:
        """A word's row among the word embeddings, and the rows of its character runs."""
        known = self.chars
        return self.words.get(word, 0), sorted({known[g] for g in grams(word) if g in known})

    def vector(self, word: str) -> np.ndarray:
        """Inputs of a word: its own embedding, and the sum of its character runs' embeddings by the root of their number."""
        own, runs = self.rows(word)
        if not own and not runs:
            return self.vectors[0]
        chars = self.char_rows[runs].sum(0) / np.sqrt(len(runs), dtype=np.float32) if runs else np.zeros(HALF, np.float32)
        return np.concatenate([self.word_rows[own], chars])

    def number(self, word: str) -> int:
        if len(self.memory) > 300_000:
            self.start()
        v = self.vector(word)
        n = 0
        if v is not self.vectors[0]:
            n = len(self.vectors)
            self.vectors.append(v)
        self.memory[word] = n
        return n

    def numbers(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        known = self.memory.get
        out = [known(w, -1) for w in words]
        if -1 in out:
            gone = len(self.memory)
            out = []
            for w in words:
                n = known(w, -1)
                out.append(self.number(w) if n < 0 else n)
                if len(self.memory) < gone:  # the memory was emptied on the way: number this text anew
                    return self.numbers(text)
                gone = len(self.memory)
        return np.array(out, np.int32)

    def windows(self, numbers: np.ndarray) -> np.ndarray:
        """All overlapping windows of a text, -1 where a window is longer than what is left; one at least."""
        n = max(len(numbers), 1)
        starts = np.arange(0, max(n - WINDOW + STRIDE, 1), STRIDE)
        padded = np.full(starts[-1] + WINDOW, -1, np.int32)
        padded[: len(numbers)] = numbers
        return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[starts]

    def inputs(self, windows: np.ndarray):
        if len(self.table) < len(self.vectors):
            self.table = np.stack(self.vectors)
        x = self.table[np.maximum(windows, 0)].transpose(1, 0, 2)
        return np.ascontiguousarray(x), (windows >= 0).T.astype(np.float32)

    def score_windows(self, windows: np.ndarray) -> np.ndarray:
        """Scores of windows; windows whose inputs are alike are computed once."""
        if not len(windows):
            return np.zeros(0)
        kinds, back = np.unique(windows, axis=0, return_inverse=True)
        out = np.empty(len(kinds))
        for at in range(0, len(kinds), 2048):
            logit, _ = self.net.forward(*self.inputs(kinds[at : at + 2048]))
            out[at : at + 2048] = 1 / (1 + np.exp(-np.clip(logit.astype(float), -30, 30)))
        return out[back.ravel()]

    def score(self, texts: list[str | None]) -> list[float]:
        """The largest window score of each text."""
        of, scores = [], []
        open_, n, size = [], 0, len(self.memory)

        def close():
            nonlocal open_, n
            if open_:
                got = self.score_windows(np.concatenate(open_))
                at = 0
                for w in open_:
                    scores.append(float(got[at : at + len(w)].max()))
                    at += len(w)
                open_, n = [], 0

        for text in texts:
            if len(self.memory) > 250_000:  # numbers stay as they are while windows wait
                close()
                self.start()
            w = self.windows(self.numbers(text))
            open_.append(w)
            n += len(w)
            if n > 4096:
                close()
        close()
        return scores


def fit(texts: list[str | None], toxic: list[int], seed: int = 7, epochs: int = 6) -> ToxicityModel:
    """Train on labelled texts: vocabularies by log odds, then embeddings and network on windows by gradient descent (Adam).

    Every other text of a class chooses the vocabularies, the rest teach: a word that
    stands in toxic texts by chance is then no sure mark in those. A toxic text teaches
    by its most marked window, a clean one by its most marked window and one drawn at
    random. Where a class has under FEW texts, all serve both ends. Without rows of both classes every score is the
    share of toxic rows, 0 if there are none.
    """
    n1 = sum(toxic)
    n0 = len(toxic) - n1
    model = ToxicityModel({}, {}, BiGru(seed))
    if not n1 or not n0:
        model.net.p["bias"][:] = 30 if n1 else -30
        model.net.p["out"][:] = 0
        return model
    turn = {y: [k for k, v in enumerate(toxic) if v == y] for y in (0, 1)}
    step = 2 if min(n0, n1) >= FEW else 1
    choosing = {k for ks in turn.values() for k in ks[::step]}
    teaching = [k for k in range(len(texts)) if k not in choosing or step == 1]
    number: dict[str, int] = {}
    own = [np.unique(np.array([number.setdefault(w, len(number)) for w in words_of(x)], np.int64)) for x in texts]
    toxic_rows, clean_rows = ([own[k] for k in turn[y] if k in choosing] for y in (1, 0))
    n1, n0 = len(toxic_rows), len(clean_rows)
    names = list(number)
    weights = {names[k]: v for k, v in _weights(toxic_rows, clean_rows, n1, n0, WORDS, 4.5)}
    runs: dict[int, np.ndarray] = {}

    def chars(row):
        return np.unique(np.concatenate([runs[k] if k in runs else runs.setdefault(k, gram_numbers(names[k])) for k in row.tolist()] or [np.empty(0, np.uint32)]))

    marks = dict(_weights([chars(w) for w in toxic_rows], map(chars, clean_rows), n1, n0, GRAMS, 5.5))
    seen = (names[k] for k in np.unique(np.concatenate(toxic_rows)).tolist())
    odds = {g: marks[n] for w in seen for g in grams(w) if (n := zlib.crc32(g.encode())) in marks}
    del own, toxic_rows, clean_rows, runs
    model = ToxicityModel(weights, odds, BiGru(seed), seed)
    rows = [model.rows(w) for w in names]
    mark = np.array([weights.get(w, 0.0) + max((odds[g] for g in grams(w) if g in odds), default=0.0) if row[0] or row[1] else 0.0 for w, row in zip(names, rows)] + [0.0])
    r = np.random.default_rng(seed)
    picked, labels = [], []
    for k in teaching:
        y, w = toxic[k], model.windows(np.array([number[v] for v in words_of(texts[k])], np.int32))
        picks = [int(mark[w].sum(1).argmax())] + ([int(r.integers(len(w)))] if not y else [])
        picked += [w[i] for i in picks]
        labels += [y] * len(picks)
    _descend(model, np.array(picked), np.array(labels, np.float32), rows, r, epochs)
    return model


def _descend(model: ToxicityModel, windows: np.ndarray, y: np.ndarray, rows: list[tuple[int, list[int]]], r, epochs: int) -> None:
    """Train the network and both tables of embeddings on labelled windows of words, whose embeddings' rows are given."""
    mask = (windows >= 0).T.astype(np.float32)
    marked = [k for k in np.unique(windows).tolist() if k >= 0 and (rows[k][0] or rows[k][1])]
    kind = np.zeros(len(rows) + 1, np.int64)  # 0 for all that nothing marks, and for no word
    kind[marked] = np.arange(1, len(marked) + 1)
    windows = kind[windows]
    own = np.array([0, *(rows[k][0] for k in marked)])
    flat = np.array([x for k in marked for x in rows[k][1]], np.int64)
    of = np.repeat(np.arange(1, len(marked) + 1), [len(rows[k][1]) for k in marked])
    scale = (1 / np.sqrt(np.maximum(np.bincount(of, minlength=len(own)), 1))).astype(np.float32)[of, None]
    net, step = model.net, 0
    p = net.p | {"words": model.word_rows, "chars": model.char_rows}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    for epoch in range(epochs):
        order = r.permutation(len(y))
        for at in range(0, len(y), 100):
            pick = order[at : at + 100]
            table = np.zeros((len(own), WIDTH), np.float32)
            table[:, :HALF] = p["words"][own]
            np.add.at(table[:, HALF:], of, p["chars"][flat] * scale)
            w = windows[pick]
            net.p = {k: p[k] for k in net.p}
            logit, memo = net.forward(np.ascontiguousarray(table[w].transpose(1, 0, 2)), mask[:, pick])
            d = (1 / (1 + np.exp(-logit)) - y[pick]) / len(pick)
            (grad, inputs), step = net.backward(d.astype(np.float32), memo), step + 1
            down = np.zeros_like(table)
            np.add.at(down, w.T.ravel(), (inputs * mask[:, pick, None]).reshape(-1, WIDTH))
            grad |= {"words": np.zeros_like(p["words"]), "chars": np.zeros_like(p["chars"])}
            np.add.at(grad["words"], own, down[:, :HALF])
            np.add.at(grad["chars"], flat, down[of, HALF:] * scale)
            rate = 0.02 * (1 - epoch / (epochs + 1))
            for k, g in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.99 * s[k] + 0.01 * g * g
                p[k] = (p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    net.p = {k: p[k] for k in net.p}
    model.word_rows, model.char_rows = p["words"], p["chars"]
    model.start()


def held_out(doc_id) -> F.Column:
    """Whether a row is kept from training: CRC-32 of its id as text is divisible by five."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> ToxicityModel:
    """Fit on at most ``most`` labelled rows of each class, the first in an order by a hash of the id.

    That bound is what lets the training rows go to the driver; it holds at every
    size of the input. Held-out rows, and rows without id or label, are never used.
    """
    ours = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    ours = ours.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.lit(5), F.col("doc_id"))
    picks = [ours.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(most) for y in (0, 1)]
    picked = {i: y for p in picks for i, y in p.select("doc_id", "toxic").collect()}
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.sparkSession.createDataFrame([(i,) for i in picked], f"doc_id {kind}")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").distinct().toArrow()
    rows = sorted(zip(rows["doc_id"].to_pylist(), rows["text"].to_pylist()), key=lambda r: (r[0], r[1] or ""))
    return fit([t for _, t in rows], [picked[i] for i, _ in rows])


def score_column(spark: SparkSession, model: ToxicityModel):
    """A function from a text Column to its score: the largest among all overlapping windows of the whole text.

    Arrow batches; the model, whose size the vocabulary bounds fix, goes along with the tasks.
    """
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in batches:
            yield pd.Series(sent.value.score(text.tolist()), dtype="float64")
        sent.value.start()  # the worker may wait for other work: give the memory back

    return score_text


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of every row.

    A map over rows without a shuffle. Defined cases: null, empty and wordless texts
    are scored as one window without words; repeated rows score alike; an empty
    table gives no rows; other columns are ignored.
    """
    of = score_column(docs.sparkSession, model)
    return docs.select(F.col(id_col).alias("id"), of(F.col(text_col)).alias("score"))
