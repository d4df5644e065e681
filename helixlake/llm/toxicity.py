"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as its characters (UTF-8 bytes, read by a bidirectional GRU) and as itself (a hashed embedding). A second
bidirectional GRU reads the words of a window, attention pools its states, and a logistic unit scores the window. All
windows of ``window`` words, each half overlapping the next, are scored; a text's score is that of its worst window,
calibrated by Platt's method. Training sees only the worst window of each text (multiple-instance learning), as a label
says that some part is toxic, not which.

The network is fitted on the driver, on at most ``SAMPLE`` labelled texts a class and ``SAMPLE_WINDOWS`` windows of
each (those with the least hash). Scoring reads every window of every text.

Edge cases: null and empty texts are scored as a window without words; words over 24 bytes are read in pieces of 24; with
fewer than two kinds of label every score is the share of label 1 (0 without labels); repeated rows get the same score;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches

SAMPLE, SAMPLE_WINDOWS = 2000, 12
WINDOW, PIECE = 48, 24
CHARS, WORD_SLOTS = 8, 1 << 13
HIDDEN_CHAR, WORD_DIM, HIDDEN = 8, 8, 8
SHUT = 30.0  # added to the update gate of a pad, which then keeps the state


def sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


def pieces(text: bytes | None) -> list[bytes]:
    """Lower-case words in pieces of at most PIECE bytes."""
    words = (text or b"").decode("utf-8", "replace").lower().encode().split()
    if not any(len(w) > PIECE for w in words):
        return words
    return [w[i : i + PIECE] for w in words for i in range(0, len(w), PIECE)]


def windows_of(n: int, window: int = WINDOW) -> np.ndarray:
    """Starts of the overlapping windows that cover ``n`` words."""
    return np.arange(0, max(1, n - window // 2), window // 2)


def gru(x: np.ndarray, u: np.ndarray, bias: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States of a GRU over x (time, batch, 3 hidden: update, reset and candidate inputs)."""
    hidden = u.shape[0]
    h, out = np.zeros((x.shape[1], hidden), x.dtype), np.empty((*x.shape[:2], hidden), x.dtype)
    for t in range(len(x)):
        g = h @ u
        zr = sigmoid(x[t, :, : 2 * hidden] + g[:, : 2 * hidden])
        z, r = zr[:, :hidden], zr[:, hidden:]
        gn = g[:, 2 * hidden :] + bias
        n = np.tanh(x[t, :, 2 * hidden :] + r * gn)
        if keep is not None:
            keep.append((h, z, r, n, gn))
        h = n + z * (h - n)
        out[t] = h
    return out


def gru_back(d_out: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the inputs, the recurrent weights and the candidate's bias."""
    hidden = u.shape[0]
    dx, du, db = np.empty((*d_out.shape[:2], 3 * hidden)), np.zeros_like(u), np.zeros(hidden)
    dh = np.zeros(d_out.shape[1:])
    for t in range(len(d_out) - 1, -1, -1):
        h, z, r, n, gn = kept[t]
        dh = dh + d_out[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * gn * r * (1 - r)
        dg = np.concatenate([dz, dr, dn * r], 1)
        dx[t] = np.concatenate([dz, dr, dn], 1)
        du += h.T @ dg
        db += (dn * r).sum(0)
        dh = dh * z + dg @ u.T
    return dx, du, db


def scattered(place: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` by place."""
    return np.stack([np.bincount(place, c, n) for c in values.T], 1)


class Network:
    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        w = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        d = 2 * HIDDEN_CHAR + WORD_DIM
        self.p = {"chars": rng.normal(0, 0.5, (257, CHARS)), "words": rng.normal(0, 0.05, (WORD_SLOTS, WORD_DIM))}
        for name, size, hidden in (("c", CHARS, HIDDEN_CHAR), ("w", d, HIDDEN)):
            for way in "fb":
                self.p |= {f"{name}{way}x": w(size, 3 * hidden), f"{name}{way}u": w(hidden, 3 * hidden), f"{name}{way}b": np.zeros(3 * hidden), f"{name}{way}n": np.zeros(hidden)}
        self.p |= {"attend": w(2 * HIDDEN), "out": w(2 * HIDDEN), "bias": np.zeros(1)}
        self.scale = (1.0, 0.0)

    # words

    @staticmethod
    def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Characters (time, word; 256 pads the end) and slots."""
        text = np.full((len(words), max([1, *map(len, words)])), 256)
        for i, w in enumerate(words):
            text[i, : len(w)] = np.frombuffer(w, np.uint8)
        return text.T, np.array([xxhash.xxh3_64_intdigest(w) % WORD_SLOTS for w in words], np.int64)

    def word_vectors(self, chars: np.ndarray, slots: np.ndarray, keep: dict | None = None, dtype=np.float64) -> np.ndarray:
        p, out = self.p, []
        for way in "fb":
            gates = p["chars"] @ p[f"c{way}x"] + p[f"c{way}b"]
            gates[256, :HIDDEN_CHAR] += SHUT
            x = gates.astype(dtype)[chars if way == "f" else chars[::-1]]
            kept = None if keep is None else keep.setdefault(f"c{way}", [])
            out.append(gru(x, p[f"c{way}u"].astype(dtype), p[f"c{way}n"].astype(dtype), kept)[-1])
        return np.concatenate([*out, p["words"][slots]], 1)

    def inputs(self, vectors: np.ndarray) -> np.ndarray:
        """What the word GRUs read of each word: forward and backward gates."""
        return np.concatenate([vectors @ self.p[f"w{way}x"] + self.p[f"w{way}b"] for way in "fb"], 1)

    # windows

    def logits(self, inputs: np.ndarray, place: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Of windows; place (window, time) points into ``inputs``, -1 at pads. The last row of inputs is the pad's."""
        p, g, states = self.p, 3 * HIDDEN, []
        at = place.T
        for i, way in enumerate("fb"):
            x = inputs[:, i * g : (i + 1) * g][at if way == "f" else at[::-1]]
            kept = None if keep is None else keep.setdefault(f"w{way}", [])
            h = gru(x, p[f"w{way}u"].astype(x.dtype), p[f"w{way}n"].astype(x.dtype), kept)
            states.append(h if way == "f" else h[::-1])
        h = np.concatenate(states, 2)
        a = h @ p["attend"].astype(h.dtype) - 1e4 * (at < 0)
        a = np.exp(a - a.max(0))
        a /= a.sum(0)
        pooled = np.einsum("tb,tbh->bh", a, h)
        if keep is not None:
            keep |= {"h": h, "a": a, "pooled": pooled}
        return pooled @ p["out"].astype(h.dtype) + p["bias"][0].astype(h.dtype)

    def table(self, words: list[bytes], dtype=np.float32) -> np.ndarray:
        """``inputs`` of different words and, last, of the pad."""
        out = np.empty((len(words) + 1, 6 * HIDDEN), dtype)
        order = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")  # words of a length cost no pads
        for i in range(0, len(words), 4096):
            own = order[i : i + 4096]
            out[own] = self.inputs(self.word_vectors(*self.spelled([words[k] for k in own]), dtype=dtype))
        out[-1] = self.pad_row(dtype)
        return out

    @staticmethod
    def pad_row(dtype=np.float32) -> np.ndarray:
        pad = np.zeros((1, 6 * HIDDEN), dtype)
        pad[0, :HIDDEN] = pad[0, 3 * HIDDEN : 4 * HIDDEN] = SHUT
        return pad

    # training

    def gradients(self, words: list[bytes], place: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, keep, d_char = self.p, {}, 2 * HIDDEN_CHAR
        chars, slots = self.spelled(words)
        vectors = self.word_vectors(chars, slots, keep)
        inputs = np.concatenate([self.inputs(vectors), self.pad_row(float)])
        logit = self.logits(inputs, place, keep)
        d = (sigmoid(logit) - y) / len(y)
        h, a = keep["h"], keep["a"]
        grad = {"out": keep["pooled"].T @ d, "bias": d.sum(keepdims=True), "words": np.zeros_like(p["words"]), "chars": np.zeros_like(p["chars"])}
        d_pooled = d[:, None] * p["out"]
        d_a = np.einsum("tbh,bh->tb", h, d_pooled)
        d_score = a * (d_a - (a * d_a).sum(0))
        d_h = a[:, :, None] * d_pooled + d_score[:, :, None] * p["attend"]
        grad["attend"] = np.einsum("tb,tbh->h", d_score, h)
        at, d_vec = place.T, np.zeros_like(vectors)
        for i, way in enumerate("fb"):
            own = d_h[:, :, i * HIDDEN : (i + 1) * HIDDEN]
            dx, du, db = gru_back(own if way == "f" else own[::-1], p[f"w{way}u"], keep[f"w{way}"])
            at_pad = np.where(at < 0, len(vectors), at)
            d_in = scattered((at_pad if way == "f" else at_pad[::-1]).ravel(), dx.reshape(-1, 3 * HIDDEN), len(inputs))
            d_in = d_in[:-1]  # the pad's row has no weights
            grad |= {f"w{way}u": du, f"w{way}n": db, f"w{way}b": d_in.sum(0), f"w{way}x": vectors.T @ d_in}
            d_vec += d_in @ p[f"w{way}x"].T
        np.add.at(grad["words"], slots, d_vec[:, d_char:])
        for i, way in enumerate("fb"):
            d_state = np.zeros((*chars.shape, HIDDEN_CHAR))
            d_state[-1] = d_vec[:, i * HIDDEN_CHAR : (i + 1) * HIDDEN_CHAR]
            dx, du, db = gru_back(d_state, p[f"c{way}u"], keep[f"c{way}"])
            dx = dx if way == "f" else dx[::-1]
            d_in = scattered(chars.ravel(), dx.reshape(-1, 3 * HIDDEN_CHAR), 257)
            d_in[256] = 0
            grad |= {f"c{way}u": du, f"c{way}n": db, f"c{way}b": d_in.sum(0), f"c{way}x": p["chars"].T @ d_in}
            grad["chars"] += d_in @ p[f"c{way}x"].T
        return grad

    def fit(self, texts: list[list[list[bytes]]], y: np.ndarray, steps: int = 400, batch: int = 64, rate: float = 0.01, seed: int = 1) -> Network:
        """texts: the windows of each text, as words. Each step takes as many texts of either label."""
        rng = np.random.default_rng(seed)
        vocabulary = sorted({w for t in texts for win in t for w in win})
        number = {w: i for i, w in enumerate(vocabulary)}
        coded = [[np.array([number[w] for w in win], np.int64) for win in t] for t in texts]
        ones, zeros = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        table = None
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            own = np.concatenate([rng.choice(ones, batch // 2), rng.choice(zeros, batch // 2)])
            if step % 60 == 21:  # what the windows read, as of now; at first, any window counts as the worst
                table = self.table(vocabulary)
            wins = [win for i in own for win in coded[i]]
            score = rng.random(len(wins)) if table is None else self.logits(table, self._padded(wins))
            worst, k = [], 0
            for i in own:
                worst.append(coded[i][int(np.argmax(score[k : k + len(coded[i])]))])
                k += len(coded[i])
            used, place = self._placed(worst)
            grad = self.gradients([vocabulary[u] for u in used], place, y[own])
            slow = rate * min(1, 2 * (1 - step / (steps + 1)))
            for name, g in grad.items():
                if name == "words":
                    g = g + 1e-3 * self.p[name]
                norm = np.sqrt((g * g).sum())
                g = g / max(1, norm)
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                self.p[name] -= slow * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-7)
        return self

    @staticmethod
    def _padded(wins: list[np.ndarray]) -> np.ndarray:
        place = np.full((len(wins), max([1, *map(len, wins)])), -1)
        for r, w in enumerate(wins):
            place[r, : len(w)] = w
        return place

    def _placed(self, wins: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        place = self._padded(wins)
        used, inverse = np.unique(place, return_inverse=True)
        pads = int(len(used) > 0 and used[0] < 0)
        return used[pads:], inverse.reshape(place.shape) - pads

    def calibrate(self, logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        a, b = 1.0, 0.0
        for _ in range(300):
            d = (sigmoid(a * logit + b) - y) * weight
            a, b = a - 0.5 * ((d * logit).sum() / weight.sum() / max(1, (logit**2).mean()) + 1e-4 * a), b - 0.5 * d.sum() / weight.sum()
        self.scale = (max(a, 1e-3), b)


class Scorer:
    """Scores whole texts; remembers what the network reads of a word."""

    MOST = 300_000

    def __init__(self, network: Network):
        self.network, self.number = network, {}
        self.rows = np.empty((0, 6 * HIDDEN), np.float32)

    def _learn(self, words: set[bytes]) -> None:
        if len(self.number) + len(words) > self.MOST:
            self.number, self.rows = {}, self.rows[:0]
        new = [w for w in words if w not in self.number]
        if new:
            self.rows = np.concatenate([self.rows, self.network.table(new)[:-1]])
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))

    def logits(self, texts: list[bytes | None], batch: int = 4096) -> np.ndarray:
        words = [pieces(t) for t in texts]
        self._learn({w for own in words for w in own})
        get, starts, lens, owner, at = self.number.__getitem__, [], [], [], 0
        for i, own in enumerate(words):
            s = windows_of(len(own))
            starts.append(s + at)
            lens.append(np.minimum(WINDOW, len(own) - s))
            owner.append(np.full(len(s), i))
            at += len(own)
        ids = np.fromiter((get(w) for own in words for w in own), np.int64, at)
        starts, lens, owner = map(np.concatenate, (starts, lens, owner))
        table = np.concatenate([self.rows, self.network.pad_row()])
        ids, worst = np.append(ids, -1), np.full(len(texts), -np.inf)
        for lo in range(0, len(starts), batch):
            s, n = starts[lo : lo + batch], lens[lo : lo + batch]
            cols = np.arange(max(1, int(n.max())))
            place = np.where(cols < n[:, None], ids[np.minimum(s[:, None] + cols, at)], -1)
            np.maximum.at(worst, owner[lo : lo + batch], self.network.logits(table, place))
        return worst

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        a, b = self.network.scale
        return sigmoid(a * self.logits(texts) + b)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_windows: int = SAMPLE_WINDOWS) -> Network | float:
    """From labels (doc_id, toxic); the share of label 1 if there are no two kinds."""
    labels = labels.where("doc_id is not null and toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    share = {r.toxic: r["count"] for r in labels.groupBy("toxic").count().collect()}
    if not share.get(0) or not share.get(1):
        return 1.0 if share.get(1) else 0.0
    # A bar on the hash leaves about twice the sample, so that few rows are sorted for it.
    near = lambda k: F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) <= int(min(1, 2 * sample / share[k]) * (1 << 30))
    chosen = [labels.where(f"toxic = {k}").where(near(k)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    chosen = F.broadcast(chosen[0].union(chosen[1]))  # at most 2 * sample rows

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            out = []
            for text in batch.column("text").to_pylist():
                words = pieces(text)
                s = sorted(windows_of(len(words)).tolist(), key=lambda x: xxhash.xxh3_64_intdigest(str(x)))[:sample_windows]
                out.append([b" ".join(words[x : x + WINDOW]) for x in s])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(out, pa.list_(pa.binary()))], ["doc_id", "toxic", "windows"])

    joined = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(chosen, "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic", "text")
    rows = sorted(joined.mapInArrow(cut, "doc_id long, toxic int, windows array<binary>").collect(), key=lambda r: (r.doc_id, r.toxic, r.windows))
    if len({r.toxic for r in rows}) < 2:
        return share[1] / (share[0] + share[1])
    texts, y = [[bytes(w).split() for w in r.windows] for r in rows], np.array([r.toxic for r in rows], float)
    network = Network().fit(texts, y)
    scorer = Scorer(network)
    logit = scorer.logits([b" ".join(w for win in t for w in win) for t in texts])
    counts = np.array([max(1, (y == k).sum()) for k in (0, 1)])
    network.calibrate(logit, y, np.where(y == 1, share[1] / counts[1], share[0] / counts[0]))
    return network


_scorers: dict[bytes, Scorer] = {}


def score(docs: DataFrame, model: Network | float) -> DataFrame:
    """doc_id and score of every document."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        if not isinstance(model, float):
            mark = xxhash.xxh3_64_digest(b"".join(v.tobytes() for v in model.p.values()))
            if mark not in _scorers:
                _scorers.clear()
                _scorers[mark] = Scorer(model)
            scorer = _scorers[mark]
        for batch in batches(rows, most=4 << 20):
            texts = batch.column("text").to_pylist()
            p = scorer.scores(texts) if scorer else np.full(len(texts), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())], ["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double")
