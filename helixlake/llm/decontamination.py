"""Benchmark decontamination: CGK embeddings, bit-sampling LSH, exact edit verification.

Words are lower-cased and stripped of punctuation. A window has as many words as an item (a shorter text is one window).
It matches if its word edit distance to the item is at most (1 - similarity) of the item's words.

The CGK embedding walks over a window with random steps: output j repeats the current word and a random bit of (walk,
j, word) decides whether to move on. Edit distance becomes Hamming distance, on which bit sampling is an LSH. Walks are
repeated until ``recall`` is reached at the largest distance allowed; how many that takes is measured on simulated edits
of the items' lengths. The sampled places of all items of a block make an index (length, walk, table, key); a window's keys
look up its candidates there, and every candidate is verified exactly. Windows are embedded where some item of their
length can match at all: the q-gram lemma rules out the others (they share fewer word trigrams with every item than its
edits leave), which loses no match. To embed every window of every length would cost some hundred times as much.

Items are taken in blocks of ``block`` and go to the executors with the task, so what is sent is bounded; any number of
blocks covers any benchmark, each by one more pass over the documents.

Edge cases: null and empty texts or items match nothing; several items of one text all match; repeated rows repeat
their results; rows without a doc_id are searched like others (null stays null in the result; :func:`clean` goes by the
text); an empty table on either side gives no rows; extra columns of any name are ignored; long texts are searched whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .alignment import bag_bounds, edit_distance
from .common import WordHashes, batches, binary_text, grams, mix

PAD = np.uint64(0x5BD1E995C0FFEE11)
TABLES, SAMPLED = 8, 2
WINDOW = "item_id long, start int, n_words int, distance int"


def form(word: bytes) -> bytes:
    text = word.decode("utf-8", "replace").lower()
    lo, hi = 0, len(text)
    while lo < hi and not text[lo].isalnum():
        lo += 1
    while lo < hi and not text[hi - 1].isalnum():
        hi -= 1
    return (text[lo:hi] or text).encode()


_words = WordHashes(form)


def cgk(windows: np.ndarray, walk: int) -> np.ndarray:
    """Embedding of each row (words, PAD at the end) to three times its width."""
    n, width = windows.shape
    out, at, rows = np.empty((n, 3 * width), np.uint64), np.zeros(n, np.int64), np.arange(n)
    padded = np.column_stack([windows, np.full(n, PAD)])
    for j in range(3 * width):
        word = padded[rows, np.minimum(at, width)]
        out[:, j] = word
        at += (mix(word + np.uint64((walk * 4099 + j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(63)).astype(np.int64)
    return out


def keys(embedded: np.ndarray, lengths: np.ndarray, walk: int) -> np.ndarray:
    """TABLES hashes of SAMPLED places each; the places of a row lie within three times its item's length."""
    draw = np.random.default_rng(977 + walk).random((TABLES, SAMPLED))
    places = (draw[None] * (3 * lengths)[:, None, None]).astype(np.int64).reshape(len(lengths), -1)
    got = np.take_along_axis(embedded, places, 1).reshape(len(lengths), TABLES, SAMPLED)
    out = np.zeros((len(lengths), TABLES), np.uint64)
    for c in range(SAMPLED):
        out = mix(out * np.uint64(3) + got[:, :, c])
    return out


def walks_for(lengths: list[int], similarity: float, recall: float, trials: int = 128) -> int:
    """Walks needed so that windows at the largest distance collide with probability ``recall``."""
    worst = 1.0
    rng = np.random.default_rng(5)
    for n in {lengths[0], lengths[len(lengths) // 2], lengths[-1]}:
        t = int(n * (1 - similarity) + 1e-9)
        a = rng.integers(1, 1 << 62, (trials, n)).astype(np.uint64)
        b = np.full_like(a, PAD)
        for r in range(trials):
            own = a[r].tolist()
            for kind in rng.integers(0, 3, t):
                i = int(rng.integers(0, len(own)))
                if kind == 0:
                    own[i] = int(rng.integers(1, 1 << 62))
                elif kind == 1:
                    own.insert(i, int(rng.integers(1, 1 << 62)))
                elif len(own) > 1:
                    own.pop(i)
            b[r, : min(n, len(own))] = own[:n]
        same = np.full(trials, n)
        hits = [(keys(cgk(a, w), same, w) == keys(cgk(b, w), same, w)).any(1).mean() for w in range(6)]
        worst = min(worst, float(np.mean(hits)))
    if worst < 0.02:
        raise ValueError(f"at a similarity of {similarity} a walk finds {worst:.1%} of the matches: too few for this method")
    return max(1, math.ceil(math.log(1 - recall) / math.log(max(1e-9, 1 - worst)))) if worst < 1 else 1


class Items:
    """One block of items and its lookup tables."""

    def __init__(self, rows: list[tuple[int, bytes]], similarity: float, recall: float):
        hashes, lens = _words.of([t for _, t in rows])
        kept = [(i, w) for (i, _), w in zip(rows, np.split(hashes, np.cumsum(lens)[:-1])) if len(w)]
        self.ids, self.words = [i for i, _ in kept], [w for _, w in kept]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.limits = (self.lengths * (1 - similarity) + 1e-9).astype(np.int64)
        if not kept:
            return
        need = self.lengths - 2 - 3 * self.limits
        self.q = np.where((need >= 1) & (self.lengths >= 3), 3, 1)
        self.need = np.where(self.q == 3, need, self.lengths - self.limits)
        self.grams = {}
        for q in (1, 3):
            own = [(g, i) for i in np.flatnonzero(self.q == q) for g in np.unique(grams(self.words[i], q)).tolist()]
            own.sort()
            g = np.array([x for x, _ in own], np.uint64)
            uniq, first, count = np.unique(g, return_index=True, return_counts=True)
            self.grams[q] = (uniq, first, count, np.array([i for _, i in own], np.int64))
        width = int(self.lengths.max())
        table = np.full((len(kept), width), PAD)
        for i, w in enumerate(self.words):
            table[i, : len(w)] = w
        self.walks = walks_for(sorted(self.lengths.tolist()), similarity, recall)
        self.width, self.table = width, table
        self.index = []
        for w in range(self.walks):
            own = self.labelled(keys(cgk(table, w), self.lengths, w), self.lengths).ravel()
            order = np.argsort(own, kind="stable")
            self.index.append((own[order], order // TABLES))

    @staticmethod
    def labelled(k: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Keys made different by window length and table."""
        return mix(k + lengths.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(k.shape[1], dtype=np.uint64))

    def met(self, walk: int, k: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(window, item) of all items in a bucket of each window."""
        own, items = self.index[walk]
        k = self.labelled(k, lengths).ravel()
        lo, hi = np.searchsorted(own, k), np.searchsorted(own, k, side="right")
        n = hi - lo
        at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(np.arange(len(k)) // TABLES, n) * len(self.ids) + items[at]

    def bag_bounds(self, windows: np.ndarray, row: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Edits that the words alone prove, of each pair of a window and an item."""
        step = max(1, (1 << 20) // self.width)
        parts = [bag_bounds(windows[row[lo : lo + step]], self.table[item[lo : lo + step]], PAD) for lo in range(0, len(row), step)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def starts(self, h: np.ndarray, doc: np.ndarray, start: np.ndarray, lens: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(document, item, first, last) ranges of window starts that the q-gram lemma leaves."""
        out = []
        for q, (uniq, first, count, items) in self.grams.items():
            if not len(uniq) or len(h) < q:
                continue
            g = grams(h, q)
            at = np.minimum(np.searchsorted(uniq, g), len(uniq) - 1)
            hit = np.flatnonzero((uniq[at] == g) & (doc[: len(g)] == doc[q - 1 :]))
            if not len(hit):
                continue
            n = count[at[hit]]
            place = np.repeat(hit, n)
            item = items[np.repeat(first[at[hit]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            pair = doc[place] * len(self.ids) + item
            order = np.argsort(pair, kind="stable")
            pair, place = pair[order], place[order]
            cuts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1], True])
            sizes = np.diff(cuts)
            for c in np.flatnonzero(sizes >= self.need[pair[cuts[:-1]] % len(self.ids)]):
                d, i = divmod(int(pair[cuts[c]]), len(self.ids))
                x, k, length = place[cuts[c] : cuts[c + 1]] - start[d], int(self.need[i]), int(self.lengths[i])
                lo, hi = x[k - 1 :] - (length - q), x[: len(x) - k + 1]
                top = max(0, int(lens[d]) - length)
                for a, b in zip(lo[lo <= hi].tolist(), hi[lo <= hi].tolist()):
                    a, b = max(0, a), min(b, top)
                    if out and out[-1][:2] == (d, i) and a <= out[-1][3] + 1:
                        out[-1] = (d, i, out[-1][2], max(out[-1][3], b))
                    elif a <= b:
                        out.append((d, i, a, b))
                    elif a > top:
                        out.append((d, i, top, top))
        return out

    def matches(self, texts: list[bytes | None]) -> list[tuple[int, int, int, int, int]]:
        """(text, item number, start, words, distance): the best window of each pair that matches."""
        if not self.ids:
            return []
        h, lens = _words.of(texts)
        start = np.cumsum(lens) - lens
        ranges = self.starts(h, np.repeat(np.arange(len(lens)), lens), start, lens)
        # A window of each length some item of which may match there; which items do is found by the index.
        at = sorted({(d, int(self.lengths[i]), s) for d, i, a, b in ranges for s in range(a, b + 1)})
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for lo in range(0, len(at), 20_000):
            d, length, s = np.array(at[lo : lo + 20_000]).T
            n = np.minimum(length, lens[d] - s)
            cols = np.arange(self.width)
            place = np.minimum((start[d] + s)[:, None] + cols, len(h) - 1)
            windows = np.where(cols < n[:, None], h[place], PAD)
            pairs = [self.met(w, keys(cgk(windows[:, : int(length.max())], w), length, w), length) for w in range(self.walks)]
            row, item = np.divmod(np.unique(np.concatenate(pairs)), len(self.ids))
            near = self.bag_bounds(windows, row, item) <= self.limits[item]
            for r, i in zip(row[near].tolist(), item[near].tolist()):
                x = edit_distance(windows[r, : n[r]], self.words[i], int(self.limits[i]))
                if x is not None:
                    key, found = (int(d[r]), i), (x, int(s[r]), int(n[r]))
                    best[key] = min(best.get(key, found), found)
        return [(d, i, s, n, x) for (d, i), (x, s, n) in sorted(best.items())]


def _found(texts: DataFrame, benchmark: DataFrame, similarity: float, recall: float, block: int) -> DataFrame:
    """Keys (long) of texts (keys, then text) with the items that match and their best window."""
    names = texts.columns[:-1]

    def search(items: Items):
        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches(rows, size=10_000, most=8 << 20):
                found = items.matches(batch.column("text").to_pylist())
                at = pa.array([f[0] for f in found], pa.int64())
                columns = [batch.column(c).take(at) for c in names] + [pa.array([items.ids[f[1]] for f in found], pa.int64())]
                columns += [pa.array([f[c] for f in found], pa.int32()) for c in (2, 3, 4)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "item_id", "start", "n_words", "distance"])

        return run

    rows = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    blocks = max(1, math.ceil(rows.count() / block))
    schema, parts = ", ".join(f"{c} long" for c in names) + ", " + WINDOW, []
    for b in range(blocks):  # a block has about ``block`` items, and each is one pass over the documents
        own = [(r.item_id, bytes(r.text)) for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()]
        parts.append(texts.mapInArrow(search(Items(own, similarity, recall)), schema))
    return reduce(DataFrame.union, parts)


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.99, block: int = 5000) -> DataFrame:
    """doc_id, item_id and the best matching window (start, n_words, distance) of every pair that matches."""
    return _found(binary_text(docs, F.col("doc_id").cast("long").alias("doc_id")), benchmark, similarity, recall, block)


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.99, block: int = 5000) -> DataFrame:
    """The rows of ``docs`` whose text matches no item, known by two hashes of the text."""
    key = [F.xxhash64(F.lit(k), "text").alias(f"t{k}") for k in (1, 2)]
    leaks = _found(docs.select(*key, F.col("text").cast("binary").alias("text")), benchmark, similarity, recall, block)
    rows = docs.select(*key, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return rows.join(leaks.select("t1", "t2").distinct(), ["t1", "t2"], "left_anti").select("row.*")
