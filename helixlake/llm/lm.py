"""Stupid-backoff scores, computed relationally.

S(w | context) = c(context w) / c(context) if that n-gram was seen, else 0.4 times the score under the context without its
first word; below the bigram it is c(w) / N, where an unseen word counts as seen once. A document's score is the sum of
log10 S over its words (lower-cased; an n-gram never leaves its document).

:func:`score` takes the counts from the documents that it scores. Every n-gram is then seen, and the quotients telescope:
of a document of n words there remain the counts of its n-grams of the full order, less those of the contexts between
them (places 2 to n - order + 1), less log10 N. Documents lie in blocks of about ``block_words`` words. Each block counts
its own n-grams first and deals the different ones, sorted, out by ranges of their hashes; a range (about
``partition_rows`` n-grams, of all blocks) adds the counts up and sends each block those of the n-grams it asked for, which
meet the block again by its number. So what is sent is one number for each different n-gram of a block and one back, in
proportion to the words, and a frequent n-gram is at most a number a block. Numbers of a block and a range travel as one
row; these rows (blocks times ranges) alone grow with the square of the words, to one for some hundreds of n-grams at
5 * 10^9 words, and are never more than the n-grams. The ranges are done in ``parts``, so that only one part's n-grams lie
on disk at a time.

:func:`score_against` scores documents by another corpus. There n-grams can be unseen. Each n-gram of the count table gets
the weight log S of its own order less log S of the next lower one, by joins of the count tables; documents' n-grams of all
orders are joined to the weights, an unseen one weighs log10 0.4, and the sum per document is its score.

N-grams and words are told apart by 64 bits of hash: of 10^10 different n-grams one in 10^9 meets another.

Edge cases: a null or empty text has no words, score 0 and a null mean; repeated rows count as often as they occur; a null
doc_id stays null; an empty table gives no rows; extra columns are ignored; texts of any length are scored whole (a
document is never divided, so it must fit a worker's memory: 8 bytes a word).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, binary_text, drop, save, word_hashes

BACKOFF = 0.4
#: Share of all rows from which an n-gram counts as frequent.
SHARE = 1 / 20_000
BLOCK = "first long, n_words long, shortest int, doc_ids array<long>, lens array<int>, words binary"
RESULT = "doc_id long, n_words long, log_score double, mean_log_score double"
#: Kinds of rows: how often the n-gram occurs (0 or 1), and with what sign its logarithm counts for the document.
KINDS = [(0, -1), (0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]
COUNT = len(KINDS)  # the row is a number of occurrences, of no document


def kind(occurs: int, sign: int) -> int:
    return KINDS.index((occurs, sign))


def squeeze(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x))


def unsqueeze(x: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype)


def _packed(hashes: np.ndarray) -> bytes:
    """Word hashes as a table of the different ones and their numbers, a plane a byte: the highest compress."""
    codes, known = pd.factorize(hashes)
    order = np.argsort(-np.bincount(codes, minlength=len(known)), kind="stable")  # frequent words get small numbers
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order))
    planes = np.ascontiguousarray(rank[codes].astype("<u4").view(np.uint8).reshape(-1, 4).T)
    table = squeeze(known[order])
    return len(table).to_bytes(8, "little") + table + squeeze(planes)


def _hashes(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    known, planes = unsqueeze(raw[8 : 8 + n], np.uint64), unsqueeze(raw[8 + n :], np.uint8)
    return known[np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()]


def _blocks(docs: DataFrame, most: int) -> DataFrame:
    """Words of some documents each. A document's number is ``first`` plus its place in the block."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, ids, lens, words = TaskContext.get().partitionId() << 40, 0, [], [], []

        def block():
            few = min((n for n in lens if n), default=0)
            values = [[first], [held], [few], [ids], [lens], [_packed(np.concatenate(words))]]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["first", "n_words", "shortest", "doc_ids", "lens", "words"])

        for batch in batches(rows):
            texts = [text.decode("utf-8", "replace").lower().encode() if text else None for text in batch.column("text").to_pylist()]
            hashes, n = word_hashes(texts)
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), np.split(hashes, np.cumsum(n)[:-1])):
                ids.append(doc_id)
                lens.append(len(own))
                words.append(own)
                held += len(own)
                if held >= most:
                    yield block()
                    first, held, ids, lens, words = first + len(ids), 0, [], [], []
        if ids:
            yield block()

    return binary_text(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, BLOCK)


def ngram_keys(h: np.ndarray, order: int) -> np.ndarray:
    """Hash of each run of ``order`` words: word hashes are random, so their sum by odd factors is."""
    n = max(0, len(h) - order + 1)
    out = np.full(n, order, np.uint64)
    for k in range(order):
        out += h[k : k + n] * np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) & (1 << 64) - 1)
    return out


class Block:
    """N-grams of one block."""

    def __init__(self, row: dict):
        self.first, self.h, self.lens = row["first"], _hashes(row["words"]), np.array(row["lens"], np.int64)
        self.doc = np.repeat(np.arange(len(self.lens)), self.lens)
        self.start = np.cumsum(self.lens) - self.lens

    def ngrams(self, order: int, lo: int = 0, hi: int = 1 << 64) -> tuple[np.ndarray, np.ndarray]:
        """Keys from ``lo`` to below ``hi`` of the n-grams inside documents, and the place of their first word."""
        g = ngram_keys(self.h, order)
        at = np.arange(len(g)) if hi - lo == 1 << 64 else np.flatnonzero((g >= np.uint64(lo)) & (g <= np.uint64(hi - 1)))
        at = at[self.doc[at] == self.doc[at + order - 1]]
        return g[at], at

    def rows(self, order: int, short: bool, lo: int = 0, hi: int = 1 << 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(n-gram, 8 * document + kind) of the rows whose signed logarithms make up the scores; ``short``: some
        document has fewer words than ``order`` - 1, so that lower orders are counted too."""
        for m in range(1 if short else max(1, order - 1), order + 1):
            g, at = self.ngrams(m, lo, hi)
            doc = self.doc[at]
            whole = self.lens[doc] == m  # of a document that is shorter than the order, the whole counts
            if m == order:
                yield g, 8 * (self.first + doc) + kind(1, 1)
            elif m == order - 1:
                inner = (at > self.start[doc]) & (at - self.start[doc] <= self.lens[doc] - order)
                yield g, 8 * (self.first + doc) + kind(1, 0) + np.where(whole, 1, np.where(inner, -1, 0))
            else:
                known, count = np.unique(g, return_counts=True)
                yield known, 8 * count + COUNT
                yield g[whole], 8 * (self.first + doc[whole]) + kind(0, 1)


def _each_block(blocks: DataFrame, schema: str, run) -> DataFrame:
    """Rows of ``schema`` from ``run`` (a block to tuples of arrays), in batches of bounded size."""
    names = [c.split()[0] for c in schema.split(", ")]

    def each(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                for columns in run(Block(row)):
                    for lo in range(0, len(columns[0]), 1 << 16):
                        yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + (1 << 16)].astype(np.int64, copy=False).view(np.int64)) for c in columns], names)

    return blocks.select("first", "lens", "words").mapInArrow(each, schema)


def _orders(order: int, short: bool) -> range:
    return range(1 if short else max(1, order - 1), order + 1)


def _asked(blocks: DataFrame, order: int, short: bool, part: int, parts: int, ranges: int) -> DataFrame:
    """(first, range, grams, counts): the different n-grams of each block in each range of one part, ascending."""
    edges = [(part * ranges + i << 64) // (parts * ranges) for i in range(ranges + 1)]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                block = Block(row)
                known, count = np.unique(np.concatenate([block.ngrams(m, edges[0], edges[-1])[0] for m in _orders(order, short)]), return_counts=True)
                cuts = [0, *np.searchsorted(known, np.array(edges[1:-1], np.uint64)).tolist(), len(known)]
                for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    if lo < hi:
                        values = [[block.first], [part * ranges + i], [known[lo:hi].tobytes()], [squeeze(count[lo:hi])]]
                        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, [pa.int64(), pa.int64(), pa.binary(), pa.binary()])], ["first", "range", "grams", "counts"])

    return blocks.select("first", "lens", "words").mapInArrow(run, "first long, range long, grams binary, counts binary")


def _answered(dealt: DataFrame) -> DataFrame:
    """(first, range, counts): of rows of :func:`_asked` dealt out by range, the n-grams' counts over all blocks."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list] = {}
        for batch in rows:
            for row in batch.to_pylist():
                own.setdefault(row["range"], []).append((row["first"], row["grams"], row["counts"]))
        for which in list(own):
            first, grams, counts = zip(*own.pop(which))
            at, known = pd.factorize(np.concatenate([np.frombuffer(g, np.int64) for g in grams]))
            total = np.bincount(at, np.concatenate([unsqueeze(c, np.int64) for c in counts]), len(known)).astype(np.int64)[at]
            for f, c in zip(first, np.split(total, np.cumsum([len(g) // 8 for g in grams])[:-1])):
                yield pa.RecordBatch.from_arrays([pa.array([f]), pa.array([which]), pa.array([squeeze(c)], pa.binary())], ["first", "range", "counts"])

    return dealt.mapInArrow(run, "first long, range long, counts binary")


def _block_sums(block: Block, counts: np.ndarray, order: int, short: bool) -> np.ndarray:
    """The signed logarithms of each document of a block, by the counts of its different n-grams in ascending order."""
    found = [(m, *block.ngrams(m)) for m in _orders(order, short)]
    known, place = np.unique(np.concatenate([g for _, g, _ in found]), return_inverse=True)
    if len(known) != len(counts):
        raise ValueError(f"{len(counts)} counts for {len(known)} n-grams")
    logs, out = np.log10(counts)[place], np.zeros(len(block.lens))
    for m, g, at in found:
        doc, (own, logs) = block.doc[at], (logs[: len(g)], logs[len(g) :])
        whole = block.lens[doc] == m  # of a document that is shorter than the order, the whole counts
        inner = (at > block.start[doc]) & (at - block.start[doc] <= block.lens[doc] - order)
        sign = np.where(whole | (m == order), 1, np.where(inner & (m == order - 1), -1, 0))
        out += np.bincount(doc, sign * own, len(out))
    return out


def _scored(blocks: DataFrame, counts: DataFrame, partitions: int, n: int, order: int, short: bool) -> DataFrame:
    """A row a document, from each block and the counts sent to it."""

    def run(block: pa.Table, counts: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        own = [unsqueeze(c, np.int64) for _, c in sorted(zip(counts.column("range").to_pylist(), counts.column("counts").to_pylist()))]
        s = _block_sums(Block(row), np.concatenate([np.zeros(0, np.int64), *own]), order, short)
        lens = np.array(row["lens"], np.int64)
        log = np.where(lens > 0, s - np.log10(max(1, n)), 0.0)
        mean = pa.array(log / np.maximum(lens, 1), mask=lens == 0)
        return pa.Table.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(lens), pa.array(log), mean], ["doc_id", "n_words", "log_score", "mean_log_score"])

    met = lambda df: df.repartition(partitions, "first").groupBy("first")
    return met(blocks.select("first", "doc_ids", "lens", "words")).cogroup(met(counts)).applyInArrow(run, RESULT)


def _frequent(blocks: DataFrame, order: int, short: bool, step: int = 8) -> np.ndarray:
    """Not on the way of :func:`score` any more. N-grams that hold a great share of the rows, by a count of one row in ``step``: at most 1 / SHARE of them. This
    only decides by which join an n-gram meets its count."""

    def run(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        every = [np.sort(g[::step]) for g, _ in block.rows(order, short)]
        n = sum(map(len, every))
        for g in every:
            first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
            count = np.diff(np.r_[first, len(g)])
            often = count >= max(2, n * SHARE)
            yield g[first[often]].view(np.int64), count[often]
        yield np.zeros(1, np.int64), np.array([-n])  # all rows of the block, under a key of its own

    found = _each_block(blocks, "gram long, n long", run).groupBy("gram", F.expr("n < 0").alias("every")).agg(F.sum("n").alias("n"))
    found = save(found, "lm-frequent")
    every = -(found.where("every").agg(F.sum("n")).first()[0] or 0)
    rows = found.where(~F.col("every") & (F.col("n") >= every * SHARE)).select("gram").collect()  # at most 1 / SHARE
    drop(found)
    return np.sort(np.array([r.gram for r in rows], np.int64).view(np.uint64))


def _counted(dealt: DataFrame) -> DataFrame:
    """Not on the way of :func:`score` any more: it sent a row for each document and partition. (doc, s), the signed
    logarithms per document, of rows of :meth:`Block.rows` dealt out by n-gram. A partition has all rows of its n-grams, so the count table
    of these is made and joined there; documents are summed within the partition first."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [(b.column("gram").to_numpy(), b.column("x").to_numpy()) for b in rows if b.num_rows]
        if not own:
            return
        gram, x = map(np.concatenate, zip(*own))
        del own
        at, known = pd.factorize(gram)
        del gram
        code = x & 7
        count = np.bincount(at, np.where(code == COUNT, x >> 3, code >= kind(1, -1)), len(known))
        keep = np.flatnonzero((code != COUNT) & (code % 3 != 1))
        doc, docs = pd.factorize(x[keep] >> 3)
        s = np.bincount(doc, (code[keep] % 3 - 1) * np.log10(count)[at[keep]], len(docs))
        for lo in range(0, len(docs), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(docs[lo : lo + (1 << 16)]), pa.array(s[lo : lo + (1 << 16)])], ["doc", "s"])

    return dealt.mapInArrow(run, "doc long, s double").groupBy("doc").agg(F.sum("s").alias("s"))


def _result(blocks: DataFrame, sums: list[DataFrame], own: Column) -> DataFrame:
    """A row a document; ``own`` is added to the sum of one that has words."""
    each = F.posexplode(F.arrays_zip("doc_ids", "lens")).alias("k", "d")
    docs = blocks.select("first", each).select((F.col("first") + F.col("k")).alias("doc"), F.col("d.doc_ids").alias("doc_id"), F.col("d.lens").cast("long").alias("n_words"))
    total = reduce(DataFrame.union, sums).groupBy("doc").agg(F.sum("s").alias("s"))
    scored = docs.join(total, "doc", "left").withColumn("log_score", F.when(F.col("n_words") > 0, F.coalesce("s", F.lit(0.0)) + own).otherwise(0.0))
    return scored.select("doc_id", "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_log_score"))


def score(docs: DataFrame, order: int = 3, parts: int = 8, block_words: int = 2_000_000, partition_rows: int = 1_000_000) -> DataFrame:
    """doc_id, n_words, log_score and mean_log_score of every document, by the counts of all of them. ``order`` >= 2."""
    blocks = save(_blocks(docs, block_words), "lm-blocks", compression="none")
    n, few, n_blocks = blocks.agg(F.sum("n_words"), F.min(F.when(F.col("shortest") > 0, F.col("shortest"))), F.count("*")).first()
    n, short = n or 0, few is not None and few < order - 1
    ranges, counts = max(1, -(-2 * n // (parts * partition_rows))), []
    for part in range(parts):
        dealt = _asked(blocks, order, short, part, parts, ranges).repartition(ranges, "range")
        counts.append(save(_answered(dealt), "lm-counts", compression="none"))
    out = save(_scored(blocks, reduce(DataFrame.union, counts), max(1, min(n_blocks, -(-n // partition_rows))), n, order, short), "lm-scores")
    drop(blocks, *counts)
    return out


def _count_table(blocks: DataFrame, m: int) -> DataFrame:
    """(gram, ctx, suf, mid, c) of the n-grams of ``m`` words; ctx, suf and mid lack the last, the first and both."""

    def run(block: Block) -> Iterator[tuple[np.ndarray, ...]]:
        g, at = block.ngrams(m)
        known, first, count = np.unique(g, return_index=True, return_counts=True)
        place = at[first]
        lower = [ngram_keys(block.h, k)[place + shift].view(np.int64) if k else np.zeros(len(known), np.int64) for k, shift in ((m - 1, 0), (m - 1, 1), (m - 2, 1))] if m > 1 else [np.zeros(len(known), np.int64)] * 3
        yield (known.view(np.int64), *lower, count)

    rows = _each_block(blocks, "gram long, ctx long, suf long, mid long, c long", run)
    return rows.groupBy("gram").agg(F.min("ctx").alias("ctx"), F.min("suf").alias("suf"), F.min("mid").alias("mid"), F.sum("c").alias("c"))


def _weights(tables: list[DataFrame], n: int) -> DataFrame:
    """(gram, w): log S of its own order less log S of the next lower one, of all n-grams of all orders."""
    count = lambda t, key, name: t.select(F.col("gram").alias(key), F.col("c").alias(name))
    out = [tables[0].select("gram", F.log10(F.col("c") / n).alias("w"))]
    for m in range(1, len(tables)):
        t = tables[m].join(count(tables[m - 1], "ctx", "cc"), "ctx").join(count(tables[m - 1], "suf", "cs"), "suf")
        t = t.withColumn("cm", F.lit(n)) if m == 1 else t.join(count(tables[m - 2], "mid", "cm"), "mid")
        out.append(t.select("gram", (F.log10("c") - F.log10("cc") - F.log10("cs") + F.log10("cm")).alias("w")))
    return reduce(DataFrame.union, out)


def score_against(docs: DataFrame, corpus: DataFrame, order: int = 3, backoff: float = BACKOFF, block_words: int = 2_000_000) -> DataFrame:
    """As :func:`score`, by the counts of ``corpus`` (doc_id, text)."""
    blocks, known = save(_blocks(docs, block_words), "lm-blocks", compression="none"), save(_blocks(corpus, block_words), "lm-corpus", compression="none")
    n = known.agg(F.sum("n_words")).first()[0] or 0
    tables = [save(_count_table(known, m), f"lm-counts-{m}") for m in range(1, order + 1)]
    weights = _weights(tables, max(1, n))

    def run(block: Block) -> Iterator[tuple[np.ndarray, ...]]:
        for m in range(1, order + 1):
            g, at = block.ngrams(m)
            yield g.view(np.int64), block.first + block.doc[at], np.full(len(g), m)

    asked = _each_block(blocks, "gram long, doc long, m long", run).groupBy("gram", "doc", "m").agg(F.count("*").alias("n"))
    unseen = F.when(F.col("m") == 1, -float(np.log10(max(1, n)))).otherwise(float(np.log10(backoff)))
    sums = save(asked.join(weights, "gram", "left").groupBy("doc").agg(F.sum(F.col("n") * F.coalesce("w", unseen)).alias("s")), "lm-sums")
    out = save(_result(blocks, [sums], F.lit(0.0)), "lm-scores")
    drop(blocks, known, sums, *tables)
    return out


def oracle_sql(digits: int = 4) -> str:
    """Scores of order 3 as DuckDB SQL, word by word."""
    return f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    p AS (SELECT r, i, w[i] AS a, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS c FROM w, unnest(range(1, len(w) + 1)) AS t(i)),
    n AS (SELECT count(*) AS n FROM p),
    c1 AS (SELECT a, count(*) AS n1 FROM p GROUP BY a),
    c2 AS (SELECT b, a, count(*) AS n2 FROM p WHERE b IS NOT NULL GROUP BY b, a),
    c3 AS (SELECT c, b, a, count(*) AS n3 FROM p WHERE c IS NOT NULL GROUP BY c, b, a),
    s AS (SELECT p.r, sum(CASE WHEN p.c IS NOT NULL THEN log10(n3 / ctx2.n2) WHEN p.b IS NOT NULL THEN log10(own2.n2 / ctx1.n1) ELSE log10(own1.n1 / n.n) END) AS s
        FROM p CROSS JOIN n JOIN c1 own1 ON own1.a = p.a LEFT JOIN c1 ctx1 ON ctx1.a = p.b LEFT JOIN c2 own2 ON own2.b = p.b AND own2.a = p.a
        LEFT JOIN c2 ctx2 ON ctx2.b = p.c AND ctx2.a = p.b LEFT JOIN c3 ON c3.c = p.c AND c3.b = p.b AND c3.a = p.a GROUP BY p.r)
SELECT doc_id, len(w)::BIGINT AS n_words, round(coalesce(s, 0), {digits})::DOUBLE AS log_score,
    round(s / len(w), {digits})::DOUBLE AS mean_log_score FROM w LEFT JOIN s USING (r)"""
