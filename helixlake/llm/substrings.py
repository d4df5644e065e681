"""Removal of long repeated substrings by compaction of the de Bruijn graph of words.

Every window of ``window`` words is an edge of the graph, from the node of its first ``window - 1`` words to that of its
last. Equal windows are one edge. The graph is compacted by Spark joins, in two steps:

1. An edge is filed under the least 8-word run that it holds (leftmost of equals). Consecutive edges of a text with the
   same run form a piece; equal edges always lie in pieces of equal runs. Runs with one piece hold no repeated edge and
   go. A run whose pieces are all alike does not branch, so its piece stays one item; only where pieces differ are they
   opened, an item an edge.
2. Items that occur twice or more are the repeated part of the graph. One whose neighbours are the same wherever it
   occurs has one way in and one way out; neighbours of that kind are merged to one path, all others end at a branch.
   So every occurrence of a path runs over the whole of it.

The coordinates of each occurrence (row, first word, number of edges) travel along. They lead back to the source words,
and a path counts as repeated only if the SHA-256 of these words says so: hashes of windows route, words decide. Should
two different windows have met in a hash (64 bits), the graph is built again with other hashes.

A run or item that holds more than one row in 10,000 is joined by broadcast (there are at most 10,000 of those), the
others by a shuffle, so no task gets all rows of a hot passage.

Edge cases: a null or empty text, and one shorter than a window, keeps all its words; repeated rows are occurrences
like any other; rows are told apart by 128 bits of hash of doc_id and text, so null or shared ids do no harm; an empty
table gives no rows; extra columns of any name are ignored (:func:`remove` returns them unchanged). Texts of any length
are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, drop, grams, mix, save, word_hashes

K = 8
SLICE = 5 << 20
SHARE = 1 / 10_000
ROW = ["r1", "r2"]


def keyed(docs: DataFrame, *more) -> DataFrame:
    """Two hashes of each row, its text as bytes, and ``more``."""
    key = lambda salt: F.xxhash64(F.lit(salt), "doc_id", "text")
    return docs.select(key(1).alias("r1"), key(2).alias("r2"), F.col("text").cast("binary").alias("text"), *more)


def _minimizers(km: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each ``width`` neighbours, the leftmost of equals."""
    val, pos, size = km, np.arange(len(km)), 1
    while size < width:
        step = min(size, width - size)
        left, right = val[:-step], val[step:]
        take = right < left
        val, pos = np.where(take, right, left), np.where(take, pos[step:], pos[:-step])
        size += step
    return pos


def _pieces(docs: DataFrame, window: int, seed: int) -> DataFrame:
    k = min(K, window)

    def find(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, most=SLICE):
            h, lens = word_hashes(batch.column("text").to_pylist())
            if len(h) < window:
                continue
            doc, start = np.repeat(np.arange(len(lens)), lens), np.cumsum(lens) - lens
            s = np.flatnonzero(doc[: len(h) - window + 1] == doc[window - 1 :])
            if not len(s):
                continue
            km, edge = grams(h, k, seed), grams(h, window, seed)
            p, d = _minimizers(km, window - k + 1)[s], doc[s]
            first = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (d[1:] != d[:-1])])
            n = np.diff(np.r_[first, len(s)])
            a, b, at = s[first], s[first + n - 1], p[first]
            content = mix(edge[a] * np.uint64(3) + mix(edge[b] + np.uint64(64) * n.astype(np.uint64) + (at - a).astype(np.uint64)))
            columns = [pa.array(km[at].view(np.int64)), pa.array(content.view(np.int64))]
            columns += [pa.array(np.asarray(batch.column(c))[d[first]]) for c in ROW]
            columns += [pa.array((a - start[d[first]]).astype(np.int32)), pa.array(n.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["run", "content", *ROW, "first", "n"])

    return docs.mapInArrow(find, "run long, content long, r1 long, r2 long, first int, n int")


def _met(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``found`` (a table with a row for each key and its number of rows, c). A key with more than
    a SHARE of the rows that are counted is broadcast: there are at most 1 / SHARE."""
    total = found.agg(F.sum("c")).first()[0] or 0
    hot = F.col("c") > total * SHARE
    often, seldom = found.where(hot).drop("c"), found.where(~hot).drop("c")
    if not found.where(hot).limit(1).count():
        return rows.join(seldom, key)
    return rows.join(F.broadcast(often), key).unionByName(rows.join(F.broadcast(often.select(key)), key, "left_anti").join(seldom, key))


def _items(listed: DataFrame, window: int, seed: int) -> DataFrame:
    """(item, r1, r2, first, n, around) of texts with their pieces (spans): a piece that does not branch as a whole,
    the others by their edges. ``around`` is a hash of the items before and after, of 0 where the text has none there."""

    def find(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, most=SLICE):
            h, lens = word_hashes(batch.column("text").to_pylist())
            start = np.cumsum(lens) - lens
            if len(h) < window:
                continue
            edge, spans = grams(h, window, seed), batch.column("spans")
            flat, size = spans.flatten(), np.diff(np.asarray(spans.offsets))
            row = np.repeat(np.arange(len(size)), size)
            first, n, content, opens = (np.asarray(flat.field(c)) for c in ("first", "n", "content", "branches"))
            times, n = np.where(opens, n, 1).astype(np.int64), n.astype(np.int64)
            shift = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            own, row, opens = np.repeat(first.astype(np.int64), times) + shift, np.repeat(row, times), np.repeat(opens, times)
            item = np.where(opens, edge[np.minimum(start[row] + own, len(edge) - 1)], np.repeat(content, times).view(np.uint64))
            n = np.where(opens, 1, np.repeat(n, times))
            order = np.lexsort((own, row))
            item, row, own, n = item[order], row[order], own[order], n[order]
            joined = (row[1:] == row[:-1]) & (own[:-1] + n[:-1] == own[1:])
            before = np.r_[np.uint64(0), np.where(joined, item[:-1], np.uint64(0))] if len(item) else item
            after = np.r_[np.where(joined, item[1:], np.uint64(0)), np.uint64(0)] if len(item) else item
            around = mix(before * np.uint64(3) + mix(after + np.uint64(seed)))
            around[(before == 0) | (after == 0)] = 0
            columns = [pa.array(item.view(np.int64)), *(pa.array(np.asarray(batch.column(c))[row]) for c in ROW)]
            columns += [pa.array(own.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(around.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["item", *ROW, "first", "n", "around"])

    return listed.mapInArrow(find, "item long, r1 long, r2 long, first int, n int, around long")


def _paths(listed: DataFrame) -> DataFrame:
    """(r1, r2, spans) with the repeated items of each row, in order, merged to paths (path, first, n): neighbours are
    one path unless either branches; the path has the name of its first item."""

    def merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            spans = batch.column("spans")
            flat, size = spans.flatten(), np.diff(np.asarray(spans.offsets))
            row = np.repeat(np.arange(len(size)), size)
            first, n, item, branches = (np.asarray(flat.field(c)) for c in ("first", "n", "item", "branches"))
            order = np.lexsort((first, row))
            row, first, n, item, branches = row[order], first[order], n[order], item[order], branches[order]
            on = (row[1:] == row[:-1]) & (first[:-1] + n[:-1] == first[1:]) & ~branches[1:] & ~branches[:-1]
            start = np.flatnonzero(np.r_[True, ~on]) if len(row) else np.zeros(0, np.int64)
            total = np.add.reduceat(n, start) if len(row) else n
            paths = pa.StructArray.from_arrays([pa.array(item[start]), pa.array(first[start]), pa.array(total.astype(np.int32))], ["path", "first", "n"])
            offsets = np.r_[0, np.cumsum(np.bincount(row[start], minlength=len(size)))].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*map(batch.column, ROW), pa.ListArray.from_arrays(pa.array(offsets), paths)], [*ROW, "spans"])

    return listed.mapInArrow(merge, "r1 long, r2 long, spans array<struct<path:long,first:int,n:int>>")


def _verified(found: DataFrame, docs: DataFrame, window: int) -> bool:
    """Whether the source words of every path occur at least twice."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, most=SLICE):
            paths, shas = [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = text.split()
                for s in spans:
                    paths.append(s["path"])
                    shas.append(hashlib.sha256(b" ".join(words[s["first"] : s["first"] + s["n"] + window - 1])).digest())
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.int64()), pa.array(shas, pa.binary())], ["path", "sha"])

    sources = keyed(docs).join(found, ROW).select("text", "spans").mapInArrow(read, "path long, sha binary")
    # Written, though mostly empty: the texts dealt out for this go before they are dealt out again.
    lone = save(sources.groupBy("path", "sha").agg(F.count("*").alias("c")).where("c = 1"), "lone-paths")
    verified = not lone.limit(1).count()
    drop(lone)
    return verified


def _built(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """(r1, r2, spans): the repeated paths of each row that has any."""
    pieces = save(_pieces(keyed(docs), window, seed), "pieces")
    runs = pieces.groupBy("run").agg(F.count("*").alias("c"), F.min("content").alias("lo"), F.max("content").alias("hi")).where("c > 1")
    runs = save(runs.select("run", "c", (F.col("lo") != F.col("hi")).alias("branches")), "runs")
    again = _met(pieces, runs, "run").select(*ROW, F.struct("first", "n", "content", "branches").alias("s")).distinct()
    # Rows that are equal in id and text share a key and must count as often as they occur: their pieces are listed once
    # and every row opens them.
    listed = save(again.groupBy(*ROW).agg(F.collect_list("s").alias("spans")), "pieces-again")
    drop(pieces, runs)
    items = save(_items(keyed(docs).join(listed, ROW).select(*ROW, "text", "spans"), window, seed), "items")
    drop(listed)
    alike = (F.min("around") == F.max("around")) & (F.min("around") != 0)
    twice = items.groupBy("item").agg(F.count("*").alias("c"), (~alike).alias("branches")).where("c > 1")
    twice = save(twice, "items-again")
    hits = _met(items, twice, "item").select(*ROW, F.struct("first", "n", "item", "branches").alias("s")).distinct()
    found = save(_paths(hits.groupBy(*ROW).agg(F.collect_list("s").alias("spans"))), "spans")
    drop(items, twice)
    return found


def repeated_spans(docs: DataFrame, window: int = 35) -> DataFrame:
    """(r1, r2, spans): the repeated runs of windows (first, n) of each row that has any."""
    for seed in count(1):
        found = _built(docs, window, seed)
        if _verified(found, docs, window):
            return found
        drop(found)


def _kept(words: list, spans, window: int) -> list:
    """The words outside of all spans, which are in order."""
    out, at = [], 0
    for s in spans:
        out += words[at : s["first"]]
        at = max(at, s["first"] + s["n"] + window - 1)
    return out + words[at:]


def digests(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""

    def digest(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, most=SLICE):
            n_words, n_removed, sha = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = text.split() if text else []
                kept = _kept(words, spans, window) if spans else words
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id")).join(repeated_spans(docs, window), ROW, "left").select("doc_id", "text", "spans")
    out = save(rows.mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string"), "digests")
    return out


def remove(docs: DataFrame, window: int = 35) -> DataFrame:
    """``docs`` without the words of repeated windows; rows without such words keep their text as it is."""

    @F.pandas_udf("string")
    def cut(texts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, spans in texts:
            out = []
            for t, s in zip(text, spans):
                out.append(b" ".join(_kept(t.encode().split(), s, window)).decode())
            yield pd.Series(out, dtype=object)

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = keyed(docs, row).drop("text").join(repeated_spans(docs, window), ROW, "left")
    same, changed = rows.where("spans is null"), rows.where("spans is not null")
    changed = changed.select(F.col("row").withField("text", cut("row.text", "spans")).alias("row"))
    return same.select("row.*").union(changed.select("row.*"))


def oracle_sql(window: int = 35) -> str:
    """:func:`digests` as DuckDB SQL."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    win AS (SELECT r, i, md5(array_to_string(w[i:i + {window - 1}], ' ')) AS g FROM d, unnest(range(1, len(w) - {window - 2})) AS t(i)),
    rep AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY g) > 1),
    gone AS (SELECT DISTINCT r, i + k AS i FROM rep, unnest(range({window})) AS u(k)),
    words AS (SELECT r, i, w[i] AS x FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
    kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS s FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""
