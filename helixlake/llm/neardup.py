"""Near-duplicates by Order MinHash.

A text's k-mers are runs of five words, labelled with their occurrence number. For each of ``sketches`` hash functions
the ``length`` least k-mers are taken and kept in text order; the sketch is a hash of that sequence, so two texts
agree in one with a probability that follows their edit similarity, not just their overlap (Marcais et al. 2019).

Texts of the same words are one node from the start. Nodes that share a sketch form a bucket; each member is first
compared with two leaders of it - the member that meets the most others over all buckets, and the least by a hash.
Candidates are verified by banded alignment of their words: linked if the edit distance is at most (1 - similarity) of
the longer one. In buckets whose members the links leave in several components, new leaders are compared with members
of other components while that joins much; at the end every pair of a bucket that still lies in different components
is verified, unless its lengths or its words' bits rule a link out. So no link between texts that share a sketch is missing from the
classes, which are the components of the links; unlike texts in one bucket cost the square of their number.

Edge cases: texts without words (empty, white space) are equal to each other; a row with a null text is equal to nothing
and its class is its doc_id; texts of fewer than five words are one k-mer; rows that share a doc_id, or have none, are
rows like any other, told apart by two hashes of the text; a class is named by its least doc_id (null if it has none);
extra columns of any name are ignored; an empty table gives no rows. Texts of any length are sketched and aligned whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .alignment import within
from .common import batches, drop, grams, mix, save, word_hashes
from .components import components

#: Members of a bucket that meet as one block; pairs a member up to which all are compared at once.
PART, FEW = 256, 4
#: 64-bit columns of a text's word bits, and 64-bit items of those that tell apart what these let pass.
BITS, FINE = 8, 128
K = 5
PLACE = ["t1", "t2", "id", "no_id"]


def multipliers(sketches: int) -> np.ndarray:
    return mix(np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def labelled(items: np.ndarray) -> np.ndarray:
    """Hashes of ``items`` with their occurrence numbers."""
    order = np.argsort(items, kind="stable")
    s = items[order]
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    count = np.empty(len(items), np.uint64)
    count[order] = np.arange(len(items)) - np.repeat(first, np.diff(np.r_[first, len(s)]))
    return mix(items + count * np.uint64(0xD6E8FEB86659FD93))


def sketch(h: np.ndarray, by: np.ndarray, length: int = 2, block: int = 4096) -> np.ndarray:
    """One hash per multiplier: of the ``length`` least occurrence-labelled k-mers, in text order."""
    km = grams(h, K) if len(h) >= K else mix(h.sum(keepdims=True) * np.uint64(7) + np.uint64(len(h)))
    if len(np.unique(km)) < len(km):
        km = labelled(km)
    length, rows = min(length, len(km)), np.arange(len(by))
    best, at = np.empty((len(by), 0), np.uint64), np.empty((len(by), 0), np.int64)
    for lo in range(0, len(km), block):
        v = by[:, None] * km[None, lo : lo + block]
        for _ in range(min(length, v.shape[1])):
            i = v.argmin(1)
            best, at = np.column_stack([best, v[rows, i]]), np.column_stack([at, i + lo])
            v[rows, i] = ~np.uint64(0)
        if best.shape[1] > length:
            keep = np.sort(np.argsort(best, axis=1, kind="stable")[:, :length], axis=1)
            best, at = np.take_along_axis(best, keep, 1), np.take_along_axis(at, keep, 1)
    at.sort(axis=1)
    out = by.copy()
    for c in range(at.shape[1]):
        out = mix(out + km[at[:, c]])
    return out


def word_bits(h: np.ndarray, size: int = BITS) -> np.ndarray:
    """A bit for each word, of 64 * size. A bit that only one of two texts has stands for a word the other one lacks."""
    on = np.zeros(64 * size, np.uint8)
    on[(mix(h) % np.uint64(64 * size)).astype(np.int64)] = 1
    return np.packbits(on).view(np.int64)


def keyed(docs: DataFrame, *more) -> DataFrame:
    """doc_id, two hashes of the text, the text as bytes, and ``more``, of the rows that have a text."""
    key = lambda salt: F.xxhash64(F.lit(salt), "text")
    return docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), key(1).alias("t1"), key(2).alias("t2"), F.col("text").cast("binary").alias("text"), *more)


def sketches_of(docs: DataFrame, sketches: int, length: int) -> DataFrame:
    """Keys of each row, 128-bit hash of its words, their number, their bits, and the sketches."""
    by = multipliers(sketches)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            out: dict[str, list] = {"h1": [], "h2": [], "n_words": [], "bits": [], "sketch": []}
            hashes, lens = word_hashes(batch.column("text").to_pylist())
            for h in np.split(hashes, np.cumsum(lens)[:-1]):
                whole = xxhash.xxh3_128_digest(h.tobytes())
                out["h1"].append(int.from_bytes(whole[:8], "little", signed=True))
                out["h2"].append(int.from_bytes(whole[8:], "little", signed=True))
                out["n_words"].append(len(h))
                out["bits"].append(word_bits(h))
                out["sketch"].append(sketch(h, by, length).view(np.int64) if len(h) else np.empty(0, np.int64))
            kinds = {"h1": pa.int64(), "h2": pa.int64(), "n_words": pa.int32(), "bits": pa.list_(pa.int64()), "sketch": pa.list_(pa.int64())}
            own = ["doc_id", "t1", "t2"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, own), *(pa.array(out[k], t) for k, t in kinds.items())], [*own, *kinds])

    return keyed(docs).mapInArrow(run, "doc_id long, t1 long, t2 long, h1 long, h2 long, n_words int, bits array<long>, sketch array<long>")


def _leaders(met: DataFrame) -> DataFrame:
    """Each member of every bucket (key) with the bucket's two leaders."""
    central = met.groupBy("node").agg(F.sum("c").alias("meets"))
    ranked = met.join(central, "node").select("key", "node", F.struct("meets", (-F.col("node")).alias("minus")).alias("rank"))
    heads = ranked.groupBy("key").agg((-F.max("rank")["minus"]).alias("most"), F.min(F.struct(F.xxhash64("node"), F.col("node")))["node"].alias("least"))
    pairs = met.select("key", "node").join(heads, "key").select("node", F.explode(F.array("most", "least")).alias("leader"))
    return pairs.where("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def _divided(met: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with the root of their component, of the buckets that hold more than one component."""
    own = save(met.join(roots, "node", "left").select("key", "node", "n_words", F.coalesce("root", "node").alias("root")), "rooted")
    mixed = own.groupBy("key").agg(F.count("*").alias("c"), F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key", "c")
    out = save(own.join(mixed, "key"), "divided")
    drop(own)
    return out


def _open_pairs(members: DataFrame) -> tuple[int, float]:
    """Rows of ``members``, and pairs in a bucket that lie in different components (once a bucket)."""
    per = members.groupBy("key", "root").agg(F.count("*").cast("double").alias("m")).groupBy("key").agg(F.sum("m").alias("s"), F.sum(F.col("m") * F.col("m")).alias("q"))
    n, pairs = per.agg(F.sum("s"), F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()
    return int(n or 0), pairs or 0.0


def _may_link(x: str, y: str, similarity: float) -> Column:
    """Different components, and lengths that do not rule a link out."""
    m, n = F.col(f"{x}.n_words"), F.col(f"{y}.n_words")
    return (F.col(f"{x}.root") != F.col(f"{y}.root")) & (F.abs(m - n) <= F.floor(F.greatest(m, n) * F.lit(1 - similarity) + F.lit(1e-9)))


def _across(members: DataFrame, turn: int, similarity: float) -> DataFrame:
    """Members of a divided bucket with two leaders of this turn, where these lie in another component."""
    rank = F.struct(F.xxhash64("node", "key", F.lit(turn)).alias("h"), "node", "root", "n_words")
    heads = members.groupBy("key").agg(F.min(rank).alias("one"), F.max(rank).alias("two"))
    met = members.join(heads, "key").select(F.struct("node", "root", "n_words").alias("x"), F.explode(F.array("one", "two")).alias("y"))
    return met.where(_may_link("x", "y", similarity)).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _lacking(x: str, y: str) -> Column:
    """Bits of words of x that y has not: an alignment has as many edits at least."""
    return reduce(lambda a, b: a + b, [F.bit_count(F.col(f"{x}.b{i}").bitwiseAND(F.bitwise_not(f"{y}.b{i}"))) for i in range(BITS)])


def _fine_lacking(x: str, y: str) -> Column:
    """The same of the fine bits, where a repeated word has a bit for each occurrence."""
    return F.aggregate(F.zip_with(f"{x}.fine", f"{y}.fine", lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b)))), F.lit(0), lambda a, b: a + b)


def _fine_bits(members: DataFrame, texts: DataFrame) -> DataFrame:
    """node and fine bits of the ``members``."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            hashes, lens = word_hashes(batch.column("text").to_pylist())
            fine = [word_bits(labelled(h) if len(h) else h, FINE) for h in np.split(hashes, np.cumsum(lens)[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(fine, pa.list_(pa.int64()))], ["node", "fine"])

    return save(members.select("node").distinct().join(texts, "node").mapInArrow(run, "node long, fine array<long>"), "fine-bits")


def _all_across(members: DataFrame, reps: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """All pairs in a divided bucket that lie in different components and whose word bits, coarse then fine, rule no
    link out; a pair that several buckets hold comes from the one of least key. A bucket is dealt into parts of about
    ``PART`` members, and each two parts meet on their own, so that a large bucket is not one task."""
    parts = F.ceil(F.col("c") / PART).cast("int")
    bits = [f"b{i}" for i in range(BITS)]
    coarse = reps.select("node", *(F.col("bits")[i].alias(b) for i, b in enumerate(bits)))
    fine = _fine_bits(members, texts)
    # A node has a key a sketch at most.
    keys = members.groupBy("node").agg(F.collect_set("key").alias("keys"))
    own = members.join(keys, "node").join(coarse, "node").join(fine, "node").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node", "key"), F.col("parts")).cast("int"))
    member = F.struct("node", "root", "n_words", "keys", "fine", *bits)
    one = own.select("key", F.col("part").alias("lo"), F.explode(F.expr("sequence(part, parts - 1)")).alias("hi"), member.alias("x"))
    two = own.select("key", F.explode(F.expr("sequence(0, part)")).alias("lo"), F.col("part").alias("hi"), member.alias("y"))
    once = (F.col("lo") < F.col("hi")) | (F.col("x.node") < F.col("y.node"))
    limit = F.floor(F.greatest("x.n_words", "y.n_words") * F.lit(1 - similarity) + F.lit(1e-9))
    near = (_lacking("x", "y") <= limit) & (_lacking("y", "x") <= limit)
    here = F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("key")
    nearer = (_fine_lacking("x", "y") <= limit) & (_fine_lacking("y", "x") <= limit)
    met = one.join(two, ["key", "lo", "hi"]).where(once & _may_link("x", "y", similarity) & near & here & nearer)
    out = save(met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")), "pairs-across")
    drop(fine)
    return out


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """``pairs`` with the edits of an alignment of their words, null if every one is beyond the limit."""

    def align(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, size=500):
            found = []
            one, two = (np.split(h, np.cumsum(n)[:-1]) for h, n in (word_hashes(batch.column(c).to_pylist()) for c in ("ta", "tb")))
            for x, y in zip(one, two):
                longer = max(len(x), len(y))
                found.append(within(x, y, int(longer * (1 - similarity) + 1e-9)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.int32())], ["a", "b", "distance"])

    one, two = texts.toDF("a", "ta"), texts.toDF("b", "tb")
    return pairs.join(one, "a").join(two, "b").mapInArrow(align, "a long, b long, distance int")


def _flat(df: DataFrame, *more) -> DataFrame:
    """The place of each row without nulls, and ``more``: a join by it deals rows out as a group by it needs them."""
    return df.select("t1", "t2", F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.col("doc_id").isNull().alias("no_id"), *more)


def _texts(docs: DataFrame, at: DataFrame) -> DataFrame:
    """Text of each node of ``at`` (node and the place of its first row), so that one row of a group of copies meets it.
    Rows that are equal in doc_id and text come together by the keys of the join, so texts are dealt out once."""
    met = _flat(keyed(docs), "text").join(_flat(at, "node"), PLACE)
    return met.groupBy(*PLACE).agg(F.min("node").alias("node"), F.min("text").alias("text")).select("node", "text")


def near_duplicates(docs: DataFrame, similarity: float = 0.8, sketches: int = 60, length: int = 2) -> tuple[DataFrame, DataFrame]:
    """(members, links): doc_id, the keys t1 and t2 of the text, class_id and ``kept`` (one row of its class has it) of
    every row, and the verified pairs of numbers of texts."""
    all_rows = save(sketches_of(docs, sketches, length), "sketches")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t1", "t2")
    first = F.min(F.struct(place.alias("at"), "n_words", "bits", "sketch")).alias("x")
    reps = all_rows.groupBy("h1", "h2").agg(first).select("h1", "h2", F.monotonically_increasing_id().alias("node"), "x.*")
    reps = save(reps, "reps-sketched")
    rows = save(all_rows.select("doc_id", "t1", "t2", "h1", "h2").join(reps.select("h1", "h2", "node"), ["h1", "h2"]).drop("h1", "h2"), "rows")
    drop(all_rows)
    entries = reps.select("node", "n_words", F.explode("sketch").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    met = save(entries.join(shared, "key"), "bucket-members")
    sketched, reps = reps, save(reps.select("node", "at", "n_words", "bits"), "reps")
    drop(sketched)
    pairs = save(_leaders(met), "pairs")
    involved = met.select("node").distinct()
    at = reps.join(involved, "node", "left_semi").select("node", "at.*")
    texts = save(_texts(docs, at), "texts")
    tested = save(_verified(pairs, texts, similarity), "aligned")
    drop(pairs)
    # What the leaders did not join is compared further: with new leaders while that joins much, then every pair.
    turn, before, whole = 0, None, False
    while True:
        links = tested.where("distance is not null")
        roots = components(links.select("a", "b"))
        if whole:
            break
        divided = _divided(met, roots)
        n, still = _open_pairs(divided)
        if not n:
            break
        whole = still <= FEW * n or (before is not None and still > 0.7 * before)
        more = _all_across(divided, reps, texts, similarity) if whole else _across(divided, turn, similarity)
        fresh = save(more.join(tested.select("a", "b"), ["a", "b"], "left_anti"), "pairs-more")
        tested = tested.union(save(_verified(fresh, texts, similarity), "aligned-more"))
        drop(divided, more, fresh)
        turn, before = turn + 1, still
    # Of a class, the least doc_id names it, and the first row with it stays.
    rooted = reps.select("node", "at").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = rooted.groupBy("root").agg(F.min("at").alias("head"))
    classes = save(rooted.select("node", "root").join(heads, "root").select("node", "head"), "classes")
    members = rows.join(classes, "node")
    kept = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("t1") == F.col("head.t1")) & (F.col("t2") == F.col("head.t2"))
    members = save(members.select("doc_id", "t1", "t2", F.col("head.doc_id").alias("class_id"), kept.alias("kept")), "members")
    drop(met, texts, reps, rows, roots, classes)
    return members, links


def classes(docs: DataFrame, **settings) -> DataFrame:
    """doc_id and class_id of every row; without a text, a row is its own class."""
    members, _ = near_duplicates(docs, **settings)
    own = F.col("doc_id").cast("long")
    alone = docs.where("text is null").select(own.alias("doc_id"), own.alias("class_id"))
    return members.select("doc_id", "class_id").union(alone)


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with the first row of each class, by doc_id (null last) and a hash of the text; of rows that are equal
    in doc_id and text, one. Rows without a text stay."""
    members, _ = near_duplicates(docs, **settings)
    chosen = _flat(members.where("kept")).distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    found = _flat(keyed(docs, row), "row").join(chosen, PLACE, "left_semi").groupBy(*PLACE).agg(F.any_value("row").alias("row"))
    return found.select("row.*").union(docs.where("text is null"))
