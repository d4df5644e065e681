"""Sharding by extendible hashing.

A document's key hash is the first 60 bits of md5(doc_id). The directory starts as one bucket; a bucket whose bytes
exceed the limit, and only such a bucket, is split on its next bit until every shard fits. Only per-prefix sums are
shuffled, and each round looks at ``step`` more bits of the oversized buckets alone. Rows that agree on all 60 bits
(repeated ids) are split further on a second hash, of the row's place in the input; a single document beyond the
limit ends as a shard of its own (or with others of one key and place hash) and is marked.

Edge cases: a null doc_id hashes as the empty string; a null text has 0 bytes; an empty table gives no shards; ties
and repeated rows all stay; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save

BITS = 60


def hashed(docs: DataFrame, *more: F.Column) -> DataFrame:
    """doc_id, n_bytes, 120 hash bits in two longs, and ``more``."""
    bits = lambda c: F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("long")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        bits(key).alias("h1"),
        bits(F.monotonically_increasing_id().cast("string")).alias("h2"),
        *more,
    )


def prefix(depth) -> F.Column:
    """The first ``depth`` of the 120 bits, as a string of 0 and 1."""
    bits = F.concat(F.lpad(F.bin("h1"), BITS, "0"), F.lpad(F.bin("h2"), BITS, "0"))
    return F.substring(bits, F.lit(1), F.lit(depth))


def directory(rows: DataFrame, limit: int, step: int = 8) -> DataFrame:
    """(prefix, depth, shard_bytes, n_docs, oversized) of every shard. ``rows`` as from :func:`hashed`."""
    shards, open_rows, base = [], rows, 0
    while True:
        cells = open_rows.groupBy(prefix(base + step).alias("cell")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("c"))
        deep = F.explode(F.sequence(F.lit(base), F.lit(base + step))).alias("depth")
        sums = cells.select("b", "c", "cell", deep).groupBy("depth", F.expr("substring(cell, 1, depth)").alias("prefix")).agg(F.sum("b").alias("shard_bytes"), F.sum("c").alias("n_docs"))
        last = base + step >= 2 * BITS
        over = (F.col("shard_bytes") > limit) & (F.col("n_docs") > 1)
        sums = save(sums.withColumn("over", over), "directory")
        parent = sums.where("over").select(F.col("depth").alias("up_depth"), F.col("prefix").alias("up"))
        fits = sums.where("not over" if not last else f"not over or depth = {base + step}")
        above = F.expr("substring(prefix, 1, depth - 1)")
        leaves = fits.where(F.col("depth") > base).join(parent, (F.col("up_depth") == F.col("depth") - 1) & (F.col("up") == above), "left_semi")
        if base == 0:
            leaves = leaves.union(fits.where("depth = 0"))
        shards.append(leaves)
        if last or not (big := sums.where((F.col("depth") == base + step) & F.col("over")).select(F.col("prefix").alias("big"))).limit(1).count():
            break
        base += step
        open_rows = open_rows.join(big, prefix(base) == F.col("big"), "left_semi")
    out = shards[0]
    for more in shards[1:]:
        out = out.union(more)
    return out.select("prefix", "depth", "shard_bytes", "n_docs", (F.col("shard_bytes") > limit).alias("oversized"))


def _placed(rows: DataFrame, limit: int, step: int, *kept: str) -> DataFrame:
    """``kept`` columns of each of ``rows`` (a table, as from :func:`hashed`), with its shard."""
    shards = save(directory(rows, limit, step), "shards")
    depths = [r.depth for r in shards.select("depth").distinct().orderBy("depth").collect()]  # at most 121
    shards = shards.withColumnRenamed("prefix", "shard").select("shard", "depth", "shard_bytes", "oversized")
    if not depths:
        return rows.select(*kept).join(shards, F.lit(False))
    # A lookup needs a document's prefix at the depths in use; it probes them all in one equality join.
    probes = rows.select(*kept, F.explode(F.array(*[prefix(d) for d in depths])).alias("shard"))
    return probes.join(shards, "shard").select(*kept, "shard", "depth", "shard_bytes", "oversized")


def assign(docs: DataFrame, limit: int, step: int = 8) -> DataFrame:
    """One row per document: doc_id, n_bytes, shard (its hash prefix), depth, shard_bytes, oversized."""
    return _placed(save(hashed(docs), "hashed"), limit, step, "doc_id", "n_bytes")


def write_shards(docs: DataFrame, limit: int, path: str, step: int = 8) -> None:
    """Files of the documents, in a folder for each shard. A row is known by both hashes, so rows without a doc_id or
    with a repeated one are each written once, to their own shard."""
    rows = save(hashed(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")), "hashed")
    placed = _placed(rows, limit, step, "h1", "h2").select("h1", "h2", "shard")
    rows.select("h1", "h2", "_row").join(placed, ["h1", "h2"]).select("_row.*", "shard").repartition("shard").write.partitionBy("shard").parquet(path)
