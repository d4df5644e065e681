"""Verification as frames of findings (code, severity, subject, detail), and the repair plan that follows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Codes and what repairs them.
CACHE_CODES = ["cache.missing", "cache.size_mismatch", "cache.sha256_mismatch", "cache.gzip_corrupt"]
STORE_CODES = ["store.collection_missing", "store.collection_size_mismatch", "store.collection_unresolvable", "store.seq_file_missing"]
UNREPAIRABLE = ["store.seq_digest_mismatch", "store.sequence_unreadable", "store.n_sequences_mismatch", "store.n_collections_mismatch", "store.sequences_root_mismatch", "store.collections_root_mismatch"]


def finding(df: DataFrame, code: str | Column, severity: str | Column, subject: str, detail: Column | str = "") -> DataFrame:
    col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return df.select(col(code).alias("code"), col(severity).alias("severity"), F.col(subject).cast("string").alias("subject"), col(detail).cast("string").alias("detail"))


def union(*findings: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)


def cache(lock: DataFrame, files: DataFrame, hashes: bool = True) -> DataFrame:
    """Locked files (cache_path, bytes, sha256, present) against those found (cache_path, bytes, sha256, gzip_ok). A file
    that is there gets a finding for each of size, hash and gzip that is wrong."""
    now = files.select("cache_path", F.col("bytes").alias("_b"), F.col("sha256").alias("_s"), F.col("gzip_ok").alias("_g"))
    out = lock.where("present").join(now, "cache_path", "left")
    gone = F.col("_b").isNull() | (F.col("_b") == 0)
    wrong = [F.when(gone, "cache.missing"), F.when(~gone & (F.col("_b") != F.col("bytes")), "cache.size_mismatch")]
    if hashes:
        wrong.append(F.when(~gone & (F.col("_s") != F.col("sha256")), "cache.sha256_mismatch"))
    wrong.append(F.when(~gone & ~F.col("_g"), "cache.gzip_corrupt"))
    return finding(out.withColumn("_code", F.explode(F.array_compact(F.array(*wrong)))), F.col("_code"), "error", "cache_path")


def membership(locked: DataFrame, census: DataFrame) -> DataFrame:
    """Collections (collection, n) in the lock against the store's."""
    a, b = locked.select("collection", F.col("n").alias("_l")), census.select("collection", F.col("n").alias("_s"))
    code = F.when(F.col("_s").isNull(), "store.collection_missing").when(F.col("_l").isNull(), "store.collection_unrecorded").when(F.col("_l") != F.col("_s"), "store.collection_size_mismatch")
    out = a.join(b, "collection", "full_outer").withColumn("_code", code).where("_code is not null")
    return finding(out, F.col("_code"), F.when(F.col("_code") == "store.collection_unrecorded", "warn").otherwise("error"), "collection", F.concat_ws("/", F.col("_l").cast("string"), F.col("_s").cast("string")))


def coherence(indexed: DataFrame, on_disk: DataFrame, reachable: DataFrame) -> DataFrame:
    """Digests that are indexed but have no payload, are in no collection, or lie about without an index entry."""
    i, d, r = (df.select("digest").distinct() for df in (indexed, on_disk, reachable))
    return union(
        finding(i.join(d, "digest", "left_anti"), "store.seq_file_missing", "error", "digest"),
        finding(i.join(r, "digest", "left_anti"), "store.orphan_sequence", "warn", "digest"),
        finding(d.join(i, "digest", "left_anti"), "store.stray_seq_file", "warn", "digest"),
    )


def redigest(recomputed: DataFrame, baseline: DataFrame) -> DataFrame:
    """(digest, redigest; null: unreadable) against the known-bad baseline (digest, cause)."""
    out = recomputed.join(baseline.select("digest", "cause"), "digest", "left")
    bad, known = F.col("digest") != F.col("redigest"), F.col("cause").isNotNull()
    code = F.when(F.col("redigest").isNull(), "store.sequence_unreadable").when(bad, "store.seq_digest_mismatch").when(known, "store.seq_digest_fixed")
    severity = F.when(F.col("redigest").isNull(), "error").when(bad & known, "warn").when(bad, "error").otherwise("info")
    return finding(out.withColumn("_code", code).withColumn("_sev", severity).where("_code is not null"), F.col("_code"), F.col("_sev"), "digest", F.coalesce("cause", F.lit("")))


def manifest(sources_status: DataFrame, config_sha256: str | None = None, locked_sha256: str | None = None) -> DataFrame:
    code = F.when(F.col("status") == "new", "manifest.file_added").when(F.col("status") == "only_in_lock", "manifest.file_removed").when(F.col("status") == "upstream_changed", "manifest.checksum_changed")
    out = finding(sources_status.withColumn("_code", code).where("_code is not null"), F.col("_code"), "error", "url")
    if config_sha256 == locked_sha256:
        return out
    changed = sources_status.sparkSession.createDataFrame([("manifest.config_changed", "warn", "manifest", f"{locked_sha256} {config_sha256}")], out.schema)
    return out.unionByName(changed)


def remote(sizes: DataFrame) -> DataFrame:
    """(url, bytes, remote; null: unknown): warnings only, as a server's word proves nothing about the cache."""
    code = F.when(F.col("remote").isNull(), "remote.size_unavailable").when(F.col("remote") != F.col("bytes"), "remote.size_mismatch")
    return finding(sizes.withColumn("_code", code).where("_code is not null"), F.col("_code"), "warn", "url")


def severity_rank() -> Column:
    return F.when(F.col("severity") == "error", 0).when(F.col("severity") == "warn", 1).otherwise(2)


def capped(findings: DataFrame, most: int = 20) -> DataFrame:
    """The first ``most`` findings of each code, with the code's total. ``info`` is not shown."""
    shown = findings.where("severity <> 'info'")
    totals = shown.groupBy("code").agg(F.count("*").alias("total"))
    order = Window.partitionBy("code").orderBy(severity_rank(), "subject", "detail")
    return shown.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).join(totals, "code")


def summary(findings: DataFrame) -> DataFrame:
    return findings.groupBy("severity", "code").agg(F.count("*").alias("n"))


def failed(findings: DataFrame) -> bool:
    return bool(findings.where("severity = 'error'").limit(1).count())


def repair_plan(findings: DataFrame, members: DataFrame, sources_of: DataFrame, lock: DataFrame) -> DataFrame:
    """(action, path, owner, codes): refetch for cache codes, reingest for store codes, else unrepairable or ignored.

    Findings are classified once. A row carries the digest, the collection or the path that it is about; one chain of left
    joins turns digests to collections and collections to paths."""
    group = F.when(F.col("severity") == "warn", "ignored").when(F.col("code").isin(CACHE_CODES), "refetch").when(F.col("code").isin(STORE_CODES), "reingest").otherwise("unrepairable")
    is_digest = F.col("code") == "store.seq_file_missing"
    f = findings.where("severity <> 'info'").withColumn("action", group)
    f = f.select("action", "code", F.when((F.col("action") == "reingest") & is_digest, F.col("subject")).alias("digest"), F.when((F.col("action") == "reingest") & ~is_digest, F.col("subject")).alias("_col"), F.when(F.col("action") != "reingest", F.col("subject")).alias("_path"))
    f = f.join(members.select("digest", F.col("collection").alias("_of")), "digest", "left").select("action", "code", F.coalesce("_col", "_of").alias("collection"), "_path").distinct()
    f = f.join(sources_of.select("collection", F.col("path").alias("_from")), "collection", "left").select("action", "code", F.coalesce("_path", "_from").alias("path")).where("path is not null")
    acts = F.col("action").isin("refetch", "reingest")
    f = f.join(lock.select("path", F.concat_ws("/", "kind", "owner").alias("owner")), "path", "left").withColumn("owner", F.when(acts, F.col("owner")))
    alone = F.when(~acts, F.col("code"))  # what is not acted on stays a row a code
    return f.groupBy("action", "path", "owner", alone.alias("_alone")).agg(F.array_sort(F.collect_set("code")).alias("codes")).drop("_alone")
