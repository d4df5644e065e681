"""What differs between manifest, cache, lock and store, and what follows from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cache_vs_lock(cache: DataFrame, lock: DataFrame) -> DataFrame:
    """(cache_path, status): matched, changed, new, missing or only_in_lock. ``cache`` has a row per source; its sha256 is null where the file is missing."""
    a, b = cache.select("cache_path", F.col("sha256").alias("_now"), F.lit(True).alias("_a")), lock.select("cache_path", F.col("sha256").alias("_then"), F.lit(True).alias("_b"))
    status = (
        F.when(F.col("_a").isNull(), "only_in_lock")
        .when(F.col("_now").isNull(), "missing")
        .when(F.col("_b").isNull(), "new")
        .when(F.col("_now") == F.col("_then"), "matched")
        .otherwise("changed")
    )
    return a.join(b, "cache_path", "full_outer").select("cache_path", status.alias("status"))


def sources_vs_lock(sources: DataFrame, lock: DataFrame) -> DataFrame:
    """(url, status) of sources and lock files of the owners in scope: new, only_in_lock, upstream_changed or same."""
    scope = lock.join(sources.select("kind", "owner").distinct(), ["kind", "owner"], "left_semi")
    a, b = sources.select("url", F.col("checksum").alias("_now"), F.lit(True).alias("_a")), scope.select("url", F.col("checksum").alias("_then"), F.lit(True).alias("_b"))
    status = F.when(F.col("_b").isNull(), "new").when(F.col("_a").isNull(), "only_in_lock").when(~F.col("_now").eqNullSafe(F.col("_then")), "upstream_changed").otherwise("same")
    return a.join(b, "url", "full_outer").select("url", status.alias("status"))


def sync_plan(files: DataFrame, lock: DataFrame) -> DataFrame:
    """(path, class, reason): ``files`` has sha256 (null: not in the cache) and spec_sha256."""
    a = files.select("path", F.col("sha256").alias("_sha"), F.col("spec_sha256").alias("_spec"), F.lit(True).alias("_a"))
    b = lock.select("path", F.col("sha256").alias("_sha0"), F.col("spec_sha256").alias("_spec0"), F.lit(True).alias("_b"))
    sha, spec = ~F.col("_sha").eqNullSafe(F.col("_sha0")), ~F.col("_spec").eqNullSafe(F.col("_spec0"))
    kind = F.when(F.col("_a").isNull(), "removed").when(F.col("_sha").isNull(), "missing").when(F.col("_b").isNull(), "added").when(sha | spec, "reingest").otherwise("unchanged")
    out = a.join(b, "path", "full_outer").withColumn("class", kind)
    reason = F.when(F.col("class") == "reingest", F.when(sha, "upstream bytes changed").otherwise("ingest spec changed"))
    return out.select("path", "class", reason.alias("reason"))


def files_by_collection(collections: DataFrame) -> DataFrame:
    """(collection, path) of collections (collection, from)."""
    return collections.select("collection", F.explode("from").alias("path"))


def closure(paths: DataFrame, sources_of: DataFrame) -> DataFrame:
    """All files of every collection that any of ``paths`` feeds: one hop, as a file feeds one collection."""
    touched = sources_of.join(paths.select("path").distinct(), "path", "left_semi").select("collection").distinct()
    return sources_of.join(touched, "collection", "left_semi").select("path").union(paths.select("path")).distinct()


def owners(paths: DataFrame, lock: DataFrame) -> DataFrame:
    return lock.join(paths.select("path").distinct(), "path", "left_semi").select("kind", "owner").distinct()


def annotate_outputs(census: DataFrame, provenance: DataFrame, known: DataFrame) -> DataFrame:
    """Census rows with the known files that made them; none gives an empty list, and no collection is dropped."""
    own = provenance.join(known.select("path").distinct(), "path", "left_semi").groupBy("collection").agg(F.array_sort(F.collect_set("path")).alias("from"))
    return census.join(own, "collection", "left").withColumn("from", F.coalesce("from", F.array().cast("array<string>")))


def merge_lock(old: DataFrame, new: DataFrame, scope: DataFrame) -> DataFrame:
    """Lock files with the scopes in ``scope`` replaced by those of ``new``."""
    return old.join(scope.select("kind", "owner").distinct(), ["kind", "owner"], "left_anti").unionByName(new.select(old.columns))


def orphans_after(sequences: DataFrame, members: DataFrame, removed: DataFrame) -> DataFrame:
    """Sequences that only the removed collections hold: one aggregate a digest says whether all its collections go."""
    gone = removed.select("collection").distinct().withColumn("_gone", F.lit(True))
    marked = members.join(gone, "collection", "left").groupBy("digest").agg(F.count_if(F.col("_gone").isNull()).alias("_kept"))
    return sequences.join(marked.where("_kept = 0"), "digest", "left_semi")


def touched_namespaces(owners: DataFrame, namespaces: DataFrame) -> DataFrame:
    """Owners (owner, namespace) that feed any namespace which one of ``owners`` feeds."""
    hit = namespaces.join(owners.select("owner").distinct(), "owner", "left_semi").select("namespace").distinct()
    return namespaces.join(hit, "namespace", "left_semi").select("owner").distinct()


def merge_outputs(old: DataFrame, census: DataFrame, provenance: DataFrame) -> DataFrame:
    """Lock collections (collection, n, from) after a partial run: as the store now holds them; the files of one that the
    run did not touch are carried over."""
    new = annotate_outputs(census, provenance, provenance)
    return new.join(old.select("collection", F.col("from").alias("_old")), "collection", "left").select("collection", "n", F.when(F.size("from") > 0, F.col("from")).otherwise(F.coalesce("_old", "from")).alias("from"))


def contributors(sources_of: DataFrame) -> DataFrame:
    """One row: collections, those that several files feed, and the most files of any."""
    own = sources_of.groupBy("collection").agg(F.count_distinct("path").alias("n"))
    return own.agg(F.count("*").alias("collections"), F.count_if(F.col("n") > 1).alias("shared"), F.max("n").alias("widest"))


def matching_collections(sources_of: DataFrame, lock: DataFrame, text: str) -> DataFrame:
    """Collections fed by a file whose path, URL or owner holds ``text``."""
    hit = lock.where(F.concat_ws("\n", "path", "url", "owner").contains(text)).select("path").distinct()
    return sources_of.join(hit, "path", "left_semi").select("collection").distinct()


def publishers(members: DataFrame, digests: DataFrame) -> DataFrame:
    """Collections that hold any of the digests."""
    return members.join(digests.select("digest").distinct(), "digest", "left_semi").select("collection").distinct()
