"""Alias operators: report rows to aliases, resolution, add-only loads and exact reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixlake.functions.scalars import is_na, lrg_names

SAFE_NAME = r"\A[A-Za-z0-9_.-]+\z"


def report_aliases(rows: DataFrame, namespace: str) -> DataFrame:
    """(refseq, namespace, alias): up to five aliases of a report row, none of them NA."""
    pairs = [(namespace, "Sequence-Name"), (namespace, "UCSC-style-name"), (namespace, "GenBank-Accn"), ("insdc", "GenBank-Accn"), ("refseq", "RefSeq-Accn")]
    every = F.array(*(F.struct(F.lit(n).alias("namespace"), F.col(f"`{c}`").alias("alias")) for n, c in pairs))
    kept = F.filter(every, lambda x: ~is_na(x["alias"]))
    return rows.where(~is_na(F.col("`RefSeq-Accn`"))).select(F.col("`RefSeq-Accn`").alias("refseq"), F.explode(kept).alias("x")).select("refseq", "x.*").distinct()


def resolve_report(aliases: DataFrame, stored: DataFrame, pending: DataFrame) -> DataFrame:
    """Digests of report aliases by their RefSeq name: pending ones win over stored ones; null where neither has it."""
    one = lambda df, c: df.where("namespace = 'refseq'").select(F.col("alias").alias("refseq"), F.col("digest").alias(c))
    out = aliases.join(one(pending, "_new"), "refseq", "left").join(one(stored, "_old"), "refseq", "left")
    return out.select("refseq", "namespace", "alias", F.coalesce("_new", "_old").alias("digest"))


def member_aliases(members: DataFrame, namespace: str, expand_lrg: bool = False) -> DataFrame:
    names = F.explode(lrg_names(F.col("name"))) if expand_lrg else F.col("name")
    return members.select(F.lit(namespace).alias("namespace"), names.alias("alias"), "digest").distinct()


def conflicts(aliases: DataFrame) -> DataFrame:
    """Names that mean more than one digest."""
    return aliases.groupBy("namespace", "alias").agg(F.count_distinct("digest").alias("n")).where("n > 1")


def first_seen(batches: DataFrame) -> DataFrame:
    """Batches (report_ord, row_ord, namespace, alias, digest): the first of each name is added, later equal ones are skipped."""
    order = Window.partitionBy("namespace", "alias").orderBy("report_ord", "row_ord")
    return batches.withColumn("rn", F.row_number().over(order)).withColumn("outcome", F.when(F.col("rn") == 1, "added").when(F.col("digest") == F.first("digest").over(order), "skipped").otherwise("conflict")).drop("rn")


def classify_load(planned: DataFrame, existing: DataFrame) -> DataFrame:
    """An add-only load: new, same or conflict against what is there."""
    old = existing.select("namespace", "alias", F.col("digest").alias("_old"))
    out = planned.join(old, ["namespace", "alias"], "left")
    return out.select("namespace", "alias", "digest", F.when(F.col("_old").isNull(), "new").when(F.col("_old") == F.col("digest"), "same").otherwise("conflict").alias("outcome"))


def reconcile(desired: DataFrame, existing: DataFrame) -> DataFrame:
    """What makes a namespace exactly as desired: rows to add and to remove."""
    keys = ["namespace", "alias", "digest"]
    add = desired.select(keys).join(existing.select(keys), keys, "left_anti").withColumn("change", F.lit("added"))
    gone = existing.select(keys).join(desired.select("namespace").distinct(), "namespace", "left_semi").join(desired.select(keys), keys, "left_anti")
    return add.unionByName(gone.withColumn("change", F.lit("removed")))


def dangling(aliases: DataFrame, sequences: DataFrame) -> DataFrame:
    return aliases.join(sequences.select("digest"), "digest", "left_anti")


def unsafe_names(aliases: DataFrame) -> DataFrame:
    return aliases.where(~F.col("namespace").rlike(SAFE_NAME)).select("namespace").distinct()


def forbidden_prefixes(aliases: DataFrame, prefixes: list[str]) -> DataFrame:
    hit = F.exists(F.array(*map(F.lit, prefixes)), lambda p: F.col("alias").startswith(p))
    return aliases.where(hit).groupBy("namespace").agg(F.count("*").alias("n"))


def release_groups(rows: DataFrame) -> DataFrame:
    """(group, release, alias, digest) as immutable ``group-release`` namespaces and the rolling one of the newest release.

    The newest release is an aggregate of the group, a row each, so no group is sorted."""
    newest = rows.groupBy("group").agg(F.max("release").alias("release"))
    fixed = rows.select(F.concat_ws("-", "group", "release").alias("namespace"), "alias", "digest")
    rolling = rows.join(newest, ["group", "release"], "left_semi").select(F.col("group").alias("namespace"), "alias", "digest")
    return fixed.union(rolling).distinct()


def publish(rows: DataFrame, processed: DataFrame, expected: DataFrame) -> DataFrame:
    """Namespaces of the releases that are complete: a partial one publishes nothing. A name that means two digests
    within a release is an error."""
    whole = rows.join(complete_groups(processed, expected), ["group", "release"], "left_semi")
    if bad := whole.groupBy("group", "release", "alias").agg(F.count_distinct("digest").alias("n")).where("n > 1").limit(3).collect():
        raise ValueError(f"names with two digests in a release: {[(r.group, r.release, r.alias) for r in bad]}")
    return release_groups(whole)


def collection_aliases(headers: DataFrame) -> DataFrame:
    """(namespace, alias, digest) of collections by a report's header (refseq, genbank, digest); NA names nothing."""
    pairs = F.array(F.struct(F.lit("refseq").alias("namespace"), F.col("refseq").alias("alias")), F.struct(F.lit("insdc").alias("namespace"), F.col("genbank").alias("alias")))
    return headers.select("digest", F.explode(F.filter(pairs, lambda x: ~is_na(x["alias"]))).alias("x")).select("x.*", "digest").distinct()


def forbidden_namespaces(aliases: DataFrame, names: list[str]) -> DataFrame:
    return aliases.where(F.col("namespace").isin(names)).select("namespace").distinct()


def complete_groups(processed: DataFrame, expected: DataFrame) -> DataFrame:
    """Releases of which every expected file was processed; only these are published."""
    have = processed.groupBy("group", "release").agg(F.count_distinct("file").alias("have"))
    return expected.join(have, ["group", "release"], "left").where(F.coalesce("have", F.lit(0)) == F.col("files")).select("group", "release")
