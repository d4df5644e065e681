"""Comparison of two inventories: by digest, by alias, over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixlake.functions.aggregates import names, percent, top
from helixlake.functions.scalars import accession_prefix, slug, version_base, version_number


def side(in_left: Column, in_right: Column) -> Column:
    return F.when(in_left & in_right, "both").when(in_left, "left_only").otherwise("right_only")


def membership(left: DataFrame, right: DataFrame, key: str = "digest") -> DataFrame:
    """(key, membership) over the union of both sets."""
    a, b = left.select(key).distinct().withColumn("_l", F.lit(True)), right.select(key).distinct().withColumn("_r", F.lit(True))
    return a.join(b, key, "full_outer").select(key, side(F.col("_l").isNotNull(), F.col("_r").isNotNull()).alias("membership"))


def coverage(member: DataFrame) -> DataFrame:
    n = lambda kind: F.count_if(F.col("membership") == kind)
    counts = member.agg(n("both").alias("both"), n("left_only").alias("left_only"), n("right_only").alias("right_only"))
    return counts.select("*", percent(F.col("both"), F.col("both") + F.col("left_only")).alias("left_covered"), percent(F.col("both"), F.col("both") + F.col("right_only")).alias("right_covered"))


def alias_parity(left: DataFrame, right: DataFrame, right_digests: DataFrame) -> DataFrame:
    """(namespace, alias, left_digest, right_digest, status) over the union of both alias sets."""
    a, b = left.select("namespace", "alias", F.col("digest").alias("left_digest")), right.select("namespace", "alias", F.col("digest").alias("right_digest"))
    held = right_digests.select(F.col("digest").alias("left_digest")).distinct().withColumn("_held", F.lit(True))
    out = a.join(b, ["namespace", "alias"], "full_outer").join(held, "left_digest", "left")
    status = (
        F.when(F.col("left_digest") == F.col("right_digest"), "match")
        .when(F.col("left_digest").isNotNull() & F.col("right_digest").isNotNull(), "digest_mismatch")
        .when(F.col("left_digest").isNull(), "store_only")
        .when(F.col("_held").isNotNull(), "left_only_digest_present")
        .otherwise("left_only_missing")
    )
    return out.select("namespace", "alias", "left_digest", "right_digest", status.alias("status"))


def namespace_agreement(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per namespace: shared, agree, mismatch, only_left, only_right."""
    a, b = left.select("namespace", "alias", F.col("digest").alias("l")), right.select("namespace", "alias", F.col("digest").alias("r"))
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    return a.join(b, ["namespace", "alias"], "full_outer").groupBy("namespace").agg(
        F.count_if(both).alias("shared"),
        F.count_if(both & (F.col("l") == F.col("r"))).alias("agree"),
        F.count_if(both & (F.col("l") != F.col("r"))).alias("mismatch"),
        F.count_if(F.col("r").isNull()).alias("only_left"),
        F.count_if(F.col("l").isNull()).alias("only_right"),
    )


def equivalence(left: DataFrame, right: DataFrame, divergent: DataFrame, right_digests: DataFrame) -> DataFrame:
    """Category of each left name (alias, digest), and for a mismatch its cause by ``divergent`` (alias, cause).

    Names of both sides match or mismatch (explained or not). One that the right side lacks is superseded if its base has
    a newer version there, or it has no version itself; any other one whose base has versions is a backfill candidate.
    Without versions, it is a naming gap if the right side holds its digest, else its sequence is missing. Names
    without a version make no version known. The inequality is a test of the base's highest version."""
    a = left.select("alias", F.col("digest").alias("l"))
    b = right.select("alias", F.col("digest").alias("r"))
    known = divergent.groupBy("alias").agg(F.min("cause").alias("cause"))
    versions = right.select(version_base(F.col("alias")).alias("_base"), version_number(F.col("alias")).alias("_v")).where("_v is not null")
    versions = versions.groupBy("_base").agg(F.max("_v").alias("_top"))
    held = right_digests.select(F.col("digest").alias("l")).distinct().withColumn("_held", F.lit(True))
    out = a.join(b, "alias", "left").join(known, "alias", "left").join(held, "l", "left")
    out = out.withColumn("_base", version_base(F.col("alias"))).withColumn("_v", version_number(F.col("alias"))).join(versions, "_base", "left")
    both = F.col("r").isNotNull()
    category = (
        F.when(F.col("l") == F.col("r"), "matched")
        .when(both & F.col("cause").isNotNull(), "mismatch_explained")
        .when(both, "mismatch_unexplained")
        .when(F.col("_top").isNotNull() & (F.col("_v").isNull() | (F.col("_top") > F.col("_v"))), "superseded_old_version")
        .when(F.col("_top").isNotNull(), "backfill_candidate")
        .when(F.col("_held").isNotNull(), "alias_naming_gap")
        .otherwise("sequence_missing")
    )
    cause = F.when(both & (F.col("l") != F.col("r")), F.coalesce("cause", F.lit("unexplained")))
    return out.select("alias", F.col("l").alias("left_digest"), F.col("r").alias("right_digest"), category.alias("category"), cause.alias("cause"))


def digest_report(left: DataFrame, right: DataFrame, most: int = 8) -> DataFrame:
    """Each digest of either side with its namespaces and capped alias examples. Only ``most`` aliases meet in a row."""
    tag = lambda df, s: df.select("digest", "namespace", "alias", F.lit(s).alias("side"))
    every = tag(left, "left").unionByName(tag(right, "right"))
    mine = lambda s: F.col("side") == s
    out = every.groupBy("digest").agg(
        side(F.count_if(mine("left")) > 0, F.count_if(mine("right")) > 0).alias("membership"),
        names(F.when(mine("left"), F.col("namespace"))).alias("left_namespaces"),
        names(F.when(mine("right"), F.col("namespace"))).alias("right_namespaces"),
    )
    shown = top(every, ["digest", "side"], "alias", most).groupBy("digest")
    shown = shown.agg(*(F.coalesce(F.max(F.when(mine(s), F.col("shown"))), F.lit("")).alias(f"{s}_aliases") for s in ("left", "right")))
    return out.join(shown, "digest").select("digest", "membership", "left_namespaces", "left_aliases", "right_namespaces", "right_aliases")


def gaps(left: DataFrame, right: DataFrame, right_digests: DataFrame) -> DataFrame:
    """Left names that the right side lacks, with what would close the gap: (alias, category, prefix, digest)."""
    none = left.sparkSession.createDataFrame([], "alias string, cause string")
    found = equivalence(left, right, none, right_digests).where("right_digest is null")
    return found.select("alias", "category", accession_prefix(F.col("alias")).alias("prefix"), F.col("left_digest").alias("digest"))


def filter_gaps(found: DataFrame, categories: list[str], prefixes: list[str]) -> DataFrame:
    starts = F.exists(F.array(*map(F.lit, prefixes)), lambda p: F.col("alias").startswith(p))
    return found.where(F.col("category").isin(categories) & starts)


def digest_coverage(left: DataFrame, right_digests: DataFrame, mapped: list[str], drifting: list[str], synthetic: list[str]) -> DataFrame:
    """One row: digests of ``left`` (namespace, alias, digest) in all, present, missing, the percentage, and the missing
    ones by the namespaces that refer to them: a mapped one, else one that drifts by version, else any other. Synthetic
    namespaces restate the digest and say nothing."""
    named = ~F.col("namespace").isin(synthetic)
    has = lambda names: F.max(named & F.col("namespace").isin(names))
    own = left.groupBy("digest").agg(has(mapped).alias("_m"), has(drifting).alias("_d"))
    held = right_digests.select("digest").distinct().withColumn("_held", F.lit(True))
    gone = F.col("_held").isNull()
    out = own.join(held, "digest", "left").agg(
        F.count("*").alias("digests"),
        F.count_if(~gone).alias("present"),
        F.count_if(gone).alias("missing"),
        F.count_if(gone & F.col("_m")).alias("missing_mapped"),
        F.count_if(gone & ~F.col("_m") & F.col("_d")).alias("missing_drift"),
        F.count_if(gone & ~F.col("_m") & ~F.col("_d")).alias("missing_other"),
    )
    return out.withColumn("coverage", percent(F.col("present"), F.col("digests")))


def classify_namespaces(left: DataFrame, right: DataFrame, mapping: dict[str, str], omitted: list[str], drifting: list[str]) -> DataFrame:
    """(namespace, status, target, n): namespaces of the left side that are mapped, omitted by design, drift by version
    or are not recognized, and those of the right side that nothing maps to."""
    targets = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair)) if mapping else F.lit(None).cast("map<string,string>")
    name = F.col("namespace")
    status = F.when(name.isin(list(mapping)), "mapped").when(name.isin(omitted), "expected_omit").when(name.isin(drifting), "version_drift").otherwise("unrecognized")
    known = left.groupBy("namespace").agg(F.count("*").alias("n")).select("namespace", status.alias("status"), F.get(F.map_values(F.map_filter(targets, lambda k, v: k == name)), F.lit(0)).alias("target"), "n")
    only = right.where(~name.isin(sorted(set(mapping.values())))).groupBy("namespace").agg(F.count("*").alias("n"))
    return known.unionByName(only.select("namespace", F.lit("right_only").alias("status"), F.lit(None).cast("string").alias("target"), "n"))


def namespace_correspondence(left: DataFrame, right: DataFrame, canonical: Column, omitted: list[str]) -> DataFrame:
    """(canonical, status, reason) of namespaces brought to one spelling by ``canonical``, an expression of ``namespace``."""
    a = left.groupBy(canonical.alias("canonical")).agg(F.max(F.col("namespace").isin(omitted)).alias("_omit"), F.lit(True).alias("_l"))
    b = right.select(canonical.alias("canonical")).distinct().withColumn("_r", F.lit(True))
    status = F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), "both").when(F.col("_l").isNotNull(), "left_only").otherwise("right_only")
    reason = (
        F.when(F.col("status") == "both", "compared name by name")
        .when((F.col("status") == "left_only") & F.col("_omit"), "restates the digest, omitted by design")
        .when(F.col("status") == "left_only", "not loaded by the build")
        .when(F.col("canonical").rlike(r"-\d+\z"), "one immutable release, the left side keeps a rolling view")
        .otherwise("not carried by the left side")
    )
    return a.join(b, "canonical", "full_outer").withColumn("status", status).select("canonical", "status", reason.alias("reason"))


#: Failure policies of a verdict.
POLICIES = ("none", "gaps", "mismatch")


def verdict(categories: DataFrame, policy: str = "gaps") -> DataFrame:
    """One row from (core, category) of every compared name: counts over the core namespaces, backfill over all, and
    whether the right side can stand in for the left one."""
    if policy not in POLICIES:
        raise ValueError(f"policy is one of {', '.join(POLICIES)}")
    n = lambda kind, core=True: F.count_if((F.col("category") == kind) & F.col("core") if core else F.col("category") == kind)
    out = categories.agg(
        n("mismatch_unexplained").alias("unexplained"),
        n("mismatch_explained").alias("explained"),
        n("sequence_missing").alias("missing"),
        n("alias_naming_gap").alias("naming_gaps"),
        n("backfill_candidate", False).alias("backfill"),
    )
    clean = (F.col("unexplained") == 0) & (F.col("missing") == 0) & (F.col("naming_gaps") == 0)
    fits = {"none": F.lit(True), "gaps": clean, "mismatch": clean & (F.col("explained") == 0)}
    return out.withColumn("compatible", fits[policy])


def first_last(rows: DataFrame) -> DataFrame:
    """(release, alias, digest, length): per name its first and last release and the digest of its longest sequence."""
    longest = F.max(F.struct("length", "digest"))["digest"]
    return rows.groupBy("alias").agg(F.min("release").alias("first"), F.max("release").alias("last"), longest.alias("longest"))


def flag_duplicates(rows: DataFrame, key: str, order: str, status: str = "discovered") -> DataFrame:
    """Every row with a status: the first of its key in ``order`` has ``status``, later ones ``skipped_duplicate_url``."""
    first = F.row_number().over(Window.partitionBy(key).orderBy(order)) == 1
    return rows.withColumn("status", F.when(first, status).otherwise("skipped_duplicate_url"))


def unpaired(rows: DataFrame, group: str, kind: str) -> DataFrame:
    """Groups that have one kind only, and that kind."""
    return rows.groupBy(group).agg(F.min(kind).alias("only"), F.max(kind).alias("_other")).where("only = _other").drop("_other")


def family_labels(rows: DataFrame) -> DataFrame:
    """(label, identity, accession): one name a family. A label that several identities share gets the least accession
    of its identity as a suffix."""
    own = rows.groupBy("label", "identity").agg(F.min("accession").alias("anchor"))
    shared = own.groupBy("label").agg(F.count("*").alias("_n"))
    name = F.when(F.col("_n") > 1, F.concat_ws("_", "label", slug(F.col("anchor")))).otherwise(F.col("label"))
    return own.join(shared, "label").select("label", "identity", name.alias("family"))


def occurrences(members: DataFrame, provenance: DataFrame) -> DataFrame:
    """(digest, name, path): where each sequence occurs, by collections and the files that made them."""
    return members.join(provenance, "collection").select("digest", "name", "path").distinct()


def unresolved(accessions: DataFrame, namespaces: list[str], aliases: DataFrame) -> DataFrame:
    """(namespace, alias): accessions that a namespace should name and does not."""
    wanted = accessions.select(F.explode(F.array(*map(F.lit, namespaces))).alias("namespace"), "alias").distinct()
    return wanted.join(aliases, ["namespace", "alias"], "left_anti")


def mutation(before: DataFrame, after: DataFrame, expected_gone: DataFrame) -> DataFrame:
    """(key, outcome) of a store's keys before and after a change: removed, added, kept, still_present (it should be
    gone) and lost (it should not be)."""
    a, b = before.select("key").distinct().withColumn("_a", F.lit(True)), after.select("key").distinct().withColumn("_b", F.lit(True))
    gone = expected_gone.select("key").distinct().withColumn("_gone", F.lit(True))
    out = a.join(b, "key", "full_outer").join(gone, "key", "left")
    due = F.col("_gone").isNotNull()
    outcome = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), F.when(due, "removed").otherwise("lost")).when(due, "still_present").otherwise("kept")
    return out.select("key", outcome.alias("outcome"))


def same_set(a: DataFrame, b: DataFrame, key: str) -> bool:
    return not membership(a, b, key).where("membership <> 'both'").limit(1).count()


def lacking(whole: DataFrame, part: DataFrame, key: str) -> DataFrame:
    """Keys of ``part`` that ``whole`` lacks: none if it is a superset. Also the stale rows of a baseline."""
    return part.select(key).distinct().join(whole.select(key), key, "left_anti")


def earliest(rows: DataFrame, *order: str, key: str = "digest", value: str = "source") -> DataFrame:
    """The earliest source of each key; ``order`` is the chronology, with the value as the last word."""
    return rows.groupBy(key).agg(F.min_by(value, F.struct(*order, value)).alias(value))


def running_coverage(rows: DataFrame, order: str, item: str) -> DataFrame:
    """Per step of ``order``: own items, those not seen before, and their running total and percentage.

    The window runs over one row a step, not over the items."""
    own = rows.groupBy(order).agg(F.count_distinct(item).alias("own"))
    first = rows.groupBy(item).agg(F.min(order).alias(order)).groupBy(order).agg(F.count("*").alias("marginal"))
    steps = own.join(first, order, "left").withColumn("marginal", F.coalesce("marginal", F.lit(0)))
    upto, every = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0), Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    steps = steps.withColumn("cumulative", F.sum("marginal").over(upto))
    return steps.withColumn("cumulative_percent", percent(F.col("cumulative"), F.sum("marginal").over(every)))


def drift(rows: DataFrame) -> DataFrame:
    """(release, alias, digest): per pair of neighbouring releases, shared and changed names.

    A release is joined with the next one that exists, on (release, alias)."""
    releases = rows.select("release").distinct()
    following = releases.withColumn("next", F.lead("release").over(Window.orderBy("release"))).where("next is not null")
    now = rows.join(following, "release").select(F.col("release").alias("from"), F.col("next").alias("to"), "alias", "digest")
    then = rows.select(F.col("release").alias("to"), "alias", F.col("digest").alias("_then"))
    return now.join(then, ["to", "alias"]).groupBy("from", "to").agg(F.count("*").alias("shared"), F.count_if(F.col("digest") != F.col("_then")).alias("changed"))


def trajectory(rows: DataFrame) -> DataFrame:
    """(alias, path): a letter a release, another letter for each digest not seen before in it; numbers from the 27th on."""
    listed = rows.groupBy("alias").agg(F.transform(F.array_sort(F.collect_list(F.struct("release", "digest"))), lambda x: x["digest"]).alias("ds"))
    number = lambda d: F.array_position(F.array_distinct("ds"), d).cast("int")
    letter = lambda d: F.when(number(d) <= 26, F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), number(d), F.lit(1))).otherwise(number(d).cast("string"))
    return listed.select("alias", F.array_join(F.transform("ds", letter), " ").alias("path"))


def precedence(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``: eras, file ranks, URL discovery."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_rn = 1").drop("_rn")
