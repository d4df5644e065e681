"""The engine's operators over the driver's tables, each with equivalent DuckDB SQL.

Two inventories are read out of ``lineitem``: L names parts per return flag, R per line status. Every query runs over
whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixlake.functions import aggregates as agg
from helixlake.functions import scalars as fn
from helixlake.operators import aliases, exclusion, parity, sync, verify
from helixlake.sources import manifest
from helixlake.streaming import events as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"{CTES}\n{sql}"
        return f

    return add


CTES = """WITH l AS (SELECT l_returnflag AS namespace, 'P_' || l_partkey || '.' || min(l_linenumber) AS alias, md5(min(l_suppkey)::VARCHAR) AS digest
    FROM lineitem GROUP BY l_returnflag, l_partkey),
  r AS (SELECT CASE l_linestatus WHEN 'F' THEN 'A' ELSE 'N' END AS namespace, 'P_' || l_partkey || '.' || max(l_linenumber) AS alias, md5(max(l_suppkey)::VARCHAR) AS digest
    FROM lineitem GROUP BY 1, l_partkey),
  rel AS (SELECT year(l_shipdate)::INTEGER AS release, l_partkey::VARCHAR AS alias, max(l_suppkey)::VARCHAR AS digest FROM lineitem GROUP BY 1, 2),
  src AS (SELECT DISTINCT l_suppkey::VARCHAR AS collection, l_partkey::VARCHAR AS path FROM lineitem),
  files AS (SELECT l_partkey::VARCHAR AS path, md5(count(*)::VARCHAR) AS sha256, max(l_returnflag) AS spec_sha256 FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1),
  lck AS (SELECT l_partkey::VARCHAR AS path, md5(count(*)::VARCHAR) AS sha256, max(l_returnflag) AS spec_sha256 FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)"""


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column: str) -> F.Column:
    return F.col(column).cast("string")


def left(spark, d) -> DataFrame:
    rows = t(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("namespace"), "l_partkey").agg(F.min("l_linenumber").alias("v"), F.min("l_suppkey").alias("s"))
    return rows.select("namespace", F.concat(F.lit("P_"), text("l_partkey"), F.lit("."), text("v")).alias("alias"), F.md5(text("s")).alias("digest"))


def right(spark, d) -> DataFrame:
    namespace = F.when(F.col("l_linestatus") == "F", "A").otherwise("N")
    rows = t(spark, d, "lineitem").groupBy(namespace.alias("namespace"), "l_partkey").agg(F.max("l_linenumber").alias("v"), F.max("l_suppkey").alias("s"))
    return rows.select("namespace", F.concat(F.lit("P_"), text("l_partkey"), F.lit("."), text("v")).alias("alias"), F.md5(text("s")).alias("digest"))


def releases(spark, d) -> DataFrame:
    return t(spark, d, "lineitem").groupBy(F.year("l_shipdate").alias("release"), text("l_partkey").alias("alias")).agg(F.max("l_suppkey").cast("string").alias("digest"))


def sources_of(spark, d) -> DataFrame:
    return t(spark, d, "lineitem").select(text("l_suppkey").alias("collection"), text("l_partkey").alias("path")).distinct()


def files(spark, d, rule: str) -> DataFrame:
    rows = t(spark, d, "lineitem").where(rule).groupBy(text("l_partkey").alias("path"))
    return rows.agg(F.md5(F.count("*").cast("string")).alias("sha256"), F.max("l_returnflag").alias("spec_sha256"))


@query("SELECT namespace, 'sha256:' || sha256(string_agg(DISTINCT digest || chr(10), '' ORDER BY digest || chr(10))) AS root FROM l GROUP BY namespace")
def set_root(spark, d):
    return left(spark, d).groupBy("namespace").agg(agg.set_root(F.concat(F.lit("SQ."), F.col("digest"))).alias("root"))


@query("SELECT coalesce(a.digest, b.digest) AS digest, CASE WHEN b.digest IS NULL THEN 'left_only' WHEN a.digest IS NULL THEN 'right_only' ELSE 'both' END AS membership FROM (SELECT DISTINCT digest FROM l) a FULL JOIN (SELECT DISTINCT digest FROM r) b ON a.digest = b.digest")
def digest_membership(spark, d):
    return parity.membership(left(spark, d), right(spark, d))


@query("""SELECT *, round(100.0 * "both" / greatest("both" + left_only, 1), 4)::DOUBLE AS left_covered, round(100.0 * "both" / greatest("both" + right_only, 1), 4)::DOUBLE AS right_covered FROM (
    SELECT count(*) FILTER (a.alias IS NOT NULL AND b.alias IS NOT NULL) AS "both", count(*) FILTER (b.alias IS NULL) AS left_only, count(*) FILTER (a.alias IS NULL) AS right_only
    FROM (SELECT DISTINCT alias FROM l) a FULL JOIN (SELECT DISTINCT alias FROM r) b ON a.alias = b.alias)""")
def coverage(spark, d):
    return parity.coverage(parity.membership(left(spark, d), right(spark, d), "alias"))


@query("""SELECT coalesce(a.namespace, b.namespace) AS namespace, coalesce(a.alias, b.alias) AS alias, a.digest AS left_digest, b.digest AS right_digest,
    CASE WHEN a.digest = b.digest THEN 'match' WHEN a.digest IS NOT NULL AND b.digest IS NOT NULL THEN 'digest_mismatch' WHEN a.digest IS NULL THEN 'store_only'
    WHEN a.digest IN (SELECT digest FROM r) THEN 'left_only_digest_present' ELSE 'left_only_missing' END AS status
    FROM l a FULL JOIN r b ON a.namespace = b.namespace AND a.alias = b.alias""")
def alias_parity(spark, d):
    r = right(spark, d)
    return parity.alias_parity(left(spark, d), r, r)


@query("""SELECT coalesce(a.namespace, b.namespace) AS namespace, count(*) FILTER (a.alias IS NOT NULL AND b.alias IS NOT NULL) AS shared, count(*) FILTER (a.digest = b.digest) AS agree,
    count(*) FILTER (a.digest <> b.digest) AS mismatch, count(*) FILTER (b.alias IS NULL) AS only_left, count(*) FILTER (a.alias IS NULL) AS only_right
    FROM l a FULL JOIN r b ON a.namespace = b.namespace AND a.alias = b.alias GROUP BY 1""")
def namespace_agreement(spark, d):
    return parity.namespace_agreement(left(spark, d), right(spark, d))


#: The left inventory here also holds names without a version, and ones above any version of the right side.
EQUIVALENCE = """, x AS (SELECT alias, min(l) AS l FROM (SELECT CASE l_partkey % 7 WHEN 0 THEN 'P_' || l_partkey WHEN 1 THEN 'P_' || l_partkey || '.99' WHEN 2 THEN 'Q_' || l_partkey ELSE 'P_' || l_partkey || '.' || min(l_linenumber) END AS alias,
      md5(min(l_suppkey)::VARCHAR) AS l FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_partkey) GROUP BY alias), y AS (SELECT alias, digest AS r FROM r WHERE namespace = 'A'),
    vs AS (SELECT split_part(alias, '.', 1) AS base, max(split_part(alias, '.', 2)::BIGINT) AS top FROM y GROUP BY 1), k AS (SELECT DISTINCT alias FROM l WHERE namespace = 'R'),
    eq AS (SELECT x.alias, x.l AS left_digest, y.r AS right_digest, CASE WHEN x.l = y.r THEN 'matched' WHEN y.r IS NOT NULL AND k.alias IS NOT NULL THEN 'mismatch_explained' WHEN y.r IS NOT NULL THEN 'mismatch_unexplained'
    WHEN vs.top IS NOT NULL AND (strpos(x.alias, '.') = 0 OR vs.top > split_part(x.alias, '.', 2)::BIGINT) THEN 'superseded_old_version' WHEN vs.top IS NOT NULL THEN 'backfill_candidate' WHEN x.l IN (SELECT r FROM y) THEN 'alias_naming_gap' ELSE 'sequence_missing' END AS category,
    CASE WHEN x.l <> y.r THEN CASE WHEN k.alias IS NOT NULL THEN 'R' ELSE 'unexplained' END END AS cause
    FROM x LEFT JOIN y USING (alias) LEFT JOIN k USING (alias) LEFT JOIN vs ON vs.base = split_part(x.alias, '.', 1))"""


def _named(spark, d) -> DataFrame:
    rows = t(spark, d, "lineitem").where("l_returnflag = 'A'").groupBy("l_partkey").agg(F.min("l_linenumber").alias("v"), F.min("l_suppkey").alias("s"))
    part, kind = text("l_partkey"), F.col("l_partkey") % 7
    name = F.when(kind == 0, F.concat(F.lit("P_"), part)).when(kind == 1, F.concat(F.lit("P_"), part, F.lit(".99"))).when(kind == 2, F.concat(F.lit("Q_"), part)).otherwise(F.concat(F.lit("P_"), part, F.lit("."), text("v")))
    return rows.select(name.alias("alias"), F.md5(text("s")).alias("digest")).groupBy("alias").agg(F.min("digest").alias("digest"))


def _equivalence(spark, d) -> DataFrame:
    r = right(spark, d).where("namespace = 'A'")
    divergent = left(spark, d).where("namespace = 'R'").select("alias", F.lit("R").alias("cause"))
    return parity.equivalence(_named(spark, d), r, divergent, r)


@query(EQUIVALENCE + " SELECT * FROM eq")
def alias_equivalence(spark, d):
    return _equivalence(spark, d)


@query(EQUIVALENCE + " SELECT alias, category, CASE WHEN substr(alias, 3, 1) = '_' THEN substr(alias, 1, 3) WHEN regexp_full_match(substr(alias, 1, 4), '[A-Za-z]{4}') THEN substr(alias, 1, 4) ELSE substr(alias, 1, 3) END AS prefix, left_digest AS digest FROM eq WHERE right_digest IS NULL")
def gap_list(spark, d):
    r = right(spark, d).where("namespace = 'A'")
    return parity.gaps(_named(spark, d), r, r)


@query(EQUIVALENCE + """ SELECT *, unexplained = 0 AND missing = 0 AND naming_gaps = 0 AS compatible FROM (SELECT count(*) FILTER (core AND category = 'mismatch_unexplained') AS unexplained, count(*) FILTER (core AND category = 'mismatch_explained') AS explained,
    count(*) FILTER (core AND category = 'sequence_missing') AS missing, count(*) FILTER (core AND category = 'alias_naming_gap') AS naming_gaps, count(*) FILTER (category = 'backfill_candidate') AS backfill FROM (SELECT category, alias LIKE 'P%' AS core FROM eq))""")
def verdict(spark, d):
    return parity.verdict(_equivalence(spark, d).select("category", F.col("alias").startswith("P").alias("core")), "gaps")


@query(""", g AS (SELECT digest, bool_or(namespace = 'A') AS m, bool_or(namespace = 'N') AS dr FROM l GROUP BY digest), h AS (SELECT *, digest IN (SELECT md5(s_suppkey::VARCHAR) FROM supplier WHERE s_nationkey < 9) AS held FROM g)
    SELECT *, round(100.0::DOUBLE * present / greatest(digests, 1), 4) AS coverage FROM (SELECT count(*) AS digests, count(*) FILTER (held) AS present, count(*) FILTER (NOT held) AS missing, count(*) FILTER (NOT held AND m) AS missing_mapped,
    count(*) FILTER (NOT held AND NOT m AND dr) AS missing_drift, count(*) FILTER (NOT held AND NOT m AND NOT dr) AS missing_other FROM h)""")
def digest_coverage(spark, d):
    held = t(spark, d, "supplier").where("s_nationkey < 9").select(F.md5(text("s_suppkey")).alias("digest"))
    return parity.digest_coverage(left(spark, d), held, ["A"], ["N"], [])


NAMED = """, a AS (SELECT n_name AS namespace FROM nation JOIN customer ON c_nationkey = n_nationkey), b AS (SELECT n_name AS namespace FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE n_nationkey % 2 = 0)"""


def _namespaces(spark, d):
    nation = t(spark, d, "nation")
    a = nation.join(t(spark, d, "customer"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("namespace"))
    return a, nation.where("n_nationkey % 2 = 0").join(t(spark, d, "supplier"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("namespace"))


@query(NAMED + """ SELECT namespace, CASE WHEN namespace = 'NATION_2' THEN 'mapped' WHEN namespace = 'NATION_3' THEN 'expected_omit' WHEN namespace = 'NATION_5' THEN 'version_drift' ELSE 'unrecognized' END AS status, CASE WHEN namespace = 'NATION_2' THEN 'NATION_4' END AS target, count(*) AS n FROM a GROUP BY namespace
    UNION ALL SELECT namespace, 'right_only', NULL, count(*) FROM b WHERE namespace <> 'NATION_4' GROUP BY namespace""")
def namespace_classes(spark, d):
    a, b = _namespaces(spark, d)
    return parity.classify_namespaces(a, b, {"NATION_2": "NATION_4"}, ["NATION_3"], ["NATION_5"])


@query(NAMED + """, x AS (SELECT lower(namespace) AS canonical, bool_or(namespace = 'NATION_3') AS omit FROM a GROUP BY 1), y AS (SELECT DISTINCT lower(namespace) AS canonical FROM b)
    SELECT coalesce(x.canonical, y.canonical) AS canonical, CASE WHEN y.canonical IS NULL THEN 'left_only' WHEN x.canonical IS NULL THEN 'right_only' ELSE 'both' END AS status,
    CASE WHEN x.canonical IS NOT NULL AND y.canonical IS NOT NULL THEN 'compared name by name' WHEN y.canonical IS NULL AND omit THEN 'restates the digest, omitted by design' WHEN y.canonical IS NULL THEN 'not loaded by the build' ELSE 'not carried by the left side' END AS reason FROM x FULL JOIN y USING (canonical)""")
def namespace_correspondence(spark, d):
    a, b = _namespaces(spark, d)
    return parity.namespace_correspondence(a, b, F.lower("namespace"), ["NATION_3"])


@query(", m AS (SELECT DISTINCT l_suppkey::VARCHAR AS collection, l_partkey::VARCHAR AS digest, l_returnflag AS name FROM lineitem), p AS (SELECT DISTINCT l_suppkey::VARCHAR AS collection, l_linestatus AS path FROM lineitem) SELECT DISTINCT digest, name, path FROM m JOIN p USING (collection)")
def occurrence_index(spark, d):
    rows = t(spark, d, "lineitem").select(text("l_suppkey").alias("collection"), text("l_partkey").alias("digest"), F.col("l_returnflag").alias("name"), F.col("l_linestatus").alias("path"))
    return parity.occurrences(rows.select("collection", "digest", "name").distinct(), rows.select("collection", "path").distinct())


@query(", k AS (SELECT DISTINCT o_orderstatus AS namespace, o_custkey::VARCHAR AS alias FROM orders), w AS (SELECT n.namespace, c_custkey::VARCHAR AS alias FROM customer, (VALUES ('F'), ('O')) n(namespace)) SELECT * FROM w EXCEPT SELECT * FROM k")
def unresolved_accessions(spark, d):
    names = t(spark, d, "orders").select(F.col("o_orderstatus").alias("namespace"), text("o_custkey").alias("alias"))
    return parity.unresolved(t(spark, d, "customer").select(text("c_custkey").alias("alias")), ["F", "O"], names)


@query(", a AS (SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_linestatus = 'F' AND l_quantity < 12), b AS (SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_linestatus = 'O' AND l_quantity < 12), g AS (SELECT p_partkey AS key FROM part WHERE p_size < 20) SELECT key, CASE WHEN a.key IS NULL THEN 'added' WHEN b.key IS NULL THEN CASE WHEN g.key IS NULL THEN 'lost' ELSE 'removed' END WHEN g.key IS NOT NULL THEN 'still_present' ELSE 'kept' END AS outcome FROM a FULL JOIN b USING (key) LEFT JOIN g USING (key)".replace("SELECT key, CASE", "SELECT coalesce(a.key, b.key) AS key, CASE").replace("a FULL JOIN b USING (key) LEFT JOIN g USING (key)", "a FULL JOIN b ON a.key = b.key LEFT JOIN g ON g.key = coalesce(a.key, b.key)"))
def store_mutation(spark, d):
    keys = lambda s: t(spark, d, "lineitem").where((F.col("l_linestatus") == s) & (F.col("l_quantity") < 12)).select(F.col("l_partkey").alias("key"))
    return parity.mutation(keys("F"), keys("O"), t(spark, d, "part").where("p_size < 20").select(F.col("p_partkey").alias("key")))


@query(", x AS (SELECT year(o_orderdate)::INTEGER AS release, o_custkey AS alias, round(o_totalprice)::BIGINT AS length, o_orderkey AS digest FROM orders) SELECT alias, min(release) AS first, max(release) AS last, arg_max(digest, {'a': length, 'b': digest}) AS longest FROM x GROUP BY alias")
def first_last_release(spark, d):
    rows = t(spark, d, "orders").select(F.year("o_orderdate").alias("release"), F.col("o_custkey").alias("alias"), F.round("o_totalprice").cast("bigint").alias("length"), F.col("o_orderkey").alias("digest"))
    return parity.first_last(rows)


@query(", u AS (SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host FROM pages) SELECT page_id, host, CASE WHEN row_number() OVER (PARTITION BY host ORDER BY page_id) = 1 THEN 'discovered' ELSE 'skipped_duplicate_url' END AS status FROM u")
def url_dedup_flag(spark, d):
    host = F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1))
    return parity.flag_duplicates(t(spark, d, "pages").select("page_id", host.alias("host")), "host", "page_id")


@query("SELECT p_brand AS family, min(p_type) AS only FROM part GROUP BY p_brand HAVING min(p_type) = max(p_type) UNION ALL SELECT 'nation ' || s_nationkey, min(s_suppkey::VARCHAR) FROM supplier GROUP BY s_nationkey HAVING min(s_suppkey::VARCHAR) = max(s_suppkey::VARCHAR)")
def unpaired_kinds(spark, d):
    part = t(spark, d, "part").select(F.col("p_brand").alias("family"), F.col("p_type").alias("kind"))
    supplier = t(spark, d, "supplier").select(F.concat(F.lit("nation "), text("s_nationkey")).alias("family"), text("s_suppkey").alias("kind"))
    return parity.unpaired(part.union(supplier), "family", "kind")


@query(", x AS (SELECT p_type AS label, p_brand AS identity, min(p_name) AS anchor FROM part GROUP BY 1, 2), c AS (SELECT label, count(*) AS n FROM x GROUP BY 1) SELECT label, identity, CASE WHEN n > 1 THEN label || '_' || lower(regexp_replace(regexp_replace(anchor, '[^A-Za-z0-9]+', '_', 'g'), '^_|_$', '', 'g')) ELSE label END AS family FROM x JOIN c USING (label)")
def family_labels(spark, d):
    return parity.family_labels(t(spark, d, "part").select(F.col("p_type").alias("label"), F.col("p_brand").alias("identity"), F.col("p_name").alias("accession")))


@query("SELECT o_orderkey AS path, o_orderpriority AS kind, o_orderstatus AS owner, 'old' AS version FROM orders WHERE year(o_orderdate) < 1998 AND o_orderpriority <> '1-URGENT' UNION ALL SELECT o_orderkey, o_orderpriority, o_orderstatus, 'new' FROM orders WHERE year(o_orderdate) >= 1995 AND o_orderpriority = '1-URGENT'")
def scoped_merge(spark, d):
    rows = lambda rule, v: t(spark, d, "orders").where(rule).select(F.col("o_orderkey").alias("path"), F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("owner"), F.lit(v).alias("version"))
    every = t(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("owner"))
    return sync.merge_lock(rows("year(o_orderdate) < 1998", "old"), rows("year(o_orderdate) >= 1995 and o_orderpriority = '1-URGENT'", "new"), every)


@query(""", s AS (SELECT o_orderkey AS url, o_orderpriority AS kind, o_orderstatus AS owner, o_custkey % 3 AS checksum FROM orders WHERE o_orderkey % 5 > 0 AND o_orderpriority < '3'), k AS (SELECT o_orderkey AS url, o_orderpriority AS kind, o_orderstatus AS owner, o_custkey % 2 AS checksum FROM orders WHERE o_orderkey % 7 > 0),
    c AS (SELECT k.* FROM k WHERE (kind, owner) IN (SELECT (kind, owner) FROM s)) SELECT coalesce(s.url, c.url) AS url, CASE WHEN c.url IS NULL THEN 'new' WHEN s.url IS NULL THEN 'only_in_lock' WHEN s.checksum IS DISTINCT FROM c.checksum THEN 'upstream_changed' ELSE 'same' END AS status FROM s FULL JOIN c ON s.url = c.url""")
def sources_vs_lock(spark, d):
    rows = lambda rule, m: t(spark, d, "orders").where(rule).select(F.col("o_orderkey").alias("url"), F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("owner"), (F.col("o_custkey") % m).alias("checksum"))
    return sync.sources_vs_lock(rows("o_orderkey % 5 > 0 and o_orderpriority < '3'", 3), rows("o_orderkey % 7 > 0", 2))


@query("SELECT count(*) AS collections, count(*) FILTER (n > 1) AS shared, max(n) AS widest FROM (SELECT md5(text) AS c, count(DISTINCT source) AS n FROM documents GROUP BY 1)")
def multi_contributor_collections(spark, d):
    return sync.contributors(t(spark, d, "documents").select(F.md5("text").alias("collection"), F.col("source").alias("path")))


@query("SELECT digest, arg_min(doc_id, doc_id) AS source FROM (SELECT md5(text) AS digest, doc_id FROM documents) GROUP BY digest")
def content_dedup_first_seen(spark, d):
    rows = t(spark, d, "documents").select(F.md5("text").alias("digest"), F.col("doc_id").alias("source"))
    return parity.earliest(rows, "source")


@query("SELECT CASE WHEN strpos(url, 'ncbi') > 0 THEN 'ncbi' ELSE lower(split_part(split_part(url, '://', 2), '/', 1)) END AS provider, count(*) AS n FROM (SELECT split_part(url, '?', 1) AS url FROM pages) GROUP BY 1")
def provider_from_host(spark, d):
    url = F.split_part("url", F.lit("?"), F.lit(1))
    return t(spark, d, "pages").groupBy(F.lower(manifest.provider(url)).alias("provider")).agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_name FROM part WHERE p_name GLOB 'p*1?'")
def glob_match_sources(spark, d):
    return t(spark, d, "part").where(fn.glob_match(F.col("p_name"), "p*1?")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name AS digest, s.alias AS alias FROM (SELECT *, CASE WHEN p_size % 2 = 0 THEN 'LRG_' || p_partkey || 'g' ELSE 'LRG_' || p_partkey || 't1' END AS name FROM part), unnest(CASE WHEN p_size % 2 = 0 THEN [name, 'LRG_' || p_partkey] ELSE [name] END) AS s(alias)")
def alias_expansion(spark, d):
    name = F.concat(F.lit("LRG_"), text("p_partkey"), F.when(F.col("p_size") % 2 == 0, "g").otherwise("t1"))
    return t(spark, d, "part").select("p_partkey", F.col("p_name").alias("digest"), F.explode(fn.lrg_names(name)).alias("alias"))


@query("SELECT event_id, CASE WHEN b >= 1048576 THEN printf('%.1f MiB', b / 1048576.0) WHEN b >= 1024 THEN printf('%.1f KiB', b / 1024.0) ELSE b || ' B' END AS size FROM (SELECT event_id, event_id * 997 AS b FROM events WHERE event_id < 1000000)")
def human_sizes(spark, d):
    return t(spark, d, "events").where("event_id < 1000000").select("event_id", fn.human_bytes(F.col("event_id") * 997).alias("size"))


@query(""", e AS (SELECT *, 'left' AS side FROM l UNION ALL SELECT *, 'right' FROM r), g AS (SELECT digest, count(*) FILTER (side = 'left') AS nl, count(*) FILTER (side = 'right') AS nr,
    list_sort(list(DISTINCT namespace) FILTER (side = 'left')) AS ln, list_sort(list(DISTINCT alias) FILTER (side = 'left')) AS la, list_sort(list(DISTINCT namespace) FILTER (side = 'right')) AS rn, list_sort(list(DISTINCT alias) FILTER (side = 'right')) AS ra FROM e GROUP BY digest)
    SELECT digest, CASE WHEN nl > 0 AND nr > 0 THEN 'both' WHEN nl > 0 THEN 'left_only' ELSE 'right_only' END AS membership,
    coalesce(array_to_string(ln, ';'), '') AS left_namespaces, coalesce(array_to_string(la[1:8], ';') || CASE WHEN len(la) > 8 THEN ';+' || (len(la) - 8) ELSE '' END, '') AS left_aliases,
    coalesce(array_to_string(rn, ';'), '') AS right_namespaces, coalesce(array_to_string(ra[1:8], ';') || CASE WHEN len(ra) > 8 THEN ';+' || (len(ra) - 8) ELSE '' END, '') AS right_aliases FROM g""")
def digest_report(spark, d):
    return parity.digest_report(left(spark, d), right(spark, d))


@query("SELECT o_custkey AS digest, arg_min(o_orderkey, {'a': o_orderdate, 'b': o_orderkey}) AS source FROM orders GROUP BY o_custkey")
def earliest_source(spark, d):
    rows = t(spark, d, "orders").select(F.col("o_custkey").alias("digest"), "o_orderdate", F.col("o_orderkey").alias("source"))
    return parity.earliest(rows, "o_orderdate")


@query(""", f AS (SELECT o_custkey, min(date_trunc('month', o_orderdate)::DATE) AS m FROM orders GROUP BY 1), g AS (SELECT m, count(*) AS marginal FROM f GROUP BY m),
    s AS (SELECT date_trunc('month', o_orderdate)::DATE AS m, count(DISTINCT o_custkey) AS own FROM orders GROUP BY 1), c AS (SELECT m AS month, own, coalesce(marginal, 0) AS marginal, (sum(coalesce(marginal, 0)) OVER (ORDER BY m))::BIGINT AS cumulative, (sum(coalesce(marginal, 0)) OVER ())::BIGINT AS n FROM s LEFT JOIN g USING (m))
    SELECT month, own, marginal, cumulative, round(100.0::DOUBLE * cumulative / n, 4) AS cumulative_percent FROM c""")
def running_coverage(spark, d):
    rows = t(spark, d, "orders").select(F.trunc("o_orderdate", "month").alias("month"), "o_custkey")
    return parity.running_coverage(rows, "month", "o_custkey")


@query(""", n AS (SELECT release, lead(release) OVER (ORDER BY release) AS nxt FROM (SELECT DISTINCT release FROM rel))
    SELECT a.release AS "from", b.release AS "to", count(*) AS shared, count(*) FILTER (a.digest <> b.digest) AS changed FROM rel a JOIN n ON a.release = n.release JOIN rel b ON b.release = n.nxt AND a.alias = b.alias GROUP BY 1, 2""")
def release_drift(spark, d):
    return parity.drift(releases(spark, d))


@query(""", g AS (SELECT alias, list(digest ORDER BY release) AS ds FROM rel GROUP BY alias), f AS (SELECT alias, ds, list_transform(range(1, len(ds) + 1), lambda i: len(list_distinct(ds[1:list_position(ds, ds[i])]))) AS nums FROM g)
    SELECT alias, array_to_string(list_transform(nums, lambda n: CASE WHEN n <= 26 THEN substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', n::INT, 1) ELSE n::VARCHAR END), ' ') AS path FROM f""")
def digest_trajectory(spark, d):
    return parity.trajectory(releases(spark, d))


@query("""SELECT coalesce(f.path, k.path) AS path, CASE WHEN f.path IS NULL THEN 'removed' WHEN k.path IS NULL THEN 'added' WHEN f.sha256 <> k.sha256 OR f.spec_sha256 <> k.spec_sha256 THEN 'reingest' ELSE 'unchanged' END AS class,
    CASE WHEN f.path IS NULL OR k.path IS NULL THEN NULL WHEN f.sha256 <> k.sha256 THEN 'upstream bytes changed' WHEN f.spec_sha256 <> k.spec_sha256 THEN 'ingest spec changed' END AS reason FROM files f FULL JOIN lck k ON f.path = k.path""")
def sync_plan(spark, d):
    return sync.sync_plan(files(spark, d, "l_linestatus = 'O'"), files(spark, d, "l_returnflag <> 'R'"))


@query("SELECT coalesce(f.path, k.path) AS cache_path, CASE WHEN f.path IS NULL THEN 'only_in_lock' WHEN k.path IS NULL THEN 'new' WHEN f.sha256 = k.sha256 THEN 'matched' ELSE 'changed' END AS status FROM files f FULL JOIN lck k ON f.path = k.path")
def cache_vs_lock(spark, d):
    named = lambda rule: files(spark, d, rule).withColumnRenamed("path", "cache_path")
    return sync.cache_vs_lock(named("l_linestatus = 'O'"), named("l_returnflag <> 'R'"))


@query(", p AS (SELECT p_partkey::VARCHAR AS path FROM part WHERE p_size = 1), c AS (SELECT DISTINCT collection FROM src WHERE path IN (SELECT path FROM p)) SELECT path FROM src WHERE collection IN (SELECT collection FROM c) UNION SELECT path FROM p")
def reingest_closure(spark, d):
    return sync.closure(t(spark, d, "part").where("p_size = 1").select(text("p_partkey").alias("path")), sources_of(spark, d))


@query(", g AS (SELECT DISTINCT o_orderkey AS collection FROM orders WHERE o_orderdate < DATE '1998-01-01'), m AS (SELECT DISTINCT l_orderkey AS collection, l_partkey::VARCHAR || '/' || l_suppkey AS digest FROM lineitem) SELECT digest FROM m LEFT JOIN g USING (collection) GROUP BY digest HAVING bool_and(collection IN (SELECT collection FROM g))")
def orphans_after_removal(spark, d):
    members = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("collection"), F.concat_ws("/", "l_partkey", "l_suppkey").alias("digest")).distinct()
    removed = t(spark, d, "orders").where("o_orderdate < date '1998-01-01'").select(F.col("o_orderkey").alias("collection"))
    return sync.orphans_after(members.select("digest").distinct(), members, removed)


@query("""SELECT coalesce(a.c, b.c) AS subject, CASE WHEN b.c IS NULL THEN 'store.collection_missing' WHEN a.c IS NULL THEN 'store.collection_unrecorded' ELSE 'store.collection_size_mismatch' END AS code,
    CASE WHEN a.c IS NULL THEN 'warn' ELSE 'error' END AS severity, concat_ws('/', a.n::VARCHAR, b.n::VARCHAR) AS detail
    FROM (SELECT l_suppkey::VARCHAR AS c, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) a FULL JOIN (SELECT l_suppkey::VARCHAR AS c, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) b ON a.c = b.c WHERE a.n IS DISTINCT FROM b.n""")
def verify_membership(spark, d):
    counted = lambda s: t(spark, d, "lineitem").where(F.col("l_linestatus") == s).groupBy(text("l_suppkey").alias("collection")).agg(F.count("*").alias("n"))
    return verify.membership(counted("F"), counted("O"))


def _coherence(spark, d) -> DataFrame:
    digest = lambda table, c: t(spark, d, table).select(text(c).alias("digest"))
    return verify.coherence(digest("customer", "c_custkey"), digest("orders", "o_custkey"), digest("events", "user_id"))


COHERENCE = """, i AS (SELECT DISTINCT c_custkey::VARCHAR AS x FROM customer), dk AS (SELECT DISTINCT o_custkey::VARCHAR AS x FROM orders), rc AS (SELECT DISTINCT user_id::VARCHAR AS x FROM events),
    fnd AS (SELECT 'store.seq_file_missing' AS code, 'error' AS severity, x AS subject, '' AS detail FROM i WHERE x NOT IN (SELECT x FROM dk WHERE x IS NOT NULL)
    UNION ALL SELECT 'store.orphan_sequence', 'warn', x, '' FROM i WHERE x NOT IN (SELECT x FROM rc WHERE x IS NOT NULL) UNION ALL SELECT 'store.stray_seq_file', 'warn', x, '' FROM dk WHERE x NOT IN (SELECT x FROM i WHERE x IS NOT NULL))"""


@query(COHERENCE + " SELECT * FROM fnd")
def verify_coherence(spark, d):
    return _coherence(spark, d)


@query(COHERENCE + " SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY CASE severity WHEN 'error' THEN 0 ELSE 1 END, subject, detail)::INTEGER AS rank, count(*) OVER (PARTITION BY code) AS total FROM fnd) WHERE rank <= 20")
def capped_findings(spark, d):
    return verify.capped(_coherence(spark, d))


@query(COHERENCE + " SELECT severity, code, count(*) AS n FROM fnd GROUP BY ALL")
def finding_summary(spark, d):
    return verify.summary(_coherence(spark, d))


@query(""", b AS (SELECT p_partkey::VARCHAR AS digest, p_brand AS cause FROM part WHERE p_size > 25), x AS (SELECT p_partkey::VARCHAR AS digest, CASE WHEN p_retailprice < 1000 THEN NULL WHEN p_size % 2 = 0 THEN p_name ELSE p_partkey::VARCHAR END AS redigest FROM part),
    j AS (SELECT x.*, cause FROM x LEFT JOIN b USING (digest)), c AS (SELECT digest AS subject, coalesce(cause, '') AS detail, CASE WHEN redigest IS NULL THEN 'store.sequence_unreadable' WHEN digest <> redigest THEN 'store.seq_digest_mismatch' WHEN cause IS NOT NULL THEN 'store.seq_digest_fixed' END AS code,
    CASE WHEN redigest IS NULL THEN 'error' WHEN digest <> redigest AND cause IS NOT NULL THEN 'warn' WHEN digest <> redigest THEN 'error' ELSE 'info' END AS severity FROM j) SELECT code, severity, subject, detail FROM c WHERE code IS NOT NULL""")
def verify_redigest(spark, d):
    part = t(spark, d, "part")
    redigest = F.when(F.col("p_retailprice") < 1000, None).when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(text("p_partkey"))
    return verify.redigest(part.select(text("p_partkey").alias("digest"), redigest.alias("redigest")), part.where("p_size > 25").select(text("p_partkey").alias("digest"), F.col("p_brand").alias("cause")))


@query(""", m AS (SELECT DISTINCT l_partkey::VARCHAR AS digest, l_suppkey::VARCHAR AS collection FROM lineitem), mp AS (SELECT DISTINCT m.collection FROM part p JOIN m ON m.digest = p.p_partkey::VARCHAR WHERE p.p_size = 1)
    SELECT 'reingest' AS action, s.path, 'supplier/' || s.path AS owner, 'store.seq_file_missing' AS codes FROM src s WHERE s.collection IN (SELECT collection FROM mp) GROUP BY s.path
    UNION ALL SELECT 'refetch', p_partkey::VARCHAR, 'supplier/' || p_partkey, 'cache.missing' FROM part WHERE p_size = 2""")
def repair_plan(spark, d):
    part, src = t(spark, d, "part"), sources_of(spark, d)
    f = lambda code, rule: verify.finding(part.where(rule), code, "error", "p_partkey")
    members = src.withColumnRenamed("path", "digest")
    lock = part.select(text("p_partkey").alias("path"), F.lit("supplier").alias("kind"), text("p_partkey").alias("owner"))
    plan = verify.repair_plan(verify.union(f("store.seq_file_missing", "p_size = 1"), f("cache.missing", "p_size = 2")), members, src, lock)
    return plan.withColumn("codes", F.array_join("codes", ","))


@query("""SELECT alias, regexp_replace(alias, '\\.[0-9]+$', '') AS base, split_part(alias, '.', 2)::BIGINT AS version, 'P_1' AS tag,
    CASE WHEN substr(alias, 3, 1) = '_' THEN substr(alias, 1, 3) WHEN regexp_full_match(substr(alias, 1, 4), '[A-Za-z]{4}') THEN substr(alias, 1, 4) ELSE substr(alias, 1, 3) END AS prefix FROM l""")
def accession_functions(spark, d):
    a = F.col("alias")
    return left(spark, d).select("alias", fn.version_base(a).alias("base"), fn.version_number(a).alias("version"), F.lit("P_1").alias("tag"), fn.accession_prefix(a).alias("prefix"))


@query("""SELECT p_partkey, reverse(translate(s, 'ACGTUMRWSYKVHDBNacgtumrwsykvhdbn', 'TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn')) AS reverse_complement,
    CASE WHEN regexp_full_match(s, '[ACGT]*') THEN 'dna2bit' WHEN regexp_full_match(s, '[ACGTNRY]*') THEN 'dna3bit' WHEN regexp_full_match(s, '[ACGTNRYSWKMBDHVU]*') THEN 'dnaio' WHEN regexp_full_match(s, '[ACDEFGHIKLMNPQRSTVWYXBZJ*-]*') THEN 'protein' ELSE 'ASCII' END AS alphabet,
    length(s) AS length, length(replace(s, 'N', '')) AS "real", (length(s) - length(ltrim(s, 'N')) + 1) AS span_start, length(rtrim(s, 'N')) AS span_end
    FROM (SELECT p_partkey, upper(replace(p_type, ' ', '')) AS s FROM part)""")
def residue_functions(spark, d):
    rows = t(spark, d, "part").select("p_partkey", F.upper(F.replace("p_type", F.lit(" "), F.lit(""))).alias("s"))
    s = F.col("s")
    return rows.select("p_partkey", fn.reverse_complement(s).alias("reverse_complement"), fn.alphabet_of(s).alias("alphabet"), *(c.alias(n) for n, c in fn.padding(s).items()))


@query(""", p AS (SELECT p_name AS a, p_type AS b FROM part), x AS (SELECT substr(a, i::INT, 1) || '>' || substr(b, i::INT, 1) AS change FROM p, unnest(range(1, least(length(a), length(b)) + 1)) AS u(i) WHERE substr(a, i::INT, 1) <> substr(b, i::INT, 1)) SELECT change, count(*) AS n FROM x GROUP BY change""")
def substitution_histogram(spark, d):
    rows = t(spark, d, "part").select(F.explode(fn.substitutions(F.col("p_name"), F.col("p_type"))).alias("s"))
    return rows.groupBy(F.col("s.change").alias("change")).agg(F.count("*").alias("n"))


@query("SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) || '/' || ltrim(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/') AS cache_path FROM pages")
def cache_paths(spark, d):
    return t(spark, d, "pages").select("page_id", fn.url_cache_path(F.col("url")).alias("cache_path"))


@query("""SELECT DISTINCT n_name, lower(regexp_replace(n_name, '[^A-Za-z0-9]+', '_', 'g')) AS slug, 'nation' AS folded FROM nation""")
def label_functions(spark, d):
    return t(spark, d, "nation").select("n_name", fn.slug(F.col("n_name")).alias("slug"), fn.fold_release(F.concat(F.lit("nation-"), text("n_nationkey"))).alias("folded")).distinct()


@query("SELECT p_brand, row_number() OVER (ORDER BY regexp_extract(p_brand, '[^0-9]+'), regexp_extract(p_brand, '[0-9]+')::INT)::INTEGER AS place FROM (SELECT DISTINCT p_brand FROM part)")
def natural_order(spark, d):
    from pyspark.sql import Window

    brands = t(spark, d, "part").select("p_brand").distinct()
    return brands.select("p_brand", F.row_number().over(Window.orderBy(fn.natural_key(F.col("p_brand")))).alias("place"))


@query(""", rep AS (SELECT s_name AS seq, CASE WHEN s_nationkey % 5 = 0 THEN 'na' ELSE 'GB_' || s_suppkey END AS gb, CASE WHEN s_nationkey % 7 = 0 THEN ' NA ' ELSE 'RS_' || s_suppkey END AS rs, NULL::VARCHAR AS ucsc FROM supplier),
    k AS (SELECT * FROM rep WHERE lower(trim(rs)) <> 'na') SELECT rs AS refseq, 'asm' AS namespace, seq AS alias FROM k UNION SELECT rs, 'asm', gb FROM k WHERE gb <> 'na' UNION SELECT rs, 'insdc', gb FROM k WHERE gb <> 'na' UNION SELECT rs, 'refseq', rs FROM k""")
def report_aliases(spark, d):
    s = t(spark, d, "supplier")
    rows = s.select(
        F.col("s_name").alias("Sequence-Name"),
        F.lit(None).cast("string").alias("UCSC-style-name"),
        F.when(F.col("s_nationkey") % 5 == 0, "na").otherwise(F.concat(F.lit("GB_"), text("s_suppkey"))).alias("GenBank-Accn"),
        F.when(F.col("s_nationkey") % 7 == 0, " NA ").otherwise(F.concat(F.lit("RS_"), text("s_suppkey"))).alias("RefSeq-Accn"),
    )
    return aliases.report_aliases(rows, "asm")


@query("SELECT l.namespace, l.alias, l.digest, CASE WHEN r.digest IS NULL THEN 'new' WHEN r.digest = l.digest THEN 'same' ELSE 'conflict' END AS outcome FROM l LEFT JOIN r USING (namespace, alias)")
def alias_load(spark, d):
    return aliases.classify_load(left(spark, d), right(spark, d))


@query("SELECT namespace, alias, digest, 'added' AS change FROM (SELECT * FROM l EXCEPT SELECT * FROM r) UNION ALL SELECT namespace, alias, digest, 'removed' FROM (SELECT * FROM r WHERE namespace IN (SELECT namespace FROM l) EXCEPT SELECT * FROM l)")
def namespace_reconcile(spark, d):
    return aliases.reconcile(left(spark, d), right(spark, d))


@query(", b AS (SELECT o_orderpriority AS namespace, o_custkey::VARCHAR AS alias, o_orderstatus AS digest, o_orderdate, o_orderkey FROM orders) SELECT namespace, alias, digest, o_orderkey AS row_ord, CASE WHEN row_number() OVER w = 1 THEN 'added' WHEN digest = first_value(digest) OVER w THEN 'skipped' ELSE 'conflict' END AS outcome FROM b WINDOW w AS (PARTITION BY namespace, alias ORDER BY o_orderdate, o_orderkey)")
def first_seen_aliases(spark, d):
    rows = t(spark, d, "orders").select(F.col("o_orderdate").alias("report_ord"), F.col("o_orderkey").alias("row_ord"), F.col("o_orderpriority").alias("namespace"), text("o_custkey").alias("alias"), F.col("o_orderstatus").alias("digest"))
    return aliases.first_seen(rows).select("namespace", "alias", "digest", "row_ord", "outcome")


@query("SELECT 'lines-' || release AS namespace, alias, digest FROM rel UNION SELECT 'lines', alias, digest FROM rel WHERE release = (SELECT max(release) FROM rel)")
def release_groups(spark, d):
    return aliases.release_groups(releases(spark, d).withColumn("group", F.lit("lines")))


@query("SELECT l_returnflag AS key, sum(l_quantity)::DOUBLE AS total, round(100 * sum(l_quantity)::DOUBLE / (SELECT sum(l_quantity)::DOUBLE FROM lineitem), 4) AS percent, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def size_by_class(spark, d):
    from pyspark.sql import Window

    rows = t(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("key")).agg(F.sum(F.col("l_quantity").cast("double")).alias("total"), F.count_distinct("l_partkey").alias("parts"))
    every = Window.partitionBy()
    return rows.select("key", "total", F.round(100 * F.col("total") / F.sum("total").over(every), 4).alias("percent"), "parts")


@query("SELECT p_type, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, p_type LIMIT 8")
def top_breakdown(spark, d):
    return agg.breakdown(t(spark, d, "part"), "p_type", top=8)


@query("SELECT p_name AS record_name, length(p_type) AS residues FROM part WHERE (starts_with(p_name, 'a') OR starts_with(p_name, 'b') OR starts_with(p_name, 'Part')) AND p_brand IN ('Brand#11', 'Brand#12', 'Brand#1', 'Brand#2')")
def exclusion_audit(spark, d):
    rows = t(spark, d, "part").select(F.col("p_name").alias("name"), F.col("p_type").alias("residues"), F.col("p_brand").alias("file_class"))
    return exclusion.split(rows, ["a", "b", "Part"], ["Brand#11", "Brand#12", "Brand#1", "Brand#2"])[1]


@query("SELECT url, min(page_id) AS page_id FROM pages GROUP BY url")
def first_discovered_url(spark, d):
    return parity.precedence(t(spark, d, "pages").select("url", "page_id"), ["url"], ["page_id"])


@query("SELECT DISTINCT collection FROM src WHERE path IN (SELECT p_partkey::VARCHAR FROM part WHERE p_size = 3)")
def publishers(spark, d):
    members = sources_of(spark, d).withColumnRenamed("path", "digest")
    return sync.publishers(members, t(spark, d, "part").where("p_size = 3").select(text("p_partkey").alias("digest")))


@query("SELECT namespace, alias, count(DISTINCT digest) AS n FROM (SELECT * FROM l UNION ALL SELECT * FROM r) GROUP BY ALL HAVING count(DISTINCT digest) > 1")
def alias_conflicts(spark, d):
    return aliases.conflicts(left(spark, d).unionByName(right(spark, d)))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL")
def event_windows(spark, d):
    return stream.windowed(t(spark, d, "events"))


@query()
def sequence_digests(spark, d):
    """Content addresses (SHA-512 has no DuckDB function)."""
    rows = t(spark, d, "part").select(F.upper("p_type").alias("residues"))
    return rows.distinct().select("residues", fn.sha512t24u(F.col("residues")).alias("digest"))
