"""The source manifest (TOML): validation, expansion to files, and resolution against checksum lists."""

from __future__ import annotations

import tomllib
from collections import defaultdict
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixlake.functions.scalars import glob_match, natural_key

FORMATS = ("fasta", "gbff", "lrg_zip")
SOURCE = "kind string, owner string, url string, file_class string, checksum_url string, shard int"
#: The file classes of an Ensembl release.
RELEASE_CLASSES = {"ensembl": {"dna.toplevel", "cdna", "ncrna", "pep"}}


@dataclass
class Assembly:
    namespace: str
    report_url: str
    fasta_url: str | None = None
    load_fasta: bool = True
    fasta_path: str | None = None
    checksum_manifest_url: str | None = None

    def __post_init__(self):
        if self.load_fasta and not self.fasta_url:
            raise ValueError(f"{self.namespace}: load_fasta needs fasta_url")


def _folder(url: str) -> tuple[str, str, str]:
    parts = urlsplit(url)
    return parts.scheme, parts.netloc, parts.path.rpartition("/")[0]


@dataclass
class Seqset:
    name: str
    namespace: str
    url_template: str | None = None
    shard_range: list[int] | None = None
    urls: list[str] | None = None
    url_pattern: str | None = None
    checksum_manifest_url: str | None = None
    checksum_manifest_urls: list[str] | None = None
    md5_manifest_urls: list[str] | None = None
    file_class: str | None = None
    file_classes: list[str] | None = None
    release: int | None = None
    rolling_namespace: str | None = None
    format: str = "fasta"
    exclude: dict | None = None

    def classes(self) -> list[str]:
        return list(self.file_classes or ([self.file_class] if self.file_class else []))

    def faults(self) -> list[str]:
        """What is wrong with the entry, as a table of (wrong, message)."""
        n = len(self.urls) if self.urls is not None else 1
        lists = {"checksum_manifest_urls": self.checksum_manifest_urls, "md5_manifest_urls": self.md5_manifest_urls}
        given = [k for k, v in lists.items() if v is not None]
        pattern, listing = self.url_pattern, self.checksum_manifest_url
        table = [
            (sum(x is not None for x in (self.url_template, self.urls, pattern)) != 1, "give one of url_template, urls and url_pattern"),
            (self.shard_range is not None and self.url_template is None, "shard_range goes with url_template"),
            (self.shard_range is not None and (len(self.shard_range) != 2 or self.shard_range[0] > self.shard_range[1]), "shard_range is [first, last]"),
            ((pattern is None) != (listing is None), "url_pattern and checksum_manifest_url go together"),
            (any(lists[k] is not None and (self.urls is None or len(lists[k]) != n) for k in lists), "a list of checksum manifests needs as many urls"),
            (len(given) + (listing is not None) > 1, "give one kind of checksum manifest"),
            (self.file_class is not None and self.file_classes is not None, "give one of file_class and file_classes"),
            (self.file_classes is not None and len(self.file_classes) != n, "as many file_classes as urls"),
            ((self.release is None) != (self.rolling_namespace is None), "release and rolling_namespace go together"),
            (self.release is not None and self.namespace != f"{self.rolling_namespace}-{self.release}", "the namespace of a release is <rolling_namespace>-<release>"),
            (self.format not in FORMATS, f"format is one of {', '.join(FORMATS)}"),
        ]
        if pattern is not None and listing is not None:
            table += [
                (not (pattern.startswith("https://") and listing.startswith("https://")), "patterns and their checksum manifest need https"),
                (not any(c in pattern.rpartition("/")[2] for c in "*?["), "the last part of url_pattern needs a glob"),
                (_folder(pattern) != _folder(listing), "the checksum manifest lies in another directory"),
            ]
        return [message for wrong, message in table if wrong] + self.exclusion_faults()

    def exclusion_faults(self) -> list[str]:
        if self.exclude is None:
            return []
        if not isinstance(self.exclude, dict):
            return ["exclude is a table"]
        chosen = self.exclude.get("file_classes") or []
        return [
            *(f"exclude has no key {k}" for k in sorted(set(self.exclude) - {"file_classes", "record_prefixes"})),
            *(f"exclude needs {k}" for k in ("file_classes", "record_prefixes") if not self.exclude.get(k)),
            *(f"exclude names {c}, which is no file class of this seqset" for c in chosen if c not in self.classes()),
        ]

    def __post_init__(self):
        if faults := self.faults():
            raise ValueError(f"{self.name}: {'; '.join(faults)}")


def load(path: str) -> tuple[list[Assembly], list[Seqset]]:
    """Entries of a manifest. A relative fasta_path is one below the manifest's own folder."""
    raw = tomllib.loads(Path(path).read_text())
    assemblies, seqsets = [Assembly(**x) for x in raw.get("assembly", [])], [Seqset(**x) for x in raw.get("seqset", [])]
    for a in assemblies:
        if a.fasta_path and not Path(a.fasta_path).is_absolute():
            a.fasta_path = str(Path(path).resolve().parent / a.fasta_path)
    names = [s.name for s in seqsets]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"seqsets share a name: {', '.join(twice)}")
    groups: dict[tuple[str, int], list[str]] = defaultdict(list)
    for s in seqsets:
        if s.release is not None:
            groups[s.rolling_namespace, s.release] += s.classes()
    for (group, release), classes in groups.items():
        due = RELEASE_CLASSES.get(group, set(classes))
        if len(classes) != len(set(classes)) or set(classes) != due:
            raise ValueError(f"{group} release {release}: file classes {sorted(classes)}, expected {sorted(due)}")
    return assemblies, seqsets


def expand(spark: SparkSession, assemblies: list[Assembly], seqsets: list[Seqset]) -> DataFrame:
    """One row per file or pattern. Shard ranges are expanded by Spark."""
    rows = [("assembly", a.namespace, a.report_url, "report", a.checksum_manifest_url, None, None) for a in assemblies]
    rows += [("assembly", a.namespace, a.fasta_url, "fasta", a.checksum_manifest_url, None, None) for a in assemblies if a.load_fasta]
    for s in seqsets:
        lists = s.checksum_manifest_urls or s.md5_manifest_urls or []
        for i, u in enumerate(s.urls or [s.url_template or s.url_pattern]):
            own = s.file_classes[i] if s.file_classes else s.file_class
            rows.append(("seqset", s.name, u, own, lists[i] if lists else s.checksum_manifest_url, *(s.shard_range or (None, None))))
    df = spark.createDataFrame(rows, "kind string, owner string, url string, file_class string, checksum_url string, lo int, hi int")
    df = df.select("*", F.explode_outer(F.when(F.col("lo").isNotNull(), F.sequence("lo", "hi"))).alias("shard"))
    url = F.when(F.col("shard").isNotNull(), F.replace("url", F.lit("{shard}"), F.col("shard").cast("string"))).otherwise(F.col("url"))
    return df.select("kind", "owner", url.alias("url"), "file_class", "checksum_url", "shard")


def _glob(name: Column) -> Column:
    """A glob of ``*``, ``?`` and ``[...]`` as a regular expression; other characters stand for themselves."""
    quoted = F.regexp_replace(name, r"([.+(){}|^$\\])", r"\\$1")
    return F.concat(F.lit(r"\A"), F.replace(F.regexp_replace(F.regexp_replace(quoted, r"\*", ".*"), r"\?", "."), F.lit("[!"), F.lit("[^")), F.lit(r"\z"))


def resolve(sources: DataFrame, listing: DataFrame) -> DataFrame:
    """Sources with provider checksums, and their place in the natural order of names. ``listing`` has (checksum_url,
    name, checksum); a pattern gives a row per match. A source's own file class stays."""
    base = F.substring_index("url", "/", -1)
    is_glob = base.rlike(r"[*?\[]")
    listed = listing.withColumnsRenamed({"checksum_url": "_list", "name": "_name"})
    at = F.col("checksum_url") == F.col("_list")
    plain = sources.where(~is_glob).join(listed, at & (base == F.col("_name")), "left").drop("_list", "_name")
    globs = sources.where(is_glob).join(listed, at).withColumn("_glob", _glob(base)).where(F.expr("_name rlike _glob"))
    folder = F.expr("substring(url, 1, length(url) - length(substring_index(url, '/', -1)))")
    globs = globs.withColumn("url", F.concat(folder, F.col("_name"))).drop("_list", "_name", "_glob")
    return plain.unionByName(globs).withColumn("natural", natural_key(F.substring_index("url", "/", -1)))


def duplicate_urls(sources: DataFrame) -> DataFrame:
    return sources.groupBy("url").agg(F.count("*").alias("n")).where("n > 1")


def provider(url: Column) -> Column:
    """ncbi, ensembl or lrg by the URL's host; any other host as it is."""
    host = F.parse_url(url, F.lit("HOST"))
    out = host
    for name in ("lrg", "ensembl", "ncbi"):
        out = F.when(host.contains(name), name).otherwise(out)
    return out


def release_of(owner_or_url: Column) -> Column:
    """The release number that a name or URL carries (``release-110``, ``ensembl_release_76``), null without one."""
    return F.regexp_extract(owner_or_url, r"release[-_](\d+)", 1).try_cast("int")


def unsized_total(sizes: DataFrame, budget: int) -> DataFrame:
    """One row over (url, bytes; null: unknown): sized, unsized, the bytes, and whether all are known and fit."""
    out = sizes.agg(F.count("bytes").alias("sized"), F.count_if(F.col("bytes").isNull()).alias("unsized"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    return out.withColumn("fits", (F.col("unsized") == 0) & (F.col("bytes") <= budget))


__all__ = ["Assembly", "Seqset", "duplicate_urls", "expand", "glob_match", "load", "provider", "release_of", "resolve", "unsized_total"]
