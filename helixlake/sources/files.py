"""Scans of the file formats that sources come in. Records are split by Spark's text reader, not by a driver loop."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixlake.functions.scalars import gzip_ok, na_to_null, relative_path

RECORDS = "file string, ordinal long, name string, residues string"


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, name, residues): the name is the header's first word; residues are upper-cased, without white space."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", r"\A>", "").alias("r"))
    head = F.substring_index("r", "\n", 1)
    body = F.when(F.col("r").contains("\n"), F.expr("substring(r, instr(r, '\n') + 1)")).otherwise("")
    return raw.where(F.trim("r") != "").select("file", "at", F.regexp_extract(head, r"\A\s*(\S*)", 1).alias("name"), F.upper(F.regexp_replace(body, r"\s+", "")).alias("residues"))


def fasta_names(spark: SparkSession, path: str) -> DataFrame:
    """Only the names: residue lines are dropped as they are read."""
    lines = spark.read.text(path).where(F.col("value").startswith(">"))
    return lines.select(F.regexp_extract("value", r"\A>\s*(\S*)", 1).alias("name"))


def genbank(spark: SparkSession, path: str) -> DataFrame:
    """(file, name, residues) of flat-file records that have both a VERSION and an ORIGIN. A line ``//`` ends a record."""
    raw = spark.read.option("lineSep", "\n//").text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    name = F.regexp_extract("value", r"(?m)^VERSION\s+(\S+)", 1)
    body = F.regexp_extract("value", r"(?ms)^ORIGIN[^\n]*\n(.*)\z", 1)
    out = raw.select("file", name.alias("name"), F.regexp_replace(body, r"(?s)[^A-Za-z]+", "").alias("residues"))
    return out.where("name <> '' and residues <> ''")


def lrg_zip(spark: SparkSession, path: str) -> DataFrame:
    """Records of LRG bundles, members in natural order. A file is one task: a zip has no other split."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"]):
                bundle, rows, loci = zipfile.ZipFile(io.BytesIO(content)), [], set()
                members = sorted((m for m in bundle.namelist() if not m.endswith("/")), key=lambda m: [int(x) if x.isdigit() else x.casefold() for x in re.split(r"(\d+)", m.rpartition("/")[2])])
                if not members:
                    raise ValueError(f"{file}: the bundle is empty")
                for m in members:
                    if not (got := re.fullmatch(r"(?:.*/)?(LRG_\d+)\.fasta", m)):
                        raise ValueError(f"{file}: unexpected member {m}")
                    if got[1] in loci:
                        raise ValueError(f"{file}: {got[1]} is there twice")
                    loci.add(got[1])
                    records = [r for r in re.split(r"(?m)^>", bundle.read(m).decode()) if r.strip()]
                    if len(records) < 2 or records[0].split(None, 1)[0] != got[1] + "g":
                        raise ValueError(f"{file}: {m} does not begin with a genomic record and go on with others")
                    for r in records:
                        head, _, body = r.partition("\n")
                        rows.append((file, len(rows), head.split()[0], re.sub(r"\s+", "", body).upper()))
                yield pd.DataFrame(rows, columns=["file", "ordinal", "name", "residues"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, RECORDS)


READERS = {"fasta": fasta, "gbff": genbank, "lrg_zip": lrg_zip}


def records(spark: SparkSession, path: str, kind: str = "fasta") -> DataFrame:
    if kind not in READERS:
        raise ValueError(f"unknown format {kind!r}; there are {', '.join(READERS)}")
    return READERS[kind](spark, path)


def rejected(df: DataFrame, what: str) -> None:
    """Raise for the first of the rows that a strict parser rejects."""
    if bad := df.limit(3).collect():
        raise ValueError(f"{what}: {[r[0] for r in bad]}")


def md5_manifest(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(checksum, name). Strict: every line must be a record of a plain, new name. Lenient: nested paths are skipped."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    got = lines.select("value", *(F.regexp_extract("value", r"\A([0-9a-fA-F]{32})[ \t]+(.+?)\s*\z", i).alias(n) for i, n in ((1, "checksum"), (2, "name"))))
    if strict:
        rejected(got.where(~F.col("name").rlike(r"\A[A-Za-z0-9_][A-Za-z0-9_.+-]*\z")), "not a checksum record")
        rejected(got.groupBy("name").count().where("count > 1"), "listed twice")
        return got.select(F.lower("checksum").alias("checksum"), "name")
    got = got.where("name <> ''").select(F.lower("checksum").alias("checksum"), F.regexp_replace("name", r"\A(\*|\./)+", "").alias("name")).where("name not like '%/%'").distinct()
    rejected(got.groupBy("name").count().where("count > 1"), "listed with different checksums")
    return got


def bsd_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(checksum in five digits, blocks, name)."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    part = lambda i: F.regexp_extract("value", r"\A\s*(\d{1,5})\s+(\d+)\s+(\S+)\s*\z", i)
    rejected(lines.where(part(3) == ""), "not a checksum record")
    return lines.select(F.lpad(part(1), 5, "0").alias("checksum"), part(2).cast("int").alias("blocks"), part(3).alias("name"))


def assembly_report(spark: SparkSession, path: str) -> tuple[dict[str, str], DataFrame]:
    """Header keys, and the rows under the last ``#`` line that names the columns; rows of another width are dropped."""
    lines = spark.read.text(path)
    heads = [r.value for r in lines.where("value like '#%'").collect()]  # a report's head has some tens of lines
    meta = {k.strip(): v.strip() for k, _, v in (h.lstrip("# ").partition(":") for h in heads) if v}
    columns = [h.lstrip("# ").rstrip("\r\n").split("\t") for h in heads if "Sequence-Name" in h]
    if not columns:
        raise ValueError(f"{path}: no line names the columns")
    parts = lines.where("value not like '#%' and trim(value) <> ''").select(F.split(F.regexp_replace("value", "\r$", ""), "\t").alias("p"))
    rows = parts.where(F.size("p") == len(columns[-1])).select(*(na_to_null(F.col("p")[i]).alias(c) for i, c in enumerate(columns[-1])))
    return meta, rows


def tsv_table(spark: SparkSession, path: str) -> DataFrame:
    """TSV with a header row and ``#`` comments; empty and ``na`` values are null."""
    df = spark.read.csv(path, sep="\t", header=True, comment="#")
    return df.select(*(na_to_null(F.col(f"`{c}`")).alias(c) for c in df.columns))


def summary_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Columns by name from a TSV whose header is the last ``#`` line; added columns do no harm."""
    lines = spark.read.text(path)
    header = [r.value.lstrip("# ").split("\t") for r in lines.where("value like '#%'").collect()][-1]
    parts = lines.where("value not like '#%'").select(F.split("value", "\t").alias("p"))
    return parts.select(*(na_to_null(F.get("p", F.lit(header.index(c)))).alias(c) for c in columns))


def build_log(spark: SparkSession, path: str) -> DataFrame:
    """(collection, n_sequences, file) of each ``Added`` line of a build's log."""
    from helixlake.functions.scalars import strip_derived_suffix

    part = lambda i: F.regexp_extract("value", r"^Added (\S+) \((\d+) seqs\) from (.*) in ", i)
    return spark.read.text(path).where(part(1) != "").select(part(1).alias("collection"), part(2).cast("long").alias("n_sequences"), strip_derived_suffix(part(3)).alias("file"))


def subset(records: DataFrame, wanted: DataFrame) -> DataFrame:
    """Records of the names in ``wanted`` (name)."""
    return records.join(wanted.select("name").distinct(), "name", "left_semi")


def newest_reports(rows: DataFrame) -> DataFrame:
    """Rows (patch, name, ...) of several reports of one assembly: of each name, the statement of the newest patch."""
    rest = [c for c in rows.columns if c not in ("name", "patch")]
    return rows.groupBy("name").agg(F.max_by(F.struct("patch", *rest), "patch").alias("x")).select("name", "x.*")


def placements(spark: SparkSession, path: str) -> DataFrame:
    """Placement files (TSV with a ``#`` header): of each ``alt_scaf_acc``, the row of the last file by name."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    header = [r.value.lstrip("#").split("\t") for r in lines.where("value like '#%'").limit(1).collect()]
    if not header:
        raise ValueError(f"{path}: no line names the columns")
    parts = lines.where("value not like '#%' and trim(value) <> ''").select("file", F.split("value", "\t").alias("p")).where(F.size("p") == len(header[0]))
    rows = parts.select("file", *(na_to_null(F.col("p")[i]).alias(c) for i, c in enumerate(header[0])))
    return rows.groupBy("alt_scaf_acc").agg(F.max_by(F.struct(*header[0]), "file").alias("x")).select("x.*")


def optional_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """:func:`tsv_table`, or an empty table of ``schema`` where there is no file."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return tsv_table(spark, path)


def file_records(spark: SparkSession, path: str) -> DataFrame:
    """(cache_path, bytes, sha256, md5, gzip_ok) of the files under ``path``; gzip_ok is null for other files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    checked = F.when(F.col("path").endswith(".gz"), gzip_ok("content"))
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString()
    return files.select(relative_path(F.col("path"), root).alias("cache_path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"), checked.alias("gzip_ok"))


def write_tsv(df: DataFrame, path: str) -> None:
    """A TSV folder with a header; null is the empty value."""
    df.write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="", emptyValue="")
