"""Scalar functions as Column expressions: digests, names, paths and residues. All run in the JVM."""

from __future__ import annotations

import fnmatch

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

#: IUPAC bases and their complements, in either case.
BASES, COMPLEMENTS = "ACGTUMRWSYKVHDBNacgtumrwsykvhdbn", "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn"
#: Alphabets from the least to the most general, as the characters that they allow.
ALPHABETS = [("dna2bit", "ACGT"), ("dna3bit", "ACGTNRY"), ("dnaio", "ACGTNRYSWKMBDHVU"), ("protein", "ACDEFGHIKLMNPQRSTVWYXBZJ*-")]


def sha512t24u(residues: Column) -> Column:
    """First 24 bytes of SHA-512 as base64url: the content address of a sequence."""
    return F.translate(F.base64(F.substring(F.unhex(F.sha2(residues, 512)), 1, 24)), "+/", "-_")


def strip_sq(digest: Column) -> Column:
    return F.regexp_replace(digest, r"^SQ\.", "")


def is_na(value: Column) -> Column:
    return value.isNull() | F.lower(F.trim(value)).isin("na", "")


def na_to_null(value: Column) -> Column:
    return F.when(~is_na(value), value)


def version_base(name: Column) -> Column:
    """The name without a final ``.digits``; unversioned names as they are."""
    return F.when(name.rlike(r"(?s)\A.*\.[0-9]+\z"), F.regexp_extract(name, r"(?s)\A(.*)\.[0-9]+\z", 1)).otherwise(name)


def version_number(name: Column) -> Column:
    return F.when(name.rlike(r"(?s)\A.*\.[0-9]+\z"), F.regexp_extract(name, r"(?s)\.([0-9]+)\z", 1)).try_cast("bigint")


def accession_prefix(name: Column) -> Column:
    """``XY_`` for underscore accessions, four letters if there are four, else three characters."""
    four = F.substring(name, 1, 4)
    return F.when(F.substring(name, 3, 1) == "_", F.substring(name, 1, 3)).when(four.rlike(r"\A[A-Za-z]{4}\z"), four).otherwise(F.substring(name, 1, 3))


def reverse_complement(residues: Column) -> Column:
    return F.reverse(F.translate(residues, BASES, COMPLEMENTS))


def alphabet_of(residues: Column) -> Column:
    """The least general alphabet that has every character."""
    out = F.lit("ASCII")
    for name, allowed in reversed(ALPHABETS):
        escaped = allowed.replace("-", r"\-").replace("*", r"\*")
        out = F.when(residues.rlike(rf"\A[{escaped}]*\z"), name).otherwise(out)
    return out


def url_cache_path(url: Column) -> Column:
    """``host/path`` of a URL, without its query."""
    return F.concat(F.parse_url(url, F.lit("AUTHORITY")), F.lit("/"), F.ltrim(F.parse_url(url, F.lit("PATH")), F.lit("/")))


def tidy_path(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, "/{2,}", "/"), r"(?<=.)/\z", "")


def slug(label: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(label), "[^a-z0-9]+", "_"), r"\A_|_\z", "")


def fold_release(namespace: Column) -> Column:
    """``ensembl-114`` and the like without the release."""
    return F.regexp_replace(namespace, r"-\d+$", "")


def strip_derived_suffix(path: Column) -> Column:
    return F.regexp_replace(path, r"(\.filtered\.fa\.gz|\.fasta)$", "")


def glob_match(name: Column, pattern: str) -> Column:
    return name.rlike(r"\A" + fnmatch.translate(pattern).removeprefix("(?s:").replace(r")\z", "").replace(r")\Z", "") + r"\z")


def lrg_names(name: Column) -> Column:
    """An LRG genomic record is also known without its ``g``."""
    return F.when(name.rlike(r"\ALRG_[0-9]+g\z"), F.array(name, F.regexp_extract(name, r"\A(LRG_[0-9]+)g\z", 1))).otherwise(F.array(name))


def bsd_sum(content: Column) -> Column:
    """16-bit rotating checksum of a small binary, in five digits."""
    n = F.octet_length(content)
    byte = lambda i: F.conv(F.hex(F.substring(content, i, F.lit(1))), 16, 10).cast("long")
    rotate = lambda a, i: (F.shiftright(a, 1) + a.bitwiseAND(F.lit(1)) * 32768 + byte(i)).bitwiseAND(F.lit(65535))
    total = F.aggregate(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), F.lit(0).cast("long"), rotate)
    return F.lpad(total.cast("string"), 5, "0")


def checksum_ok(algorithm: Column, expected: Column, content: Column) -> Column:
    return F.when(algorithm == "md5", F.md5(content) == expected).when(algorithm == "bsd-sum", bsd_sum(content) == expected).otherwise(F.lit(True))


def substitutions(a: Column, b: Column) -> Column:
    """Array of (at, change) for every place of the shorter length where two sequences differ."""
    n = F.least(F.length(a), F.length(b))
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    at = lambda s, i: F.substring(s, i, F.lit(1))
    return F.transform(F.filter(places, lambda i: at(a, i) != at(b, i)), lambda i: F.struct((i - 1).alias("at"), F.concat(at(a, i), F.lit(">"), at(b, i)).alias("change")))


#: IUPAC codes of more than one base, but N.
AMBIGUOUS = "BDHKMRSVWY"


def mismatch_cause(namespace: Column, left: Column, right: Column, left_digest: Column, right_digest: Column) -> Column:
    """Why two sides give a name different digests: the left one drops stop codons before it hashes; one side of an
    Ensembl pair writes N for ambiguous bases; the sequences differ otherwise; or only the digests do."""
    changes = F.array_distinct(F.transform(substitutions(left, right), lambda s: s["change"]))
    to_n = F.array(*(F.lit(x) for b in AMBIGUOUS for x in (f"{b}>N", f"N>{b}")))
    stops = (left == right) & left.contains("*") & (sha512t24u(left) == right_digest) & (sha512t24u(F.replace(left, F.lit("*"), F.lit(""))) == left_digest)
    masked = (namespace == "ensembl") & (F.length(left) == F.length(right)) & (F.size(changes) > 0) & (F.size(F.array_except(changes, to_n)) == 0)
    return (
        F.when(stops, "ensembl_stop_codon_digest_normalization")
        .when(masked, "ensembl_iupac_to_n_normalization")
        .when(left != right, "sequence_divergence_unexplained")
        .otherwise("unexplained_digest_algorithm")
    )


def difference(a: Column, b: Column) -> Column:
    """(first differing index, number of differences with the difference in length, that difference)."""
    found, more = substitutions(a, b), F.abs(F.length(a) - F.length(b))
    first = F.when(F.size(found) > 0, F.get(found, F.lit(0))["at"]).when(more > 0, F.least(F.length(a), F.length(b)))
    return F.struct(first.alias("first"), (F.size(found) + more).alias("n"), (F.length(b) - F.length(a)).alias("length_delta"))


def recovered(padded: Column, digest_of_trimmed: Column) -> Column:
    """How a padded record's real bases are found elsewhere: forward, reverse or no. The digest is that of the bases
    between the N at both ends, or of their reverse complement."""
    span = F.rtrim(F.ltrim(padded, F.lit("Nn")), F.lit("Nn"))
    return F.when(sha512t24u(span) == digest_of_trimmed, "forward").when(sha512t24u(reverse_complement(span)) == digest_of_trimmed, "reverse").otherwise("no")


def padded_length(span_start: Column, span_end: Column, length: Column, inserted: Column) -> Column:
    """Length of a chromosome of ``length`` where ``inserted`` bases stand for the span (1-based, inclusive)."""
    return (span_start - 1) + inserted + (length - span_end)


def human_bytes(n: Column) -> Column:
    """Bytes in the largest binary unit that leaves a whole part, with one decimal."""
    out = F.concat(n.cast("string"), F.lit(" B"))
    for k, unit in enumerate(("KiB", "MiB", "GiB", "TiB"), 1):
        out = F.when(n >= 1 << 10 * k, F.format_string(f"%.1f {unit}", F.bround(n / float(1 << 10 * k), 1))).otherwise(out)
    return out


def relative_path(path: Column, folder: str) -> Column:
    """The path below ``folder``; any other path as it is."""
    root = folder.rstrip("/") + "/"
    return F.when(path.startswith(root), F.substring(path, F.lit(len(root) + 1), F.length(path))).otherwise(path)


#: Bases of the 4-bit codes, as first written and as corrected.
CODES_FIRST, CODES = "NACMGRSKTWYDBHVV", "NACMGRSKTWYDBDHV"


def unpack_codes(payload: Column, length: Column, table: str = CODES) -> Column:
    """Bases of 4-bit codes, high half first: each hexadecimal digit is one code."""
    return F.substring(F.translate(F.hex(payload), "0123456789ABCDEF", table), F.lit(1), length)


@F.pandas_udf(BooleanType())
def gzip_ok(content: pd.Series) -> pd.Series:
    """Whether a file is a whole gzip stream, its checksums included."""
    import zlib

    def whole(raw: bytes) -> bool:
        try:
            while raw:
                part = zlib.decompressobj(31)
                for i in range(0, len(raw), 1 << 20):
                    part.decompress(raw[i : i + (1 << 20)])
                    if part.eof:
                        raw = part.unused_data + raw[i + (1 << 20) :]
                        break
                else:
                    return False
            return True
        except zlib.error:
            return False

    return content.map(lambda raw: bool(raw) and whole(bytes(raw)))


def padding(residues: Column) -> dict[str, Column]:
    """Real bases, and the span between the N at both ends (1-based, inclusive)."""
    left = F.length(F.ltrim(residues, F.lit("Nn")))
    right = F.length(F.rtrim(residues, F.lit("Nn")))
    return {
        "length": F.length(residues),
        "real": F.length(F.regexp_replace(residues, "[Nn]", "")),
        "span_start": F.length(residues) - left + 1,
        "span_end": right,
    }


def natural_key(name: Column) -> Column:
    """Sorts digit runs as numbers: they are padded to 20 digits."""
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"\A[0-9]+\z"), F.lpad(F.regexp_replace(p, r"\A0+(?=.)", ""), 20, "0")).otherwise(p)), "")


def release_date(rfc2822: Column) -> Column:
    return F.to_date(F.substring(rfc2822, 6, 11), "dd MMM yyyy")


def tsv(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))
