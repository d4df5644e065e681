"""Digests, scans, the manifest and the store."""

import gzip
import hashlib
import shutil
import zipfile

import pytest
from pyspark.sql import functions as F

from helixlake.functions import aggregates as agg
from helixlake.functions import scalars as fn
from helixlake.operators import aliases, exclusion, parity, sync, verify
from helixlake.plans.store import Store, canonical, redigests, validate_lock
from helixlake.sources import files, manifest

GOLDEN = {
    "MCVTYHNGTGYC": ("13xx4yn7JousnAXLxTBX-bbWg4TitdN0", "dnaio"),
    "ACGTHACGTVACGTNACGT": ("Vu6wOvjbNQLTfbmxUCCcf9tBB9KZJYDu", "dnaio"),
    "MKWVTFISLLOFLFSSAYS": ("p8m0yov-U6dljEuwih4z-J4D_bHJo1eJ", "ASCII"),
    "MKWVTFISLLFLFSSAYS": ("Yh8OEOTbVpE7N7GDVoGQS-x77N0Wyuyj", "protein"),
    "ACGTACGTACGT": ("tlkjFUbZBvLI4IYBwYgqhjZI_Aetdq5B", "dna2bit"),
}


def test_golden_digests(spark):
    df = spark.createDataFrame([(s,) for s in GOLDEN], "s string").select("s", fn.sha512t24u(F.col("s")).alias("d"), fn.alphabet_of(F.col("s")).alias("a"))
    for r in df.collect():
        assert r.d == GOLDEN[r.s][0]
        assert r.a == GOLDEN[r.s][1]


def test_set_root(spark):
    want = "sha256:" + hashlib.sha256(b"aaa\nbbb\n").hexdigest()
    df = spark.createDataFrame([("bbb",), ("SQ.aaa",), ("aaa",)], "digest string")
    assert df.select(agg.set_root(F.col("digest"))).first()[0] == want == agg.streamed_set_root(df)
    assert agg.streamed_set_root(df.limit(0)) == "sha256:" + hashlib.sha256(b"").hexdigest()


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column).first()[0]


def test_scalars(spark):
    c = F.col
    assert [(x["at"], x["change"]) for x in one(spark, fn.substitutions(c("a"), c("b")), a="MCVTYHNGTGYC", b="MCVTYVNGTGYC")] == [(5, "H>V")]
    assert one(spark, fn.reverse_complement(c("a")), a="ACGTnr") == "ynACGT"
    assert one(spark, fn.bsd_sum(c("a").cast("binary")), a="A") == "00065"
    assert one(spark, fn.lrg_names(c("a")), a="LRG_1g") == ["LRG_1g", "LRG_1"]
    assert one(spark, fn.lrg_names(c("a")), a="LRG_1t1") == ["LRG_1t1"]
    assert one(spark, fn.glob_match(c("a"), "human.*.rna"), a="human.2.rna") is True
    assert one(spark, fn.version_base(c("a")), a="A.B.12") == "A.B"
    cause = lambda ns, a, b, x="", y="": one(spark, fn.mismatch_cause(F.lit(ns), c("a"), c("b"), F.lit(x), F.lit(y)), a=a, b=b)
    assert cause("ensembl", "ACN", "ACR") == "ensembl_iupac_to_n_normalization"
    assert cause("refseq", "ACN", "ACR") == cause("ensembl", "ACN", "ACG") == "sequence_divergence_unexplained"
    assert cause("ensembl", "ACG", "ACG") == "unexplained_digest_algorithm"
    address = lambda x: one(spark, fn.sha512t24u(c("a")), a=x)
    assert cause("ensembl", "MA*", "MA*", address("MA"), address("MA*")) == "ensembl_stop_codon_digest_normalization"
    assert tuple(one(spark, fn.difference(c("a"), c("b")), a="ACGTT", b="AGG")) == (1, 3, -2)
    assert one(spark, fn.recovered(c("a"), F.lit(address("ACGG"))), a="NNACGGN") == "forward"
    assert one(spark, fn.recovered(c("a"), F.lit(address("CCGT"))), a="NNACGGN") == "reverse"
    assert one(spark, fn.human_bytes(c("a").cast("long")), a="1536") == "1.5 KiB"
    assert one(spark, fn.relative_path(c("a"), "/d/"), a="/d/x/y") == "x/y"
    assert one(spark, fn.unpack_codes(F.unhex("a"), F.lit(3)), a="12D0") == "ACD"
    assert one(spark, fn.release_date(c("a")), a="Tue, 05 Mar 2024 10:00:00 GMT").isoformat() == "2024-03-05"
    assert one(spark, fn.strip_derived_suffix(c("a")), a="x.filtered.fa.gz") == "x"


@pytest.fixture
def fastas(tmp_path):
    (tmp_path / "alpha.fa").write_text(">chr_a first > one\nACGTACGTAAGG\nttccaa\n>chr_shared\nTTTTGGGGCCCCAAAATT\n")
    (tmp_path / "beta.fa").write_text(">chr_shared\nTTTTGGGGCCCCAAAATT\n>chr_b\nGATTACAGATTACAGATT\n")
    return tmp_path


def test_fasta(spark, fastas):
    rows = files.records(spark, str(fastas / "*.fa")).collect()
    assert {(r.file.rsplit("/", 1)[1], r.name, r.residues) for r in rows} == {
        ("alpha.fa", "chr_a", "ACGTACGTAAGGTTCCAA"),
        ("alpha.fa", "chr_shared", "TTTTGGGGCCCCAAAATT"),
        ("beta.fa", "chr_shared", "TTTTGGGGCCCCAAAATT"),
        ("beta.fa", "chr_b", "GATTACAGATTACAGATT"),
    }
    assert {r.name for r in files.fasta_names(spark, str(fastas / "*.fa")).collect()} == {"chr_a", "chr_shared", "chr_b"}


def test_other_formats(spark, tmp_path):
    (tmp_path / "a.gbff").write_text("LOCUS x\nVERSION     NM_1.1\nCOMMENT     see http://x/y//\nORIGIN\n        1 acgt ac\n//\nLOCUS y\nORIGIN\n 1 aa\n//\n")
    assert [(r.name, r.residues) for r in files.records(spark, str(tmp_path / "a.gbff"), "gbff").collect()] == [("NM_1.1", "acgtac")]
    with zipfile.ZipFile(tmp_path / "l.zip", "w") as z:
        for i in (10, 2, 1):
            z.writestr(f"fasta/LRG_{i}.fasta", f">LRG_{i}g (genomic)\nACGT\n>LRG_{i}t1\nACG\n>LRG_{i}p1\nMA")
    rows = files.records(spark, str(tmp_path / "l.zip"), "lrg_zip").orderBy("ordinal").collect()
    assert [r.name for r in rows][::3] == ["LRG_1g", "LRG_2g", "LRG_10g"] and len(rows) == 9
    with pytest.raises(ValueError):
        files.records(spark, "x", "sff")


def test_checksum_lists(spark, tmp_path):
    good = tmp_path / "md5"
    good.write_text(f"{'a' * 32}  human.10.rna\n{'B' * 32}  human.2.rna\n")
    assert {(r.checksum, r.name) for r in files.md5_manifest(spark, str(good)).collect()} == {("a" * 32, "human.10.rna"), ("b" * 32, "human.2.rna")}
    for bad in ("not-a-record", f"{'a' * 32}  dir/f.gz", f"{'a' * 32}  ../f.gz", f"{'a' * 32}  *f.gz", f"{'a' * 32}  f\n{'a' * 32}  f"):
        (tmp_path / "bad").write_text(bad + "\n")
        with pytest.raises(ValueError):
            files.md5_manifest(spark, str(tmp_path / "bad"))
    (tmp_path / "len").write_text(f"{'a' * 32}  *f.gz\n{'c' * 32}  ./g.gz\n{'d' * 32}  sub/h.gz\n")
    assert {r.name for r in files.md5_manifest(spark, str(tmp_path / "len"), strict=False).collect()} == {"f.gz", "g.gz"}
    (tmp_path / "bsd").write_text("65 1 one.fa.gz\n")
    assert tuple(files.bsd_manifest(spark, str(tmp_path / "bsd")).first()) == ("00065", 1, "one.fa.gz")


def test_report(spark, tmp_path):
    head = "Sequence-Name\tSequence-Role\tGenBank-Accn\tRefSeq-Accn\tUCSC-style-name"
    (tmp_path / "r.txt").write_text(f"# RefSeq assembly accession: GCF_1.1\n# GenBank assembly accession: GCA_1.1\n# {head}\n1\tx\tCM1.1\tNC_1.1\tchr1\n2\tx\tna\tna\tchr2\nbroken\tline\n")
    meta, rows = files.assembly_report(spark, str(tmp_path / "r.txt"))
    assert meta["RefSeq assembly accession"] == "GCF_1.1" and rows.count() == 2
    got = {(r.namespace, r.alias) for r in aliases.report_aliases(rows, "asm").collect()}
    assert got == {("asm", "1"), ("asm", "chr1"), ("asm", "CM1.1"), ("insdc", "CM1.1"), ("refseq", "NC_1.1")}
    stored = spark.createDataFrame([("refseq", "NC_1.1", "old")], "namespace string, alias string, digest string")
    pending = spark.createDataFrame([("refseq", "NC_1.1", "new")], stored.schema)
    assert {r.digest for r in aliases.resolve_report(aliases.report_aliases(rows, "asm"), stored, pending).collect()} == {"new"}


MANIFEST = """
[[assembly]]
namespace = "g"
report_url = "https://x/r.txt"
fasta_url = "https://x/f.fa"
fasta_path = "f.fa"
[[seqset]]
name = "s"
namespace = "refseq"
url_template = "https://x/h.{shard}.fa"
shard_range = [1, 3]
[[seqset]]
name = "p"
namespace = "refseq"
url_pattern = "https://x/d/h.*.rna"
checksum_manifest_url = "https://x/d/md5"
[[seqset]]
name = "m"
namespace = "refseq"
urls = ["https://x/m/a.gz", "https://x/m/b.gz"]
md5_manifest_urls = ["https://x/m/md5", "https://x/m/md5"]
file_classes = ["rna", "protein"]
exclude = { file_classes = ["rna"], record_prefixes = ["X_"] }
[[seqset]]
name = "e"
namespace = "ensembl-76"
release = 76
rolling_namespace = "ensembl"
urls = ["https://x/e/1", "https://x/e/2", "https://x/e/3", "https://x/e/4"]
checksum_manifest_urls = ["https://x/e/CHECKSUMS", "https://x/e/CHECKSUMS", "https://x/e/CHECKSUMS", "https://x/e/CHECKSUMS"]
file_classes = ["dna.toplevel", "cdna", "ncrna", "pep"]
"""


def test_manifest(spark, tmp_path):
    path = tmp_path / "sources.toml"
    path.write_text(MANIFEST)
    assemblies, seqsets = manifest.load(str(path))
    assert assemblies[0].fasta_path == str(tmp_path / "f.fa")
    sources = manifest.expand(spark, assemblies, seqsets)
    assert {r.url for r in sources.where("owner = 's'").collect()} == {f"https://x/h.{i}.fa" for i in (1, 2, 3)}
    rows = [("https://x/d/md5", "h.10.rna", "aa"), ("https://x/d/md5", "h.2.rna", "bb"), ("https://x/d/md5", "h.prot", "cc"), ("https://x/m/md5", "b.gz", "dd")]
    listing = spark.createDataFrame(rows, "checksum_url string, name string, checksum string")
    resolved = manifest.resolve(sources, listing)
    assert [(r.url, r.checksum) for r in resolved.where("owner = 'p'").orderBy("natural").collect()] == [("https://x/d/h.2.rna", "bb"), ("https://x/d/h.10.rna", "aa")]
    assert {(r.url[-4:], r.checksum, r.file_class) for r in resolved.where("owner = 'm'").collect()} == {("a.gz", None, "rna"), ("b.gz", "dd", "protein")}
    assert resolved.count() == 13 and manifest.duplicate_urls(resolved).count() == 0
    path.write_text(MANIFEST.replace('"ncrna", ', '"cdna", '))
    with pytest.raises(ValueError, match="release 76"):
        manifest.load(str(path))


@pytest.mark.parametrize(
    "bad",
    [
        {"urls": ["u"], "url_pattern": "p"},
        {"urls": ["u"], "shard_range": [1, 2]},
        {"urls": ["u"], "format": "zip"},
        {"urls": ["u"], "release": 3},
        {"urls": ["u"], "release": 3, "rolling_namespace": "e"},
        {"urls": ["u"], "exclude": {"x": 1}},
        {"urls": ["u"], "file_class": "a", "exclude": {"file_classes": ["b"], "record_prefixes": ["X"]}},
        {"urls": ["u"], "file_class": "a", "exclude": {"file_classes": ["a"]}},
        {"urls": ["u"], "md5_manifest_urls": ["a", "b"]},
        {"urls": ["u"], "md5_manifest_urls": ["a"], "checksum_manifest_urls": ["a"]},
        {"urls": ["u"], "file_class": "a", "file_classes": ["a"]},
        {"urls": ["u"], "file_classes": ["a", "b"]},
        {"url_pattern": "https://x/d/h.*"},
        {"url_pattern": "http://x/d/h.*", "checksum_manifest_url": "http://x/d/m"},
        {"url_pattern": "https://x/d/h", "checksum_manifest_url": "https://x/d/m"},
        {"url_pattern": "https://x/d/h.*", "checksum_manifest_url": "https://x/e/m"},
    ],
)
def test_manifest_faults(bad):
    with pytest.raises(ValueError):
        manifest.Seqset(name="b", namespace="n", **bad)


def test_manifest_globs(spark):
    for ok in ("https://x/d/h?.rna", "https://x/d/h[0-9].rna"):
        seqset = manifest.Seqset(name="b", namespace="n", url_pattern=ok, checksum_manifest_url="https://x/d/m")
        listing = spark.createDataFrame([("https://x/d/m", n, "a") for n in ("h1.rna", "h10.rna", "hx-rna")], "checksum_url string, name string, checksum string")
        assert [r.url for r in manifest.resolve(manifest.expand(spark, [], [seqset]), listing).collect()] == ["https://x/d/h1.rna"]


def test_equivalence(spark):
    """Unversioned names are superseded by any version, names above the top are to be filled in, and the digest is looked
    for only where the base has no version."""
    rows = lambda *x: spark.createDataFrame(list(x), "alias string, digest string")
    left = rows(("NM_1", "a"), ("NM_2.5", "b"), ("NM_3.1", "c"), ("NM_4.1", "d"), ("NM_5.1", "e"), ("NM_6.1", "f"), ("NM_7.1", "g"))
    right = rows(("NM_1.2", "z"), ("NM_2.3", "y"), ("X_2", "b"), ("NM_3", "x"), ("X_4", "d"), ("NM_5.1", "w"), ("NM_6.1", "v"), ("NM_7.1", "g"))
    divergent = spark.createDataFrame([("NM_6.1", "why")], "alias string, cause string")
    got = {r.alias: (r.category, r.cause) for r in parity.equivalence(left, right, divergent, right).collect()}
    assert got == {
        "NM_1": ("superseded_old_version", None),
        "NM_2.5": ("backfill_candidate", None),
        "NM_3.1": ("sequence_missing", None),
        "NM_4.1": ("alias_naming_gap", None),
        "NM_5.1": ("mismatch_unexplained", "unexplained"),
        "NM_6.1": ("mismatch_explained", "why"),
        "NM_7.1": ("matched", None),
    }
    found = parity.gaps(left, right, right)
    assert {r.alias for r in parity.filter_gaps(found, ["sequence_missing", "alias_naming_gap"], ["NM_3", "NM_9"]).collect()} == {"NM_3.1"}


def test_trajectory(spark):
    rows = spark.createDataFrame([(i, "a", f"d{i}") for i in range(30)], "release int, alias string, digest string")
    assert parity.trajectory(rows).first().path.split()[24:] == ["Y", "Z", "27", "28", "29", "30"]


def test_release_groups(spark):
    rows = spark.createDataFrame([("e", 2, "shared", "d2"), ("e", 1, "shared", "d1"), ("e", 1, "retired", "old"), ("e", 3, "half", "h")], "group string, release int, alias string, digest string")
    processed = spark.createDataFrame([("e", r, f) for r, f in ((1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"))], "group string, release int, file string")
    expected = spark.createDataFrame([("e", r, 2) for r in (1, 2, 3)], "group string, release int, files int")
    got = {(r.namespace, r.alias, r.digest) for r in aliases.publish(rows, processed, expected).collect()}
    assert got == {("e-1", "shared", "d1"), ("e-1", "retired", "old"), ("e-2", "shared", "d2"), ("e", "shared", "d2")}
    with pytest.raises(ValueError):
        aliases.publish(rows.union(spark.createDataFrame([("e", 2, "shared", "other")], rows.schema)), processed, expected)


def test_collection_aliases(spark):
    heads = spark.createDataFrame([("GCF_1", "GCA_1", "c"), ("na", "GCA_2", "d")], "refseq string, genbank string, digest string")
    assert {tuple(r) for r in aliases.collection_aliases(heads).collect()} == {("refseq", "GCF_1", "c"), ("insdc", "GCA_1", "c"), ("insdc", "GCA_2", "d")}


def test_examples_of_a_large_group(spark):
    rows = spark.range(100).selectExpr("'k' as k", "lpad(id, 3, '0') as v")
    assert agg.top(rows, ["k"], "v", 3).first().shown == "000;001;002;+97"


def test_file_records(spark, tmp_path):
    (tmp_path / "d").mkdir()
    whole = gzip.compress(b"ACGT" * 1000)
    for name, raw in {"a.gz": whole, "b.gz": whole[:-3], "c.gz": whole + whole, "d/e.txt": b"x"}.items():
        (tmp_path / name).write_bytes(raw)
    got = {r.cache_path: r for r in files.file_records(spark, str(tmp_path)).collect()}
    assert {k: r.gzip_ok for k, r in got.items()} == {"a.gz": True, "b.gz": False, "c.gz": True, "d/e.txt": None}
    assert got["d/e.txt"].sha256 == hashlib.sha256(b"x").hexdigest() and got["a.gz"].bytes == len(whole)


def test_store_pointer(spark, fastas, tmp_path):
    """Snapshots are never replaced; a lost pointer is an error; an alias copies no residues."""
    store = Store(spark, f"file://{tmp_path}/store")
    store.ingest(files.records(spark, str(fastas / "alpha.fa")))
    before = store.folders()
    store.add_aliases(store.table("members").select(F.lit("n").alias("namespace"), F.col("name").alias("alias"), "digest"))
    assert {k for k, v in store.folders().items() if before.get(k) != v} == {"aliases"}
    with pytest.raises(OSError):
        store._point(2, {})
    store.ingest(files.records(spark, str(fastas / "beta.fa")))
    assert store.table("sequences").count() == 3 and store.versions() == [1, 2, 3]
    shutil.rmtree(tmp_path / "store" / "pointers")
    with pytest.raises(OSError):
        Store(spark, f"file://{tmp_path}/store").table("sequences")


def test_redigest_of_long_sequences(spark):
    rows = [("x", 1, "GG"), ("x", 0, "AC"), ("x", 2, "T"), ("y", 0, "TT")]
    got = {r.digest: r.redigest for r in redigests(spark.createDataFrame(rows, "digest string, chunk_no long, residues string")).collect()}
    want = {r.s: r.d for r in spark.createDataFrame([("ACGGT",), ("TT",)], "s string").select("s", fn.sha512t24u(F.col("s")).alias("d")).collect()}
    assert got == {"x": want["ACGGT"], "y": want["TT"]}


def test_manifest_and_remote_findings(spark):
    status = spark.createDataFrame([("u", "new"), ("v", "same")], "url string, status string")
    assert {r.code for r in verify.manifest(status, "a", "b").collect()} == {"manifest.file_added", "manifest.config_changed"}
    sizes = spark.createDataFrame([("u", 3, None), ("v", 3, 4), ("w", 3, 3)], "url string, bytes long, remote long")
    assert {(r.subject, r.code, r.severity) for r in verify.remote(sizes).collect()} == {("u", "remote.size_unavailable", "warn"), ("v", "remote.size_mismatch", "warn")}


def test_repair_dispatch(spark):
    rows = [("store.collection_missing", "error", "c"), ("cache.missing", "error", "z"), ("cache.sha256_mismatch", "error", "z"), ("store.seq_digest_mismatch", "error", "q"), ("store.orphan_sequence", "warn", "o"), ("store.seq_digest_fixed", "info", "i")]
    found = spark.createDataFrame([(*r, "") for r in rows], "code string, severity string, subject string, detail string")
    members = spark.createDataFrame([("q", "c")], "digest string, collection string")
    sources = spark.createDataFrame([("c", "a"), ("c", "b")], "collection string, path string")
    lock = spark.createDataFrame([(p, "seqset", p.upper()) for p in "abz"], "path string, kind string, owner string")
    got = {(r.action, r.path, r.owner, tuple(r.codes)) for r in verify.repair_plan(found, members, sources, lock).collect()}
    assert got == {
        ("reingest", "a", "seqset/A", ("store.collection_missing",)),
        ("reingest", "b", "seqset/B", ("store.collection_missing",)),
        ("refetch", "z", "seqset/Z", ("cache.missing", "cache.sha256_mismatch")),
        ("unrepairable", "q", None, ("store.seq_digest_mismatch",)),
        ("ignored", "o", None, ("store.orphan_sequence",)),
    }


def test_exclusion(spark):
    rows = spark.createDataFrame([("1", "ACGT", "dna"), ("CHR_A", "NNNN", "dna"), ("CHR_B", "NN", "cdna")], "name string, residues string, file_class string")
    kept, audit = exclusion.split(rows, ["CHR_"], ["dna"])
    assert {r.name for r in kept.collect()} == {"1", "CHR_B"} and [tuple(r) for r in audit.collect()] == [("CHR_A", 4)]


def test_store(spark, fastas, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    heads = store.ingest(files.records(spark, str(fastas / "*.fa"))).collect()
    assert {h.n for h in heads} == {2} and all(h.was_new for h in heads)
    lock = store.lock()
    assert lock["outputs"]["n_sequences"] == 3 and lock["outputs"]["n_collections"] == 2
    validate_lock(lock)
    assert store.verify(lock, deep=True).count() == 0
    assert not any(h.was_new for h in store.ingest(files.records(spark, str(fastas / "*.fa"))).collect())
    assert store.outputs() == lock_outputs(lock)
    members = store.table("members")
    named = members.select(F.lit("refseq").alias("namespace"), F.col("name").alias("alias"), "digest")
    assert store.add_aliases(named) == {"added": 3, "skipped": 0}
    assert store.add_aliases(named) == {"added": 0, "skipped": 3}
    with pytest.raises(ValueError):
        store.add_aliases(named.limit(1).withColumn("digest", F.lit("other")))
    assert store.replace_namespace("roll", named.select("alias", "digest").limit(2)) == {"added": 2, "removed": 0}
    digest = {r.name: r.digest for r in members.collect()}
    assert store.substring(digest["chr_b"], 2, 6) == "TTAC"
    got = {r.alias: r.length for r in store.resolve(spark.createDataFrame([("refseq", "chr_a"), ("refseq", "zzz")], "namespace string, alias string")).collect()}
    assert got == {"chr_a": 18, "zzz": None}
    alpha = next(h.collection for h in heads if h.file.endswith("alpha.fa"))
    store.remove(spark.createDataFrame([(alpha,)], "collection string"))
    assert {r.name for r in store.table("members").collect()} == {"chr_shared", "chr_b"}
    assert digest["chr_a"] not in {r.digest for r in store.table("sequences").collect()}
    codes = {r.code for r in store.verify(lock).collect()}
    assert {"store.collection_missing", "store.n_sequences_mismatch", "store.sequences_root_mismatch"} <= codes


def lock_outputs(lock):
    return {k: v for k, v in lock["outputs"].items() if k != "collections"}


def test_lock():
    good = {"schema": 1, "inputs": {"files": [{"cache_path": "a"}]}, "outputs": {"n_collections": 1, "collections": [{"digest": "d", "n_sequences": 1, "from": ["a"]}]}}
    validate_lock(good)
    for change in ({"schema": 2}, {"inputs": {"files": [{"cache_path": "b"}]}}, {"outputs": {"n_collections": 2, "collections": []}}):
        with pytest.raises(ValueError):
            validate_lock(good | change)
    assert canonical({"b": 1, "a": [1, "é"]}) == '{"a":[1,"\\u00e9"],"b":1}'


def test_cache_findings(spark):
    lock = spark.createDataFrame([("a", 3, "s", True), ("b", 3, "s", True), ("c", 3, "s", True), ("d", 3, "s", True), ("e", 3, "s", False), ("f", 3, "s", True)], "cache_path string, bytes long, sha256 string, present boolean")
    found = spark.createDataFrame([("a", 3, "s", True), ("b", 0, "s", True), ("c", 3, "t", True), ("d", 2, "t", False), ("f", 3, "s", False)], "cache_path string, bytes long, sha256 string, gzip_ok boolean")
    got = {(r.subject, r.code) for r in verify.cache(lock, found).collect()}
    assert got == {("b", "cache.missing"), ("c", "cache.sha256_mismatch"), ("d", "cache.size_mismatch"), ("d", "cache.sha256_mismatch"), ("d", "cache.gzip_corrupt"), ("f", "cache.gzip_corrupt")}
    assert ("c", "cache.sha256_mismatch") not in {(r.subject, r.code) for r in verify.cache(lock, found, hashes=False).collect()}


def test_sync_missing_wins(spark):
    files_ = spark.createDataFrame([("a", None, "s"), ("b", "x", "s")], "path string, sha256 string, spec_sha256 string")
    lock = spark.createDataFrame([("b", "x", "t"), ("c", "y", "s")], files_.schema)
    got = {r.path: (r["class"], r.reason) for r in sync.sync_plan(files_, lock).collect()}
    assert got == {"a": ("missing", None), "b": ("reingest", "ingest spec changed"), "c": ("removed", None)}
