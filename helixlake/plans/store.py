"""The content-addressed store: Parquet tables in immutable snapshots, and a pointer that moves when one is complete.

A snapshot is a numbered pointer that names a folder for each table. A commit writes only the tables that change, links the
others from the snapshot before, and then creates the next pointer, which must not exist yet: readers see the old store or
the new one, a failed commit leaves nothing visible, of two writers one fails, and any snapshot can be read again. A store
with tables but no pointer is an error, not an empty store. Everything goes through Spark's file systems.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixlake.functions.aggregates import streamed_set_root
from helixlake.functions.scalars import alphabet_of, sha512t24u
from helixlake.operators import aliases as alias_ops
from helixlake.operators import verify as verify_ops

CHUNK = 1 << 20
TABLES = {
    "sequences": "digest string, name string, length long, alphabet string, md5 string",
    "chunks": "digest string, chunk_no long, residues string",
    "members": "collection string, ordinal long, name string, digest string",
    "provenance": "collection string, path string",
    "aliases": "namespace string, alias string, digest string",
    "collection_aliases": "namespace string, alias string, digest string",
}


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # files and snapshots

    def _fs(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        """Numbers of the snapshots, oldest first."""
        fs, path = self._fs("pointers")
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        found = sorted(int(n) for n in names if n.isdigit())
        tables, root = self._fs("tables")
        if not found and tables.exists(root) and len(tables.listStatus(root)) and not self._started:
            raise OSError(f"{self.path} has tables but no pointer: restore one, or remove what a first commit left behind")
        return found

    _started = False

    def folders(self) -> dict[str, str]:
        """Folder of each table of the last snapshot."""
        found = self.versions()
        if not found:
            return {}
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.path}/pointers/{found[-1]}").collect()))

    def _point(self, number: int, folders: dict[str, str]) -> None:
        """The pointer appears whole, by a rename, and never replaces another one."""
        fs, new = self._fs(f"pointers/.{uuid.uuid4().hex}")
        out = fs.create(new, False)
        out.write(bytearray(json.dumps(folders).encode()))
        out.close()
        _, path = self._fs(f"pointers/{number}")
        if fs.exists(path) or not fs.rename(new, path):
            fs.delete(new, False)
            raise OSError(f"another writer made snapshot {number}")

    def table(self, name: str) -> DataFrame:
        folder = self.folders().get(name)
        if folder is None:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*(f"{self.path}/{f}" for f in folder.split(",")))

    def commit(self, add: dict[str, DataFrame] | None = None, **tables: DataFrame) -> int:
        """A new snapshot in which ``tables`` are replaced and the rows of ``add`` join their tables, whose files stay
        as they are. Aliases are laid out by namespace."""
        found = self.versions()
        folders, number = self.folders(), (found[-1] if found else 0) + 1
        self._started = True
        for name, df in [*tables.items(), *(add or {}).items()]:
            df = df.select([c.split()[0] for c in TABLES[name].split(", ")])
            if name.endswith("aliases"):
                df = df.repartitionByRange("namespace", "alias").sortWithinPartitions("namespace", "alias")
            folder = f"tables/{name}-{number}-{uuid.uuid4().hex}"
            df.write.parquet(f"{self.path}/{folder}")
            folders[name] = folder if name in tables or name not in folders else f"{folders[name]},{folder}"
        self._point(number, folders)
        return number

    # ingest and removal

    def ingest(self, records: DataFrame) -> DataFrame:
        """Add collections, one a file, from records (file, at, name, residues); returns (file, collection, n, was_new)."""
        seqs = records.withColumn("digest", sha512t24u(F.col("residues")))
        # A collection's digest is that of its names, lengths and sequences in order: only digests meet, not residues.
        lines = F.array_sort(F.collect_list(F.struct("at", F.concat_ws("\t", "name", F.length("residues").cast("string"), "digest").alias("x"))))
        heads = seqs.groupBy("file").agg(sha512t24u(F.concat_ws("\n", F.transform(lines, lambda s: s["x"]))).alias("collection"), F.count("*").alias("n"))
        heads = heads.join(self.table("members").select("collection").distinct().withColumn("_old", F.lit(True)), "collection", "left")
        heads = heads.select("file", "collection", "n", F.col("_old").isNull().alias("was_new")).cache()
        fresh = heads.where("was_new").groupBy("collection").agg(F.min("file").alias("file"))
        new = seqs.join(fresh, "file")
        ordinal = F.row_number().over(Window.partitionBy("collection").orderBy("at")) - 1
        members = new.select("collection", ordinal.cast("long").alias("ordinal"), "name", "digest")
        unseen = new.join(self.table("sequences").select("digest"), "digest", "left_anti").groupBy("digest").agg(F.min(F.struct("name", "residues")).alias("s"))
        meta = unseen.select("digest", "s.name", F.length("s.residues").cast("long").alias("length"), alphabet_of(F.col("s.residues")).alias("alphabet"), F.md5("s.residues").alias("md5"))
        steps = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.length("s.residues") / CHUNK).cast("int") - 1))).alias("no")
        chunks = unseen.select("digest", "s.residues", steps).select("digest", F.col("no").cast("long").alias("chunk_no"), F.substring("residues", F.col("no") * CHUNK + 1, F.lit(CHUNK)).alias("residues"))
        provenance = heads.select("collection", F.col("file").alias("path")).distinct().join(self.table("provenance"), ["collection", "path"], "left_anti")
        self.commit(add={"members": members, "sequences": meta, "chunks": chunks, "provenance": provenance})
        return heads

    def remove(self, collections: DataFrame) -> None:
        """Collections go, and with them the sequences that no other collection holds."""
        gone = collections.select("collection").distinct()
        members = self.table("members").join(gone, "collection", "left_anti")
        held = members.select("digest").distinct()
        keep = lambda name: self.table(name).join(held, "digest", "left_semi")
        self.commit(members=members, sequences=keep("sequences"), chunks=keep("chunks"), aliases=keep("aliases"), provenance=self.table("provenance").join(gone, "collection", "left_anti"))

    # aliases

    def add_aliases(self, planned: DataFrame) -> dict[str, int]:
        """Add-only; a name that means something else already, or two things at once, is an error and nothing is added."""
        planned = planned.select("namespace", "alias", "digest").distinct()
        if alias_ops.unsafe_names(planned).limit(1).count():
            raise ValueError("unsafe namespace")
        if alias_ops.conflicts(planned).limit(1).count():
            raise ValueError("a name means two digests")
        load = alias_ops.classify_load(planned, self.table("aliases")).cache()
        counts = {r.outcome: r["count"] for r in load.groupBy("outcome").count().collect()}
        if counts.get("conflict"):
            raise ValueError(f"{counts['conflict']} names mean another digest already")
        self.commit(add={"aliases": load.where("outcome = 'new'").drop("outcome")})
        return {"added": counts.get("new", 0), "skipped": counts.get("same", 0)}

    def replace_namespace(self, namespace: str, desired: DataFrame) -> dict[str, int]:
        """The namespace becomes exactly ``desired`` (alias, digest)."""
        want = desired.select(F.lit(namespace).alias("namespace"), "alias", "digest").distinct()
        old = self.table("aliases").where(F.col("namespace") == namespace)
        keys = ["namespace", "alias", "digest"]
        counts = {"added": want.join(old, keys, "left_anti").count(), "removed": old.join(want, keys, "left_anti").count()}
        self.commit(aliases=self.table("aliases").where(F.col("namespace") != namespace).unionByName(want))
        return counts

    def resolve(self, names: DataFrame) -> DataFrame:
        """(namespace, alias, digest, length): null where a name is unknown."""
        found = names.join(self.table("aliases"), ["namespace", "alias"], "left")
        return found.join(self.table("sequences").select("digest", "length"), "digest", "left").select("namespace", "alias", "digest", "length")

    def substring(self, digest: str, start: int, end: int) -> str:
        """Residues [start, end): only the chunks that hold them are read."""
        own = self.table("chunks").where((F.col("digest") == digest) & F.col("chunk_no").between(start // CHUNK, max(start, end - 1) // CHUNK))
        rows = own.orderBy("chunk_no").collect()
        text = "".join(r.residues for r in rows)
        base = (start // CHUNK) * CHUNK
        return text[start - base : end - base]

    # state

    def census(self) -> DataFrame:
        return self.table("members").groupBy("collection").agg(F.count("*").alias("n"))

    def outputs(self) -> dict:
        """Counts and set roots: the lock's output section."""
        seqs, cols = self.table("sequences"), self.census()
        return {
            "n_sequences": seqs.count(),
            "n_collections": cols.count(),
            "sequences_root": streamed_set_root(seqs),
            "collections_root": streamed_set_root(cols, "collection"),
        }

    def verify(self, lock: dict, deep: bool = False, baseline: DataFrame | None = None) -> DataFrame:
        """Findings against a lock's outputs: roots and counts, membership, coherence and, if deep, every digest."""
        now, then = self.outputs(), lock["outputs"]
        codes = [(f"store.{k}_mismatch", "error", k, f"{then[k]} {now[k]}") for k in now if now[k] != then[k]]
        level0 = self.spark.createDataFrame(codes, "code string, severity string, subject string, detail string")
        locked = self.spark.createDataFrame([(c["digest"], c["n_sequences"]) for c in then["collections"]], "collection string, n long")
        out = verify_ops.union(level0, verify_ops.membership(locked, self.census()), verify_ops.coherence(self.table("sequences"), self.table("chunks"), self.table("members")))
        if deep:
            known = self.spark.createDataFrame([], "digest string, cause string") if baseline is None else baseline
            out = out.unionByName(verify_ops.redigest(redigests(self.table("chunks")), known))
        return out

    def lock(self, inputs: list[dict] | None = None) -> dict:
        """The lock document of this state; ``from`` lists the files of each collection."""
        made = self.table("provenance").groupBy("collection").agg(F.array_sort(F.collect_set("path")).alias("from"))
        rows = self.census().join(made, "collection", "left").orderBy("collection").collect()  # a row a collection
        listed = [{"digest": r.collection, "n_sequences": r.n, "from": list(r["from"] or [])} for r in rows]
        return {"schema": 1, "inputs": {"files": inputs or []}, "outputs": {**self.outputs(), "collections": listed}}


def redigests(chunks: DataFrame) -> DataFrame:
    """(digest, redigest) of every sequence: its chunks pass by in order, one in memory at a time. Sequences of one chunk
    need no order and stay in the JVM."""
    longer = chunks.where("chunk_no > 0").select("digest").distinct()
    short = chunks.join(longer, "digest", "left_anti").select("digest", sha512t24u(F.col("residues")).alias("redigest"))

    def fold(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, hashlib.sha512()
        address = lambda: base64.urlsafe_b64encode(total.digest()[:24]).decode()
        for batch in rows:
            done = []
            for digest, residues in zip(batch.column("digest").to_pylist(), batch.column("residues").to_pylist()):
                if digest != now:
                    if now is not None:
                        done.append((now, address()))
                    now, total = digest, hashlib.sha512()
                total.update(residues.encode())
            yield pa.RecordBatch.from_pydict({"digest": pa.array([d[0] for d in done], pa.string()), "redigest": pa.array([d[1] for d in done], pa.string())})
        if now is not None:
            yield pa.RecordBatch.from_pydict({"digest": [now], "redigest": [address()]})

    ordered = chunks.join(longer, "digest", "left_semi").repartition("digest").sortWithinPartitions("digest", "chunk_no")
    return short.unionByName(ordered.select("digest", "residues").mapInArrow(fold, "digest string, redigest string"))


def validate_lock(lock: dict) -> None:
    """Raise ValueError at the first broken invariant; other schema versions are rejected, never coerced."""
    if lock.get("schema") != 1:
        raise ValueError("another schema version")
    out = lock["outputs"]
    digests = [c["digest"] for c in out["collections"]]
    if len(digests) != len(set(digests)) or len(digests) != out["n_collections"]:
        raise ValueError("collections do not match their count")
    files = lock["inputs"]["files"]
    for key in ("cache_path", "url"):
        own = [f[key] for f in files if key in f]
        if len(own) != len(set(own)):
            raise ValueError(f"two files share a {key}")
    for f in files:
        if "ingest_spec_sha256" in f and f["ingest_spec_sha256"] != spec_sha256(f.get("ingest_spec")):
            raise ValueError(f"the ingest spec of {f['cache_path']} is not the one that its digest names")
    fed = [p for c in out["collections"] for p in c["from"]]
    if len(fed) != len(set(fed)):
        raise ValueError("a file feeds two collections")
    root = out.get("collections_root")
    if root is not None and root != "sha256:" + hashlib.sha256("".join(f"{d}\n" for d in sorted(digests)).encode()).hexdigest():
        raise ValueError("collections do not match their root")
    known = {f["cache_path"] for f in lock["inputs"]["files"]}
    if known and any(set(c["from"]) - known for c in out["collections"]):
        raise ValueError("a collection comes from an unknown file")


def canonical(document: dict) -> str:
    """Canonical JSON: sorted keys, no spaces, other than ASCII escaped."""
    return json.dumps(document, sort_keys=True, separators=(",", ":"))


def spec_sha256(spec: dict | None) -> str:
    """Digest of an ingest spec, of null too."""
    return hashlib.sha256(canonical(spec).encode()).hexdigest()


def write_lock(lock: dict, path: str) -> None:
    validate_lock(lock)
    with open(path, "w") as out:
        out.write(json.dumps(lock, indent=2, sort_keys=True) + "\n")


def read_lock(path: str) -> dict:
    with open(path) as raw:
        lock = json.load(raw)
    validate_lock(lock)
    return lock
