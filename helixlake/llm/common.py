"""What the training-data operators share: scratch tables, words and stable hashes."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LIBC = ctypes.CDLL(None)
#: Word separators of every operator here: space and \t \n \v \f \r.
SPACES = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a checkpoint folder set on the context. Where both
    are unset, a folder of our own serves a local master only: executors of a cluster would not see it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="helixlake-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/helixlake/{label}-{uuid.uuid4().hex}"


@contextmanager
def conf(spark: SparkSession, **settings: str):
    """Session settings (dots written as double underscores) for the length of a block."""
    old = {k.replace("__", "."): spark.conf.get(k.replace("__", "."), None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k.replace("__", "."), v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def save(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back: lineage ends here, so a lost executor
    costs no recomputation beyond this point. The shuffle files behind it go once it is written."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    with conf(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(*frames: DataFrame) -> None:
    """Delete tables made by :func:`save` that nothing reads any more."""
    for df in frames:
        if path := getattr(df, "_scratch", None):
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def binary_text(df: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and the text as UTF-8 bytes: what the Arrow operators read."""
    return df.select(*keys, F.col("text").cast("binary").alias("text"))


def batches(rows, size: int = 2000, most: int = 24 << 20):
    """Slices of Arrow batches with at most ``size`` rows and about ``most`` bytes, so that memory stays bounded. At the
    end a worker gives back what it has freed, as it outlives its task."""
    used, read = Memory.uses, 0
    for batch in rows:
        read += batch.num_rows
        step = max(1, min(size, int(batch.num_rows * most / max(1, batch.nbytes))))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)
        del batch
    if read and Memory.uses == used and Memory._last is not None:  # another operator's
        Memory._last.clear()
    give_back()


def give_back() -> None:
    """Freed memory goes from Arrow's pool and the C library's to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(_LIBC, "malloc_trim", None):  # glibc alone has it
        trim(0)


class Memory:
    """Something remembered by a Python worker, in two generations: when the young one is full it becomes the old one
    and what is asked for again moves back, so rare entries go and frequent ones stay. Workers outlive their tasks and
    serve every operator in turn, so only the memory that was used last is kept: another operator's is cleared when a
    new one is taken up."""

    _last: Memory | None = None
    uses = 0

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def clear(self) -> None:
        self.young, self.old = {}, {}

    def take_up(self) -> None:
        Memory.uses += 1
        if Memory._last is not self:
            if Memory._last is not None:
                Memory._last.clear()
            Memory._last = self
        if len(self.young) > self.most // 2:
            self.old, self.young = self.young, {}

    def missing(self, keys: list) -> list:
        """Those of ``keys`` that are not remembered; the others are in ``young`` afterwards."""
        young, old, out = self.young, self.old, []
        for k in keys:
            if k not in young:
                if (v := old.get(k)) is None:
                    out.append(k)
                else:
                    young[k] = v
        return out


def coded(raw: np.ndarray, cuts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The different ones of the pieces of ``raw`` (bytes) between ``cuts``, and the number of each piece among them."""
    cuts = np.ascontiguousarray(cuts, np.int64)
    x = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(raw)]).dictionary_encode()
    offsets, data = x.dictionary.buffers()[1:]
    edges = np.frombuffer(offsets, np.int64)[: len(x.dictionary) + 1].tolist()
    known = data.to_pybytes() if data else b""
    return [known[i:j] for i, j in zip(edges, edges[1:])], x.indices.to_numpy()


class WordHashes(Memory):
    """64-bit hashes of what ``form`` makes of words (bytes); it is asked once for a word that is remembered."""

    def __init__(self, form, most: int = 400_000):
        super().__init__(most)
        self.form = form

    def of(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of some texts, end to end, and the number of words of each text."""
        self.take_up()
        raw = np.frombuffer(b" ".join([b"", *(t or b"" for t in texts), b""]), np.uint8)
        blank = IS_SPACE[raw]
        edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        start, end = edges[::2], edges[1::2]
        lens = np.diff(np.searchsorted(start, np.cumsum([1, *(len(t) + 1 if t else 1 for t in texts)])))
        words, codes = coded(raw[~blank], np.cumsum(np.r_[0, end - start]))
        self.young.update((w, xxhash.xxh3_64_intdigest(self.form(w))) for w in self.missing(words))
        return np.fromiter(map(self.young.__getitem__, words), np.uint64, len(words))[codes], lens


M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


IS_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
#: A random number for each byte, a factor for each place, and its inverse modulo 2^64.
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
STEP, BACK = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
_places = [np.ones(1, np.uint64)] * 2


def _factors(n: int) -> list[np.ndarray]:
    if len(_places[0]) < n:
        for k, by in enumerate((STEP, BACK)):
            steps = np.full(max(n, 1 << 20), by, np.uint64)
            steps[0] = 1
            _places[k] = np.cumprod(steps)
    return _places


def word_hashes(texts: list[bytes | None], most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of some texts, end to end, and the number of words of each text.

    A word's hash is the sum of its bytes' random numbers times the factors of their places: a difference of running
    sums, moved back to place 0 by an inverse factor. So all words of about ``most`` bytes are hashed at once."""
    out, lens, lo = [], np.zeros(len(texts), np.int64), 0
    sizes = [len(t) + 1 if t else 1 for t in texts]
    while lo < len(texts):
        hi, size = lo + 1, sizes[lo]
        while hi < len(texts) and size + sizes[hi] <= most:
            size += sizes[hi]
            hi += 1
        raw = np.frombuffer(b" ".join(t or b"" for t in texts[lo:hi]), np.uint8)
        edges = np.flatnonzero(np.diff(IS_SPACE[raw].view(np.int8), prepend=1, append=1))
        start, end = edges[::2], edges[1::2]
        place, back = _factors(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTES[raw] * place[: len(raw)], out=sums[1:])
        out.append(mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64)))
        lens[lo:hi] = np.diff(np.searchsorted(start, np.r_[0, np.cumsum(sizes[lo:hi])]))
        lo = hi
    return np.concatenate(out) if out else np.zeros(0, np.uint64), lens


def grams(h: np.ndarray, k: int, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each run of ``k`` words. Runs are joined by doubling, so it costs log2(k) passes."""
    if len(h) < k:
        return np.empty(0, np.uint64)
    out, have, bits = None, 0, mix(h ^ np.uint64(seed & 0xFFFFFFFFFFFFFFFF))
    size, power = 1, bits
    while True:
        if k & size:
            if out is None:
                out, have = power, size
            else:
                n = len(h) - have - size + 1
                out = mix(out[:n] * np.uint64(0x9E3779B97F4A7C15) + power[have : have + n])
                have += size
        if have == k:
            return out[: len(h) - k + 1]
        power = mix(power[:-size] * np.uint64(0xD6E8FEB86659FD93) + power[size:])
        size *= 2
