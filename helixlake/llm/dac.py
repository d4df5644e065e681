"""Token-id output as directly addressable codes.

Ids are split into 8-bit chunks. Level 0 holds the lowest chunk of every id, level l the l-th chunk of those ids that
need it. A bitmap per level marks the ids that continue, and a rank directory counts its ones before every 512th bit,
so ``Dac.get`` reaches any id with one rank query a level and no block is ever decoded. Segments are rows of a
Parquet table that Spark writes (so any file system works and a lost executor's half-written files never show);
payload columns stay uncompressed, as they are addressed in place.

Edge cases: a null text counts as empty and still gets its end id; an empty table gives no segments; rows that share a
doc_id all stay, next to each other, ordered by a hash of the text; a null doc_id sorts first; extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batches, binary_text
from .tokens import END, encoder

RANK_STEP = 512
SEGMENT = "part int, seq int, n_tokens long, doc_ids array<long>, starts array<long>, chunks array<binary>, bitmaps array<binary>, ranks array<binary>"


class Dac:
    """The codes of one segment."""

    def __init__(self, chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes]):
        self.chunks = [np.frombuffer(x, np.uint8) for x in chunks]
        self.bitmaps = [np.frombuffer(x, np.uint8) for x in bitmaps]
        self.ranks = [np.frombuffer(x, "<u4") for x in ranks]

    @staticmethod
    def encode(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
        chunks, bitmaps, ranks = [], [], []
        rest = np.ascontiguousarray(ids, np.uint32)
        while True:
            chunks.append((rest & np.uint32(255)).astype(np.uint8).tobytes())
            more = rest > 255
            if not more.any():
                return chunks, bitmaps, ranks
            bits = np.packbits(more, bitorder="little")
            ones = np.bitwise_count(np.pad(bits, (0, -len(bits) % (RANK_STEP // 8)))).reshape(-1, RANK_STEP // 8).sum(1, dtype=np.uint32)
            bitmaps.append(bits.tobytes())
            ranks.append((np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4").tobytes())
            rest = rest[more] >> np.uint32(8)

    def get(self, i: int) -> int:
        """Id number ``i``: one rank query for each level it continues to."""
        value, shift = int(self.chunks[0][i]), 8
        for level, bits in enumerate(self.bitmaps):
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_STEP
            own = np.unpackbits(bits[block * RANK_STEP // 8 : (i >> 3) + 1], bitorder="little")[: i - block * RANK_STEP]
            i = int(self.ranks[level][block]) + int(own.sum())
            value |= int(self.chunks[level + 1][i]) << shift
            shift += 8
        return value

    def decode(self) -> np.ndarray:
        ids = np.zeros(0, np.uint32)
        for level in range(len(self.chunks) - 1, -1, -1):
            low = self.chunks[level].astype(np.uint32)
            if level < len(self.bitmaps):
                more = np.unpackbits(self.bitmaps[level], count=len(low), bitorder="little").view(bool)
                low[more] |= ids << np.uint32(8)
            ids = low
        return ids


def segments(docs: DataFrame, tokenizer: str, segment_tokens: int = 1 << 20) -> DataFrame:
    """Segments of at least ``segment_tokens`` ids (a document is never divided), in ascending doc_id order."""

    def build(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        end = np.array([END], np.uint32)
        seq, ids, held, doc_ids, starts = 0, [], 0, [], []

        def segment():
            chunks, bitmaps, ranks = Dac.encode(np.concatenate(ids))
            values = [[part], [seq], [held], [doc_ids], [starts], [chunks], [bitmaps], [ranks]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.list_(pa.binary())] * 3]
            names = ["part", "seq", "n_tokens", "doc_ids", "starts", "chunks", "bitmaps", "ranks"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        for batch in batches(rows):
            texts = [(t or b"").decode() for t in batch.column("text").to_pylist()]
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), enc.encode(texts)):
                doc_ids.append(doc_id)
                starts.append(held)
                ids += [own, end]
                held += len(own) + 1
                if held >= segment_tokens:
                    yield segment()
                    seq, ids, held, doc_ids, starts = seq + 1, [], 0, [], []
        if doc_ids:
            yield segment()

    tie = F.xxhash64("text")
    rows = binary_text(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie).mapInArrow(build, SEGMENT)


def write(docs: DataFrame, path: str, tokenizer: str, segment_tokens: int = 1 << 20) -> None:
    segments(docs, tokenizer, segment_tokens).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT).parquet(path)


def bases(segs: DataFrame) -> DataFrame:
    """(part, base): ids before each part. It has a row for each file, not for each document."""
    parts = segs.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def documents(segs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the decoded files."""

    def digest(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                ids = Dac(row["chunks"], row["bitmaps"], row["ranks"]).decode().astype("<u4")
                raw, cuts = memoryview(ids.tobytes()), [*row["starts"], len(ids)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "part": pa.array([row["part"]] * len(row["doc_ids"]), pa.int32()),
                        "seq": pa.array([row["seq"]] * len(row["doc_ids"]), pa.int32()),
                        "local": pa.array(row["starts"], pa.int64()),
                        "n_tokens": pa.array(np.diff(cuts), pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                    }
                )

    docs = segs.mapInArrow(digest, "doc_id long, part int, seq int, local long, n_tokens long, ids_crc32 long")
    own = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    places = segs.select("part", "seq", "n_tokens").withColumn("first", F.coalesce(F.sum("n_tokens").over(own), F.lit(0)))
    places = places.join(bases(segs), "part").select("part", "seq", (F.col("base") + F.col("first")).alias("first"))
    return docs.join(places, ["part", "seq"]).select("doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def tokens_at(spark: SparkSession, path: str, positions: list[int]) -> dict[int, int]:
    """Ids at global positions. A position reads one segment, and in it one chunk a level."""
    segs = read(spark, path)
    own = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    index = segs.select("part", "seq", "n_tokens").withColumn("first", F.coalesce(F.sum("n_tokens").over(own), F.lit(0)))
    wanted = spark.createDataFrame([(p,) for p in positions], "position long")
    hits = wanted.join(index, F.expr("position >= first and position < first + n_tokens"))
    rows = hits.join(segs.drop("n_tokens"), ["part", "seq"]).select("position", "first", "chunks", "bitmaps", "ranks")
    return {r.position: Dac(r.chunks, r.bitmaps, r.ranks).get(r.position - r["first"]) for r in rows.toLocalIterator()}
