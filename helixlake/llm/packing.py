"""Best-fit packing with certificates.

Each group of pieces is packed by best-fit decreasing. Dual-feasible functions (the identity, Martello and Toth's
threshold functions, and the u(k) and phi(eps) families of Fekete and Schepers) bound from below the bins that the
group needs; where that bound equals the bins used, the group is certified and final. Groups with a gap keep their
full bins and give up the documents of the others; these meet in new groups and are packed again. A round that does
not save a bin is dropped and ends the exchange, as does one that certifies every group.

Edge cases: a null text counts as empty, so its only id is the end id; an empty table gives no rows; repeated rows
are packed as often as they occur; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, binary_text, save
from .tokens import END, encoder

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """Documents as token pieces. Of those longer than ``capacity`` only the first piece may be shorter."""

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches(rows):
            texts = [(t or b"").decode() for t in batch.column("text").to_pylist()]
            out: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(texts)):
                raw, n = ids.tobytes() + END.to_bytes(4, "little"), len(ids) + 1
                edges = [0, *range(n % capacity or min(n, capacity), n + 1, capacity)]
                out += [(doc_id, i, a, b - a, zlib.crc32(raw[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
            columns = zip(*out) if out else [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return binary_text(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(cut, PIECE)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin. An item goes to the fullest bin that still takes it."""
    bins, offsets, fill = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        if fits := rooms >> n:
            room = n + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += n
        if room > n:
            open_bins[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins, offsets, np.array(fill, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The most that any of the dual-feasible functions proves. All sums are of integers."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    up = lambda total, unit: -(-int(total) // unit)
    best = up((count * x).sum(), capacity)
    for k in range(1, 21):
        y = (k + 1) * x
        best = max(best, up((count * np.where(y % capacity == 0, x * k, y // capacity * capacity)).sum(), capacity * k))
    for eps in range(1, capacity // 2 + 1):
        best = max(best, up((count * np.where(x > capacity - eps, capacity, np.where(x < eps, 0, x))).sum(), capacity))
        q = capacity // eps
        phi = np.where(2 * x > capacity, q - (capacity - x) // eps, np.where(x >= eps, 1, 0))
        best = max(best, up((count * phi).sum(), q))
    return best


def packer(capacity: int, turn: int):
    def best_fit(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        sure = len(fill) == lower_bound(lengths, capacity)
        pdf = pdf.assign(sequence_id=((turn << 28) + int(pdf["grp"].iloc[0]) << 28) + bins, offset=offsets, certified=sure)
        return pdf.assign(again=(not sure) & (fill[bins] < capacity)).drop(columns="grp")

    return best_fit


def pack(items: DataFrame, capacity: int = 1024, group_items: int = 30_000) -> DataFrame:
    """``items`` (a table: it is read once a round) with sequence_id, offset and certified."""
    columns = items.columns
    fields = ", ".join(f"{n} {t}" for n, t in items.dtypes)
    done: list[DataFrame] = []
    todo, bins_before = items, None
    for turn in count():
        n = todo.count()
        if not n:
            break
        groups = -(-n // group_items)

        keyed = todo.select(*columns, F.pmod(F.xxhash64("doc_id", "piece", F.lit(turn)), F.lit(groups)).alias("grp"))
        packed = keyed.groupBy("grp").applyInPandas(packer(capacity, turn), f"{fields}, sequence_id long, offset long, certified boolean, again boolean")
        packed = save(packed, "packed")
        bins = packed.agg(F.count_distinct("sequence_id")).first()[0]
        if bins_before is not None and bins >= bins_before:
            done.append(last.where("again"))  # noqa: F821  the round saved nothing: what was there stays
            todo = None
            break
        last = packed
        done.append(packed.where("not again"))
        todo = packed.where("again")
        bins_before = todo.agg(F.count_distinct("sequence_id")).first()[0]
        if groups == 1 or not bins_before:
            break
    if todo is not None and done:
        done.append(todo)
    if not done:
        return items.select(*columns, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified")).limit(0)
    out = done[0]
    for df in done[1:]:
        out = out.union(df)
    return out.drop("again")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, group_items: int = 30_000) -> DataFrame:
    """The pieces of all documents and their places; pieces are tokenized once and kept in a table."""
    return pack(save(pieces(docs, tokenizer, capacity), "pieces"), capacity, group_items)
