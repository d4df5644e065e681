"""Aggregates over columns and frames."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scalars import strip_sq


def set_root(digest: Column) -> Column:
    """Canonical root of a set of digests, as one aggregate: for sets that fit one row (a collection, a namespace)."""
    own = F.array_sort(F.collect_set(strip_sq(digest)))
    return F.concat(F.lit("sha256:"), F.sha2(F.concat_ws("", F.transform(own, lambda x: F.concat(x, F.lit("\n")))), 256))


def streamed_set_root(digests: DataFrame, column: str = "digest") -> str:
    """The same root for sets of any size: sorted in Spark, hashed on the driver one partition at a time."""
    total = hashlib.sha256()
    for r in digests.select(strip_sq(F.col(column)).alias("d")).where("d is not null").distinct().orderBy("d").toLocalIterator():
        total.update(r.d.encode() + b"\n")
    return "sha256:" + total.hexdigest()


def examples(value: Column, most: int = 8) -> Column:
    """The first ``most`` values in order, and how many more there are. For groups of a bounded size; see :func:`top`."""
    every = F.array_sort(F.collect_set(value))
    rest = F.size(every) - most
    return F.concat(F.array_join(F.slice(every, 1, most), ";"), F.when(rest > 0, F.concat(F.lit(";+"), rest.cast("string"))).otherwise(""))


def top(rows: DataFrame, keys: list[str], value: str, most: int = 8) -> DataFrame:
    """(keys, shown): as :func:`examples`, for groups of any size: a row holds ``most`` values at most."""
    own = rows.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(value))
    first = own.withColumn("_rank", rank).where(F.col("_rank") <= most)
    shown = first.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(value)), ";").alias("_first"))
    total = own.groupBy(*keys).agg(F.count("*").alias("_n"))
    more = F.when(F.col("_n") > most, F.concat(F.lit(";+"), (F.col("_n") - most).cast("string"))).otherwise("")
    return shown.join(total, keys).select(*keys, F.concat("_first", more).alias("shown"))


def names(value: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(value)), ";")


def percent(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.round(100 * part.cast("double") / F.greatest(whole, F.lit(1)).cast("double"), digits)


def breakdown(df: DataFrame, *keys: str, top: int | None = None) -> DataFrame:
    """Rows by key, the most frequent first."""
    out = df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys)
    return out if top is None else out.limit(top)


def histogram(key: Column, n: Column) -> Column:
    """MAP of summed counts in key order; for keys of a small vocabulary."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, n))))
