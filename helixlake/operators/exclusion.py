"""Record exclusion with an audit, and source filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def excluded(prefixes: list[str], file_classes: list[str] | None = None) -> Column:
    hit = F.exists(F.array(*map(F.lit, prefixes)), lambda p: F.col("name").startswith(p))
    return hit & (F.col("file_class").isin(file_classes) if file_classes else F.lit(True))


def split(records: DataFrame, prefixes: list[str], file_classes: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, audit): both are plain filters of one scan."""
    rule = excluded(prefixes, file_classes)
    return records.where(~rule), records.where(rule).select(F.col("name").alias("record_name"), F.length("residues").alias("residues"))


def mutable_url(url: Column) -> Column:
    return url.contains("/mRNA_Prot/") | url.contains("/current") | url.contains("/latest")


def select(sources: DataFrame, only: list[str] | None = None, kinds: list[str] | None = None, limit: int | None = None) -> DataFrame:
    if only is not None:
        unknown = set(only) - {r.owner for r in sources.where(F.col("owner").isin(only)).select("owner").distinct().collect()}
        if unknown:
            raise ValueError(f"unknown owners: {sorted(unknown)}")
        sources = sources.where(F.col("owner").isin(only))
    if kinds is not None:
        sources = sources.where(F.col("kind").isin(kinds))
    return sources if limit is None else sources.orderBy("kind", "owner", "url").limit(limit)
