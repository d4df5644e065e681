"""The corpus pipeline: five stages of training-data operators, each written and read again before the next.

``ORACLE_SQL`` is None: sketches and alignments have no SQL; tests compare ``run`` with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixlake.llm import decontamination, neardup, packing, quality, substrings
from helixlake.llm.common import drop, save, table
from helixlake.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the first by doc_id."""
    return neardup.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 35 that occur elsewhere go; other columns stay as they are."""
    return substrings.remove(docs, window=35)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window close to a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed into sequences of 1024 tokens."""
    return packing.pack_documents(docs, tokenizer(), capacity=1024)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop(before)  # the table of the stage before; the input is not one
    return docs
