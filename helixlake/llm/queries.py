"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dac, decontamination, lm, neardup, packing, quality, sharding, substrings, toxicity, urls
from .common import save, table

SHARD_BYTES = 1 << 20
LM_DIGITS = 4


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"), window=35)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels.where(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer(), capacity=1024)


def op7_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), SHARD_BYTES)


def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of labelled documents (a path's last number is the document's id): block those of low quality or toxic."""
    labels = table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("block"))
    number = F.regexp_extract("url", r"/(\d{1,18})(?:[/.?#][^/]*)?$", 1)
    return table(spark, sf_dir, "pages").select("url", F.when(number != "", number.cast("long")).alias("doc_id")).join(labels, "doc_id").select("url", "block")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), labelled_urls(spark, sf_dir))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = save(dac.segments(table(spark, sf_dir, "documents"), tokenizer()), "dac", compression="none")
    return dac.documents(files)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm.score(table(spark, sf_dir, "documents"), order=3)
    return out.select("doc_id", "n_words", *(F.round(c, LM_DIGITS).alias(c) for c in ("log_score", "mean_log_score")))


SHARDING_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
        lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT), 60, '0') AS bits FROM documents),
    p AS (SELECT doc_id, n_bytes, k AS depth, substr(bits, 1, k) AS shard FROM d, range(0, 41) AS t(k)),
    s AS (SELECT depth, shard, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS c FROM p GROUP BY ALL),
    f AS (SELECT p.*, s.shard_bytes FROM p JOIN s USING (depth, shard) WHERE shard_bytes <= {SHARD_BYTES} OR c = 1)
SELECT doc_id, n_bytes, shard, depth::INTEGER AS depth, shard_bytes, shard_bytes > {SHARD_BYTES} AS oversized
FROM f QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_extendible_sharding": op7_extendible_sharding,
    "op8_url_filter": op8_url_filter,
    "op9_token_ids": op9_token_ids,
    "op10_lm_scoring": op10_lm_scoring,
}

ORACLES: dict[str, str] = {
    "op1_quality_rules": quality.oracle_sql(),
    "op3_substring_dedup": substrings.oracle_sql(35),
    "op7_extendible_sharding": SHARDING_SQL,
    "op10_lm_scoring": lm.oracle_sql(LM_DIGITS),
}
