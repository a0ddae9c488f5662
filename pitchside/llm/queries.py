"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, centroids, imatch, language_id, line_dedup, lm_score, near_dup, pii, quality_rules, secret_scan, source_mix, token_count, turn_repair
from .common import documents


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_report(documents(spark, sf_dir))


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_edits(documents(spark, sf_dir))


def op3_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return lm_score.score_documents(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(documents(spark, sf_dir))


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules.verdicts(quality_rules.ledger(documents(spark, sf_dir)))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(documents(spark, sf_dir))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir), k=3, least=0.85).select("doc_id", "n_shingles", "component_id", "kept")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir), least_chars=40, least_docs=5)


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turn_repair.repair_report(turn_repair.damaged(rows), rows)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (
    op1_source_mix, op2_imatch, op3_attention_lm, op4_pii, op5_token_count, op6_language_id, op7_bpe,
    op8_quality_rules, op9_secret_scan, op10_near_dup, op11_line_dedup, op12_turn_repair, op13_centroids)}

ORACLE_SQL = {"op8_quality_rules": quality_rules.ORACLE_SQL, "op11_line_dedup": line_dedup.ORACLE_SQL}
