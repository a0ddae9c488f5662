"""A training-data pipeline of five stages over the table of documents.

Each stage takes the rows that the one before it kept, as a Parquet table that was
written and read again, so a lost executor costs a part of one stage only. All but
the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pitchside.llm import bpe, language_id, near_dup, pii, source_mix
from pitchside.llm.common import few_parts
from pitchside.llm.queries import tokenizer_file
from pitchside.session import ensure_checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language is uncertain, go."""
    return language_id.with_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8) stays."""
    return few_parts(near_dup.deduplicated(docs, k=5, least=0.8))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    return few_parts(pii.redacted(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix of sources takes."""
    return source_mix.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, round_trip of every row."""
    return bpe.encode(docs, tokenizer_file("byte_bpe_50k.json"), ["doc_id", "lang", "source"])


STAGES = [
    ("language_id", language),
    ("near_dup", near_duplicates),
    ("pii", personal_data),
    ("source_mix", mix),
    ("bpe", encode),
]

#: The stages learn models and hash sets, which SQL can't express; the tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex[:12]}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
