"""From raw documents to token ids, stage by stage; every stage's result is written and read again.

Toxic documents go; of each group of near duplicates (five-word shingles, similarity 0.8) the one with the
smallest doc_id stays; documents that hold a benchmark item go; secrets are replaced by a mark in the text;
what is left is encoded. All stages but the last return the columns of their input, whatever they are. The
special inputs of each stage are those of its operator; an empty table passes through as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import decontam, minhash, secrets, toxicity
from tidegate.llm.bpe import encode_texts
from tidegate.llm.common import cut, table, work_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")), threshold=0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.drop_duplicates(docs, size=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item at an edit similarity of 0.8 or more."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"), similarity=0.8)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as token ids."""
    return encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("byte_bpe", encode),
]
#: No stage can be said in SQL: learnt scores, sketches, edit distances, nested decoding and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    folder = work_folder(spark)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)
