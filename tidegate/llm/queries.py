"""The registered query of every training-data operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import decontam, langid, lm_corpus, minhash, periods, prefixes, quality, repeats, toxicity, warc
from tidegate.llm.bpe import encode_texts
from tidegate.llm.common import table, work_folder
from tidegate.llm.counts import count_tokens
from tidegate.llm.secrets import find_secrets
from tidegate.llm.twins import SQL as SQL


def secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return find_secrets(table(spark, sf, "documents"))


def language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return langid.identify(docs, langid.learn(docs))


def benchmark_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"), similarity=0.8)


def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return quality.judge(docs, quality.learn(docs))


def warc_archive(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark)
    warc.write_archives(table(spark, sf, "pages"), folder, shard_bytes=32 << 20, roll_bytes=16 << 20)
    return warc.read_archives(spark, folder)


def lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm_corpus.score_corpus(table(spark, sf, "documents"))


def toxic_passages(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.score_texts(docs, toxicity.learn(docs, table(spark, sf, "labels")))


def byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_texts(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN, keep_ids=False)


def near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"), size=3, percent=85)


def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf, "conversations"))


def repeated_strings(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf, "documents"))


def periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periods.periodic_runs(table(spark, sf, "documents"), planting=periods.planted)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": secret_scan,
    "op2_language_id": language_id,
    "op3_benchmark_leaks": benchmark_leaks,
    "op4_quality_rules": quality_rules,
    "op5_warc_archive": warc_archive,
    "op6_byte_bpe": byte_bpe,
    "op7_lm_scores": lm_scores,
    "op8_toxic_passages": toxic_passages,
    "op9_minhash_near_dedup": near_duplicates,
    "op10_token_counts": token_counts,
    "op11_prefix_trie": prefix_trie,
    "op12_repeated_strings": repeated_strings,
    "op13_periodic_runs": periodic_runs,
}
