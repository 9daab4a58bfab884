"""The registered queries of the text operators, with the parameters that they are run with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow.llm import (
    common,
    divergence,
    exact_dedup,
    katz,
    language_id,
    license_scan,
    ngram_join,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    source_mixing,
    toxicity,
    warc,
)

# Tokens are the ids of byte_bpe_50k.json; this file has the same vocabulary as ranks and gives the same ids faster.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Rows whose crc32 has these remainders are held out from learning.
LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 3, 1
QUALITY_FOLDS, QUALITY_HELD_OUT = 5, 0
MODEL_FOLDS, MODEL_HELD_OUT = 7, 2


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(common.read_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality_probability"
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_documents(spark, sf_dir)
    return ngram_join.near_duplicates(docs, ngram_join.Similarity(words=3, part=90, whole=100)).drop("mark")


def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.read_documents(spark, sf_dir), TOKENIZER)


def op4_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from rows whose crc32(doc_id as text) mod 5 is not 0."""
    docs, labels = common.read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    remainder = common.crc_remainder("doc_id", QUALITY_FOLDS)
    models = toxicity.learn(docs, labels, eligible=remainder != QUALITY_HELD_OUT)
    held_out = F.coalesce(remainder == QUALITY_HELD_OUT, F.lit(False)).alias("held_out")
    return toxicity.predict(docs, models).select("doc_id", held_out, *toxicity.CATEGORIES, "score", "predicted")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_documents(spark, sf_dir)
    return exact_dedup.exact_duplicates(docs, all_hashes=True).withColumnRenamed("full_hash", "text_sha256")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_documents(spark, sf_dir)
    remainder = common.crc_remainder("doc_id", LANGUAGE_FOLDS)
    learned = language_id.learn(docs.where(remainder != LANGUAGE_HELD_OUT))
    held_out = F.coalesce(remainder == LANGUAGE_HELD_OUT, F.lit(False)).alias("held_out")
    return language_id.identify(docs, learned).select("doc_id", held_out, "lang_pred", "score", "accepted")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(common.read_documents(spark, sf_dir)).drop("spans")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix_sizes(common.read_documents(spark, sf_dir))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    remainder = common.crc_remainder("doc_id", QUALITY_FOLDS)
    model = quality_classifier.fit(docs, labels, eligible=remainder != QUALITY_HELD_OUT)
    held_out = F.coalesce(remainder == QUALITY_HELD_OUT, F.lit(False)).alias("held_out")
    return quality_classifier.score(docs, model).select("doc_id", held_out, "score", "predicted")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(common.read_documents(spark, sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = common.crc_remainder("doc_id", MODEL_FOLDS)
    return katz.score_texts(common.read_documents(spark, sf_dir), remainder != MODEL_HELD_OUT, remainder == MODEL_HELD_OUT)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_ngram_jaccard_join, op3_harmonic_packing, op4_toxicity_chain, op5_exact_dedup,
        op6_language_id, op7_license_scan, op8_source_mixing, op9_warc, op10_quality_classifier,
        op11_source_divergence, op12_prefix_trie, op13_katz_backoff,
    )
}
