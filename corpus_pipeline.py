"""From raw documents to packed training sequences: five stages over one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditflow.llm import common, exact_dedup, language_id, ngram_join, packing, source_mixing
from creditflow.llm.queries import LANGUAGE_FOLDS, LANGUAGE_HELD_OUT, TOKENIZER
from creditflow.session import stage

# Near duplicates share at least 80 % of their five-word shingles.
NEAR = ngram_join.Similarity(words=5, part=80, whole=100)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; the dictionaries come from the labelled rows that are not held out."""
    learned = language_id.learn(docs.where(common.crc_remainder("doc_id", LANGUAGE_FOLDS) != LANGUAGE_HELD_OUT))
    return language_id.keep_identified(docs, learned)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact_dedup.drop_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the one with the smallest id."""
    return ngram_join.drop_near_duplicates(docs, NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as they are taken."""
    return source_mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences; a document that the mix repeats is packed as often."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact),
    ("ngram_jaccard_join", drop_near),
    ("source_mixing", mix_sources),
    ("harmonic_packing", pack_sequences),
]

# Fitted dictionaries and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents, each written as Parquet and read by the next."""
    docs = common.read_documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
