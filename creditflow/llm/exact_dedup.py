"""Exact duplicates by progressive refinement: length, then a hash of the first bytes, then a hash of everything.

The first scan gives each row its length and prefix hash (a few bytes a row). Rows whose length, and then whose
length and prefix hash, nobody shares are unique and leave. Only the rest have their whole content hashed in a
second scan, which finds them by a filter of fixed size; rows that pass it by chance are told apart by their full
hash. Texts of rows that leave never move between machines.

Null counts as an empty text. Of equal texts the row with the largest id stays, a null id counting as the
smallest; rows that repeat text and id stay or go together. An empty table gives an empty result. Other columns
may have any names: rows travel as one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow.llm import common
from creditflow.session import stage

PREFIX_BYTES = 256


def outline(docs: DataFrame, id_column: str, text_column: str, *extra: Column) -> DataFrame:
    """Id, length in bytes and hash of the first bytes of every row, then ``extra``."""
    content = whole_text(text_column)
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.octet_length(content).alias("length"),
        F.xxhash64(F.substring(content, 1, PREFIX_BYTES)).alias("prefix_hash"),
        *extra,
    )


def whole_text(text_column: str) -> Column:
    return F.encode(F.coalesce(F.col(text_column), F.lit("")), "utf-8")


def shared_groups(outlines: DataFrame) -> DataFrame:
    """(length, prefix hash) groups of at least two rows; rows of lengths that occur once leave first.

    The lengths act as a filter of fixed size, so rows are not brought together by length, which copies share. A row
    that passes it by chance is alone in its group.
    """
    lengths = outlines.groupBy("length").agg(F.count("*").alias("n")).where("n > 1").select("length")
    passed = common.with_membership(outlines, lengths, "length").where("may_be_in")
    return passed.groupBy("length", "prefix_hash").agg(F.count("*").alias("n")).where("n > 1")


def candidate_groups(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The (length, prefix hash) groups that need their content read."""
    return stage(shared_groups(stage(outline(docs, id_column, text_column), "text-outlines")), "text-groups")


def duplicate_groups(hashed: DataFrame) -> DataFrame:
    """Of rows with ``doc_id`` and ``full_hash``, the texts that occur at least twice, with the row that stays."""
    return (
        hashed.groupBy("full_hash")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", all_hashes: bool = False) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept``, and ``full_hash``.

    The hash is null where none was needed, unless ``all_hashes`` asks for it.
    """
    groups = candidate_groups(docs, id_column, text_column)
    marked = common.with_membership(
        outline(docs, id_column, text_column, whole_text(text_column).alias("content")), groups, "length", "prefix_hash"
    )
    needed = F.col("may_be_in") | F.lit(all_hashes)
    hashed = stage(marked.select("doc_id", "may_be_in", F.when(needed, F.sha2("content", 256)).alias("full_hash")), "text-hashes")
    # staged, so that the join shuffles both sides and adaptive execution may split a hash of very many copies
    repeated = stage(duplicate_groups(hashed.where("may_be_in")), "duplicate-groups")
    return hashed.join(repeated, "full_hash", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "full_hash",
    )


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they are."""
    groups = candidate_groups(docs, id_column, text_column)
    marked = common.with_membership(
        outline(docs, id_column, text_column, whole_text(text_column).alias("content"), common.whole_row(docs)), groups, "length", "prefix_hash"
    )
    hashed = marked.where("may_be_in").select("doc_id", F.sha2("content", 256).alias("full_hash"), "row")
    repeated = stage(duplicate_groups(hashed.select("doc_id", "full_hash")), "duplicate-groups")
    stays = F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))
    shared = hashed.join(repeated, "full_hash", "left").where(stays).select("row.*")
    return marked.where("not may_be_in").select("row.*").unionByName(shared)
