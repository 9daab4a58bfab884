"""Helpers that several text operators share."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# What counts as white space between words, as a regular expression and as bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WHITE_SPACE = b" \t\n\x0b\x0c\r"

Batches = Iterator[pa.RecordBatch]


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def struct_udf(schema: str, function: Callable[[str | None], tuple]):
    """An Arrow-batched column function from a text to a struct; ``schema`` lists its fields as DDL."""
    kind = StructType.fromDDL(schema)
    fields = list(to_arrow_schema(kind))

    def apply(texts: pa.Array) -> pa.Array:
        rows = [function(x.as_py()) for x in texts]
        columns = zip(*rows, strict=True) if rows else [()] * len(fields)
        return pa.StructArray.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, fields, strict=True)], fields=fields)

    return F.arrow_udf(apply, returnType=kind)


def whole_row(rows: DataFrame) -> Column:
    """All columns as one struct ``row``, so that no name of theirs can clash with an operator's own."""
    return F.struct(*[f"`{c}`" for c in rows.columns]).alias("row")


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def feature_hash(token: bytes, buckets: int) -> int:
    return zlib.crc32(token) % buckets


def release_memory() -> None:
    """Gives freed memory back to the system at the end of a task: workers live on, and later stages need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


# Size of ``row_filter``: this many 64-bit words at most (about 2 MB as a table), whatever the input.
FILTER_WORDS = 1 << 16


def row_filter(keys: DataFrame, *columns: Column | str) -> DataFrame:
    """A bitmap of hashed keys, as at most ``FILTER_WORDS`` rows: every key of ``keys`` is in it, and few others."""
    slot = F.pmod(F.xxhash64(*columns), F.lit(FILTER_WORDS * 64))
    bits = keys.select(slot.alias("slot")).select(F.shiftright("slot", 6).alias("filter_word"), F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bit"))
    return bits.groupBy("filter_word").agg(F.bit_or("bit").alias("filter_bits"))


def with_membership(rows: DataFrame, keys: DataFrame, *columns: Column | str) -> DataFrame:
    """``rows`` with ``may_be_in``: true for every row whose key is in ``keys`` and for few others.

    Broadcasts a bitmap of fixed size, so the rows stay where they are; with very many keys it only lets more pass.
    """
    return (
        rows.withColumn("slot", F.pmod(F.xxhash64(*columns), F.lit(FILTER_WORDS * 64)))
        .withColumn("filter_word", F.shiftright("slot", 6))
        .join(F.broadcast(row_filter(keys, *columns)), "filter_word", "left")
        .withColumn("may_be_in", F.expr("coalesce(filter_bits & shiftleft(1L, cast(slot % 64 as int)), 0L) != 0"))
        .drop("slot", "filter_word", "filter_bits")
    )
