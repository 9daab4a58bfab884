"""Tables that are replaced as a whole or by batch, and state that is kept per batch.

A replaced table is a folder with one folder per version and a small table of pointers. A version is written first and
pointed to last, by adding one row, so a reader sees the old table or the new one and never a part of it; a writer that
dies leaves a folder that nothing points to.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditflow.sources.tables import read_history, small_table, upper_names

POINTER_SCHEMA = T.StructType([T.StructField("version", T.LongType()), T.StructField("folder", T.StringType())])


def versions(spark: SparkSession, root: str) -> DataFrame:
    """``version, folder`` of all complete versions; empty before the first."""
    return read_history(spark, f"{root}/pointers", POINTER_SCHEMA)


def newest(spark: SparkSession, root: str, version: int | None = None):
    """The pointer of the newest version, or of the given one. Of two writers of one version the later name counts."""
    known = versions(spark, root)
    if version is not None:
        known = known.where(F.col("version") == version)
    return known.agg(F.max(F.struct("version", "folder")).alias("p")).first()["p"]


def replace_table(df: DataFrame, root: str) -> int:
    """Write ``df`` as the new version of the table, names in upper case, and point to it. Returns its number."""
    spark = df.sparkSession
    last = newest(spark, root)
    version = 1 if last is None else last["version"] + 1
    folder = f"v{version:08d}-{uuid.uuid4().hex}"
    upper_names(df).write.parquet(f"{root}/{folder}")
    point_to(spark, root, version, folder)
    return version


def point_to(spark: SparkSession, root: str, version: int, folder: str) -> None:
    """One row in one file: it is there or it is not."""
    small_table(spark, [(version, folder)], POINTER_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/pointers")


def current_table(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest version, or an older one by its number."""
    pointer = newest(spark, root, version)
    if pointer is None:
        raise ValueError(f"no version of {root}" if version is None else f"no version {version} of {root}")
    return spark.read.parquet(f"{root}/{pointer['folder']}")


# --- batches -------------------------------------------------------------------------

BATCH = "BATCH"


def with_batch(df: DataFrame, date: str = "DISBURSED_DATE") -> DataFrame:
    """Add the batch of each row: the month of its date."""
    return df.withColumn(BATCH, F.date_format(date, "yyyy-MM"))


def write_batches(df: DataFrame, path: str) -> None:
    """Replace the batches that ``df`` has rows of; all others stay as they are."""
    upper_names(df).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(BATCH).parquet(path)


def read_batches(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """The table, or the batches that ``wanted`` lists: its rows decide at run time which folders are read."""
    rows = spark.read.parquet(path)
    return rows if wanted is None else rows.join(wanted.select(BATCH).distinct(), BATCH, "left_semi")


# --- distinct counts over batches ----------------------------------------------------------

# Size of a sketch, as a power of two; its relative error is about 0.8 %, and under MOST_ERROR with near certainty.
SKETCH_SIZE = 14
MOST_ERROR = 0.03


def sketches(df: DataFrame, columns: list[str]) -> DataFrame:
    """``BATCH, column, rows, sketch`` of a batched table, nulls not counted: what a batch adds to the distinct counts."""
    values = df.select(BATCH, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot([BATCH], columns, "column", "value")
    return values.groupBy(BATCH, "column").agg(F.count("*").alias("rows"), F.hll_sketch_agg("value", F.lit(SKETCH_SIZE)).alias("sketch"))


def distinct_over_history(kept: DataFrame) -> DataFrame:
    """``BATCH, column, rows, observed``: rows and distinct values of each column up to each batch, from the sketches alone.

    A sketch is repeated for the batches from its own on; the batches, not the rows of the data, bound that.
    """
    batches = kept.groupBy("column").agg(F.array_sort(F.collect_set(BATCH)).alias("batches"))
    later = kept.join(batches, "column").withColumn("until", F.explode(F.filter("batches", lambda b: b >= F.col(BATCH))))
    merged = later.groupBy(F.col("until").alias(BATCH), "column").agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("whole"))
    return merged.select(BATCH, "column", "rows", F.hll_sketch_estimate("whole").alias("observed"))


def exact_distinct_over_history(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same exactly, from all rows: a value counts from the first batch that has it."""
    values = df.select(BATCH, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot([BATCH], columns, "column", "value")
    first = values.groupBy("column", "value").agg(F.min(BATCH).alias(BATCH)).groupBy(BATCH, "column").agg(F.count("value").alias("fresh"))
    rows = values.groupBy(BATCH, "column").agg(F.count("*").alias("rows")).join(first, [BATCH, "column"], "left")
    batches = rows.groupBy("column").agg(F.array_sort(F.collect_set(BATCH)).alias("batches"))
    later = rows.join(batches, "column").withColumn("until", F.explode(F.filter("batches", lambda b: b >= F.col(BATCH))))
    return later.groupBy(F.col("until").alias(BATCH), "column").agg(F.sum("rows").alias("rows"), F.coalesce(F.sum("fresh"), F.lit(0)).alias("observed"))


# --- minima from footers -----------------------------------------------------------------


def footer_minima(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """One row with the minimum of each column of a Parquet table, taken from the files' footers without reading rows.

    Runs in a session of its own, because the reader that can do this is chosen by a session setting.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(*[F.min(c).alias(c) for c in columns])
