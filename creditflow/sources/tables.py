"""Readers and writers of the pipeline's tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

DICTIONARY_SCHEMA = T.StructType(
    [
        T.StructField("Sno", T.IntegerType()),
        T.StructField("variables", T.StringType()),
        T.StructField("Var", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Type", T.StringType()),
        T.StructField("Trend_Business", T.StringType()),
    ]
)
BIN_SCHEMA = T.StructType(
    [
        T.StructField("variable", T.StringType()),
        T.StructField("bin_order", T.IntegerType()),
        T.StructField("is_special", T.BooleanType()),
        T.StructField("lo", T.DoubleType()),
        T.StructField("hi", T.DoubleType()),
    ]
)
MODEL_SCHEMA = T.StructType(
    [
        T.StructField("model_no", T.LongType()),
        T.StructField("variable", T.StringType()),
        T.StructField("coef", T.DoubleType()),
    ]
)
TREE_SCHEMA = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.LongType()),
        T.StructField("feature", T.StringType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("left", T.LongType()),
        T.StructField("right", T.LongType()),
        T.StructField("leaf", T.DoubleType()),
    ]
)
COMPONENT_SCHEMA = T.StructType(
    [
        T.StructField("component", T.IntegerType()),
        T.StructField("variance", T.DoubleType()),
        T.StructField("cumulative", T.DoubleType()),
    ]
)

ROC_OFFSET_SCHEMA = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("bads_before", T.LongType()),
        T.StructField("goods_before", T.LongType()),
        T.StructField("range_next_bad", T.LongType()),
        T.StructField("range_next_good", T.LongType()),
    ]
)
CORRELATION_SCHEMA = T.StructType(
    [
        T.StructField("a", T.StringType()),
        T.StructField("b", T.StringType()),
        T.StructField("correlation", T.DoubleType()),
    ]
)
COMPONENT_SUMS_SCHEMA = T.StructType(
    [
        T.StructField("components", T.LongType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("squares", T.DoubleType()),
    ]
)

# Columns that the modelling bases use of the given tables. Naming them spares a
# job per table that only reads file footers.
TABLE_SCHEMAS = {
    "customer": "c_custkey bigint, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_extendedprice double, l_shipdate timestamp_ntz",
    "events": "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, value double",
}


def read_given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, with only the columns this engine uses."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def small_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Parameters (bins, coefficients, dictionary) as a table held in the plan.

    Arrow keeps the rows in the plan with a known size, so that joins with them
    are planned by that size and no Python task is started.
    """
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrow = pa.table(
        [pa.array(values, type=to_arrow_type(f.dataType)) for values, f in zip(columns, schema.fields)],
        names=schema.names,
    )
    return spark.createDataFrame(arrow, schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The feature dictionary from a CSV file with a header."""
    return spark.read.csv(path, header=True, schema=DICTIONARY_SCHEMA)


def read_bins(spark: SparkSession, path: str) -> DataFrame:
    """Saved bins, with or without their statistics."""
    return spark.read.parquet(path)


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """Model table (model number, variable, coefficient) from a CSV file."""
    return spark.read.csv(path, header=True, schema=MODEL_SCHEMA)


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace a table; every column name is written in upper case."""
    writer = upper_names(df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*[c.upper() for c in partition_by])
    writer.parquet(path)


def write_bin_reports(bins: DataFrame, folder: str) -> None:
    """Accepted, rejected and unresolved bins as three CSV tables."""
    for status in ("accepted", "rejected", "unresolved"):
        (
            bins.where(F.col("status") == status)
            .write.mode("overwrite")
            .csv(f"{folder}/{status}_bins", header=True)
        )


def write_model(models: DataFrame, path: str) -> None:
    """Save a model table in the form that ``read_model`` reads."""
    models.write.mode("overwrite").csv(path, header=True)


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    """A saved tree table."""
    return spark.read.schema(TREE_SCHEMA).parquet(path)


def write_trees(trees: DataFrame, path: str) -> None:
    """Save a tree table in the form that ``read_trees`` reads."""
    trees.write.mode("overwrite").parquet(path)


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All recorded data-quality runs; empty before the first."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_results(results: DataFrame, path: str) -> DataFrame:
    """Add one run to the history of data-quality runs and return its rows as recorded.

    The run id is part of the key, so a run that is already recorded is refused.
    """
    spark = results.sparkSession
    runs = [r["run_id"] for r in results.select("run_id").distinct().collect()]
    known = read_history(spark, path, results.schema).where(F.col("run_id").isin(runs)).select("run_id").first()
    if known is not None:
        raise ValueError(f"run {known['run_id']} is already recorded")
    results.write.mode("append").parquet(path)
    return read_history(spark, path, results.schema).where(F.col("run_id").isin(runs))


def preview(df: DataFrame, rows: int = 5) -> tuple[tuple[int, int], DataFrame]:
    """Shape of a table and its first rows."""
    return (df.count(), len(df.columns)), df.limit(rows)


def latest_batch(df: DataFrame, batch_column: str | None) -> DataFrame:
    """Only the rows of the newest batch; the whole table if it has none.

    The newest batch is a scalar subquery over one column, so a table that is
    partitioned by the batch column reads only that partition afterwards.
    """
    if batch_column is None:
        return df
    return df.where(df[batch_column] == df.agg(F.max(batch_column)).scalar())
