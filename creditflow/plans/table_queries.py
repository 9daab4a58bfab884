"""The registered queries of tables that are kept: versions, batches, files, and state per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow import config
from creditflow.operators import prepare, woe
from creditflow.plans import jobs
from creditflow.plans.queries import FIXED_CUTS, _fitted, _imputed, _job_fit, round_doubles
from creditflow.session import new_path, stage
from creditflow.sources import datasets, versions
from creditflow.sources.tables import preview, read_dictionary, write_bin_reports

HISTORY_COLUMNS = ["LOAN_ID", "USER_ID", "MONTHS_SINCE_LAST_TXN", "SEGMENT"]
FOOTER_COLUMNS = ["TOTAL_TRXNS", "DAYS_SINCE_LAST_TXN", "LOAN_AMOUNT", "LOAN_ID"]


def _summary(rows: DataFrame, *by: str) -> DataFrame:
    cents = F.sum(F.round(F.col("LOAN_AMOUNT") * 100).cast("bigint"))
    return rows.groupBy(*by).agg(F.count("*").alias("loans"), F.sum("BAD_FLAG").cast("bigint").alias("bad"), cents.alias("cents"))


def table_replace(spark, sf):
    """The imputed base is written and then replaced by its train part; both versions are read back."""
    base = stage(_imputed(spark, sf).select("LOAN_ID", "DISBURSED_DATE", "BAD_FLAG", "LOAN_AMOUNT"), "base")
    root = new_path(spark, "table")
    versions.replace_table(base, root)
    versions.replace_table(prepare.train_and_oot(base, config.TRANSACTIONS.split)[0], root)
    first = versions.current_table(spark, root, 1).withColumn("version", F.lit(1))
    return _summary(first.unionByName(versions.current_table(spark, root).withColumn("version", F.lit(2))), "version")


def batch_replace(spark, sf):
    """The base by month; the newest month is written again with other amounts, and the late months are read back."""
    base = versions.with_batch(stage(_imputed(spark, sf).select("LOAN_ID", "DISBURSED_DATE", "BAD_FLAG", "LOAN_AMOUNT"), "base"))
    path = new_path(spark, "batches")
    versions.write_batches(base, path)
    newest = base.agg(F.max(versions.BATCH)).first()[0]
    versions.write_batches(base.where(F.col(versions.BATCH) == newest).withColumn("LOAN_AMOUNT", F.col("LOAN_AMOUNT") * 2), path)
    late = prepare.train_and_oot(base, config.TRANSACTIONS.split)[1].select(versions.BATCH)
    return _summary(versions.read_batches(spark, path, late), versions.BATCH)


def dq_unique_history(spark, sf):
    """Distinct values up to each month from the months' sketches alone, held against the exact counts."""
    batched = versions.with_batch(stage(_imputed(spark, sf).select("DISBURSED_DATE", *HISTORY_COLUMNS), "base"))
    path = new_path(spark, "sketches")
    versions.sketches(batched, HISTORY_COLUMNS).write.parquet(path)
    merged = versions.distinct_over_history(spark.read.parquet(path)).withColumnRenamed("observed", "estimate")
    exact = versions.exact_distinct_over_history(batched, HISTORY_COLUMNS).drop("rows")
    near = F.abs(F.col("estimate") - F.col("observed")) <= versions.MOST_ERROR * F.col("observed")
    return merged.join(exact, [versions.BATCH, "column"]).select(versions.BATCH, "column", "rows", "observed", near.alias("is_near"))


def dq_min_footer(spark, sf):
    """Minima of the saved base from the files' footers."""
    path = new_path(spark, "base")
    _imputed(spark, sf).select(*FOOTER_COLUMNS).write.parquet(path)
    return round_doubles(versions.footer_minima(spark, path, FOOTER_COLUMNS))


def dictionary_csv(spark, sf):
    """The dictionary as a CSV file; the job reads it back to tell numbers from categories."""
    path = new_path(spark, "dictionary")
    datasets.transaction_dictionary(spark).write.csv(path, header=True)
    base = prepare.project_base(datasets.transaction_base(spark, sf, ("core",)))
    imputed = jobs.extract(datasets.transaction_base(spark, sf, ("core",)), read_dictionary(spark, path), config.TRANSACTIONS)
    kinds = prepare.column_kinds(base, read_dictionary(spark, path))
    counts = imputed.agg(*[F.count(c).alias(c) for c in kinds]).unpivot([], list(kinds), "variable", "filled")
    words = read_dictionary(spark, path).select("variables", "Type", "Sno")
    return counts.join(words, F.col("variable") == F.col("variables"), "left").select(
        "variable", F.coalesce("Type", F.lit("Others")).alias("kind"), F.col("Sno").alias("number"), "filled"
    )


def bin_report_files(spark, sf):
    """Accepted, rejected and unresolved bins as three CSV tables, read back with the table that they stand in."""
    _, found, _ = _job_fit(spark, sf)
    folder = new_path(spark, "bin-reports")
    kept = stage(found.select("variable", "round", "bin_order", "count", "bad", "status"), "bins")
    write_bin_reports(kept, folder)
    parts = []
    for status in ("accepted", "rejected", "unresolved"):
        rows = spark.read.csv(f"{folder}/{status}_bins", header=True, schema=kept.schema)
        parts.append(rows.withColumn("file", F.lit(status)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def woe_columns_shape(spark, sf):
    """Only the WOE columns of the transformed base, and its shape."""
    imputed, table = _fitted(spark, sf, FIXED_CUTS)
    (rows, width), _ = preview(woe.woe_columns(woe.woe_wide(imputed, table)))
    columns = woe.woe_columns(woe.woe_wide(imputed, table)).columns
    sums = woe.woe_columns(woe.woe_wide(imputed, table)).agg(*[F.sum(c).alias(c) for c in columns]).unpivot([], columns, "column", "total")
    return round_doubles(sums.withColumns({"rows": F.lit(rows).cast("bigint"), "width": F.lit(width).cast("bigint")}))


TABLE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (table_replace, batch_replace, dq_unique_history, dq_min_footer, dictionary_csv, bin_report_files, woe_columns_shape)
}
