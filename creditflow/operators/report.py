"""The bin report: statistics, tests, trend against expectation, performance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditflow.operators.woe import raw_name

# The report's columns in order.
REPORT_COLUMNS = (
    "variable", "var", "bin", "count", "count_distr", "good", "bad", "badprob", "woe", "bin_iv",
    "total_iv", "Prop_iv", "Max_IV_test", "IV_test", "breaks", "is_special_values", "counter",
    "num_bin", "Trend", "Trend_Business", "Gini_train", "Gini_oot", "Relative_diff",
)


def with_trend(tested: DataFrame) -> DataFrame:
    """``Increasing`` if the bad rate rises at any step of the variable, else ``Decreasing``."""
    rises = F.max(F.when(F.col("test") == "Dec", 1).otherwise(0)).over(Window.partitionBy("variable"))
    return tested.withColumn("Trend", F.when(rises == 1, "Increasing").otherwise("Decreasing"))


def bin_report(tested: DataFrame, performance: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row per bin. All three inputs hold bins or variables, never loans."""
    perf = performance.withColumn("var1", raw_name("var"))
    expected = dictionary.select("variables", "Trend_Business")
    return (
        with_trend(tested)
        .join(perf, F.col("variable") == F.col("var1"), "left")
        .join(expected, F.col("variable") == F.col("variables"), "left")
        .withColumn("is_special_values", F.col("is_special"))
        .select(*REPORT_COLUMNS)
    )
