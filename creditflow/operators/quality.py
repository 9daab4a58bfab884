"""Data-quality expectations: one aggregate for a whole suite."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_BETWEEN = "expect_column_min_to_be_between"
UNIQUE_BETWEEN = "expect_column_unique_value_count_to_be_between"


@dataclass(frozen=True)
class Expectation:
    """A check on one column; the bounds are inclusive and optional."""

    expectation_type: str
    column: str
    min_value: float | None = None
    max_value: float | None = None

    @classmethod
    def from_kwargs(cls, expectation_type: str, kwargs: dict) -> Expectation:
        """Accepts the bounds as ``min``/``max`` as well as ``min_value``/``max_value``."""
        low = kwargs.get("min_value", kwargs.get("min"))
        high = kwargs.get("max_value", kwargs.get("max"))
        return cls(expectation_type, kwargs["column"], low, high)


# The suites that the products run after imputation.
TEST_SUITE = (
    Expectation(UNIQUE_BETWEEN, "MONTHS_SINCE_LAST_TXN"),
    Expectation(MIN_BETWEEN, "TOTAL_CUSTOMERS", 1, 1),
)
ACTIVITY_SUITE = (
    Expectation(UNIQUE_BETWEEN, "DAYS_SINCE_LAST_FACT"),
    Expectation(MIN_BETWEEN, "TOTAL_FACTS", 0),
)


def _observed(check: Expectation, approximate: bool) -> Column:
    if check.expectation_type == MIN_BETWEEN:
        return F.min(check.column).cast("double")
    if check.expectation_type == UNIQUE_BETWEEN:
        count = F.approx_count_distinct if approximate else F.count_distinct
        return count(F.col(check.column)).cast("double")
    raise ValueError(f"unknown expectation {check.expectation_type}")


def run_suite(
    df: DataFrame, suite: Sequence[Expectation] = TEST_SUITE, run_id: str = "run", approximate: bool = False
) -> DataFrame:
    """One result row per expectation, from a single aggregate over the table.

    An expectation of a column that the table does not have fails, with nothing observed.
    """
    columns = {c.upper() for c in df.columns}
    is_known = [c.column.upper() in columns for c in suite]
    nothing = F.lit(None).cast("double")
    observed = df.agg(F.count("*"), *[(_observed(c, approximate) if k else F.max(nothing)).alias(f"o{i}") for i, (c, k) in enumerate(zip(suite, is_known))])
    rows = F.array(
        *[
            F.struct(
                F.lit(run_id).alias("run_id"),
                F.lit(c.expectation_type).alias("expectation_type"),
                F.lit(c.column).alias("column"),
                F.lit(c.min_value).cast("double").alias("min_value"),
                F.lit(c.max_value).cast("double").alias("max_value"),
                F.col(f"o{i}").alias("observed"),
                F.lit(is_known[i]).alias("is_known"),
            )
            for i, c in enumerate(suite)
        ]
    )
    results = observed.select(F.inline(rows))
    within = F.coalesce(F.col("observed") >= F.col("min_value"), F.col("min_value").isNull()) & F.coalesce(
        F.col("observed") <= F.col("max_value"), F.col("max_value").isNull()
    )
    return results.withColumn("success", within & F.col("is_known")).drop("is_known")


def with_run_success(results: DataFrame) -> DataFrame:
    """Add each run's overall outcome to its result rows."""
    return results.withColumn("run_success", F.bool_and("success").over(Window.partitionBy("run_id")))


def run_success(results: DataFrame) -> DataFrame:
    """Overall outcome per run."""
    return results.groupBy("run_id").agg(F.bool_and("success").alias("success"))


def require_success(results: DataFrame) -> None:
    """Raise if any expectation failed (results hold one row per expectation)."""
    failed = [f"{r['expectation_type']}({r['column']})={r['observed']}" for r in results.where(~F.col("success")).collect()]
    if failed:
        raise ValueError("data quality: " + ", ".join(failed))
