"""One pass over the data: counts of every variable on a decimal grid.

Each value falls into the bucket that starts at the value cut down to its
leading ``digits`` significant digits. The bucket is a function of the value
alone, so the counts do not depend on row order, partitioning or retries, and
two samples (train, out-of-time) share their buckets. There are at most
``9 * 10**(digits - 1)`` buckets per power of ten, however many rows there are.

Where one bucket holds more than ``max_share`` of a variable's rows and more than one
value, that bucket alone is counted again with more digits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow import config
from creditflow.session import stage

SMALLEST = 1e-12
DIGIT_STEPS = (3, 6, 9, 12, 15)


def with_grid_start(df: DataFrame, value: str, digits: int, out: str) -> DataFrame:
    """Add the start of the bucket of ``value``: the largest grid number not above it.

    Grid numbers are whole numbers over (or times) a power of ten, so they are
    the doubles nearest to their printed decimals. The last step settles values
    that the scaling rounded across a grid number.
    """
    names = df.columns
    up = f"pow(10D, cast({digits - 1} - e AS double))"
    down = f"pow(10D, cast(e - {digits - 1} AS double))"

    def grid(k: str) -> str:
        return f"(CASE WHEN e < {digits} THEN ({k}) / scale ELSE ({k}) * scale END)"

    return (
        df.selectExpr(*names, f"floor(log10(abs({value}))) AS guess")
        .selectExpr(*names, f"guess - CASE WHEN abs({value}) < pow(10D, cast(guess AS double)) THEN 1 ELSE 0 END AS e")
        .selectExpr(*names, "e", f"CASE WHEN e < {digits} THEN {up} ELSE {down} END AS scale")
        .selectExpr(
            *names, "e", "scale",
            f"cast(floor(CASE WHEN e < {digits} THEN {value} * scale ELSE {value} / scale END) AS double) AS k",
        )
        .selectExpr(
            *names,
            f"CASE WHEN abs({value}) < {SMALLEST}D THEN CASE WHEN {value} < 0 THEN -{SMALLEST}D ELSE 0D END "
            f"WHEN abs({value}) = double('inf') THEN {value} "
            f"WHEN {value} >= {grid('k + 1')} THEN {grid('k + 1')} "
            f"WHEN {value} < {grid('k')} THEN {grid('k - 1')} ELSE {grid('k')} END AS {out}",
        )
    )


# Spark generates no loop for a step of more than 100 columns, and unpivoting is one: fewer columns at a time take half the time.
COLUMNS_AT_A_TIME = 40


def long_form(
    df: DataFrame, features: Sequence[str], target: str, by: Sequence[str] = ()
) -> DataFrame:
    """(by..., y, variable, value): one row per loan and variable with a known outcome.

    Of a wide table each part of the columns is read by itself; stage it first if it is not read from a file.
    """
    known = df.where(F.col(target).isNotNull())

    def part(names: Sequence[str]) -> DataFrame:
        return known.select(
            *by, F.col(target).cast("bigint").alias("y"), *[F.col(c).cast("double").alias(c) for c in names]
        ).unpivot([*by, "y"], list(names), "variable", "value")

    parts = [part(features[i : i + COLUMNS_AT_A_TIME]) for i in range(0, max(1, len(features)), COLUMNS_AT_A_TIME)]
    return reduce(DataFrame.unionByName, parts)


def is_special(value: str, special: Sequence[float]) -> str:
    """SQL text: whether a value is missing or one of the special values."""
    tests = [f"{value} IS NULL", f"isnan({value})", *[f"{value} = {float(s)!r}D" for s in special]]
    return "(" + " OR ".join(tests) + ")"


def _count(long: DataFrame, keys: Sequence[str], digits: int) -> DataFrame:
    usable = long.withColumn("value", F.when(~F.col("special"), F.col("value")))
    return (
        with_grid_start(usable, "value", digits, "start")
        .groupBy(*keys, "variable", "special", "start")
        .agg(
            F.count("*").alias("n"),
            F.sum("y").alias("bad"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
    )


def variable_histogram(
    df: DataFrame,
    features: Sequence[str],
    target: str = config.TARGET,
    by: Sequence[str] = (),
    special: Sequence[float] = (config.MISSING_NUMERIC,),
    max_share: float = config.HEAVY_SHARE,
    judged_on: str = "true",
) -> DataFrame:
    """Bucket counts per (by..., variable): ``special, start, n, bad, low, high``.

    ``start`` is null in the special bucket. ``judged_on``, a condition on ``by``, says whose rows
    decide which buckets are counted again with more digits; all rows are counted in them.
    """
    long = long_form(df, features, target, by).withColumn("special", F.expr(is_special("value", special)))
    counts = stage(_count(long, by, DIGIT_STEPS[0]), "histogram")
    for coarse, fine in zip(DIGIT_STEPS, DIGIT_STEPS[1:]):
        heavy = _heavy_buckets(counts.where(judged_on), max_share)
        variables = [r["variable"] for r in heavy.select("variable").distinct().collect()]
        if not variables:
            break
        # At most 1 / max_share buckets per variable can be heavy.
        marks = F.broadcast(heavy)
        long = long_form(df, variables, target, by).withColumn("special", F.expr(is_special("value", special)))
        inside = with_grid_start(long.where(~F.col("special")), "value", coarse, "start").join(
            marks, ["variable", "start"], "left_semi"
        )
        refined = _count(inside.drop("start"), by, fine)
        kept = counts.join(marks, ["variable", "start"], "left_anti")
        counts = stage(kept.unionByName(refined), "histogram")
    return counts


def _heavy_buckets(counts: DataFrame, max_share: float) -> DataFrame:
    per_bucket = (
        counts.where(~F.col("special"))
        .groupBy("variable", "start")
        .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    )
    totals = counts.groupBy("variable").agg(F.sum("n").alias("total"))
    return (
        per_bucket.join(totals, "variable")
        .where((F.col("n") > max_share * F.col("total")) & (F.col("low") < F.col("high")))
        .select("variable", "start")
    )
