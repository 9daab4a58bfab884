"""Univariate discrimination of binned variables, in and out of time, and the ROC curve of a score.

A one-variable logistic score is monotone in the variable and its slope has the
sign of the covariance with the target, so its Gini is that sign times the rank
Gini of the variable. No model is fitted: the input is one row per
(sample, variable, WOE value) and everything is a window over those rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditflow import config
from creditflow.functions.expressions import ratio
from creditflow.session import stage
from creditflow.sources.tables import ROC_OFFSET_SCHEMA, small_table


def rank_auc(counts: DataFrame, group: Sequence[str], value: str = "woe") -> DataFrame:
    """Area under the ROC curve of ``value`` per group, ties at their mid-rank.

    ``counts``: ``n`` and ``bad`` per (group, value). Null if a class is absent.
    """
    merged = counts.groupBy(*group, value).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    below = (
        Window.partitionBy(*group).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = merged.withColumn("__below", F.coalesce(F.sum("n").over(below), F.lit(0))).withColumn(
        "__rank", F.col("bad") * (F.col("__below") + (F.col("n") + 1) / F.lit(2.0))
    )
    v = F.col(value)
    sums = ranked.groupBy(*group).agg(
        F.sum("__rank").alias("ranks"),
        F.sum("bad").cast("double").alias("bads"),
        F.sum("n").cast("double").alias("rows"),
        F.sum(F.col("bad") * v).alias("bad_sum"),
        F.sum(F.col("n") * v).alias("sum"),
    )
    goods = F.col("rows") - F.col("bads")
    auc = ratio(F.col("ranks") - F.col("bads") * (F.col("bads") + 1) / 2, F.col("bads") * goods)
    covariance = ratio("bad_sum", "rows") - ratio("sum", "rows") * ratio("bads", "rows")
    return sums.select(*group, auc.alias("auc"), covariance.alias("covariance"))


def gini_train_oot(counts: DataFrame, split: str = "split", value: str = "woe") -> DataFrame:
    """``var, Gini_train, Gini_oot, Relative_diff`` per variable."""
    scored = rank_auc(counts, [split, "variable"], value)
    train = F.col(split) == "train"
    # A covariance this small against shares of rows is rounding noise.
    per_variable = scored.groupBy("variable").agg(
        F.max(F.when(train, F.when(F.abs("covariance") < 1e-12, 0.0).otherwise(F.signum("covariance")))).alias("direction"),
        F.max(F.when(train, F.col("auc"))).alias("auc_train"),
        F.max(F.when(F.col(split) == "oot", F.col("auc"))).alias("auc_oot"),
    )
    gini = {
        name: F.col("direction") * (2 * F.col(f"auc_{name}") - 1) for name in ("train", "oot")
    }
    both = per_variable.select(
        F.concat("variable", F.lit("_woe")).alias("var"),
        gini["train"].alias("Gini_train"),
        gini["oot"].alias("Gini_oot"),
    )
    drop = ratio(F.abs(F.col("Gini_train") - F.col("Gini_oot")), F.round("Gini_train", 4))
    return both.withColumn("Relative_diff", drop)


# --- the curve of a score with any number of values ---------------------------------


def ranked_counts(scored: DataFrame, score: str, target: str = config.TARGET) -> tuple[DataFrame, int, int]:
    """Rows and bad rows per score, from the highest down, with the sums before and after each; then all bad and good rows.

    Scores are dealt to ranges, each range is summed up on its own, and what comes before a range is added: one number
    per range reaches the driver, and no task sees all scores. ``next_good, next_bad`` are those of the next lower score.
    """
    known = scored.where(F.col(target).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    y = F.col(target).cast("bigint")
    counts = known.groupBy(F.col(score).cast("double").alias("score")).agg(F.sum(y).alias("bad"), F.sum(1 - y).alias("good"))
    dealt = counts.repartitionByRange(F.col("score").desc())
    # staged, so that every range keeps its number
    ranges = stage(dealt.withColumn("part", F.spark_partition_id()), "score-ranges")
    highest = F.max_by(F.struct("good", "bad"), "score")
    parts = ranges.groupBy("part").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), highest.alias("first")).orderBy("part").collect()
    rows, bads, goods = [], 0, 0
    for k, p in enumerate(parts):
        follows = parts[k + 1]["first"] if k + 1 < len(parts) else (None, None)
        rows.append((p["part"], bads, goods, follows[1], follows[0]))
        bads, goods = bads + p["bad"], goods + p["good"]
    offsets = small_table(scored.sparkSession, rows, ROC_OFFSET_SCHEMA)
    order = Window.partitionBy("part").orderBy(F.col("score").desc())
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = (
        ranges.withColumns({"bads": F.sum("bad").over(until), "goods": F.sum("good").over(until)})
        .withColumns({"own_next_bad": F.lead("bad").over(order), "own_next_good": F.lead("good").over(order)})
        .join(offsets, "part")
    )
    return (
        summed.select(
            "score", "bad", "good",
            (F.col("bads") + F.col("bads_before")).alias("bads"),
            (F.col("goods") + F.col("goods_before")).alias("goods"),
            F.coalesce("own_next_bad", "range_next_bad").alias("next_bad"),
            F.coalesce("own_next_good", "range_next_good").alias("next_good"),
        ),
        bads,
        goods,
    )


def roc_points(scored: DataFrame, score: str, target: str = config.TARGET) -> DataFrame:
    """``threshold, fpr, tpr``: the share of good and of bad rows that score at least the threshold.

    The first point has no threshold and is (0, 0). A point between two pieces of the same slope is left out. Rows
    without outcome or score do not count; a share of no rows is null.
    """
    ranked, bads, goods = ranked_counts(scored, score, target)

    def wide(name: str) -> Column:
        return F.col(name).cast("decimal(19, 0)")

    bends = wide("bad") * wide("next_good") != wide("next_bad") * wide("good")
    corners = ranked.where(F.col("next_bad").isNull() | bends)
    points = corners.select(F.col("score").alias("threshold"), ratio("goods", F.lit(goods)).alias("fpr"), ratio("bads", F.lit(bads)).alias("tpr"))
    origin = scored.sparkSession.range(1 if bads + goods else 0).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(points)


def roc_area(scored: DataFrame, score: str, target: str = config.TARGET) -> DataFrame:
    """``auc, gini`` of a score with any number of values, ties at one half; null if a class is absent."""
    ranked, bads, goods = ranked_counts(scored, score, target)
    # twice the area in whole pairs; up to 38 digits
    below = F.col("good").cast("decimal(19, 0)") * (2 * F.col("bads") - F.col("bad")).cast("decimal(19, 0)")
    pairs = ranked.agg(F.sum(below).cast("double").alias("twice"))
    auc = ratio(F.col("twice"), F.lit(2.0 * bads * goods))
    return pairs.select(auc.alias("auc"), (2 * auc - 1).alias("gini"))
