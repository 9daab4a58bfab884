"""Bins: statistics, fixed cut points, and the supervised search for cut points."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditflow import config
from creditflow.functions.expressions import bin_number, information_value, ratio, weight_of_evidence
from creditflow.operators.histogram import is_special
from creditflow.sources.tables import BIN_SCHEMA, small_table

INFINITY = float("inf")


# --- statistics ---------------------------------------------------------------


def bin_statistics(counts: DataFrame, group: Sequence[str] = ("variable",)) -> DataFrame:
    """Add share, bad rate, weight of evidence and information value to bin counts.

    ``counts`` has one row per (group, bin) with ``n`` and ``bad``. All totals
    are windows over these few rows.
    """
    w = Window.partitionBy(*group)
    return (
        counts.withColumnRenamed("n", "count")
        .withColumn("good", F.col("count") - F.col("bad"))
        .withColumn("count_distr", ratio("count", F.sum("count").over(w)))
        .withColumn("badprob", ratio("bad", "count"))
        .withColumn("__goods", F.sum("good").over(w))
        .withColumn("__bads", F.sum("bad").over(w))
        .withColumn(
            "woe", weight_of_evidence(F.col("good"), F.col("bad"), F.col("__goods"), F.col("__bads"))
        )
        .withColumn(
            "bin_iv", information_value(F.col("good"), F.col("bad"), F.col("__goods"), F.col("__bads"))
        )
        .withColumn("total_iv", F.sum("bin_iv").over(w))
        .drop("__goods", "__bads")
    )


def bin_labels(bins: DataFrame) -> DataFrame:
    """Add the printed ``bin`` and ``breaks`` (upper edge) of each bin."""
    lo = F.when(F.col("lo") == -INFINITY, "-inf").otherwise(F.col("lo").cast("string"))
    hi = F.when(F.col("hi") == INFINITY, "inf").otherwise(F.col("hi").cast("string"))
    return bins.withColumn(
        "bin", F.when(F.col("is_special"), "missing").otherwise(F.concat(F.lit("["), lo, F.lit(","), hi, F.lit(")")))
    ).withColumn("breaks", F.when(F.col("is_special"), "missing").otherwise(hi))


# --- fixed cut points ---------------------------------------------------------


def bins_from_cuts(spark: SparkSession, cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """Bins of given ascending cut points; bin 0 is the special bin."""
    rows = []
    for variable, points in cuts.items():
        edges = [-INFINITY, *[float(p) for p in points], INFINITY]
        rows.append((variable, 0, True, None, None))
        rows += [(variable, i, False, edges[i - 1], edges[i]) for i in range(1, len(edges))]
    return small_table(spark, rows, BIN_SCHEMA)


def cuts_of(bins: DataFrame) -> dict[str, list[float]]:
    """The finite lower edges of each variable's bins, ascending.

    Bins are model parameters (variables x bin limit), so they fit on the driver.
    """
    rows = bins.where(~F.col("is_special")).select("variable", "lo").distinct().collect()
    cuts: dict[str, list[float]] = {}
    for row in rows:
        cuts.setdefault(row["variable"], [])
        if row["lo"] is not None and row["lo"] != -INFINITY:
            cuts[row["variable"]].append(row["lo"])
    return {v: sorted(points) for v, points in cuts.items()}


def bin_order_expression(
    column: str, cuts: Sequence[float], special: Sequence[float] = (config.MISSING_NUMERIC,)
) -> Column:
    """Number of the bin a value falls into: 0 for special values, then ascending."""
    value = f"cast({column} as double)"
    return F.expr(f"CASE WHEN {is_special(value, special)} THEN 0 ELSE {bin_number(value, cuts)} END")


def assign_bins_long(
    df: DataFrame,
    cuts: Mapping[str, Sequence[float]],
    keep: Sequence[str],
    special: Sequence[float] = (config.MISSING_NUMERIC,),
) -> DataFrame:
    """(keep..., variable, bin_order): one row per loan and variable.

    The lookup is an expression per column, so the data is not joined or
    shuffled; a join on ``variable`` would send each variable to one task.
    """
    numbers = [bin_order_expression(v, points, special).alias(v) for v, points in cuts.items()]
    return df.select(*keep, *numbers).unpivot(list(keep), list(cuts), "variable", "bin_order")


def count_bins(
    df: DataFrame,
    cuts: Mapping[str, Sequence[float]],
    target: str = config.TARGET,
    by: Sequence[str] = (),
    special: Sequence[float] = (config.MISSING_NUMERIC,),
) -> DataFrame:
    """``n`` and ``bad`` per (by..., variable, bin) at fixed cut points."""
    labelled = df.where(F.col(target).isNotNull()).withColumn("y", F.col(target).cast("bigint"))
    return (
        assign_bins_long(labelled, cuts, [*by, "y"], special)
        .groupBy(*by, "variable", "bin_order")
        .agg(F.count("*").alias("n"), F.sum("y").alias("bad"))
    )


def with_edges(counts: DataFrame, bins: DataFrame) -> DataFrame:
    """Add ``is_special, lo, hi`` to counted bins (both sides hold only bins)."""
    return counts.join(bins.select("variable", "bin_order", "is_special", "lo", "hi"), ["variable", "bin_order"])


# --- search for cut points ----------------------------------------------------

ROUND_SCHEMA = (
    "variable string, round int, bin_order int, is_special boolean, "
    "lo double, hi double, n bigint, bad bigint"
)


def greedy_rounds(
    rounds: Sequence[tuple[int, float]] = config.SEARCH_ROUNDS,
    min_gain: float = config.MIN_IV_GAIN,
):
    """The per-variable part of the search, for ``applyInPandas``.

    Its input is one variable's histogram, whose size the decimal grid bounds.
    For each smallest share it splits greedily by information value, with every
    bucket's start as a possible cut; a bin limit just stops that sequence
    earlier. It returns the bins of every round.
    """

    def search(counts: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        variable = counts["variable"].iloc[0]
        special = counts[counts["special"]]
        usual = counts[~counts["special"]].sort_values("start")
        n, bad, start = (usual[c].to_numpy() for c in ("n", "bad", "start"))
        total = int(counts["n"].sum())
        bads = float(counts["bad"].sum())
        goods = total - bads

        cum_n = np.concatenate([[0], np.cumsum(n)])
        cum_bad = np.concatenate([[0], np.cumsum(bad)])

        def segment_iv(left, right):
            b = cum_bad[right] - cum_bad[left]
            g = (cum_n[right] - cum_n[left]) - b
            pb, pg = np.where(b == 0, 0.5, b) / bads, np.where(g == 0, 0.5, g) / goods
            return (pb - pg) * np.log(pb / pg)

        def split_sequence(share, limit):
            cuts, candidates, last = [], np.arange(1, len(n)), len(n)
            if not last or bads == 0 or goods == 0:
                return cuts
            iv = segment_iv(0, last)
            while len(cuts) + 1 < limit and len(candidates):
                bounds = np.sort(np.array([0, *cuts, last]))
                at = np.searchsorted(bounds, candidates, side="right")
                left, right = bounds[at - 1], bounds[at]
                large = (cum_n[candidates] - cum_n[left] >= share * total) & (
                    cum_n[right] - cum_n[candidates] >= share * total
                )
                candidates, left, right = candidates[large], left[large], right[large]
                if not len(candidates):
                    break
                gain = (
                    segment_iv(left, candidates) + segment_iv(candidates, right) - segment_iv(left, right)
                )
                best = int(np.argmax(gain))
                if gain[best] <= 0 or gain[best] < min_gain * iv:
                    break
                iv += gain[best]
                cuts.append(int(candidates[best]))
                candidates = np.delete(candidates, best)
            return cuts

        longest = max((limit for limit, _ in rounds), default=1)
        sequences = {share: split_sequence(share, longest) for share in {s for _, s in rounds}}
        rows = []
        for number, (limit, share) in enumerate(rounds, 1):
            if len(special):
                rows.append((variable, number, 0, True, None, None, int(special["n"].sum()), int(special["bad"].sum())))
            if not len(n):
                continue
            bounds = [0, *sorted(sequences[share][: limit - 1]), len(n)]
            for i, (a, b) in enumerate(zip(bounds, bounds[1:]), 1):
                lo = -np.inf if a == 0 else float(start[a])
                hi = np.inf if b == len(n) else float(start[b])
                rows.append((variable, number, i, False, lo, hi, int(cum_n[b] - cum_n[a]), int(cum_bad[b] - cum_bad[a])))
        names = ["variable", "round", "bin_order", "is_special", "lo", "hi", "n", "bad"]
        return pd.DataFrame(rows, columns=names)

    return search


def search_rounds(histogram: DataFrame, **options) -> DataFrame:
    """Bins of every search round for every variable, with their counts."""
    slim = histogram.groupBy("variable", "special", "start").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad")
    )
    return slim.groupBy("variable").applyInPandas(greedy_rounds(**options), ROUND_SCHEMA)


# --- categories ---------------------------------------------------------------


def category_scores(
    df: DataFrame, columns: Sequence[str], target: str = config.TARGET
) -> DataFrame:
    """(variable, category, score): each category's bad rate on a 1/1000 grid.

    Binning a category means binning this score, so the numeric search applies
    unchanged and sees at most 1001 distinct scores, however many categories.
    """
    return (
        df.where(F.col(target).isNotNull())
        .select(F.col(target).cast("bigint").alias("y"), *[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot(["y"], list(columns), "variable", "category")
        .groupBy("variable", "category")
        .agg(F.floor(ratio(F.sum("y"), F.count("*")) * 1000).alias("milli"))
        .select("variable", "category", (F.col("milli") / F.lit(1000.0)).alias("score"))
    )


def score_categories(df: DataFrame, columns: Sequence[str], scores: DataFrame) -> DataFrame:
    """Replace each categorical column by its category's score.

    A category without a score (unseen when fitted) becomes null. Spark
    broadcasts a variable's categories if they are small and shuffles if not.
    """
    for column in columns:
        lookup = scores.where(F.col("variable") == column).select(
            F.col("category").alias(column), F.col("score").alias("__score")
        )
        df = df.join(lookup, column, "left").withColumn(column, F.col("__score")).drop("__score")
    return df
