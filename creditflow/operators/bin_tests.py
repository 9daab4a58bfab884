"""Acceptance tests on fitted bins: monotonic bad rate, share of information value.

Everything here is a window over bins, not over loans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditflow import config
from creditflow.functions.expressions import ratio


def monotonic_check(bins: DataFrame, group: Sequence[str] = ("variable",)) -> DataFrame:
    """Compare each bin's bad rate with the one before it.

    ``test`` is ``Inc`` where the earlier bin's rate is higher, ``Dec`` where it
    is lower, ``NA`` for the first bin, ties, and the bin after a missing one.
    A variable is ``NonMono`` if both directions occur.
    """
    order = Window.partitionBy(*group).orderBy("bin_order")
    whole = Window.partitionBy(*group)
    before, rate = F.col("badprob_lag"), F.col("badprob")
    comparable = (F.col("counter") >= 2) & (F.col("missing_bin_lag") != 1)

    def occurrences(label: str):
        return F.sum(F.when(F.col("test") == label, 1).otherwise(0)).over(whole)

    return (
        bins.withColumn("missing_bin", F.col("is_special").cast("int"))
        .withColumn("counter", F.row_number().over(order))
        .withColumn("badprob_lag", F.lag("badprob").over(order))
        .withColumn("missing_bin_lag", F.lag("missing_bin").over(order))
        .withColumn(
            "test",
            F.when(comparable & (before > rate), "Inc").when(comparable & (before < rate), "Dec").otherwise("NA"),
        )
        .withColumn("Inc_cnt", occurrences("Inc"))
        .withColumn("Dec_cnt", occurrences("Dec"))
        .withColumn("Na_cnt", occurrences("NA"))
        .withColumn("break_missing", F.sum("missing_bin").over(whole))
        .withColumn("num_bin", F.count("*").over(whole))
        .withColumn("mtest", F.when((F.col("Inc_cnt") > 0) & (F.col("Dec_cnt") > 0), "NonMono").otherwise("Mono"))
    )


def iv_share_test(
    bins: DataFrame, group: Sequence[str] = ("variable",), smallest: float = config.MIN_BIN_IV_SHARE
) -> DataFrame:
    """Flag ordinary bins that carry less than ``smallest`` of the variable's IV."""
    whole = Window.partitionBy(*group)
    thin = (F.col("Prop_iv") < smallest) & ~F.col("is_special")
    return (
        bins.withColumn("Max_iv", F.max("total_iv").over(whole))
        .withColumn("Prop_iv", ratio("bin_iv", "total_iv"))
        .withColumn("IV_test", F.when(thin, 1).otherwise(0))
        .withColumn("Max_IV_test", F.max("IV_test").over(whole))
    )


def decide(bins: DataFrame, threshold: float = config.IV_THRESHOLD) -> DataFrame:
    """``status`` per bin row: accepted, rejected or unresolved (same for a variable)."""
    strong = F.col("Max_iv") >= threshold
    shape = (
        (F.col("mtest") == "Mono")
        | (F.col("num_bin") == 2)
        | ((F.col("break_missing") > 0) & (F.col("num_bin") == 3))
    )
    accepted = strong & (F.col("Max_IV_test") == 0) & shape
    rejected = F.col("Max_iv") < threshold
    return (
        bins.withColumn("Accept_flag", F.when(accepted, 1).otherwise(0))
        .withColumn("status", F.when(rejected, "rejected").when(accepted, "accepted").otherwise("unresolved"))
        .withColumn("Issue_bin", F.when(F.col("status") == "unresolved", 1).otherwise(0))
    )


def test_bins(bins: DataFrame, group: Sequence[str] = ("variable",)) -> DataFrame:
    """All acceptance tests and the decision."""
    return decide(iv_share_test(monotonic_check(bins, group), group))


test_bins.__test__ = False


def variable_counts(tested: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many variables are accepted, rejected and unresolved."""
    return tested.groupBy(*by, "status").agg(F.countDistinct("variable").alias("variables"))


def settling_rounds(tested: DataFrame, rounds: int, stop_at_one: bool = True) -> DataFrame:
    """(variable, round): the round that settles each variable.

    A variable is settled by the first round that accepts or rejects it and
    leaves the search. With ``stop_at_one`` the search ends as soon as a single
    variable is left, so that one keeps the bins of the last round that ran and
    stays unresolved, like any variable that no round settles. A search that
    begins with one variable runs one round and keeps that round's status.
    """
    per_round = tested.select("variable", "round", "status").distinct()
    settled = per_round.groupBy("variable").agg(
        F.coalesce(F.min(F.when(F.col("status") != "unresolved", F.col("round"))), F.lit(rounds + 1)).alias("settled")
    )
    last = F.lit(rounds)
    if stop_at_one:
        # Round r runs while two variables settle in r or later, so the last
        # round is the second latest settling one. One row per variable here.
        latest_first = Window.orderBy(F.desc("settled")).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        settled = settled.withColumn("second", F.nth_value("settled", 2).over(latest_first))
        last = F.least(F.lit(rounds), F.coalesce("second", F.lit(1)))
    return settled.select("variable", F.least(F.col("settled"), last).alias("round"))


def final_round(tested: DataFrame, rounds: int, stop_at_one: bool = True) -> DataFrame:
    """Each variable's bins in the round that settles it."""
    return tested.join(settling_rounds(tested, rounds, stop_at_one), ["variable", "round"])


def round_counts(tested: DataFrame, rounds: int, stop_at_one: bool = True) -> DataFrame:
    """Per round: how many of the variables still in the search it accepts, rejects, leaves open."""
    ends = settling_rounds(tested, rounds, stop_at_one).withColumnRenamed("round", "last_round")
    ran = tested.join(ends, "variable").where(F.col("round") <= F.col("last_round"))
    return variable_counts(ran, ["round"])
