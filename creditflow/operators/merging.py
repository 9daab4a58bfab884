"""Bins from the bottom up: neighbouring buckets are merged, the least different first.

The second way to bins, beside the greedy split. Every bucket of a variable's histogram is a bin at first. The
neighbours whose bad rates differ least by the chi-square of their 2 x 2 table are merged, the leftmost of equal ones,
until there are few enough bins and all neighbours differ. As long as a bin is below the smallest share, the least
different pair with such a bin is merged, and the rest is looked at again. A heap finds the next pair, so n buckets
cost about n log n.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow import config
from creditflow.operators.binning import ROUND_SCHEMA

# Fixed value: the 95 % quantile of the chi-square distribution with one degree of freedom.
LEAST_CHI_SQUARE = 3.841459


def chi_square(n1: int, bad1: int, n2: int, bad2: int) -> float:
    """How much two bins' bad rates differ; 0 if they are all of one class."""
    bad, n = bad1 + bad2, n1 + n2
    if bad == 0 or bad == n:
        return 0.0
    cross = float(bad1 * (n2 - bad2) - bad2 * (n1 - bad1))
    return float(n) * cross * cross / (float(n1) * float(n2) * float(bad) * float(n - bad))


def merge_buckets(
    n: Sequence[int], bad: Sequence[int], total: int, limit: int, share: float, least: float = LEAST_CHI_SQUARE
) -> list[int]:
    """Numbers of the buckets that bins begin with, the first of them 0."""
    n, bad = list(n), list(bad)
    size = len(n)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    is_bin = [True] * size
    version = [0] * size

    def pair(i: int) -> tuple[float, int, int, int]:
        j = after[i]
        return chi_square(n[i], bad[i], n[j], bad[j]), i, version[i], version[j]

    def merge(i: int) -> None:
        """The bin after ``i`` becomes part of it."""
        j = after[i]
        n[i], bad[i] = n[i] + n[j], bad[i] + bad[j]
        is_bin[j], after[i] = False, after[j]
        if after[j] < size:
            before[after[j]] = i
        version[i] += 1

    heap = [pair(i) for i in range(size - 1)]
    heapq.heapify(heap)

    def join(i: int) -> None:
        merge(i)
        for k in (before[i], i):
            if k >= 0 and after[k] < size:
                heapq.heappush(heap, pair(k))

    bins = size
    while True:
        while heap:
            chi, i, mine, theirs = heap[0]
            if not is_bin[i] or version[i] != mine or after[i] >= size or version[after[i]] != theirs:
                heapq.heappop(heap)
                continue
            if bins <= limit and chi >= least:
                break
            heapq.heappop(heap)
            join(i)
            bins -= 1
        starts = [i for i in range(size) if is_bin[i]]
        small = {i for i in starts if n[i] < share * total}
        touching = [pair(i) for i in starts if after[i] < size and (i in small or after[i] in small)]
        if not touching:
            return starts
        join(min(touching)[1])
        bins -= 1


def merged_rounds(rounds: Sequence[tuple[int, float]] = config.SEARCH_ROUNDS, least: float = LEAST_CHI_SQUARE):
    """The per-variable part, for ``applyInPandas``: the bins of every round, from one variable's bounded histogram."""

    def search(counts: pd.DataFrame) -> pd.DataFrame:
        variable = counts["variable"].iloc[0]
        special = counts[counts["special"]]
        usual = counts[~counts["special"]].sort_values("start")
        n, bad, edge = (usual[c].tolist() for c in ("n", "bad", "start"))
        total, infinity = int(counts["n"].sum()), float("inf")
        rows = []
        for number, (limit, share) in enumerate(rounds, 1):
            if len(special):
                rows.append((variable, number, 0, True, None, None, int(special["n"].sum()), int(special["bad"].sum())))
            starts = merge_buckets(n, bad, total, limit, share, least)
            for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(n)]), 1):
                lo, hi = -infinity if a == 0 else edge[a], infinity if b == len(n) else edge[b]
                rows.append((variable, number, i, False, lo, hi, sum(n[a:b]), sum(bad[a:b])))
        return pd.DataFrame(rows, columns=["variable", "round", "bin_order", "is_special", "lo", "hi", "n", "bad"])

    return search


def merge_search(histogram: DataFrame, **options) -> DataFrame:
    """Bins of every search round for every variable, with their counts."""
    slim = histogram.groupBy("variable", "special", "start").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    return slim.groupBy("variable").applyInPandas(merged_rounds(**options), ROUND_SCHEMA)
