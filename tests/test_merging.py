"""Merging by chi-square against a plain loop over all pairs; the ROC curve against every threshold."""

import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from creditflow import config
from creditflow.operators import binning, merging, performance
from creditflow.operators.histogram import variable_histogram
from creditflow.plans import jobs


def plain(n, bad, total, limit, share, least=merging.LEAST_CHI_SQUARE):
    """Every step looks at all pairs."""
    bins = [[i, a, b] for i, (a, b) in enumerate(zip(n, bad))]
    while len(bins) > 1:
        chis = [merging.chi_square(x[1], x[2], y[1], y[2]) for x, y in itertools.pairwise(bins)]
        if len(bins) > limit or min(chis) < least:
            at = chis.index(min(chis))
        else:
            touching = [(c, i) for i, c in enumerate(chis) if min(bins[i][1], bins[i + 1][1]) < share * total]
            if not touching:
                break
            at = min(touching)[1]
        bins[at : at + 2] = [[bins[at][0], bins[at][1] + bins[at + 1][1], bins[at][2] + bins[at + 1][2]]]
    return [b[0] for b in bins]


@pytest.mark.parametrize("seed", range(30))
def test_same_as_looking_at_all_pairs(seed):
    rng = np.random.default_rng(seed)
    n = rng.integers(1, 40, (8, 60, 300)[seed % 3])
    bad = rng.binomial(n, np.clip(np.sin(np.arange(len(n)) / 5) * 0.4 + 0.45, 0, 1))
    for limit, share in ((5, 0.05), (2, 0.3), (10, 0.0), (1, 0.0)):
        want = plain(n.tolist(), bad.tolist(), int(n.sum()) + 20, limit, share)
        assert merging.merge_buckets(n.tolist(), bad.tolist(), int(n.sum()) + 20, limit, share) == want
        assert len(want) <= limit


def test_ties_go_to_the_left():
    assert merging.merge_buckets([10] * 6, [2] * 6, 60, 3, 0.0) == [0]
    assert merging.merge_buckets([100, 100, 100, 100], [10, 10, 60, 60], 400, 4, 0.0) == [0, 2]
    assert merging.merge_buckets([], [], 5, 3, 0.1) == []


def test_chi_square():
    assert merging.chi_square(5, 5, 7, 7) == merging.chi_square(5, 0, 7, 0) == 0
    table = np.array([[30, 70], [55, 45]])
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    assert merging.chi_square(100, 30, 100, 55) == pytest.approx(((table - expected) ** 2 / expected).sum())


def test_all_rounds(spark):
    rng = random.Random(4)
    rows = [(float(rng.randrange(300)) if rng.random() > 0.1 else -99999.0, rng.randrange(2)) for _ in range(3000)]
    rows = [(x, int(rng.random() < 0.1 + (x > 150) * 0.5)) for x, _ in rows]
    counts = variable_histogram(spark.createDataFrame(rows, "x double, BAD_FLAG int"), ["x"])
    bins = merging.merge_search(counts).toPandas()
    limits = {i: limit for i, (limit, _) in enumerate(config.SEARCH_ROUNDS, 1)}
    assert sorted(bins["round"].unique()) == list(limits)
    usual = bins[~bins["is_special"]]
    assert (usual.groupby("round").size() <= pd.Series(limits)).all()
    assert (bins.groupby("round")["n"].sum() == 3000).all()
    found = jobs.search_bins(spark.createDataFrame(rows, "x double, BAD_FLAG int").withColumn("z", F.lit(1.0)), ["x", "z"], stop_at_one=False, search=merging.merge_search)
    x = found.where("variable = 'x' AND bin_order > 0").orderBy("bin_order").collect()
    assert [(r["lo"], r["hi"]) for r in x] == [(-np.inf, 151.0), (151.0, np.inf)] and x[0]["status"] == "accepted"


@pytest.mark.parametrize("buckets", [50, 51])
def test_greedy_search_offers_every_bucket(buckets):
    """One bucket more does not change which cuts are offered: the only useful one is found at any place."""
    for at in (1, 7, 24, 49):
        rows = [("x", False, float(i), 10, 9 if i >= at else 1) for i in range(buckets)]
        got = binning.greedy_rounds(rounds=((2, 0.01),))(pd.DataFrame(rows, columns=["variable", "special", "start", "n", "bad"]))
        assert got["hi"].tolist() == [float(at), np.inf]


# --- the curve --------------------------------------------------------------------


def scored_rows(n, values, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = rng.randrange(values) / values
        rows.append((None if i % 17 == 0 else p, None if i % 23 == 0 else int(rng.random() < p)))
    return rows


def curve(rows):
    """From the definition, one threshold after the other; exact corners."""
    known = [(s, y) for s, y in rows if s is not None and y is not None]
    bads, goods = sum(y for _, y in known), sum(1 - y for _, y in known)
    points = [(None, 0, 0)]
    for t in sorted({s for s, _ in known}, reverse=True):
        points.append((t, sum(1 - y for s, y in known if s >= t), sum(y for s, y in known if s >= t)))
    kept = [
        p for k, p in enumerate(points)
        if k in (0, len(points) - 1) or (p[1] - points[k - 1][1]) * (points[k + 1][2] - p[2]) != (points[k + 1][1] - p[1]) * (p[2] - points[k - 1][2])
    ]
    pairs = sum((a > b) + (a == b) / 2 for a, y in known if y for b, z in known if not z)
    return [(t, g / goods, b / bads) for t, g, b in kept], pairs / (bads * goods)


@pytest.mark.parametrize("values", [3, 40, 10**6])
def test_roc(spark, values):
    rows = scored_rows(500, values)
    df = spark.createDataFrame(rows, "p double, BAD_FLAG int").repartition(6)
    want, auc = curve(rows)
    got = sorted(map(tuple, performance.roc_points(df, "p").collect()), key=lambda r: (r[1], r[2]))
    assert [r[0] for r in got] == [w[0] for w in want]
    np.testing.assert_allclose([r[1:] for r in got], [w[1:] for w in want])
    area = performance.roc_area(df, "p").first()
    assert (area["auc"], area["gini"]) == (pytest.approx(auc), pytest.approx(2 * auc - 1))
    # the points that are left out do not change the area
    assert sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in itertools.pairwise(got)) == pytest.approx(auc)


def test_roc_of_one_class_and_of_nothing(spark):
    one = spark.createDataFrame([(0.1, 1), (0.4, 1)], "p double, BAD_FLAG int")
    assert sorted(map(tuple, performance.roc_points(one, "p").collect()), key=str) == [(0.1, None, 1.0), (None, 0.0, 0.0)]
    assert performance.roc_area(one, "p").first()["auc"] is None
    none = spark.createDataFrame([], "p double, BAD_FLAG int")
    assert performance.roc_points(none, "p").count() == 0 and performance.roc_area(none, "p").first()["auc"] is None


def test_no_task_sees_all_scores(spark, capsys):
    df = spark.createDataFrame(scored_rows(300, 10**6), "p double, BAD_FLAG int")
    performance.roc_points(df, "p").explain()
    assert "SinglePartition" not in capsys.readouterr().out
