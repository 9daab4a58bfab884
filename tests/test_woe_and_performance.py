import math
import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from creditflow.operators import binning, performance, woe

CUTS = {"x": [10.0, 20.0], "z": []}


def rows(n=2000, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x = rng.uniform(0, 30)
        out.append((i, None if rng.random() < 0.05 else x, rng.random(), int(rng.random() < 0.5 - x / 80)))
    return out


def loans(spark, data=None):
    return spark.createDataFrame(data or rows(), "LOAN_ID long, x double, z double, BAD_FLAG int")


def fitted(spark, df):
    counts = binning.count_bins(df, CUTS)
    return binning.bin_statistics(binning.with_edges(counts, binning.bins_from_cuts(spark, CUTS)))


def test_long_and_wide_agree(spark):
    df = loans(spark)
    table = woe.woe_table(fitted(spark, df))
    wide = woe.woe_wide(df, table)
    assert woe.woe_columns(wide).columns == ["x_woe", "z_woe"]
    long = {(r["LOAN_ID"], r["variable"]): r["woe"] for r in woe.woe_long(df, table).collect()}
    for r in wide.collect():
        assert r["x_woe"] == long[r["LOAN_ID"], "x"] and r["z_woe"] == long[r["LOAN_ID"], "z"]
    assert len(long) == 2 * 2000


def test_each_value_takes_its_bins_woe(spark):
    df = loans(spark)
    bins = {(b["variable"], b["bin_order"]): b["woe"] for b in fitted(spark, df).collect()}
    table = woe.woe_table(fitted(spark, df))
    probes = [(1, 9.99), (1, -1e9), (2, 10.0), (2, 19.99), (3, 20.0), (3, 1e9), (0, None), (0, -99999.0), (0, float("nan"))]
    got = spark.createDataFrame([(i, v, 0.0) for i, v in probes], "LOAN_ID long, x double, z double").select(
        "LOAN_ID", woe.woe_expression("x", table["x"]).alias("w")
    )
    for r in got.collect():
        assert r["w"] == bins["x", r["LOAN_ID"]]


def test_values_without_a_bin_are_neutral(spark):
    complete = [r for r in rows() if r[1] is not None]
    table = woe.woe_table(fitted(spark, loans(spark, complete)))
    df = loans(spark, [(1, None, 0.5, 0)])
    assert df.select(woe.woe_expression("x", table["x"])).first()[0] == woe.NEUTRAL


def test_target_may_be_missing_when_applying(spark):
    table = woe.woe_table(fitted(spark, loans(spark)))
    assert woe.woe_wide(loans(spark, [(1, 5.0, 0.5, None)]), table).count() == 1


def grouped(spark, pairs):
    df = spark.createDataFrame(pairs, "woe double, y int")
    return df.groupBy("woe").agg(F.count("*").alias("n"), F.sum("y").alias("bad")).withColumn("variable", F.lit("x"))


def test_auc_with_ties(spark):
    auc = performance.rank_auc(grouped(spark, [(1.0, 0), (1.0, 1), (2.0, 0), (2.0, 1)]), ["variable"])
    assert auc.first()["auc"] == 0.5


def test_auc_without_one_class_is_null(spark):
    assert performance.rank_auc(grouped(spark, [(1.0, 0), (2.0, 0)]), ["variable"]).first()["auc"] is None


def test_auc_agrees_with_the_evaluator(spark):
    rng = random.Random(8)
    pairs = [(float(rng.randrange(12)), int(rng.random() < 0.3)) for _ in range(3000)]
    ours = performance.rank_auc(grouped(spark, pairs), ["variable"]).first()["auc"]
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="woe", labelCol="y", numBins=0)
    assert ours == pytest.approx(evaluator.evaluate(spark.createDataFrame(pairs, "woe double, y int")), abs=1e-9)


@pytest.mark.parametrize("slope", [-0.1, 0.1])
def test_gini_equals_that_of_a_fitted_logistic(spark, slope):
    rng = random.Random(9)
    data = []
    for split in ("train", "oot"):
        for _ in range(1500):
            v = float(rng.randrange(6))
            data.append((split, "x", v, int(rng.random() < 0.4 + slope * (v - 2.5))))
    df = spark.createDataFrame(data, "split string, variable string, woe double, y int")
    counts = df.groupBy("split", "variable", "woe").agg(F.count("*").alias("n"), F.sum("y").alias("bad"))
    got = performance.gini_train_oot(counts).first()
    vectors = VectorAssembler(inputCols=["woe"], outputCol="features").transform(df)
    model = LogisticRegression(labelCol="y").fit(vectors.where("split = 'train'"))
    for split, ours in (("train", got["Gini_train"]), ("oot", got["Gini_oot"])):
        scored = model.transform(vectors.where(F.col("split") == split))
        auc = BinaryClassificationEvaluator(labelCol="y", numBins=0).evaluate(scored)
        assert ours == pytest.approx(2 * auc - 1, abs=1e-9)
    assert got["var"] == "x_woe"
    assert got["Relative_diff"] == pytest.approx(abs(got["Gini_train"] - got["Gini_oot"]) / round(got["Gini_train"], 4))


def test_uninformative_variable_has_no_gini(spark):
    data = [(s, "x", 1.0, 10, 4) for s in ("train", "oot")]
    counts = spark.createDataFrame(data, "split string, variable string, woe double, n long, bad long")
    got = performance.gini_train_oot(counts).first()
    assert got["Gini_train"] == 0 and got["Gini_oot"] == 0 and got["Relative_diff"] is None


def test_woe_formula(spark):
    counts = spark.createDataFrame([("x", 1, 50, 10), ("x", 2, 50, 0)], "variable string, bin_order int, n long, bad long")
    bins = {r["bin_order"]: r for r in binning.bin_statistics(counts).collect()}
    assert bins[1]["woe"] == pytest.approx(math.log((10 / 10) / (40 / 90)))
    assert bins[2]["woe"] == pytest.approx(math.log((0.5 / 10) / (50 / 90)))
    assert bins[2]["bin_iv"] == pytest.approx((0.5 / 10 - 50 / 90) * bins[2]["woe"])
    assert bins[2]["bad"] == 0
