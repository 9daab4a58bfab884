import numpy as np
import pytest
from helpers import documents
from pyspark.sql import functions as F

from creditflow.llm import common, quality_classifier, sparse, toxicity

SF = "/root/testdata/sf0.1"


def rows(*pairs):
    return sparse.Rows.of([(list(p), list(p.values())) for p in pairs])


def test_sum_of_squares_is_the_sum_over_pairs():
    random = np.random.default_rng(0)
    model = sparse.Model(0.3, random.normal(size=20), random.normal(size=(20, 4)))
    entries = {1: 0.5, 7: -2.0, 12: 1.5, 19: 1.0}
    want = model.bias + sum(model.weights[i] * x for i, x in entries.items())
    keys = list(entries)
    want += sum(model.factors[i] @ model.factors[j] * entries[i] * entries[j] for a, i in enumerate(keys) for j in keys[:a])
    got = model.raw(rows(entries, {}))
    assert got[0] == pytest.approx(want) and got[1] == pytest.approx(model.bias)


def test_pairs_are_learned():
    # the label is that both or neither of two features are there: a linear model gets three of the four cases at most
    random = np.random.default_rng(2)
    a, b = random.integers(0, 2, 2000), random.integers(0, 2, 2000)
    x = rows(*[{i: 1.0 for i, on in ((0, p), (1, 1 - p), (2, q), (3, 1 - q)) if on} for p, q in zip(a, b, strict=True)])
    y = (a == b).astype(float)
    assert ((sparse.fit(x, y, 4, 4, epochs=40).score(x) > 0.5) == y).mean() > 0.95
    rarest = min(((a == p) & (b == q)).mean() for p in (0, 1) for q in (0, 1))
    assert ((sparse.fit(x, y, 4, 0, epochs=40).score(x) > 0.5) == y).mean() <= 1 - rarest


def test_one_kind_of_label():
    assert sparse.fit(rows({0: 1.0}, {1: 1.0}), np.ones(2), 2, 2).score(rows({0: 1.0}))[0] == pytest.approx(0.99)
    assert sparse.fit(rows(), np.zeros(0), 2, 2).score(rows({0: 1.0}))[0] == 0.5


@pytest.fixture(scope="module")
def tables(spark):
    return common.read_documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_on_held_out_rows(spark, tables):
    docs, labels = tables
    remainder = common.crc_remainder("doc_id", 5)
    model = quality_classifier.fit(docs, labels, eligible=remainder != 0)
    scored = quality_classifier.score(docs.where(remainder == 0), model).join(labels, "doc_id")
    by_label = {r["quality"]: r["p"] for r in scored.groupBy("quality").agg(F.avg("predicted").alias("p")).collect()}
    assert by_label[1] > 0.98 and by_label[0] < 0.1
    hard = quality_classifier.score(documents(spark, clashing=True), model).collect()
    assert len(hard) == 13 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in hard)
    assert quality_classifier.score(documents(spark, []), model).count() == 0


def test_toxicity_on_held_out_rows(spark, tables):
    docs, labels = tables
    remainder = common.crc_remainder("doc_id", 5)
    models = toxicity.learn(docs, labels, eligible=remainder != 0)
    assert len(models) == 3
    scored = toxicity.predict(docs.where(remainder == 0), models).drop("toxic").join(labels, "doc_id")
    by_label = {r["toxic"]: r["p"] for r in scored.groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()}
    assert by_label[1] > 0.9 and by_label[0] < 0.01
    hard = toxicity.predict(documents(spark, clashing=True), models).collect()
    assert len(hard) == 13 and all(0 <= r["score"] <= 1 for r in hard)
    assert toxicity.predict(documents(spark, []), models).count() == 0


def test_labels_that_say_nothing(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, None, 5), (None, 1, 1), (6, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(docs, labels)
    assert {round(r["score"], 3) for r in quality_classifier.score(docs, model).collect()} == {0.99}
    assert len(toxicity.predict(docs, toxicity.learn(docs, labels)).collect()) == 13
    nothing = labels.where("doc_id = 77")
    assert {r["score"] for r in quality_classifier.score(docs, quality_classifier.fit(docs, nothing)).collect()} == {0.5}
    assert {r["score"] for r in toxicity.predict(docs, toxicity.learn(docs, nothing)).collect()} == {0.5}


def test_later_models_use_earlier_categories():
    # the second category is the first one's, whatever the text: its model must lean on the chain
    random = np.random.default_rng(4)
    first = random.integers(0, 2, 600)
    found = [sorted({int(x) for x in random.integers(100, 3000, 8)} | ({5} if f else {6})) for f in first]
    models = toxicity.fit_chain(found, np.stack([first, first], axis=1).astype(float))
    assert models[1].weights[toxicity.BUCKETS] > 0
