import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditflow import config
from creditflow.operators import quality, scoring
from creditflow.plans import jobs
from creditflow.session import stage, staging_root
from creditflow.sources import datasets, tables

SF = "/root/testdata/sf0.001"


def woe_rows(spark, n=800):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        a, b = rng.choice([-1.0, 0.2, 0.9]), rng.choice([-0.5, 0.5])
        rows.append((i, int(rng.random() < 1 / (1 + pow(2.718, 0.5 - a - b))), a, b))
    return spark.createDataFrame(rows, "LOAN_ID long, BAD_FLAG int, a_woe double, b_woe double")


def test_scorecard_equals_the_fitted_model(spark):
    df = woe_rows(spark)
    models = scoring.fit_scorecard(df, ["a_woe", "b_woe"], 7)
    ours = {r["LOAN_ID"]: r["p_bad"] for r in scoring.score_scorecard(df, models, 7).collect()}
    vectors = VectorAssembler(inputCols=["a_woe", "b_woe"], outputCol="features").transform(df)
    model = LogisticRegression(labelCol="BAD_FLAG", maxIter=100).fit(vectors)
    p = vector_to_array("probability")[1].alias("p")
    for r in model.transform(vectors).select("LOAN_ID", p).collect():
        assert ours[r["LOAN_ID"]] == pytest.approx(r["p"], abs=1e-6)


def test_scoring_needs_a_known_model(spark):
    with pytest.raises(ValueError, match="no model 2"):
        scoring.score_scorecard(woe_rows(spark), scoring.model_table(spark, 1, 0.1, {"a_woe": 1.0}), 2)


def test_scoring_is_one_projection(spark, capsys):
    models = scoring.model_table(spark, 1, 0.1, {"a_woe": 1.0, "b_woe": 0.5})
    scoring.score_scorecard(stage(woe_rows(spark), "woe"), models, 1).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_model_frame_matches_on_the_key(spark):
    base = spark.createDataFrame(
        [(1, 10, "2020-01-01", 0, 5.0), (2, 20, "2020-01-02", 1, 6.0)], "USER_ID int, LOAN_ID int, DISBURSED_DATE string, BAD_FLAG int, a double"
    )
    woe = spark.createDataFrame([(20, 0.2), (10, 0.1)], "LOAN_ID int, a_woe double")
    frame = scoring.model_frame(base, woe, ["a_woe"])
    assert {r["LOAN_ID"]: (r["a"], r["A_WOE"]) for r in frame.collect()} == {10: (5.0, 0.1), 20: (6.0, 0.2)}


def test_trees_round_trip(spark, tmp_path):
    df = woe_rows(spark)
    model = scoring.fit_trees(df, ["a_woe", "b_woe"], rounds=3, depth=2)
    scoring.save_trees(model, str(tmp_path / "trees"))
    first = sorted(map(tuple, scoring.score_trees(df, model).collect()))
    again = sorted(map(tuple, scoring.score_trees(df, scoring.load_trees(str(tmp_path / "trees"))).collect()))
    assert first == again
    assert all(abs(good + bad - 1) < 1e-9 for _, good, bad in first)


def test_components(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(500):
        a, b = rng.gauss(0, 1), rng.gauss(0, 50)
        rows.append((a, 2 * a, b))
    variance = scoring.explained_variance(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"])
    got = [r["cumulative"] for r in variance.orderBy("component").collect()]
    assert got == sorted(got) and got[-1] == pytest.approx(1)
    assert got[0] == pytest.approx(2 / 3, abs=0.03)
    assert scoring.components_for_share(variance, 0.75).count() == 2


# --- data quality ---------------------------------------------------------------


def test_suite(spark):
    df = spark.createDataFrame([(1, 1), (4, 2), (-99999, 3)], "total_customers int, months_since_last_txn int")
    results = quality.run_suite(df, quality.TEST_SUITE, "r1")
    got = {r["column"]: (r["observed"], r["success"]) for r in results.collect()}
    assert got == {"TOTAL_CUSTOMERS": (-99999.0, False), "MONTHS_SINCE_LAST_TXN": (3.0, True)}
    assert quality.run_success(results).first()["success"] is False
    with pytest.raises(ValueError, match="TOTAL_CUSTOMERS"):
        quality.require_success(results)


def test_both_spellings_of_the_bounds():
    short = quality.Expectation.from_kwargs(quality.MIN_BETWEEN, {"column": "c", "min": 1, "max": 2})
    assert short == quality.Expectation.from_kwargs(quality.MIN_BETWEEN, {"column": "c", "min_value": 1, "max_value": 2})


def test_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(1,), (2,)], "c int")
    checks = [
        quality.Expectation(quality.MIN_BETWEEN, "c", 1, 1),
        quality.Expectation(quality.MIN_BETWEEN, "c", 1.5, None),
        quality.Expectation(quality.UNIQUE_BETWEEN, "c", None, 1),
        quality.Expectation(quality.UNIQUE_BETWEEN, "c", 2, 2),
    ]
    assert [r["success"] for r in quality.run_suite(df, checks).collect()] == [True, False, False, True]


def test_approximate_unique_count(spark):
    df = spark.range(1000).selectExpr("id % 10 AS c")
    check = [quality.Expectation(quality.UNIQUE_BETWEEN, "c", 9, 11)]
    assert quality.run_suite(df, check, approximate=True).first()["success"]


def test_latest_batch(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "batch int, v string")
    assert sorted(r["v"] for r in tables.latest_batch(df, "batch").collect()) == ["b", "c"]
    assert tables.latest_batch(df, None).count() == 3


# --- sources and sinks ------------------------------------------------------------


def test_table_round_trip_in_upper_case(spark, tmp_path):
    path = str(tmp_path / "t")
    for value in (1, 2):
        tables.write_table(spark.createDataFrame([(value, "x")], "a int, b string"), path)
    df = tables.read_parquet(spark, path)
    assert df.columns == ["A", "B"] and [tuple(r) for r in df.collect()] == [(2, "x")]


def test_preview(spark):
    shape, head = tables.preview(spark.range(9).selectExpr("id", "id * 2 AS twice"), 4)
    assert shape == (9, 2) and head.count() == 4


def test_dictionary_and_model_from_csv(spark, tmp_path):
    datasets.transaction_dictionary(spark).write.csv(str(tmp_path / "d"), header=True)
    assert tables.read_dictionary(spark, str(tmp_path / "d")).count() == 199
    scoring.model_table(spark, 3, 0.5, {"a_woe": 1.5}).write.csv(str(tmp_path / "m"), header=True)
    assert scoring.model_coefficients(tables.read_model(spark, str(tmp_path / "m")), 3) == (0.5, {"a_woe": 1.5})


def test_results_are_appended(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "c int")
    for run in ("a", "b"):
        tables.append_results(quality.run_suite(df, [quality.Expectation(quality.MIN_BETWEEN, "c")], run), str(tmp_path / "r"))
    assert tables.read_parquet(spark, str(tmp_path / "r")).count() == 2


def test_stage_uses_the_shared_folder(spark):
    root = staging_root(spark).removeprefix("file:")
    first, second = stage(spark.range(3), "three"), stage(spark.range(4), "three")
    assert (first.count(), second.count()) == (3, 4)
    assert all(f"{root}/three-" in f for f in first.inputFiles())


def test_no_folder_is_made_up_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging_root(Session())


# --- the whole run ------------------------------------------------------------------


def test_transactions_end_to_end(spark, tmp_path):
    data = config.Dataset("transactions", "1995-01-01", "2001-12-31", "2000-06-30", recency_column=None)
    base = datasets.transaction_base(spark, SF, ("core",))
    suite = [quality.Expectation(quality.MIN_BETWEEN, "TOTAL_TRXNS", 0, None)]
    paths = jobs.run(base, datasets.transaction_dictionary(spark), data, str(tmp_path), suite=suite, fail_on_error=True)
    read = lambda name: spark.read.parquet(paths[name])
    bins = read("bins")
    assert {r["status"] for r in bins.select("status").distinct().collect()} <= {"accepted", "rejected", "unresolved"}
    assert "EVER11DPD_IN_90DAYS" not in {r["variable"] for r in bins.select("variable").distinct().collect()}
    assert "SEGMENT" in {r["variable"] for r in bins.select("variable").distinct().collect()}
    per_variable = bins.groupBy("variable").agg(F.sum("count").alias("n")).select("n").distinct().collect()
    assert len(per_variable) == 1
    accepted = bins.where("status = 'accepted'").select("variable").distinct().count()
    assert accepted > 0
    assert read("report").count() == bins.count()
    assert read("woe").count() == read("base").count() == read("scores").count() == 273
    assert len([c for c in read("woe").columns if c.endswith("_WOE")]) == accepted
    assert read("scores").where("P_BAD <= 0 OR P_BAD >= 1 OR P_BAD IS NULL").count() == 0
    written = sum(
        spark.read.csv(f"{paths['bin_reports']}/{s}_bins", header=True).count()
        for s in ("accepted", "rejected", "unresolved")
        if bins.where(F.col("status") == s).count()
    )
    assert written == bins.count()
    # the saved bins and model give the same batch the same scores
    again = jobs.apply_saved(base, datasets.transaction_dictionary(spark), data, paths, str(tmp_path / "later"))
    assert sorted(spark.read.parquet(again["scores"]).collect()) == sorted(read("scores").collect())


def test_activity_end_to_end(spark, tmp_path):
    base = datasets.activity_base(spark, SF)
    paths = jobs.run(base, datasets.activity_dictionary(spark), config.ACTIVITY, str(tmp_path), run_id="may")
    assert spark.read.parquet(paths["woe"]).count() == 199
    assert spark.read.parquet(paths["quality"]).first()["success"]


def test_report_counts_do_not_need_a_second_pass(spark):
    """Train bins counted from the shared histogram equal bins counted from rows."""
    from creditflow.operators import binning, prepare

    base = prepare.project_base(datasets.transaction_base(spark, SF, ("core",)))
    imputed = stage(prepare.impute(base, prepare.column_kinds(base, datasets.transaction_dictionary(spark))), "base")
    found, full = jobs.fit_report(imputed, datasets.transaction_dictionary(spark), ["DAYS_SINCE_LAST_TXN", "LOAN_AMOUNT", "TOTAL_TRXNS"], config.TRANSACTIONS)
    train, _ = prepare.train_and_oot(imputed, config.TRANSACTIONS.split)
    cuts = binning.cuts_of(found)
    direct = {(r["variable"], r["bin_order"]): (r["n"], r["bad"]) for r in binning.count_bins(train, cuts).collect()}
    assert {(r["variable"], r["bin_order"]): (r["count"], r["bad"]) for r in found.collect()} == direct
    assert len(full.columns) == 23 and full.where("Gini_train IS NULL").count() == 0


def test_out_of_time_rows_do_not_change_the_bins(spark):
    """Crowded out-of-time values once merged or refined the buckets that the bins are made of."""
    train = spark.range(4000).selectExpr("1000 + id % 400 / 7.0D AS x", "id % 13 AS z", "cast(hash(id) % 5 < (id % 400) / 130 AS int) AS BAD_FLAG", "DATE'2000-01-01' AS DISBURSED_DATE")
    late = spark.range(50).selectExpr("1000 + id / 3D AS x", "id % 13 AS z", "cast(id % 2 AS int) AS BAD_FLAG", "DATE'2001-01-01' AS DISBURSED_DATE")
    crowd = spark.range(40_000).selectExpr("5D + id % 3 AS x", "id % 5 AS z", "cast(id % 2 AS int) AS BAD_FLAG", "DATE'2001-01-01' AS DISBURSED_DATE")
    words = datasets.transaction_dictionary(spark)

    def bins(rows):
        found, _ = jobs.fit_report(rows, words, ["x", "z"], config.TRANSACTIONS)
        return sorted(map(str, found.select("variable", "bin_order", "lo", "hi", "count", "bad", "status").collect()))

    alone = bins(train.unionByName(late))
    assert len(alone) > 2 and alone == bins(train.unionByName(late).unionByName(crowd))


def test_failing_run_is_recorded_and_not_repeated(spark, tmp_path):
    df, path = spark.range(3).toDF("c"), str(tmp_path / "history")
    suite = [quality.Expectation(quality.MIN_BETWEEN, "c", 1)]
    with pytest.raises(ValueError, match="data quality"):
        jobs.check(df, "monday", path, suite, fail_on_error=True)
    assert [(r["run_id"], r["success"]) for r in spark.read.parquet(path).collect()] == [("monday", False)]
    with pytest.raises(ValueError, match="already recorded"):
        jobs.check(df, "monday", path, suite)
    jobs.check(df.where("c > 0"), "tuesday", path, suite)
    assert {r["run_id"]: r["success"] for r in quality.run_success(spark.read.parquet(path)).collect()} == {"monday": False, "tuesday": True}


def test_many_bins_are_used_whole(spark):
    from creditflow.operators import binning, woe

    bins = spark.range(120_000).selectExpr("'x' AS variable", "cast(id + 1 AS int) AS bin_order", "false AS is_special", "cast(id AS double) AS lo", "0.5D AS woe")
    assert len(binning.cuts_of(bins)["x"]) == 120_000
    assert len(woe.woe_table(bins)["x"]["woe"]) == 120_000


def test_large_model_is_used_whole(spark):
    rows = spark.range(150_000).selectExpr("cast(3 AS bigint) AS model_no", "concat('v', id, '_woe') AS variable", "cast(id AS double) AS coef")
    constant, coefficients = scoring.model_coefficients(rows, 3)
    assert constant == 0 and len(coefficients) == 150_000 and sum(coefficients.values()) == 150_000 * 149_999 / 2


def test_job_queries_cover_every_candidate(spark):
    from creditflow.operators import features
    from creditflow.plans.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    found, full = QUERIES["job_bins"](spark, sf), QUERIES["job_report"](spark, sf)
    candidates = {*features.feature_names(), "LOAN_AMOUNT", "SEGMENT"}
    assert len(candidates) == 199
    assert {r["variable"] for r in found.select("variable").distinct().collect()} == candidates
    key = ["variable", "count", "good", "bad", "woe", "total_iv"]
    assert sorted(map(str, full.select(key).collect())) == sorted(map(str, found.select(key).collect()))
    assert full.where("Gini_train IS NULL").count() == 0
    accepted = {r["variable"] for r in found.where("status = 'accepted'").select("variable").distinct().collect()}
    assert len(accepted) > 8
    coefficients = {r["variable"] for r in QUERIES["scorecard_fit"](spark, sf).collect()}
    assert coefficients == {"const", *(f"{v}_woe" for v in accepted)}
