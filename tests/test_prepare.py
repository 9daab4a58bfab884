import datetime as dt

import pytest
from pyspark.errors import PySparkException

from creditflow import config
from creditflow.operators import features, prepare, woe
from creditflow.sources.tables import DICTIONARY_SCHEMA


def dictionary(spark):
    rows = [
        (1, "AMOUNT", "AMOUNT_woe", "", "Numerical", "Decreasing"),
        (2, "SEGMENT", "SEGMENT_woe", "", "Categorical", "Decreasing"),
    ]
    return spark.createDataFrame(rows, DICTIONARY_SCHEMA)


def test_catalog_grid():
    names = features.feature_names()
    assert len(names) == len(set(names)) == 197
    assert len(features.tree_model_features()) == 154
    assert sum(features.expected_trend(n) == "Increasing" for n in names) == 14
    assert set(features.TWO_DECIMALS) <= set(names)


def test_impute(spark):
    rows = [(1, 1.0, "A", 1), (2, None, None, None), (3, float("nan"), "--", 0)]
    df = spark.createDataFrame(rows, "LOAN_ID long, AMOUNT double, SEGMENT string, BAD_FLAG int")
    kinds = prepare.column_kinds(df, dictionary(spark))
    assert kinds == {"LOAN_ID": "Others", "AMOUNT": "Numerical", "SEGMENT": "Categorical", "BAD_FLAG": "Others"}
    got = sorted(map(tuple, prepare.impute(df, kinds).collect()))
    assert got == [(1, 1.0, "A", 1), (2, -99999.0, "missing", None), (3, -99999.0, "missing", 0)]


def test_impute_casts_strictly(spark):
    df = spark.createDataFrame([("1.5",), (None,)], "AMOUNT string")
    assert sorted(r[0] for r in prepare.impute(df, {"AMOUNT": "Numerical"}).collect()) == [-99999.0, 1.5]
    bad = spark.createDataFrame([("--",)], "AMOUNT string")
    with pytest.raises(PySparkException, match="not a number"):
        prepare.impute(bad, {"AMOUNT": "Numerical"}).collect()


def test_sample_window_edges(spark):
    stamps = ["2021-07-31 23:59:00", "2021-08-01 00:00:00", "2022-07-31 23:59:00", "2022-08-01 00:00:00"]
    rows = [(i, dt.datetime.fromisoformat(s), 1.0) for i, s in enumerate(stamps)]
    rows += [(10 + i, dt.datetime(2022, 1, 1), d) for i, d in enumerate((90.0, 91.0, None))]
    df = spark.createDataFrame(rows, "LOAN_ID int, DISBURSED_DATE timestamp_ntz, DAYS_SINCE_LAST_TXN double")
    kept = prepare.sample_window(df, config.START_DATE, config.END_DATE).collect()
    assert sorted(r["LOAN_ID"] for r in kept) == [1, 2, 10]
    everyone = prepare.sample_window(df, config.START_DATE, config.END_DATE, recency=None).collect()
    assert sorted(r["LOAN_ID"] for r in everyone) == [1, 2, 10, 11, 12]


def test_split_edges(spark):
    rows = [(1, dt.date(2022, 6, 30)), (2, dt.date(2022, 7, 1)), (3, None)]
    df = spark.createDataFrame(rows, "LOAN_ID int, DISBURSED_DATE date")
    assert {r["LOAN_ID"]: r["split"] for r in prepare.with_split(df, config.SPLIT_DATE).collect()} == {
        1: "train", 2: "oot", 3: None,
    }
    train, oot = prepare.train_and_oot(df, config.SPLIT_DATE)
    assert [r["LOAN_ID"] for r in train.collect()] == [1]
    assert [r["LOAN_ID"] for r in oot.collect()] == [2]


def test_candidates_leave_out_every_outcome(spark):
    columns = "USER_ID long, LOAN_ID long, DISBURSED_DATE date, BAD_FLAG int, EVER11DPD_IN_90DAYS int, EVER15DPD_IN_60DAYS int, AMOUNT double"
    df = spark.createDataFrame([], columns)
    kinds = {c: "Numerical" for c in df.columns}
    assert prepare.candidate_features(df, kinds) == ["AMOUNT"]


def test_two_decimals_and_target_name(spark):
    df = spark.createDataFrame([(1, 1.005)], "EVER15DPD_IN_90DAYS int, RATIO_CNT_L1_L3_MNTH_DAILY double")
    row = prepare.project_base(df).collect()[0]
    assert row.asDict() == {"BAD_FLAG": 1, "RATIO_CNT_L1_L3_MNTH_DAILY": 1.01}


def test_window_bounds_reach_the_scan(spark, tmp_path, capsys):
    df = spark.createDataFrame(
        [(1, dt.datetime(2022, 1, 1), 1.0)], "LOAN_ID int, DISBURSED_DATE timestamp_ntz, DAYS_SINCE_LAST_TXN double"
    )
    df.write.parquet(str(tmp_path / "t"))
    sample = prepare.sample_window(spark.read.parquet(str(tmp_path / "t")), "2021-08-01", "2022-07-31")
    sample.explain("formatted")
    pushed = [line for line in capsys.readouterr().out.splitlines() if "PushedFilters" in line][0]
    assert "GreaterThanOrEqual(DISBURSED_DATE" in pushed and "LessThan(DISBURSED_DATE" in pushed
    assert "LessThanOrEqual(DAYS_SINCE_LAST_TXN,90.0)" in pushed


def test_suffix_removal(spark):
    df = spark.createDataFrame([("SIZE_woe",), ("low_woe",), ("A_WOE",)], "name string")
    assert [r[0] for r in df.select(woe.raw_name("name")).collect()] == ["SIZE", "low", "A"]


def test_large_dictionary_is_used_whole(spark):
    large = spark.range(150_000).selectExpr("concat('V', id) AS variables", "'Numerical' AS Type")
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "v149999 double, V7 double, OTHER double")
    assert prepare.column_kinds(df, large) == {"v149999": "Numerical", "V7": "Numerical", "OTHER": "Others"}
