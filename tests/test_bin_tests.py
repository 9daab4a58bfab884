import pytest
from pyspark.sql import functions as F

from creditflow.operators import bin_tests, report

# variable, order, special, bad rate, bin IV, total IV, then expected: test,
# Inc, Dec, mtest, Prop_iv, Max_IV_test, num_bin, status, trend
EXAMPLE = [
    ("V_MISS", 0, True, 0.20, 0.010, 0.100, "NA", 1, 0, "Mono", 0.100, 0, 3, "accepted", "Decreasing"),
    ("V_MISS", 1, False, 0.30, 0.040, 0.100, "NA", 1, 0, "Mono", 0.400, 0, 3, "accepted", "Decreasing"),
    ("V_MISS", 2, False, 0.10, 0.050, 0.100, "Inc", 1, 0, "Mono", 0.500, 0, 3, "accepted", "Decreasing"),
    ("V_UP", 1, False, 0.05, 0.03, 0.09, "NA", 0, 2, "Mono", 0.333, 0, 3, "accepted", "Increasing"),
    ("V_UP", 2, False, 0.10, 0.02, 0.09, "Dec", 0, 2, "Mono", 0.222, 0, 3, "accepted", "Increasing"),
    ("V_UP", 3, False, 0.20, 0.04, 0.09, "Dec", 0, 2, "Mono", 0.444, 0, 3, "accepted", "Increasing"),
    ("V_ZIG", 1, False, 0.05, 0.03, 0.09, "NA", 1, 1, "NonMono", 0.333, 0, 3, "unresolved", "Increasing"),
    ("V_ZIG", 2, False, 0.25, 0.02, 0.09, "Dec", 1, 1, "NonMono", 0.222, 0, 3, "unresolved", "Increasing"),
    ("V_ZIG", 3, False, 0.10, 0.04, 0.09, "Inc", 1, 1, "NonMono", 0.444, 0, 3, "unresolved", "Increasing"),
    ("V_THIN", 1, False, 0.05, 0.051, 0.100, "NA", 0, 2, "Mono", 0.510, 1, 3, "unresolved", "Increasing"),
    ("V_THIN", 2, False, 0.06, 0.001, 0.100, "Dec", 0, 2, "Mono", 0.010, 1, 3, "unresolved", "Increasing"),
    ("V_THIN", 3, False, 0.20, 0.048, 0.100, "Dec", 0, 2, "Mono", 0.480, 1, 3, "unresolved", "Increasing"),
    ("V_LOW", 1, False, 0.05, 0.006, 0.012, "NA", 0, 1, "Mono", 0.500, 0, 2, "rejected", "Increasing"),
    ("V_LOW", 2, False, 0.06, 0.006, 0.012, "Dec", 0, 1, "Mono", 0.500, 0, 2, "rejected", "Increasing"),
    ("V_ZERO", 1, False, 0.05, 0.0, 0.0, "NA", 0, 0, "Mono", None, 0, 2, "rejected", "Decreasing"),
    ("V_ZERO", 2, False, 0.05, 0.0, 0.0, "NA", 0, 0, "Mono", None, 0, 2, "rejected", "Decreasing"),
]
INPUT = "variable string, bin_order int, is_special boolean, badprob double, bin_iv double, total_iv double"


def test_worked_example(spark):
    bins = spark.createDataFrame([r[:6] for r in EXAMPLE], INPUT)
    rows = report.with_trend(bin_tests.test_bins(bins)).collect()
    got = {
        (r["variable"], r["bin_order"]): (
            r["test"], r["Inc_cnt"], r["Dec_cnt"], r["mtest"],
            None if r["Prop_iv"] is None else round(r["Prop_iv"], 3),
            r["Max_IV_test"], r["num_bin"], r["status"], r["Trend"],
        )
        for r in rows
    }
    assert got == {(r[0], r[1]): r[6:] for r in EXAMPLE}


def test_missing_bin_in_the_middle_allows_three_bins(spark):
    rows = [("V", 1, False, 0.1, 0.05, 0.2), ("V", 2, False, 0.3, 0.05, 0.2), ("V", 3, True, 0.2, 0.1, 0.2)]
    bins = spark.createDataFrame(rows, INPUT)
    tested = bin_tests.test_bins(bins).select("mtest", "status").distinct().collect()
    assert [tuple(r) for r in tested] == [("NonMono", "accepted")]


def test_variable_counts(spark):
    bins = spark.createDataFrame([r[:6] for r in EXAMPLE], INPUT)
    counts = {r["status"]: r["variables"] for r in bin_tests.variable_counts(bin_tests.test_bins(bins)).collect()}
    assert counts == {"accepted": 2, "unresolved": 2, "rejected": 2}


@pytest.mark.parametrize(
    "stop_at_one, expected",
    # A settles in round 1, B in 2; C alone is left for round 3, where it would settle.
    [(True, {"A": 1, "B": 2, "C": 2}), (False, {"A": 1, "B": 2, "C": 3})],
)
def test_search_stops_when_one_variable_is_left(spark, stop_at_one, expected):
    settle = {"A": 1, "B": 2, "C": 3}
    rows = [
        (v, r, "accepted" if r >= settle[v] else "unresolved") for v in settle for r in range(1, 5)
    ]
    tested = spark.createDataFrame(rows, "variable string, round int, status string")
    final = bin_tests.final_round(tested, 4, stop_at_one).select("variable", "round", "status").collect()
    assert {r["variable"]: r["round"] for r in final} == expected
    assert {r["variable"]: r["status"] for r in final}["C"] == ("unresolved" if stop_at_one else "accepted")


def test_never_settled_keeps_the_last_round(spark):
    rows = [(v, r, "unresolved") for v in ("A", "B") for r in (1, 2, 3)]
    tested = spark.createDataFrame(rows, "variable string, round int, status string")
    final = bin_tests.final_round(tested, 3).select("variable", F.col("round")).collect()
    assert sorted(map(tuple, final)) == [("A", 3), ("B", 3)]


def test_round_counts_leave_out_settled_variables(spark):
    settle = {"A": 1, "B": 2, "C": 9}
    rows = [(v, r, "accepted" if r >= settle[v] else "unresolved") for v in settle for r in range(1, 4)]
    tested = spark.createDataFrame(rows, "variable string, round int, status string")
    got = {(r["round"], r["status"]): r["variables"] for r in bin_tests.round_counts(tested, 3).collect()}
    assert got == {(1, "accepted"): 1, (1, "unresolved"): 2, (2, "accepted"): 1, (2, "unresolved"): 1}


def test_search_of_one_variable_keeps_its_first_round(spark):
    rows = [("V", 1, "unresolved"), ("V", 2, "accepted")]
    tested = spark.createDataFrame(rows, "variable string, round int, status string")
    assert [tuple(r) for r in bin_tests.final_round(tested, 2).select("variable", "round", "status").collect()] == [("V", 1, "unresolved")]
