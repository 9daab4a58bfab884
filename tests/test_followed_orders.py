"""Lines that no loan follows are not dealt out, and what is left gives the same features."""

import datetime as dt

from pyspark.sql import functions as F

from creditflow.sources import datasets

NAMES = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
LOAN, OTHER = "1-URGENT", "5-LOW"


def at(month, day):
    return dt.datetime(1998, month, day)


# the last loan of customer 5 is order 3, customer 6 has none, order 7 belongs to both and to no one
ORDERS = [
    (1, 5, "F", 10.0, at(1, 1), OTHER),
    (2, 5, "F", 10.0, at(2, 1), LOAN),
    (3, 5, "F", 10.0, at(3, 1), LOAN),
    (4, 5, "F", 10.0, at(3, 2), OTHER),
    (5, 6, "F", 10.0, at(1, 1), OTHER),
    (None, 5, "F", 10.0, at(1, 1), OTHER),
    (6, None, "F", 10.0, at(1, 1), LOAN),
    (7, 5, "F", 10.0, at(1, 5), OTHER),
    (7, 6, "F", 10.0, at(1, 6), OTHER),
    (7, None, "F", 10.0, at(1, 7), OTHER),
    (8, 5, "F", 10.0, None, OTHER),
]


def given(spark, folder):
    lines = [(o, 9, 100.0, at(m, 20)) for o in range(1, 9) for m in (1, 2, 3)]
    spark.createDataFrame(ORDERS, NAMES).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_extendedprice double, l_shipdate timestamp_ntz").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(5, "MACHINERY"), (6, "BUILDING")], "c_custkey long, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(9, 1.0)], "s_suppkey long, s_acctbal double").write.parquet(f"{folder}/supplier.parquet")
    return str(folder)


def test_only_orders_before_a_loan_are_kept(spark, tmp_path):
    orders = datasets._orders(spark, given(spark, tmp_path))
    kept = datasets.followed_orders(orders, F.lit(True)).collect()
    assert sorted((r["order_id"], r["user_id"] or 0) for r in kept) == [(1, 5), (2, 5), (7, 0), (7, 5), (7, 6)]
    early = F.col("day") <= F.lit("1998-02-01").cast("date")
    kept = datasets.followed_orders(orders, early).collect()
    assert sorted((r["order_id"], r["user_id"] or 0) for r in kept) == [(1, 5), (7, 0), (7, 5), (7, 6)]


def test_features_are_those_of_all_lines(spark, tmp_path, monkeypatch):
    folder = given(spark, tmp_path)
    found = datasets.transaction_base(spark, folder)
    with monkeypatch.context() as patched:
        patched.setattr(datasets, "followed_orders", lambda orders, is_sampled: orders)
        whole = datasets.transaction_base(spark, folder)
    assert found.count() == whole.count() == 3
    assert found.exceptAll(whole).count() == 0


def test_lines_are_dealt_once_on_their_way_to_the_windows(spark, tmp_path, capsys):
    folder = given(spark, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders, lines = datasets._orders(spark, folder), datasets.read_given(spark, folder, "lineitem")
        datasets.settlement_events(orders, lines).explain("simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 2
