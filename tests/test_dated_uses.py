"""Items in use are counted without further rows: the same values, and what the plan must not contain."""

import datetime as dt
import random

from pyspark.sql import functions as F

from creditflow.operators.point_in_time import as_of, daily_panel, dated_uses
from creditflow.sources import datasets

DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def test_items_in_use_match_brute_force_without_further_days(spark):
    rng = random.Random(5)
    uses = sorted({(u, rng.randrange(4), day(rng.randrange(300))) for u in range(4) for _ in range(20)})
    anchors = sorted({(u, day(rng.randrange(430))) for u in range(4) for _ in range(40)})
    events = dated_uses(spark.createDataFrame(uses, "user_id int, item int, day date"), "user_id", ["item"], "day", 30, "ever", "active")
    assert events.count() == len(uses)
    counted = events.drop("item").withColumn("n", F.lit(0).cast("long"))
    panel = daily_panel([counted], spark.createDataFrame(anchors, "user_id int, day date"), "user_id", "day")
    assert panel.count() == len({(u, d) for u, _, d in uses} | set(anchors))
    got = as_of(panel, "user_id", "day", {"ever": (), "active": (30,)}, "n").collect()
    assert len(got) == len(anchors)
    for r in got:
        known = [(i, (r["day"] - d).days) for u, i, d in uses if u == r["user_id"] and d < r["day"]]
        assert r["ever"] == len({i for i, _ in known})
        assert r["active_30"] == len({i for i, gap in known if gap <= 30})


def test_base_adds_no_days_to_the_panel(spark, tmp_path, capsys):
    """A use that ends is no row of its own 90 days later."""
    lines = [(1, 7, 10.0, dt.datetime(1998, 1, 3))]
    orders = [(1, 5, "F", 100.0, dt.datetime(1998, 1, 1), "1-URGENT"), (2, 5, "O", 50.0, dt.datetime(1998, 2, 1), "1-URGENT")]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_extendedprice double, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    names = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(orders, names).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(5, "MACHINERY")], "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(7, 1.0)], "s_suppkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    base = datasets.transaction_base(spark, str(tmp_path))
    base.explain()
    assert "date_add(" not in capsys.readouterr().out
    columns = ("ACTIVE_ACCOUNTS", "ACTIVE_PLATFORM_COUNTERPARTY_USERS", "TOTAL_ACCOUNTS", "TOTAL_CUSTOMERS", "NO_PLATFORM_CUSTOMERS")
    found = {r["LOAN_ID"]: tuple(r[c] for c in columns) for r in base.collect()}
    assert found == {1: (0, 0, 0, 0, 0), 2: (1, 1, 1, 1, 1)}
