import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from creditflow.operators.point_in_time import as_of, daily_panel, uses_to_events

DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def facts_of(rng, users, per_user, days):
    return [(u, day(rng.randrange(days)), rng.randrange(1, 1000)) for u in range(users) for _ in range(per_user[u])]


@pytest.mark.parametrize("hot", [20, 4000])
def test_totals_match_brute_force(spark, hot):
    """Also with one user holding most rows: the panel shrinks them to one per day."""
    rng = random.Random(hot)
    facts = facts_of(rng, 5, [hot, 10, 10, 1, 0], 400)
    anchors = sorted({(u, day(rng.randrange(420))) for u in range(5) for _ in range(25)})
    events = spark.createDataFrame(facts, "user_id int, day date, c long").withColumn("n", F.lit(1).cast("long"))
    panel = daily_panel([events], spark.createDataFrame(anchors, "user_id int, day date"), "user_id", "day")
    assert panel.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 421
    got = as_of(panel, "user_id", "day", {"n": (1, 30, 90), "c": (30,)}, "n").collect()
    assert sorted((r["user_id"], r["day"]) for r in got) == anchors
    for r in got:
        known = [(d, c) for u, d, c in facts if u == r["user_id"] and d < r["day"]]
        gaps = [(r["day"] - d).days for d, _ in known]
        days = sorted({d for d, _ in known})
        epoch = dt.date(1970, 1, 1)
        assert r["n"] == len(known) and r["c"] == sum(c for _, c in known)
        for w in (1, 30, 90):
            assert r[f"n_{w}"] == sum(g <= w for g in gaps)
        assert r["c_30"] == sum(c for (d, c), g in zip(known, gaps) if g <= 30)
        assert r["active_days"] == len(days)
        assert r["active_months"] == len({(d.year, d.month) for d in days})
        assert r["first_day"] == ((days[0] - epoch).days if days else None)
        assert r["last_day"] == ((days[-1] - epoch).days if days else None)
        assert r["second_day"] == ((days[1] - epoch).days if len(days) > 1 else None)


def test_distinct_items_match_brute_force(spark):
    rng = random.Random(3)
    uses = sorted({(u, rng.randrange(4), day(rng.randrange(300))) for u in range(4) for _ in range(20)})
    anchors = sorted({(u, day(rng.randrange(430))) for u in range(4) for _ in range(40)})
    events = uses_to_events(
        spark.createDataFrame(uses, "user_id int, item int, day date"), "user_id", ["item"], "day", 30, "ever", "active"
    ).drop("item")
    counted = events.withColumn("n", F.lit(0).cast("long"))
    panel = daily_panel([counted], spark.createDataFrame(anchors, "user_id int, day date"), "user_id", "day")
    for r in as_of(panel, "user_id", "day", {"ever": (), "active": ()}, "n").collect():
        known = [(i, (r["day"] - d).days) for u, i, d in uses if u == r["user_id"] and d < r["day"]]
        assert r["ever"] == len({i for i, _ in known})
        assert r["active"] == len({i for i, gap in known if gap <= 30})


def test_dated_twice_counts_only_what_was_known(spark):
    """A recovery belongs to its order's day but counts from the day it was paid."""
    rng = random.Random(11)
    rows = []
    for _ in range(300):
        made = rng.randrange(300)
        rows.append((rng.randrange(3), made, made + rng.randrange(0, 91), rng.randrange(1, 500)))
    known = [(u, day(p), c, 0) for u, _, p, c in rows]
    belongs = [(u, day(m), 0, c) for u, m, _, c in rows]
    events = spark.createDataFrame(known + belongs, "user_id int, day date, c long, c__aged long").withColumn(
        "n", F.lit(1).cast("long")
    )
    anchors = sorted({(u, day(rng.randrange(420))) for u in range(3) for _ in range(60)})
    panel = daily_panel([events], spark.createDataFrame(anchors, "user_id int, day date"), "user_id", "day")
    for r in as_of(panel, "user_id", "day", {"c": (90, 180)}, "n").collect():
        a = (r["day"] - DAY).days
        mine = [(m, p, c) for u, m, p, c in rows if u == r["user_id"] and p < a]
        assert r["c"] == sum(c for _, _, c in mine)
        for w in (90, 180):
            assert r[f"c_{w}"] == sum(c for m, _, c in mine if a - m <= w)


def test_facts_without_a_day_or_key_are_never_known(spark):
    facts = [(1, None, 5), (None, DAY, 7), (1, DAY, 2)]
    events = spark.createDataFrame(facts, "user_id int, day date, n long")
    anchors = spark.createDataFrame([(1, day(3)), (1, None), (None, day(3))], "user_id int, day date")
    got = as_of(daily_panel([events], anchors, "user_id", "day"), "user_id", "day", {"n": (30,)}, "n").collect()
    assert [(r["user_id"], r["day"], r["n"], r["n_30"]) for r in got] == [(1, day(3), 2, 2)]


def test_loans_without_a_customer_stay(spark, tmp_path):
    from creditflow.sources import datasets

    for name in ("customer", "orders"):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        if name == "orders":
            lost = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey"))
            df = df.withColumn("o_custkey", lost)
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    base = datasets.transaction_base(spark, str(tmp_path), ("core",))
    assert base.count() == 273
    unknown = base.where("USER_ID IS NULL")
    assert unknown.count() > 0 and unknown.where("TOTAL_TRXNS IS NOT NULL").count() == 0


def test_no_pairwise_join(spark, capsys):
    events = spark.createDataFrame([(1, DAY, 1)], "user_id int, day date, n long")
    panel = daily_panel([events], events.select("user_id", "day"), "user_id", "day")
    as_of(panel, "user_id", "day", {"n": (30, 60, 90)}, "n").explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan
    # One per source and one by user: the sources are put together without a shuffle.
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("Sort [") == 1
