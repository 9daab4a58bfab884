"""Every registered query against its SQL twin, on the smallest scale."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tools.check_oracle import TABLES, table

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, capsys, name):
    df = entry.queries()[name](spark, SF)
    df.explain("formatted")
    plan = capsys.readouterr().out
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan
    result = duck.execute(ORACLE[name])
    expected = table([c[0] for c in result.description], result.fetchall())
    assert table(df.columns, df.collect()) == expected
    assert expected[1]


def test_every_sql_twin_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_comparison_notices_a_changed_value():
    assert table(["a", "b"], [(1, 2.0)]) != table(["a", "b"], [(1, 2.0000001)])


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(ORACLE)))
def test_fitted_models_run(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_skewed_tables(spark, tmp_path):
    """A third of all orders belong to one customer, a third of all lines to one order and one supplier."""
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    third = lambda key, column, value: F.when(F.col(key) % 3 == 0, F.lit(value)).otherwise(F.col(column))
    orders = read("orders")
    hot_order = orders.where("o_custkey = 7 OR o_orderkey % 3 = 0").agg(F.min("o_orderkey")).first()[0]
    orders.withColumn("o_custkey", third("o_orderkey", "o_custkey", 7)).write.parquet(f"{tmp_path}/orders.parquet")
    read("lineitem").withColumn("l_suppkey", third("l_partkey", "l_suppkey", 1)).withColumn(
        "l_orderkey", third("l_partkey", "l_orderkey", hot_order)
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("customer", "supplier"):
        read(name).write.parquet(f"{tmp_path}/{name}.parquet")
    connection = duckdb.connect()
    for name in ("orders", "lineitem", "customer", "supplier"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    result = connection.execute(ORACLE["base_scan_project"])
    expected = table([c[0] for c in result.description], result.fetchall())
    df = entry.queries()["base_scan_project"](spark, str(tmp_path))
    assert table(df.columns, df.collect()) == expected
