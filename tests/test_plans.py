"""What the plans must not contain, whatever the data size."""

from creditflow import config
from creditflow.operators import prepare
from creditflow.plans.queries import QUERIES
from creditflow.sources import datasets
from creditflow.sources.tables import latest_batch, read_given

SF = "/root/testdata/sf0.001"


def plan_of(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_scans_read_only_what_a_query_needs(spark, capsys):
    plan = plan_of(QUERIES["feat_recency"](spark, SF), capsys)
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schemas and all("o_totalprice" not in s and "o_orderstatus" not in s for s in schemas)
    assert "lineitem" not in plan and "supplier" not in plan


def test_loan_filter_reaches_the_scan(spark, capsys):
    plan = plan_of(datasets.loans(spark, SF), capsys)
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan


def test_base_reads_the_facts_in_few_passes(spark, capsys):
    """Loans; transactions with accounts and loan dates; orders of settled lines; orders of suppliers' lines."""
    data = config.TRANSACTIONS
    plan = plan_of(datasets.transaction_base(spark, SF, period=(data.start, data.end)), capsys)
    scans = [part for part in plan.split("\n\n") if "Scan parquet" in part and "orders.parquet" in part]
    assert len(scans) == 4
    assert all("LessThan(o_orderdate,2001-08-01" in s for s in scans)


def test_a_period_leaves_the_features_of_its_loans(spark):
    period = ("1998-03-01", "1999-02-15")
    whole = datasets.transaction_base(spark, SF).where("DISBURSED_DATE BETWEEN '1998-03-01' AND '1999-02-15'")
    part = datasets.transaction_base(spark, SF, period=period)
    assert part.count() == whole.count() > 0
    assert part.exceptAll(whole).count() == 0


def test_split_and_impute_do_not_shuffle(spark, capsys, tmp_path):
    datasets.transaction_base(spark, SF, ("core",)).write.parquet(str(tmp_path / "base"))
    base = prepare.project_base(spark.read.parquet(str(tmp_path / "base")))
    kinds = prepare.column_kinds(base, datasets.transaction_dictionary(spark))
    train, _ = prepare.train_and_oot(prepare.impute(base, kinds), config.TRANSACTIONS.split)
    assert "Exchange" not in plan_of(train, capsys)


def test_latest_batch_prunes_partitions(spark, capsys, tmp_path):
    spark.range(20).selectExpr("id", "id % 4 AS batch").write.partitionBy("batch").parquet(str(tmp_path / "batches"))
    newest = latest_batch(spark.read.parquet(str(tmp_path / "batches")), "batch")
    assert newest.count() == 5
    plan = plan_of(newest, capsys)
    assert any("PartitionFilters" in line and "ubquery" in line for line in plan.splitlines())


def test_supplier_is_looked_up_after_the_window(spark, capsys):
    """So the join's own partitioning is nobody's input, and a supplier with many lines can be split."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = datasets._orders(spark, SF)
        uses = datasets.counterparty_events(orders, read_given(spark, SF, "lineitem"), read_given(spark, SF, "supplier"))
        uses.explain("simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = capsys.readouterr().out
    # a plan prints an operator before its inputs
    assert plan.index("SortMergeJoin [supplier_id") < plan.index("Window [")
