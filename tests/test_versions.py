"""Tables that are replaced whole or by batch, sketches per batch, minima from footers."""

import pytest
from pyspark.sql import functions as F

from creditflow.sources import tables, versions


def numbered(spark, first, last):
    return spark.range(first, last).selectExpr("id AS loan_id", "cast(id % 2 AS int) AS bad")


def ids(df):
    return sorted(r["LOAN_ID"] for r in df.select("LOAN_ID").collect())


def test_versions_follow_one_another(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no version"):
        versions.current_table(spark, root)
    assert [versions.replace_table(numbered(spark, 0, n), root) for n in (3, 5, 2)] == [1, 2, 3]
    assert ids(versions.current_table(spark, root)) == [0, 1]
    assert [len(ids(versions.current_table(spark, root, v))) for v in (1, 2, 3)] == [3, 5, 2]
    with pytest.raises(ValueError, match="no version 9"):
        versions.current_table(spark, root, 9)


def test_a_reader_keeps_the_version_that_it_opened(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace_table(numbered(spark, 0, 4), root)
    opened = versions.current_table(spark, root)
    versions.replace_table(numbered(spark, 7, 9), root)
    assert ids(opened) == [0, 1, 2, 3] and ids(versions.current_table(spark, root)) == [7, 8]


def test_a_write_that_dies_between_files_leaves_the_old_table(spark, tmp_path):
    """Some tasks have written their files when another one fails; the folder is left, and nothing points to it."""
    root = str(tmp_path / "t")
    versions.replace_table(numbered(spark, 0, 4), root)
    broken = numbered(spark, 0, 800).repartition(8).selectExpr("CASE WHEN loan_id = 799 THEN cast(raise_error('lost') AS bigint) ELSE loan_id END AS loan_id", "bad")
    with pytest.raises(Exception, match="lost"):
        versions.replace_table(broken, root)
    assert ids(versions.current_table(spark, root)) == [0, 1, 2, 3]
    assert versions.replace_table(numbered(spark, 5, 6), root) == 2
    assert ids(versions.current_table(spark, root)) == [5]


def test_a_writer_that_dies_before_it_points_leaves_the_old_table(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    versions.replace_table(numbered(spark, 0, 2), root)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versions, "point_to", die)
        with pytest.raises(KeyboardInterrupt):
            versions.replace_table(numbered(spark, 0, 9), root)
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v")]) == 2
    assert ids(versions.current_table(spark, root)) == [0, 1]


# --- batches ------------------------------------------------------------------------


def months(spark):
    return versions.with_batch(spark.range(300).selectExpr("id AS LOAN_ID", "date_add(DATE'2020-01-15', cast(id AS int)) AS DISBURSED_DATE", "1.5D AS LOAN_AMOUNT"))


def test_one_batch_is_replaced_and_the_others_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "b")
    versions.write_batches(months(spark), path)
    files = lambda: {str(p.relative_to(path)) for p in (tmp_path / "b").rglob("*.parquet")}
    before = files()
    versions.write_batches(months(spark).where("BATCH = '2020-03' AND LOAN_ID % 2 = 0").withColumn("LOAN_AMOUNT", F.lit(9.0)), path)
    assert {f for f in before ^ files() if "2020-03" not in f} == set()
    got = {r["BATCH"]: (r["n"], r["a"]) for r in versions.read_batches(spark, path).groupBy("BATCH").agg(F.count("*").alias("n"), F.max("LOAN_AMOUNT").alias("a")).collect()}
    want = {r["BATCH"]: r["n"] for r in months(spark).groupBy("BATCH").agg(F.count("*").alias("n")).collect()}
    assert got.pop("2020-03") == (16, 9.0) and got == {b: (n, 1.5) for b, n in want.items() if b != "2020-03"}


def test_wanted_batches_are_found_at_run_time(spark, tmp_path, capsys):
    """The filter is a table; the scan only reads the folders that it names."""
    path, wanted = str(tmp_path / "b"), str(tmp_path / "w")
    versions.write_batches(months(spark), path)
    months(spark).where("LOAN_ID > 250").select("BATCH").distinct().write.parquet(wanted)
    df = versions.read_batches(spark, path, spark.read.parquet(wanted).where("BATCH > '2020-09'"))
    df.explain("formatted")
    assert "dynamicpruning" in capsys.readouterr().out
    assert {r["BATCH"] for r in df.select("BATCH").distinct().collect()} == {"2020-10", "2020-11"}
    assert tables.latest_batch(versions.read_batches(spark, path), "BATCH").select("BATCH").distinct().first()[0] == "2020-11"


# --- sketches ------------------------------------------------------------------------


def test_sketches_are_merged_without_the_rows(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("format_string('2020-%02d', 1 + id % 6) AS BATCH", "id AS a", "id % 40 AS b", "CASE WHEN id % 3 > 0 THEN 'x' END AS c")
    path = str(tmp_path / "s")
    for batch in ("2020-01", "2020-02"):
        versions.sketches(rows.where(F.col("BATCH") == batch), ["a", "b", "c"]).write.mode("append").parquet(path)
    versions.sketches(rows.where("BATCH > '2020-02'"), ["a", "b", "c"]).write.mode("append").parquet(path)
    got = {(r["BATCH"], r["column"]): (r["rows"], r["observed"]) for r in versions.distinct_over_history(spark.read.parquet(path)).collect()}
    exact = {(r["BATCH"], r["column"]): (r["rows"], r["observed"]) for r in versions.exact_distinct_over_history(rows, ["a", "b", "c"]).collect()}
    assert len(exact) == 18 and exact["2020-06", "a"] == (60_000, 60_000) and exact["2020-06", "c"][1] == 1 and exact["2020-03", "c"][1] == 1
    assert got.keys() == exact.keys()
    for key, (n, observed) in exact.items():
        assert got[key][0] == n and abs(got[key][1] - observed) <= versions.MOST_ERROR * observed
    assert {got[k][1] for k in got if k[1] == "b"} <= set(range(20, 41))


def test_a_batch_of_nulls_adds_nothing(spark):
    rows = spark.createDataFrame([("2020-01", None), ("2020-02", "x")], "BATCH string, c string")
    want = {"2020-01": (1, 0), "2020-02": (2, 1)}
    for found in (versions.distinct_over_history(versions.sketches(rows, ["c"])), versions.exact_distinct_over_history(rows, ["c"])):
        assert {r["BATCH"]: (r["rows"], r["observed"]) for r in found.collect()} == want


# --- footers -------------------------------------------------------------------------


def test_minima_come_from_the_footers(spark, tmp_path, capsys):
    path = str(tmp_path / "f")
    spark.range(1000).selectExpr("id - 7 AS a", "id / 4D AS b").repartition(5).write.parquet(path)
    df = versions.footer_minima(spark, path, ["a", "b"])
    df.explain("formatted")
    assert "PushedAggregation: [MIN(a), MIN(b)]" in capsys.readouterr().out
    assert tuple(df.first()) == (-7, 0.0)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
