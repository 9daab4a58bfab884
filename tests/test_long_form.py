"""Wide tables are unpivoted a part of the columns at a time."""

from creditflow.operators.histogram import long_form


def test_wide_tables_are_unpivoted_by_generated_code(spark, tmp_path, capsys):
    names = [f"v{i}" for i in range(130)]
    rows = [(k, k % 2 if k % 7 else None, *[float(k * i) if i % 5 else None for i in range(130)]) for k in range(20)]
    spark.createDataFrame(rows, f"k int, bad int, {', '.join(f'{n} double' for n in names)}").write.parquet(f"{tmp_path}/wide")
    long = long_form(spark.read.parquet(f"{tmp_path}/wide"), names, "bad", by=["k"])
    long.explain()
    expands = [line for line in capsys.readouterr().out.splitlines() if "Expand [" in line]
    assert expands and all("*(" in line for line in expands)
    got = sorted((r["k"], r["y"], r["variable"], r["value"]) for r in long.where("value IS NOT NULL").collect())
    assert got == sorted((r[0], r[1], n, v) for r in rows if r[1] is not None for n, v in zip(names, r[2:]) if v is not None)
    assert long.count() == 130 * sum(r[1] is not None for r in rows)
