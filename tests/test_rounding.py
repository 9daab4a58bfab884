"""Rounding in whole numbers gives what the decimals give."""

import math
import random

from pyspark.sql import functions as F

from creditflow.functions.expressions import rounded


def test_rounding_is_that_of_the_decimals(spark):
    rng = random.Random(6)
    values = [rng.choice((-1, 1)) * rng.random() * 10.0 ** rng.randrange(-9, 13) for _ in range(4000)]
    values += [rng.randrange(-(10**9), 10**9) / 10**k for k in range(9) for _ in range(200)]
    values += [x / 2 * 10.0**-k for x in range(-99, 100) for k in range(8)]
    values += [0.0, -0.0, -1e-9, 1e-7, 5e-7, 99999999.9999995, 1e8, 1e20, math.nan, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for places in (0, 2, 6, 8):
        plain = F.round(F.col("v").cast("decimal(38,10)"), places).cast("double")
        # as text, which also tells zeros apart
        wrong = df.select("v", rounded("v", places).cast("string").alias("a"), plain.cast("string").alias("b"))
        assert wrong.where("NOT a <=> b").collect() == []


def test_few_values_are_rounded_by_their_decimals(spark, capsys):
    spark.createDataFrame([(1.5,)], "v double").select(rounded("v").alias("v")).explain()
    assert "CASE WHEN" in capsys.readouterr().out
