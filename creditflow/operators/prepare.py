"""Extract, impute and split the modelling base."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow import config
from creditflow.functions.expressions import rounded
from creditflow.operators.features import TWO_DECIMALS

RAW_TARGET = "EVER15DPD_IN_90DAYS"


def project_base(df: DataFrame, two_decimals: Sequence[str] = TWO_DECIMALS) -> DataFrame:
    """The base projection: rename the outcome to the target, round where stored rounded."""
    fixed = {c.upper() for c in two_decimals}
    columns = []
    for name in df.columns:
        if name.upper() == RAW_TARGET:
            columns.append(F.col(name).alias(config.TARGET))
        elif name.upper() in fixed:
            columns.append(rounded(name, 2).alias(name))
        else:
            columns.append(F.col(name))
    return df.select(*columns)


def sample_window(
    df: DataFrame,
    start: str,
    end: str,
    recency: str | None = "DAYS_SINCE_LAST_TXN",
    max_recency: int = config.MAX_RECENCY_DAYS,
    date: str = "DISBURSED_DATE",
) -> DataFrame:
    """Loans disbursed from ``start`` to the end of ``end``, with recent activity.

    The bounds are query parameters. The cast on the upper bound still reaches
    the scan as a plain comparison with the next day.
    """
    spark = df.sparkSession
    sql = "SELECT * FROM {base} WHERE {date} >= :start AND CAST({date} AS DATE) <= CAST(:end AS DATE)"
    args = {"start": start, "end": end}
    if recency is not None:
        sql += " AND {recency} <= :days AND {recency} IS NOT NULL"
        args["days"] = max_recency
        return spark.sql(sql, args=args, base=df, date=F.col(date), recency=F.col(recency))
    return spark.sql(sql, args=args, base=df, date=F.col(date))


def column_kinds(df: DataFrame, dictionary: DataFrame) -> dict[str, str]:
    """Each column's kind: ``Numerical`` or ``Categorical`` by the dictionary, else ``Others``.

    Only the entries of the table's own columns are read, so any dictionary will do.
    """
    wanted = sorted({name.upper() for name in df.columns})
    rows = dictionary.where(F.upper("variables").isin(wanted)).select("variables", "Type").distinct().collect()
    return kinds_by_name(df.columns, {r["variables"]: r["Type"] for r in rows})


def kinds_by_name(columns: Sequence[str], types: dict[str, str]) -> dict[str, str]:
    known = {name.upper(): kind for name, kind in types.items()}
    kinds = {}
    for name in columns:
        kind = known.get(name.upper())
        kinds[name] = kind if kind in ("Numerical", "Categorical") else "Others"
    return kinds


def impute(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Fill missing values by kind; ``Others`` pass through untouched.

    Numbers are cast strictly (bad text fails) and null or NaN becomes the
    numeric sentinel; categories turn null and the null token into the
    categorical one.
    """
    types = dict(df.dtypes)
    columns = []
    for name in df.columns:
        if kinds.get(name) == "Numerical":
            value = _strict_double(name, types[name])
            columns.append(f"coalesce(nanvl({value}, {config.MISSING_NUMERIC}D), {config.MISSING_NUMERIC}D) AS {name}")
        elif kinds.get(name) == "Categorical":
            columns.append(
                f"CASE WHEN {name} IS NULL OR {name} = '{config.NULL_TOKEN}' "
                f"THEN '{config.MISSING_CATEGORY}' ELSE {name} END AS {name}"
            )
        else:
            columns.append(name)
    return df.selectExpr(*columns)


def _strict_double(name: str, dtype: str) -> str:
    if dtype != "string":
        return f"cast({name} as double)"
    return (
        f"CASE WHEN {name} IS NOT NULL AND try_cast({name} AS double) IS NULL "
        f"THEN cast(raise_error(concat('not a number in {name}: ', {name})) AS double) "
        f"ELSE try_cast({name} AS double) END"
    )


def with_split(df: DataFrame, cut: str, date: str = "DISBURSED_DATE") -> DataFrame:
    """Add ``split``: ``train`` up to ``cut``, ``oot`` after it, null without a date."""
    day = F.to_date(F.col(date))
    cut_day = F.to_date(F.lit(cut))
    return df.withColumn("split", F.when(day <= cut_day, "train").when(day > cut_day, "oot"))


def train_and_oot(df: DataFrame, cut: str, date: str = "DISBURSED_DATE") -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, cut, date)
    return (
        marked.where(F.col("split") == "train").drop("split"),
        marked.where(F.col("split") == "oot").drop("split"),
    )


def candidate_features(
    df: DataFrame, kinds: dict[str, str], kind: str = "Numerical", exclude: Sequence[str] = ()
) -> list[str]:
    """Columns of one kind, without ids, date and any outcome flag."""
    out = {c.upper() for c in (*config.ID_COLUMNS, *config.OUTCOME_COLUMNS, *exclude)}
    return [c for c in df.columns if kinds.get(c) == kind and c.upper() not in out]
