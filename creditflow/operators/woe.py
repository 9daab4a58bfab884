"""Apply fitted bins: replace values by their bin's weight of evidence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow import config
from creditflow.operators.histogram import is_special

# A value that no bin covers (a missing value where none was seen in training,
# an unseen category) carries no evidence, and neither does a bin of a sample
# with only one class.
NEUTRAL = 0.0


def woe_table(bins: DataFrame) -> dict[str, dict]:
    """Per variable: cut points, WOE of the ordinary bins, WOE of the special bin.

    Bins are model parameters (variables x bin limit), so they fit on the driver.
    """
    rows = bins.select("variable", "bin_order", "is_special", "lo", "woe").distinct().collect()
    table: dict[str, dict] = {}
    for row in sorted(rows, key=lambda r: (r["variable"], r["bin_order"])):
        entry = table.setdefault(row["variable"], {"cuts": [], "woe": [], "special": NEUTRAL})
        value = NEUTRAL if row["woe"] is None else row["woe"]
        if row["is_special"]:
            entry["special"] = value
        else:
            if row["lo"] != -float("inf"):
                entry["cuts"].append(row["lo"])
            entry["woe"].append(value)
    return table


def woe_expression(
    column: str, entry: Mapping, special: Sequence[float] = (config.MISSING_NUMERIC,)
) -> Column:
    value = f"cast({column} as double)"
    missing = f"{float(entry['special'])!r}D"
    if not entry["woe"]:
        return F.expr(f"CASE WHEN {is_special(value, special)} THEN {missing} ELSE {NEUTRAL}D END")
    # One WOE more than cuts; the first bin reaches down to -infinity.
    steps = "".join(f" WHEN {value} < {float(c)!r}D THEN {float(w)!r}D" for c, w in zip(entry["cuts"], entry["woe"]))
    return F.expr(
        f"CASE WHEN {is_special(value, special)} THEN {missing}{steps} ELSE {float(entry['woe'][-1])!r}D END"
    )


def woe_wide(
    df: DataFrame,
    table: Mapping[str, Mapping],
    keep: Sequence[str] = ("LOAN_ID", config.TARGET),
    variables: Sequence[str] | None = None,
) -> DataFrame:
    """``<variable>_woe`` columns next to the key and target; no join, no shuffle."""
    chosen = list(variables) if variables is not None else list(table)
    return df.select(*keep, *[woe_expression(v, table[v]).alias(f"{v}_woe") for v in chosen])


def woe_long(
    df: DataFrame, table: Mapping[str, Mapping], keep: Sequence[str] = ("LOAN_ID", config.TARGET)
) -> DataFrame:
    """(keep..., variable, woe): one row per loan and variable."""
    return df.select(*keep, *[woe_expression(v, e).alias(v) for v, e in table.items()]).unpivot(
        list(keep), list(table), "variable", "woe"
    )


def woe_columns(df: DataFrame) -> DataFrame:
    """Only the columns whose name ends in ``_woe``."""
    return df.select(df.colRegex("`(?i).*_woe$`"))


def raw_name(column: Column | str) -> Column:
    """The variable behind a ``_woe`` name."""
    value = F.col(column) if isinstance(column, str) else column
    return F.regexp_replace(value, "(?i)_woe$", "")
