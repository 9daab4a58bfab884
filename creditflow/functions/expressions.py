"""Column expressions used across the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division in double; null where the denominator is 0 or null."""
    return F.try_divide(
        as_column(numerator).cast("double"), as_column(denominator).cast("double")
    )


# Below this a double scaled by up to 10**6 is off by less than 0.02, far from what ``rounded`` leaves to the decimals.
EASILY_ROUNDED = 1e8


def rounded(value: Column | str, places: int = 6) -> Column:
    """Half-up decimal rounding that does not depend on binary representation.

    Only a value near the middle of two results needs its decimals. All others go to the nearer one in whole numbers, and
    a whole number divided by a power of ten is the double nearest to that decimal, the same that the decimals give.
    """
    v = as_column(value)
    by_decimals = F.round(v.cast("decimal(38,10)"), places).cast("double")
    if not 0 <= places <= 6:
        return by_decimals
    scale = F.lit(10.0**places)
    scaled = v.cast("double") * scale
    is_clear = (F.abs(v) < EASILY_ROUNDED) & (F.abs(scaled - F.floor(scaled) - 0.5) > 0.05)
    return F.when(is_clear, F.floor(scaled + 0.5).cast("double") / scale).otherwise(by_decimals)


def cents(amount: Column | str) -> Column:
    """A money amount as whole cents, so that sums and differences are exact."""
    return F.round(as_column(amount) * 100).cast("bigint")


def sigmoid(value: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))


def weight_of_evidence(good: Column, bad: Column, goods: Column, bads: Column) -> Column:
    """``ln(bad share / good share)``; an empty cell counts as one half."""
    return F.ln(
        ratio(_half_if_zero(bad), bads) / ratio(_half_if_zero(good), goods)
    )


def information_value(good: Column, bad: Column, goods: Column, bads: Column) -> Column:
    gap = ratio(_half_if_zero(bad), bads) - ratio(_half_if_zero(good), goods)
    return gap * weight_of_evidence(good, bad, goods, bads)


def _half_if_zero(cell: Column) -> Column:
    return F.when(cell == 0, F.lit(0.5)).otherwise(cell.cast("double"))


def bin_number(value: str, cuts: Sequence[float]) -> str:
    """SQL text: 1 + how many of the ascending ``cuts`` are at or below ``value``."""
    if not len(cuts):
        return "1"
    steps = " ".join(f"WHEN {value} < {float(c)!r}D THEN {i}" for i, c in enumerate(cuts, 1))
    return f"CASE {steps} ELSE {len(cuts) + 1} END"
