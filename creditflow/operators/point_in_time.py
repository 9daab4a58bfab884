"""Point-in-time totals: what was known about a key before each of its dates.

Facts and the dates to describe ("anchors") are first collapsed to one row per
(key, day). Every total is then a running sum up to the day before the anchor,
and a windowed total is the difference of two running sums. Nothing is joined
pairwise: a key with a third of all facts shrinks to at most one row per
calendar day before the window, and no frame is longer than its prefix.

All measures are whole numbers (amounts in cents), so differences are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

AGED = "__aged"


def daily_panel(events: Sequence[DataFrame], anchors: DataFrame | None, key: str, day: str) -> DataFrame:
    """One row per (key, day): summed measures, and whether the day is an anchor.

    Each source is summed by itself first, so what is shuffled carries only that
    source's measures, and a hot (key, day) leaves a task as one row. The sources
    then lie partitioned alike and are put together where they are. Rows without
    a key or a day belong to no point in time. Where the anchors are days of a
    source, that source marks them (``is_anchor``, 1 or null) and ``anchors`` is None.
    """
    placed = f"{key} IS NOT NULL AND {day} IS NOT NULL"
    parts = []
    if anchors is not None:
        parts.append(anchors.select(key, day).where(placed).distinct().withColumn("is_anchor", F.lit(1)))
    for part in events:
        part = part.where(placed)
        measures = [F.expr(f"sum({c})").alias(c) for c in part.columns if c not in (key, day, "is_anchor")]
        marks = [F.max("is_anchor").alias("is_anchor")] if "is_anchor" in part.columns else []
        parts.append(part.groupBy(key, day).agg(*marks, *measures))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    measures = [c for c in rows.columns if c not in (key, day, "is_anchor")]
    return rows.groupBy(key, day).agg(
        F.max("is_anchor").alias("is_anchor"),
        *[F.expr(f"coalesce(sum({m}), 0L)").alias(m) for m in measures],
    )


def as_of(
    panel: DataFrame,
    key: str,
    day: str,
    windows: Mapping[str, Sequence[int]],
    count: str,
    dated: Sequence[str] = (),
) -> DataFrame:
    """Totals before each anchor day.

    For each measure ``m`` of ``windows``: ``m`` over all earlier days, and
    ``m_<w>`` over the last ``w`` days for each window length. A measure with a
    twin ``m__aged`` is *dated twice*: ``m`` sits on the day it became known and
    the twin on the day it belongs to, so that a window selects by the day it
    belongs to but only counts what was known by the anchor. This needs every
    window to be at least as long as the delay between the two days.

    ``count`` is the measure that makes a day active; from it come first, last
    and second active day, active days and active months. ``dated`` measures
    get the first and last day on which they were above 0.
    """
    per_key = f"PARTITION BY {key} ORDER BY __day_number"

    def until(days: int) -> str:
        return f"OVER ({per_key} RANGE BETWEEN UNBOUNDED PRECEDING AND {days} PRECEDING)"

    before = until(1)
    out = {
        "first_day": f"min(__active) {before}",
        "last_day": f"max(__active) {before}",
        "second_day": f"nth_value(__active, 2) IGNORE NULLS {before}",
        "active_days": f"count(__active) {before}",
        "active_months": f"count(__new_month) {before}",
        "first_month": f"min(__month) {before}",
        "last_month": f"max(__month) {before}",
    }
    for measure in dated:
        out[f"first_{measure}"] = f"min(CASE WHEN {measure} > 0 THEN __day_number END) {before}"
        out[f"last_{measure}"] = f"max(CASE WHEN {measure} > 0 THEN __day_number END) {before}"
    older, totals = {}, {}
    columns = set(panel.columns)
    for measure, lengths in windows.items():
        aged = measure + AGED if measure + AGED in columns else measure
        out[measure] = f"coalesce(sum({measure}) {before}, 0)"
        for length in lengths:
            older[f"{measure}_before_{length}"] = f"coalesce(sum({aged}) {until(length + 1)}, 0)"
            totals[f"{measure}_{length}"] = f"{measure} - {measure}_before_{length}"

    numbered = panel.selectExpr(
        "*",
        f"unix_date({day}) AS __day_number",
        f"CASE WHEN {count} > 0 THEN unix_date({day}) END AS __active",
        f"CASE WHEN {count} > 0 THEN year({day}) * 12 + month({day}) END AS __month",
    ).selectExpr(
        "*",
        f"CASE WHEN __month IS DISTINCT FROM last_value(__month) IGNORE NULLS OVER ({per_key} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN __month END AS __new_month",
    )
    return (
        numbered.selectExpr(
            key, day, "__day_number AS anchor_day", "is_anchor", *[f"{e} AS {n}" for n, e in {**out, **older}.items()]
        )
        .where("is_anchor = 1")
        .selectExpr(key, day, "anchor_day", *out, *[f"{e} AS {n}" for n, e in totals.items()])
    )


def uses_to_events(
    uses: DataFrame, key: str, item: Sequence[str], day: str, horizon: int, first: str, active: str, carried: Sequence[str] = ()
) -> DataFrame:
    """Distinct-item counts as summable events.

    ``uses`` has one row per (key, item, day). Summing ``first`` over the days
    before an anchor counts the items ever used; summing ``active`` counts the
    items used in the ``horizon`` days before it: an item opens (+1) on a use
    that follows none within the horizon and closes (-1) ``horizon`` days after
    a use that none follows. ``carried`` columns of a use stay on its own day,
    the first of them is never null there.
    """
    w = Window.partitionBy(key, *item).orderBy(day)
    kept = F.col(carried[0]).isNotNull() if carried else F.lit(False)
    marked = uses.select(
        key,
        *item,
        day,
        *carried,
        F.lag(day).over(w).alias("__previous"),
        F.lead(day).over(w).alias("__next"),
    )
    opens = F.col("__previous").isNull() | (F.datediff(day, "__previous") > horizon)
    closes = F.col("__next").isNull() | (F.datediff("__next", day) > horizon)
    rows = F.array(
        F.struct(
            F.col(day).alias("__d"),
            F.col("__previous").isNull().cast("bigint").alias(first),
            opens.cast("bigint").alias(active),
            *carried,
        ),
        F.struct(
            F.date_add(day, horizon).alias("__d"),
            F.lit(0).cast("bigint").alias(first),
            F.when(closes, F.lit(-1)).otherwise(F.lit(0)).cast("bigint").alias(active),
            *[F.lit(None).cast(uses.schema[c].dataType).alias(c) for c in carried],
        ),
    )
    return (
        marked.select(key, *item, F.inline(rows))
        .where((F.col(first) != 0) | (F.col(active) != 0) | kept)
        .withColumnRenamed("__d", day)
    )


def dated_uses(
    uses: DataFrame, key: str, item: Sequence[str], day: str, horizon: int, first: str, active: str, carried: Sequence[str] = ()
) -> DataFrame:
    """The counts of ``uses_to_events`` with one row per use, for ``as_of`` with the window ``{active: (horizon,)}``.

    ``active`` is dated twice: an item opens on its own day, and a use that none follows within the horizon closes it
    in the twin, also on its own day. The close is only counted once the use lies before the window, so
    ``active_<horizon>`` is the number of items used within it, and no further day comes into the panel.
    """
    w = Window.partitionBy(key, *item).orderBy(day)
    marked = uses.select(
        key, *item, day, *carried, F.lag(day).over(w).alias("__previous"), F.lead(day).over(w).alias("__next")
    )
    opens = F.col("__previous").isNull() | (F.datediff(day, "__previous") > horizon)
    closes = F.col("__next").isNull() | (F.datediff("__next", day) > horizon)
    return marked.select(
        key,
        *item,
        day,
        *carried,
        F.col("__previous").isNull().cast("bigint").alias(first),
        opens.cast("bigint").alias(active),
        closes.cast("bigint").alias(active + AGED),
    )
