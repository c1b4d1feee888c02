"""A spine of equal time slots, occupied or not, and values carried over the gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tvlens.functions.columns import ColumnLike, _c, week_start

WEEK_MINUTES = 7 * 24 * 60


def slot_of(ts: ColumnLike, minutes: int = 30) -> tuple[Column, Column]:
    """(week start, 0-based slot of the week) of a timestamp."""
    start = week_start(ts)
    seconds = F.unix_micros(_c(ts).cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return start, F.floor(seconds / F.lit(minutes * 60_000_000)).cast("int")


def slot_start(week: ColumnLike, slot: ColumnLike, minutes: int = 30) -> Column:
    return F.timestamp_add("MINUTE", _c(slot) * F.lit(minutes), _c(week)).cast("timestamp_ntz")


def week_slots(weeks: DataFrame, week: str = "week_start", minutes: int = 30, slot: str = "slot_index") -> DataFrame:
    """All slots of every week: one row for each (336 a week for half hours)."""
    if WEEK_MINUTES % minutes:
        raise ValueError("slots must divide a week")
    return weeks.withColumn(slot, F.explode(F.sequence(F.lit(0), F.lit(WEEK_MINUTES // minutes - 1))))


def weeks_between(df: DataFrame, ts: str, week: str = "week_start") -> DataFrame:
    """Every week from the first to the last one of ``ts``, with and without rows."""
    ends = df.agg(F.min(week_start(ts)).alias("a"), F.max(week_start(ts)).alias("b")).where("a IS NOT NULL")
    return ends.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 7 DAYS"))).alias(week))


def fill_slots(
    spine: DataFrame, occupied: DataFrame, counts: Sequence[str], carried: Sequence[str], week: str = "week_start", slot: str = "slot_index"
) -> DataFrame:
    """The spine with the occupied slots' columns: ``counts`` are 0 in empty
    slots, ``carried`` keep the value of the last slot that has one.

    Weeks are filled on their own; what a week starts with comes from the last
    value of each week before (one row a week), so no task sees all slots.
    """
    rows = spine.join(occupied, [week, slot], "left")
    within = Window.partitionBy(week).orderBy(slot).rowsBetween(Window.unboundedPreceding, 0)
    for c in carried:
        rows = rows.withColumn(c, F.last(c, ignorenulls=True).over(within))
    ends = rows.groupBy(week).agg(*[F.max_by(c, slot).alias(c) for c in carried])
    before = Window.orderBy(week).rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(week, *[F.last(c, ignorenulls=True).over(before).alias(f"_{c}") for c in carried])
    filled = rows.join(starts, week)
    for c in carried:
        filled = filled.withColumn(c, F.coalesce(c, f"_{c}")).drop(f"_{c}")
    return filled.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in counts})
