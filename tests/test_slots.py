"""The slot spine: every slot of every week, gaps filled, values carried over weeks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tvlens.operators.slots import fill_slots, slot_of, slot_start, week_slots, weeks_between


def test_slots_of_timestamps(spark):
    stamps = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 29, 59, 999999), dt.datetime(2024, 1, 7, 23, 59, 59), None]
    df = spark.createDataFrame([(t,) for t in stamps], "t timestamp_ntz")
    week, slot = slot_of("t")
    rows = df.select(week.alias("w"), slot.alias("s")).withColumn("at", slot_start("w", "s")).collect()
    monday = dt.datetime(2024, 1, 1)
    assert [(r.w, r.s) for r in rows] == [(monday, 0), (monday, 0), (monday, 335), (None, None)]
    assert rows[2]["at"] == dt.datetime(2024, 1, 7, 23, 30)
    hourly = df.select(slot_of("t", 60)[1].alias("s")).collect()
    assert [r.s for r in hourly] == [0, 0, 167, None]


def test_gaps_are_filled_and_values_carried_over_empty_weeks(spark):
    """Events in week 1 and week 4 only; nothing before the first one."""
    stamps = [dt.datetime(2024, 1, 2, 10, 5), dt.datetime(2024, 1, 2, 10, 20), dt.datetime(2024, 1, 5, 0, 0), dt.datetime(2024, 1, 24, 12, 31)]
    df = spark.createDataFrame([(t,) for t in [*stamps, None]], "t timestamp_ntz")
    spine = week_slots(weeks_between(df, "t"))
    assert spine.count() == 4 * 336
    week, slot = slot_of("t")
    occupied = df.groupBy(week.alias("week_start"), slot.alias("slot_index")).agg(F.count(F.lit(1)).alias("events"), F.max("t").alias("last"))
    rows = fill_slots(spine, occupied, ["events"], ["last"]).withColumn("at", slot_start("week_start", "slot_index")).collect()
    assert len(rows) == 4 * 336
    for r in rows:
        end = r["at"] + dt.timedelta(minutes=30)
        assert r.events == sum(r["at"] <= t < end for t in stamps)
        assert r["last"] == max((t for t in stamps if t < end), default=None)


def test_no_rows_and_odd_slots(spark):
    none = spark.createDataFrame([], "t timestamp_ntz")
    assert weeks_between(none, "t").count() == 0
    with pytest.raises(ValueError, match="divide"):
        week_slots(none, "t", 37)
