"""Stored serving tables and the bitmaps that answer distinct viewers of any period."""

import datetime as dt
import itertools
import os

from pyspark.sql import functions as F

from conftest import SF001, SF01
from tvlens.operators.bitmaps import count_members, day_bitmaps, number_ids
from tvlens.plans import serving, stored
from tvlens.plans.catalog import all_queries, registered
from tvlens.sources import versions
from tvlens.sources.tables import read_table, viewing_logs

AS_OF = dt.date(2024, 1, 31)


def test_numbers_are_dense_and_stay(spark):
    some = spark.createDataFrame([(x,) for x in ["b", "a", None, "c", "a"]], "id string")
    first = {r.id: r.number for r in number_ids(some, "id").collect()}
    assert sorted(first.values()) == [1, 2, 3] and set(first) == {"a", "b", "c"}
    known = spark.createDataFrame(list(first.items()), "id string, number bigint")
    more = spark.createDataFrame([("a",), ("z",), ("y",), (None,)], "id string")
    grown = {r.id: r.number for r in number_ids(more, "id", known).collect()}
    assert {k: grown[k] for k in first} == first and sorted(grown.values()) == [1, 2, 3, 4, 5]
    none = spark.createDataFrame([], "id string, number bigint")
    assert number_ids(more, "id", none).count() == 3 and number_ids(more.limit(0), "id").count() == 0


def test_bitmaps_equal_count_distinct_over_every_period(spark):
    """Ids over three buckets, hot days, NULL ids and NULL days."""
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i % 9), f"u{(i * i) % 997}") for i in range(4000)]
    rows += [(dt.date(2024, 1, 3), "hot")] * 2000 + [(None, "u1"), (None, "only"), (dt.date(2024, 1, 4), None)]
    df = spark.createDataFrame(rows, "day date, id string")
    numbers = number_ids(df, "id").withColumn("number", F.col("number") * 100)  # spread over several buckets
    bits = day_bitmaps(df, F.col("day"), "id", numbers).cache()
    assert bits.agg(F.max(F.octet_length("bits"))).first()[0] <= 4096
    days = sorted({d for d, _ in rows if d})
    for a, b in itertools.combinations_with_replacement(days, 2):
        want = len({i for d, i in rows if d and i and a <= d <= b})
        assert count_members(bits.where(F.col("day").between(a, b))).first()[0] == want
    assert count_members(bits).first()[0] == len({i for _, i in rows if i})
    assert count_members(bits.where("false")).first()[0] == 0
    by_day = {r.day: r.members for r in count_members(bits, ["day"]).collect()}
    assert by_day[None] == 2 and by_day[dt.date(2024, 1, 3)] == len({i for d, i in rows if d == dt.date(2024, 1, 3)})


def test_dashboard_queries_read_the_stored_tables(spark):
    views = [n for n in stored.STORED if n.startswith("view_")]
    for name in set(stored.STORED) - {*views, "variant_objects"}:
        df = registered()[name](spark, SF01)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "events.parquet" not in plan, name
        if name not in ("platform_kpis_all", "latest_days", "viewers_by_week"):
            assert "PartitionFilters: [isnotnull(summary_date" in plan, name
        if name in all_queries():
            assert sorted(map(str, df.collect())) == sorted(map(str, all_queries()[name](spark, SF01).collect()))


def test_stored_tables_follow_the_logs(spark, tmp_path):
    """New files: both tables are replaced; a reader of the old ones keeps them."""
    events = read_table(spark, SF001, "events")
    path = os.path.join(str(tmp_path), "events.parquet")
    events.where("event_id % 2 = 0").write.parquet(path)
    kpis = registered()["platform_kpis_all"]
    before = kpis(spark, str(tmp_path))
    half = before.first()
    assert half.total_events == events.where("event_id % 2 = 0").count()
    events.where("event_id % 2 = 1").write.mode("append").parquet(path)
    whole = kpis(spark, str(tmp_path)).first()
    assert whole.total_events == events.count() and before.first() == half
    logs = viewing_logs(events)
    assert whole.unique_viewers == logs.agg(F.count_distinct("customer_id")).first()[0]


def test_new_days_are_appended_with_the_old_numbers(spark, tmp_path):
    logs = viewing_logs(read_table(spark, SF01, "events"))
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    root = str(tmp_path)
    stored.publish(logs.where(F.col("event_time") < cut), root, "2024-01-31")
    old = {r.customer_id: r.number for r in versions.read(spark, f"{root}/customer_numbers").collect()}
    stored.publish_days(logs.where(F.col("event_time") >= cut), root, "2024-01-31")
    new = {r.customer_id: r.number for r in versions.read(spark, f"{root}/customer_numbers").collect()}
    assert {k: new[k] for k in old} == old and sorted(new.values()) == list(range(1, len(new) + 1))
    daily, bits = versions.read(spark, f"{root}/daily_summary"), versions.read(spark, f"{root}/daily_viewers")
    for days in (3, 7, 30, None):
        got = serving.platform_kpis(daily, AS_OF, days, viewers=bits).first()
        want = serving.platform_kpis(daily, AS_OF, days, logs).first()
        assert got.unique_viewers == want.unique_viewers and got.total_events == want.total_events
