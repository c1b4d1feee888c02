"""Plan checks: the physical plans we rely on at scale."""

import datetime as dt
import os
import tempfile

from conftest import SF01
from tests_support import overlap_ratio_literal
from tvlens.operators.numbering import dense_index
from tvlens.operators.overlap import overlap_ratio
from tvlens.plans import gold
from tvlens.sources.tables import crm, partner, read_table, viewing_logs

AS_OF = dt.date(2024, 1, 31)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df):
    df.collect()
    return _plan(df)


def test_overlap_has_no_nested_loop_join(spark):
    c = crm(read_table(spark, SF01, "customer"), AS_OF)
    p = partner(read_table(spark, SF01, "supplier"))
    assert "NestedLoopJoin" not in _final_plan(overlap_ratio(c, p))
    # the literal OR-EXISTS form does plan a nested loop join
    assert "NestedLoopJoin" in _final_plan(overlap_ratio_literal(c, p))


def test_dense_index_window_partitioned_by_bucket(spark):
    df = dense_index(spark.range(0, 1000).withColumnRenamed("id", "k"), ["k"], "rn")
    plan = _plan(df)
    assert "hashpartitioning(_b" in plan
    # the only single-partition exchange is over the per-bucket counts
    assert plan.count("SinglePartition") <= 1


def test_viewing_summary_filters_before_shuffle(spark):
    logs = viewing_logs(read_table(spark, SF01, "events"))
    plan = _plan(gold.viewing_summary(logs))
    scan_side = plan.split("Exchange")[-1]
    assert "Filter" in scan_side


def test_period_filter_reaches_parquet_scan(spark):
    logs = viewing_logs(read_table(spark, SF01, "events"))
    path = os.path.join(tempfile.mkdtemp(prefix="tvlens-logs-"), "logs")
    logs.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    plan = _plan(gold.top_programmes(stored, AS_OF, 7, 50))
    assert "GreaterThanOrEqual(slot_start_time" in plan and "GreaterThanOrEqual(event_time" in plan
    plan = _plan(gold.peak_hours(stored, AS_OF, 7))
    assert "GreaterThanOrEqual(event_time" in plan


def test_column_pruning(spark):
    logs = viewing_logs(read_table(spark, SF01, "events"))
    plan = _plan(gold.daily_summary(logs))
    # the log id is never read by the daily summary
    assert "event_id" not in plan.split("ReadSchema:")[-1].split("\n")[0]


def test_top_k_is_take_ordered(spark):
    logs = viewing_logs(read_table(spark, SF01, "events"))
    c360 = gold.customer_360(crm(read_table(spark, SF01, "customer"), AS_OF), logs, AS_OF)
    assert "TakeOrderedAndProject" in _plan(gold.top_customers(c360, 100))


def test_no_registered_query_plans_a_cross_join(spark):
    """No query pairs rows without a key (cartesian or nested-loop join)."""
    from conftest import SF001
    from tvlens.plans.catalog import all_queries

    offenders = []
    for name, fn in all_queries().items():
        plan = _plan(fn(spark, SF001))
        if "NestedLoopJoin" in plan or "CartesianProduct" in plan:
            offenders.append(name)
    assert offenders == []


def test_bucketed_tables_skip_the_customer_shuffles(spark):
    """Logs and CRM bucketed by customer_id: counting values, folding them and
    the CRM join read co-partitioned data, so the customer 360 runs without
    any exchange and gives the same rows."""
    from plan_report import final_only
    from tvlens.plans.catalog import round_doubles
    from tvlens.sources.sinks import write_bucketed

    logs = viewing_logs(read_table(spark, SF01, "events"))
    c = crm(read_table(spark, SF01, "customer"), AS_OF)
    lb = write_bucketed(logs, "tvlens_logs_b", ["customer_id"], 8)
    cb = write_bucketed(c, "tvlens_crm_b", ["customer_id"], 8)
    df = gold.customer_360(cb, lb, AS_OF)
    got = sorted(map(tuple, round_doubles(df).collect()))
    plan = final_only(df._jdf.queryExecution().executedPlan().toString())
    assert "Bucketed: true" in plan
    assert "Exchange" not in plan
    assert got == sorted(map(tuple, round_doubles(gold.customer_360(c, logs, AS_OF)).collect()))


def test_period_filters_prune_a_store_by_date(spark):
    from pyspark.sql import functions as F
    from tvlens.plans import serving
    from tvlens.streaming.daily import write_logs_partitioned

    events = read_table(spark, SF01, "events")
    logs = viewing_logs(events)
    path = os.path.join(tempfile.mkdtemp(prefix="tvlens-logs-"), "logs")
    write_logs_partitioned(logs, path)
    stored = spark.read.parquet(path)
    for df in (
        gold.top_programmes(stored, AS_OF, 7, 50),
        gold.peak_hours(stored, AS_OF, 7),
        serving.platform_kpis(gold.daily_summary(stored), AS_OF, 7, stored),
    ):
        assert "PartitionFilters: [isnotnull(event_date" in _final_plan(df)
    assert stored.count() == events.count() and F is not None
    # the driver's own events: the implied bound reaches ``ts``
    assert "GreaterThanOrEqual(ts" in _plan(gold.top_programmes(logs, AS_OF, 7, 50))


def test_customer_side_reads_the_logs_once_without_typed_aggregates(spark):
    logs = viewing_logs(read_table(spark, SF01, "events"))
    for df in (gold.viewing_summary(logs), gold.programme_analytics(logs), gold.device_analytics(logs)):
        plan = _plan(df)
        assert plan.count("FileScan") == 1
        assert "ObjectHashAggregate" not in plan and "Expand" not in plan


def test_building_a_query_starts_no_job(spark, monkeypatch):
    """Only the footers of the tables are read while a plan is built."""
    from pyspark.sql import DataFrameReader

    from conftest import SF001
    from tvlens.plans.catalog import all_queries

    opened = []
    read = DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *p, **o: (opened.append(p), read(self, *p, **o))[1])
    sc = spark.sparkContext
    for name, fn in all_queries().items():
        opened.clear()
        sc.setJobGroup(f"build-{name}", name)
        fn(spark, SF001)
        assert len(sc.statusTracker().getJobIdsForGroup(f"build-{name}")) <= len(opened), name
    sc.setJobGroup("tests", "tests")
