"""Invariants the source system states for its tables and views."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF01
from tvlens.plans import gold
from tvlens.sources.tables import crm, read_table, viewing_logs

AS_OF = dt.date(2024, 1, 31)


def test_daily_totals_and_shares(spark):
    logs = viewing_logs(read_table(spark, SF01, "events"))
    daily = gold.daily_summary(logs)
    assert daily.agg(F.sum("total_events")).first()[0] == logs.count()
    shares = daily.select(
        (F.col("smarttv_share") + F.col("mobile_share") + F.col("web_share") + F.col("tablet_share")).alias("s")
    ).collect()
    assert all(abs(r.s - 1.0) < 1e-12 for r in shares)


def test_customer_360_has_one_row_per_crm_row(spark):
    logs = viewing_logs(read_table(spark, SF01, "events"))
    c = crm(read_table(spark, SF01, "customer"), AS_OF)
    c360 = gold.customer_360(c, logs, AS_OF)
    assert c360.count() == c.count()
    assert c360.select("customer_id").distinct().count() == c.count()


def test_ad_load_formulas(spark):
    logs = viewing_logs(read_table(spark, SF01, "events"))
    bad = logs.where(
        (F.col("ad_breaks") != F.floor(F.col("watch_seconds") / 180))
        | (F.col("ad_total_seconds") != F.col("ad_breaks") * 30)
    ).count()
    assert bad == 0
