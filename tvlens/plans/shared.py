"""Derived views of a data folder, as lazy plans.

Each call builds the plan anew: a plan kept across calls would also keep the
file listing of its tables and miss files added since.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from tvlens.plans import gold
from tvlens.sources.tables import FIXTURE_AS_OF, crm, partner, read_table, viewing_logs

AS_OF = FIXTURE_AS_OF
LAST_UPDATED = _dt.datetime(2024, 1, 31, 0, 0, 0)


def shared_logs(spark: SparkSession, sf: str) -> DataFrame:
    return viewing_logs(read_table(spark, sf, "events"))


def shared_crm(spark: SparkSession, sf: str) -> DataFrame:
    return crm(read_table(spark, sf, "customer"), AS_OF)


def shared_partner(spark: SparkSession, sf: str) -> DataFrame:
    return partner(read_table(spark, sf, "supplier"))


def shared_c360(spark: SparkSession, sf: str) -> DataFrame:
    return gold.customer_360(shared_crm(spark, sf), shared_logs(spark, sf), AS_OF)


def shared_daily(spark: SparkSession, sf: str) -> DataFrame:
    return gold.daily_summary(shared_logs(spark, sf), LAST_UPDATED)


def shared_device(spark: SparkSession, sf: str) -> DataFrame:
    return gold.device_analytics(shared_logs(spark, sf))
