"""Serving queries: validations, KPI tiles, trends and top-k tables.

They read the small derived tables (daily summary, device analytics,
customer 360), so they are cheap once those are materialised; each takes the
period (``days``, ``None`` = all time), the reference date and ``k`` as
arguments.  Every ``limit`` follows a total order (a key breaks ties).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tvlens.functions.columns import per_hour, since
from tvlens.operators.bitmaps import count_members
from tvlens.plans.gold import recent_logs, top_customers, top_programmes


def _period(df: DataFrame, date_col: str, as_of, days: int | None) -> DataFrame:
    """``WHERE 1=1 [AND date_col >= as_of - days]``."""
    if days is None:
        return df
    return df.where(F.col(date_col) >= since(as_of, days))


def segment_summary(c360: DataFrame) -> DataFrame:
    """Customers, average score and average hours per viewer segment."""
    return c360.groupBy("viewer_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("engagement_score").alias("avg_engagement"),
        F.avg("total_watch_hours").alias("avg_watch_hours"),
    )


def segment_clv(c360: DataFrame) -> DataFrame:
    """:func:`segment_summary` over identified rows, plus the average CLV."""
    return (
        c360.where(F.col("customer_id").isNotNull())
        .groupBy("viewer_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.avg("engagement_score").alias("avg_engagement"),
            F.avg("total_watch_hours").alias("avg_watch_hours"),
            F.avg("estimated_clv").alias("avg_clv"),
        )
    )


def latest_days(daily: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most recent rows of the daily summary."""
    return daily.orderBy(F.col("summary_date").desc()).limit(k)


def device_events(logs: DataFrame) -> DataFrame:
    """Events, distinct users, bitrate and rebuffering per device type.

    The validation query this stands for selected bare columns next to
    ``COUNT(*)`` without grouping; here every column is an explicit aggregate
    over the log rows of the device type.
    """
    return logs.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("customer_id").alias("unique_users"),
        F.avg("bitrate_kbps").alias("avg_bitrate"),
        F.avg("rebuffer_ratio").alias("avg_rebuffer_ratio"),
    )


def crm_count(crm: DataFrame) -> DataFrame:
    """``SELECT COUNT(*) AS row_count``."""
    return crm.agg(F.count(F.lit(1)).alias("row_count"))


def platform_kpis(
    daily: DataFrame, as_of, days: int | None, logs: DataFrame | None = None, viewers: DataFrame | None = None
) -> DataFrame:
    """KPI tiles for a period over the daily summary.

    ``viewer_days`` sums the daily distinct viewers (a viewer active on three
    days counts three times) and the two ``avg_of_daily_*`` columns are
    unweighted means of daily means, as the tiles define them.  With ``viewers``
    (daily bitmaps) or ``logs`` the true number of distinct viewers of the
    period is added beside them.
    """
    kpis = _period(daily, "summary_date", as_of, days).agg(
        F.sum("total_events").alias("total_events"),
        F.sum("unique_viewers").alias("viewer_days"),
        F.sum("total_watch_hours").alias("total_watch_hours"),
        F.avg("avg_bitrate").alias("avg_of_daily_bitrate"),
        F.avg("identified_viewer_rate").alias("avg_of_daily_id_rate"),
    )
    if viewers is not None:
        members = count_members(_period(viewers, "summary_date", as_of, days), name="unique_viewers")
        return kpis.withColumn("unique_viewers", members.scalar())
    if logs is None:
        return kpis
    period_logs = logs if days is None else recent_logs(logs, as_of, days)
    return kpis.withColumn("unique_viewers", period_logs.select(F.count_distinct("customer_id")).scalar())


def daily_trend(daily: DataFrame, as_of, days: int | None) -> DataFrame:
    """Viewers, hours, ad minutes and bitrate per day of the period."""
    return (
        _period(daily, "summary_date", as_of, days)
        .select("summary_date", "unique_viewers", "total_watch_hours", "total_ad_minutes", "avg_bitrate")
        .orderBy("summary_date")
    )


def qoe_trend(daily: DataFrame, as_of, days: int | None) -> DataFrame:
    """Bitrate, buffer events and rebuffer ratio per day of the period."""
    return (
        _period(daily, "summary_date", as_of, days)
        .select("summary_date", "avg_bitrate", "avg_buffer_events", "avg_rebuffer_ratio")
        .orderBy("summary_date")
    )


def device_distribution(device: DataFrame) -> DataFrame:
    """Per device type over the device analytics rows, as the chart defines it.

    ``users`` is ``COUNT(DISTINCT unique_users)``: the number of distinct
    per-combination user *counts*, kept literally; :func:`device_events`
    gives the real distinct users.
    """
    return device.groupBy("device_type").agg(
        F.sum("total_events").alias("events"),
        F.count_distinct("unique_users").alias("users"),
        F.avg("avg_bitrate").alias("bitrate"),
    )


def top_customers_table(c360: DataFrame, k: int = 20) -> DataFrame:
    """The customer table of the dashboard: top ``k`` by score, 8 columns."""
    cols = [
        "customer_id",
        "first_name",
        "last_name",
        "subscription_level",
        "engagement_score",
        "total_watch_hours",
        "preferred_device",
        "region",
    ]
    return top_customers(c360, k, cols)


def top_programmes_table(logs: DataFrame, as_of, days: int = 7, k: int = 20) -> DataFrame:
    """The programme table of the dashboard: top ``k`` of the period, 7 columns."""
    cols = [
        "programme_id",
        "programme_date",
        "programme_hour",
        "unique_viewers",
        per_hour("total_watch_seconds").alias("total_watch_hours"),
        "completion_rate",
        "top_region",
    ]
    return top_programmes(logs, as_of, days, k, cols)


def busiest_cells(peak: DataFrame, k: int = 24) -> DataFrame:
    """The ``k`` hour x weekday cells with the most average viewers."""
    return peak.orderBy(
        F.col("avg_unique_viewers").desc_nulls_first(), F.col("viewing_hour").asc(), F.col("day_name").asc()
    ).limit(k)


def device_detail(device: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` device combinations with the most events, 8 columns."""
    return (
        device.select(
            "device_type",
            "os_name",
            "connection_type",
            "total_events",
            "unique_users",
            "avg_bitrate",
            "avg_buffer_events",
            "avg_rebuffer_ratio",
        )
        .orderBy(
            F.col("total_events").desc_nulls_first(),
            F.col("device_type").asc(),
            F.col("os_name").asc(),
            F.col("connection_type").asc(),
        )
        .limit(k)
    )
