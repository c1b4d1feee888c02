"""Register the analytics as SQL views under their original names.

After ``register_views(spark, crm, logs, as_of)`` the dashboard's and the
validation queries run as SQL text on Spark, e.g.
``spark.sql("SELECT * FROM top_customers LIMIT 20")``.  The views are lazy
DataFrames; ``daily`` may be a materialised daily summary (then the serving
queries read that table instead of recomputing it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tvlens.plans import gold
from tvlens.sources import versions

VIEW_NAMES = (
    "customer_360",
    "programme_analytics",
    "peak_times_analytics",
    "device_analytics",
    "daily_summary",
    "top_customers",
    "top_programmes",
    "peak_hours",
)


def register_views(
    spark: SparkSession,
    crm: DataFrame,
    logs: DataFrame,
    as_of,
    daily: DataFrame | None = None,
    days: int = 7,
) -> dict[str, DataFrame]:
    """Create or replace the temp views; returns them by name."""
    c360 = gold.customer_360(crm, logs, as_of)
    views = {
        "customer_360": c360,
        "programme_analytics": gold.programme_analytics(logs),
        "peak_times_analytics": gold.peak_times(logs),
        "device_analytics": gold.device_analytics(logs),
        "daily_summary": daily if daily is not None else gold.daily_summary(logs),
        "top_customers": gold.top_customers(c360, 100),
        "top_programmes": gold.top_programmes(logs, as_of, days, 50),
        "peak_hours": gold.peak_hours(logs, as_of, days),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def publish_gold(
    spark: SparkSession,
    crm: DataFrame,
    logs: DataFrame,
    as_of,
    daily_path: str,
    last_updated=None,
) -> dict[str, DataFrame]:
    """Build the analytics layer: materialise the daily summary, register views.

    The daily summary is written once (a new version that replaces the last
    one as a whole, partitioned by date so that period filters prune files) and
    the serving views read the written table; every other view stays lazy,
    recomputed on read.
    """
    versions.replace(gold.daily_summary(logs, last_updated), daily_path, ["summary_date"])
    return register_views(spark, crm, logs, as_of, daily=versions.read(spark, daily_path))
