"""The dashboard's queries over stored tables.

The daily summary and the viewers' bitmaps of a data folder are written once,
as versioned tables partitioned by date in the shared folder, and read from
there; a query touches no raw log.  A change of the log files (names, sizes,
times) is seen at the next call, which replaces both tables; readers of the
version before keep it.

These are the queries of :mod:`tvlens.plans.serving` that the source system
runs over its materialised summary, the permanent views, answered by a second
session, and objects stored as VARIANT.  The first call for a folder runs the
jobs that write the tables; the others only read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tvlens.functions.columns import to_variant, week_start
from tvlens.operators.bitmaps import day_bitmaps, number_ids
from tvlens.plans import oracle, serving, view_sql
from tvlens.plans.gold import daily_summary
from tvlens.plans.shared import AS_OF, LAST_UPDATED, shared_crm, shared_logs
from tvlens.session import ensure_checkpoint_dir
from tvlens.sources import versions

DAY = "summary_date"


def viewer_bitmaps(logs: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """(summary_date, bucket, bits): the customers seen on each day."""
    numbers = numbers if numbers is not None else number_ids(logs, "customer_id")
    return day_bitmaps(logs, F.to_date("event_time"), "customer_id", numbers, DAY)


def publish(logs: DataFrame, root: str, last_updated=None, note: str | None = None) -> None:
    """Write (replace) the numbers, the bitmaps and, last, the daily summary under ``root``."""
    spark = logs.sparkSession
    versions.replace(number_ids(logs, "customer_id"), f"{root}/customer_numbers", note=note)
    numbers = versions.read(spark, f"{root}/customer_numbers")
    versions.replace(viewer_bitmaps(logs, numbers), f"{root}/daily_viewers", [DAY], note=note)
    versions.replace(daily_summary(logs, last_updated), f"{root}/daily_summary", [DAY], note=note)


def publish_days(logs: DataFrame, root: str, last_updated=None, note: str | None = None) -> None:
    """Add days that are not there yet: known customers keep their numbers, the
    bitmaps and the summary get the new days' rows."""
    spark = logs.sparkSession
    known = versions.read(spark, f"{root}/customer_numbers")
    versions.replace(number_ids(logs, "customer_id", known), f"{root}/customer_numbers", note=note)
    numbers = versions.read(spark, f"{root}/customer_numbers")
    versions.append(viewer_bitmaps(logs, numbers), f"{root}/daily_viewers", [DAY], note=note)
    versions.append(daily_summary(logs, last_updated), f"{root}/daily_summary", [DAY], note=note)


def serving_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(daily summary, viewer bitmaps) of a data folder, published if its logs changed."""
    root, mark = _root(spark, sf), _mark(spark, sf, "events")
    # The summary is written last: its mark vouches for all three tables.
    held = versions.record(spark, f"{root}/daily_summary")
    if held is None or held["note"] != mark:
        publish(shared_logs(spark, sf), root, LAST_UPDATED, mark)
    return versions.read(spark, f"{root}/daily_summary"), versions.read(spark, f"{root}/daily_viewers")


def _root(spark: SparkSession, sf: str) -> str:
    name = hashlib.sha256(sf.rstrip("/").encode()).hexdigest()[:16]
    return os.path.join(ensure_checkpoint_dir(spark), "tables", f"serving-{name}")


def _mark(spark: SparkSession, sf: str, table: str) -> str:
    """Names, sizes and times of a table's files, as one text."""
    return hashlib.sha256(repr(versions.listing(spark, f"{sf}/{table}.parquet")).encode()).hexdigest()


def _kept(spark: SparkSession, path: str, mark: str, rows: Callable[[], DataFrame]) -> DataFrame:
    """The stored table at ``path``, written anew if its source changed."""
    held = versions.record(spark, path)
    if held is None or held["note"] != mark:
        versions.replace(rows(), path, note=mark)
    return versions.read(spark, path)


def gold_session(spark: SparkSession, sf: str) -> tuple[SparkSession, str]:
    """A second session and the database in which it finds the permanent views.

    The CRM and the daily summary are stored tables with names; the logs are a
    view over the event file.
    """
    root, marks = _root(spark, sf), [_mark(spark, sf, t) for t in ("customer", "events")]
    serving_tables(spark, sf)
    _kept(spark, f"{root}/crm", marks[0], lambda: shared_crm(spark, sf))
    # One database for each state of the source tables; its last view tells that it is complete.
    name = hashlib.sha256("".join([root, *marks]).encode()).hexdigest()[:16]
    database = f"tvlens_{name}"
    if not spark.catalog.tableExists(f"{database}.{list(view_sql.VIEWS)[-1]}"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/catalog-{name}'")
        tables = {"crm": f"{database}.crm", "logs": f"{database}.viewing_logs", "daily": f"{database}.stored_daily"}
        versions.name_version(spark, f"{root}/crm", tables["crm"])
        versions.name_version(spark, f"{root}/daily_summary", tables["daily"])
        spark.sql(f"CREATE OR REPLACE VIEW {tables['logs']} AS {view_sql.log_view(f'{sf}/events.parquet')}")
        view_sql.create_views(spark, database, tables, AS_OF)
    return spark.newSession(), database


def from_view(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        other, database = gold_session(spark, sf)
        return other.table(f"{database}.{name}")

    query.__doc__ = f"The permanent view {name}, read by a second session."
    return query


def device_objects(logs: DataFrame) -> DataFrame:
    """(log_id, object): what an event says of device, network and viewing as
    one VARIANT; fields without a value are left out."""
    network = F.struct(F.col("connection_type").alias("kind"), F.col("isp").alias("isp"))
    fields = F.struct(
        F.col("device_type").alias("device"),
        F.col("os_name").alias("os"),
        F.col("customer_id").alias("customer"),
        F.col("watch_seconds").alias("watched"),
        network.alias("network"),
    )
    return logs.select("log_id", to_variant(fields).alias("object"))


def variant_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Objects built from columns, stored as VARIANT in Parquet, read back by path."""
    path = f"{_root(spark, sf)}/device_objects"
    stored = _kept(spark, path, _mark(spark, sf, "events"), lambda: device_objects(shared_logs(spark, sf)))
    get = lambda at, kind: F.variant_get("object", f"$.{at}", kind)
    return stored.select(
        "log_id",
        get("device", "string").alias("device"),
        get("network.kind", "string").alias("network_kind"),
        get("network.isp", "string").alias("isp"),
        get("watched", "bigint").alias("watched"),
        get("customer", "string").alias("customer"),
        F.size(F.json_object_keys(F.to_json("object"))).alias("fields"),
    )


def platform_kpis(spark: SparkSession, sf: str, days: int | None) -> DataFrame:
    """KPI tiles of a period, its distinct viewers from the bitmaps."""
    daily, viewers = serving_tables(spark, sf)
    return serving.platform_kpis(daily, AS_OF, days, viewers=viewers)


def viewers_by_week(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct viewers and viewer-days of every week."""
    _, viewers = serving_tables(spark, sf)
    week = F.to_date(week_start(F.col(DAY).cast("timestamp_ntz")))
    united = viewers.groupBy(week.alias("week"), "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.sum(F.bitmap_count("bits")).alias("days")
    )
    return united.groupBy("week").agg(
        F.sum(F.bitmap_count("bits")).alias("unique_viewers"), F.sum("days").alias("viewer_days")
    )


STORED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "latest_days": lambda s, sf: serving.latest_days(serving_tables(s, sf)[0], 10),
    "platform_kpis_7": lambda s, sf: platform_kpis(s, sf, 7),
    "platform_kpis_30": lambda s, sf: platform_kpis(s, sf, 30),
    "platform_kpis_90": lambda s, sf: platform_kpis(s, sf, 90),
    "platform_kpis_all": lambda s, sf: platform_kpis(s, sf, None),
    "daily_trend": lambda s, sf: serving.daily_trend(serving_tables(s, sf)[0], AS_OF, 30),
    "qoe_trend": lambda s, sf: serving.qoe_trend(serving_tables(s, sf)[0], AS_OF, 30),
    "viewers_by_week": viewers_by_week,
    "variant_objects": variant_objects,
    **{f"view_{name}": from_view(name) for name in view_sql.VIEWS},
}

STORED_IDS = {
    "viewers_by_week": "A2 Q11 Q20 S7",
    "variant_objects": "F26 S7 P13",
    **{f"view_{name}": "S10 S4 S12" for name in view_sql.VIEWS},
}

#: DuckDB SQL of those queries; the others have that of their namesakes.
STORED_SQL = {
    "viewers_by_week": oracle.with_ctes(oracle.LOGS)
    + """SELECT CAST(date_trunc('week', event_time) AS DATE) AS week, count(DISTINCT customer_id) AS unique_viewers,
  count(DISTINCT (CAST(event_time AS DATE), customer_id)) AS viewer_days
FROM logs WHERE customer_id IS NOT NULL GROUP BY 1""",
    "variant_objects": oracle.with_ctes(oracle.LOGS)
    + """SELECT log_id, device_type AS device, connection_type AS network_kind, isp, watch_seconds AS watched,
  customer_id AS customer,
  CAST((device_type IS NOT NULL)::INT + (os_name IS NOT NULL)::INT + (customer_id IS NOT NULL)::INT
       + (watch_seconds IS NOT NULL)::INT + 1 AS INTEGER) AS fields FROM logs""",
    **{f"view_{name}": oracle.GOLD_SQL[{"peak_times_analytics": "peak_times"}.get(name, name)] for name in view_sql.VIEWS},
}
