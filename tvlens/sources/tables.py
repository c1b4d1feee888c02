"""Readers for the parquet inputs and the three views the analytics use.

``viewing_logs`` (22 columns), ``crm`` (10 columns) and ``partner`` (4
columns) are derived from the driver tables ``events``, ``customer`` and
``supplier``.  Every log column is a rule over the event's own columns (time,
user, type, value, properties), so group sizes, ties and NULLs are those of
the data; every value depends on its row only.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tvlens.functions.columns import padded
from tvlens.operators.generators import ad_load
from tvlens.operators.labels import assign_quota_by_key

# Reference date used by the fixtures (the driver data ends on 2024-01-30).
FIXTURE_AS_OF = _dt.date(2024, 1, 31)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# How the fixture reads an event: device by the ``k`` of its properties, system
# by its value, network and log event by its type.  Sign-ups have no customer
# yet, errors no watch time.
DEVICE_BELOW = ((40, "SmartTV"), (70, "Mobile"), (90, "Web"))
DEVICE_OTHER = "Tablet"
SYSTEM_BELOW = ((10.0, "tvOS"), (40.0, "Android"), (90.0, "iOS"))
SYSTEM_OTHER = "webOS"
NETWORKS = {"view": "ethernet", "click": "wifi", "purchase": "wifi"}
NETWORK_OTHER = "cellular"
LOG_EVENTS = {"view": "play_start", "purchase": "play_end", "error": "pause", "click": "seek"}
LOG_EVENT_OTHER = "play"
ANONYMOUS_TYPE = "signup"
UNWATCHED_TYPE = "error"

# CRM subscription level by market segment (others -> TRIAL,
# a level the CLV price list does not know).
SEGMENT_LEVELS = {
    "BUILDING": "FREE",
    "AUTOMOBILE": "BASIC",
    "MACHINERY": "STANDARD",
    "FURNITURE": "PREMIUM",
}
UNKNOWN_LEVEL = "TRIAL"

LOG_COLUMNS = (
    "log_id channel event_time slot_start_time programme_id customer_id device_type "
    "os_name connection_type bitrate_kbps buffer_events rebuffer_ratio watch_seconds "
    "ad_breaks ad_total_seconds event_type ip_address isp country region city device"
).split()

CRM_COLUMNS = (
    "customer_id email phone first_name last_name gender profession date_joined "
    "subscription_level overlap_type"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a lazy parquet scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _below(column: str, bounds, other: str) -> str:
    """CASE text: the first bound above the column, ``other`` beyond the last, NULL for NULL."""
    cases = " ".join(f"WHEN {column} < {top} THEN '{name}'" for top, name in bounds)
    return f"CASE {cases} WHEN {column} IS NOT NULL THEN '{other}' END"


def _mapped(column: str, mapping, other: str) -> str:
    return f"CASE {column} {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())} ELSE '{other}' END"


def log_rules(channel: str = "CH", country: str = "FR") -> dict[str, str]:
    """The log columns as SQL text over an event's columns and ``_k``, the ``k`` of its properties."""
    return {
        "log_id": "CAST(event_id AS STRING)",
        "channel": f"'{channel}'",
        "event_time": "CAST(ts AS TIMESTAMP_NTZ)",
        "slot_start_time": "CAST(date_trunc('hour', ts) AS TIMESTAMP_NTZ)",
        "programme_id": f"concat('{channel}-', date_format(ts, 'yyyyMMdd-HH'))",
        "customer_id": f"CASE WHEN event_type <> '{ANONYMOUS_TYPE}' THEN CAST(user_id AS STRING) END",
        "device_type": _below("_k", DEVICE_BELOW, DEVICE_OTHER),
        "os_name": _below("value", [(f"{top}D", name) for top, name in SYSTEM_BELOW], SYSTEM_OTHER),
        "connection_type": _mapped("event_type", NETWORKS, NETWORK_OTHER),
        "bitrate_kbps": "CAST(500 + floor(value * 40D) AS BIGINT)",
        "buffer_events": "CAST(floor(_k / 12) AS BIGINT)",
        "rebuffer_ratio": "value / 1000D",
        "watch_seconds": f"CASE WHEN event_type <> '{UNWATCHED_TYPE}' THEN CAST(floor(value * 60D) AS BIGINT) END",
        "event_type": _mapped("event_type", LOG_EVENTS, LOG_EVENT_OTHER),
        "ip_address": "concat_ws('.', '10', _k, user_id % 256, event_id % 256)",
        "isp": "concat('isp-', CAST(_k % 5 AS STRING))",
        "country": f"'{country}'",
        "region": "concat('region_', CAST(floor(value) % 8 AS STRING))",
        "city": "concat('city_', CAST(user_id % 25 AS STRING))",
        "device": "props",
    }


#: The ``k`` of an event's properties; a column of its own, so that it is parsed once.
EVENT_K = "CAST(get_json_object(props, '$.k') AS INT)"


def viewing_logs(events: DataFrame, channel: str = "CH", country: str = "FR") -> DataFrame:
    """The viewing-log table: one row for each event, all users kept.

    ``customer_id`` is NULL for sign-ups, watch time (and with it ad load) for
    errors; ``device`` is the event's JSON ``props`` text.
    """
    rules = log_rules(channel, country)
    logs = events.selectExpr("*", f"{EVENT_K} AS _k").selectExpr(*[f"{text} AS {name}" for name, text in rules.items()])
    return ad_load(logs).select(*LOG_COLUMNS)


def quota_ranks() -> list:
    """(label, cumulative rank of the row count) of the overlap labels.

    25 % of the rows overlap, split 8:10:7 into TRIPLE / EMAIL / PHONE; every
    split is rounded half to even, the last part takes the remainder.
    """

    def target(rows: Column) -> Column:
        return F.bround(rows.cast("double") * F.lit(0.25), 0)

    def part(rows: Column, weight: float) -> Column:
        return F.bround(target(rows) * F.lit(weight) / F.lit(25.0), 0)

    return [
        ("TRIPLE", lambda rows: part(rows, 8.0)),
        ("EMAIL", lambda rows: part(rows, 8.0) + part(rows, 10.0)),
        ("PHONE", target),
    ]


def crm(customer: DataFrame, as_of=FIXTURE_AS_OF) -> DataFrame:
    """The CRM table derived from ``customer``.

    Email is missing for 15 % (``key % 20 < 3``), phone for 20 %
    (``key % 5 = 4``); the overlap label comes from the row's ordinal in key
    order and cumulative quotas (see :func:`quota_ranks`).
    """
    labelled = assign_quota_by_key(customer, "c_custkey", quota_ranks(), "NONE", "overlap_type")
    return labelled.selectExpr(
        "CAST(c_custkey AS STRING) AS customer_id",
        "CASE WHEN c_custkey % 20 >= 3 THEN concat('c', CAST(c_custkey AS STRING), '@example.com') END AS email",
        "CASE WHEN c_custkey % 5 <> 4 THEN concat('06 ', lpad(CAST(c_custkey AS STRING), 8, '0')) END AS phone",
        "c_name AS first_name",
        "concat('nation-', CAST(c_nationkey AS STRING)) AS last_name",
        "CASE pmod(c_custkey, 2) WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' END AS gender",
        "concat('profession-', CAST(c_custkey % 8 AS STRING)) AS profession",
        f"date_sub(DATE'{as_of}', CAST(c_custkey * 37 % 3651 AS INT)) AS date_joined",
        f"{_mapped('c_mktsegment', SEGMENT_LEVELS, UNKNOWN_LEVEL)} AS subscription_level",
        "overlap_type",
    )


def partner(supplier: DataFrame) -> DataFrame:
    """The partner CRM derived from ``supplier`` (email / phone / names)."""
    key = F.col("s_suppkey")
    return supplier.select(
        F.concat(F.lit("c"), (key * F.lit(7)).cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("06 "), padded(key * F.lit(11), 8)).alias("phone"),
        F.col("s_name").alias("first_name"),
        F.concat(F.lit("nation-"), F.col("s_nationkey").cast("string")).alias("last_name"),
    )


def load_views(spark: SparkSession, sf_dir: str, as_of=FIXTURE_AS_OF) -> dict[str, DataFrame]:
    """The three analytic inputs for one scale-factor folder."""
    return {
        "logs": viewing_logs(read_table(spark, sf_dir, "events")),
        "crm": crm(read_table(spark, sf_dir, "customer"), as_of),
        "partner": partner(read_table(spark, sf_dir, "supplier")),
    }
