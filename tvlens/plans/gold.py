"""The analytics layer: customer 360, programme / peak-time / device
analytics, daily summary and the ranking views built on them.

Plan notes (checked with ``explain``):

* ``viewing_summary``, ``programme_analytics`` and ``device_analytics`` read the
  logs once.  Rows are unpivoted to (group, tag, value) and counted by a hash
  aggregate with fixed-size state, combined before the shuffle; distinct
  counts, modes and medians are then taken from one row for each distinct
  value (:func:`grouped_values`).  A customer with a third of the rows ships
  its distinct values of each map task, not its rows.  ``viewing_summary``
  drops the rows without a customer before that.
* ``customer_360`` joins the CRM with the summary **once**.  The score, CLV
  and segment are functions of the joined row, so the second join of the
  original view (against a second copy of the summary) is not needed.
* Period filters come with the predicates they imply on ``event_time`` and, in
  a store partitioned by it, on ``event_date`` (:func:`recent_logs`), so they
  prune partitions and row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvlens.functions.columns import (
    day_gap,
    day_name,
    dow0,
    per_hour,
    per_minute,
    ratio,
    share_if,
    since,
    strict_greatest,
    strict_least,
    value_map,
)
from tvlens.operators.joins import (
    grouped_values,
    value_distinct,
    value_mean,
    value_median,
    value_mode,
    value_rows,
    value_sum,
    with_ranks,
)

# Overlap labels that make a customer cross-platform.
CROSS_PLATFORM_LABELS = ("TRIPLE", "EMAIL", "PHONE", "NAME")
CROSS_PLATFORM = "Cross-Platform"
PLATFORM_ONLY = "Platform Only"

# Monthly price per subscription level (unknown level -> NULL).
LEVEL_PRICES = {"FREE": 0.0, "BASIC": 4.99, "STANDARD": 9.99, "PREMIUM": 14.99}

# Viewer segments by total watch hours (lower bounds).
SEGMENT_BOUNDS = ((50, "Heavy Viewer"), (20, "Regular Viewer"), (5, "Light Viewer"))
SEGMENT_OTHER = "Minimal Viewer"
NO_ACTIVITY = "No Activity"

# Activity status by days since the last view.
ACTIVE_DAYS = 7
RECENT_DAYS = 30

DEVICE_TYPES = ("SmartTV", "Mobile", "Web", "Tablet")


# --- customer 360 -------------------------------------------------------------
def customer_base(crm: DataFrame, only_label: str = PLATFORM_ONLY) -> DataFrame:
    """CRM columns plus ``customer_type`` from the overlap label.

    DUPLICATE, NONE and NULL labels are all single-platform.
    """
    cross = F.coalesce(F.col("overlap_type").isin(*CROSS_PLATFORM_LABELS), F.lit(False))
    return crm.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "phone",
        "gender",
        "profession",
        "date_joined",
        "subscription_level",
        F.when(cross, CROSS_PLATFORM).otherwise(only_label).alias("customer_type"),
        "overlap_type",
    )


VIEWING_SUMMARY_COLUMNS = (
    "customer_id total_events active_days unique_programmes_watched total_watch_seconds avg_watch_seconds "
    "total_ad_seconds preferred_device device_types_used preferred_connection avg_bitrate avg_buffer_events "
    "avg_rebuffer_ratio region city isp first_viewing_date last_viewing_date viewing_span_days"
).split()


def _quality() -> dict[str, Column]:
    """Measures that every log view averages."""
    return {
        "watch": F.col("watch_seconds"),
        "bitrate": F.col("bitrate_kbps"),
        "buffer": F.col("buffer_events"),
        "rebuffer": F.col("rebuffer_ratio"),
    }


def viewing_summary(logs: DataFrame) -> DataFrame:
    """One row per identified customer: volume, variety, QoE, habits, dates."""
    identified = logs.where(F.col("customer_id").isNotNull())
    values = grouped_values(
        identified,
        ["customer_id"],
        {
            "device": F.col("device_type"),
            "connection": F.col("connection_type"),
            "region": F.col("region"),
            "city": F.col("city"),
            "isp": F.col("isp"),
            "programme": F.col("programme_id"),
            "day": F.to_date("event_time"),
        },
        {**_quality(), "ad": F.col("ad_total_seconds")},
        F.col("event_time"),
    )
    out = values.groupBy("customer_id").agg(
        value_rows().alias("total_events"),
        value_distinct("day").alias("active_days"),
        value_distinct("programme").alias("unique_programmes_watched"),
        value_sum("watch").cast("bigint").alias("total_watch_seconds"),
        value_mean("watch").alias("avg_watch_seconds"),
        value_sum("ad").cast("bigint").alias("total_ad_seconds"),
        value_mode("device").alias("preferred_device"),
        value_distinct("device").alias("device_types_used"),
        value_mode("connection").alias("preferred_connection"),
        value_mean("bitrate").alias("avg_bitrate"),
        value_mean("buffer").alias("avg_buffer_events"),
        value_mean("rebuffer").alias("avg_rebuffer_ratio"),
        value_mode("region").alias("region"),
        value_mode("city").alias("city"),
        value_mode("isp").alias("isp"),
        F.min("_first").alias("first_viewing_date"),
        F.max("_last").alias("last_viewing_date"),
    )
    span = day_gap("first_viewing_date", "last_viewing_date") + F.lit(1)
    return out.withColumn("viewing_span_days", span).select(*VIEWING_SUMMARY_COLUMNS)


def engagement_score(watch_seconds: Column, active_days: Column, programmes: Column) -> Column:
    """``LEAST(100, hours * 2 + active_days * 3 + programmes * 0.5)``.

    NULL when any input is NULL (e.g. only NULL watch seconds), not 100.
    """
    raw = per_hour(watch_seconds) * F.lit(2.0) + active_days * F.lit(3) + programmes * F.lit(0.5)
    return strict_least(F.lit(100.0), raw)


def estimated_clv(level: Column, span_days: Column) -> Column:
    """Monthly price of the level times ``GREATEST(1, span_days / 30.0)``.

    An unknown level has no price: the result is NULL.
    """
    price = value_map(level, LEVEL_PRICES)
    return price * strict_greatest(F.lit(1.0), span_days.cast("double") / F.lit(30.0))


def viewer_segment(watch_seconds: Column) -> Column:
    """Heavy (>= 50 h), Regular (>= 20 h), Light (>= 5 h), else Minimal."""
    hours = per_hour(watch_seconds)
    expr = None
    for bound, label in SEGMENT_BOUNDS:
        cond = hours >= F.lit(float(bound))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(SEGMENT_OTHER)


def activity_status(last_view: Column, as_of) -> Column:
    """Never Active / Active (<= 7 days) / Recently Active (<= 30) / Inactive.

    A view after ``as_of`` has a negative gap and counts as Active.
    """
    gap = day_gap(last_view, F.lit(as_of).cast("date"))
    return (
        F.when(last_view.isNull(), "Never Active")
        .when(gap <= ACTIVE_DAYS, "Active")
        .when(gap <= RECENT_DAYS, "Recently Active")
        .otherwise("Inactive")
    )


def engagement_scores(crm: DataFrame, logs: DataFrame) -> DataFrame:
    """Score, CLV and segment for customers that have log rows (inner join)."""
    v = viewing_summary(logs)
    c = customer_base(crm).select("customer_id", "subscription_level")
    j = v.join(c, "customer_id")
    return j.select(
        "customer_id",
        engagement_score(F.col("total_watch_seconds"), F.col("active_days"), F.col("unique_programmes_watched")).alias(
            "engagement_score"
        ),
        estimated_clv(F.col("subscription_level"), F.col("viewing_span_days")).alias("estimated_clv"),
        viewer_segment(F.col("total_watch_seconds")).alias("viewer_segment"),
    )


def customer_360(crm: DataFrame, logs: DataFrame, as_of) -> DataFrame:
    """Every CRM row with its viewing behaviour, scores and activity status.

    One left join of the CRM with :func:`viewing_summary`.  Every CRM row
    comes out once, also where ``customer_id`` repeats (the summary has one row
    for each customer); :func:`assert_unique` checks a CRM before it is stored.
    """
    c = customer_base(crm)
    v = viewing_summary(logs)
    j = c.join(v, "customer_id", "left")
    has_logs = F.col("total_events").isNotNull()
    score = engagement_score(F.col("total_watch_seconds"), F.col("active_days"), F.col("unique_programmes_watched"))
    clv = estimated_clv(F.col("subscription_level"), F.col("viewing_span_days"))
    segment = F.when(has_logs, viewer_segment(F.col("total_watch_seconds")))
    return j.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "phone",
        "gender",
        "profession",
        "subscription_level",
        "customer_type",
        "date_joined",
        F.coalesce(F.col("total_events"), F.lit(0).cast("long")).alias("total_events"),
        F.coalesce(F.col("active_days"), F.lit(0).cast("long")).alias("active_days"),
        F.coalesce(F.col("unique_programmes_watched"), F.lit(0).cast("long")).alias("unique_programmes_watched"),
        F.coalesce(per_hour("total_watch_seconds"), F.lit(0.0)).alias("total_watch_hours"),
        F.coalesce(F.col("avg_watch_seconds"), F.lit(0.0)).alias("avg_watch_seconds"),
        F.coalesce(per_minute("total_ad_seconds"), F.lit(0.0)).alias("total_ad_minutes"),
        "preferred_device",
        "device_types_used",
        "preferred_connection",
        "avg_bitrate",
        "avg_buffer_events",
        "avg_rebuffer_ratio",
        "region",
        "city",
        "isp",
        "first_viewing_date",
        "last_viewing_date",
        "viewing_span_days",
        F.coalesce(F.when(has_logs, score), F.lit(0.0)).alias("engagement_score"),
        F.coalesce(F.when(has_logs, clv), F.lit(0.0)).alias("estimated_clv"),
        F.coalesce(segment, F.lit(NO_ACTIVITY)).alias("viewer_segment"),
        activity_status(F.col("last_viewing_date"), as_of).alias("activity_status"),
    )


def assert_unique(df: DataFrame, key: str) -> None:
    """Raise when ``key`` repeats (one aggregate pass; returns at most 1 row)."""
    dup = df.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"{key} is not unique, e.g. {dup[0][key]!r}")


# --- log analytics --------------------------------------------------------------
PROGRAMME_COLUMNS = (
    "programme_id programme_date programme_hour total_events unique_viewers hours_with_activity "
    "total_watch_seconds avg_watch_seconds median_watch_seconds avg_bitrate avg_buffer_events "
    "avg_rebuffer_ratio total_ad_seconds avg_ad_breaks smarttv_viewers mobile_viewers web_viewers "
    "tablet_viewers top_region regions_reached play_starts play_ends pauses seeks completion_rate"
).split()


def programme_analytics(logs: DataFrame) -> DataFrame:
    """Programme x slot date x slot hour: 22 viewing, QoE, ad and event metrics."""
    keys = ["programme_id", "programme_date", "programme_hour"]
    keyed = logs.withColumn("programme_date", F.to_date("slot_start_time")).withColumn(
        "programme_hour", F.hour("slot_start_time")
    )
    is_type = {"starts": "play_start", "ends": "play_end", "pauses": "pause", "seeks": "seek"}
    values = grouped_values(
        keyed,
        keys,
        {
            "viewer": F.col("customer_id"),
            "hour": F.hour("event_time"),
            "region": F.col("region"),
            "watch": F.col("watch_seconds"),
        },
        {
            **_quality(),
            "ad": F.col("ad_total_seconds"),
            "breaks": F.col("ad_breaks"),
            **{d: (F.col("device_type") == d).cast("int") for d in DEVICE_TYPES},
            **{name: (F.col("event_type") == t).cast("int") for name, t in is_type.items()},
        },
    )
    total = lambda name: F.coalesce(value_sum(name), F.lit(0)).cast("bigint")
    out = (
        with_ranks(values, keys, "watch")
        .groupBy(*keys)
        .agg(
            value_rows().alias("total_events"),
            value_distinct("viewer").alias("unique_viewers"),
            value_distinct("hour").alias("hours_with_activity"),
            value_sum("watch").cast("bigint").alias("total_watch_seconds"),
            value_mean("watch").alias("avg_watch_seconds"),
            value_median("watch").alias("median_watch_seconds"),
            value_mean("bitrate").alias("avg_bitrate"),
            value_mean("buffer").alias("avg_buffer_events"),
            value_mean("rebuffer").alias("avg_rebuffer_ratio"),
            value_sum("ad").cast("bigint").alias("total_ad_seconds"),
            value_mean("breaks").alias("avg_ad_breaks"),
            *[total(d).alias(f"{d.lower()}_viewers") for d in DEVICE_TYPES],
            value_mode("region").alias("top_region"),
            value_distinct("region").alias("regions_reached"),
            total("starts").alias("play_starts"),
            total("ends").alias("play_ends"),
            total("pauses").alias("pauses"),
            total("seeks").alias("seeks"),
        )
    )
    return out.withColumn("completion_rate", ratio(F.col("play_ends"), F.col("play_starts"))).select(
        *PROGRAMME_COLUMNS
    )


def peak_times(logs: DataFrame) -> DataFrame:
    """Date x hour (x weekday): activity, engagement, quality and device mix."""
    return (
        logs.groupBy(
            F.to_date("event_time").alias("viewing_date"),
            F.hour("event_time").alias("viewing_hour"),
            dow0("event_time").alias("day_of_week"),
        )
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_distinct("customer_id").alias("unique_viewers"),
            F.count_distinct("programme_id").alias("unique_programmes"),
            F.sum("watch_seconds").alias("total_watch_seconds"),
            F.avg("watch_seconds").alias("avg_watch_seconds"),
            F.avg("bitrate_kbps").alias("avg_bitrate"),
            F.avg("buffer_events").alias("avg_buffer_events"),
            *[share_if(F.col("device_type") == d).alias(f"{d.lower()}_pct") for d in DEVICE_TYPES],
        )
        .withColumn("day_name", day_name("day_of_week"))
        .select(
            "viewing_date",
            "viewing_hour",
            "day_of_week",
            "day_name",
            "total_events",
            "unique_viewers",
            "unique_programmes",
            "total_watch_seconds",
            "avg_watch_seconds",
            "avg_bitrate",
            "avg_buffer_events",
            *[f"{d.lower()}_pct" for d in DEVICE_TYPES],
        )
    )


DEVICE_COLUMNS = (
    "device_type os_name connection_type total_events unique_users unique_programmes total_watch_seconds "
    "avg_watch_seconds avg_bitrate avg_buffer_events avg_rebuffer_ratio identified_users identification_rate "
    "regions_used top_region peak_hour active_days"
).split()


def device_analytics(logs: DataFrame) -> DataFrame:
    """Device x OS x connection: usage, engagement, QoE, identification, habits."""
    keys = ["device_type", "os_name", "connection_type"]
    values = grouped_values(
        logs,
        keys,
        {
            "user": F.col("customer_id"),
            "programme": F.col("programme_id"),
            "region": F.col("region"),
            "hour": F.hour("event_time"),
            "day": F.to_date("event_time"),
        },
        {**_quality(), "identified": F.col("customer_id").isNotNull().cast("int")},
    )
    out = values.groupBy(*keys).agg(
        value_rows().alias("total_events"),
        value_distinct("user").alias("unique_users"),
        value_distinct("programme").alias("unique_programmes"),
        value_sum("watch").cast("bigint").alias("total_watch_seconds"),
        value_mean("watch").alias("avg_watch_seconds"),
        value_mean("bitrate").alias("avg_bitrate"),
        value_mean("buffer").alias("avg_buffer_events"),
        value_mean("rebuffer").alias("avg_rebuffer_ratio"),
        value_sum("identified").cast("bigint").alias("identified_users"),
        value_mean("identified").alias("identification_rate"),
        value_distinct("region").alias("regions_used"),
        value_mode("region").alias("top_region"),
        value_mode("hour", "int").alias("peak_hour"),
        value_distinct("day").alias("active_days"),
    )
    return out.select(*DEVICE_COLUMNS)


def daily_summary(logs: DataFrame, last_updated=None) -> DataFrame:
    """Per date: volume, viewers, hours, ad minutes, QoE, device and ID shares.

    ``last_updated`` is the audit timestamp (timestamp_ntz); by default the
    time of the run.
    """
    stamp = (
        F.current_timestamp().cast("timestamp_ntz")
        if last_updated is None
        else F.lit(str(last_updated)).cast("timestamp_ntz")
    )
    return (
        logs.groupBy(F.to_date("event_time").alias("summary_date"))
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_distinct("customer_id").alias("unique_viewers"),
            F.count_distinct("programme_id").alias("unique_programmes"),
            per_hour(F.sum("watch_seconds")).alias("total_watch_hours"),
            F.avg("watch_seconds").alias("avg_watch_seconds"),
            per_minute(F.sum("ad_total_seconds")).alias("total_ad_minutes"),
            F.avg("bitrate_kbps").alias("avg_bitrate"),
            F.avg("buffer_events").alias("avg_buffer_events"),
            F.avg("rebuffer_ratio").alias("avg_rebuffer_ratio"),
            *[share_if(F.col("device_type") == d).alias(f"{d.lower()}_share") for d in DEVICE_TYPES],
            share_if(F.col("customer_id").isNotNull()).alias("identified_viewer_rate"),
        )
        .withColumn("last_updated", stamp)
    )


# --- rankings over the views ------------------------------------------------------

TOP_CUSTOMER_COLUMNS = (
    "customer_id first_name last_name subscription_level viewer_segment engagement_score "
    "total_watch_hours unique_programmes_watched preferred_device region estimated_clv"
).split()


def top_customers(c360: DataFrame, k: int = 100, columns=TOP_CUSTOMER_COLUMNS) -> DataFrame:
    """The ``k`` customers with the highest engagement score (ties by id)."""
    return (
        c360.where(F.col("customer_id").isNotNull())
        .select(*columns)
        .orderBy(F.col("engagement_score").desc_nulls_first(), F.col("customer_id").asc())
        .limit(k)
    )


def recent_logs(logs: DataFrame, as_of, days: int, column: str = "event_time") -> DataFrame:
    """Log rows whose ``column`` (``event_time`` or ``slot_start_time``) is in the
    last ``days`` days.

    An event is never before its slot, so a bound on the slot implies the same
    bound on ``event_time``, which is stored and has statistics; in a store
    partitioned by ``event_date`` the date's bound prunes partitions.
    """
    start = since(as_of, days)
    out = logs.where(F.col(column) >= start.cast("timestamp_ntz"))
    if column != "event_time":
        out = out.where(F.col("event_time") >= start.cast("timestamp_ntz"))
    return out.where(F.col("event_date") >= start) if "event_date" in logs.columns else out


def top_programmes(logs: DataFrame, as_of, days: int = 7, k: int = 50, columns=None) -> DataFrame:
    """The ``k`` programmes of the last ``days`` days with most viewers.

    The period filter is on the slot start (see :func:`recent_logs`).
    """
    recent = recent_logs(logs, as_of, days, "slot_start_time")
    pa = programme_analytics(recent)
    cols = columns or [
        "programme_id",
        "programme_date",
        "programme_hour",
        "unique_viewers",
        per_hour("total_watch_seconds").alias("total_watch_hours"),
        "completion_rate",
        "avg_bitrate",
        "top_region",
    ]
    return (
        pa.select(*cols)
        .orderBy(
            F.col("unique_viewers").desc_nulls_first(),
            F.col("programme_date").desc(),
            F.col("programme_hour").asc(),
            F.col("programme_id").asc(),
        )
        .limit(k)
    )


def peak_hours(logs: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Hour x weekday averages over the daily rows of the last ``days`` days.

    Unordered: a view's ORDER BY has no effect on its readers, who sort
    (e.g. :func:`tvlens.plans.serving.busiest_cells`).
    """
    recent = recent_logs(logs, as_of, days)
    pt = peak_times(recent)
    return (
        pt.groupBy("viewing_hour", "day_name", "day_of_week")
        .agg(
            F.avg("unique_viewers").alias("avg_unique_viewers"),
            per_hour(F.avg("total_watch_seconds")).alias("avg_watch_hours"),
            F.avg("smarttv_pct").alias("avg_smarttv_share"),
            F.avg("mobile_pct").alias("avg_mobile_share"),
        )
        .drop("day_of_week")
    )
