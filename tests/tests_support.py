"""Inline log rows for unit tests."""

LOG_SCHEMA = (
    "log_id string, event_time timestamp_ntz, slot_start_time timestamp_ntz, programme_id string, "
    "customer_id string, device_type string, os_name string, connection_type string, bitrate_kbps bigint, "
    "buffer_events bigint, rebuffer_ratio double, watch_seconds bigint, ad_breaks bigint, "
    "ad_total_seconds bigint, event_type string, isp string, region string, city string"
)


def log_rows(specs):
    """(customer, time, device, bitrate) tuples -> (rows, schema) for createDataFrame."""
    rows = []
    for i, (cid, ts, device, bitrate) in enumerate(specs):
        slot = ts.replace(minute=0, second=0, microsecond=0)
        rows.append(
            (str(i), ts, slot, f"P-{slot:%Y%m%d%H}", cid, device, "os", "wifi", bitrate, 1, 0.01, 600, 3, 90,
             "play", "isp", "r1", "c1")
        )
    return rows, LOG_SCHEMA


def _all_operators():
    """All public functions of the operator modules under one name."""
    from types import SimpleNamespace

    from tvlens.operators import generators, joins, labels, numbering

    found = {n: f for m in (generators, joins, labels, numbering) for n, f in vars(m).items() if callable(f)}
    return SimpleNamespace(**found)


T = _all_operators()


def overlap_ratio_literal(crm, partner):
    """The query exactly as written, through Spark SQL (for plan comparison).

    Correct, but the OR inside EXISTS leaves a nested-loop semi join; use
    ``overlap_ratio`` for large inputs.
    """
    spark = crm.sparkSession
    crm.createOrReplaceTempView("_ov_crm")
    partner.createOrReplaceTempView("_ov_partner")
    return spark.sql(
        """
        SELECT CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM _ov_crm) AS overlap_ratio
        FROM _ov_crm c
        WHERE EXISTS (SELECT 1 FROM _ov_partner s WHERE s.email = c.email OR s.phone = c.phone)
        """
    )
