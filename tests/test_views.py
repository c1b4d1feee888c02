"""The analytics as SQL views under their original names."""

import datetime as dt

from conftest import SF01
from tvlens.plans import gold, serving
from tvlens.plans.views import register_views
from tvlens.sources.tables import crm, read_table, viewing_logs

AS_OF = dt.date(2024, 1, 31)


def _rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_views_answer_sql(spark):
    """Own SQL over every view name agrees with the DataFrame functions."""
    logs = viewing_logs(read_table(spark, SF01, "events"))
    c = crm(read_table(spark, SF01, "customer"), AS_OF)
    register_views(spark, c, logs, AS_OF)
    one = lambda q: spark.sql(q).first()[0]

    assert one("SELECT sum(total_events) FROM device_analytics") == logs.count()
    assert one("SELECT sum(total_events) FROM programme_analytics") == logs.count()
    assert one("SELECT sum(total_events) FROM peak_times_analytics") == logs.count()
    assert one("SELECT count(1) FROM customer_360") == c.count()
    by_segment = spark.sql("SELECT viewer_segment, max(estimated_clv) AS best FROM customer_360 GROUP BY ALL")
    want = gold.customer_360(c, logs, AS_OF).groupBy("viewer_segment").agg({"estimated_clv": "max"})
    assert _rows(by_segment) == _rows(want)
    days = spark.sql("SELECT summary_date, unique_viewers FROM daily_summary")
    assert _rows(days) == _rows(gold.daily_summary(logs).select("summary_date", "unique_viewers"))
    for view, k in (("top_customers", 100), ("top_programmes", 50)):
        assert one(f"SELECT count(*) FROM {view}") == k
    assert one("SELECT max(avg_unique_viewers) FROM peak_hours") >= one("SELECT min(avg_unique_viewers) FROM peak_hours")


def test_publish_gold_materialises_daily(spark):
    import os
    import tempfile

    from tvlens.plans.views import publish_gold

    logs = viewing_logs(read_table(spark, SF01, "events"))
    c = crm(read_table(spark, SF01, "customer"), AS_OF)
    path = os.path.join(tempfile.mkdtemp(prefix="tvlens-gold-"), "daily_summary")
    views = publish_gold(spark, c, logs, AS_OF, path, "2024-01-31 00:00:00")
    assert os.path.isdir(path)
    lazy = gold.daily_summary(logs, "2024-01-31 00:00:00")
    assert _rows(views["daily_summary"]) == _rows(lazy)
    assert views["daily_summary"].columns == lazy.columns
    plan = spark.sql("SELECT * FROM daily_summary WHERE summary_date >= DATE'2024-01-24'")
    assert "PartitionFilters: [isnotnull(summary_date" in plan._jdf.queryExecution().executedPlan().toString()


def test_kpi_metric_definitions(spark):
    """viewer_days sums daily distinct viewers; unique_viewers is distinct
    over the period.  D6: bitrate is the unweighted mean of daily means.
    D5: device_distribution.users counts distinct per-combination counts."""
    import datetime as dt2

    from tests_support import log_rows

    logs = spark.createDataFrame(*log_rows([
        ("a", dt2.datetime(2024, 1, 30, 10), "SmartTV", 1000),
        ("a", dt2.datetime(2024, 1, 29, 10), "SmartTV", 3000),
        ("a", dt2.datetime(2024, 1, 29, 11), "SmartTV", 3000),
        ("b", dt2.datetime(2024, 1, 29, 12), "Mobile", 2000),
    ]))
    k = serving.platform_kpis(gold.daily_summary(logs), AS_OF, 7, logs).collect()[0]
    assert k.viewer_days == 3 and k.unique_viewers == 2
    assert k.avg_of_daily_bitrate == (1000 + (3000 + 3000 + 2000) / 3) / 2
    dist = {r.device_type: r.users for r in serving.device_distribution(gold.device_analytics(logs)).collect()}
    assert dist == {"SmartTV": 1, "Mobile": 1}
