"""Views stored in the catalog as text: other sessions answer from them, with the same rows and types."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tvlens.plans import stored, view_sql
from tvlens.plans.catalog import all_queries, registered, round_doubles
from tvlens.sources import versions
from tvlens.sources.sinks import create_database, write_named
from tvlens.sources.tables import crm, read_table, viewing_logs

NAMES = {"peak_times_analytics": "peak_times"}


@pytest.mark.parametrize("name", list(view_sql.VIEWS))
def test_second_session_answers_like_the_dataframe(spark, name):
    got = registered()[f"view_{name}"](spark, SF01)
    want = all_queries()[NAMES.get(name, name)](spark, SF01)
    assert got.sparkSession is not want.sparkSession
    assert sorted(got.dtypes) == sorted(want.dtypes)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_views_outlive_the_session_and_follow_their_tables(spark):
    create_database(spark, "tvlens_views")
    logs = viewing_logs(read_table(spark, SF001, "events"))
    write_named(logs.where("event_time < '2024-01-15'"), "tvlens_views.logs")
    write_named(crm(read_table(spark, SF001, "customer")), "tvlens_views.crm")
    maker = spark.newSession()
    tables = {"crm": "tvlens_views.crm", "logs": "tvlens_views.logs"}
    made = view_sql.create_views(maker, "tvlens_views", tables, dt.date(2024, 1, 31))
    del maker
    reader = spark.newSession()
    assert sorted(made) == sorted(f"tvlens_views.{n}" for n in view_sql.VIEWS)
    first = reader.sql("SELECT sum(total_events) FROM tvlens_views.daily_summary").first()[0]
    assert first == logs.where("event_time < '2024-01-15'").count()
    # Only a permanent view is there: a temporary one of this session is not.
    logs.createOrReplaceTempView("tvlens_only_here")
    assert not reader.catalog.tableExists("tvlens_only_here") and reader.catalog.tableExists("tvlens_views.peak_hours")
    write_named(logs.where("event_time >= '2024-01-15'"), "tvlens_views.logs", "append")
    again = spark.newSession().sql("SELECT sum(total_events) FROM tvlens_views.daily_summary").first()[0]
    assert again == logs.count()
    # Without a date the views take the current one.
    view_sql.create_views(spark, "tvlens_views", tables)
    text = spark.sql("SHOW CREATE TABLE tvlens_views.top_programmes").first()[0]
    assert "current_date()" in text


def test_named_version_switches_when_it_is_named_anew(spark, tmp_path):
    create_database(spark, "tvlens_views")
    path = str(tmp_path / "days")
    rows = spark.range(6).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    versions.replace(rows.where("id < 3"), path, ["day"])
    assert versions.name_version(spark, path, "tvlens_views.days") == 1
    versions.append(rows.where("id >= 3"), path, ["day"])
    view = spark.newSession().table("tvlens_views.days")
    assert view.count() == 3 and view.dtypes == rows.dtypes
    assert versions.name_version(spark, path, "tvlens_views.days") == 2
    assert sorted(spark.newSession().table("tvlens_views.days").collect()) == sorted(rows.collect())
    with pytest.raises(FileNotFoundError):
        versions.name_version(spark, str(tmp_path / "none"), "tvlens_views.none")


def test_objects_leave_out_missing_fields(spark, tmp_path):
    rows = [("1", None, "tvOS", "wifi", None, "7", 60), ("2", "Web", None, "wifi", "isp-1", None, None)]
    logs = spark.createDataFrame(
        rows, "log_id string, device_type string, os_name string, connection_type string, isp string, customer_id string, watch_seconds bigint"
    )
    path = str(tmp_path / "objects")
    versions.replace(stored.device_objects(logs), path)
    back = versions.read(spark, path)
    assert back.dtypes == [("log_id", "string"), ("object", "variant")]
    texts = {r.log_id: r.t for r in back.select("log_id", F.to_json("object").alias("t")).collect()}
    assert texts == {
        "1": '{"customer":"7","network":{"kind":"wifi"},"os":"tvOS","watched":60}',
        "2": '{"device":"Web","network":{"isp":"isp-1","kind":"wifi"}}',
    }
