"""Sinks: replace, append (created once, rows not doubled), schema-only, views."""

import os
import tempfile

import pytest

from conftest import SF001
from tvlens.plans import gold
from tvlens.sources import sinks
from tvlens.sources.tables import read_table, viewing_logs


def test_overwrite_then_append(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tvlens-sink-"), "t")
    df = spark.range(0, 10)
    sinks.write_table(df, path, "append")  # table missing: created, rows written once
    assert sinks.read_written(spark, path).count() == 10
    sinks.write_table(df, path, "append")
    assert sinks.read_written(spark, path).count() == 20
    sinks.write_table(df, path, "overwrite")
    assert sinks.read_written(spark, path).count() == 10


def test_partitioned_write_and_pruning(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tvlens-sink-"), "daily")
    daily = gold.daily_summary(viewing_logs(read_table(spark, SF001, "events")), "2024-01-31 00:00:00")
    sinks.write_table(daily, path, "overwrite", ["summary_date"])
    back = sinks.read_written(spark, path).where("summary_date >= DATE'2024-01-24'")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(summary_date" in plan
    assert back.count() == daily.where("summary_date >= DATE'2024-01-24'").count()


def test_schema_only_and_view(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    empty = sinks.schema_only(df)
    assert empty.count() == 0 and empty.schema == df.schema
    sinks.register_view(df, "tvlens_test_view")
    assert spark.sql("SELECT count(*) AS n FROM tvlens_test_view").collect()[0].n == 5


def test_fetch_is_bounded(spark):
    assert len(sinks.fetch(spark.range(5), 10)) == 5
    with pytest.raises(ValueError):
        sinks.fetch(spark.range(50), 10)


def test_materialise_under_checkpoint_dir(spark):
    df = spark.range(0, 100).selectExpr("id", "id * 2 AS twice")
    back = sinks.materialise(df, "tvlens_test_materialise")
    assert back.count() == 100
    ckpt = spark.sparkContext.getCheckpointDir()
    assert ckpt and "tvlens_test_materialise" in back.inputFiles()[0]
    def local(p):
        return os.path.normpath(p.replace("file:", ""))

    assert local(back.inputFiles()[0]).startswith(local(ckpt))


def test_named_tables_in_a_database(spark):
    from tvlens.sources.sinks import create_database, materialise, write_named

    create_database(spark, "tvlens_gold")
    create_database(spark, "tvlens_gold")
    df = spark.range(5)
    assert write_named(df, "tvlens_gold.days").count() == 5
    assert write_named(df, "tvlens_gold.days", mode="append").count() == 10
    assert spark.sql("SELECT count(*) FROM tvlens_gold.days").first()[0] == 10
    a, b = materialise(df, "x"), materialise(df.limit(0), "x")
    assert a.count() == 5 and b.count() == 0 and a.columns == b.columns
