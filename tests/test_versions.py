"""Versioned tables: whole replaces and appends, readers of the old version, failed and rival writers."""

import os

import pytest
from pyspark.sql import functions as F

from tvlens.sources import versions


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    assert versions.append(spark.range(3), path) == 1  # created if missing, rows once
    assert versions.append(spark.range(3, 5), path) == 2
    assert ids(versions.read(spark, path)) == [0, 1, 2, 3, 4]
    assert versions.replace(spark.range(7, 9), path, note="third") == 3
    assert ids(versions.read(spark, path)) == [7, 8]
    assert ids(versions.read(spark, path, 2)) == [0, 1, 2, 3, 4]
    assert versions.record(spark, path)["note"] == "third"
    with pytest.raises(ValueError, match="columns differ"):
        versions.append(spark.range(2).withColumnRenamed("id", "other"), path)
    assert versions.versions(spark, path) == [1, 2, 3]


def test_a_reader_keeps_the_version_it_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(spark.range(100), path)
    opened = versions.read(spark, path)
    rows = opened.toLocalIterator()
    first = next(rows).id
    versions.replace(spark.range(1000, 1010), path)
    assert sorted([first, *(r.id for r in rows)]) == list(range(100))
    assert ids(opened) == list(range(100))  # also when it is read again
    assert ids(versions.read(spark, path)) == list(range(1000, 1010))


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(spark.range(10), path)
    bad = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    for write in (versions.replace, versions.append):
        with pytest.raises(Exception, match="no"):
            write(bad, path)
        assert versions.versions(spark, path) == [1] and ids(versions.read(spark, path)) == list(range(10))
    # What the failed writes left is cleared away with the old versions.
    left = [f for f in os.listdir(path) if f.startswith("_set=")]
    assert len(versions.vacuum(spark, path)) == len(left) - 1
    assert ids(versions.read(spark, path)) == list(range(10))


def test_of_two_writers_the_second_builds_on_the_first(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.append(spark.range(2), path)
    real, rival = versions._add_record, []

    def late(spark_, path_, version, content):
        if not rival:  # another writer is faster
            rival.append(1)
            versions.append(spark.range(10, 12), path)
        return real(spark_, path_, version, content)

    monkeypatch.setattr(versions, "_add_record", late)
    assert versions.append(spark.range(20, 22), path) == 3
    assert ids(versions.read(spark, path)) == [0, 1, 10, 11, 20, 21]


def test_empty_tables_partitions_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20).select("id", (F.col("id") % 3).alias("part"), F.lit("x").alias("s"))
    versions.replace(rows.where("false"), path, ["part"])
    empty = versions.read(spark, path)
    assert empty.count() == 0 and empty.dtypes == rows.dtypes
    versions.append(rows.where("id < 10"), path, ["part"])
    versions.append(rows.where("id >= 10"), path, ["part"])
    table = versions.read(spark, path)
    assert table.columns == ["id", "part", "s"] and sorted(table.collect()) == sorted(rows.collect())
    pruned = table.where("part = 1")
    assert "PartitionFilters: [isnotnull(part" in pruned._jdf.queryExecution().executedPlan().toString()
    versions.replace(rows.where("id = 5"), path, ["part"])
    assert len(versions.vacuum(spark, path)) == 3 and versions.versions(spark, path) == [4]
    assert ids(versions.read(spark, path)) == [5]
    with pytest.raises(Exception):
        versions.read(spark, path, 1)
