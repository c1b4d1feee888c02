"""Sinks: replace, append, schema-only table, view registration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tvlens.session import scratch_table_path


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    fmt: str = "parquet",
) -> None:
    """``CREATE OR REPLACE TABLE ... AS`` (overwrite) or ``INSERT INTO`` (append).

    Appending to a missing path creates it, which covers
    ``CREATE TABLE IF NOT EXISTS ... WHERE 1=0; INSERT INTO ...`` in one step
    (and does not write the rows twice).
    """
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_bucketed(df: DataFrame, table: str, by: Sequence[str], buckets: int, mode: str = "overwrite") -> DataFrame:
    """Save ``df`` as a catalog table bucketed (and sorted) by ``by``.

    Tables bucketed on the same key with the same bucket count are
    co-partitioned: aggregates grouped by the key and joins on it read them
    without a shuffle (e.g. logs and CRM bucketed by ``customer_id`` for the
    customer summary and the customer-360 join).  Returns the table.
    """
    df.write.mode(mode).bucketBy(buckets, *by).sortBy(*by).saveAsTable(table)
    return df.sparkSession.table(table)


def create_database(spark, name: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS name`` in the session's catalog."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def write_named(
    df: DataFrame, table: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None
) -> DataFrame:
    """Replace (or append to, creating it if missing) a catalog table such as
    ``db.table``, and return it."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to a fresh table in the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors."""
    path = scratch_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_written(spark, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def schema_only(df: DataFrame) -> DataFrame:
    """The same columns with no rows (``... WHERE 1=0``)."""
    return df.limit(0)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW name AS ...`` for the session's SQL."""
    df.createOrReplaceTempView(name)
    return df


def fetch(df: DataFrame, max_rows: int = 10_000):
    """Bring a small result to the client as pandas, never more than ``max_rows``.

    Raises when the result is larger, instead of silently truncating it;
    errors propagate (an empty frame is never returned for a failure).
    """
    rows = df.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; aggregate or page it")
    return rows
