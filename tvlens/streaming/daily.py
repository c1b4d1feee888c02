"""Keep the materialised daily summary current as log files arrive.

The summary is a full-refresh table in the source system.  At scale only the
days that received new events need refreshing: a Structured Streaming query
watches the log folder, ``foreachBatch`` finds the dates a micro-batch touched,
recomputes those dates from the log table (exact distinct counts cannot be
merged from partial counts) and overwrites only those date partitions of the
summary.  A replayed micro-batch after a failure leaves the same rows.

The log table is expected to be stored partitioned by ``event_date`` so the
recomputation reads only the touched partitions (the date filter is a
partition filter).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tvlens.plans.gold import daily_summary
from tvlens.session import ensure_checkpoint_dir


def write_logs_partitioned(logs: DataFrame, path: str, mode: str = "append") -> None:
    """Store log rows partitioned by event date (the layout the refresh reads)."""
    logs.withColumn("event_date", F.to_date("event_time")).write.mode(mode).partitionBy("event_date").parquet(path)


def refresh_dates(spark: SparkSession, logs_path: str, daily_path: str, dates: list) -> None:
    """Recompute the summary rows of ``dates`` and replace those partitions."""
    if not dates:
        return
    logs = spark.read.parquet(logs_path).where(F.col("event_date").isin(dates)).drop("event_date")
    out = daily_summary(logs).withColumn("summary_date_part", F.col("summary_date"))
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("summary_date_part")
        .parquet(daily_path)
    )


def start_daily_refresh(
    spark: SparkSession,
    logs_path: str,
    daily_path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the refresh stream over new files under ``logs_path``.

    ``available_now`` processes what is there and stops (a scheduled job);
    otherwise the query keeps running.  The stream's checkpoint lives in the
    shared checkpoint folder unless given.
    """
    schema = spark.read.parquet(logs_path).schema
    checkpoint = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "daily_refresh")
    stream = spark.readStream.schema(schema).parquet(logs_path)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        # The touched dates of one micro-batch: one row per day, a few values.
        dates = [r[0] for r in batch.select("event_date").distinct().collect()]
        refresh_dates(batch.sparkSession, logs_path, daily_path, dates)

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_daily(spark: SparkSession, daily_path: str) -> DataFrame:
    """The materialised summary with its original columns."""
    return spark.read.parquet(daily_path).drop("summary_date_part")
