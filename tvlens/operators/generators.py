"""Row expansion and value builders: exact per-row expansion, ad load, padded keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvlens.functions.columns import ColumnLike, _c, padded


def expand_rows(df: DataFrame, count: ColumnLike, name: str = "seq") -> DataFrame:
    """Repeat each row ``count`` times with sequence numbers 1..count.

    Rows with a NULL or non-positive count disappear.  Exactly ``count`` rows
    are generated, instead of a cross product with a fixed maximum that is
    cut afterwards.
    """
    n = _c(count)
    seqs = F.when(n >= 1, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))
    return df.withColumn(name, F.explode(seqs))


def ad_load(df: DataFrame, watch: str = "watch_seconds", seconds_per_break: int = 30) -> DataFrame:
    """``ad_breaks = floor(watch / 180)``, ``ad_total_seconds = breaks * 30``."""
    breaks = F.floor(F.col(watch) / F.lit(180)).cast("long")
    return df.withColumn("ad_breaks", breaks).withColumn(
        "ad_total_seconds", breaks * F.lit(seconds_per_break)
    )


def padded_key(index: ColumnLike, prefix: str = "ID-", width: int = 10) -> Column:
    """``prefix || LPAD(index, width, '0')``."""
    return F.concat(F.lit(prefix), padded(index, width))
