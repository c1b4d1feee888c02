"""Distinct counts that merge: bitmaps over dense numbers.

``COUNT(DISTINCT id)`` of a period cannot be added up from daily counts, but
the sets can be united.  Ids get dense numbers once; a day's set is a bitmap,
one row for each bucket of 32,768 numbers that has a member (4 KB at most,
whatever the number of events).  A period is the bitwise OR of its days and the
number of bits in it: exact, without a look at the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvlens.operators.numbering import dense_index


def number_ids(ids: DataFrame, id_col: str, known: DataFrame | None = None) -> DataFrame:
    """(id, number): dense numbers from 1 for the distinct non-NULL ids.

    With ``known`` numbers the ids already there keep theirs, new ones are
    numbered after the largest; so stored bitmaps stay valid.
    """
    new = ids.where(F.col(id_col).isNotNull()).select(id_col).distinct()
    if known is None:
        return dense_index(new, [id_col], "number")
    last = F.coalesce(known.select(F.max("number")).scalar(), F.lit(0))
    added = dense_index(new.join(known, id_col, "left_anti"), [id_col], "_rn")
    return known.select(id_col, "number").unionByName(added.select(id_col, (F.col("_rn") + last).alias("number")))


def day_bitmaps(rows: DataFrame, day: Column, id_col: str, numbers: DataFrame, day_name: str = "day") -> DataFrame:
    """(day, bucket, bits) of the ids seen on each day; NULL days are one more day."""
    seen = rows.where(F.col(id_col).isNotNull()).select(day.alias(day_name), id_col).distinct()
    numbered = seen.join(numbers, id_col)
    return numbered.groupBy(day_name, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )


def count_members(bitmaps: DataFrame, by: Sequence[str] = (), name: str = "members") -> DataFrame:
    """Distinct ids in the union of the bitmaps, for each group ``by``."""
    united = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    total = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias(name)
    return united.groupBy(*by).agg(total)
