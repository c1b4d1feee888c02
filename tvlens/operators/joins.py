"""Joins and grouped aggregates shaped for scale.

* no job runs while a plan is built: strategies are left to adaptive
  execution, which decides from measured sizes;
* NULL keys of an outer join spread over all tasks (``null_spread_join``);
* one-row relations as a single struct scalar subquery, never a cross join
  (``one_row_columns``, ``cross_one_row``);
* modes, medians and exact distinct counts from one count per (group, tag,
  value) (``grouped_values``);
* the cyclic lookup ``key % N + 1`` as an equi-join (``cyclic_lookup``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tvlens.functions.columns import ColumnLike, _c

# Sums that share an unpivoted row.
SUMS_A_ROW = 4
# Copies of a NULL key, so that rows that cannot match share no task.
NULL_SPREAD = 4096


def one_row_columns(one_row: DataFrame) -> dict[str, Column]:
    """The columns of a one-row relation (a global aggregate) as scalar values.

    All columns travel in one struct-valued scalar subquery; its repeated
    uses share one execution (Spark reuses identical subqueries), so the
    aggregate runs once and no join - let alone a cross join - is planned.
    """
    packed = one_row.select(F.struct(*one_row.columns).alias("_row")).scalar()
    return {c: packed.getField(c) for c in one_row.columns}


def null_spread_join(big: DataFrame, small: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``left`` or ``inner`` equi-join on ``key`` in one pass over ``big``.

    Rows of ``big`` with a NULL key cannot match.  An inner join drops them
    before the shuffle; a left join gives each a salt, so that they spread
    over all tasks instead of meeting in one.  Hot non-NULL keys are split by
    adaptive execution's skew handling.
    """
    if how == "inner":
        return big.where(F.col(key).isNotNull()).join(small, key)
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*big.columns), F.lit(NULL_SPREAD)))
    left = big.withColumn("_salt", F.coalesce(salt, F.lit(-1)))
    right = small.where(F.col(key).isNotNull()).withColumnRenamed(key, "_key")
    right = right.withColumn("_none", F.lit(-1).cast("bigint"))
    same = (left[key] == right["_key"]) & (left["_salt"] == right["_none"])
    return left.join(right, same, "left").drop("_key", "_salt", "_none")


def cross_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``a CROSS JOIN one_row``: attach the columns of a one-row relation."""
    return df.select("*", *[v.alias(k) for k, v in one_row_columns(one_row).items()])


def grouped_values(
    df: DataFrame,
    keys: Sequence[str],
    values: dict[str, Column],
    sums: dict[str, Column],
    span: Column | None = None,
) -> DataFrame:
    """One scan of ``df`` for sums, modes, medians and distinct counts.

    Every row is unpivoted into one row for each named value (tag, value as
    text) and one for every ``SUMS_A_ROW`` sums, so that rows and aggregation
    buffers stay narrow; a hash aggregate with fixed-size state counts rows by
    (keys, tag, value) and is combined before the shuffle, so a hot group ships
    its distinct values only.  The result, a row for each distinct value, has
    keys, ``_tag``, ``_value``, ``_n``, the sums ``s_*`` with their counts
    ``c_*`` and the extremes ``_first`` / ``_last`` of ``span`` (filled for the
    tag ``''`` only).  The ``value_*`` aggregates below fold it into groups.
    """
    names = list(sums)
    chunks = [names[i : i + SUMS_A_ROW] for i in range(0, len(names), SUMS_A_ROW)] or [[]]
    width = len(chunks[0])
    no_sum, no_time = F.lit(None).cast("double"), F.lit(None).cast("timestamp_ntz")

    def row(tag: str, value: Column, measured: Sequence[str], time: Column) -> Column:
        x = [sums[n].cast("double") for n in measured] + [no_sum] * (width - len(measured))
        fields = [F.lit(tag).alias("_tag"), value.alias("_value"), *[c.alias(f"_x{i}") for i, c in enumerate(x)]]
        return F.struct(*fields, *([time.alias("_t")] if span is not None else []))

    measures = [row("", F.lit(str(i)), c, span if i == 0 and span is not None else no_time) for i, c in enumerate(chunks)]
    tagged = [row(tag, c.cast("string"), [], no_time) for tag, c in values.items()]
    rows = df.select(*keys, F.inline(F.array(*measures, *tagged))).where(F.col("_value").isNotNull())
    counted = rows.groupBy(*keys, "_tag", "_value").agg(
        F.count(F.lit(1)).alias("_n"),
        *[f(f"_x{i}").alias(f"{p}{i}") for i in range(width) for f, p in ((F.sum, "_s"), (F.count, "_c"))],
        *([F.min("_t").alias("_first"), F.max("_t").alias("_last")] if span is not None else []),
    )
    place = {n: (str(i), k) for i, c in enumerate(chunks) for k, n in enumerate(c)}
    own = [
        f"CASE WHEN _tag = '' AND _value = '{place[n][0]}' THEN _{p}{place[n][1]} END AS `{p}_{n}`" for n in names for p in "sc"
    ]
    return counted.selectExpr(
        *[f"`{k}`" for k in keys],
        "_tag",
        "_value",
        "CASE WHEN _tag <> '' OR _value = '0' THEN _n END AS _n",
        *own,
        *(["_first", "_last"] if span is not None else []),
    )


# Aggregates over the rows of ``grouped_values``, grouped by its keys.
def value_rows() -> Column:
    """``COUNT(*)`` of the original rows."""
    return F.coalesce(F.sum(F.when(F.col("_tag") == "", F.col("_n"))), F.lit(0)).cast("bigint")


def value_sum(name: str) -> Column:
    return F.sum(f"s_{name}")


def value_mean(name: str) -> Column:
    return F.sum(f"s_{name}") / F.sum(f"c_{name}")


def value_distinct(tag: str) -> Column:
    """``COUNT(DISTINCT value)``: one row for each distinct value."""
    return F.count_if(F.col("_tag") == tag)


def value_mode(tag: str, kind: str = "string") -> Column:
    """Most frequent non-NULL value; the smallest one on ties."""
    ranked = F.struct((-F.col("_n")).alias("n"), F.col("_value").cast(kind).alias("v"))
    return F.min(F.when(F.col("_tag") == tag, ranked)).getField("v")


def with_ranks(values: DataFrame, keys: Sequence[str], tag: str) -> DataFrame:
    """Add ``_upto`` / ``_all``: rows of ``tag`` up to a numeric value, and all."""
    own = F.when(F.col("_tag") == tag, F.col("_n"))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_tag", F.col("_value").try_cast("double")).rowsBetween(Window.unboundedPreceding, 0)
    return values.withColumn("_upto", F.sum(own).over(upto)).withColumn("_all", F.sum(own).over(group))


def value_median(tag: str) -> Column:
    """Exact median of a numeric tag, over rows of :func:`with_ranks`."""
    def at(rank: Column) -> Column:
        inside = (F.col("_tag") == tag) & (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)
        return F.max(F.when(inside, F.col("_value").try_cast("double")))

    return (at(F.floor((F.col("_all") + 1) / 2)) + at(F.floor(F.col("_all") / 2) + 1)) / 2


def cyclic_lookup(
    df: DataFrame, key: ColumnLike, lookup: DataFrame, rn: str = "rn", size: Column | None = None
) -> DataFrame:
    """Attach lookup row number ``key mod N + 1`` (``N = MAX(rn)``) to each row.

    ``lookup`` must be numbered 1..N in ``rn`` (see ``dense_index``).  The
    remainder is never negative.  An empty lookup gives NULL columns, as
    ``% NULLIF(MAX(rn), 0)`` does.  ``N`` is an uncorrelated scalar subquery -
    ``MAX(rn)``, or ``size`` when the caller knows a cheaper expression such
    as the row count of the input before numbering.
    """
    n = size if size is not None else lookup.select(F.max(F.col(rn))).scalar()
    keyed = df.withColumn("_lk", F.pmod(_c(key), F.when(n != 0, n)) + F.lit(1))
    return keyed.join(lookup, keyed["_lk"] == lookup[rn], "left").drop("_lk", rn)
