"""Numbering and sampling in a stable pseudo-random order.

``ROW_NUMBER() OVER (ORDER BY RANDOM())`` without a global window, exact-n
picks, previews, percentage samples and per-group caps.  The order is always
a pure function of key columns and a seed, so a recomputed partition gets
the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tvlens.functions.columns import HASH_BITS, ColumnLike, _c, hash_bucket, key_hash
from tvlens.operators.selection import place_of, quantiles, rank_flag, row_identity

# Hash buckets of dense numbering: the top BUCKET_BITS of the hash, so buckets
# are in hash order.  A bucket is one window group (rows / 65,536 of them); the
# offsets table has one row for each bucket, so its broadcast is bounded.
BUCKET_BITS = 16
# Largest number of copies one task expands in the dense index.
EXPAND_CHUNK = 1_000_000
# Parts of a table in key order, found in two steps of PART_STEP.
PART_STEP = 32
PARTS = PART_STEP * PART_STEP


def _bucket(hash_: ColumnLike) -> Column:
    return F.shiftright(_c(hash_), HASH_BITS - BUCKET_BITS)


def _bucket_offsets(counts: DataFrame) -> DataFrame:
    """Prefix sums of per-bucket sizes ``_n`` (one row for each bucket)."""
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_b", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))


def row_ordinal(df: DataFrame, key: str, name: str = "rn") -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY key)`` without a global window.

    Equal rows are collapsed to (row, multiplicity); a sketch of the order of
    (key, hash of the row) cuts them into ``PARTS`` parts of about equal size,
    also inside a key that holds a third of the rows; rows are numbered inside
    their part and shifted by the sizes of the parts before it.  NULL keys
    come last, rows with equal keys are ordered by their hash.
    """
    cols = df.columns
    tie = F.shiftrightunsigned(F.xxhash64(*cols), 1)
    rows = place_of(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m")).withColumn("_t", tie), key)
    sketch = place_of(df.withColumn("_t", tie), key).selectExpr(
        f"{quantiles('_at', [i / PARTS for i in range(1, PARTS)], 10 * PARTS)} AS q"
    )
    # Two steps of PART_STEP comparisons find the part; an empty table has no cuts.
    none = "CAST(array() AS ARRAY<DOUBLE>)"
    cuts = sketch.selectExpr(
        f"array(coalesce(filter(q, (x, i) -> (i + 1) % {PART_STEP} = 0), {none}), coalesce(q, {none})) AS c"
    )
    tagged = (
        rows.withColumn("_c", cuts.scalar())
        .selectExpr("*", f"size(filter(_c[0], x -> x < _at)) * {PART_STEP} AS _f")
        # Never NULL, so that the join on it infers no filter that repeats all this.
        .selectExpr("*", f"coalesce(_f + size(filter(slice(_c[1], _f + 1, {PART_STEP - 1}), x -> x < _at)), 0) AS _b")
        .drop("_c", "_f", "_at")
    )
    order = [F.col(key).asc_nulls_last(), F.col("_t"), *[F.col(c) for c in cols if c != key]]
    return _numbered(tagged, order, cols, name)


def dense_index(df: DataFrame, key: Sequence[str], name: str = "rn", seed: int = 0) -> DataFrame:
    """Number the rows 1..N in the order of (hash of the key, key).

    This is ``ROW_NUMBER() OVER (ORDER BY RANDOM())`` as a pure function of
    the key columns and ``seed``, without a global window.  The key may
    repeat, even for a third of the rows: identical rows are first collapsed
    to (row, multiplicity) with a map-side partial aggregate, numbered as one
    weighted row inside their hash bucket, shifted by the sizes of the buckets
    before it, and expanded back in chunks of at most ``EXPAND_CHUNK`` rows
    spread over all tasks.  Rows with equal keys are numbered by their other
    columns.
    """
    cols = df.columns
    distinct = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    keys = [F.col(k) for k in key]
    others = [F.col(c) for c in cols if c not in key]
    tagged = distinct.withColumn("_h", key_hash(*key, seed=seed)).withColumn("_b", _bucket("_h"))
    return _numbered(tagged, [F.col("_h"), *keys, *others], cols, name)


def _numbered(tagged: DataFrame, order: Sequence[Column], cols: Sequence[str], name: str) -> DataFrame:
    """Number rows of multiplicity ``_m`` in ``order`` inside buckets ``_b``, buckets in order."""
    offsets = _bucket_offsets(tagged.groupBy("_b").agg(F.sum("_m").alias("_n"))).drop("_n")
    before = F.sum("_m").over(Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    starts = tagged.withColumn("_before", F.coalesce(before, F.lit(0))).join(F.broadcast(offsets), "_b")
    chunk = F.lit(EXPAND_CHUNK)
    n_chunks = F.floor((F.col("_m") - F.lit(1)) / chunk).cast("int")
    chunks = starts.withColumn("_c", F.explode(F.sequence(F.lit(0), n_chunks)))
    chunks = chunks.withColumn(
        "_first", F.col("_off") + F.col("_before") + F.col("_c").cast("long") * chunk + F.lit(1)
    ).withColumn("_len", F.least(chunk, F.col("_m") - F.col("_c").cast("long") * chunk))
    spread = chunks.repartition(F.col("_first"))
    out = spread.withColumn("_i", F.explode(F.sequence(F.lit(0), (F.col("_len") - F.lit(1)).cast("int"))))
    return out.withColumn(name, (F.col("_first") + F.col("_i")).cast("long")).select(*cols, name)


def group_index(df: DataFrame, group: Sequence[str], key: Sequence[str], name: str = "seq", seed: int = 0) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY group ORDER BY RANDOM())``, stable.

    The order inside a group is ``(hash of the key, key)``.
    """
    w = Window.partitionBy(*group).orderBy(key_hash(*key, seed=seed), *[F.col(k) for k in key])
    return df.withColumn(name, F.row_number().over(w))


def first_n(df: DataFrame, n: int | Column, key: Sequence[str], seed: int = 0) -> DataFrame:
    """Exactly ``min(n, rows)`` rows picked in stable pseudo-random order.

    ``QUALIFY ROW_NUMBER() OVER (ORDER BY RANDOM()) <= n`` for any ``n``.  Of a
    table scan the row of rank ``n`` is selected and the others are compared
    with it.  Of other rows the counts by hash bucket give the bucket in which
    the n-th row lies; rows of the buckets before it are kept where they are,
    and only the rows of that one bucket (1 / 65,536 of all) are numbered.
    """
    bound = n if isinstance(n, Column) else F.lit(n)
    cols = df.columns
    tie = row_identity(df)
    if tie is not None:
        flagged = rank_flag(df, key_hash(*key, seed=seed), tie, lambda rows: bound, "_pick")
        return flagged.where("_pick").select(*cols)
    tagged = df.withColumn("_b", _bucket(key_hash(*key, seed=seed)))
    sizes = _bucket_offsets(tagged.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")))
    last = sizes.withColumn("_want", bound).where(F.col("_off") < F.col("_want"))
    cut = last.agg(F.max(F.struct("_b", (F.col("_want") - F.col("_off")).alias("room"))).alias("c")).scalar()
    placed = tagged.withColumn("_cut", cut)
    below = placed.where(F.col("_b") < F.col("_cut._b")).select(*cols)
    edge = placed.where(F.col("_b") == F.col("_cut._b")).select(*cols, F.col("_cut.room").alias("_room"))
    picked = dense_index(edge, key, "_pick", seed).where(F.col("_pick") <= F.col("_room"))
    return below.unionByName(picked.select(*cols))


def exact_sample(df: DataFrame, n: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """``SAMPLE (n ROWS)`` for a small preview ``n`` (a top-k by hash).

    Planned as ``TakeOrderedAndProject``: each partition keeps its best ``n``
    rows, so at most ``n * partitions`` rows reach the final merge.
    """
    return df.orderBy(key_hash(*key, seed=seed), *[F.col(k) for k in key]).limit(n)


def fraction_sample(df: DataFrame, percent: float, key: Sequence[str], seed: int = 0) -> DataFrame:
    """``SAMPLE (p)``: keep about ``p`` percent of rows, chosen by key hash."""
    keep = int(round(float(Decimal(str(percent)) * 1000)))
    return df.where(hash_bucket(100_000, *key, seed=seed) < F.lit(keep))


def capped_sample(
    df: DataFrame,
    group: Sequence[str],
    cap: ColumnLike,
    key: Sequence[str],
    max_cap: int | None = None,
    seed: int = 0,
    name: str = "seq",
) -> DataFrame:
    """At most ``cap`` rows per group, chosen in stable pseudo-random order.

    ``max_cap`` is a promise that ``cap`` never exceeds it.  The constant lets
    Spark plan a ``WindowGroupLimit`` before the shuffle, so that even a group
    with a third of the rows ships at most ``max_cap`` rows per map task; a row
    with a larger cap raises an error, nothing is dropped silently.
    """
    limit = _c(cap)
    if max_cap is not None:
        too_large = F.raise_error(F.concat(F.lit(f"cap above max_cap {max_cap}: "), limit.cast("string")))
        limit = F.when(limit > max_cap, too_large.cast("bigint")).otherwise(limit)
    out = group_index(df.withColumn("_cap", limit), group, key, name, seed)
    if max_cap is not None:
        out = out.where(F.col(name) <= F.lit(max_cap))
    return out.where(F.col(name) <= F.col("_cap")).drop("_cap")
