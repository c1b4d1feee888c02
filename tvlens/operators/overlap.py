"""Overlap of a customer table with a partner table (OR-EXISTS semi join).

``EXISTS (SELECT 1 FROM partner s WHERE s.email = c.email OR s.phone = c.phone)``
plans as a nested-loop join (rows x rows) when written literally.  Here the
partner's distinct keys first become a Bloom filter, one scalar of a fixed size
(``FILTER_BITS``) for both disjuncts.  Customers none of whose contacts may be
in it are not shuffled at all; those with one such contact are joined once, by
that contact; the few with more are joined by each.  The joins decide, so the
result is exact, also when more keys than the filter is made for leave it full
(then every customer is a candidate).

No row of the customer table can fan out, duplicates in the customer table are
kept (bag semantics), and adaptive execution broadcasts a key list that measured
small or splits the hot partitions of the customer side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvlens.operators.joins import null_spread_join

#: 1 MB, made for some million keys (under 5 % false candidates).
FILTER_BITS = 1 << 23


def _positions(hash_: Column, bits: int) -> list[Column]:
    mask = F.lit(bits - 1).cast("bigint")
    return [hash_.bitwiseAND(mask), F.shiftrightunsigned(hash_, 32).bitwiseAND(mask)]


def bloom_filter(hashes: DataFrame, column: str, bits: int = FILTER_BITS) -> Column:
    """The filter of 64-bit hashes as a scalar array of ``bits`` / 64 words.
    ``bits`` is a power of two, at most 2^32."""
    at = hashes.select(F.explode(F.array(*_positions(F.col(column), bits))).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
    used = at.select(F.shiftright("p", 6).alias("w"), bit.alias("b"))
    empty = hashes.sparkSession.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("bigint").alias("b"))
    words = used.unionByName(empty).groupBy("w").agg(F.bit_or("b").alias("b"))
    return words.agg(F.transform(F.sort_array(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("f")).scalar()


def may_contain(filter_: Column, hash_: Column, bits: int = FILTER_BITS) -> Column:
    """False only if the hash is in no key of the filter."""
    held = [F.getbit(F.get(filter_, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) for p in _positions(hash_, bits)]
    return (held[0] == 1) & (held[1] == 1)


def _key_hash(i: int, key: Column) -> Column:
    return F.xxhash64(F.lit(i), key)


def overlap_flags(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    name: str = "in_partner",
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Add a boolean ``name``: some ``left[a] = right[b]`` holds for a pair.

    NULL never matches (equality with NULL is unknown, as in EXISTS).
    """
    keys = _distinct_keys(right, pairs)
    filter_ = bloom_filter(keys.select(F.xxhash64("_i", "_k").alias("h")), "h", filter_bits)
    maybe = [
        F.col(a).isNotNull() & may_contain(F.col("_f"), _key_hash(i, F.col(a).cast("string")), filter_bits)
        for i, (a, _) in enumerate(pairs)
    ]
    probed = F.array_compact(F.array(*[F.when(m, F.lit(i)) for i, m in enumerate(maybe)]))
    tagged = left.withColumn("_f", filter_).withColumn("_in", probed).drop("_f")
    none = tagged.where(F.size("_in") == 0).withColumn(name, F.lit(False))
    contact = F.coalesce(*[F.when(F.col("_in")[0] == i, F.col(a).cast("string")) for i, (a, _) in enumerate(pairs)])
    one = tagged.where(F.size("_in") == 1).withColumn("_i", F.col("_in")[0]).withColumn("_k", contact)
    one = one.join(keys.withColumn("_hit", F.lit(True)), ["_i", "_k"], "left")
    one = one.withColumn(name, F.coalesce("_hit", F.lit(False)))
    more = _probe_each(tagged.where(F.size("_in") > 1), right, pairs, name)
    cols = [*left.columns, name]
    return none.select(*cols).unionByName(one.select(*cols)).unionByName(more.select(*cols))


def _distinct_keys(right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(_i, _k): the distinct non-NULL keys of each pair's right column."""
    each = F.array(*[F.struct(F.lit(i).alias("_i"), F.col(b).cast("string").alias("_k")) for i, (_, b) in enumerate(pairs)])
    return right.select(F.inline(each)).where(F.col("_k").isNotNull()).distinct()


def _probe_each(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], name: str) -> DataFrame:
    """Join the rows with every pair's keys in turn."""
    out = left
    flags = []
    for i, (lcol, rcol) in enumerate(pairs):
        flag = f"_hit{i}"
        keys = (
            right.where(F.col(rcol).isNotNull())
            .select(F.col(rcol).alias(f"_k{i}"))
            .distinct()
            .withColumn(flag, F.lit(True))
        )
        out = null_spread_join(out.withColumn(f"_k{i}", F.col(lcol)), keys, f"_k{i}").drop(f"_k{i}")
        flags.append(F.coalesce(F.col(flag), F.lit(False)))
    hit = flags[0]
    for f in flags[1:]:
        hit = hit | f
    return out.withColumn(name, hit).drop(*[f"_hit{i}" for i in range(len(pairs))])


def overlap_ratio(
    crm: DataFrame,
    partner: DataFrame,
    pairs: Sequence[tuple[str, str]] = (("email", "email"), ("phone", "phone")),
) -> DataFrame:
    """One row: share of ``crm`` rows matching the partner on any pair.

    ``COUNT(*)::double / (SELECT COUNT(*) FROM crm)`` computed in the same
    aggregate pass as the matching count.
    """
    flagged = overlap_flags(crm.select(*{p[0] for p in pairs}), partner, pairs)
    return flagged.agg(
        F.try_divide(F.count_if(F.col("in_partner")).cast("double"), F.count(F.lit(1))).alias("overlap_ratio")
    )
