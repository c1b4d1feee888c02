"""Overlap through a Bloom filter: exact for full and empty filters, and shuffles candidates only."""

import re

from pyspark.sql import functions as F

from conftest import SF01
from tvlens.operators.overlap import bloom_filter, may_contain, overlap_flags, overlap_ratio
from tvlens.sources.tables import crm, partner, read_table

PAIRS = [("email", "email"), ("phone", "phone")]


def brute(left, right):
    emails, phones = {e for e, _ in right if e is not None}, {p for _, p in right if p is not None}
    return sorted(((i, e, p, e in emails or p in phones) for i, e, p in left), key=str)


def found(spark, left, right, bits):
    a = spark.createDataFrame(left, "id int, email string, phone string")
    b = spark.createDataFrame(right, "email string, phone string")
    return sorted(map(tuple, overlap_flags(a, b, PAIRS, filter_bits=bits).collect()), key=str)


def test_flags_by_brute_force(spark):
    left = [(i, None if i % 5 == 0 else f"e{i % 90}", None if i % 3 == 0 else f"p{i % 70}") for i in range(400)]
    left += [left[7]] * 3 + [(900, "e1", "p1"), (901, "hot", "p2"), (902, None, None)] + [(1000 + i, "hot", None) for i in range(200)]
    right = [(f"e{i}", f"p{i * 3}") for i in range(0, 90, 11)] + [("hot", None), (None, "p5"), (None, None), ("p2", "e7"), ("e1", "p1")] * 2
    for bits in (64, 1 << 10, 1 << 16):  # full, crowded and wide filters
        assert found(spark, left, right, bits) == brute(left, right)
    assert found(spark, left, [], 1 << 10) == brute(left, [])
    assert found(spark, [], right, 1 << 10) == []


def test_filter_has_no_false_negative_and_few_false_positives(spark):
    bits = 1 << 16
    keys = spark.range(3000).select(F.xxhash64("id").alias("h"))
    rows = spark.range(20000).withColumn("f", bloom_filter(keys, "h", bits))
    hits = rows.where(may_contain(F.col("f"), F.xxhash64("id"), bits)).select("id").collect()
    ids = {r.id for r in hits}
    assert set(range(3000)) <= ids and len(ids) < 3000 + 17000 * 0.03


def test_only_candidates_are_shuffled(spark):
    c = crm(read_table(spark, SF01, "customer")).select("customer_id", "email", "phone")
    p = partner(read_table(spark, SF01, "supplier"))
    flags = overlap_flags(c, p, PAIRS)
    plan = flags._jdf.queryExecution().executedPlan().toString()
    # Customers come out of three branches; the first has no exchange above its scan.
    first = plan[plan.index("Union") :].split("\n:- ")[1] if "\n:- " in plan else plan
    first = re.split(r"\n   ?:- |\n   \+- ", plan[plan.index("Union") + 5 :])[1]
    outside = [x for x in first.split("\n") if "Subquery" not in x and not re.match(r"[\s:]*:  +", x)]
    assert not any("Exchange" in x for x in outside)
    assert "NestedLoopJoin" not in plan
    n = flags.where("in_partner").count()
    assert overlap_ratio(c, p).first()[0] == n / c.count() and n > 0
