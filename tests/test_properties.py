"""Property tests of the operators at several sizes (hypothesis)."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests_support import T

FEW = settings(max_examples=6, deadline=None)


@given(total=st.integers(0, 10_000_000), share=st.sampled_from([0.1, 0.25, 0.3, 0.5]),
       weights=st.lists(st.integers(1, 20), min_size=1, max_size=4))
@settings(max_examples=200, deadline=None)
def test_quota_sizes_add_up(total, share, weights):
    parts = T.quota_sizes(total, share, weights)
    assert sum(parts) == int(round(total * share))
    assert len(parts) == len(weights)


@FEW
@given(n=st.integers(1, 400), seed=st.integers(0, 1000))
def test_dense_index_permutation(spark, n, seed):
    df = spark.range(0, n).withColumnRenamed("id", "k")
    got = sorted(r.rn for r in T.dense_index(df, ["k"], "rn", seed).collect())
    assert got == list(range(1, n + 1))


@FEW
@given(fraction=st.decimals(min_value=Decimal("-0.5"), max_value=Decimal("1.5"), places=2))
def test_attach_fraction_exact(spark, fraction):
    df = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    kept = T.attach_fraction(df, "v", "k", float(fraction), "w").where("w IS NOT NULL").count()
    p = min(Decimal(1), max(Decimal(0), fraction))
    assert kept == sum(1 for k in range(1000) if k % 100 < p * 100)


@FEW
@given(counts=st.lists(st.one_of(st.none(), st.integers(-2, 30)), min_size=1, max_size=12))
def test_expand_rows_total(spark, counts):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(counts)], "g int, n int")
    assert T.expand_rows(df, "n").count() == sum(c for c in counts if c and c > 0)


@FEW
@given(n=st.integers(0, 300), cap=st.integers(1, 40))
def test_capped_sample_counts(spark, n, cap):
    df = spark.range(0, n).select(F.col("id").cast("string").alias("key"), (F.col("id") % 7).alias("g"))
    out = T.capped_sample(df, ["g"], F.lit(cap), ["key"], seed=1)
    sizes = {g: sum(1 for i in range(n) if i % 7 == g) for g in range(7)}
    got = {r.g: r["count"] for r in out.groupBy("g").count().collect()}
    assert got == {g: min(s, cap) for g, s in sizes.items() if s}
