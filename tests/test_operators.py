"""Invariants of the table operators."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tests_support import T, overlap_ratio_literal
from tvlens.operators.overlap import overlap_ratio
from tvlens.sources.tables import crm, partner, read_table, viewing_logs

AS_OF = dt.date(2024, 1, 31)


def test_dense_index_is_1_to_n_and_stable(spark):
    a = T.dense_index(spark.range(0, 3000, numPartitions=5).withColumnRenamed("id", "k"), ["k"], "rn", seed=1)
    b = T.dense_index(spark.range(0, 3000, numPartitions=2).withColumnRenamed("id", "k"), ["k"], "rn", seed=1)
    ra = sorted((r.k, r.rn) for r in a.collect())
    rb = sorted((r.k, r.rn) for r in b.collect())
    assert ra == rb
    assert sorted(rn for _, rn in ra) == list(range(1, 3001))
    # not the identity order: it is a shuffle
    assert sum(k + 1 == rn for k, rn in ra) < 100


def test_first_n_exact(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    assert T.first_n(df, 123, ["k"]).count() == 123
    assert T.first_n(df, 5000, ["k"]).count() == 1000


def test_quota_sizes():
    assert T.quota_sizes(4_000_000, 0.25, (8, 10, 7)) == [320_000, 400_000, 280_000]
    assert sum(T.quota_sizes(1501, 0.25, (8, 10, 7))) == round(1501 * 0.25)


def test_assign_quota_counts(spark):
    df = spark.range(1, 4001).withColumnRenamed("id", "ord")
    a, b, c = T.quota_sizes(4000, 0.25, (8, 10, 7))
    bounds = [("TRIPLE", a), ("EMAIL", F.lit(a + b)), ("PHONE", a + b + c)]
    out = T.assign_quota(df, "ord", bounds, "NONE", "lab")
    got = {r.lab: r["count"] for r in out.groupBy("lab").count().collect()}
    assert got == {"TRIPLE": 320, "EMAIL": 400, "PHONE": 280, "NONE": 3000}


def test_attach_fraction_exact_percent(spark):
    df = spark.range(0, 10000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    out = T.attach_fraction(df, "v", "k", 0.07, "w")
    assert out.where(F.col("w").isNotNull()).count() == 700  # not 800 from 0.07*100 > 7
    assert T.attach_fraction(df, "v", "k", 1.7, "w").where(F.col("w").isNull()).count() == 0


def test_null_out_protects_labels(spark):
    c = crm(read_table(spark, SF01, "customer"), AS_OF)
    out = T.null_out(c, "phone", 0.5, ["customer_id"], F.col("overlap_type").isin("TRIPLE", "PHONE"), seed=3)
    joined = out.alias("o").join(c.alias("c"), "customer_id")
    prot = joined.where(F.col("o.overlap_type").isin("TRIPLE", "PHONE"))
    assert prot.where(F.col("o.phone").isNull() & F.col("c.phone").isNotNull()).count() == 0
    other = joined.where(~F.col("o.overlap_type").isin("TRIPLE", "PHONE") & F.col("c.phone").isNotNull())
    blanked = other.where(F.col("o.phone").isNull()).count() / other.count()
    assert 0.4 < blanked < 0.6


def test_near_duplicates(spark):
    c = crm(read_table(spark, SF01, "customer"), AS_OF)
    out = T.near_duplicates(
        c, 150, ["customer_id"], F.col("overlap_type") == "NONE", "customer_id", "email", "phone", "overlap_type"
    )
    assert out.count() == c.count() + 150
    dups = out.where(F.col("overlap_type") == "DUPLICATE")
    assert dups.count() == 150
    assert dups.where(~F.col("customer_id").endswith("_DUP")).count() == 0
    src = dups.select(F.regexp_replace("customer_id", "_DUP$", "").alias("customer_id")).join(c, "customer_id")
    assert src.where(F.col("overlap_type") != "NONE").count() == 0
    assert out.select("customer_id").distinct().count() == out.count()


def test_expand_rows(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (3, None), (4, 1)], "g int, n int")
    got = Counter(r.g for r in T.expand_rows(df, "n").collect())
    assert got == {1: 3, 4: 1}
    assert sorted(r.seq for r in T.expand_rows(df, "n").where("g = 1").collect()) == [1, 2, 3]


def test_capped_sample(spark):
    logs = viewing_logs(read_table(spark, SF01, "events"))
    cap = F.hour("slot_start_time") + F.lit(5)
    out = T.capped_sample(logs, ["programme_id"], cap, ["log_id"], max_cap=28, seed=2)
    per = {r.programme_id: r["count"] for r in out.groupBy("programme_id").count().collect()}
    sizes = {
        r.programme_id: (r["n"], r.h)
        for r in logs.groupBy("programme_id").agg(F.count("*").alias("n"), F.first(F.hour("slot_start_time")).alias("h")).collect()
    }
    for p, (n, h) in sizes.items():
        assert per.get(p, 0) == min(n, h + 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_exact_and_fraction_sample(spark):
    logs = viewing_logs(read_table(spark, SF01, "events"))
    assert T.exact_sample(logs, 100, ["log_id"]).count() == 100
    n = T.fraction_sample(logs, 10.0, ["log_id"]).count()
    assert 800 < n < 1200


def test_cyclic_lookup_empty_lookup_gives_nulls(spark):
    df = spark.range(1, 6).withColumnRenamed("id", "k")
    empty = spark.createDataFrame([], "rn bigint, v string")
    out = T.cyclic_lookup(df, "k", empty, "rn")
    assert out.count() == 5 and out.where(F.col("v").isNotNull()).count() == 0


def test_cyclic_lookup_cycles(spark):
    df = spark.range(1, 11).withColumnRenamed("id", "k")
    lk = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "rn bigint, v string")
    got = {r.k: r.v for r in T.cyclic_lookup(df, "k", lk, "rn").collect()}
    assert got == {1: "b", 2: "c", 3: "a", 4: "b", 5: "c", 6: "a", 7: "b", 8: "c", 9: "a", 10: "b"}


def test_overlap_split_equals_literal(spark):
    c = crm(read_table(spark, SF01, "customer"), AS_OF)
    p = partner(read_table(spark, SF01, "supplier"))
    a = overlap_ratio(c, p).collect()[0][0]
    b = overlap_ratio_literal(c, p).collect()[0][0]
    assert a == pytest.approx(b) and a == pytest.approx(0.106, abs=1e-3)


def test_dense_index_hot_duplicate_key(spark, monkeypatch):
    """A key holding a third of the rows: still 1..N, expanded in chunks."""
    import tvlens.operators.numbering as N
    monkeypatch.setattr(N, "EXPAND_CHUNK", 50)
    hot = spark.range(0, 1000).select(F.lit(7).cast("long").alias("k"))
    cold = spark.range(0, 2000).select(F.col("id").alias("k"))
    df = hot.unionByName(cold)
    out = T.dense_index(df, ["k"], "rn", seed=5)
    rows = out.collect()
    assert sorted(r.rn for r in rows) == list(range(1, 3001))
    assert Counter(r.k for r in rows)[7] == 1001
    again = sorted((r.k, r.rn) for r in T.dense_index(df.repartition(3), ["k"], "rn", seed=5).collect())
    assert again == sorted((r.k, r.rn) for r in rows)


def test_null_spread_join_equals_plain_join(spark):
    rows = [(i, "hot" if i % 3 == 0 else (None if i % 5 == 0 else f"k{i % 40}")) for i in range(3000)]
    big = spark.createDataFrame(rows, "id int, key string")
    small = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("zz", 4)], "key string, v int")
    want = sorted(map(tuple, big.join(small, "key", "left").select("id", "key", "v").collect()), key=str)
    got = T.null_spread_join(big, small, "key", "left")
    assert sorted(map(tuple, got.select("id", "key", "v").collect()), key=str) == want
    inner = T.null_spread_join(big, small, "key", "inner").count()
    assert inner == big.join(small, "key").count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan


def test_first_n_is_the_head_of_the_dense_order(spark):
    df = spark.range(0, 500).select((F.col("id") % 200).alias("k"), F.col("id").alias("v"))
    order = {(r.k, r.v): r.rn for r in T.dense_index(df, ["k"], "rn", seed=4).collect()}
    for n in (0, 1, 7, 499, 500, 900):
        got = {(r.k, r.v) for r in T.first_n(df, n, ["k"], seed=4).collect()}
        assert got == {x for x, rn in order.items() if rn <= n}
    hot = spark.range(0, 900).select(F.lit(1).alias("k"))
    assert T.first_n(hot.unionByName(spark.range(0, 50).select(F.col("id").cast("int").alias("k"))), 333, ["k"]).count() == 333


def test_capped_sample_keeps_min_of_cap_and_rows(spark):
    df = spark.range(0, 100).select(F.lit("g").alias("g"), F.col("id").alias("k"))
    for cap in (1, 28, 50, 200):
        assert T.capped_sample(df, ["g"], F.lit(cap), ["k"]).count() == min(cap, 100)
    with pytest.raises(Exception, match="cap above max_cap"):
        T.capped_sample(df, ["g"], F.lit(50), ["k"], max_cap=28).count()


def test_row_ordinal_with_gaps_outliers_and_nulls(spark):
    keys = [i * 10 for i in range(700)] + [-5, 10**17, None, None, 30, 30]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
    rows = T.row_ordinal(df, "k", "rn").collect()
    assert sorted(r.rn for r in rows) == list(range(1, len(keys) + 1))
    ordered = [r.k for r in sorted(rows, key=lambda r: r.rn)]
    assert ordered == sorted((k for k in keys if k is not None)) + [None, None]
    assert T.row_ordinal(df.limit(0), "k").count() == 0


def test_quota_labels_on_keys_with_gaps(spark):
    c = read_table(spark, SF01, "customer").withColumn("c_custkey", F.col("c_custkey") * 10)
    got = Counter(r.overlap_type for r in crm(c, AS_OF).select("overlap_type").collect())
    assert got == {"TRIPLE": 120, "EMAIL": 150, "PHONE": 105, "NONE": 1125}


def test_cyclic_lookup_of_negative_keys(spark):
    df = spark.createDataFrame([(-1,), (-3,)], "k bigint")
    lk = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "rn bigint, v string")
    assert {r.k: r.v for r in T.cyclic_lookup(df, "k", lk, "rn").collect()} == {-1: "c", -3: "a"}


def test_views_see_files_added_between_calls(spark, tmp_path):
    from tvlens.plans.shared import shared_logs

    ev = read_table(spark, SF001, "events")
    ev.write.parquet(str(tmp_path / "events.parquet"))
    before = shared_logs(spark, str(tmp_path)).count()
    ev.write.mode("append").parquet(str(tmp_path / "events.parquet"))
    assert shared_logs(spark, str(tmp_path)).count() == 2 * before == 2 * ev.count()


def test_value_aggregates_on_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", "x", 10), ("a", "y", 9), ("a", None, None), ("a", "y", 2), ("a", "x", 2), ("b", None, None)],
        "g string, v string, n int",
    )
    values = T.grouped_values(df, ["g"], {"v": F.col("v"), "n": F.col("n")}, {"n": F.col("n")})
    out = T.with_ranks(values, ["g"], "n").groupBy("g").agg(
        T.value_rows().alias("rows"), T.value_mode("v").alias("mode"), T.value_mode("n", "int").alias("top"),
        T.value_distinct("n").alias("distinct"), T.value_median("n").alias("median"), T.value_mean("n").alias("mean"),
    )
    got = {r.g: tuple(r)[1:] for r in out.collect()}
    assert got == {"a": (5, "x", 2, 3, 5.5, 5.75), "b": (1, None, None, 0, None, None)}
