"""Trap helpers: each pins one place where naive Spark differs."""

import datetime as dt

from pyspark.sql import functions as F

from tvlens.functions import columns as C


def _one(spark, expr, data=None, schema=None):
    df = spark.createDataFrame(data or [(1,)], schema or "x int")
    return df.select(expr.alias("v")).collect()[0]["v"]


def test_dow0_sunday_is_zero(spark):
    # 2024-01-07 was a Sunday, 2024-01-13 a Saturday
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 12),), (dt.datetime(2024, 1, 13, 1),)], "t timestamp_ntz")
    got = [r.v for r in df.select(C.dow0("t").alias("v")).collect()]
    assert got == [0, 6]
    assert _one(spark, C.day_name(F.lit(0))) == "Sunday"
    assert _one(spark, C.day_name(F.lit(7))) is None


def test_day_gap_counts_calendar_boundaries(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 23, 0), dt.datetime(2024, 1, 2, 1, 0))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert df.select(C.day_gap("a", "b").alias("v")).collect()[0].v == 1
    # span of a group: +1
    assert df.select(C.day_gap("a", "b").alias("v")).collect()[0].v + 1 == 2


def test_strict_least_greatest_null(spark):
    df = spark.createDataFrame([(None,), (150.0,), (20.0,)], "x double")
    got = [r.v for r in df.select(C.strict_least(F.lit(100.0), "x").alias("v")).collect()]
    assert got == [None, 100.0, 20.0]
    got = [r.v for r in df.select(C.strict_greatest(F.lit(100.0), "x").alias("v")).collect()]
    assert got == [None, 150.0, 100.0]
    # plain least skips NULL: the trap this helper avoids
    assert df.select(F.least(F.lit(100.0), "x").alias("v")).collect()[0].v == 100.0


def test_mode_of_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "x string")
    assert df.agg(C.mode_of("x").alias("m")).collect()[0].m == "a"


def test_per_hour_is_double(spark):
    df = spark.createDataFrame([(7200,)], "s bigint").select(C.per_hour("s").alias("h"))
    assert df.schema["h"].dataType.simpleString() == "double"
    assert df.collect()[0].h == 2.0


def test_ratio_null_on_zero(spark):
    df = spark.createDataFrame([(3, 0), (3, 2)], "a bigint, b bigint")
    assert [r.v for r in df.select(C.ratio("a", "b").alias("v")).collect()] == [None, 1.5]


def test_share_if(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), ("x",)], "d string")
    assert df.agg(C.share_if(F.col("d") == "x").alias("s")).collect()[0].s == 0.75


def test_hash_helpers_stable_and_in_range(spark):
    df = spark.range(0, 5000, numPartitions=7)
    a = df.select("id", C.hash_int(10, 99, "id", seed=3).alias("v"), C.hash_unit("id").alias("u"))
    b = spark.range(0, 5000, numPartitions=2).select(
        "id", C.hash_int(10, 99, "id", seed=3).alias("v"), C.hash_unit("id").alias("u")
    )
    ra = sorted(map(tuple, a.collect()))
    rb = sorted(map(tuple, b.collect()))
    assert ra == rb
    vs = [r[1] for r in ra]
    assert min(vs) == 10 and max(vs) == 99
    assert all(0.0 <= r[2] < 1.0 for r in ra)


def test_stable_id_repeatable(spark):
    df = spark.range(3).select(C.stable_id("id", seed=1).alias("a"), C.stable_id("id", seed=1).alias("b"))
    for r in df.collect():
        assert r.a == r.b and len(r.a) == 32


def test_value_map_without_else_is_null(spark):
    df = spark.createDataFrame([("A",), ("Z",)], "x string")
    got = [r.v for r in df.select(C.value_map("x", {"A": 1.5}).alias("v")).collect()]
    assert got == [1.5, None]


def test_programme_key_and_hour_slot(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5, 21, 47, 3),)], "t timestamp_ntz")
    r = df.select(C.programme_key("CH-", "t").alias("p"), C.hour_slot("t").alias("s")).collect()[0]
    assert r.p == "CH-20240105-21"
    assert r.s == dt.datetime(2024, 1, 5, 21, 0)
    assert df.select(C.hour_slot("t").alias("s")).schema["s"].dataType.simpleString() == "timestamp_ntz"


def test_week_start_is_monday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 12),)], "t timestamp_ntz")  # Sunday
    assert df.select(C.week_start("t").alias("w")).collect()[0].w == dt.datetime(2024, 1, 1)


def test_cluster_conf_sizes_partitions():
    from tvlens.session import cluster_conf, shuffle_partitions_for

    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(100 * 1024**4) == 409600  # 100 TB / 256 MB
    assert cluster_conf(10 * 1024**3)["spark.sql.shuffle.partitions"] == "40"


def test_round_doubles_matches_duckdb_round(spark):
    import random

    import duckdb

    from tvlens.plans.catalog import round_doubles

    rng = random.Random(7)
    values = [2.5e-6, 0.0000125, 1.0000005, 123.4567895, -0.0000025, 0.1234565, 1 / 640, 7 / 1280, 0.0]
    values += [rng.uniform(-1000, 1000) for _ in range(200)] + [k / 640 for k in range(1, 400)]
    got = [r.x for r in round_doubles(spark.createDataFrame([(v,) for v in values], "x double")).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT round(?::DOUBLE, 6)", [v]).fetchone()[0] for v in values]
    assert got == want


def test_json_object_drops_null_fields(spark):
    """Object construction leaves NULL fields out; variant reads them back."""
    df = spark.createDataFrame([(1, None)], "a int, b string")
    r = df.select(C.json_object({"a": "a", "b": "b"}).alias("j")).collect()[0]
    assert r.j == '{"a":1}'
    v = df.select(F.variant_get(C.to_variant(F.struct("a", "b")), "$.a", "int").alias("a")).collect()[0]
    assert v.a == 1


def test_top_k_puts_null_scores_first(spark):
    """NULL sorts as the largest value, so a NULL score leads a descending top-k."""
    from tvlens.plans.gold import top_customers

    df = spark.createDataFrame(
        [("a", 5.0), ("b", None), ("c", 9.0), ("d", 9.0)], "customer_id string, engagement_score double"
    )
    got = [r.customer_id for r in top_customers(df, 3, ["customer_id", "engagement_score"]).collect()]
    assert got == ["b", "c", "d"]
