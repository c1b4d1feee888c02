"""Ranks become key values: exact labels and picks without numbering."""

import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tvlens.operators import selection
from tvlens.operators.labels import assign_quota_by_key, near_duplicates
from tvlens.operators.numbering import dense_index, first_n, row_ordinal
from tvlens.plans.catalog import all_queries
from tvlens.sources.tables import crm, read_table


def stored(spark, tmp_path, rows, schema="k bigint, v int", files=3):
    path = os.path.join(str(tmp_path), f"t{len(os.listdir(tmp_path))}")
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
    return spark.read.parquet(path)


def fixed(rank):
    return lambda rows: F.lit(rank)


def check_labels(df, keys, ranks):
    """Every label has exactly its number of rows, and labels follow the key order (NULLs last)."""
    names = [f"L{i}" for i in range(len(ranks))]
    out = assign_quota_by_key(df, "k", [(n, fixed(r)) for n, r in zip(names, ranks, strict=True)], "rest", "lab")
    rows = out.collect()
    assert Counter((r.k, r.v) for r in rows) == Counter(map(tuple, df.collect()))
    got, before = Counter(r.lab for r in rows), 0
    for n, r in zip(names, ranks, strict=True):
        r = max(before, min(max(r, 0), len(keys)))
        assert got.get(n, 0) == r - before, (n, ranks)
        before = r
    place = {n: i for i, n in enumerate([*names, "rest"])}
    ordered = sorted((place[r.lab], float("inf") if r.k is None else r.k) for r in rows)
    assert [k for _, k in ordered] == sorted(k for _, k in ordered)


CASES = {
    "gaps, outliers, nulls": ([i * 10 for i in range(700)] + [-5, 10**17, None, None, 30, 30], [0, 1, 5, 350, 703, 706, 900]),
    "hot key and hot NULL": ([7] * 1000 + [None] * 1000 + list(range(1000)), [10, 500, 1008, 1500, 2000, 2500]),
    "large keys": (list(range(10**18, 10**18 + 800)) + [10**18 + 5] * 300, [3, 7, 200, 700]),
    "one key": ([5] * 7, [2, 4]),
    "all NULL": ([None] * 5, [2]),
    "one row": ([5], [1]),
    "no row": ([], [1]),
}


@pytest.mark.parametrize("case", CASES)
def test_quota_labels_are_exact(spark, tmp_path, case):
    keys, ranks = CASES[case]
    rows = [(k, i % 3) for i, k in enumerate(keys)]
    df = stored(spark, tmp_path, rows)
    assert selection.row_identity(df) is not None
    check_labels(df, keys, ranks)
    # Rows that are no table scan are numbered instead; the labels are as exact.
    check_labels(spark.createDataFrame(rows, "k bigint, v int").repartition(2), keys, ranks)


def test_dates_and_times_have_an_exact_order(spark, tmp_path):
    import datetime as dt

    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i * 3 % 200) for i in range(300)]
    times = [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i * 7919 % 100000) for i in range(300)]
    df = stored(spark, tmp_path, list(zip(days, times, strict=True)), "d date, t timestamp_ntz")
    tie = selection.row_identity(df)
    for column, values in (("d", days), ("t", times)):
        out = selection.rank_flag(df, F.col(column), tie, fixed(100), "first").where("first")
        assert sorted(r[column] for r in out.collect()) == sorted(values)[:100]
    with pytest.raises(TypeError, match="no exact order"):
        selection.order_key(df, F.col("d").cast("string"))


def test_row_identity_only_where_rows_come_from_files(spark):
    c = read_table(spark, SF001, "customer")
    assert selection.row_identity(c.where("c_custkey > 3").withColumn("x", F.lit(1))) is not None
    for other in (spark.range(5), c.union(c), c.crossJoin(spark.range(2)), c.withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))), c.distinct()):
        assert selection.row_identity(other) is None
    names = c.select(selection.row_identity(c).alias("t"))
    assert names.distinct().count() == names.count() == c.count()


def test_a_bound_outside_its_bracket_is_an_error(spark, tmp_path, monkeypatch):
    """A sketch that lies must not give a wrong label."""
    df = stored(spark, tmp_path, [(i, 0) for i in range(1000)])
    real = selection.quantiles
    monkeypatch.setattr(selection, "quantiles", lambda c, q, a: f"transform({real(c, q, a)}, x -> 3.5D)")
    out = selection.rank_flag(df, F.col("k"), selection.row_identity(df), fixed(500), "first")
    with pytest.raises(Exception, match="outside its bracket"):
        out.collect()


def test_first_n_of_a_scan_and_of_other_rows(spark, tmp_path):
    rows = [(i % 200, i) for i in range(500)]
    df = stored(spark, tmp_path, rows)
    everything = dense_index(df, ["k"], "rn", seed=4).collect()
    for n in (0, 1, 7, 250, 499, 500, 900):
        got = [(r.k, r.v) for r in first_n(df, n, ["k"], seed=4).collect()]
        assert len(got) == len(set(got)) == min(n, 500)
        # The same keys as the head of the dense order; among equal keys any row.
        head = Counter(r.k for r in everything if r.rn <= n)
        assert Counter(k for k, _ in got) == head
    hot = stored(spark, tmp_path, [(1, 0)] * 900 + [(i, i) for i in range(50)])
    assert first_n(hot, 333, ["k"]).count() == 333
    assert first_n(hot, hot.select(F.count(F.lit(1)) - 900).scalar(), ["k"]).count() == 50


def test_near_duplicates_in_one_pass_equal_the_numbered_ones(spark):
    c = crm(read_table(spark, SF01, "customer"))
    args = (["customer_id"], F.col("overlap_type") == "NONE", "customer_id", "email", "phone", "overlap_type")
    tenth = lambda rows: F.bround(rows * F.lit(0.1), 0)
    one_pass = sorted(map(tuple, near_duplicates(c, tenth, *args, seed=7).collect()), key=str)
    numbered = near_duplicates(spark.createDataFrame(c.collect(), c.schema), tenth, *args, seed=7)
    assert one_pass == sorted(map(tuple, numbered.collect()), key=str)
    assert len(one_pass) == 1650
    assert near_duplicates(c, 10**6, *args).count() == 1500 + 1125  # all eligible rows, once


def test_labels_of_a_crm_with_repeated_and_missing_keys(spark, tmp_path):
    c = read_table(spark, SF01, "customer")
    holes = c.withColumn("c_custkey", F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("c_custkey") % 400))
    path = os.path.join(str(tmp_path), "customer")
    holes.union(holes.where("c_custkey = 5")).union(holes.limit(333)).write.parquet(path)
    df = spark.read.parquet(path)
    n = df.count()
    t, e, p = (round(round(n * 0.25) * w / 25) for w in (8, 10, 7))
    got = Counter(r.overlap_type for r in crm(df).select("overlap_type").collect())
    assert got == {"TRIPLE": t, "EMAIL": e, "PHONE": round(n * 0.25) - t - e, "NONE": n - round(n * 0.25)}


def test_row_ordinal_splits_a_hot_key_over_parts(spark):
    rows = [(7, i) for i in range(2000)] + [(None, i) for i in range(500)] + [(i, 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "k bigint, v int").repartition(4)
    out = row_ordinal(df, "k").collect()
    ordered = sorted(out, key=lambda r: r.rn)
    assert [r.rn for r in ordered] == list(range(1, len(rows) + 1))
    keys = [r.k for r in ordered]
    assert keys == sorted(k for k, _ in rows if k is not None) + [None] * 500
    text = row_ordinal(spark.createDataFrame([(2.5,), (-1.0,), (None,), (2.5,)], "k double"), "k").collect()
    assert [r.k for r in sorted(text, key=lambda r: r.rn)] == [-1.0, 2.5, 2.5, None]


def _plan(spark, name):
    return all_queries()[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("name", "scans", "windows"),
    [("crm", 3, 1), ("crm_count", 1, 0), ("segment_summary", 2, 0), ("assign_quota", 3, 1), ("row_number", 4, 2)],
)
def test_plans_stay_small(spark, name, scans, windows):
    plan = _plan(spark, name)
    assert plan.count("FileScan") <= scans
    assert len(re.findall(r"Window \[", plan)) <= windows
    assert len(plan) < 120_000


def test_plan_of_near_duplicates(spark):
    plan = _plan(spark, "near_duplicates")
    assert plan.count("FileScan") < 10 and len(plan) < 120_000


def test_labels_are_a_projection(spark):
    """No exchange above the scan of the labelled rows: all of them are in the subquery."""
    plan = _plan(spark, "crm")
    outside = [line for line in plan.split("\n") if not re.match(r"\s+:", line)]
    assert not any("Exchange" in line or "Window" in line or "Join" in line for line in outside)
