"""Staged tables end with their block; results come in pages."""

import datetime as dt
import os
from decimal import Decimal

import pandas as pd
import pytest

from tvlens.sources import stages
from tvlens.sources.pages import page, pages
from tvlens.sources.versions import listing


def left(spark):
    return [name for name, _, _ in listing(spark, stages.stage_root(spark))]


def test_stages_end_with_the_block_the_last_reader_and_an_error(spark):
    before = left(spark)
    with stages.Stages(spark) as block:
        a = block.stage(spark.range(10), "lookup", readers=2)
        b = block.stage(spark.range(3), "lookup2")
        assert a.count() == 10 and b.count() == 3
        with pytest.raises(ValueError, match="exists"):
            block.stage(spark.range(1), "lookup")
        block.done("lookup")
        assert a.agg({"id": "max"}).first()[0] == 9
        block.done("lookup")
        assert [n for n, _, _ in listing(spark, block.folder)] == ["lookup2"]
        again = block.stage(spark.range(4), "lookup")  # a rerun inside the block
        assert again.count() == 4
    assert left(spark) == before
    with pytest.raises(RuntimeError, match="job"), stages.Stages(spark) as block:
        block.stage(spark.range(5), "lookup")
        raise RuntimeError("job")
    assert left(spark) == before
    with stages.Stages(spark) as block:  # and a rerun after the error
        assert block.stage(spark.range(5), "lookup").count() == 5
    assert left(spark) == before


def test_sweep_removes_what_a_killed_driver_left(spark):
    root = stages.stage_root(spark)
    own = stages.Stages(spark)
    own.stage(spark.range(2), "x")
    for name in ("app-old_100_ab", "app-new_99999999999_cd", "odd"):
        spark.range(1).write.parquet(os.path.join(root, name, "t"))
    assert stages.sweep(spark) == ["app-old_100_ab"]
    assert {"app-new_99999999999_cd", "odd", os.path.basename(own.folder)} <= set(left(spark))
    own.__exit__()


ROWS = [
    (i % 4 if i % 5 else None, None if i % 7 == 0 else f"s{i % 3}", i / 3, dt.datetime(2024, 1, 1 + i % 9, 1, 2, 3, 456), b"\x00%d" % (i % 6))
    for i in range(60)
]


def test_pages_give_every_row_once_in_order(spark):
    rows = ROWS + ROWS[:10] + [ROWS[3]] * 25  # ties over several pages
    schema = "k int, `odd name` string, d double, t timestamp_ntz, b binary"
    df = spark.createDataFrame(rows, schema).repartition(3)
    for size in (1, 7, 24, 94, 95, 96, 500):
        got = list(pages(df, ["odd name", "k"], size))
        assert all(len(p) == size for p in got[:-1]) and sum(map(len, got)) == len(rows)
        whole = pd.concat(got)
        nulls_last = lambda v: (pd.isna(v), None if pd.isna(v) else v)
        keys = [(nulls_last(a), nulls_last(b)) for a, b in zip(whole["odd name"], whole["k"], strict=True)]
        assert [x[0][0] for x in keys] == sorted(x[0][0] for x in keys)
        text = lambda r: str([None if pd.isna(v) else v for v in r])
        want = sorted(text(r) for r in df.toPandas().itertuples(index=False))
        assert sorted(text(r) for r in whole.itertuples(index=False)) == want


def test_a_token_goes_on_in_another_session(spark):
    df = spark.createDataFrame([(i, Decimal(i) / 4, i % 2 == 0) for i in range(10)], "id int, d decimal(10,2), even boolean")
    first, token = page(df, ["even"], 4)
    other = spark.newSession().createDataFrame(df.collect(), df.schema)
    rest = pd.concat(pages(other, ["even"], 3, token))
    assert sorted([*first["id"], *rest["id"]]) == list(range(10)) and not first["even"].any()
    assert page(df.limit(0), ["id"], 5)[1] is None and list(pages(df.limit(0), ["id"], 5)) == []
