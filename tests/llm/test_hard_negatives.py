"""Hard negatives against all pairs computed in Python."""

import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from llm.support import SF

from tvlens.llm import hard_negatives as hn
from tvlens.llm.queries import QUERIES
from tvlens.llm.sql import SQL

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string, key int"


def mined(rows, every=100):
    """Brute force; rows (vec_id, vector, label)."""
    known = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        known.setdefault(i, []).append((label, np.array(q, "<i8").tobytes(), q))
    known = {i: (min(r)[0], min(r)[2]) for i, r in known.items()}
    out = set()
    for a, (label, q) in known.items():
        if a % every:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(q, r, strict=False)), i, own) for i, (own, r) in known.items() if i != a)
        for s, p, _ in [r for r in ranked if r[2] == label][:5]:
            fits = [(-t, n) for t, n, own in ranked if own != label and 30 * -s <= 100 * -t <= 90 * -s]
            out |= {(a, p, k, n, -s, t) for k, (t, n) in enumerate(fits[:10], 1)}
    return out


def found(spark, rows, every=100):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = [tuple(r) for r in hn.mine(table, F.col("vec_id") % every == 0).collect()]
    assert len(got) == len(set(got))
    return set(got)


def random_rows(n, seed, dims=6, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (labels, dims))
    label = rng.integers(0, labels, n)
    vectors = centres[label] + rng.normal(0, 0.25, (n, dims))
    return [(i, v, int(k)) for i, (v, k) in enumerate(zip(vectors.round(2).tolist(), label, strict=True))]


def test_all_pairs_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 90)
    monkeypatch.setattr(hn, "ANCHORS", 7)
    rows = random_rows(600, 0)
    rows += [(1000, None, 1), (1001, [None, 1.0], 1), (1002, [float("nan")] * 6, 1), (1003, [float("inf")] * 6, 2)]
    rows += [(None, [0.5] * 6, 1), (1004, [0.5] * 6, None), (1100, [], 1), (1200, [0.5, 0.5], 1), (-100, [0.3] * 6, 2)]
    rows += [rows[20], rows[20], (40, [0.9] * 6, 3), (60, rows[60][1], 0)]
    got = found(spark, rows, 20)
    assert got == mined(rows, 20) and len(got) > 500


def test_copies_of_one_vector_and_ties(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 64)
    rows = random_rows(300, 1) + [(i, [0.5] * 6, i % 4) for i in range(300, 450)] + [(i, [0.0] * 6, i % 2) for i in range(450, 500)]
    got = found(spark, rows, 10)
    assert got == mined(rows, 10)
    # A positive of score 0 takes negatives of score 0.
    assert any(r[0] >= 450 and r[4] == r[5] == 0 for r in got)


def test_few_rows(spark):
    assert found(spark, []) == set()
    assert found(spark, [(0, [1.0], 1)]) == set()
    assert found(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]) == {(0, 1, 1, 2, 65536, 32768)}
    assert found(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)]) == set()


def test_exact_scores_and_windows():
    a = np.array([[1 << 40, 3], [1 << 20, -5]])
    b = np.array([[1 << 21, 7], [-(1 << 22), 1]])
    assert hn.scores(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(r, c, strict=True)) for c in b] for r in a]
    with pytest.raises(OverflowError):
        hn.scores(a << 20, b << 20)
    for s in [*range(-250, 250), 10**17 + 7, 9 * 10**18, -(9 * 10**18)]:
        lo, hi = (int(x[0]) for x in hn.window(np.array([s]), 30, 90))
        assert lo == -((-30 * s) // 100) and hi == 90 * s // 100


def test_keys_sort_as_wanted():
    rows = [(a, s, k, i) for a in (-5, 0, 7) for s in (9, 3, 0, -2) for k in (0, 1) for i in (-1, 0, 4)]
    keys = [k for a, s, kind, i in rows for k in hn.pack(np.array([a]), np.array([s]), kind, np.array([i])).column(0).to_pylist()]
    assert keys == sorted(keys)
    back = hn.unpack(pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], ["key"]))
    assert list(zip(*(c.tolist() for c in back), strict=True)) == rows


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.sql(SQL["op11_hard_negatives"])
    cols, rows = want.columns, want.fetchall()
    got = QUERIES["op11_hard_negatives"](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(rows) and rows
