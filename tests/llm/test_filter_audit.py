"""Filter audit: every order applied document by document, the potential against the mean over orders."""

from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from llm.support import ODD, SF, docs

from tvlens.llm import filter_audit as fa
from tvlens.llm.queries import QUERIES
from tvlens.llm.sql import SQL

LABELS = "doc_id bigint, quality int, toxic int"
GAPS = set(" \t\n\x0b\x0c\r")


def words_of(text):
    out, word = [], ""
    for ch in text + " ":
        if ch in GAPS:
            out += [word] if word else []
            word = ""
        else:
            word += ch
    return out


def applied(rows, labels):
    """The audit by brute force; rows (doc_id, part, text)."""
    fails = []
    for i, part, text in rows:
        text, w = text or "", words_of(text or "")
        copy = i is not None and any(j is not None and j < i and (u or "") == text for j, _, u in rows)
        caps = sum("A" <= c <= "Z" for c in text)
        bad = (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * caps > 5 * len(text), any(c in "#$%&*|" for c in text), copy)
        said = [x for x in labels if i is not None and x[0] == i]
        fails.append((part or "", bad, any(q == 1 for _, q, _ in said), any(t == 1 for _, _, t in said)))
    out, total = {}, Counter()
    for part in {f[0] for f in fails}:
        for order in permutations("ABCDE"):
            left, gone = [f for f in fails if f[0] == part], []
            for step, letter in enumerate(order, 1):
                k = "ABCDE".index(letter)
                now = [f for f in left if f[1][k]]
                left = [f for f in left if not f[1][k]]
                only = sum(f[1][k] and sum(f[1]) == 1 for f in [*left, *now, *gone])
                out[part, "".join(order), step] = [
                    len(left), len(now), sum(f[1][k] for f in gone), only, sum(f[2] for f in now), sum(f[3] for f in now)
                ]
                total[part, letter] += len(now)
                gone += now
    return {(p, o, s, *v, total[p, o[s - 1]]) for (p, o, s), v in out.items()}


COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def found(classes):
    return [tuple(r[c] for c in COLUMNS) for r in fa.audit(classes).collect()]


def test_every_order_by_brute_force(spark):
    many = " ".join(f"w{i}" for i in range(60))
    texts = [*ODD, many, many.upper(), many + " #", "a b " * 40, "A" + " a" * 60, many, many, "É" * 19 + "A", "É" * 20 + "A"]
    rows = [(i, ["x", "y", None][i % 3], t) for i, t in enumerate(texts)]
    rows += [(None, "x", many), (None, None, ""), (3, "y", many), (3, "y", many), (-1, "z", "a"), (None, "x", many)]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 20)] + [(4, 1, 1), (4, 0, 0), (5, None, None), (None, 1, 1), (77, 1, 1)]
    table = spark.createDataFrame([(*r, "q", 1) for r in rows], "doc_id bigint, source string, text string, quality string, n int")
    classes = fa.failure_classes(fa.mark(table), spark.createDataFrame(labels, LABELS))
    got = found(classes)
    assert len(got) == len(set(got)) == 4 * 600
    assert set(got) == applied(rows, labels)


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert found(fa.failure_classes(fa.mark(docs(spark, []).where("false")), none)) == []
    assert len(found(fa.failure_classes(fa.mark(docs(spark, ["a"])), none))) == 600


def test_potential_is_the_mean_over_orders():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 1000, (1, 32))
    v = fa.removed_by(counts)[0].tolist()
    p = fa.potentials(v)
    for i in range(5):
        total = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            total += v[before | 1 << i] - v[before]
        assert p[31] - p[31 ^ 1 << i] == total
    # Efficiency: the values add up to what all filters remove together.
    assert sum(p[31] - p[31 ^ 1 << i] for i in range(5)) == 120 * v[31]


def test_coalitions(spark):
    table = docs(spark, ["a # b", "A", " ".join(f"w{i}" for i in range(60))], ["s", "s", "s"])
    game = {r.coalition: r for r in fa.coalitions(fa.failure_classes(fa.mark(table), spark.createDataFrame([(1, 1, 0)], LABELS))).collect()}
    assert len(game) == 32 and game[""].potential == 0
    assert [game[c].removed for c in ("A", "C", "D", "CD", "ABCDE")] == [2, 1, 1, 2, 2]
    assert game["C"].good_removed == 1


def test_words_of_long_texts_in_pieces(monkeypatch):
    text = (" ".join(f"w{i % 37}" for i in range(5000)) + "\x1c tail").encode()
    whole = fa.count_words(text)
    monkeypatch.setattr(fa, "PIECE_BYTES", 101)
    assert fa.count_words(text) == whole == (5001, 39)


@pytest.mark.parametrize("sf", [SF])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(SQL["op12_filter_audit"])
    cols = want.columns
    got = QUERIES["op12_filter_audit"](spark, sf)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(want.fetchall())
