"""Pitman-Yor scores: exact counts, exact seating law, probabilities recomputed from the seating."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from llm.support import ODD, SF, docs, texts

from tvlens.llm import pitman_yor as py
from tvlens.llm.common import crc_fold, cut_lineage
from tvlens.llm.queries import QUERIES
from tvlens.llm.restaurants import Level, first_seating

def held_out():
    return crc_fold(F.col("doc_id"), 5) == 1


def tokens(text):
    return [w.lower() for w in (text or "").encode().split()] + [b""]


def held(doc_id):
    import zlib

    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 == 1


def base(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of rows (doc_id, text)."""
    learned = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(learned.values()), len(learned)
    out = []
    for i, t in rows:
        w = tokens(t)
        s = sum(math.log10((learned[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        out.append((i, held(i), len(w), sum(x in learned for x in w), n, round(s, 6)))
    return sorted(out, key=str)


def found(scored):
    rows = scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6)).collect()
    return sorted(map(tuple, rows), key=str)


def odd_rows():
    rows = [(i, t) for i, t in enumerate(ODD)]
    return rows + [(None, "same text here"), (None, "same text here"), (3, "x y z"), (3, "x y z"), (40, "ABC ÄB abc äb " * 5)]


def test_counts_and_base_score(spark):
    rows = odd_rows()
    scored = py.score(docs(spark, rows), held_out())
    assert found(scored) == base(rows)
    assert all(r.score < 0 for r in scored.collect())


def test_long_texts_in_pieces(spark, monkeypatch):
    rows = [(0, "aa bb " * 100), (1, " lead " + "cc dd ee " * 70 + "no_space" * 40), (2, "x"), (4, None)]
    whole = py.score(docs(spark, rows), held_out()).orderBy("doc_id").collect()
    monkeypatch.setattr(py, "BLOCK_BYTES", 64)
    monkeypatch.setattr(py, "PIECE_BYTES", 101)
    cut = py.score(docs(spark, rows), held_out())
    assert found(cut) == base(rows)
    # The pairs are the same ones, so the same dishes are seated.
    assert [round(r.score, 6) for r in cut.orderBy("doc_id").collect()] == [round(r.score, 6) for r in whole]


def test_no_training_documents(spark):
    assert py.score(docs(spark, []), held_out()).collect() == []
    only = [(i, "a b") for i in range(40) if held(i)]
    assert {(r.n_tokens, r.n_known, r.base_score, r.score, r.train_tokens) for r in py.score(docs(spark, only), held_out()).collect()} == {
        (3, 0, 0.0, 0.0, 0)
    }


def test_scores_from_the_seating_in_plain_python(spark, monkeypatch):
    """All probabilities again from the final customers and tables, and their sums over the vocabulary."""
    monkeypatch.setattr(py, "PART_BYTES", 30_000)
    rows = texts()
    table = docs(spark, rows)
    size = sum(len((t or "").encode()) for _, t in rows)
    sheets = cut_lineage(py.sheets(table, held_out(), -(-size // py.PART_BYTES), "doc_id", "text"))
    state, totals = py.learn(sheets.where("part >= 0"))
    seat = [[Counter() for _ in range(6)] for _ in totals]
    for r in state.collect():
        part = py.Part.read(bytes(r.data))
        words = py._listed(part.words, part.lengths)
        for s, (c2, t2, c1, t1, c0, t0) in zip(seat, part.past, strict=True):
            for k, (w, leaf) in enumerate(zip(part.word.tolist(), part.leaf.tolist(), strict=True)):
                s[0][words[w], leaf], s[1][words[w], leaf] = int(c2[k]), int(t2[k])
            for k, (w, up) in enumerate(zip(part.word1.tolist(), part.parent1.tolist(), strict=True)):
                s[2][words[w], up], s[3][words[w], up] = int(c1[k]), int(t1[k])
            for w, c, t in zip(words, c0.tolist(), t0.tolist(), strict=True):
                s[4][w], s[5][w] = c, t
    types = len(seat[0][4])

    def sums(counter, k=1):
        out = Counter()
        for key, n in counter.items():
            out[key[k]] += n
        return out

    def model(s):
        c2, t2, c1, t1, c0, t0 = s
        d = []
        for c in (c2, c1, c0):
            n = Counter(c.values())
            d.append(min(0.95, max(0.05, n[1] / (n[1] + 2 * n[2]))))
        cc2, tt2, cc1, tt1, all0, tt0 = sums(c2), sums(t2), sums(c1), sums(t1), sum(c0.values()), sum(t0.values())

        def p(w, leaf):
            p0 = (c0[w] - d[2] * t0[w] + (1 + d[2] * tt0) / (types + 1)) / (1 + all0)
            up = leaf // 64
            p1 = (c1[w, up] - d[1] * t1[w, up] + (1 + d[1] * tt1[up]) * p0) / (1 + cc1[up])
            return (c2[w, leaf] - d[0] * t2[w, leaf] + (1 + d[0] * tt2[leaf]) * p1) / (1 + cc2[leaf])

        # Customers of a parent are the tables below it.
        up = Counter()
        for (w, leaf), t in t2.items():
            up[w, leaf // 64] += t
        assert up == c1 and sums(t1, 0) == c0
        return p

    models = [model(s) for s in seat]
    assert len(models) == 2 and seat[0][1] != seat[1][1]  # the seating moved
    vocabulary = [*seat[0][4], b"an unknown word"]
    for leaf in [0, *sorted({k[1] for k in seat[0][0]})[::40]]:
        for p in models:
            assert abs(sum(p(w, leaf) for w in vocabulary) - 1) < 1e-9
    got = {r.doc_id: r.score for r in py.score(table, held_out()).collect()}
    for i, t in rows:
        w = tokens(t)
        leaves = py.contexts([b"", *w[:-1]]).tolist()
        want = sum(math.log10(sum(p(x, k) for p in models) / 2) for x, k in zip(w, leaves, strict=True))
        assert got[i] == pytest.approx(want, rel=1e-6, abs=1e-5)


def test_better_than_the_base_on_held_out_documents(spark):
    scored = QUERIES["op13_pitman_yor"](spark, SF)
    rows = texts()
    assert found(scored) == base(rows)
    for r in py.perplexity(scored).collect():
        assert r.perplexity < 0.7 * r.base_perplexity
    assert sorted(map(str, scored.collect())) == sorted(map(str, QUERIES["op13_pitman_yor"](spark, SF).collect()))


def stirling_law(c, a, d):
    """Law of the number of tables of c customers when a new table weighs a."""
    s = {0: {0: 1.0}}
    for n in range(c):
        s[n + 1] = {t: s[n].get(t - 1, 0) + (n - d * t) * s[n].get(t, 0) for t in range(1, n + 2)}
    w = np.array([s[c][t] * a**t for t in range(1, c + 1)])
    return w / w.sum()


@pytest.mark.parametrize(("c", "a", "d"), [(2, 0.3, 0.5), (3, 0.05, 0.8), (5, 1.5, 0.6), (8, 0.4, 0.3)])
def test_gibbs_reaches_the_law_of_the_tables(c, a, d):
    rng, n = np.random.default_rng(5), 20_000
    level = Level(np.full(n, c))
    level.gibbs(np.full(n, a), d, 25 * c, rng)
    assert (level.c == c).all() and (np.bincount(level.row, level.size) == c).all() and (level.size > 0).all()
    share = np.bincount(level.t, minlength=c + 1)[1:] / n
    assert np.abs(share - stirling_law(c, a, d)).max() < 0.015


def test_first_seating_is_the_walk_customer_by_customer():
    rng, n, c, d = np.random.default_rng(6), 20_000, 30, 0.6
    a = np.full(n, 0.8)
    row, size = first_seating(np.full(n, c), a, d, rng)
    assert (np.bincount(row, size) == c).all() and (np.diff(row) >= 0).all()
    t = np.ones(n)
    for i in range(1, c):
        t += rng.random(n) < a / (a + i - d * t)
    got = np.bincount(np.bincount(row), minlength=c) / n
    assert np.abs(got[: c - 1] - np.bincount(t.astype(int), minlength=c)[: c - 1] / n).max() < 0.02
    one, alone = first_seating(np.array([1, 1]), np.array([0.1, 9.0]), d, rng)
    assert one.tolist() == [0, 1] and alone.tolist() == [1, 1]
    # A hot dish: few draws, not one for each customer.
    assert first_seating(np.array([10**9]), np.array([2.0]), 0.5, rng)[1].sum() == 10**9


def test_customers_come_and_go():
    rng = np.random.default_rng(7)
    level = Level(np.array([5, 1, 9, 3]))
    level.change(np.array([2, 4, 9, 1]), np.full(4, 0.5), 0.5, rng)
    assert level.c.tolist() == [2, 4, 9, 1] and np.bincount(level.row, level.size).tolist() == [2, 4, 9, 1]


def test_block_lists_every_token_once():
    rows = [t for _, t in odd_rows()]
    train = np.array([i % 3 > 0 for i in range(len(rows))])
    out = list(py.block_sheets(7, pa.array([t or "" for t in rows]), (0, [], []), train, 5))
    own = py._get(out[-1][2])
    assert out[-1][1] == -1 and [o[1] for o in out[:-1]] == sorted(o[1] for o in out[:-1])
    learned = Counter()
    for _, _, data in out[:-1]:
        words, lengths, each, _, counts = py._get(data)
        for w, n in zip(np.repeat(np.arange(len(each)), each), counts.tolist(), strict=True):
            learned[py._listed(words, lengths)[w]] += n
    assert +learned == Counter(w for t, ok in zip(rows, train, strict=True) if ok for w in tokens(t))
    doc = np.repeat(np.arange(len(own[1])), own[1])
    assert np.bincount(doc, own[3], len(rows)).tolist() == [len(tokens(t)) for t in rows]
