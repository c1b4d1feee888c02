"""op13: restaurants are whole words, their probabilities recomputed from the seating."""

import math
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from llm.support import docs, texts
from llm.test_pitman_yor import base, found, held, held_out, odd_rows, tokens

from tvlens.llm import word_contexts as wc
from tvlens.llm.common import cut_and_tidy, cut_lineage
from tvlens.llm.pitman_yor import _listed, sheets
from tvlens.llm.queries import QUERIES
from tvlens.llm.restaurants import Level


def test_words_with_one_ending_are_different_contexts(spark, tmp_path):
    """Both words end in the same four bytes; what follows them tells them apart."""
    ids = [i for i in range(400) if not held(i)]
    test = [i for i in range(400) if held(i)][:2]
    rows = [(i, "alpha_ending red" if i % 2 else "omega_ending blue") for i in ids]
    rows += [(test[0], "alpha_ending red"), (test[1], "alpha_ending blue")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.score for r in QUERIES["op13_pitman_yor"](spark, str(tmp_path)).collect()}
    assert got[test[0]] > got[test[1]] + 1


def test_counts_and_base_score(spark):
    rows = odd_rows()
    scored = wc.score(docs(spark, rows), held_out())
    assert found(scored) == base(rows)
    assert all(r.score < 0 for r in scored.collect())
    assert wc.score(docs(spark, []), held_out()).collect() == []
    only = [(i, "a b") for i in range(40) if held(i)]
    assert {(r.n_tokens, r.n_known, r.base_score, r.score, r.train_tokens) for r in wc.score(docs(spark, only), held_out()).collect()} == {
        (3, 0, 0.0, 0.0, 0)
    }


def test_long_texts_in_pieces(spark, monkeypatch):
    from tvlens.llm import pitman_yor as py

    rows = [(0, "aa bb " * 100), (1, " lead " + "cc dd ee " * 70 + "no_space" * 40), (2, "x"), (4, None)]
    whole = wc.score(docs(spark, rows), held_out()).orderBy("doc_id").collect()
    monkeypatch.setattr(py, "BLOCK_BYTES", 64)
    monkeypatch.setattr(py, "PIECE_BYTES", 101)
    cut = wc.score(docs(spark, rows), held_out())
    assert found(cut) == base(rows)
    assert [round(r.score, 5) for r in cut.orderBy("doc_id").collect()] == [round(r.score, 5) for r in whole]


def test_scores_from_the_seating_in_plain_python(spark, monkeypatch):
    """One sample, again from the final customers and tables; sums over the vocabulary are 1."""
    monkeypatch.setattr(wc, "PART_BYTES", 30_000)
    rows = texts()
    table = docs(spark, rows)
    parts = -(-sum(len((t or "").encode()) for _, t in rows) // wc.PART_BYTES)
    assert parts > 2
    asked = cut_lineage(sheets(table, held_out(), parts, "doc_id", "text", wc.block_sheets)).where("part >= 0")
    state, models = wc.learn(asked, parts, samples=1)
    c2, t2, c0, t0 = Counter(), Counter(), {}, {}
    everything = {w for _, t in rows for w in tokens(t)}
    named = dict(zip(wc.hashes(sorted(everything)).tolist(), sorted(everything), strict=True))
    for r in state.collect():
        part = wc.Part.read(bytes(r.data))
        words, (leaves, root) = _listed(part.words, part.lengths), part.levels
        for w, u, c, t in zip(part.word.tolist(), part.names[part.context].tolist(), leaves.c.tolist(), leaves.t.tolist(), strict=True):
            c2[words[w], named[u]], t2[words[w], named[u]] = c, t
        c0 |= dict(zip(words, root.c.tolist(), strict=True))
        t0 |= dict(zip(words, root.t.tolist(), strict=True))
    learned = Counter(p for i, t in rows if not held(i) for p in zip(tokens(t), [b"", *tokens(t)], strict=False))
    assert c2 == learned
    d = [(lambda n: min(0.95, max(0.05, n[1] / (n[1] + 2 * n[2]))))(Counter(c.values())) for c in (c2, c0)]
    cu, tu, up = Counter(), Counter(), Counter()
    for (w, u), c in c2.items():
        cu[u] += c
        tu[u] += t2[w, u]
        up[w] += t2[w, u]
    assert up == c0

    all_t0, all_c0 = sum(t0.values()), sum(c0.values())

    def p(w, u):
        p0 = (c0.get(w, 0) - d[1] * t0.get(w, 0) + (1 + d[1] * all_t0) / (len(c0) + 1)) / (1 + all_c0)
        return (c2[w, u] - d[0] * t2[w, u] + (1 + d[0] * tu[u]) * p0) / (1 + cu[u])

    for u in [b"", b"never a context", *sorted(cu)[:: len(cu) // 20]]:
        assert abs(sum(p(w, u) for w in [*c0, b"an unknown word"]) - 1) < 1e-9
    got = {r.doc_id: r.score for r in wc.score(table, held_out(), samples=1).collect()}
    for i, t in rows:
        w = tokens(t)
        assert got[i] == pytest.approx(sum(math.log10(p(x, u)) for x, u in zip(w, [b"", *w[:-1]], strict=True)), rel=1e-5, abs=1e-4)


def test_two_words_with_one_hash_raise(monkeypatch):
    monkeypatch.setattr(wc, "hashes", lambda words: np.zeros(len(words), np.uint64))
    one = np.ones(2, np.int64)
    with pytest.raises(RuntimeError, match="one hash"):
        wc.Part.merged([b"a", b"b"], np.arange(2), one.astype(np.uint64), one, 1)


def test_block_lists_every_token_once():
    rows = [t for _, t in odd_rows()]
    train = np.array([i % 3 > 0 for i in range(len(rows))])
    out = list(wc.block_sheets(7, pa.array([t or "" for t in rows]), (0, [], []), train, 5))
    learned = Counter()
    for _, _, data in out[:-1]:
        words, lengths, each, _, _, counts = wc._get(data)
        for w, n in zip(np.repeat(np.arange(len(each)), each), counts.tolist(), strict=True):
            learned[_listed(words, lengths)[w]] += n
    assert +learned == Counter(w for t, ok in zip(rows, train, strict=True) if ok for w in tokens(t))


def checkpoints(spark):
    return set(Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).glob("rdd-*"))


def test_replaced_states_are_deleted(spark, monkeypatch):
    monkeypatch.setattr(wc, "PART_BYTES", 30_000)
    asked = cut_lineage(sheets(docs(spark, texts()), held_out(), 3, "doc_id", "text", wc.block_sheets)).where("part >= 0")
    before = checkpoints(spark)
    state, _ = wc.learn(asked, 3)
    assert len(checkpoints(spark) - before) == 1
    assert state.count() == 3


def test_shuffle_files_go_with_the_checkpoint(spark):
    def files():
        held = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {n for i in range(held.size()) if (n := held.apply(i).getName()).startswith("shuffle_")}

    before = files()
    out = cut_and_tidy(spark.range(1000).repartition("id"))
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert out.count() == 1000


def test_turns_give_the_same_scores(spark, monkeypatch):
    monkeypatch.setattr(wc, "PART_BYTES", 30_000)
    table = docs(spark, texts()[:150] + odd_rows())
    rows = lambda: sorted(map(tuple, wc.score(table, held_out()).collect()), key=str)
    whole = rows()
    monkeypatch.setattr(wc, "TURN_PARTS", 1)
    assert rows() == whole


def test_moves_apart_from_still_rows():
    """Levels move some rows apart: customers add up, single ones stay, tables are in order."""
    rng = np.random.default_rng(5)
    c = rng.integers(1, 30, 500) * (rng.random(500) < 0.4) + 1
    level, a = Level(c), np.full(500, 3.0)
    level.seat(c, a, 0.6, rng)
    for to in (c, np.maximum(1, c - 9), c + 2 * (c % 7 == 0)):
        level.change(to, a, 0.6, rng)
        level.gibbs(a, 0.6, 3, rng)
        assert (level.c == to).all() and (np.bincount(level.row, level.size, 500) == to).all()
        assert (np.diff(level.row) >= 0).all() and (level.size > 0).all()


def test_steps_within_words():
    each = np.array([0, 2, 0, 1, 3, 0])
    x = np.array([4, 9, 2, 0, 1, 70000])
    assert wc._stepped(wc._small(wc._steps(x, each)), each).tolist() == x.tolist()
    assert wc._stepped(wc._small(wc._steps(x[:0], each[:0])), each[:0]).tolist() == []
