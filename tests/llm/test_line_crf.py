"""Line CRF: marginals against all labelings, gradient-trained accuracy."""

import itertools

import duckdb
import numpy as np
from llm.support import ODD, docs
from tvlens.llm import line_crf as C
from tvlens.llm.queries import op8_line_crf

SF1 = "/root/testdata/sf0.1"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    sizes = [1, 4, 3]
    doc = np.repeat(np.arange(3), sizes)
    good, moves = rng.normal(size=len(doc)), rng.normal(size=(2, 2))
    p, pairs, total = C.marginals(good, moves, C.Chains.of(doc, 3))
    log_z, want, want_pairs = 0.0, [], np.zeros((2, 2))
    for d, n in enumerate(sizes):
        own = good[doc == d]
        paths = list(itertools.product((0, 1), repeat=n))
        w = np.exp([sum(own[i] * y for i, y in enumerate(q)) + sum(moves[a, b] for a, b in itertools.pairwise(q)) for q in paths])
        log_z += np.log(w.sum())
        want += [sum(x for x, q in zip(w, paths, strict=True) if q[i]) / w.sum() for i in range(n)]
        for x, q in zip(w / w.sum(), paths, strict=True):
            for a, b in itertools.pairwise(q):
                want_pairs[a, b] += x
    assert np.allclose(p, want) and np.allclose(pairs, want_pairs) and np.isclose(total, log_z)


def test_held_out_accuracy(spark):
    rows = op8_line_crf(spark, SF1).collect()
    truth = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF1}/labels.parquet'").fetchall())
    held = [r for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    bad = [r for r in held if truth[r.doc_id] == 0]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert sum(r.predicted == 0 for r in bad) >= 0.85 * len(bad)


def test_features_are_of_lines_and_neighbours():
    lines = C.line_features([b"One line.\nSHOUT!! SHOUT!!\n\nOne line.", b"", b" \n "])
    assert lines.doc.tolist() == [0, 0, 0, 1, 2] and lines.weight.tolist() == [9, 15, 9, 1, 1]
    assert lines.features[2, 4] == 1 and lines.features[0, 4] == 0  # repeated line
    assert lines.features[0, C.N_OWN + C.N_TOLD + 2] == lines.features[1, 2] > 0  # the next line's shouting


def test_defined_cases(spark):
    frame = docs(spark, [*ODD, (None, "a b"), (3, "a b"), (3, "a b")])
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, 0), (4, 1), (5, None), (None, 1), (11, 0), (77, 1)], "doc_id bigint, quality int")
    for own in (labels, labels.where("quality = 1"), labels.limit(0)):
        rows = C.score(frame, C.train(frame, own)).collect()
        assert len(rows) == len(ODD) + 3 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows} == {0.5}
    assert C.score(docs(spark, []), C.train(docs(spark, []), labels)).count() == 0
