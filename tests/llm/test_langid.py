"""Language identification: held-out accuracy, spans, Viterbi."""

import itertools

import numpy as np
from llm.support import ODD, docs, texts
from tvlens.llm import langid
from tvlens.llm.queries import op2_language

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {d: lang for d, lang in texts(SF01, "doc_id, lang")}
    rows = op2_language(spark, SF01).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert 0.25 < len(held) / len(rows) < 0.42
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(4)
    sizes = [1, 4, 0, 6, 2]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    scores = (rng.normal(size=(len(doc), 3)) * 12).astype(np.float32)
    got = langid.viterbi(scores, doc, len(sizes))
    for d, n in enumerate(sizes):
        own = scores[doc == d]
        value = lambda path: sum(own[i, k] for i, k in enumerate(path)) - langid.SWITCH_PENALTY * sum(a != b for a, b in itertools.pairwise(path))
        best = max((value(p) for p in itertools.product(range(3), repeat=n)), default=0)
        assert abs(value(got[doc == d].tolist()) - best) < 1e-3


def test_spans_of_mixed_text_and_scripts(spark):
    rows = texts(SF01, "text, lang")
    by_text = spark.createDataFrame([*rows, ("привет мир как дела", "ru"), (None, "en"), ("x y", None)], "text string, lang string")
    model = langid.train(by_text, "text", "lang")
    assert model.languages == ["de", "en", "es", "fr", "ru"]
    english = next(t for t, g in rows if g == "en" and len(t) > 400)[:300]
    german = next(t for t, g in rows if g == "de" and len(t) > 900)[:800]
    langs, scores, spans = langid.label_slice([english + " " + german, "мир дом", "1234 --", ""], model)
    assert langs == ["de", "ru", "und", "und"] and scores[2:] == [0, 0] and spans[2:] == [[], []]
    assert [s["lang"] for s in spans[0]] == ["en", "de"] and abs(spans[0][1]["start"] - len(english)) < 40


def test_defined_cases(spark):
    frame = docs(spark, [*ODD, (None, "the and of with"), (3, "the and"), (3, "the and")])
    model = langid.train(frame, "text", "lang")
    rows = langid.identify(frame, model).collect()
    assert len(rows) == len(ODD) + 3
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (0, 1, 2)} == {("und", 0.0)}
    empty = langid.train(docs(spark, []), "text", "lang")
    assert {r.lang_pred for r in langid.identify(frame, empty).collect()} == {"und"}
    assert langid.identify(docs(spark, []), model).count() == 0


def test_script_narrows_also_for_long_words():
    """A word whose script one language admits gets that language, whatever the n-grams say."""
    rng = np.random.default_rng(2)
    scores = np.stack((rng.normal(-2, 1, langid.BUCKETS), rng.normal(-9, 1, langid.BUCKETS)), axis=1).astype(np.float32)
    allowed = np.ones((langid.N_SCRIPTS, 2), bool)
    allowed[1, 0] = False  # Latin: only bb
    model = langid.Model(["aa", "bb"], scores, allowed)
    for word in ("ab", "abcdefghijklmnopqrstuvwx", "z" * 3000):
        langs, score, spans = langid.label_slice([word, f"{word} мир мир {word}"], model)
        assert langs[0] == "bb" and score[0] > 0.99
        assert [s["lang"] for s in spans[1]] == ["bb", "aa", "bb"]
