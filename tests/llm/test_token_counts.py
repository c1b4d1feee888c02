"""Token counts against the tokenizer library on whole texts."""

import public_tokenizers
from llm.support import ODD, docs, texts
from tokenizers import Tokenizer
from tvlens.llm import token_counts
from tvlens.llm.queries import op3_token_counts

LIB = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expect(text):
    return len(LIB.encode(text or "", add_special_tokens=False))


def test_query_equals_the_library(spark):
    rows = {r.doc_id: r for r in op3_token_counts(spark, "/root/testdata/sf0.01").collect()}
    for doc_id, text in texts("/root/testdata/sf0.01"):
        r = rows.pop(doc_id)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), expect(text), expect(text) > 1024)
    assert not rows


def test_odd_texts(spark):
    cases = ODD + [a + b for a in (" ", "x", "  ", "\n", " \n", "'s", "<|endoftext|>", "1") for b in ("y z", " y", "\n y", " ", "\t x ")]
    got = token_counts.count_tokens(docs(spark, cases)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == [
        (i, len((t or "").encode()), expect(t)) for i, t in enumerate(cases)
    ]


def test_rows_stay_rows_and_hot_units(spark):
    many = [(None, "a b"), (7, "a b"), (7, "a b")] + [(i, f"zzqx zzqx qzzx{i % 5} only{i}") for i in range(200)]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in token_counts.count_tokens(docs(spark, many)).collect())
    assert got == sorted((i is None, i or 0, expect(t)) for i, t in many)
    assert token_counts.count_tokens(docs(spark, [])).count() == 0
