"""Sequences: permutation, exact round trip of the ids, resumable reads."""

import os

import numpy as np
import public_tokenizers
import pytest
from llm.support import ODD, docs, texts
from tokenizers import Tokenizer
from tvlens.llm import sequences as S

LIB = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
LIB.encode_special_tokens = True


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_feistel_is_a_keyed_permutation(n):
    a, b = S.feistel(np.arange(n), n, 1), S.feistel(np.arange(n), n, 2)
    assert sorted(a.tolist()) == list(range(n)) == sorted(b.tolist())
    if n > 60:
        assert (a != b).mean() > 0.9 and np.abs(np.corrcoef(a, np.arange(n))[0, 1]) < 0.3


def written(spark, rows, folder, **how):
    index = S.write_shards(docs(spark, rows).repartition(3).checkpoint(), str(folder), **how).collect()
    sequences = list(S.read_slots(str(folder), 0, 1 << 40))
    assert sorted(r.slot for r in index) == list(range(len(sequences)))
    out = []
    for part in sorted({r.part for r in index}):
        own = sorted((r for r in index if r.part == part), key=lambda r: r.seq)
        ids = np.concatenate([sequences[r.slot] for r in own])
        assert [len(sequences[r.slot]) for r in own] == [r.n_tokens for r in own]
        out += [x[x != S.END].tolist() for x in np.split(ids, np.flatnonzero(ids == S.END) + 1)[:-1]]
    return index, sequences, out


def test_round_trip_and_resume(spark, tmp_path):
    rows = [*texts()[:80], *[(1000 + i, t) for i, t in enumerate(ODD)], (None, "x"), (7, "x"), (7, "x")]
    index, sequences, out = written(spark, rows, tmp_path / "a", seq_len=64, shard_sequences=50)
    assert sorted(out) == sorted(LIB.encode(t or "", add_special_tokens=False).ids for _, t in rows)
    again = list(S.read_slots(str(tmp_path / "a"), 45, 70))
    assert all((x == y).all() for x, y in zip(again, sequences[45:115], strict=True))
    for r in index:
        assert r.shard == r.slot // 50 and r.offset == r.slot % 50 * 128
    names = sorted(os.listdir(tmp_path / "a"))
    assert len([n for n in names if n.startswith("shard")]) == -(-len(sequences) // 50) and all(n[-4:] in (".bin", "json") for n in names)
    other, _, _ = written(spark, rows, tmp_path / "b", seq_len=64, shard_sequences=50, key=5)
    assert {(r.part, r.seq): r.slot for r in other} != {(r.part, r.seq): r.slot for r in index}


def test_empty_table(spark, tmp_path):
    assert S.write_shards(docs(spark, []), str(tmp_path / "e")).collect() == []
    assert list(S.read_slots(str(tmp_path / "e"), 0, 5)) == []


def test_pieces_are_those_of_the_given_pattern():
    """Any white space beside a space, a word or the end."""
    import itertools

    import tiktoken

    own = S.encoder(S.TOKENIZER)
    given = tiktoken.Encoding("given", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own._mergeable_ranks, special_tokens={})
    odd = [" ", "\n", "\t", "\x1c", "\x85", "\u00a0", "\u3000", "\u200b", "a", "'s", "'S", "7", ".", "漢", "é", "<|endoftext|>"]
    rows = [str(t or "") for t in ODD] + ["".join(x) for x in itertools.product(odd, repeat=4)]
    ids, size = S.tokenize(rows, S.TOKENIZER)
    want = [given.encode_ordinary(t) for t in rows]
    assert size.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_no_python_worker_beside_the_packing_one(spark, tmp_path):
    plan = S.write_shards(docs(spark, [(1, "a b")]), str(tmp_path / "p"))._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan and "Broadcast" not in plan
