"""SimHash fingerprints and components against brute force."""

import random
import re

import pytest
import xxhash
from llm.support import ODD, docs, texts
from tvlens.llm import simhash
from tvlens.llm.components import connected_components
from tvlens.llm.queries import op7_simhash_dedup


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def components(ids, fps, radius=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i] = root[root[i]]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: least[find(i)] for i, d in enumerate(ids)}


def test_masks_cover_every_pair():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        rng = random.Random(radius)
        for _ in range(3000):
            diff = sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius)))
            assert any(diff & m == 0 for m in masks)


def test_query_equals_brute_force(spark):
    rows = op7_simhash_dedup(spark, "/root/testdata/sf0.01").collect()
    data = texts("/root/testdata/sf0.01")
    fps = [plain_fingerprint(t) for _, t in data]
    want = components([d for d, _ in data], fps)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        d: (f"{f:016x}", want[d]) for (d, _), f in zip(data, fps, strict=True)
    }
    assert len(rows) == len(data)


@pytest.mark.parametrize("radius", [1, 2])
def test_links_find_all_planted_neighbours(spark, radius):
    rng = random.Random(5)
    fps = set()
    for _ in range(8):
        seed = rng.getrandbits(64)
        fps.add(seed)
        for _ in range(8):
            seed ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius + 1)))
            fps.add(seed)
    fps = sorted(fps)
    signed = [(simhash._signed(f),) for f in fps]
    got = connected_components(simhash.links(spark.createDataFrame(signed, "fp bigint"), radius)).collect()
    roots = {r.node: r.root for r in got}
    want = components([s[0] for s in signed], fps, radius)
    assert {s[0]: roots.get(s[0], s[0]) for s in signed} == want
    with pytest.raises(ValueError, match="radius"):
        simhash.links(spark.createDataFrame(signed, "fp bigint"), 3)


def test_defined_cases(spark):
    rows = simhash.near_duplicates(docs(spark, [*ODD, (None, "same text here, repeated"), (None, "alone in the world")])).collect()
    assert len(rows) == len(ODD) + 2
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by_id[i].component_id for i in (0, 1, 2, 3)} == {0} and by_id[0].fp == 0
    assert by_id[12].component_id == 11
    assert sorted(r.component_id is None for r in rows if r.doc_id is None) == [False, True]
    for i, t in enumerate(ODD):
        assert simhash.fingerprint((t or "").encode()) == plain_fingerprint(t)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert connected_components(spark.createDataFrame([(i, i + 1) for i in range(12)], "a int, b int")).where("root = 0").count() == 12
