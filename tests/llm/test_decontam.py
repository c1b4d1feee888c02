"""Decontamination against a brute-force aligner, and tolerance of substitutions."""

import random
import re

import duckdb
from llm.support import ODD, docs, texts
from tvlens.llm import decontam as D
from tvlens.llm.queries import op10_decontamination

SF01 = "/root/testdata/sf0.01"


def toks(t):
    return [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]


def brute(rows, items):
    """(doc, item) with a verified overlap, by trying every alignment."""
    out = set()
    for item, text in items:
        b = toks(text)
        for doc, body in rows:
            d = toks(body)
            if any(hit(d, b, i, j) for j in range(len(b) - 7) for i in starts(d, b, j)):
                out.add((doc, item))
    return out


def starts(d, b, j):
    for i in range(len(d) - 7):
        if any(all(m == "0" or d[i + k] == b[j + k] for k, m in enumerate(mask)) for mask in D.MASKS):
            yield i


def hit(d, b, i, j):
    left = min(i, j, D.REACH)
    right = min(len(d) - i, len(b) - j, D.SPAN + D.REACH)
    n = left + right
    same = sum(d[i - left + k] == b[j - left + k] for k in range(n))
    return n >= min(len(b), D.MIN_OVERLAP) and same >= D.SIMILARITY * n


def test_query_equals_brute_force(spark):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF01}/benchmark.parquet'").fetchall()
    grams = {tuple(toks(t)[i : i + 3]) for _, t in items for i in range(len(toks(t)) - 2)}
    rows = [(d, t) for d, t in texts(SF01) if any(tuple(w) in grams for w in zip(*(toks(t)[k:] for k in range(3)), strict=False))]
    got = {(r.doc_id, r.item_id) for r in op10_decontamination(spark, SF01).collect()}
    assert got == brute(rows, items) and len(got) > 10


def test_substitutions_are_tolerated_and_clean_texts_left_alone(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    item = [word() for _ in range(30)]
    changed = [word() if i % 7 == 3 else w for i, w in enumerate(item)]
    far = [word() if i % 2 else w for i, w in enumerate(item)]
    wrap = lambda ws: " ".join([*[word() for _ in range(40)], *ws, *[word() for _ in range(40)]])
    cases = [wrap(item), wrap(changed), wrap(far), wrap([]), " ".join(item).upper() + "!", wrap(item[:9]), wrap(item[5:26])]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "too short to be evidence"), (1, " ".join(item))], "item_id int, text string")
    got = {r.doc_id for r in D.overlaps(docs(spark, cases), bench).collect()}
    assert got == {0, 1, 4, 6}


def test_defined_cases(spark):
    text = " ".join(f"tok{i}" for i in range(20))
    bench = spark.createDataFrame([(None, text)], "item_id int, text string")
    rows = D.overlaps(docs(spark, [*ODD, (None, text), (3, text), (3, text)]), bench).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["3", "None"] and {r.item_id for r in rows} == {None}
    assert D.overlaps(docs(spark, []), bench).count() == 0
    assert D.overlaps(docs(spark, [text]), bench.limit(0)).count() == 0


def test_exact_passages_from_the_least_overlap_on(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    item = [word() for _ in range(40)]
    wrap = lambda ws: " ".join([*[word() for _ in range(30)], *ws, *[word() for _ in range(30)]])
    sizes = [8, 9, 10, 13, 14, 15, 16, 20, 25]
    cases = [wrap(item[k : k + n]) for n in sizes for k in (0, 9, 40 - n)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id int, text string")
    got = {r.doc_id: r for r in D.overlaps(docs(spark, cases), bench).collect()}
    assert set(got) == {3 * i + k for i, n in enumerate(sizes) if n >= D.MIN_OVERLAP for k in range(3)}
    assert all(D.MIN_OVERLAP <= r.aligned and r.matched >= D.SIMILARITY * r.aligned for r in got.values())


def test_short_items_match_where_they_are_held_whole(spark):
    bench = spark.createDataFrame([(1, "Why is it so?"), (2, "quux"), (3, "seven tokens are still less than eight"), (4, "?")], "item_id int, text string")
    cases = ["he asked: why IS it, so often", "why is that so", "a quux, quux", "quuxes", "Seven tokens are still less than eight", "still less than eight", None, ""]
    rows = D.overlaps(docs(spark, cases), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.matched, r.aligned) for r in rows) == [(0, 1, 4, 4), (2, 2, 1, 1), (4, 3, 7, 7)]


def test_every_item_of_a_shared_passage_is_reported(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    own, template = [[word() for _ in range(30)] for _ in range(2)], [word() for _ in range(24)]
    whole = " ".join(own[0])
    items = [(7, whole), (3, whole), (9, " ".join(template + own[1])), (4, " ".join(own[1][::-1] + template)), (5, "short item"), (6, "Short item!")]
    bench = spark.createDataFrame([*items, (7, whole)], "item_id int, text string")
    cases = [" ".join([word() for _ in range(30)] + ws) for ws in (own[0], template, own[1], ["short", "item"], [])]
    frame = docs(spark, cases)
    got = sorted((r.doc_id, r.item_id) for r in D.overlaps(frame, bench).collect())
    assert got == [(0, 3), (0, 7), (1, 4), (1, 9), (2, 9), (3, 5), (3, 6)]
    assert sorted(r.doc_id for r in D.contaminated(frame, bench).collect()) == [0, 1, 2, 3]
