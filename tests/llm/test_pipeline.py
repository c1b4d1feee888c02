"""The pipeline's stages against brute force, each on its own input."""

import corpus_pipeline as P
import __spark_entry__ as entry
from llm.support import ODD, docs, texts
from llm.test_decontam import toks
from llm.test_simhash import components, plain_fingerprint
from tvlens.llm import decontam, mixing

SF01 = "/root/testdata/sf0.01"


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert [n for n, _ in P.STAGES] == ["language", "near_duplicates", "decontaminate", "mix", "sequences"]


def test_stages(spark, tmp_path):
    frame = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = texts(SF01)
    spoken = P.language(spark, frame, SF01)
    assert spoken.columns == frame.columns and spoken.count() == frame.count()  # all clean: all stay
    kept = P.near_duplicates(spark, frame, SF01)
    want = set(components([d for d, _ in rows], [plain_fingerprint(t) for _, t in rows]).values())
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(want)
    clean = P.decontaminate(spark, frame, SF01)
    bad = {r.doc_id for r in decontam.overlaps(frame, spark.read.parquet(f"{SF01}/benchmark.parquet")).collect()}
    left = {r.doc_id for r in clean.select("doc_id").collect()}
    assert clean.columns == frame.columns and left == {d for d, _ in rows} - bad and clean.count() == len(left)
    times = {r.doc_id: r.times for r in mixing.mix(frame).collect()}
    taken = P.mix(spark, frame, SF01).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in taken} == {d: n for d, n in times.items() if n}
    assert toks("A b") == ["a", "b"]


def test_run_reads_back_all_sequences(spark):
    index = P.run(spark, "/root/testdata/sf0.001").collect()
    assert index and sorted(r.slot for r in index) == list(range(len(index)))


def test_defined_cases(spark):
    frame = docs(spark, [*ODD, (None, "same text here, repeated"), (7, None), (7, None), (7, "x"), (7, "x")])
    assert P.language(spark, frame, SF01).columns == frame.columns
    kept = P.near_duplicates(spark, frame, SF01)
    assert kept.columns == frame.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert left.count((7, "x")) == 1 and (0, None) in left and (11, ODD[11]) in left and (12, ODD[12]) not in left
    assert P.decontaminate(spark, frame, SF01).count() == frame.count()
    assert P.mix(spark, frame, SF01).columns == frame.columns
    empty = docs(spark, [])
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF01).count() == 0


def test_language_rejects_foreign_scripts_and_keeps_certain_mixtures(spark):
    own = {g: [t for t, x in texts(SF01, "text, lang") if x == g and len(t) > 400] for g in ("en", "de", "fr", "es")}
    rows = [(i, t, g) for i, (t, g) in enumerate((t, g) for g, ts in own.items() for t in ts[:40])]
    part = lambda g: own[g][0][:300].rsplit(" ", 1)[0]
    odd = {
        1001: "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему",
        1002: "人人生而自由 在尊严和权利上一律平等 他们赋有理性和良心",
        1003: "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια",
        1004: part("en")[:60] + " Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему",
        1005: " ".join(part(g) for g in own),
        1006: part("en") + " и " + part("de"),
    }
    frame = spark.createDataFrame([*rows, *((i, t, None) for i, t in odd.items())], "doc_id bigint, text string, lang string")
    left = {r.doc_id for r in P.language(spark, frame, SF01).collect()}
    assert left == {i for i, _, _ in rows} | {1005, 1006}
