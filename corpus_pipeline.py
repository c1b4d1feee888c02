"""The corpus pipeline: five stages, each calling one operator of tvlens.llm.

Every stage is a function of (spark, docs, sf_dir) and is judged on its own
input; its output is written as Parquet and reread as the next stage's docs.
All stages but the last return the columns of their input.

1. language: documents without a language go: no letters, a text with most
   letters in scripts of no learned language, or one whose letters are, over
   all its spans, doubtful.  Certain texts in several languages stay; so does
   an unlearned language in a learned script, which looks like the closest.
2. near_duplicates: one document of each SimHash group stays, the one with
   the smallest id (of repeated rows of that id: the one with the smallest
   hash of its text, once).
3. decontaminate: documents with a verified benchmark overlap go.
4. mix: every document is kept as often as the mix takes it (0 to 3 times).
5. sequences: the rest is tokenized, packed, permuted and written as shards;
   the index of the sequences is the result.

Defined cases: stages keep NULLs in other columns as they are.  A NULL or
repeated doc_id is told apart by the hash of the text, so no row is judged by
another row's text.  Empty tables pass through.  Extra columns are kept by
stages 1 to 4, whatever their names (work columns start with ``_llm_``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tvlens.llm import decontam, langid, mixing, sequences, simhash
from tvlens.llm.common import cut_lineage, read_table
from tvlens.session import ensure_checkpoint_dir

#: Documents whose letters have a smaller mean posterior, in whatever learned
#: languages they are (0 in a script of none), are taken for no language.
MIN_LANGUAGE_SCORE = 0.3
#: Rejected rows are broadcast when they were counted to be this few.
BROADCAST_ROWS = 500_000


def _keyed(text_hash: str | None = None) -> list[Column]:
    """Key of a row: its id and the hash of its text (NULL id: the smallest bigint)."""
    hash_ = F.col(text_hash) if text_hash else F.xxhash64("text")
    return [
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("_llm_id"),
        F.coalesce(hash_, F.lit(0)).alias("_llm_hash"),
    ]


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is not in ``bad`` (_llm_id, _llm_hash).  The
    rejected keys are counted: few are broadcast, many join by shuffle."""
    bad = cut_lineage(bad.distinct())
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad
    keyed = docs.select(*_columns(docs), *_keyed())
    return keyed.join(bad, ["_llm_id", "_llm_hash"], "left_anti").drop("_llm_id", "_llm_hash")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language."""
    model = langid.train(docs, "text", "lang")
    found = langid.identify(docs, model, "doc_id", "text", F.xxhash64("text").alias("text_hash"))
    total = lambda spans, part: F.aggregate(spans, F.lit(0.0), lambda a, s: a + s[part])
    letters, sure = total("spans", "letters"), total("spans", "sure")
    foreign = total(F.filter("spans", lambda s: s["lang"] == langid.UNKNOWN), "letters")
    none = (letters == 0) | (foreign > letters / 2) | (sure < MIN_LANGUAGE_SCORE * letters)
    return _without(docs, found.where(none).select(*_keyed("text_hash")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within 2 bits over 3-word shingles."""
    found = simhash.near_duplicates(docs, keep=tuple(_keyed()))
    null_last = F.struct(F.col("doc_id").isNull(), "_llm_id", "_llm_hash")
    chosen = found.groupBy("root").agg(F.min(null_last).alias("m")).select("m._llm_id", "m._llm_hash")
    # Rows equal in id and text count once; they are dropped before the shuffle too.
    keyed = docs.select(*_columns(docs), *_keyed())
    same = Window.partitionBy("_llm_id", "_llm_hash").orderBy("_llm_hash")
    once = keyed.withColumn("_llm_n", F.row_number().over(same)).where("_llm_n = 1")
    return once.join(chosen, ["_llm_id", "_llm_hash"], "left_semi").drop("_llm_id", "_llm_hash", "_llm_n")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = decontam.contaminated(docs, read_table(spark, sf_dir, "benchmark"))
    return _without(docs, found.select(*_keyed("text_hash")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, repeated as often as the mix of the sources takes them."""
    return mixing.take(docs)


def write_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Index of the training sequences; the shards are in the shared folder."""
    return sequences.write_shards(docs, sequences.new_folder(spark)).drop("path")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("sequences", write_sequences),
]

#: Hash-based stages and training have no SQL; tests/llm/test_pipeline.py
#: checks the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
