"""The opN_ queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tvlens.llm import (
    decontam,
    filter_audit,
    hard_negatives,
    host_rules,
    langid,
    line_crf,
    mixing,
    pii,
    sequences,
    simhash,
    suffix_dedup,
    token_counts,
    word_contexts,
)
from tvlens.llm.common import crc_fold, read_table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(pii.find_pii(read_table(spark, sf_dir, "documents")))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = crc_fold(F.col("doc_id"), 3) == 1
    model = langid.train(docs.where(~held_out), "text", "lang")
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(read_table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(read_table(spark, sf_dir, "documents")).drop("host", "host_ok")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(mixing.mix(read_table(spark, sf_dir, "documents")))


def op6_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = sequences.write_shards(read_table(spark, sf_dir, "documents"), sequences.new_folder(spark))
    return index.drop("path")


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op8_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = crc_fold(F.col("doc_id"), 4) == 2
    model = line_crf.train(docs, labels, ~held_out)
    scored = line_crf.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read_table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = filter_audit.mark(read_table(spark, sf_dir, "documents"))
    return filter_audit.audit(filter_audit.failure_classes(marked, read_table(spark, sf_dir, "labels")))


def op13_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_contexts.score(read_table(spark, sf_dir, "documents"), crc_fold(F.col("doc_id"), 5) == 1)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_language": op2_language,
    "op3_token_counts": op3_token_counts,
    "op4_host_rules": op4_host_rules,
    "op5_mix_sources": op5_mix_sources,
    "op6_sequences": op6_sequences,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_line_crf": op8_line_crf,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_filter_audit": op12_filter_audit,
    "op13_pitman_yor": op13_pitman_yor,
}
