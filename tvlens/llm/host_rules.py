"""Quality rules judged by document and by host.

Every document gets rule figures (words, symbols, repeated lines and word
windows).  Rule failures are summed by host, each host's failure rate is
shrunk towards the rate of all hosts with an empirical beta prior (moments of
the hosts' rates), and a host whose shrunken rate of some rule is above
``host_limit`` is rejected; the verdict is joined back to its documents.  So a
host with two documents, both bad, stays near the common rate, and a host with
thousands of bad ones does not.

Built-in functions only.  The documents' figures are narrow and are
checkpointed once; sums by host are combined map-side, and the join back is by
host with adaptive skew splitting, or a broadcast where the verdicts measured
small.

Repeated word windows are found by sorting the 64-bit hashes of a document's
three-word windows with their positions, within the row.

Defined cases: NULL and empty texts have no words and fail; a NULL host has no
verdict (its documents are judged alone); NULL or repeated ids and repeated
rows give one result row each; an empty table gives an empty result; other
input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvlens.llm.common import cut_lineage, words

WINDOW = 3
HOST_LIMIT = 0.5
#: Weight of the prior in documents: at least one, at most this many.
MAX_STRENGTH = 1000.0


def _window_hashes(w: Column) -> Column:
    """Hashes of the WINDOW-word windows of the array ``w``, in order."""
    hashed = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    return F.when(F.size(w) >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>"))


def _repeated_at(sorted_windows: Column) -> Column:
    """Positions, in order, of the windows that have an equal neighbour."""
    s = sorted_windows
    twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
    return F.sort_array(F.transform(twice, lambda x: x["p"]))


def figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text.alias("text"), lines.alias("lines"), words(text).alias("w"))
    with_windows = own.select(
        "doc_id",
        "host",
        F.size("w").cast("bigint").alias("n_words"),
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _window_hashes(F.col("w")).alias("win"),
    )
    # Documents without any repeated window need no sort.
    repeats = F.size(F.array_distinct("win")) < F.size("win")
    placed = F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    sorted_ = with_windows.withColumn("win", F.when(repeats, F.sort_array(placed)))
    found = sorted_.withColumn("at", _repeated_at(F.col("win"))).drop("win")
    new_words = F.transform("at", lambda p, i: F.least(F.lit(WINDOW), p - F.coalesce(F.get("at", i - 1), F.lit(-WINDOW))))
    total = F.aggregate(new_words, F.lit(0), lambda a, x: a + x)
    return found.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("bigint")).drop("at")


def rule_failures() -> dict[str, Column]:
    """Name and condition of each rule over the figures."""
    n = F.col("n_words")
    return {
        "base": (n < 50) | (100 * F.col("n_repeat_words") > 50 * n),
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": F.col("n_dup_lines") * 20 > n,
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
    }


def host_verdicts(judged: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """(host, docs, rate_<rule>..., host_ok) from rows with host and boolean fail_<rule>."""
    rules = list(rule_failures())
    hosts = (
        judged.where("host IS NOT NULL")
        .groupBy("host")
        .agg(F.count("*").alias("docs"), *[F.sum(F.col(f"fail_{r}").cast("int")).alias(r) for r in rules])
    )
    # Moments over hosts: n, sums of k, and of k^2 / n.
    moments = hosts.agg(
        F.struct(
            F.sum("docs").cast("double").alias("n"),
            *[F.sum(r).cast("double").alias(r) for r in rules],
            *[F.sum(F.col(r).cast("double") * F.col(r) / F.col("docs")).alias(f"{r}_2") for r in rules],
        ).alias("m")
    ).scalar()
    rated = hosts.withColumn("m", moments)
    for r in rules:
        mean = F.col(f"m.{r}") / F.col("m.n")
        spread = F.col(f"m.{r}_2") / F.col("m.n") - mean * mean  # of the rates, weighted by documents
        strength = F.when(
            spread * (MAX_STRENGTH + 1) > mean * (1 - mean), F.greatest(mean * (1 - mean) / spread - 1, F.lit(1.0))
        ).otherwise(MAX_STRENGTH)
        rated = rated.withColumn(f"rate_{r}", (F.col(r) + strength * mean) / (F.col("docs") + strength))
    ok = F.greatest(*[F.col(f"rate_{r}") for r in rules]) <= host_limit
    return rated.select("host", "docs", *[f"rate_{r}" for r in rules], ok.alias("host_ok"))


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    host_limit: float = HOST_LIMIT,
) -> DataFrame:
    """The figures of every row with base_failed, host_ok and kept."""
    rows = cut_lineage(figures(docs, id_col, text_col, host_col))
    judged = rows.select("*", *[c.alias(f"fail_{r}") for r, c in rule_failures().items()])
    verdicts = host_verdicts(judged, host_limit).select(F.col("host").alias("of_host"), "host_ok")
    return (
        judged.join(verdicts, judged["host"] == verdicts["of_host"], "left")
        .withColumn("host_ok", F.coalesce("host_ok", F.lit(True)))
        .select(*rows.columns, F.col("fail_base").alias("base_failed"), "host_ok", (~F.col("fail_base") & F.col("host_ok")).alias("kept"))
    )
