"""Filter interaction audit by Hart-Mas-Colell potentials.

Five filters are a game: a coalition S of filters removes the documents that
fail at least one of its members, v(S).  The potential of the game is

    P({}) = 0,   P(S) = (v(S) + sum of P(S without i) over i in S) / |S|

and the Shapley value of filter i is P(all) - P(all without i).  What a filter
removes at a step of an order is a difference of two coalitions, v(S with i) -
v(S); so the 120 orders need no pass over documents, only the 32 coalitions.

1. One pass over the texts gives each row its failed filters A to D as bits
   and the SHA-256 of its text; texts go no further.
2. Rows are collapsed to (id, part, bits, digest), labels are joined by id.
   Filter E needs the smallest id of each digest: rows of equal text, part and
   label are counted first (map-side too), so a text that a third of all
   documents share is one row for each part when its smallest id is looked up.
3. Counts by (part, bits, labels), at most 128 a part, become the coalitions.

Filters (words are runs of other than the six ASCII white-space characters):
A under 50 words; B under 65 distinct words of 100; C over 5 capitals A-Z of
100 code points; D any of ``#$%&*|``; E text equal to one of a smaller id.

Defined cases: NULL text is an empty text, NULL part is ''; a row with NULL id
has no labels, never fails E and makes no other row fail it; rows that repeat
an id count each (equal texts of one id do not fail E among themselves); a
document is good (toxic) if any of its label rows says 1; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tvlens.llm.common import text_slices
from tvlens.operators.joins import null_spread_join

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 50, 65, 5, b"#$%&*|"
#: A longer text is split into words a piece at a time.
PIECE_BYTES = 4 << 20

MARK_SCHEMA = "doc_id bigint, part string, bits int, digest binary"
COALITION_SCHEMA = "part string, coalition string, removed bigint, good_removed bigint, toxic_removed bigint, potential bigint"
AUDIT_SCHEMA = (
    "part string, filter_order string, step int, filter string, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUATION = bytes(range(0x80, 0xC0))
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def count_words(text: bytes) -> tuple[int, int]:
    """Words and distinct words of a text."""
    if len(text) <= PIECE_BYTES:
        words = text.split()
        return len(words), len(set(words))
    n, seen, at = 0, set(), 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE_BYTES)
        end = gap.start() if gap else len(text)
        words = text[at:end].split()
        n, at = n + len(words), end
        seen.update(words)
    return n, len(seen)


def failed(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    n, distinct = count_words(text)
    points = len(text) - (0 if text.isascii() else len(text) - len(text.translate(None, _CONTINUATION)))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    symbols = any(s in text for s in SYMBOLS)
    fails = (n < MIN_WORDS, 100 * distinct < DISTINCT_PERCENT * n, 100 * capitals > CAPITAL_PERCENT * points, symbols)
    return sum(bad << i for i, bad in enumerate(fails))


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, bits, digest) of every row."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text", 4096, 16 << 20):
            texts = b.column("text").to_pylist()
            bits = pa.array([failed(t) for t in texts], pa.int32())
            digest = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), bits, digest], ["doc_id", "part", "bits", "digest"]
            )

    only = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    return only.mapInArrow(marks, MARK_SCHEMA)


def failure_classes(marked: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows by (part, bits of A to D, good, toxic): ``n`` without and ``n_copies`` with failed E."""
    rows = marked.groupBy("doc_id", "part", "bits", "digest").agg(F.count(F.lit(1)).alias("n"))
    said = (
        labels.select(F.col(id_col).cast("bigint").alias("doc_id"), "quality", "toxic")
        .groupBy("doc_id")
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    no = F.lit(False)
    told = null_spread_join(rows, said, "doc_id").select(
        *rows.columns, F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")
    )
    # Rows of one text: how many, the smallest id and how many rows have it.
    texts = told.groupBy("digest", "part", "bits", "good", "toxic").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min("doc_id").alias("first"),
        F.coalesce(F.min_by("n", "doc_id"), F.lit(0)).alias("first_rows"),
    )
    least = F.min("first").over(Window.partitionBy("digest"))
    originals = F.col("nameless") + F.when(F.col("first") == F.col("least"), F.col("first_rows")).otherwise(0)
    return (
        texts.withColumn("least", least)
        .withColumn("originals", originals)
        .groupBy("part", "bits", "good", "toxic")
        .agg(F.sum("originals").alias("n"), F.sum(F.col("rows") - F.col("originals")).alias("n_copies"))
    )


def class_counts(entries: list[dict]) -> np.ndarray:
    """Documents by failed filters (all 32 sets): all, good and toxic ones."""
    counts = np.zeros((3, ALL + 1), np.int64)
    for e in entries:
        for bits, n in ((e["bits"], e["n"]), (e["bits"] | 1 << 4, e["n_copies"])):
            counts[0, bits] += n
            counts[1, bits] += n * e["good"]
            counts[2, bits] += n * e["toxic"]
    return counts


def removed_by(counts: np.ndarray) -> np.ndarray:
    """v(S): documents that fail a filter of S, for every coalition S."""
    sets = np.arange(counts.shape[-1])
    return counts @ ((sets[:, None] & sets[None, :]) != 0).astype(np.int64)


def potentials(v: list[int]) -> list[int]:
    """120 times the potential of every coalition: exact integers, as the
    potential of a coalition has a denominator that divides |S|!."""
    out = [0] * len(v)
    for s in range(1, len(v)):
        members = [1 << i for i in range(s.bit_length()) if s >> i & 1]
        out[s] = (120 * v[s] + sum(out[s ^ i] for i in members)) // len(members)
    return out


def _orders() -> tuple[list[str], np.ndarray, np.ndarray]:
    """The 120 orders, and by order and step the filter and the coalition before it."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    which = np.array([[FILTERS.index(f) for f in o] for o in orders])
    return orders, which, np.cumsum(1 << which, axis=1) - (1 << which)


def _games(classes: DataFrame) -> DataFrame:
    """One row for each part with its at most 64 classes."""
    return classes.groupBy("part").agg(F.collect_list(F.struct("bits", "good", "toxic", "n", "n_copies")).alias("classes"))


def audit(classes: DataFrame) -> DataFrame:
    """Every step of every order in every part, from :func:`failure_classes`."""
    orders, which, before = _orders()
    names = pa.array(np.repeat(orders, len(FILTERS)).tolist(), pa.string())
    which, before = which.ravel(), before.ravel()
    after = before | 1 << which
    steps = pa.array(np.tile(np.arange(1, len(FILTERS) + 1), len(orders)), pa.int32())
    letters = pa.array([FILTERS[i] for i in which], pa.string())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for game in b.to_pylist():
                counts = class_counts(game["classes"])
                v, good, toxic = removed_by(counts)
                removed, alone = v[after] - v[before], 1 << which
                p = np.array(potentials(v.tolist()))
                columns = [
                    pa.array([game["part"]] * len(which), pa.string()),
                    names,
                    steps,
                    letters,
                    counts[0].sum() - v[after],
                    removed,
                    v[alone] - removed,
                    v[ALL] - v[ALL ^ alone],
                    good[after] - good[before],
                    toxic[after] - toxic[before],
                    p[ALL] - p[ALL ^ alone],
                ]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns],
                    [c.split()[0] for c in AUDIT_SCHEMA.split(", ")],
                )

    return _games(classes).mapInArrow(rows, AUDIT_SCHEMA)


def coalitions(classes: DataFrame) -> DataFrame:
    """The game itself: what every coalition removes, and 120 times its potential."""
    letters = ["".join(f for i, f in enumerate(FILTERS) if s >> i & 1) for s in range(ALL + 1)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for game in b.to_pylist():
                v = removed_by(class_counts(game["classes"]))
                columns = [[game["part"]] * len(letters), letters, *v.tolist(), potentials(v[0].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], [c.split()[0] for c in COALITION_SCHEMA.split(", ")]
                )

    return _games(classes).mapInArrow(rows, COALITION_SCHEMA)
