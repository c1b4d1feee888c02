"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: A-Z lower-cased, words, ``shingle_words``-word shingles with
repeats (fewer words: the whole sequence); bit b is set when it is set in over
half of the shingles' XXH64 values (seed 42).  No words: fingerprint zero.

Candidates: bit i of the fingerprint gets a non-zero vector f(i) of
``radius + 1`` bits, and every non-zero vector v of that length makes a table
whose mask holds the bits with odd f(i).v.  Up to ``radius`` differing bits
span less than the whole space, so some v is orthogonal to all of them: in its
table the two fingerprints have the same masked value.  No pair within the
radius is missed.

Verification without pairs: within one bucket all fingerprints agree on the
mask.  Two of them are at distance d <= 2 exactly when flipping at most one
unmasked bit in each gives a common value, so every fingerprint of a bucket
with company lists these few values, equal values meet, and each links to the
smallest fingerprint there; its distance is checked again.  At most
1 + 64 fingerprints can meet at a value, whatever the bucket holds.  (Radius
1: one side, the centre, flips nothing.)

Exact copies of a fingerprint are collapsed before the search.  Components of
the links give ``component_id``, the smallest id reachable.

Defined cases: NULL text counts as empty; rows with the same id are separate
rows; a NULL id gets a component id like any other, the smallest non-NULL id
of its component (NULL if there is none); an empty table gives an empty
result; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvlens.llm.common import cut_lineage, text_slices
from tvlens.llm.components import connected_components

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
_CHUNK = 1 << 18  # shingle hashes held at a time

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = bytes(32 if 9 <= b <= 13 else b for b in range(256))
_FOLD = bytes(_SPACE[b] for b in _LOWER)


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a UTF-8 text."""
    words = text.translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle_words + 1)
    starts, ends = starts[:n], ends[-n:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        cut = zip(starts[i : i + _CHUNK].tolist(), ends[i : i + _CHUNK].tolist(), strict=True)
        h = np.array([digest(joined[s:e], SEED) for s, e in cut], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, keep: tuple[Column, ...] = ()
) -> DataFrame:
    """(doc_id, <keep>, fp): fp is the fingerprint as a signed 64-bit number."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text", 8192, 8 << 20):
            fps = [fingerprint(t, shingle_words) for t in b.column("text").to_pylist()]
            names = [n for n in b.schema.names if n != "text"]
            signed = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], signed], [*names, "fp"])

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    only = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), *keep, text)
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in only.schema.fields if f.name != "text")
    return only.mapInArrow(scan, f"{out}, fp bigint")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """One mask for each non-zero v; bit i carries the vector 1 + i mod (2^(radius+1) - 1)."""
    vectors = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(64) if ((1 + i % vectors) & v).bit_count() % 2) for v in range(1, vectors + 1)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(distinct_fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` such that the
    components of the links are those of all pairs within the radius."""
    if not 0 <= radius <= 2:
        raise ValueError("radius: 0 to 2 bits; beyond that the flips of a fingerprint become too many")
    masks = covering_masks(radius)
    tables = F.explode(
        F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)])
    )
    keyed = distinct_fps.select("fp", tables.alias("k")).select("fp", "k.t", "k.key")
    busy = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1").select("t", "key")
    # A hot bucket is one row in ``busy``; adaptive execution splits its rows in ``keyed``.
    meeting = keyed.join(busy, ["t", "key"])
    # (flip pattern, whether it counts as a centre's pattern) of each table
    flips = [
        [(_signed(sum(1 << i for i in c)), k <= radius // 2) for k in range((radius + 1) // 2 + 1) for c in combinations([i for i in range(64) if not m >> i & 1], k)]
        for m in masks
    ]
    flip_table = F.array(
        *[F.array(*[F.struct(F.lit(x).alias("bits"), F.lit(c).alias("centre")) for x, c in f]) for f in flips]
    )
    near = meeting.select("t", "fp", F.explode(F.element_at(flip_table, F.col("t") + 1)).alias("x")).select(
        "t", F.col("fp").bitwiseXOR(F.col("x.bits")).alias("value"), "fp", "x.centre"
    )
    # One value is shared by few fingerprints (those within ceil(radius/2)
    # flips of it), so this group has a fixed bound.
    met = near.groupBy("t", "value").agg(F.min(F.when(F.col("centre"), F.col("fp"))).alias("b"), F.collect_set("fp").alias("fps"))
    pairs = met.where(F.size("fps") > 1).select("b", F.explode("fps").alias("a")).where("a <> b")
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    keep: tuple[Column, ...] = (),
) -> DataFrame:
    """(doc_id, <keep>, fp, root, component_id), one row per input row; ``root``
    names the component by its smallest fingerprint."""
    rows = cut_lineage(fingerprints(docs, id_col, text_col, shingle_words, keep))
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(links(nodes.select("fp"), radius))
    member = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    names = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = member.join(names, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select(*rows.columns, "root", "component_id")


def fingerprint_hex(fp_col: str = "fp"):
    """16 lower-case hex digits of the fingerprint."""
    return F.lower(F.lpad(F.hex(fp_col), 16, "0"))
