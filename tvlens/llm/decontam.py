"""Benchmark decontamination by spaced-seed hashing.

Tokens are the runs of letters and digits of the lower-cased text.  A seed is
``SPAN`` tokens in a row with some positions ignored by a fixed mask; its hash
is the same when only ignored tokens differ.  Hashes of the benchmark's seeds
meet the hashes of every position of every document, and each hit is verified
around itself: item and document are aligned up to ``REACH`` tokens beyond the
seed on both sides, and some stretch of at least ``MIN_OVERLAP`` tokens (or the
whole item, if shorter) that holds the seed must have at least ``similarity``
equal; the longest such stretch counts.  So substituted tokens are tolerated,
in the seed and around it.  Items of fewer than SPAN tokens are one seed
without ignored tokens: they are found where a document holds them whole.

Built-in functions only.  Hashes of documents are tested against a bitmap of
the benchmark's hashes first, inside the row; the bitmap has a fixed size
(``BITMAP_BITS``) however large the benchmark is, it only saves work, and what
passes it is joined by hash.  Benchmark seeds with equal surroundings are one
row, with a digest of the set of items that have them in place of the items,
so repeated items multiply nothing while hits are verified; a document's best
overlap with each set is then joined to the set's members.  ``contaminated``
stops before that.

Defined cases: NULL and empty texts have no tokens and match nothing; an item
of one token matches every document that holds it; NULL or repeated ids
and repeated rows are reported as they are (with the text's hash to tell them
apart); empty tables give an empty result; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvlens.llm.common import let

#: Masks over SPAN tokens; 0 marks an ignored position.
MASKS = ("11011011", "11101101", "10110111")
SPAN = 8
REACH = 6
MIN_OVERLAP = 13
SIMILARITY = 0.8
BITMAP_BITS = 1 << 21


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seed_hashes(h: Column, i: Column) -> list[Column]:
    """One hash for each mask of the token hashes ``h`` from position ``i``."""
    return [F.xxhash64(F.lit(m), *[F.get(h, i + k) for k, used in enumerate(mask) if used == "1"]) for m, mask in enumerate(MASKS)]


def _starts(size: Column) -> Column:
    return F.when(size >= SPAN, F.sequence(F.lit(0), size - SPAN)).otherwise(F.array().cast("array<int>"))


def _around(w: Column, pos: Column) -> Column:
    """Tokens from REACH before the seed to REACH after it, and how many precede it."""
    left = F.least(pos, F.lit(REACH))
    return F.struct(left.alias("left"), F.slice(w, pos - left + 1, left + SPAN + REACH).alias("win"))


def _whole(w: Column) -> Column:
    """A short item as a seed with nothing around it."""
    return F.struct(F.lit(0).alias("left"), w.alias("win"))


def _whole_hash(w: Column) -> Column:
    return F.xxhash64(F.lit("whole"), F.array_join(w, " "))


def _short_hits(w: Column, sizes: list[int], bitmap: Column) -> Column:
    """Distinct marked runs of so many tokens, as the hits of short items."""
    def runs(n: int) -> Column:
        at = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.array_join(F.slice(w, i, n), " "))

    marked = [F.array_distinct(F.filter(runs(n), lambda t: _marked(bitmap, F.xxhash64(F.lit("whole"), t)))) for n in sizes]
    return F.transform(F.concat(*marked), lambda t: F.struct(_whole(F.split(t, " ")).alias("d"), F.array(F.xxhash64(F.lit("whole"), t)).alias("hs")))


def _longest(equal: Column, before: Column, need: Column, similarity: float) -> Column:
    """(aligned, matched) of the longest stretch of ``need`` or more tokens that
    holds the seed with enough of them equal, or NULL.  ``equal``: 1 or 0 for
    every aligned token; ``before`` of them precede the seed."""
    count = lambda x: F.aggregate(x, F.lit(0), lambda a, e: a + e)
    enough = lambda s: (s["aligned"] >= need) & (s["matched"] >= F.lit(similarity) * s["aligned"])
    stretch = lambda first, n: F.struct(n.alias("aligned"), count(F.slice(equal, first + 1, n)).alias("matched"))
    size = F.size(equal)
    ends = F.sequence(F.least(before + SPAN, size), size)
    every = F.flatten(F.transform(F.sequence(F.lit(0), before), lambda a: F.transform(ends, lambda e: stretch(a, e - a))))
    most = count(equal)
    return (
        F.when(enough({"aligned": size, "matched": most}), F.struct(size.alias("aligned"), most.alias("matched")))
        .when(most >= F.lit(similarity) * need, F.array_max(F.filter(every, enough)))
    )


def seeds(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(h, around, need, item): seeds of the benchmark and the items that have them."""
    own = benchmark.select(F.col(id_col).alias("item"), tokens(F.col(text_col)).alias("w"))
    own = own.withColumn("th", F.transform("w", lambda x: F.xxhash64(x)))
    at = own.select("item", "w", "th", F.explode(_starts(F.size("w"))).alias("pos"))
    hashed = at.select("item", _around(F.col("w"), F.col("pos")).alias("around"), F.size("w").alias("n"), F.array(*_seed_hashes(F.col("th"), F.col("pos"))).alias("hs"))
    long = hashed.select(F.explode("hs").alias("h"), "around", F.least("n", F.lit(MIN_OVERLAP)).alias("need"), "item")
    w = F.col("w")
    short = own.where((F.size(w) > 0) & (F.size(w) < SPAN)).select(_whole_hash(w).alias("h"), _whole(w).alias("around"), F.size(w).alias("need"), "item")
    return long.unionByName(short).distinct()


_SEED = ("h", "around", "need")
_SET = ("set_a", "set_b")


def _item_sets(held: DataFrame) -> DataFrame:
    """(h, around, need, set_a, set_b): distinct seeds with the digest of their items."""
    digests = [F.bit_xor(F.xxhash64(F.lit(s), "item")).alias(s) for s in _SET]
    return held.groupBy(*_SEED).agg(*digests)


def _members(held: DataFrame) -> DataFrame:
    """(set_a, set_b, item): the items of every set."""
    return held.join(_item_sets(held), list(_SEED)).select(*_SET, "item").distinct()


def _bitmap(hashes: DataFrame) -> Column:
    """Array of BITMAP_BITS / 64 longs with the bits of the hashes set."""
    slot = F.col("h").bitwiseAND(F.lit(BITMAP_BITS - 1))
    rows = (
        hashes.groupBy(F.shiftright(slot, 6).alias("i"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits"))
        .collect()  # at most BITMAP_BITS / 64 rows, whatever the benchmark's size
    )
    table = [0] * (BITMAP_BITS // 64)
    for r in rows:
        table[r["i"]] = r["bits"]
    # A constant: folded to one array when the plan is optimised.
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")


def _marked(bitmap: Column, h: Column) -> Column:
    slot = F.shiftright(h.bitwiseAND(F.lit(BITMAP_BITS - 1)), 6).cast("int")
    return F.getbit(F.get(bitmap, slot), h.bitwiseAND(F.lit(63)).cast("int")) == 1


def _best(rows: DataFrame, *by: str) -> DataFrame:
    """The overlap with the highest share, then the most tokens, of each group."""
    best = F.max(F.struct((F.col("matched") / F.col("aligned")).alias("share"), "matched", "aligned")).alias("best")
    return rows.groupBy(*by).agg(best).select(*by, "best.matched", "best.aligned")


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(doc_id, text_hash, item_id, matched, aligned): the best verified overlap
    of every document and benchmark item that have one."""
    held = seeds(benchmark, item_id_col, item_text_col)
    found = _best(_verified(docs, _item_sets(held), id_col, text_col, similarity), "doc_id", "text_hash", *_SET)
    linked = found.join(_members(held), list(_SET))
    return _best(linked, "doc_id", "text_hash", "item").withColumnRenamed("item", "item_id")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(doc_id, text_hash): the documents with a verified overlap, once each."""
    known = _item_sets(seeds(benchmark, item_id_col, item_text_col))
    return _verified(docs, known, id_col, text_col, similarity).select("doc_id", "text_hash").distinct()


def _verified(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame:
    """(doc_id, text_hash, set_a, set_b, matched, aligned): every verified hit."""
    bitmap = _bitmap(known)
    sizes = [r["n"] for r in known.where(F.col("need") < SPAN).select(F.col("need").alias("n")).distinct().collect()]  # below SPAN

    def hits(w: Column) -> Column:
        """Surroundings and hashes of the positions of a token array where a hash is marked."""
        placed = lambda th: F.transform(
            _starts(F.size(th)), lambda i: F.struct(i.alias("pos"), F.array(*_seed_hashes(th, i)).alias("hs"))
        )
        all_at = let(F.transform(w, lambda x: F.xxhash64(x)), placed)
        marked = F.filter(all_at, lambda x: F.exists(x["hs"], lambda h: _marked(bitmap, h)))
        long = F.transform(marked, lambda x: F.struct(_around(w, x["pos"]).alias("d"), x["hs"].alias("hs")))
        return F.concat(long, _short_hits(w, sizes, bitmap)) if sizes else long

    found = let(tokens(F.col(text_col)), hits)
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), found.alias("hits"))
    at = own.select("doc_id", "text_hash", F.explode_outer("hits").alias("hit")).where("hit IS NOT NULL")
    seen = at.select("doc_id", "text_hash", F.col("hit.d").alias("d"), F.explode("hit.hs").alias("h"))
    met = seen.join(known.withColumnRenamed("around", "b"), "h")
    left = F.least("d.left", "b.left")
    right = F.least(F.size("d.win") - F.col("d.left"), F.size("b.win") - F.col("b.left"))
    side = lambda x: F.slice(f"{x}.win", F.col(f"{x}.left") - left + 1, left + right)
    equal = F.zip_with(side("d"), side("b"), lambda x, y: (x == y).cast("int"))
    longest = let(equal, lambda e: _longest(e, left, F.col("need"), similarity))
    return met.withColumn("s", longest).where("s IS NOT NULL").select("doc_id", "text_hash", *_SET, "s.matched", "s.aligned")
