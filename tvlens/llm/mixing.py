"""Mixing sources to target weights.

Every source gets a budget of words; documents are taken whole, in the order
of a hash, so a mix is a hash threshold per source.  The thresholds come from
histograms: sum sizes by source and hash bucket, find the bucket in which the
running sum crosses the budget, refine only that bucket by the next bits of
the hash, and decide the last, tiny bucket hash by hash.  Nothing is sorted
but histograms and that bucket.

Budgets above the source's own size repeat it: ``floor(target / size)`` whole
copies plus a hash threshold for the rest (nested: a larger budget always
contains the documents of a smaller one).

Defined cases: NULL text has size 0; the NULL source is a source of its own
and ranks last; rows equal in id and text share a hash and are taken together;
a source without words takes nothing; an empty table gives an empty result.
Other input columns are ignored.  The table of sources (one row each, the
configuration of a mix) is the only thing ranked in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tvlens.llm.common import cut_lineage, words

MAX_REPEAT = 3
WEIGHTS = (1, 2, 3)
#: Bits of the hash (60 in all) used by each histogram level.
LEVEL_BITS = (10, 10)
HASH_BITS = 60
#: The table of sources is broadcast when it was counted to be this small;
#: beyond that the joins shuffle (adaptive execution splits a hot source).
BROADCAST_SOURCES = 100_000


def row_hash(id_col: str, text_col: str) -> Column:
    """60 bits of the MD5 of id and text."""
    key = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.col(text_col)).cast("binary"))
    return F.conv(F.substring(key, 1, 15), 16, 10).cast("bigint")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, h): words of every row and its hash."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.size(words(F.col(text_col))).cast("bigint").alias("size"),
        row_hash(id_col, text_col).alias("h"),
    )


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target): weights by rank of the source, targets
    at most MAX_REPEAT times the source, the excess reshared by weight.

    Sources are capped in the order of capacity per weight.  With the first k
    capped, the level is what is left over the weights left; a source is
    capped exactly when its capacity per weight is at most that level.  The
    level grows while sources are capped and would fall after the first free
    one, so the largest level of a free source is the final one.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * MAX_REPEAT
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), F.col("rank"))
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = (
        sizes.select("source", "source_size", rank.alias("rank"), weight.alias("weight"), cap.alias("cap"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("left_size", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("left_size").cast("double") / F.col("left_weight"))
        .withColumn("free", F.col("cap") / F.col("weight") > F.col("level"))
        .withColumn("final_level", F.max(F.when(F.col("free"), F.col("level"))).over(everything))
    )
    free = F.col("final_level").isNotNull() & (F.col("cap") > F.col("weight") * F.col("final_level"))
    target = F.when(free, F.col("weight") * F.col("final_level")).otherwise(F.col("cap").cast("double"))
    return table.select("source", "source_size", target.alias("target"))


def _cut(histogram: DataFrame, order: str) -> DataFrame:
    """Of (source, room, <order>, size): the first entry whose running sum
    goes above the room, with the room left before it."""
    run = Window.partitionBy("source").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Exactly one entry has the room within [sum before it, sum with it).
    return (
        histogram.withColumn("run", F.sum("size").over(run))
        .where((F.col("run") > F.col("room")) & (F.col("run") - F.col("size") <= F.col("room")))
        .select("source", order, (F.col("room") - (F.col("run") - F.col("size"))).alias("room"), "size")
    )


def _inside(rows: DataFrame, edge: DataFrame, shift: int, small: bool) -> DataFrame:
    """Rows whose hash prefix is their source's boundary prefix, with the room left."""
    edge = edge.select(F.col("source").alias("edge_source"), "prefix", "room")
    return rows.join(
        F.broadcast(edge) if small else edge,
        rows["source"].eqNullSafe(F.col("edge_source")) & (F.shiftright("h", shift) == F.col("prefix")),
    ).select("source", "size", "h", "room")


def thresholds(rows: DataFrame, targets: DataFrame, small: bool) -> DataFrame:
    """(source, source_size, target, copies, h_cut): ``copies`` whole copies,
    and one more of every document whose hash is below ``h_cut``."""
    goal = targets.withColumn(
        "copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("room", F.col("target") - F.col("copies") * F.col("source_size"))
    rows = rows.where("size > 0")
    edge, shift = None, HASH_BITS
    for bits in LEVEL_BITS:
        shift_now = shift - bits
        bucket = F.shiftright("h", shift_now).alias("bucket")
        if edge is None:
            sums = rows.groupBy("source", bucket).agg(F.sum("size").alias("size"))
            room = goal.select(F.col("source").alias("goal_source"), "room")
            histogram = sums.join(room, sums["source"].eqNullSafe(room["goal_source"])).drop("goal_source")
        else:  # only rows inside the boundary bucket of the level before
            histogram = (
                _inside(rows, edge, shift, small)
                .groupBy("source", bucket)
                .agg(F.sum("size").alias("size"), F.first("room").alias("room"))
            )
        edge, shift = _cut(histogram, "bucket").withColumnRenamed("bucket", "prefix"), shift_now
    last = _inside(rows, edge, shift, small).groupBy("source", "h").agg(F.sum("size").alias("size"), F.first("room").alias("room"))
    # The document that crosses the budget is taken when that ends nearer.
    over, under = F.col("size") - F.col("room"), F.col("room")
    h_cut = _cut(last, "h").select(
        F.col("source").alias("cut_source"), F.when(over <= under, F.col("h") + 1).otherwise(F.col("h")).alias("h_cut")
    )
    # No crossing: the room is the whole rest (or nothing at all).
    none = F.when(F.col("room") > 0, F.lit(1 << HASH_BITS)).otherwise(F.lit(0)).cast("bigint")
    return goal.join(h_cut, goal["source"].eqNullSafe(h_cut["cut_source"]), "left").select(
        "source", "source_size", "target", F.col("copies").cast("int"), F.coalesce("h_cut", none).alias("h_cut")
    )


def mix_plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(plan_source, source_size, target, copies, h_cut) from sized rows; hinted
    for broadcast when it was counted to be small."""
    targets = cut_lineage(source_targets(rows, weights))
    small = targets.count() <= BROADCAST_SOURCES
    plan = cut_lineage(thresholds(rows, targets, small)).withColumnRenamed("source", "plan_source")
    return F.broadcast(plan) if small else plan


def times_taken() -> Column:
    """Copies of a row with hash ``h`` under its source's plan."""
    return F.col("copies") + (F.col("h") < F.col("h_cut")).cast("int")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
) -> DataFrame:
    """(doc_id, source, size, h, source_size, target, times): how often the
    mix takes each row."""
    rows = cut_lineage(sized(docs, id_col, text_col, source_col))
    plan = mix_plan(rows, weights)
    return rows.join(plan, rows["source"].eqNullSafe(F.col("plan_source")), "left").select(
        "doc_id", "source", "size", "h", "source_size", "target", times_taken().alias("times")
    )


def take(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.  The plan is a
    function of source and hash, so whole rows are never checkpointed."""
    plan = mix_plan(cut_lineage(sized(docs, id_col, text_col, source_col)), weights)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(source_col).alias("source"),
        row_hash(id_col, text_col).alias("h"),
    )
    taken = rows.join(plan, rows["source"].eqNullSafe(F.col("plan_source"))).where(times_taken() > 0)
    return taken.select("row", F.explode(F.sequence(F.lit(1), times_taken()))).select("row.*")


def mix_report(mixed: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken)."""
    return mixed.select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("times") * F.col("size")).alias("taken")
    )
