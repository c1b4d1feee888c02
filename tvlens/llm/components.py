"""Connected components of an edge list as rounds of joins.

Alternates the large-star and small-star steps: in a large star every node
links its larger neighbours to the smallest node it knows, in a small star it
links its smaller neighbours (and itself) to it.  The edge list shrinks to one
edge from every node to the smallest node of its component.  Each step is a
grouped minimum (combined map-side) and a join that adaptive execution can
split at a hot node; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tvlens.llm.common import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over (a, b); returns distinct edges (a, b) with b < a."""
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        pairs = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = pairs.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that is not a root
    itself; the root is the smallest node of its component."""
    now = cut_lineage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )
    mark = None
    for _ in range(max_rounds):
        now = cut_lineage(_star(_star(now, True), False))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
