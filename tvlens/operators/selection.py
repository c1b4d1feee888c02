"""Exact order statistics: a rank becomes a key value.

``ROW_NUMBER() OVER (ORDER BY key) <= rank`` is, for every row, the question
whether the row is at or before the row of that rank.  So the bound row is
selected once, and the question is a comparison in a projection: nothing is
numbered, sorted or shuffled as a whole, and a query that does not ask for the
label does not compute it.

Rows are ordered by (key, tie), NULL keys last.  ``tie`` names the row (the
hash of its file and position), so equal keys, even a third of all rows, are
told apart.  Selection takes two scans of the two columns, both inside one
scalar subquery:

1. a quantile sketch (state bounded by ``ACCURACY``) with the row count, which
   turns the ranks into brackets of the order that hold the bound rows;
2. the exact number of rows before a bracket (counted map-side) and the rows
   inside, about three in ``GRID`` of them for a rank, in order: the bound is the
   one at which the running count reaches the rank.

A bound that is not in its bracket raises an error; nothing is approximate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampNTZType, TimestampType

GRID, ACCURACY = 1_000, 10_000
#: A rank from the number of all rows.
Rank = Callable[[Column], Column]


def row_identity(df: DataFrame) -> Column | None:
    """A number naming each row of a table scan by its file and position in it.

    None where rows do not come from files row by row: then two equal rows
    cannot be told apart by an expression.
    """
    try:
        plan = df._jdf.queryExecution().analyzed()
    except AttributeError:
        return None
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation":
        return None
    place = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    try:
        df.select(*place)
    except AnalysisException:
        return None
    return F.shiftrightunsigned(F.xxhash64(*place), 1)


def order_key(df: DataFrame, key: Column) -> Column:
    """The key as a bigint of the same order; integers, dates and timestamps only."""
    kind = df.select(key.alias("k")).schema["k"].dataType
    if isinstance(kind, DateType):
        return F.unix_date(key).cast("bigint")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(key.cast("timestamp"))
    if isinstance(kind, IntegralType):
        return key.cast("bigint")
    raise TypeError(f"no exact order number for {kind.simpleString()}")


# Expressions are given as text where they are long: every function call of the
# Column API is a round trip to the JVM, and a plan may be built for a query
# that then prunes the label.
#: A double that never falls along the order of (key, tie).
_PLACE = "CASE WHEN key IS NULL THEN 1e300D * (1D + tie / 9.223372036854775808e18D) ELSE CAST(key AS DOUBLE) + tie / 9.223372036854775808e18D END"


def place_of(df: DataFrame, key: str, name: str = "_at", tie: str = "_t") -> DataFrame:
    """Add a double that never falls along the order of (key, tie), NULL keys
    last; for keys that are no whole numbers along the order of the key."""
    try:
        keyed = df.withColumn("_key", order_key(df, F.col(key)))
    except TypeError:
        return df.withColumn(name, F.coalesce(F.col(key).cast("double"), F.lit(float("inf"))))
    return keyed.selectExpr(*_names(df), f"{_PLACE.replace('key', '_key').replace('tie', tie)} AS {name}")


def _names(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns]


def quantiles(column: str, shares: Sequence[float], accuracy: int) -> str:
    return f"percentile_approx({column}, array({', '.join(f'{s!r}D' for s in shares)}), {accuracy})"


def _brackets(rows: DataFrame, ranks: Sequence[Rank]) -> Column:
    """Array of (rank, low, high), one for each rank: bounds of the place of its row."""
    sketch = rows.selectExpr("CASE WHEN among THEN at END AS at").selectExpr(
        "count(1) AS rows", "count(at) AS n", f"{quantiles('at', [i / GRID for i in range(GRID + 1)], ACCURACY)} AS q"
    )
    wanted = [F.least(rank(F.col("rows")).cast("bigint"), F.col("n")).alias(f"r{i}") for i, rank in enumerate(ranks)]

    def bracket(r: str) -> str:
        low, high = f"CAST(floor({r} / n * {GRID}) AS INT) - 1", f"CAST(ceil({r} / n * {GRID}) AS INT) + 1"
        return (
            f"named_struct('rank', {r}, 'low', CASE WHEN {low} < 0 THEN -double('infinity') ELSE get(q, {low}) END, "
            f"'high', CASE WHEN {high} > {GRID} THEN double('infinity') ELSE get(q, {high}) END)"
        )

    each = ", ".join(bracket(f"r{i}") for i in range(len(ranks)))
    return sketch.select("n", "q", *wanted).selectExpr(f"CASE WHEN n > 0 THEN array({each}) END AS brackets").scalar()


def bound_rows(df: DataFrame, key: Column, tie: Column, ranks: Sequence[Rank], among: Column | None = None) -> Column:
    """Map of rank number -> (key, tie) of its row, as one scalar subquery.

    To be kept in a column and used from there, so that it stands in the plan
    once.  Only rows for which ``among`` holds have an order; each rank is a
    function of the number of all rows.  A rank below 1 has no entry, one beyond
    the last row that row's."""
    among = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    # No filter on ``among``: pushed down, it would repeat what the column is computed from.
    rows = df.select(order_key(df, key).alias("key"), tie.alias("tie"), among.alias("among"))
    rows = rows.selectExpr("*", f"{_PLACE} AS at")

    def seen(i: int) -> str:
        """A row as a bracket sees it: before (no key, no tie), inside, or not at all."""
        b = f"brackets[{i}]"
        inside = f"at >= {b}.low"
        return (
            f"CASE WHEN among AND at <= {b}.high AND {b}.rank > 0 THEN named_struct('i', {i}, 'rank', {b}.rank, "
            f"'inside', {inside}, 'key', CASE WHEN {inside} THEN key END, 'tie', CASE WHEN {inside} THEN tie END) END"
        )

    each = ", ".join(seen(i) for i in range(len(ranks)))
    upto = (
        rows.withColumn("brackets", _brackets(rows, ranks))
        .selectExpr(f"explode(array_compact(array({each}))) AS s")
        .selectExpr("s.*")
        .groupBy("i", "rank", "inside", "key", "tie")
        .agg(F.expr("count(1) AS n"))
        .selectExpr(
            "*",
            "sum(n) OVER (PARTITION BY i ORDER BY inside, key ASC NULLS LAST, tie "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto",
        )
    )
    bound = "max(CASE WHEN inside AND upto >= rank AND upto - n < rank THEN named_struct('key', key, 'tie', tie) END)"
    missing = "CAST(raise_error('a rank is outside its bracket') AS STRUCT<key: BIGINT, tie: BIGINT>)"
    bounds = upto.groupBy("i").agg(F.expr(f"coalesce({bound}, {missing}) AS bound"))
    return bounds.selectExpr("map_from_entries(collect_list(struct(i, bound))) AS m").scalar()


def _reached(i: int) -> str:
    """Whether a row (_key, _tie) is at or before bound ``i`` of ``_bounds`` (False without one)."""
    b = f"try_element_at(_bounds, {i})"
    return (
        f"coalesce(CASE WHEN {b} IS NULL THEN false WHEN _key IS NULL THEN {b}.key IS NULL AND _tie <= {b}.tie "
        f"ELSE {b}.key IS NULL OR _key < {b}.key OR (_key = {b}.key AND _tie <= {b}.tie) END, false)"
    )


def _compared(
    df: DataFrame, key: Column, tie: Column, ranks: Sequence[Rank], among: Column | None, name: str, text: str
) -> DataFrame:
    """Add ``name``, an expression over the bounds, the row's key and tie, and ``_among``."""
    own = {"_bounds": bound_rows(df, key, tie, ranks, among), "_key": order_key(df, key), "_tie": tie}
    own["_among"] = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    return df.withColumns(own).selectExpr(*_names(df), f"{text} AS `{name}`")


def rank_labels(
    df: DataFrame,
    key: Column,
    tie: Column,
    ranks: Sequence[tuple[str, Rank]],
    default: str | None,
    name: str,
    among: Column | None = None,
) -> DataFrame:
    """Add ``name``: the label of the first rank that reaches the row in key
    order, else ``default``; rows outside ``among`` get the default too."""
    text = lambda v: "NULL" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    cases = " ".join(f"WHEN _among AND {_reached(i)} THEN {text(label)}" for i, (label, _) in enumerate(ranks))
    return _compared(df, key, tie, [r for _, r in ranks], among, name, f"CASE {cases} ELSE {text(default)} END")


def rank_flag(df: DataFrame, key: Column, tie: Column, rank: Rank, name: str, among: Column | None = None) -> DataFrame:
    """Add ``name``: whether the row is one of the first ``rank`` rows in key order."""
    return _compared(df, key, tie, [rank], among, name, f"_among AND {_reached(0)}")
