"""Column helpers that pin down the semantics the analytics are written in.

Each helper fixes one place where a naive Spark expression would silently
return a different answer than the source dialect:

* weekday numbering starts at Sunday = 0 (``dow0``), Spark's starts at 1;
* ``DATEDIFF('day', a, b)`` counts calendar-day boundaries (``day_gap``),
  not whole 24 h periods;
* ``LEAST``/``GREATEST`` return NULL when any input is NULL (``strict_least``,
  ``strict_greatest``); Spark's skip NULL inputs;
* ``MODE`` must be deterministic on ties (``mode_of`` picks the smallest);
* fixed-point literals such as ``3600.0`` stay double (``per_hour``), never
  decimal;
* random choices are hashes of keys (``hash_bucket``, ``hash_unit``) so a
  retried task or a different partitioning gives the same rows.

All helpers are built-in expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- calendar ---------------------------------------------------------------
def dow0(ts: ColumnLike) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(_c(ts)) - F.lit(1)


# Weekday names indexed by dow0.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def day_name(dow: ColumnLike) -> Column:
    """Weekday name for a Sunday-based day number; NULL outside 0..6."""
    return value_map(dow, dict(enumerate(DAY_NAMES)))


def day_gap(start: ColumnLike, end: ColumnLike) -> Column:
    """Number of calendar-day boundaries between two timestamps (end - start).

    23:00 -> 01:00 on the next day is 1, as in ``DATEDIFF('day', a, b)``.
    """
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def hour_slot(ts: ColumnLike) -> Column:
    """Start of the hour containing ``ts``, kept as timestamp_ntz."""
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")


def week_start(ts: ColumnLike) -> Column:
    """Monday 00:00 of the week containing ``ts``, as timestamp_ntz."""
    return F.date_trunc("week", _c(ts)).cast("timestamp_ntz")


def programme_key(prefix: str, ts: ColumnLike, pattern: str = "yyyyMMdd-HH") -> Column:
    """Programme id ``<prefix>yyyyMMdd-HH`` (or another datetime pattern)."""
    return F.concat(F.lit(prefix), F.date_format(_c(ts), pattern))


def since(as_of, days: int) -> Column:
    """The date ``days`` before ``as_of`` (a date or ISO string)."""
    return F.date_sub(F.lit(as_of).cast("date"), days)


# --- NULL-strict arithmetic ---------------------------------------------------
def strict_least(*cols: ColumnLike) -> Column:
    """LEAST that is NULL when any argument is NULL."""
    cs = [_c(c) for c in cols]
    return F.when(_all_not_null(cs), F.least(*cs))


def strict_greatest(*cols: ColumnLike) -> Column:
    """GREATEST that is NULL when any argument is NULL."""
    cs = [_c(c) for c in cols]
    return F.when(_all_not_null(cs), F.greatest(*cs))


def _all_not_null(cols: Sequence[Column]) -> Column:
    cond = cols[0].isNotNull()
    for c in cols[1:]:
        cond = cond & c.isNotNull()
    return cond


def per_hour(seconds: ColumnLike) -> Column:
    """Seconds to hours as double (``x / 3600.0``)."""
    return _c(seconds).cast("double") / F.lit(3600.0)


def per_minute(seconds: ColumnLike) -> Column:
    """Seconds to minutes as double (``x / 60.0``)."""
    return _c(seconds).cast("double") / F.lit(60.0)


def ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """``num::double / NULLIF(den, 0)``."""
    d = _c(den)
    return _c(num).cast("double") / F.when(d != 0, d)


# --- aggregates ---------------------------------------------------------------
def mode_of(col: ColumnLike) -> Column:
    """Most frequent non-NULL value; the smallest one on ties."""
    return F.mode(_c(col), True)


def share_if(pred: Column) -> Column:
    """``COUNT_IF(pred)::double / COUNT(*)``."""
    return F.count_if(pred).cast("double") / F.count(F.lit(1))


def day_span(ts: ColumnLike) -> Column:
    """``DATEDIFF('day', MIN(ts), MAX(ts)) + 1`` as an aggregate."""
    return day_gap(F.min(_c(ts)), F.max(_c(ts))) + F.lit(1)


# --- value maps and bands ----------------------------------------------------
def value_map(col: ColumnLike, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Simple CASE: ``CASE col WHEN k THEN v ... [ELSE default] END``.

    Without ``default`` unmatched values give NULL (CASE without ELSE).
    """
    c = _c(col)
    expr = None
    for key, value in mapping.items():
        lit_value = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(c == F.lit(key), lit_value) if expr is None else expr.when(c == F.lit(key), lit_value)
    if expr is None:
        return F.lit(default)
    if default is not None:
        expr = expr.otherwise(default if isinstance(default, Column) else F.lit(default))
    return expr


def bands(cases: Iterable[tuple[Column, Any]], default: Any = None) -> Column:
    """Searched CASE: the first true predicate wins, else ``default``."""
    expr = None
    for pred, value in cases:
        lit_value = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(pred, lit_value) if expr is None else expr.when(pred, lit_value)
    if expr is None:
        return F.lit(default)
    if default is not None:
        expr = expr.otherwise(default if isinstance(default, Column) else F.lit(default))
    return expr


def cycle(key: ColumnLike, values: Sequence[Any]) -> Column:
    """``values[key % len(values)]``: a label chosen by modulo of a key."""
    return value_map(F.pmod(_c(key), F.lit(len(values))), dict(enumerate(values)))


# --- deterministic randomness ------------------------------------------------
HASH_BITS = 60


def key_hash(*cols: ColumnLike, seed: int = 0) -> Column:
    """A stable 60-bit number from the text of the key columns and a seed.

    MD5 of ``seed|col|col...`` (NULL as ``\\N``), its first 15 hex digits: any
    SQL engine computes the same number, so every hash-ordered operator has
    an oracle.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit("\\N")) for c in cols]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def hash_bucket(n: int, *cols: ColumnLike, seed: int = 0) -> Column:
    """A stable bucket 0..n-1 from a hash of the key columns and a seed."""
    return key_hash(*cols, seed=seed) % F.lit(n)


def hash_unit(*cols: ColumnLike, seed: int = 0, resolution: int = 1_000_000) -> Column:
    """A stable pseudo-uniform double in [0, 1) from the key columns."""
    return hash_bucket(resolution, *cols, seed=seed).cast("double") / F.lit(float(resolution))


def hash_int(lo: int, hi: int, *cols: ColumnLike, seed: int = 0) -> Column:
    """A stable pseudo-uniform integer in [lo, hi], both ends inclusive."""
    return hash_bucket(hi - lo + 1, *cols, seed=seed) + F.lit(lo)


def stable_id(*cols: ColumnLike, seed: int = 0) -> Column:
    """A 32-hex-digit id derived from the key columns (replaces random UUIDs).

    Recomputing a lost partition yields the same id, unlike ``uuid()``.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), *parts), 256), 1, 32)


def padded(col: ColumnLike, width: int, fill: str = "0") -> Column:
    """``LPAD(col::string, width, fill)``."""
    return F.lpad(_c(col).cast("string"), width, fill)


def to_variant(struct_col: Column) -> Column:
    """Semi-structured object from a struct; NULL fields are dropped."""
    return F.parse_json(F.to_json(struct_col))


def json_object(fields: Mapping[str, ColumnLike]) -> Column:
    """JSON text of an object built from named columns; NULL fields dropped."""
    return F.to_json(F.struct(*[_c(v).alias(k) for k, v in fields.items()]))
