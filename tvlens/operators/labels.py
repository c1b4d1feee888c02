"""Labels, fractions, NULL injection and near-duplicates by key.

Cumulative quota labels, exact fractional attachment, protected NULL
injection, source-or-derived substitution, hash categories and mutated
copies of picked rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvlens.functions.columns import (
    ColumnLike,
    _c,
    bands,
    hash_bucket,
    hash_int,
    hash_unit,
    key_hash,
)

from tvlens.operators.numbering import first_n, row_ordinal
from tvlens.operators.selection import Rank, rank_flag, rank_labels, row_identity


def quota_sizes(total: int, overall_share: float, weights: Sequence[int]) -> list[int]:
    """Split ``round(total * overall_share)`` by integer weights.

    Every part but the last is ``round(target * w / sum)``; the last takes the
    remainder so the parts add up exactly.  Python's ``round`` (half to even)
    is used, as the job that sets the quotas does.
    """
    target = int(round(total * overall_share))
    weight_sum = sum(weights)
    parts = [int(round(target * w / weight_sum)) for w in weights[:-1]]
    parts.append(target - sum(parts))
    return parts


def assign_quota(
    df: DataFrame,
    ordinal: ColumnLike,
    bounds: Sequence[tuple[str, int | Column]],
    default: str,
    name: str,
) -> DataFrame:
    """Label rows by cumulative ordinal bounds.

    With bounds ``[(A, a), (B, b)]`` rows with ordinal ``<= a`` get A, ``<= b``
    get B, the rest ``default``.  A bound is a number or a scalar column.
    """
    cases = [(_c(ordinal) <= (b if isinstance(b, Column) else F.lit(b)), label) for label, b in bounds]
    return df.withColumn(name, bands(cases, default))


def assign_quota_by_key(
    df: DataFrame, key: str, ranks: Sequence[tuple[str, Rank]], default: str, name: str
) -> DataFrame:
    """Label rows by cumulative ranks in key order (NULL keys last).

    ``ranks`` are functions of the row count.  Rows of a table scan are
    compared with the selected bound rows, without numbering or shuffle; where
    rows have no identity (not from files) they are numbered.
    """
    tie = row_identity(df)
    if tie is not None:
        return rank_labels(df, F.col(key), tie, ranks, default, name)
    rows = df.select(F.count(F.lit(1))).scalar()
    bounds = [(label, rank(rows)) for label, rank in ranks]
    return assign_quota(row_ordinal(df, key, "_rn"), "_rn", bounds, default, name).drop("_rn")


def attach_fraction(
    df: DataFrame, value: ColumnLike, key: ColumnLike, fraction: float, name: str
) -> DataFrame:
    """Keep ``value`` for about ``fraction`` of rows (by ``key % 100``), else NULL.

    The fraction is clamped to [0, 1] and scaled exactly (decimal), so 0.07
    means ``key % 100 < 7``, not ``< 7.000000000000001``.
    """
    p = min(Decimal(1), max(Decimal(0), Decimal(str(fraction))))
    threshold = p * 100
    lit = F.lit(int(threshold)) if threshold == threshold.to_integral_value() else F.lit(float(threshold))
    return df.withColumn(name, F.when(F.pmod(_c(key), F.lit(100)) < lit, _c(value)))


def null_out(
    df: DataFrame,
    column: str,
    rate: float,
    key: Sequence[str],
    protect: Column | None = None,
    seed: int = 0,
) -> DataFrame:
    """Blank ``column`` at about ``rate`` of rows, never where ``protect`` holds."""
    blank = hash_unit(*key, seed=seed) < F.lit(float(rate))
    if protect is not None:
        blank = ~F.coalesce(protect, F.lit(False)) & blank
    return df.withColumn(column, F.when(blank, F.lit(None).cast(df.schema[column].dataType)).otherwise(F.col(column)))


def substitute_from_source(
    df: DataFrame,
    label: ColumnLike,
    targets: dict[str, tuple[Sequence[str], str, str, bool]],
) -> DataFrame:
    """Take a source value for the listed labels, else the derived value.

    ``targets`` maps output column -> (labels, source column, derived column,
    fall_back).  With ``fall_back`` a NULL source value falls back to the
    derived value (COALESCE); without it the NULL is kept.
    """
    out = df
    for column, (labels, source, derived, fall_back) in targets.items():
        src = F.col(source)
        if fall_back:
            src = F.coalesce(src, F.col(derived))
        out = out.withColumn(column, F.when(_c(label).isin(list(labels)), src).otherwise(F.col(derived)))
    return out


def hash_category(
    cols: Sequence[ColumnLike],
    cuts: Sequence[tuple[float, str]],
    last: str,
    seed: int = 0,
) -> Column:
    """A stable category: the first ``(cut, label)`` with ``u < cut``, else ``last``.

    ``u`` is ``(hash % 1000) / 1000`` of the key columns and seed.
    """
    u = hash_bucket(1000, *cols, seed=seed).cast("double") / F.lit(1000.0)
    return bands([(u < F.lit(float(cut)), label) for cut, label in cuts], last)


def near_duplicates(
    df: DataFrame,
    n: int | Column | Rank,
    key: Sequence[str],
    eligible: Column,
    id_col: str,
    email_col: str,
    phone_col: str,
    label_col: str,
    label: str = "DUPLICATE",
    suffix: str = "_DUP",
    seed: int = 0,
) -> DataFrame:
    """Append exactly ``n`` mutated copies of eligible rows (all, if fewer).

    ``n`` is a number, a scalar column, or a function of the row count.  A copy
    gets ``id || suffix``; with chance 1/2 (when not NULL) a digit is inserted
    before every ``@`` of the email and the phone's last character is replaced
    by a digit; its label becomes ``label``.  Rows of a table scan come out with
    their copy in one pass.
    """
    cols = df.columns
    changes = _mutated(key, id_col, email_col, phone_col, F.lit(label), suffix, seed, label_col)
    tie = row_identity(df)
    if tie is None:
        rows = df.select(F.count(F.lit(1))).scalar()
        picked = first_n(df.where(eligible), n(rows) if callable(n) and not isinstance(n, Column) else n, key, seed)
        return df.unionByName(picked.select(*[changes.get(c, F.col(c)).alias(c) for c in cols]))
    rank = n if callable(n) and not isinstance(n, Column) else lambda rows: n if isinstance(n, Column) else F.lit(n)
    flagged = rank_flag(df, key_hash(*key, seed=seed), tie, rank, "_picked", eligible)
    copy = F.struct(*[changes.get(c, F.col(c)).alias(c) for c in cols])
    both = F.array_compact(F.array(F.struct(*cols), F.when(F.col("_picked"), copy)))
    return flagged.select(F.inline(both))


def _mutated(key, id_col, email_col, phone_col, label, suffix, seed, label_col) -> dict[str, Column]:
    """The columns of a copy that differ from its original."""
    new_id = F.concat(F.col(id_col), F.lit(suffix))
    k = [new_id if c == id_col else F.col(c) for c in key]
    email, phone = F.col(email_col), F.col(phone_col)
    digit_e = hash_int(0, 9, *k, seed=seed + 2).cast("string")
    digit_p = hash_int(0, 9, *k, seed=seed + 4).cast("string")
    marked = F.regexp_replace(email, "@", F.concat(digit_e, F.lit("@")))
    redialled = F.concat(F.expr(f"substr({phone_col}, 1, length({phone_col}) - 1)"), digit_p)
    return {
        id_col: new_id,
        email_col: F.when((hash_bucket(2, *k, seed=seed + 1) == 0) & email.isNotNull(), marked).otherwise(email),
        phone_col: F.when((hash_bucket(2, *k, seed=seed + 3) == 0) & phone.isNotNull(), redialled).otherwise(phone),
        label_col: label,
    }
