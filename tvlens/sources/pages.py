"""Results in pages: a keyset over a total order, with a token to go on from.

A page is a filter behind the last row of the page before and a top-k, so no
page reads into the driver more than its own rows, and none is computed from
offsets.  The order is the given columns, then all others, NULLs last; rows
equal in every column are told apart by how many of them were delivered, which
the token says too.  The token is plain text: the next page may be asked for
by another session, as long as the rows are the same.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType


def _order(df: DataFrame, order_by: Sequence[str]) -> list[str]:
    return [*order_by, *[c for c in df.columns if c not in order_by]]


def _text(df: DataFrame, name: str) -> Column:
    """A column as text that casts back to the same value."""
    column = F.col(f"`{name}`")
    return F.hex(column) if isinstance(df.schema[name].dataType, BinaryType) else column.cast("string")


def _value(df: DataFrame, name: str, text: str | None) -> Column:
    kind = df.schema[name].dataType
    return F.unhex(F.lit(text)) if isinstance(kind, BinaryType) else F.lit(text).cast(kind)


def _from(df: DataFrame, names: Sequence[str], values: Sequence[str | None]) -> Column:
    """Rows at or behind the given one in the order."""
    at = F.lit(True)  # equal in all columns so far: the row itself counts
    for name, text in reversed(list(zip(names, values, strict=True))):
        column, value = F.col(f"`{name}`"), _value(df, name, text)
        behind = F.lit(False) if text is None else (column.isNull() | F.coalesce(column > value, F.lit(False)))
        at = behind | (column.eqNullSafe(value) & at)
    return at


def page(df: DataFrame, order_by: Sequence[str], rows: int, token: str | None = None) -> tuple[pd.DataFrame, str | None]:
    """The next ``rows`` rows behind ``token`` and the token to go on from
    (None: there are no more)."""
    names = _order(df, order_by)
    values, skip = json.loads(base64.b64decode(token)) if token else (None, 0)
    source = df.where(_from(df, names, values)) if values else df
    keys = [_text(df, n).alias(f"_at{i}") for i, n in enumerate(names)]
    order = [F.col(f"`{n}`").asc_nulls_last() for n in names]
    # The delivered copies of the token's row come first; one row more shows whether there are others.
    found = source.select("*", *keys).orderBy(*order).limit(skip + rows + 1).toPandas()
    now = found.iloc[skip : skip + rows]
    shown = now[df.columns]
    if len(found) <= skip + rows:
        return shown.reset_index(drop=True), None
    text = lambda r: [None if pd.isna(r[f"_at{i}"]) else r[f"_at{i}"] for i in range(len(names))]
    last, delivered = text(now.iloc[-1]), 0
    for i in range(skip + rows - 1, -1, -1):
        if text(found.iloc[i]) != last:
            break
        delivered += 1
    return shown.reset_index(drop=True), base64.b64encode(json.dumps([last, delivered]).encode()).decode()


def pages(df: DataFrame, order_by: Sequence[str], rows: int, token: str | None = None) -> Iterator[pd.DataFrame]:
    """All pages of a result, from ``token`` on."""
    while True:
        shown, token = page(df, order_by, rows, token)
        if len(shown):
            yield shown
        if token is None:
            return
