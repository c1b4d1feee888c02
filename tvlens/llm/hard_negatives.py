"""Hard negatives by secondary sort.

An anchor's positives are its best rows of the same label; each positive opens
a window of scores from ``low`` to ``high`` percent of its own, and the best
rows of other labels inside the window are its hard negatives.

Pair scores travel as packed keys (anchor, descending score, kind, id), 25
bytes whose byte order is the wanted order.  The keys are dealt out by anchor
and sorted within their partition; an iterator then walks the stream: a
positive opens its window, a negative is given to every open window that it
fits.  The iterator holds the windows of one anchor, never its pairs.

Scores are computed in cells of at most about ``ROWS`` rows by ``ANCHORS``
anchors (the anchors are a stated query set against all rows, in blocks): rows
and anchors are dealt to groups by hash, and each cell is one group pair.  Two
rounds keep the shuffle small without losing a pair that could matter:

1. A cell sends the best ``positives`` rows of every anchor.  Merged and sorted
   these are the anchor's positives, hence its windows.
2. Knowing the windows, a cell sends for each of them its best ``negatives``
   rows inside; no other row of the cell can be among the window's first ones.

So a label, or copies of one vector, with a third of all rows send no more
than any others.

Components become ``floor(scale * x)``, scores are exact 64-bit integers (a
score beyond them raises an error).  Defined cases: rows with a NULL id, label
or vector, or a NULL or non-finite component, take no part; rows that repeat
an id count once (of different ones, the smallest by label, then by bytes of
the vector); a shorter vector is continued with zeros; an anchor without
positives, or a positive of negative score, has no rows; ties go to the
smaller id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvlens.llm.common import cut_lineage

POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 10, 30, 90, 256
ROWS, ANCHORS, TILE = 4096, 8192, 128

KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
POSITIVE, NEGATIVE = 0, 1
OUT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
_SIGN = np.uint64(1 << 63)
_LEAST = np.iinfo(np.int64).min


def _ordered(x: np.ndarray) -> np.ndarray:
    """Signed integers as unsigned ones of the same order (and back)."""
    return x.astype(np.int64).view(np.uint64) ^ _SIGN


def pack(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> pa.RecordBatch:
    keys = np.empty(len(ids), KEY)
    keys["anchor"], keys["score"], keys["kind"], keys["id"] = _ordered(anchor), ~_ordered(score), kind, _ordered(ids)
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(KEY.itemsize), len(keys), [None, pa.py_buffer(keys.tobytes())])
    return pa.RecordBatch.from_arrays([fixed.cast(pa.binary())], ["key"])


def unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), KEY)
    signed = lambda x: (x.astype(np.uint64) ^ _SIGN).view(np.int64)
    return signed(keys["anchor"]), signed(~keys["score"].astype(np.uint64)), keys["kind"], signed(keys["id"])


def share(score: np.ndarray, percent: int) -> np.ndarray:
    """floor(percent * score / 100) without overflow."""
    return percent * (score // 100) + percent * (score % 100) // 100


def window(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest score inside the window of a positive."""
    return -share(-score, low), share(score, high)


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """The vectors as rows, continued with zeros to the longest."""
    own = [np.frombuffer(v, "<i8") for v in vectors.to_pylist()]
    out = np.zeros((len(own), max(map(len, own), default=0)), np.int64)
    for i, v in enumerate(own):
        out[i, : len(v)] = v
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` and ``b``."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    top = lambda m: max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))
    bound = top(a) * top(b) * d
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    if any(not _LEAST < s < 1 << 63 for s in exact.ravel()):
        raise OverflowError("an inner product is beyond 64 bits")
    return exact.astype(np.int64)


def best(s: np.ndarray, inside: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the first ``k`` columns of every row that are
    ``inside``, by descending score and ascending column."""
    if s.shape[1] > k:
        held = np.where(inside, s, _LEAST)
        inside = inside & (s >= np.partition(held, -k, axis=1)[:, -k, None])
    i, j = np.nonzero(inside)
    order = np.lexsort((j, -s[i, j], i))
    i, j = i[order], j[order]
    first = np.searchsorted(i, i)
    keep = np.arange(len(i)) - first < k
    return i[keep], j[keep]


def _quantised(vectors: DataFrame, anchor: Column, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, label, anchor, q), one row for each id that takes part."""

    def to_integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("vector")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            x = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.float64)  # NULL: nan
            ends = np.concatenate(([0], np.cumsum(sizes)))
            fine = np.diff(np.concatenate(([0], np.cumsum(~np.isfinite(x))))[ends]) == 0
            q = np.floor(scale * np.where(np.isfinite(x), x, 0.0))
            if np.abs(q).max(initial=0) >= 2.0**63:
                raise OverflowError("a component is beyond 64 bits")
            data = q.astype("<i8").tobytes()
            packed = pa.array([data[8 * s : 8 * e] for s, e in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            out = [b.column("vec_id"), b.column("label"), b.column("anchor"), packed]
            yield pa.RecordBatch.from_arrays(out, ["vec_id", "label", "anchor", "q"]).filter(pa.array(fine))

    taking_part = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    rows = taking_part.mapInArrow(to_integers, "vec_id bigint, label bigint, anchor boolean, q binary")
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "q", "anchor")).alias("v")).select("vec_id", "v.*")


class _Cells:
    """The grid of row groups by anchor groups."""

    def __init__(self, rows: DataFrame):
        n, anchors = rows.agg(F.count("*"), F.count_if("anchor")).first()
        self.row_groups, self.anchor_groups = max(1, -(-n // ROWS)), max(1, -(-anchors // ANCHORS))
        most = 16 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.tasks = min(self.row_groups * self.anchor_groups, most)
        self.rows = self._dealt(rows.drop("anchor"), "r", self.row_groups, "a", self.anchor_groups)

    def _dealt(self, df: DataFrame, own: str, groups: int, other: str, others: int, key: str = "vec_id") -> DataFrame:
        placed = df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(groups)))
        copies = placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)).cast("array<bigint>")))
        return copies.repartition(self.tasks, "r", "a")

    def apply(self, anchors: DataFrame, function) -> DataFrame:
        """``function(ids, labels, matrix, anchors table)`` yields batches of keys for each cell."""

        def cell(rows: pa.Table, anchors: pa.Table) -> pa.Table:
            empty = pa.RecordBatch.from_arrays([pa.array([], pa.binary())], ["key"])
            if not rows.num_rows or not anchors.num_rows:
                return pa.Table.from_batches([empty])
            rows = rows.sort_by("vec_id")
            ids, labels = (rows[c].to_numpy() for c in ("vec_id", "label"))
            return pa.Table.from_batches([empty, *function(ids, labels, _matrix(rows["q"]), anchors)])

        # New column names: both sides come from the same frame.
        own = anchors.select(*[F.col(c).alias(f"anchor_{c}") for c in anchors.columns])
        right = self._dealt(own, "a", self.anchor_groups, "r", self.row_groups, "anchor_vec_id")
        return self.rows.groupBy("r", "a").cogroup(right.groupBy("r", "a")).applyInArrow(cell, "key binary")


def _tiles(ids: np.ndarray, matrix: np.ndarray, anchors: pa.Table) -> Iterator[tuple]:
    """(slice, ids, labels, scores) of some anchors at a time."""
    own, label = (anchors[c].to_numpy() for c in ("anchor_vec_id", "anchor_label"))
    vectors = _matrix(anchors["anchor_q"])
    for at in range(0, len(own), TILE):
        part = slice(at, at + TILE)
        yield part, own[part], label[part], scores(vectors[part], matrix)


def _sorted(keys: DataFrame) -> DataFrame:
    return keys.repartition(F.substring("key", 1, 8)).sortWithinPartitions("key")


def _windows(keys: DataFrame, positives: int) -> DataFrame:
    """(anchor_id, windows): the first scores and ids of every anchor, packed."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def row(anchor: int, pairs: list[tuple[int, int]]) -> tuple[int, bytes]:
            return anchor, np.array(pairs, "<i8").tobytes()

        for b in batches:
            out = []
            for anchor, score, _, i in zip(*(c.tolist() for c in unpack(b)), strict=True):
                if anchor != now:
                    out += [row(now, held)] if held else []
                    now, held = anchor, []
                if len(held) < positives:
                    held.append((score, i))
            yield _window_batch(out)
        if held:
            yield _window_batch([row(now, held)])

    return _sorted(keys).mapInArrow(first, "anchor_id bigint, windows binary")


def _window_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["anchor_id", "windows"])


def _opened(windows: DataFrame) -> DataFrame:
    """The positives of the windows as keys."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for anchor, packed in zip(b.column("anchor_id").to_pylist(), b.column("windows").to_pylist(), strict=True):
                pairs = np.frombuffer(packed, "<i8").reshape(-1, 2)
                yield pack(np.full(len(pairs), anchor), pairs[:, 0], POSITIVE, pairs[:, 1])

    return windows.mapInArrow(keys, "key binary")


def walk(batches: Iterator[pa.RecordBatch], negatives: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Hard negatives from the sorted stream of one partition's keys."""
    names = [c.split()[0] for c in OUT.split(", ")]
    types_ = [pa.int32() if c.endswith(" int") else pa.int64() for c in OUT.split(", ")]
    now, open_windows = None, []
    for b in batches:
        out = []
        anchors, points, kinds, ids = unpack(b)
        least, most = window(points, low, high)
        rows = zip(*(c.tolist() for c in (anchors, points, kinds, ids, least, most)), strict=True)
        for anchor, score, kind, i, lo, hi in rows:
            if anchor != now:
                now, open_windows = anchor, []
            if kind == POSITIVE:
                open_windows.append([i, score, lo, hi, 0])
                continue
            for w in open_windows:
                if w[2] <= score <= w[3] and w[4] < negatives:
                    w[4] += 1
                    out.append((anchor, w[0], w[4], i, w[1], score))
        columns = zip(*out, strict=True) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types_, strict=True)], names)


def mine(
    vectors: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for the rows for which ``anchor`` holds."""
    # Read by both rounds; the second must see what the first saw.
    rows = cut_lineage(_quantised(vectors, anchor, id_col, label_col, vector_col, scale))
    cells, anchors = _Cells(rows), rows.where("anchor").drop("anchor")

    def near(ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray, table: pa.Table) -> Iterator[pa.RecordBatch]:
        for _, own, label, s in _tiles(ids, matrix, table):
            i, j = best(s, (label[:, None] == labels) & (own[:, None] != ids), positives)
            yield pack(own[i], s[i, j], POSITIVE, ids[j])

    def fitting(ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray, table: pa.Table) -> Iterator[pa.RecordBatch]:
        pairs = [np.frombuffer(w, "<i8")[::2] for w in table["anchor_windows"].to_pylist()]
        for part, own, label, s in _tiles(ids, matrix, table):
            other, kept = label[:, None] != labels, np.zeros(s.shape, bool)
            for k in range(positives):
                # Anchors without a k-th positive get an empty window.
                has = np.array([len(p) > k for p in pairs[part]])
                lo, hi = window(np.array([p[k] if len(p) > k else 0 for p in pairs[part]], np.int64), low, high)
                inside = other & has[:, None] & (s >= lo[:, None]) & (s <= hi[:, None])
                kept[best(s, inside, negatives)] = True
            i, j = np.nonzero(kept)
            yield pack(own[i], s[i, j], NEGATIVE, ids[j])

    # Also read twice: by the cells of the second round and as the positives of the stream.
    windows = cut_lineage(_windows(cells.apply(anchors, near), positives))
    with_windows = anchors.join(windows, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    keys = _opened(windows).unionByName(cells.apply(with_windows, fitting))
    return _sorted(keys).mapInArrow(lambda batches: walk(batches, negatives, low, high), OUT)
