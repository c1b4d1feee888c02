"""Token counts without token ids.

A byte-level BPE never merges across the borders of its pre-tokens, and one
border is always at a space that follows a non-space and precedes one (the
space goes with what follows).  The text between two such spaces is the unit
counted here; it holds whole pre-tokens only.  The pieces of a unit are
counted once per distinct unit, joined to the units' frequencies in every
document, and summed.

1. Documents are read in blocks.  A block lists its distinct units, each with
   the documents of the block that have it and how often.  Units in at least
   ``1 / HOT_SHARE`` of the block's documents, and very long ones, are counted
   where they are (a block has a bounded number of the first, and the second
   rarely repeat); so no frequent unit gathers the whole corpus's rows.
2. The other units are dealt out and sorted by hash; equal units are next to
   each other, so each distinct unit is tokenized once, and its count is
   multiplied with the frequencies into sums per block and document.
3. The sums meet the block's own row (ids, byte lengths, sums of step 1).

Special tokens written in a text count as the tokenizer does by default: one
token each, cut out before everything else.

Defined cases: NULL and empty texts have 0 bytes and 0 tokens; NULL or
repeated ids and repeated rows give one result row each; an empty table gives
an empty result; other input columns are ignored.
"""

from __future__ import annotations

import json
import os
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tvlens.llm.common import text_slices

TOKENIZER = "byte_bpe_50k.json"
BLOCK_DOCS, BLOCK_BYTES = 8192, 24 << 20
HOT_SHARE = 128
LONG_UNIT = 200
MAX_OPEN_BLOCKS = 512

# White space as in Unicode's White_Space property, and four separators more
# (taking a character for white space only makes longer units).
_WHITE = r"\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: A space next to other white space or to an end of the text.
_ODD_SPACE = f" [{_WHITE}]|[{_WHITE}] |^ | $"

# Rows carry their numbers as bytes: Spark measures every batch it hands to
# Python, and list columns that are mostly NULL make that quadratic.
ROW_SCHEMA = "unit string, kind int, block bigint, posting binary"
PART_SCHEMA = "block bigint, kind int, posting binary"
OUT_SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint"
_POST = np.dtype([("doc", "<u2"), ("times", "<u2")])


class Pieces:
    """Counts the pieces of strings; one per Python worker and vocabulary."""

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        if not name.endswith(".json"):
            raise ValueError(f"{name}: only byte-level BPE vocabularies (.json) are counted by pre-token")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = name if os.path.isabs(name) else public_tokenizers.path(name)
        with open(path, encoding="utf-8") as f:
            self.specials = [t["content"] for t in json.load(f)["added_tokens"]]
        self.encode = Tokenizer.from_file(path).encode_batch_fast
        self.known: dict[str, int] = {}

    def count(self, units: list[str]) -> np.ndarray:
        if len(self.known) > 200_000:
            self.known.clear()
        new = [u for u in dict.fromkeys(units) if u not in self.known]
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            self.known.update(zip(part, map(len, self.encode(part, add_special_tokens=False)), strict=True))
        return np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))


def pieces_of(name: str) -> Pieces:
    """The worker's tokenizer; kept between tasks of the same worker."""
    kept = sys.modules.setdefault("tvlens_worker_state", types.ModuleType("tvlens_worker_state"))
    held = kept.__dict__.setdefault("pieces", {})
    if name not in held:
        held[name] = Pieces(name)
    return held[name]


def split_units(text: str) -> list[str]:
    """Units of a text with odd spaces: cut at each space between two non-spaces."""
    out, start = [], 0
    at = text.find(" ")
    while at >= 0:
        if 0 < at < len(text) - 1 and not text[at - 1].isspace() and not text[at + 1].isspace():
            out.append(text[start:at])
            start = at + 1
        at = text.find(" ", at + 1)
    return [*out, text[start:]]


def _block_units(texts: pa.Array, specials: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """All units of a block in order without their leading space, the document
    and first-of-its-text flag of each, and the special tokens per document."""
    odd = pc.match_substring_regex(texts, _ODD_SPACE)
    for s in specials:
        odd = pc.or_(odd, pc.match_substring(texts, s))
    odd = np.asarray(odd.fill_null(False).to_pylist(), bool) if len(texts) else np.zeros(0, bool)
    n_special = np.zeros(len(texts), np.int64)
    plain = np.flatnonzero(~odd)
    lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    units, docs = [pc.list_flatten(lists)], [np.repeat(plain, sizes)]
    first = np.zeros(int(sizes.sum()), bool)
    first[np.cumsum(sizes) - sizes] = True
    firsts = [first]
    for i in np.flatnonzero(odd).tolist():
        parts = [texts[i].as_py()]
        for s in specials:
            cut = [q for p in parts for q in p.split(s)]
            n_special[i] += len(cut) - len(parts)
            parts = cut
        for p in parts:
            own = split_units(p)
            units.append(pa.array(own, pa.string()))
            docs.append(np.full(len(own), i))
            firsts.append(np.arange(len(own)) == 0)
    return pa.concat_arrays(units), np.concatenate(docs), np.concatenate(firsts), n_special


def block_rows(batch: pa.RecordBatch, block: int, pieces: Pieces) -> pa.RecordBatch:
    """The rows of one block: one of kind 0 for the block itself, and one of
    kind 1 for each distinct unit that is counted elsewhere."""
    texts, n = batch.column("text"), batch.num_rows
    units, doc, first, sums = _block_units(texts, pieces.specials)
    coded = pc.dictionary_encode(units)
    key = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + first
    pair, times = np.unique(key * n + doc, return_counts=True)
    key, doc = pair // n, pair % n
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.concatenate((start, [len(key)])))
    own = key[start]
    texts_of = coded.dictionary.take(pa.array(own >> 1))
    names = pc.if_else(pa.array(own % 2 == 1), texts_of, pc.binary_join_element_wise("", texts_of, " "))
    most = np.maximum.reduceat(times, start) if len(start) else size
    here = (size >= max(32, n // HOT_SHARE)) | (most > 65535)
    here |= pc.greater(pc.utf8_length(names), LONG_UNIT).to_numpy(zero_copy_only=False).astype(bool)
    counted = np.zeros(len(own), np.int64)
    counted[here] = pieces.count(names.filter(pa.array(here)).to_pylist())
    sums += np.bincount(doc, np.repeat(counted, size) * times, n).astype(np.int64)[:n]
    away = np.repeat(~here, size)
    post = np.empty(int(away.sum()), _POST)
    post["doc"], post["times"] = doc[away], times[away]
    ends = np.concatenate(([0], np.cumsum(size[~here]))).astype(np.int32) * _POST.itemsize
    k = len(ends) - 1
    posting = pa.Array.from_buffers(pa.binary(), k, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(post)])
    head = pa.array([f"\x00{block}"], pa.string())
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = batch.column("doc_id")
    # The block's own row: ids, which of them are NULL, sums, byte lengths.
    own_row = np.concatenate((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), sums, lengths))
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([head, names.filter(pa.array(~here)).cast(pa.string())]),
            pa.array(np.concatenate(([0], np.ones(k))), pa.int32()),
            pa.array(np.full(k + 1, block, np.int64)),
            pa.concat_arrays([pa.array([own_row.astype("<i8").tobytes()], pa.binary()), posting]),
        ],
        ["unit", "kind", "block", "posting"],
    )


def _part_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    types_ = [pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types_)], ["block", "kind", "posting"])


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens), one row per input row."""

    def to_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, block = pieces_of(tokenizer), TaskContext.get().partitionId() << 32
        for b in text_slices(batches, "text", BLOCK_DOCS, BLOCK_BYTES):
            yield block_rows(b, block, pieces)
            block += 1

    def to_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, open_sums = pieces_of(tokenizer), {}

        def flush() -> pa.RecordBatch:
            rows = []
            for block, held in open_sums.items():
                at = np.flatnonzero(held)
                rows.append((block, 1, np.stack((at, held[at])).astype("<i8").tobytes()))
            open_sums.clear()
            return _part_batch(rows)

        for b in batches:
            kind = b.column("kind").to_numpy(zero_copy_only=False)
            heads = [(r["block"], 0, r["posting"]) for r in b.filter(pa.array(kind == 0)).to_pylist()]
            if heads:
                yield _part_batch(heads)
            b = b.filter(pa.array(kind == 1))
            coded = pc.dictionary_encode(b.column("unit"))
            n = pieces.count(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
            block = b.column("block").to_numpy(zero_copy_only=False)
            order = np.argsort(block, kind="stable")
            posts = b.column("posting").take(pa.array(order))
            each = np.diff(np.flatnonzero(np.concatenate(([True], block[order][1:] != block[order][:-1], [True]))))
            at = 0
            for rows in each.tolist():
                own = posts.slice(at, rows).to_pylist()
                post = np.frombuffer(b"".join(own), _POST)
                weight = np.repeat(n[order[at : at + rows]], [len(x) // _POST.itemsize for x in own])
                add = np.bincount(post["doc"], weight * post["times"], BLOCK_DOCS).astype(np.int64)
                held = open_sums.setdefault(int(block[order[at]]), np.zeros(BLOCK_DOCS, np.int64))
                held += add
                at += rows
                if len(open_sums) >= MAX_OPEN_BLOCKS:
                    yield flush()
        if open_sums:
            yield flush()

    def to_docs(table: pa.Table) -> pa.Table:
        ids = missing = sums = lengths = np.zeros(0, np.int64)
        numbers = lambda kind: [np.frombuffer(p, "<i8") for p in table.filter(pc.equal(table["kind"], kind))["posting"].to_pylist()]
        for own in numbers(0):
            ids, missing, sums, lengths = own.reshape(4, -1)
        sums = sums.copy()
        for part in numbers(1):
            at, add = part.reshape(2, -1)
            sums[at] += add
        return pa.table([pa.array(ids, pa.int64(), mask=missing > 0), pa.array(lengths), pa.array(sums)], ["doc_id", "n_bytes", "n_tokens"])

    only = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    units = only.mapInArrow(to_units, ROW_SCHEMA).repartition("unit").sortWithinPartitions(F.xxhash64("unit"))
    return units.mapInArrow(to_parts, PART_SCHEMA).groupBy("block").applyInArrow(to_docs, OUT_SCHEMA)
