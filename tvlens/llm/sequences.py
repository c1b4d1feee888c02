"""Token-id sequences in training order, in fixed-stride binary shards.

1. Documents are tokenized and packed, each followed by END, into sequences
   of ``seq_len`` ids; a sequence is named by its input partition and its
   number there.
2. A first pass counts the sequences of every partition (one number each goes
   through the driver), which gives every sequence an index in 0..N-1; a keyed Feistel permutation of that range
   (cycle-walking over the next power of four) gives its global slot.  The
   ids themselves are made in a second pass: tokenizing twice is cheaper than
   keeping a second copy of all ids.  ``docs`` must therefore be a table scan
   or a checkpointed frame, whose partitions are the same each time; a shard
   in which a slot is missing or taken twice raises an error.
3. Slots are dealt out by range, ``shard_sequences`` to a shard; each task
   sorts its shard and writes one file of records of ``2 * seq_len`` bytes
   (little-endian uint16, the unused tail filled with PAD).

Slot s lies in shard ``s // shard_sequences`` at byte ``(s % shard_sequences)
* stride``, so a reader can resume anywhere by seeking (``read_slots``).  A
task writes under a name of its own and renames at the end, so a repeated or
lost task leaves no half-written shard.  The folder must be one that all
executors share.

Special strings inside texts are ordinary text here: no document can forge a
boundary.  Ids must be below PAD.

Defined cases: NULL and empty texts hold no ids but still get their END; NULL
or repeated ids and repeated rows are packed like any other; an empty table
writes no shard; other input columns are ignored.
"""

from __future__ import annotations

import base64
import json
import os
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tvlens.llm.common import give_back, text_slices
from tvlens.session import ensure_checkpoint_dir

TOKENIZER = "byte_bpe_50k.tiktoken"
END, PAD = 50256, 65535
SEQ_LEN = 2048
SHARD_SEQUENCES = 8192
SLICE_ROWS, SLICE_BYTES = 4096, 2 << 20
ROUNDS = 6
#: The pieces of ``public_tokenizers.PATTERN`` without its steps back: runs are
#: taken whole; where white space is followed by a word, its last character is
#: a piece or begins one.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

PACKED = "slot bigint, part bigint, seq bigint, n_tokens int, doc_ids array<bigint>, ids binary"
INDEX = "slot bigint, shard bigint, offset bigint, part bigint, seq bigint, n_tokens int, doc_ids array<bigint>, checksum bigint, path string"


def encoder(name: str):
    """The vocabulary's encoder; kept between tasks of the same worker.  It
    has no special tokens, so their strings in a text are ordinary text."""
    kept = sys.modules.setdefault("tvlens_worker_state", types.ModuleType("tvlens_worker_state"))
    held = kept.__dict__.setdefault("encoders", {})
    if name not in held:
        import public_tokenizers
        import tiktoken

        with open(name if os.path.isabs(name) else public_tokenizers.path(name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        held[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return held[name]


def tokenize(texts: list[str], tokenizer: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and how many each text has."""
    encode = encoder(tokenizer).encode_ordinary
    parts = [np.array(encode(t), np.uint16) for t in texts]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.concatenate([np.zeros(0, np.uint16), *parts]), size


def _squeeze(ids: np.ndarray) -> bytes:
    """Low bytes, then high bytes, compressed."""
    return zstandard.compress(ids.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), 1)


def _expand(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(2, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u2")


def pack(docs: DataFrame, tokenizer: str, seq_len: int, id_col: str, text_col: str, first: dict[int, int], total: int, key: int) -> DataFrame:
    """The table of sequences (see PACKED).  ``first``: index of the first
    sequence of each input partition, of ``total`` in all."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        rest, rest_docs = np.zeros(0, np.uint16), np.zeros(0, np.int64)
        doc_names: list[int | None] = []  # ids of the documents that rest_docs numbers

        def rows(tokens: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
            nonlocal seq
            out = []
            for s in range(0, len(tokens), seq_len):
                piece, who = tokens[s : s + seq_len], owner[s : s + seq_len]
                named = [doc_names[d] for d in who[np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))].tolist()]
                out.append((part, seq, len(piece), named, _squeeze(piece)))
                seq += 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
            cols = [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)]
            if part not in first or first[part] + seq > total:
                raise RuntimeError(f"partition {part} has more sequences than were counted: the input's partitions changed")
            slots = feistel(np.arange(seq - len(out), seq) + first[part], total, key)
            return pa.RecordBatch.from_arrays([pa.array(slots), *cols], ["slot", "part", "seq", "n_tokens", "doc_ids", "ids"])

        for b in text_slices(batches, "text", SLICE_ROWS, SLICE_BYTES):
            tokens, size = tokenize(b.column("text").to_pylist(), tokenizer)
            n = b.num_rows
            all_ids = np.full(len(tokens) + n, END, np.uint16)
            owner = np.repeat(np.arange(n), size + 1)
            is_text = np.ones(len(all_ids), bool)
            is_text[np.cumsum(size + 1) - 1] = False
            all_ids[is_text] = tokens
            numbers, rest_docs = np.unique(rest_docs, return_inverse=True)
            carried = [doc_names[d] for d in numbers.tolist()]
            doc_names = carried + b.column("doc_id").to_pylist()
            all_ids = np.concatenate((rest, all_ids))
            owner = np.concatenate((rest_docs, owner + len(carried)))
            whole = len(all_ids) // seq_len * seq_len
            rest, rest_docs = all_ids[whole:], owner[whole:]
            if whole:
                yield rows(all_ids[:whole], owner[:whole])
        if len(rest):
            yield rows(rest, rest_docs)
        give_back()

    only = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return only.mapInArrow(fill, PACKED)


def feistel(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Keyed permutation of 0..n-1: a balanced Feistel network over the next
    power of four, walked on until the value is below n."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    h = np.uint64(half)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> h, x & mask
        for r in range(ROUNDS):
            salt = np.uint64(xxhash.xxh64_intdigest(f"{key}:{r}".encode()))
            f = (right ^ salt) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(32)) & mask)
        return (left << h) | right

    out = once(index.astype(np.uint64))
    while (far := out >= np.uint64(n)).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def count_sequences(docs: DataFrame, tokenizer: str, seq_len: int, text_col: str) -> DataFrame:
    """(part, n): sequences of each input partition."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, total = encoder(tokenizer).encode_ordinary, TaskContext.get().partitionId(), 0
        for b in text_slices(batches, "text", SLICE_ROWS, SLICE_BYTES):
            total += b.num_rows + sum(len(encode(t)) for t in b.column("text").to_pylist())
        give_back()
        if total:
            yield pa.RecordBatch.from_pydict({"part": [part], "n": [-(-total // seq_len)]})

    return docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(count, "part bigint, n bigint")


def write_shards(
    docs: DataFrame,
    folder: str,
    key: int = 2024,
    tokenizer: str = TOKENIZER,
    seq_len: int = SEQ_LEN,
    shard_sequences: int = SHARD_SEQUENCES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Index of the sequences (see INDEX); its evaluation writes the shards and
    writes them anew, byte for byte, if it is evaluated again."""
    counts = count_sequences(docs, tokenizer, seq_len, text_col)
    first, n = {}, 0
    for r in sorted(counts.collect()):  # one row for each input partition
        first[r.part], n = n, n + r.n
    placed = pack(docs, tokenizer, seq_len, id_col, text_col, first, n, key)
    placed = placed.withColumn("shard", F.floor(F.col("slot") / shard_sequences))
    stride = 2 * seq_len
    system, base = pyarrow.fs.FileSystem.from_uri(_uri(folder))
    system.create_dir(base, recursive=True)
    with system.open_output_stream(f"{base}/manifest.json") as out:
        out.write(json.dumps({"sequences": n, "seq_len": seq_len, "shard_sequences": shard_sequences, "pad": PAD, "end": END}).encode())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pyarrow.fs.FileSystem.from_uri(_uri(folder))
        shard, out, path, draft, expect = None, None, "", "", 0

        def close() -> None:
            if out is not None:
                out.close()
                if expect != min(n, (shard + 1) * shard_sequences):
                    raise RuntimeError(f"shard {shard} ends before slot {expect}: the input's partitions changed")
                system.move(draft, path)

        for b in batches:
            sums, paths = [], []
            rows = zip(b.column("slot").to_pylist(), b.column("shard").to_pylist(), b.column("ids").to_pylist(), strict=True)
            for slot, s, blob in rows:
                if s != shard:
                    close()
                    shard, path, expect = s, f"{base}/shard-{s:08d}.bin", s * shard_sequences
                    draft = f"{path}.{uuid.uuid4().hex}"
                    out = system.open_output_stream(draft)
                if slot != expect:
                    raise RuntimeError(f"slot {slot} where {expect} belongs: the input's partitions changed")
                expect += 1
                record = np.full(seq_len, PAD, "<u2")
                ids = _expand(blob)
                record[: len(ids)] = ids
                out.write(record.tobytes())
                sums.append(xxhash.xxh64_intdigest(record.tobytes()) >> 1)
                paths.append(path)
            offset = b.column("slot").to_numpy() % shard_sequences * stride
            cols = [b.column("slot"), b.column("shard"), pa.array(offset)]
            cols += [b.column(c) for c in ("part", "seq", "n_tokens", "doc_ids")] + [pa.array(sums, pa.int64()), pa.array(paths, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in INDEX.split(", ")])
        close()

    shards = max(1, -(-n // shard_sequences))
    dealt = placed.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("slot")
    return dealt.mapInArrow(write, INDEX)


def _uri(folder: str) -> str:
    """``file:/x`` (as Spark writes it) and local paths as URIs that Arrow reads."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        return "file://" + folder[5:]
    return folder if "://" in folder else "file://" + os.path.abspath(folder)


def new_folder(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sequences-{uuid.uuid4().hex}"


def read_slots(folder: str, first: int, count: int) -> Iterator[np.ndarray]:
    """Sequences from a slot on, in training order, without their padding."""
    system, base = pyarrow.fs.FileSystem.from_uri(_uri(folder))
    with system.open_input_stream(f"{base}/manifest.json") as f:
        m = json.loads(f.read())
    stride, per = 2 * m["seq_len"], m["shard_sequences"]
    slot, end = first, min(first + count, m["sequences"])
    while slot < end:
        here = min(end, (slot // per + 1) * per)
        with system.open_input_file(f"{base}/shard-{slot // per:08d}.bin") as f:
            f.seek(slot % per * stride)
            data = np.frombuffer(f.read((here - slot) * stride), "<u2").reshape(-1, m["seq_len"])
        for record in data:
            yield record[record != m["pad"]]
        slot = here
