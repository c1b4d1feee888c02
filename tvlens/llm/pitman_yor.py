"""Language-model scores of a hierarchical Pitman-Yor process.

The model gives every token (lower-cased words, then one end) a probability
after the word before it.  Restaurants are contexts: a token's own one is the
ending of the word before it, its last four bytes folded to 64 * 64 leaf
contexts; 64 leaves share a parent, the last two bytes; the 64 parents share
the root, whose base is uniform over the V training types and one more for all
unknown words.  A token sits in its leaf restaurant; every table there is a
customer of the parent, every table there one of the root.

Seating is sampled by Gibbs: sequential first seating, then rounds in which
random customers of every dish leave and sit down again by the predictive rule
(restaurants.py).  In a round the totals of restaurants and the parents'
probabilities are those of the round before, so all dishes move at once; a
dish has all its restaurants in one part, and a round needs no shuffle but the
sum of 4,161 totals.  The last ``SAMPLES`` rounds give a predictive probability
each, their mean is the score's.  Each sample sums to 1 in every context.

1. Texts are read in blocks.  A block lists its distinct (word, leaf context)
   pairs with their training counts, dealt to parts by the word's hash, and
   its documents as pairs and times.  Both are checkpointed.
2. A part merges the pairs of all blocks: exact counts of whole words.  All
   training documents count, so the model grows with the corpus; the number
   of parts comes from the counted bytes.
3. Rounds of Gibbs over the parts; a round's state is checkpointed.
4. Parts answer every block's pairs with probabilities and counts, and blocks
   add them up by document.

A word in a third of all tokens has at most 4,096 pairs in a block, whatever
the block's size; what meets in one task are these, block after block.  Only
the totals (bounded by the number of contexts) go through the driver.

``base_score`` is the additive unigram score, with the same counts.

Defined cases: NULL and empty texts are one end token; NULL or repeated ids and
repeated rows give one result row each; without training documents every token
is unknown and has probability 1; a text over ``PIECE_BYTES`` is cut at white
space and its pieces' sums are added; an empty table gives an empty result;
other input columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvlens.llm.common import cut_lineage, text_slices
from tvlens.llm.restaurants import Level, discount, once_and_twice

PARENTS, LEAVES = 64, 64 * 64
BLOCK_DOCS, BLOCK_BYTES, PIECE_BYTES, PART_BYTES = 8192, 16 << 20, 6 << 20, 12 << 20
ROUNDS, SAMPLES, MOVES, STRENGTH = 3, 2, 4, 1.0

#: A row for documents (part -1) or for what a block asks of a part.
SHEET = "block bigint, part int, data binary"
STATE = "part int, data binary, totals array<bigint>"
OUT = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
_GAP = re.compile(rb"[\x20\x09-\x0D]")
#: Layout of a part's totals.
_C2, _T2, _T1 = slice(0, LEAVES), slice(LEAVES, 2 * LEAVES), slice(2 * LEAVES, 2 * LEAVES + PARENTS)
_T0, _TYPES, _ONCE = 2 * LEAVES + PARENTS, 2 * LEAVES + PARENTS + 1, 2 * LEAVES + PARENTS + 2
TOTALS = _ONCE + 6


def _put(*values) -> bytes:
    """Values as bytes.  Arrays go in by byte position (all lowest bytes first),
    which leaves long runs where numbers are small."""
    out = []
    for v in values:
        if isinstance(v, np.ndarray):
            planes = np.ascontiguousarray(v).view(np.uint8).reshape(len(v), v.itemsize).T
            v = (v.dtype.str, planes.tobytes())
        out.append(v)
    raw = pickle.dumps(out, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)


def _get(data: bytes) -> list:
    out = pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True))
    for i, v in enumerate(out):
        if isinstance(v, tuple) and len(v) == 2 and isinstance(v[0], str):
            dtype = np.dtype(v[0])
            planes = np.frombuffer(v[1], np.uint8).reshape(dtype.itemsize, -1)
            out[i] = np.ascontiguousarray(planes.T).view(dtype).ravel()
    return out


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    kinds["array<bigint>"] = pa.list_(pa.int64())
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], [n for n, _ in fields])


def _words(values: pa.Array) -> tuple[bytes, np.ndarray]:
    """Words as their bytes and lengths."""
    values = values.cast(pa.binary())
    return b"".join(values.to_pylist()), pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.uint32)


def _listed(words: bytes, lengths: np.ndarray) -> list[bytes]:
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    return [words[e - n : e] for e, n in zip(ends, lengths.tolist(), strict=True)]


def contexts(words: list[bytes]) -> np.ndarray:
    """Leaf context after each word (parent: the leaf // 64)."""
    tail = np.frombuffer(b"".join(w[-4:].rjust(4, b"\0") for w in words), ">u4").astype(np.uint64)

    def fold(x: np.ndarray) -> np.ndarray:
        return ((x + 1) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(58)).astype(np.int64)

    return fold(tail & np.uint64(0xFFFF)) * 64 + fold(tail)


def word_tokens(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, number of each token in them, text of each token)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, n = pc.list_flatten(lists), len(texts)
    doc = np.repeat(np.arange(n), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    real = pc.greater(pc.binary_length(flat), 0)
    flat, doc = flat.filter(real), doc[real.to_numpy(zero_copy_only=False)]
    coded = pc.dictionary_encode(flat)
    # Words in order: neighbours share their first letters.
    sorted_ = pc.array_sort_indices(coded.dictionary)
    place = np.empty(len(sorted_), np.int64)
    place[sorted_.to_numpy()] = np.arange(len(sorted_))
    words = coded.dictionary.take(sorted_).cast(pa.binary()).to_pylist()
    return words, place[coded.indices.to_numpy(zero_copy_only=False)], doc


def block_sheets(
    block: int, texts: pa.Array, meta: tuple, train: np.ndarray, parts: int, before: bytes = b"", ended: bool = True
) -> Iterator[tuple]:
    """The rows of one block of documents, or of a piece of one.

    ``before`` is the word before the piece; ``ended`` says that the text ends."""
    words, token, doc = word_tokens(texts)
    n = len(texts)
    # The end is the empty word; so is, as a context, the start.
    words.append(b"")
    after = contexts(words)
    home = np.array([xxhash.xxh64_intdigest(w) % parts for w in words], np.int64)
    order = np.argsort(home, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    first = np.concatenate(([True], doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, bool)
    context = np.where(first, contexts([before])[0], after[np.concatenate(([0], token[:-1]))]) if len(doc) else doc
    if ended:
        last = np.full(n, contexts([before])[0])
        final = np.flatnonzero(np.concatenate((doc[1:] != doc[:-1], [True]))) if len(doc) else []
        last[doc[final]] = after[token[final]]
        token = np.concatenate((token, np.full(n, len(words) - 1)))
        doc, context = np.concatenate((doc, np.arange(n))), np.concatenate((context, last))
    pair, at = np.unique(rank[token] * LEAVES + context, return_inverse=True)
    counts = np.bincount(at, weights=train[doc], minlength=len(pair)).astype(np.int64)
    bag, times = np.unique(doc * len(pair) + at, return_counts=True)
    word, leaf = pair // LEAVES, (pair % LEAVES).astype(np.uint16)
    part = home[order][word] if len(pair) else word
    starts = np.searchsorted(part, np.arange(parts + 1))
    used, word = np.unique(word, return_inverse=True)
    names = [words[i] for i in order[used]]
    for q in np.flatnonzero(np.diff(starts)).tolist():
        own = slice(starts[q], starts[q + 1])
        low, high = int(word[own][0]), int(word[own][-1]) + 1
        each = np.bincount(word[own] - low).astype(np.uint16)
        asked = names[low:high]
        lengths = np.fromiter(map(len, asked), np.uint32, len(asked))
        yield block, q, _put(b"".join(asked), lengths, each, leaf[own], _small(counts[own]))
    steps = np.diff(np.concatenate(([0], bag % max(len(pair), 1))))  # within a document: gaps
    sizes = np.bincount(bag // max(len(pair), 1), minlength=n)
    yield block, -1, _put(meta, sizes.astype(np.uint32), steps.astype(np.int32), _small(times), np.diff(starts).astype(np.int32))


def _small(x: np.ndarray) -> np.ndarray:
    """Counts in the smallest unsigned type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def sheets(docs: DataFrame, held_out: Column, parts: int, id_col: str, text_col: str, listed: Callable = block_sheets) -> DataFrame:
    def to_sheets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = row = TaskContext.get().partitionId() << 40
        for b in text_slices(batches, "text", BLOCK_DOCS, BLOCK_BYTES):
            train = ~b.column("held_out").to_numpy(zero_copy_only=False)
            meta = row, b.column("doc_id").to_pylist(), b.column("held_out").to_pylist()
            for texts, before, ended in _pieces(b.column("text")):
                for sheet in listed(block, texts, meta, train, parts, before, ended):
                    yield _batch(SHEET, [sheet])
                block += 1
            row += b.num_rows
            pa.default_memory_pool().release_unused()

    only = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return only.mapInArrow(to_sheets, SHEET)


def _pieces(texts: pa.Array) -> Iterator[tuple[pa.Array, bytes, bool]]:
    """The texts as they are, or one long text cut at white space."""
    if len(texts) != 1 or pc.binary_length(texts)[0].as_py() <= PIECE_BYTES:
        yield texts, b"", True
        return
    text, at, before = texts.cast(pa.binary())[0].as_py(), 0, b""
    while at < len(text):
        gap = _GAP.search(text, at + PIECE_BYTES)
        end = gap.start() if gap else len(text)
        piece = text[at:end]
        yield pa.array([piece]).cast(pa.string()), before, end == len(text)
        tail = piece.rsplit(None, 1)
        before, at = (tail[-1].lower() if tail else before), end


class Part:
    """The seating of all words of a part.

    ``c``: training counts of the pairs (word, leaf); ``word1``, ``leaf1``:
    rows of the parents.  ``past``: tables of the sampled rounds, by level."""

    def __init__(self, words: bytes, lengths: np.ndarray, word: np.ndarray, leaf: np.ndarray, levels: list | None, past: list):
        self.words, self.lengths, self.word, self.leaf, self.past = words, lengths, word, leaf, past
        self.key1, self.up = np.unique(word * PARENTS + leaf // 64, return_inverse=True)
        self.word1, self.parent1 = self.key1 // PARENTS, self.key1 % PARENTS
        self.levels = [Level(*x) for x in levels] if levels else []

    @classmethod
    def merged(cls, counted: dict[bytes, dict[int, int]]) -> Part:
        names = sorted(counted)
        word = np.repeat(np.arange(len(names)), np.array([len(counted[w]) for w in names], np.int64))
        pairs = [p for w in names for p in sorted(counted[w].items())]
        leaf, c = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
        part = cls(b"".join(names), np.array([len(w) for w in names], np.uint32), word, leaf, None, [])
        leaves = Level(c)
        parents = Level(np.bincount(part.up, leaves.t, len(part.key1)))
        part.levels = [leaves, parents, Level(np.bincount(part.word1, parents.t, len(names)))]
        return part

    def data(self) -> bytes:
        """Rows of tables and words go in as steps, 0 or 1 mostly."""
        tables = [x for v in self.levels for x in (_small(v.c), _small(np.diff(v.row, prepend=0)), _small(v.size))]
        past = [x for p in self.past for x in p]
        return _put(self.words, _small(self.lengths), _small(np.diff(self.word, prepend=0)), self.leaf.astype(np.uint16), *tables, *past)

    @classmethod
    def read(cls, data: bytes) -> Part:
        words, lengths, word, leaf, *rest = _get(data)
        c, row, size = ([x.astype(np.int64) for x in rest[i:9:3]] for i in range(3))
        levels = [[c[i], np.cumsum(row[i]), size[i]] for i in range(3)]
        past = [rest[i : i + 6] for i in range(9, len(rest), 6)]
        return cls(words, lengths.astype(np.uint32), np.cumsum(word, dtype=np.int64), leaf.astype(np.int64), levels, past)

    def totals(self) -> np.ndarray:
        leaves, parents, root = self.levels
        out = np.zeros(TOTALS, np.int64)
        out[_C2] = np.bincount(self.leaf, leaves.c, LEAVES)
        out[_T2] = np.bincount(self.leaf, leaves.t, LEAVES)
        out[_T1] = np.bincount(self.parent1, parents.t, PARENTS)
        out[_T0], out[_TYPES] = root.t.sum(), len(self.lengths)
        out[_ONCE:] = [n for v in self.levels for n in once_and_twice(v.c)]
        return out

    def round(self, totals: np.ndarray, number: int, moves: int, rng: np.random.Generator, sampled: bool) -> None:
        """One round of Gibbs; the first one seats all customers anew."""
        model, (leaves, parents, root) = Model(totals), self.levels
        p0 = model.root(root.c, root.t)
        p1 = model.parent(parents.c, parents.t, self.parent1, p0[self.word1])
        weights = (model.new2[self.leaf] * p1[self.up], model.new1[self.parent1] * p0[self.word1], np.full(len(p0), model.new0 * model.base))
        below = [leaves.c, lambda: np.bincount(self.up, leaves.t, len(self.key1)), lambda: np.bincount(self.word1, parents.t, len(p0))]
        for level, a, d, c in zip(self.levels, weights, model.d, below, strict=True):
            c = (c() if callable(c) else c).astype(np.int64)
            if number == 0:
                level.seat(c, a, d, rng)
            else:
                level.change(c, a, d, rng)
                level.gibbs(a, d, moves, rng)
        if sampled:
            self.past.append([_small(x) for v in self.levels for x in (v.c, v.t)])


class Model:
    """Predictive probabilities under the totals of one round."""

    def __init__(self, totals: np.ndarray, strength: float = STRENGTH):
        t = totals.astype(np.float64)
        # Leaves, parents, root.
        self.d = [discount(*totals[_ONCE + 2 * i : _ONCE + 2 * i + 2].tolist()) for i in range(3)]
        self.base = 1.0 / (t[_TYPES] + 1.0)
        t1 = t[_T2].reshape(PARENTS, -1).sum(1)
        self.all2, self.all1, self.all0 = strength + t[_C2], strength + t1, strength + t[_T1].sum()
        self.new2, self.new1, self.new0 = (strength + d * n for d, n in zip(self.d, (t[_T2], t[_T1], t[_T0]), strict=True))

    def root(self, c, t):
        return (c - self.d[2] * t + self.new0 * self.base) / self.all0

    def parent(self, c, t, parent, p):
        return (c - self.d[1] * t + self.new1[parent] * p) / self.all1[parent]

    def leaf(self, c, t, leaf, p):
        return (c - self.d[0] * t + self.new2[leaf] * p) / self.all2[leaf]


class Answers:
    """Mean predictive probabilities of the words of one part."""

    def __init__(self, part: Part, models: list[Model]):
        self.part, self.models = part, models
        self.ids = {w: i for i, w in enumerate(_listed(part.words, part.lengths))}
        self.count = np.concatenate((np.bincount(part.word, part.levels[0].c, len(self.ids)), [0])).astype(np.int64)
        self.key2 = part.word * LEAVES + part.leaf

    def __call__(self, words: list[bytes], each: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(training counts of the words, probabilities of the pairs)."""
        none = len(self.ids)
        ids = np.fromiter((self.ids.get(w, none) for w in words), np.int64, len(words))
        word, leaf = np.repeat(ids, each), leaf.astype(np.int64)
        row2, has2 = _find(self.key2, word * LEAVES + leaf)
        row1, has1 = _find(self.part.key1, word * PARENTS + leaf // 64)
        p = np.zeros(len(word))
        for model, (c2, t2, c1, t1, c0, t0) in zip(self.models, self.part.past, strict=True):
            held = lambda x, row, has: np.where(has, np.append(x, 0)[row], 0).astype(np.float64)
            root = model.root(np.append(c0, 0).astype(np.float64), np.append(t0, 0))[word]
            parent = model.parent(held(c1, row1, has1), held(t1, row1, has1), leaf // 64, root)
            p += model.leaf(held(c2, row2, has2), held(t2, row2, has2), leaf, parent)
        return self.count[ids], p / len(self.models)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row = np.searchsorted(keys, wanted)
    return row, np.append(keys, -1)[row] == wanted


def _by_part(rows: DataFrame) -> DataFrame:
    return rows.repartition("part").sortWithinPartitions("part", "block")


def _counted(asked: DataFrame) -> DataFrame:
    """States of the parts: exact counts, one table for each dish."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counted = None, {}

        def done() -> pa.RecordBatch:
            part = Part.merged(counted)
            return _batch(STATE, [(now, part.data(), part.totals())])

        for _, part, data in _rows(batches):
            if part != now:
                if counted:
                    yield done()
                now, counted = part, {}
            words, lengths, each, leaf, counts = _get(data)
            ends = np.cumsum(each, dtype=np.int64)
            learned = np.add.reduceat(counts.astype(np.int64), ends - each)
            for word, end, n, c in zip(_listed(words, lengths), ends.tolist(), each.tolist(), learned.tolist(), strict=True):
                if c:
                    held = counted.setdefault(word, {})
                    for k, x in zip(leaf[end - n : end].tolist(), counts[end - n : end].tolist(), strict=True):
                        if x:
                            held[k] = held.get(k, 0) + x
        if counted:
            yield done()

    return _by_part(asked).mapInArrow(build, STATE)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
    for b in batches:
        block, part, data = (b.column(c) for c in ("block", "part", "data"))
        for i in range(b.num_rows):
            yield block[i].as_py(), part[i].as_py(), data[i].as_py()


def _gibbs(state: DataFrame, totals: np.ndarray, number: int, moves: int, seed: int, sampled: bool) -> DataFrame:
    def rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, data in zip(b.column("part").to_pylist(), b.column("data"), strict=True):
                own = Part.read(data.as_py())
                own.round(totals, number, moves, np.random.default_rng([seed, part, number]), sampled)
                yield _batch(STATE, [(part, own.data(), own.totals())])

    return state.select("part", "data").mapInArrow(rounds, STATE)


def _totals(state: DataFrame) -> np.ndarray:
    """Sums over all parts: added up in the tasks, then by position."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TOTALS, np.int64)
        for b in batches:
            for t in b.column("totals"):
                total += t.values.to_numpy()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    out = np.zeros(TOTALS, np.int64)
    sums = state.select("totals").mapInArrow(added, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    for r in sums.collect():  # at most TOTALS rows
        out[r.at] = r.n
    return out


def _answered(asked: DataFrame, state: DataFrame, totals: list[np.ndarray]) -> DataFrame:
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, now, answers = [Model(t) for t in totals], None, None
        for block, part, data in _rows(batches):
            if part != now:
                now, answers = part, None
            if block < 0:
                answers = Answers(Part.read(data), models)
                continue
            if answers is None:  # no word of the part was in a training document
                nothing = Part.merged({})
                nothing.past = [[np.zeros(0, np.int64)] * 6] * len(models)
                answers = Answers(nothing, models)
            words, lengths, each, leaf, _ = _get(data)
            counts, p = answers(_listed(words, lengths), each, leaf)
            yield _batch(SHEET, [(block, part, _put(_small(counts), each, p.astype(np.float32)))])

    learned = state.select(F.lit(-1).cast("bigint").alias("block"), "part", "data")
    return _by_part(learned.unionByName(asked)).mapInArrow(answer, SHEET)


def _added(own: DataFrame, answers: DataFrame, n: int, types: int) -> DataFrame:
    """Sums by document from a block's own row and the answers of all parts."""

    def block_sums(sheet: tuple, answers: list[tuple]) -> pa.RecordBatch:
        (row, ids, held_out), sizes, steps, times, _ = sheet
        doc = np.repeat(np.arange(len(sizes)), sizes)
        pair = np.cumsum(steps, dtype=np.int64)
        joined = [np.concatenate(x) for x in zip(*answers, strict=True)] if answers else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        count = np.repeat(joined[0].astype(np.int64), joined[1])[pair]
        p = joined[2].astype(np.float64)[pair]
        add = lambda x: np.bincount(doc, x * times, len(sizes))
        base = np.log10((count + 0.5) / (n + 0.5 * (types + 1)))
        sums = [add(np.ones(len(doc))), add(count > 0), add(base), add(np.log10(p))]
        columns = [np.arange(row, row + len(ids)), pa.array(ids, pa.int64()), pa.array(held_out, pa.bool_())]
        columns += [x.round().astype(np.int64) for x in sums[:2]] + sums[2:]
        return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], [c.split()[0] for c in OUT.split(", ")])

    def to_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sheet, answers = None, None, []
        for block, _, data in _rows(batches):
            if block != now:
                if sheet:
                    yield block_sums(sheet, answers)
                now, sheet, answers = block, _get(data), []
            else:
                answers.append(_get(data))
        if sheet:
            yield block_sums(sheet, answers)

    rows = own.unionByName(answers).repartition("block").sortWithinPartitions("block", "part")
    sums = rows.mapInArrow(to_docs, OUT)
    total = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    return sums.groupBy("row", "doc_id", "held_out").agg(*total).drop("row")


def learn(
    asked: DataFrame, rounds: int = ROUNDS, samples: int = SAMPLES, moves: int = MOVES, seed: int = 13
) -> tuple[DataFrame, list[np.ndarray]]:
    """The parts after the last round, and the totals of the sampled rounds."""
    state = cut_lineage(_counted(asked))
    totals, sampled = _totals(state), []
    for number in range(rounds):
        keeps = number >= rounds - samples
        state = cut_lineage(_gibbs(state, totals, number, moves, seed, keeps))
        totals = _totals(state)
        sampled += [totals] if keeps else []
    return state.select("part", "data"), sampled


def score(
    docs: DataFrame,
    held_out: Column,
    rounds: int = ROUNDS,
    samples: int = SAMPLES,
    moves: int = MOVES,
    seed: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base_score, score, train_tokens)
    of every row; rows for which ``held_out`` holds are not learned from."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    all_sheets = cut_lineage(sheets(docs, held_out, max(1, -(-size // PART_BYTES)), id_col, text_col))
    asked, own = all_sheets.where("part >= 0"), all_sheets.where("part < 0")
    state, sampled = learn(asked, rounds, samples, moves, seed)
    n, types = int(sampled[-1][_C2].sum()), int(sampled[-1][_TYPES])
    scored = _added(own, _answered(asked, state, sampled), n, types)
    return scored.withColumn("train_tokens", F.lit(n).cast("bigint"))


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity of the held-out and the training documents, of model and base."""
    each = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(each("score").alias("perplexity"), each("base_score").alias("base_perplexity"))
