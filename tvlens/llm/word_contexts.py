"""Language-model scores of a hierarchical Pitman-Yor process over whole words.

The bigram model of Teh (2006): the restaurant of a token is the whole word
before it (the empty word at the start of a text), every word has its own one.
Every table there is a customer of the root, the restaurant without a context,
whose base is uniform over the V training types and one more for all unknown
words.  A word that was no context in training has an empty restaurant, which
answers as the root does.

Seating is sampled by Gibbs as in pitman_yor.py: sequential first seating, then
rounds in which random customers leave and sit down again (restaurants.py);
totals and root probabilities are those of the round before, so all dishes
move at once.  The last ``SAMPLES`` rounds give a predictive probability each,
their mean is the score's; each sums to 1 in every context.

1. Texts are read in blocks.  A block lists its distinct (word, word before)
   pairs with their training counts, dealt to parts by the word's hash, and
   its documents as pairs and times.  Both are checkpointed.
2. A part merges the pairs of all blocks: exact counts of whole words.
3. The number of restaurants grows with the vocabulary, so their totals never
   meet in one place: a part sends its tables by context to the part at which
   the context's word is at home; that part adds them up and replies.  After
   it a round of Gibbs runs over the parts; its state is checkpointed.
4. Parts answer every block: of each pair its customers and tables, and of
   each word its root probability, the customers of its restaurant and the
   weight that this leaves to the root.  Blocks put these together (small
   integers travel, not probabilities) and add them up by document.

Counting and answering (2, 4) take the parts in turns; a checkpoint that is
replaced, and the shuffle files behind a checkpoint, are deleted at once.

Words as contexts travel as their XXH64; two training words with one hash have
one home, which raises an error, so no two restaurants are ever mixed up.  Only
eight sums go through the driver.  ``base_score`` is the additive unigram score
with the same counts.  Defined cases: see pitman_yor.py.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvlens.llm.common import cut_and_tidy, discard, give_back
from tvlens.llm.pitman_yor import MOVES, OUT, ROUNDS, SAMPLES, SHEET, STRENGTH, _batch, _by_part, _find, _get, _listed, _put, _rows, _small, sheets, word_tokens
from tvlens.llm.restaurants import Level, discount, once_and_twice

PART_BYTES = 24 << 20  # of text, for each part
TURNS, TURN_PARTS = 4, 8  # turns at most; parts that make a further turn worth while
MERGE_ROWS = 1 << 21  # pairs that a part takes in before it adds up equal ones
#: Rows of a part, of the totals of the contexts at home in it; others are dealt.
PART, HOME = -3, -2
STATE = f"{SHEET}, totals array<bigint>"
TOTALS = 8


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _gaps(names: np.ndarray) -> np.ndarray:
    """Hashes as steps from one to the next, which are short where they are in order."""
    return np.diff(names, prepend=np.uint64(0))


def _named(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(gaps, dtype=np.uint64)


def _steps(x: np.ndarray, each: np.ndarray) -> np.ndarray:
    """Rising numbers in groups of ``each`` as a first one and the steps from it."""
    out, starts = np.diff(x, prepend=0), (np.cumsum(each) - each)[each > 0]
    out[starts] = x[starts]
    return out


def _stepped(steps: np.ndarray, each: np.ndarray) -> np.ndarray:
    each = each[each > 0].astype(np.int64)
    x, starts = np.cumsum(steps, dtype=np.int64), np.cumsum(each) - each
    return x - np.repeat(x[starts] - steps[starts], each)


def block_sheets(
    block: int, texts: pa.Array, meta: tuple, train: np.ndarray, parts: int, before: bytes = b"", ended: bool = True
) -> Iterator[tuple]:
    """The rows of one block of documents, or of a piece of one.

    ``before`` is the word before the piece; ``ended`` says that the text ends."""
    words, token, doc = word_tokens(texts)
    n = len(texts)
    if before and before not in words:
        words.append(before)
    # The end is the empty word; so is, as a context, the start.
    words.append(b"")
    name = hashes(words)
    home = (name % np.uint64(parts)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    start = words.index(before)
    first = np.concatenate(([True], doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, bool)
    context = np.where(first, start, np.concatenate(([0], token[:-1]))) if len(doc) else doc
    if ended:
        last = np.full(n, start)
        final = np.flatnonzero(np.concatenate((doc[1:] != doc[:-1], [True]))) if len(doc) else np.zeros(0, np.int64)
        last[doc[final]] = token[final]
        token = np.concatenate((token, np.full(n, len(words) - 1)))
        doc, context = np.concatenate((doc, np.arange(n))), np.concatenate((context, last))
    pair, at = np.unique(rank[token] * len(words) + rank[context], return_inverse=True)
    counts = np.bincount(at, weights=train[doc], minlength=len(pair)).astype(np.int64)
    bag, times = np.unique(doc * len(pair) + at, return_counts=True)
    word, context = pair // len(words), pair % len(words)
    each, name = np.bincount(word, minlength=len(words)), name[order]
    words_to = np.searchsorted(home[order], np.arange(parts + 1))
    pairs_to = np.concatenate(([0], np.cumsum(each)))[words_to]
    for q in np.flatnonzero(np.diff(words_to)).tolist():
        own, held = slice(pairs_to[q], pairs_to[q + 1]), slice(words_to[q], words_to[q + 1])
        asked = [words[i] for i in order[held]]
        lengths = np.fromiter(map(len, asked), np.uint32, len(asked))
        used, which = np.unique(name[context[own]], return_inverse=True)
        yield block, q, _put(b"".join(asked), lengths, _small(each[held]), _gaps(used), _small(which), _small(counts[own]))
    steps = np.diff(np.concatenate(([0], bag % max(len(pair), 1))))  # within a document: gaps
    sizes = np.bincount(bag // max(len(pair), 1), minlength=n)
    yield block, -1, _put(meta, sizes.astype(np.uint32), steps.astype(np.int32), _small(times), _small(each), _small(_steps(context, each)))


def _summed(word: np.ndarray, name: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs in order, each once with its sum."""
    names, at = np.unique(name, return_inverse=True)
    pair, at = np.unique(word * len(names) + at, return_inverse=True)
    return pair // max(1, len(names)), names[pair % max(1, len(names))], np.bincount(at, c, len(pair)).astype(np.int64)


class Part:
    """The seating of all words of a part.

    A pair is a ``word`` in the restaurant ``context``, which is a number in
    ``names``: the contexts' hashes, by the part at which they are at home.
    ``past``: of each sample the tables of the pairs, the words' customers and
    tables in the root and the tables of the contexts at ``home``; ``home_c``:
    the customers of these."""

    def __init__(self, words, lengths, names, word, context, home, home_c, past, levels):
        self.words, self.lengths, self.names, self.word, self.context = words, lengths, names, word, context
        self.home, self.home_c, self.past, self.levels = home, home_c, past, levels

    @classmethod
    def merged(cls, listed: list[bytes], word: np.ndarray, name: np.ndarray, c: np.ndarray, parts: int) -> Part:
        own = np.sort(hashes(listed))
        if (own[1:] == own[:-1]).any():
            raise RuntimeError("two training words have one hash: their restaurants would be one")
        sorted_ = np.array(sorted(range(len(listed)), key=listed.__getitem__), np.int64)
        place = np.empty(len(sorted_), np.int64)
        place[sorted_] = np.arange(len(sorted_))
        names, context = np.unique(name, return_inverse=True)
        by_home = np.argsort(names % np.uint64(parts), kind="stable")
        rank = np.empty(len(names), np.int64)
        rank[by_home] = np.arange(len(names))
        word, context = place[word], rank[context]
        order = np.argsort(word * len(names) + context)
        word, context, c = word[order], context[order], c[order]
        leaves = Level(c)
        levels = [leaves, Level(np.bincount(word, leaves.t, len(listed)))]
        texts = [listed[i] for i in sorted_.tolist()]
        lengths = np.fromiter(map(len, texts), np.uint32, len(texts))
        return cls(b"".join(texts), lengths, names[by_home], word, context, np.zeros(0, np.uint64), np.zeros(0, np.uint8), [], levels)

    def data(self) -> bytes:
        """Rows of tables and words go in as steps, 0 or 1 mostly."""
        tables = [x for v in self.levels for x in (_small(v.c), _small(np.diff(v.row, prepend=0)), _small(v.size))]
        past = [x for p in self.past for x in p]
        names = _gaps(self.names), _small(np.diff(self.word, prepend=0)), _small(self.context), _gaps(self.home)
        return _put(self.words, _small(self.lengths), *names, self.home_c, *tables, *past)

    @classmethod
    def read(cls, data: bytes) -> Part:
        words, lengths, names, word, context, home, home_c, *rest = _get(data)
        c, row, size = ([x.astype(np.int64) for x in rest[i:6:3]] for i in range(3))
        levels = [Level(c[i], np.cumsum(row[i]), size[i]) for i in range(2)]
        past = [rest[i : i + 4] for i in range(6, len(rest), 4)]
        word, context = np.cumsum(word, dtype=np.int64), context.astype(np.int64)
        return cls(words, lengths.astype(np.uint32), _named(names), word, context, _named(home), home_c, past, levels)

    def row(self, number: int) -> tuple:
        leaves, root = self.levels
        totals = [leaves.c.sum(), root.c.sum(), root.t.sum(), len(self.lengths), *once_and_twice(leaves.c), *once_and_twice(root.c)]
        return PART, number, self.data(), [int(x) for x in totals]

    def sent(self, number: int, parts: int) -> Iterator[tuple]:
        """Customers and tables by context, to the parts these are at home in."""
        leaves = self.levels[0]
        c, t = (np.bincount(self.context, x, len(self.names)).astype(np.int64) for x in (leaves.c, leaves.t))
        to = np.searchsorted(self.names % np.uint64(parts), np.arange(parts + 1, dtype=np.uint64))
        for q in np.flatnonzero(np.diff(to)).tolist():
            own = slice(to[q], to[q + 1])
            yield number, q, _put(_gaps(self.names[own]), _small(c[own]), _small(t[own])), None

    def sample(self, home: list) -> None:
        """Keep what predictions need; ``home``: totals of the contexts at home."""
        leaves, root = self.levels
        names, self.home_c, t = home
        self.home = _named(names)
        self.past.append([_small(leaves.t), _small(root.c), _small(root.t), t])

    def round(self, model: Model, t: np.ndarray, first: bool, moves: int, rng: np.random.Generator) -> None:
        """One round of Gibbs; the first one seats all customers anew."""
        leaves, root = self.levels
        p0 = model.root(root.c, root.t)
        a = (STRENGTH + model.d[0] * t)[self.context] * p0[self.word]
        if first:
            leaves.seat(leaves.c, a, model.d[0], rng)
        else:
            leaves.gibbs(a, model.d[0], moves, rng)
        c = np.bincount(self.word, leaves.t, len(p0)).astype(np.int64)
        a = np.full(len(p0), model.new0 * model.base)
        if first:
            root.seat(c, a, model.d[1], rng)
        else:
            root.change(c, a, model.d[1], rng)
            root.gibbs(a, model.d[1], moves, rng)


class Model:
    """Predictive probabilities under the totals of one round."""

    def __init__(self, totals: list[int]):
        self.n, customers, tables, self.types = totals[:4]
        self.d = [discount(*totals[4:6]), discount(*totals[6:8])]  # words as contexts, root
        self.base = 1.0 / (self.types + 1.0)
        self.all0, self.new0 = STRENGTH + customers, STRENGTH + self.d[1] * tables

    def root(self, c, t):
        return (c - self.d[1] * t + self.new0 * self.base) / self.all0

    def left(self, c, t):
        """What restaurants of c customers at t tables leave to the root."""
        return (STRENGTH + self.d[0] * t) / (STRENGTH + c)


def _counted(asked: DataFrame, parts: int) -> DataFrame:
    """Parts with exact counts, one table for each dish."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, held, rows = None, {}, [], 0

        def done() -> Iterator[pa.RecordBatch]:
            if ids:
                part = Part.merged(list(ids), *_summed(*map(np.concatenate, zip(*held, strict=True))), parts)
                yield _batch(STATE, [part.row(now)])
                for sent in part.sent(now, parts):
                    yield _batch(STATE, [sent])

        for _, part, data in _rows(batches):
            if part != now:
                yield from done()
                now, ids, held, rows = part, {}, [], 0
            words, lengths, each, names, which, counts = _get(data)
            counts, owner = counts.astype(np.int64), np.repeat(np.arange(len(each)), each)
            learned = np.bincount(owner, counts, len(each))
            number = np.fromiter((ids.setdefault(w, len(ids)) if c else -1 for w, c in zip(_listed(words, lengths), learned.tolist(), strict=True)), np.int64, len(each))
            real = counts > 0
            held.append((number[owner[real]], _named(names)[which[real]], counts[real]))
            rows += int(real.sum())
            if rows > MERGE_ROWS:
                held = [_summed(*map(np.concatenate, zip(*held, strict=True)))]
                rows = 0
        yield from done()
        give_back()

    return _by_part(asked).mapInArrow(build, STATE)


def _replied(state: DataFrame) -> DataFrame:
    """Totals of the contexts: to the parts that sent some, and to the home itself."""

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if asked:
                senders, names, c, t = zip(*asked, strict=True)
                all_names, at = np.unique(np.concatenate(names), return_inverse=True)
                c, t = (np.bincount(at, np.concatenate(x)).astype(np.int64) for x in (c, t))
                yield _batch(SHEET, [(HOME, now, _put(_gaps(all_names), _small(c), _small(t)))])
                to = np.cumsum([0, *map(len, names)])
                for sender, a, b in zip(senders, to[:-1], to[1:], strict=True):
                    yield _batch(SHEET, [(now, sender, _put(_small(t[at[a:b]])))])

        for sender, part, data in _rows(batches):
            if part != now:
                yield from done()
                now, asked = part, []
            names, c, t = _get(data)
            asked.append((sender, _named(names), c, t))
        yield from done()

    return _by_part(state.where("block >= 0").select("block", "part", "data")).mapInArrow(reply, SHEET)


def _moved(state: DataFrame, model: Model, parts: int, number: int, rounds: int, samples: int, moves: int, seed: int) -> DataFrame:
    """The parts after their totals came back: sampled, and after one more round of Gibbs."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, home, totals = None, None, None, []

        def done() -> Iterator[pa.RecordBatch]:
            if part is None:
                return
            if number > rounds - samples:
                part.sample(home)
            if number < rounds:
                part.round(model, np.concatenate(totals).astype(np.int64), number == 0, moves, np.random.default_rng([seed, now, number]))
            yield _batch(STATE, [part.row(now)])
            if number < rounds:
                for sent in part.sent(now, parts):
                    yield _batch(STATE, [sent])

        for block, q, data in _rows(batches):
            if block == PART:
                yield from done()
                now, part, totals = q, Part.read(data), []
            elif block == HOME:
                home = _get(data)
            else:
                totals += _get(data)
        yield from done()
        give_back()

    held = state.where(f"block = {PART}").select("block", "part", "data")
    return _by_part(held.unionByName(_replied(state))).mapInArrow(move, STATE)


def _in_turns(made: Callable[[Column], DataFrame], parts: int) -> list[DataFrame]:
    """What ``made`` gives for all parts, some of them at a time: the shuffle
    files of one turn are gone before those of the next are written."""
    turns = min(TURNS, -(-parts // TURN_PARTS))
    return [cut_and_tidy(made(F.col("part") % turns == turn)) for turn in range(turns)]


def _totals(state: DataFrame) -> list[int]:
    sums = [F.sum(F.get("totals", F.lit(i))).alias(f"t{i}") for i in range(TOTALS)]
    return [x or 0 for x in state.where(f"block = {PART}").agg(*sums).first()]


def learn(
    asked: DataFrame, parts: int, rounds: int = ROUNDS, samples: int = SAMPLES, moves: int = MOVES, seed: int = 13
) -> tuple[DataFrame, list[Model]]:
    """The parts after the last round, and the models of the sampled rounds."""
    cut = _in_turns(lambda turn: _counted(asked.where(turn), parts), parts)
    state = reduce(DataFrame.unionByName, cut)
    models = [Model(_totals(state))]
    for number in range(rounds + 1):
        state = cut_and_tidy(_moved(state, models[-1], parts, number, rounds, samples, moves, seed))
        discard(*cut)
        cut = [state]
        if number < rounds:
            models.append(Model(_totals(state)))
    return state, models[len(models) - samples :]


class Answers:
    """What a part knows of the words and pairs of a block."""

    def __init__(self, part: Part | None, samples: int):
        none = np.zeros(0, np.int64)
        self.part = part = part or Part(b"", none, none.astype(np.uint64), none, none, none.astype(np.uint64), none, [[none] * 4] * samples, [Level(none)] * 2)
        self.ids = {w: i for i, w in enumerate(_listed(part.words, part.lengths))}
        self.count = np.append(np.bincount(part.word, part.levels[0].c, len(self.ids)), 0).astype(np.int64)
        self.by_name = np.argsort(part.names, kind="stable")
        self.key = part.word * (len(part.names) + 1) + part.context

    def __call__(self, words: list[bytes], each: np.ndarray, names: np.ndarray, which: np.ndarray) -> list[np.ndarray]:
        """Training counts of the words and customers of their restaurants,
        customers of the pairs, and for each sample the tables of the pairs,
        the words' customers and tables in the root and the tables of their
        restaurants."""
        ids = np.fromiter((self.ids.get(w, len(self.ids)) for w in words), np.int64, len(words))
        row, known = _find_names(self.part.names[self.by_name], _named(names))
        context = np.where(known, np.append(self.by_name, 0)[row], len(self.part.names))
        at, seen = _find(self.key, np.repeat(ids, each) * (len(self.part.names) + 1) + context[which])
        home, here = _find_names(self.part.home, hashes(words))
        home = np.where(here, home, len(self.part.home))
        of = lambda x, row: _small(np.append(x, 0).astype(np.int64)[row])
        held = lambda x: _small(np.where(seen, np.append(x, 0)[at], 0))
        out = [_small(self.count[ids]), of(self.part.home_c, home), held(self.part.levels[0].c)]
        for t, c0, t0, home_t in self.part.past:
            out += [held(t), of(c0, ids), of(t0, ids), of(home_t, home)]
        return out


def _find_names(names: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row = np.searchsorted(names, wanted)
    return row, (row < len(names)) & (np.append(names, np.uint64(0))[row] == wanted)


def _answered(asked: DataFrame, state: DataFrame, samples: int) -> DataFrame:
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, answers = None, None
        for block, part, data in _rows(batches):
            if part != now:
                # Without a row of its own, no word of the part was in a training document.
                now, answers = part, Answers(Part.read(data) if block == PART else None, samples)
            if block != PART:
                words, lengths, each, names, which, _ = _get(data)
                yield _batch(SHEET, [(block, part, _put(*answers(_listed(words, lengths), each, names, which)))])
        give_back()

    return _by_part(state.select("block", "part", "data").unionByName(asked)).mapInArrow(answer, SHEET)


def _single(x: np.ndarray) -> np.ndarray:
    """Probabilities in single precision, as the scores are defined."""
    return x.astype(np.float32).astype(np.float64)


def _added(own: DataFrame, answers: DataFrame, models: list[Model]) -> DataFrame:
    """Sums by document from a block's own row and the answers of all parts."""
    n, types = models[-1].n, models[-1].types

    def block_sums(sheet: list, answers: list[list]) -> pa.RecordBatch:
        (row, ids, held_out), sizes, steps, times, each, context = sheet
        context = _stepped(context, each)
        count, inside, c, *samples = (np.concatenate(x).astype(np.float64) for x in zip(*answers, strict=True))
        word, p = np.repeat(np.arange(len(each)), each), np.zeros(len(context))
        for model, t, c0, t0, home_t in zip(models, *(samples[i::4] for i in range(4)), strict=True):
            root, left = _single(model.root(c0, t0)), _single(model.left(inside, home_t))
            p += (c - model.d[0] * t) / (STRENGTH + inside[context]) + left[context] * root[word]
        p = np.log10(p / len(models))
        count = count[word]
        base = np.log10((count + 0.5) / (n + 0.5 * (types + 1)))
        doc, pair = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(steps, dtype=np.int64)
        add = lambda x: np.bincount(doc, x * times, len(sizes))
        sums = [add(np.ones(len(doc))), add((count > 0)[pair]), add(base[pair]), add(p[pair])]
        columns = [pa.array(np.arange(row, row + len(ids))), pa.array(ids, pa.int64()), pa.array(held_out, pa.bool_())]
        columns += [pa.array(x.round().astype(np.int64)) for x in sums[:2]] + [pa.array(x) for x in sums[2:]]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in OUT.split(", ")])

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
        give_back()

    rows = own.unionByName(answers).repartition("block").sortWithinPartitions("block", "part")
    sums = rows.mapInArrow(to_docs, OUT)
    total = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    return sums.groupBy("row", "doc_id", "held_out").agg(*total).drop("row")


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
    parts = max(1, -(-size // PART_BYTES))
    all_sheets = cut_and_tidy(sheets(docs, held_out, parts, id_col, text_col, block_sheets))
    asked, own = all_sheets.where("part >= 0"), all_sheets.where("part < 0")
    state, models = learn(asked, parts, rounds, samples, moves, seed)
    answers = _in_turns(lambda turn: _answered(asked.where(turn), state.where(turn), samples), parts)
    discard(state)
    scored = _added(own, reduce(DataFrame.unionByName, answers), models)
    return scored.withColumn("train_tokens", F.lit(models[-1].n).cast("bigint"))
