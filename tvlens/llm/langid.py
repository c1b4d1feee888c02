"""Language of documents, and of the spans of mixed-language texts.

Training counts hashed character n-grams (1 to ORDER characters, word starts
and ends marked) and the scripts of letters for every language, over all rows
given.  The counts are summed per task before the shuffle; a model is one
score per language and hash bucket, so its size is fixed by the number of
languages, not by the corpus.

A word's score for a language is the sum of its n-grams' log probabilities.
Languages in which the word's script is rare (below MIN_SCRIPT of the letters)
are no candidates for it; a word without any candidate is ``und`` with
posterior 0.  Viterbi over the other words of a text, with a penalty for
switching, labels every word; neighbours with one label form a span, which
has its letters and the sum of their posteriors (``sure``).  The document gets the label with the most letters, and as score the share of
those letters times the mean posterior of its words.

Posteriors compare the learned languages with each other: a language that was
not learned but shares a script with one that was is taken for the closest.

Everything inside a task is numpy over many words and documents at a time:
the Viterbi step t handles word t of all documents of a slice together.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0
and no spans; a text mostly in scripts of no learned language is ``und`` with
score 0 and ``und`` spans; rows with a NULL language or text don't train; ties go to the
first language by code point; without any training row every text is ``und``;
NULL or repeated ids and repeated rows give one result row each; an empty
table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvlens.llm.common import give_back, text_slices

ORDER = 3
GAP = ORDER - 1  # zeros after a word, so that no n-gram sees two words
BUCKETS = 1 << 16
SWITCH_PENALTY = 12.0
MIN_SCRIPT = 0.01
SMOOTHING = 0.2
FLOOR = -1e9
UNKNOWN = "und"
SLICE_ROWS, SLICE_BYTES = 2048, 1 << 20

# First code points of script ranges (fixed values): each range lasts to the
# next entry; script 0 is everything without a script of its own.
_RANGES = (
    (0x0000, 0), (0x0041, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6),
    (0x0700, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 9), (0x0B80, 10), (0x0C00, 11), (0x0E00, 12), (0x0E80, 0),
    (0x10A0, 13), (0x1100, 14), (0x1200, 15), (0x1380, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 16),
    (0x30A0, 17), (0x3100, 0), (0x3400, 18), (0xA000, 0), (0xAC00, 14), (0xD7B0, 0), (0xF900, 18), (0xFB00, 0),
    (0x20000, 18), (0x32000, 0),
)
N_SCRIPTS = 19
_STARTS = np.array([a for a, _ in _RANGES], np.int32)
_SCRIPT_OF = np.array([s for _, s in _RANGES], np.int8)
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # (BUCKETS, languages)
    allowed: np.ndarray  # (N_SCRIPTS, languages)


_TABLES: list[tuple[np.ndarray, np.ndarray]] = []
_TOP = 0x32000  # no letters from here on


def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point below _TOP: whether it is a letter, and its lower case."""
    if not _TABLES:
        chars = [chr(c) for c in range(_TOP)]
        is_letter = np.array([unicodedata.category(c)[0] == "L" for c in chars])
        lower = np.array([ord(x) if len(x := c.lower()) == 1 else ord(c) for c in chars], np.uint32)
        _TABLES.append((is_letter, lower))
    return _TABLES[0]


@dataclass
class Words:
    """Maximal runs of letters of several texts, one after the other."""

    codes: np.ndarray  # lower-cased code points of all words, GAP zeros after each
    start: np.ndarray  # of each word in codes
    size: np.ndarray  # letters of each word
    doc: np.ndarray  # text of each word
    at: np.ndarray  # offset of each word in its text


def find_words(texts: list[str]) -> Words:
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = "\n".join(texts) + "\n"
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    raw = np.minimum(raw, _TOP - 1)
    is_letter, lower = tables()
    is_letter = is_letter[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], is_letter, [False])).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    base = np.cumsum(lengths + 1) - (lengths + 1)
    doc = np.searchsorted(base, begin, side="right") - 1
    size = end - begin
    start = np.cumsum(size + GAP) - (size + GAP)
    out = np.zeros(int((size + GAP).sum()), np.uint32)
    keep = np.repeat(begin - start, size) + _ramp(start, size)
    out[_ramp(start, size)] = lower[raw[keep]]
    return Words(out, start, size, doc, begin - base[doc])


def _ramp(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for size[0] entries, then the next run."""
    total = int(size.sum())
    first = np.repeat(start - (np.cumsum(size) - size), size)
    return first + np.arange(total)


def gram_buckets(words: Words) -> Iterator[np.ndarray]:
    """For each order the bucket of the n-gram that ends at each position of
    ``codes`` (gaps count as characters: they mark word starts and ends)."""
    c = words.codes.astype(np.uint64)
    h = np.zeros(len(c), np.uint64)
    for n in range(1, ORDER + 1):
        back = np.zeros(len(c), np.uint64)
        back[n - 1 :] = c[: len(c) - n + 1] if n > 1 else c
        h = h + (back + np.uint64(n)) * np.uint64(_MULTIPLIERS[n - 1])
        mixed = (h ^ (h >> np.uint64(15))) * np.uint64(0x2545F4914F6CDD1D)
        yield (mixed >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)


def word_script(words: Words) -> np.ndarray:
    """Script of each word's first letter."""
    first = words.codes[words.start].astype(np.int32)
    return _SCRIPT_OF[np.searchsorted(_STARTS, first, side="right") - 1]


def train(rows: DataFrame, text_col: str, lang_col: str) -> Model:
    """Learn from all rows with a text and a language."""
    schema = "lang string, kind int, bucket int, n bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for b in text_slices(batches, "text", SLICE_ROWS, SLICE_BYTES):
            lang = np.array(b.column("lang").to_pylist(), object)
            texts = b.column("text").to_pylist()
            for name in dict.fromkeys(lang.tolist()):
                words = find_words([texts[i] for i in np.flatnonzero(lang == name)])
                own = grams.setdefault(name, np.zeros(BUCKETS, np.int64))
                for g in gram_buckets(words):
                    own += np.bincount(g, minlength=BUCKETS)
                seen = scripts.setdefault(name, np.zeros(N_SCRIPTS, np.int64))
                seen += np.bincount(word_script(words), words.size, N_SCRIPTS).astype(np.int64)
        give_back()
        for kind, held in enumerate((grams, scripts)):
            for name, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(at), pa.string()),
                        pa.array(np.full(len(at), kind), pa.int32()),
                        pa.array(at, pa.int32()),
                        pa.array(counts[at], pa.int64()),
                    ],
                    ["lang", "kind", "bucket", "n"],
                )

    labelled = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    sums = labelled.mapInArrow(count, schema).groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n"))
    table = sums.toPandas()  # at most BUCKETS + N_SCRIPTS rows a language
    languages = sorted(table["lang"].unique())
    code = table["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)
    grams, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((N_SCRIPTS, len(languages)))
    for kind, held in enumerate((grams, scripts)):
        own = (table["kind"] == kind).to_numpy()
        held[table["bucket"].to_numpy()[own], code[own]] = table["n"].to_numpy()[own]
    scores = np.log((grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * BUCKETS))
    allowed = scripts >= MIN_SCRIPT * np.maximum(scripts.sum(axis=0), 1)
    return Model(languages, scores.astype(np.float32), allowed)


def score_words(words: Words, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(words, languages): log scores, and which words have a candidate.
    Scores are relative to the best candidate of the word's script; the other
    languages get a floor that no candidate reaches, however long the word.  A
    word without any candidate has the floor for all, so it scores 0 for all and
    moves no neighbour."""
    total = np.zeros((len(words.codes), len(model.languages)), np.float32)
    for g in gram_buckets(words):
        total += model.scores[g]
    out = np.add.reduceat(total, words.start, axis=0) if len(words.start) else total[:0]
    ok = model.allowed[word_script(words)]
    known = ok.any(axis=1)
    np.copyto(out, FLOOR, where=~ok)
    out -= out.max(axis=1, keepdims=True, initial=2 * FLOOR)
    return out, known


def viterbi(scores: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Best label of every word; the words of a document are in order.

    With one penalty for any switch, the best way into a label is either to
    stay or to come from the overall best label, so a step costs as much as
    there are labels.  Documents are handled together, longest first.
    """
    count = np.bincount(doc, minlength=n_docs)
    order = np.argsort(-count, kind="stable")
    begin = (np.cumsum(count) - count)[order]
    count = count[order]
    labels = np.zeros(len(scores), np.int16)
    if not len(scores):
        return labels
    came = np.zeros(scores.shape, bool)  # whether the best way in is a switch
    best_before = np.zeros(len(scores), np.int16)
    active = np.searchsorted(-count, -np.arange(1, count[0] + 1), side="right")
    state = scores[begin[: active[0]]].copy()
    for t in range(1, count[0]):
        k = active[t]
        state = state[:k]
        top = state.argmax(axis=1)
        jump = state[np.arange(k), top] - SWITCH_PENALTY
        here = begin[:k] + t
        best_before[here] = top
        switch = jump[:, None] > state
        came[here] = switch
        state = np.where(switch, jump[:, None], state) + scores[here]
        state -= state.max(axis=1, keepdims=True)
        finished = slice(active[t + 1] if t + 1 < count[0] else 0, k)
        labels[here[finished]] = state[finished].argmax(axis=1)
    once = count == 1
    labels[begin[once]] = scores[begin[once]].argmax(axis=1)
    for t in range(count[0] - 1, 0, -1):
        here = begin[: active[t]] + t
        own = labels[here]
        labels[here - 1] = np.where(came[here, own], best_before[here], own)
    return labels


def _posteriors(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def label_slice(texts: list[str], model: Model) -> tuple[list[str], list[float], list[list[dict]]]:
    """Language, score and spans of each text."""
    n, names = len(texts), [*model.languages, UNKNOWN]
    words = find_words(texts)
    if not len(words.start) or not model.languages:
        return [UNKNOWN] * n, [0.0] * n, [[] for _ in texts]
    scores, known = score_words(words, model)
    found = viterbi(scores, words.doc, n)
    posterior = _posteriors(scores)[np.arange(len(found)), found] * known
    labels = np.where(known, found, len(names) - 1)
    letters_by = np.bincount(words.doc * len(names) + labels, words.size, n * len(names)).reshape(n, -1)
    winner, total = letters_by.argmax(axis=1), letters_by.sum(axis=1)
    own = labels == winner[words.doc]
    score = np.bincount(words.doc, posterior * own * words.size, n) / np.maximum(total, 1)
    langs = [names[w] if t else UNKNOWN for w, t in zip(winner, total, strict=True)]
    first = np.flatnonzero(np.concatenate(([True], (words.doc[1:] != words.doc[:-1]) | (labels[1:] != labels[:-1]))))
    last = np.concatenate((first[1:], [len(labels)])) - 1
    letters = np.add.reduceat(words.size, first)
    sure = np.add.reduceat(words.size * posterior, first)
    spans: list[list[dict]] = [[] for _ in texts]
    ends = words.at + words.size
    columns = (words.doc[first], words.at[first], ends[last], labels[first], letters, sure)
    for d, s, e, k, m, c in zip(*(x.tolist() for x in columns), strict=True):
        spans[d].append({"start": s, "end": e, "lang": names[k], "letters": m, "sure": c})
    return langs, np.clip(score, 0, 1).tolist(), spans


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *keep: Column) -> DataFrame:
    """(doc_id, lang_pred, score, spans), one row per input row; further
    columns to keep may be given as expressions with own names."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string()), ("letters", pa.int64()), ("sure", pa.float64())])
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text", SLICE_ROWS, SLICE_BYTES):
            langs, scores, spans = label_slice(b.column("text").to_pylist(), model)
            more = b.schema.names[2:]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[b.column(m) for m in more], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))],
                ["doc_id", *more, "lang_pred", "score", "spans"],
            )
        give_back()

    only = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *keep)
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in only.schema.fields if f.name != "text")
    return only.mapInArrow(label, f"{out}, lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string,letters:bigint,sure:double>>")
