"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is good or bad.  Its features describe the line itself
(length, symbols, capitals, digits, repeated words, ...) and its neighbours'
most telling features; transition weights tie neighbouring labels.  Training
gives each line its document's label (the only labels there are) and maximises
the regularised likelihood of the label sequences.  A document's score is the
mean of its lines' forward-backward marginals for "good", weighted by length,
sharpened to a probability by a logistic curve fitted on the same rows.

Training is bounded: at most ``train_docs`` labelled documents (those with the
smallest hash of the id), each of at most ``train_lines`` lines.  Scoring
reads whole texts; lines are handled as numpy arrays over many documents.

Defined cases: NULL, empty and blank texts count as one empty line and get a
score like any other; rows without a label, with a NULL id or NULL label don't
train, and a document with several labels trains on their mean, rounded; with
no label or only one kind the score is the share of good labels (0.5 without
any); NULL or repeated ids and repeated rows give one result row each; an
empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvlens.llm.common import text_slices

TRAIN_DOCS, TRAIN_LINES = 4000, 200
SLICE_ROWS, SLICE_BYTES = 4096, 8 << 20
ROUNDS, RATE, RIDGE = 150, 0.1, 1e-3

_SPACES = bytes([9, 10, 11, 12, 13, 32])
#: Character classes by UTF-8 byte (fixed values).
_CLASSES = (_SPACES, b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b".,;:", bytes(range(128, 256)))
_MARKS = [np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(c, np.uint8)) for c in _CLASSES]
N_OWN, N_TOLD = 12, 5  # features of the line, and how many of them neighbours see
N_FEATURES = N_OWN + 2 * N_TOLD + 1


@dataclass
class Model:
    weights: np.ndarray  # (N_FEATURES,)
    moves: np.ndarray  # (2, 2) transition weights, from and to; 1 is good
    curve: tuple[float, float]  # logistic over the logit of the mean marginal
    constant: float | None = None  # the score of everything, if labels gave no model


@dataclass
class Lines:
    features: np.ndarray  # (lines, N_FEATURES)
    weight: np.ndarray  # length of each line
    doc: np.ndarray  # document of each line, ascending


def line_features(texts: list[bytes]) -> Lines:
    """Lines with a word of each text; a text without any has one empty line."""
    joined = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(joined, np.uint8)
    end = np.flatnonzero(raw == 10)
    start = np.concatenate(([0], end[:-1] + 1))
    last = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    doc = np.searchsorted(last, end)
    count = []
    for mark in _MARKS:
        run = np.concatenate(([0], np.cumsum(mark[raw], dtype=np.int64)))
        count.append(run[end] - run[start])
    n = end - start
    filled = count[0] < n
    has = np.bincount(doc[filled], minlength=len(texts)) > 0
    first = np.concatenate(([True], doc[1:] != doc[:-1]))
    keep = np.flatnonzero(filled | (first & ~has[doc]))
    start, end, doc, n, filled = start[keep], end[keep], doc[keep], n[keep], filled[keep]
    spaces, symbols, capitals, digits, shouts, stops, wide = (c[keep] for c in count)
    words, distinct, seen_before, dotted = (np.zeros(len(keep)) for _ in range(4))
    seen: set[bytes] = set()
    at = -1
    for i, (s, e, d) in enumerate(zip(start.tolist(), end.tolist(), doc.tolist(), strict=True)):
        if d != at:
            at, seen = d, set()
        line = joined[s:e]
        own = line.split()
        words[i], distinct[i] = len(own), len(set(own))
        seen_before[i] = line in seen
        dotted[i] = line.endswith(b".")
        seen.add(line)
    some = np.maximum(n - spaces, 1)
    w = np.maximum(words, 1)
    own = np.column_stack(
        [
            np.minimum(10 * symbols / some, 3),
            np.minimum(2 * capitals / some, 2),
            np.minimum(10 * shouts / some, 3),
            1 - distinct / w,
            seen_before,
            np.minimum(5 * digits / some, 3),
            np.minimum(10 * stops / some, 3),
            wide / some,
            np.log1p(n) / 5,
            np.log1p(words) / 5,
            np.minimum(some / w, 30) / 10,
            dotted,
        ]
    )
    told = own[:, :N_TOLD]
    same_doc = doc[1:] == doc[:-1]
    before, after = np.zeros_like(told), np.zeros_like(told)
    before[1:][same_doc] = told[:-1][same_doc]
    after[:-1][same_doc] = told[1:][same_doc]
    features = np.column_stack([own, before, after, np.ones(len(own))])
    return Lines(features, np.maximum(n, 1).astype(float), doc)


@dataclass
class Chains:
    """Lines by step: step t holds line t of every document that has one."""

    steps: list[np.ndarray]

    @staticmethod
    def of(doc: np.ndarray, n_docs: int) -> Chains:
        count = np.bincount(doc, minlength=n_docs)
        order = np.argsort(-count, kind="stable")
        begin, count = (np.cumsum(count) - count)[order], count[order]
        top = int(count[0]) if n_docs else 0
        active = np.searchsorted(-count, -np.arange(1, top + 1), side="right")
        return Chains([begin[:k] + t for t, k in enumerate(active.tolist())])


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def marginals(good: np.ndarray, moves: np.ndarray, chains: Chains) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of every line, expected transitions, and the log partition sum."""
    unary = np.column_stack([np.zeros(len(good)), good])
    ahead, behind = unary.copy(), np.zeros_like(unary)
    steps = chains.steps
    for t in range(1, len(steps)):
        here = steps[t]
        ahead[here] += _lse(ahead[here - 1][:, :, None] + moves[None], 1)
    for t in range(len(steps) - 1, 0, -1):
        here = steps[t]
        behind[here - 1] = _lse(moves[None] + (unary[here] + behind[here])[:, None, :], 2)
    joint = ahead + behind
    total = _lse(joint, 1)
    p = np.exp(joint[:, 1] - total)
    expected = np.zeros((2, 2))
    for here in steps[1:]:
        pair = ahead[here - 1][:, :, None] + moves[None] + (unary[here] + behind[here])[:, None, :]
        expected += np.exp(pair - total[here][:, None, None]).sum(axis=0)
    return p, expected, float(total[steps[0]].sum()) if steps else 0.0


def fit(lines: Lines, label: np.ndarray) -> Model:
    """Train on lines of documents with labels 0 / 1 (by document number)."""
    if len(set(label.tolist())) < 2:
        return Model(np.zeros(N_FEATURES), np.zeros((2, 2)), (1.0, 0.0), float(label.mean()) if len(label) else 0.5)
    y = label[lines.doc].astype(float)
    chains = Chains.of(lines.doc, len(label))
    observed = np.zeros((2, 2))
    for here in chains.steps[1:]:
        np.add.at(observed, (y[here - 1].astype(int), y[here].astype(int)), 1)
    w, moves = np.zeros(N_FEATURES), np.zeros((2, 2))
    first, second = [np.zeros(N_FEATURES + 4) for _ in range(2)]
    for step in range(1, ROUNDS + 1):
        p, expected, _ = marginals(lines.features @ w, moves, chains)
        slope = np.concatenate((lines.features.T @ (y - p), (observed - expected).ravel())) / len(y)
        slope -= RIDGE * np.concatenate((w, moves.ravel()))
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, moves = w + move[:N_FEATURES], moves + move[N_FEATURES:].reshape(2, 2)
    model = Model(w, moves, (1.0, 0.0))
    x = _logit(mean_marginals(lines, len(label), model))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of the logistic curve, slightly damped
        q = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        r, v = label - q, q * (1 - q) + 1e-6
        hess = np.array([[(v * x * x).sum() + 1, (v * x).sum()], [(v * x).sum(), v.sum() + 1]])
        step = np.linalg.solve(hess, [(r * x).sum() + (1 - a), r.sum() - b])
        a, b = a + 0.7 * step[0], b + 0.7 * step[1]
    return Model(w, moves, (float(max(a, 0.05)), float(b)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def mean_marginals(lines: Lines, n_docs: int, model: Model) -> np.ndarray:
    p, _, _ = marginals(lines.features @ model.weights, model.moves, Chains.of(lines.doc, n_docs))
    return np.bincount(lines.doc, p * lines.weight, n_docs) / np.bincount(lines.doc, lines.weight, n_docs)


def score_texts(texts: list[bytes], model: Model) -> np.ndarray:
    if model.constant is not None or not texts:
        return np.full(len(texts), model.constant or 0.0)
    x = _logit(mean_marginals(line_features(texts), len(texts), model))
    return 1 / (1 + np.exp(-np.clip(model.curve[0] * x + model.curve[1], -30, 30)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    fold: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_docs: int = TRAIN_DOCS,
    train_lines: int = TRAIN_LINES,
) -> Model:
    """Fit on labelled documents; ``fold`` is a condition on the labels' rows."""
    usable = labels.where(fold) if fold is not None else labels
    drawn = (
        usable.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(train_docs)  # the documented bound of the training sample
    )
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    rows = own.join(F.broadcast(drawn), own["doc_id"] == drawn["label_id"]).select("doc_id", "label", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text", SLICE_ROWS, SLICE_BYTES):
            short = pc.less_equal(pc.count_substring(b.column("text"), "\n"), train_lines)
            b = b.filter(short)
            if not b.num_rows:
                continue
            lines = line_features(b.column("text").to_pylist())
            cut = np.searchsorted(lines.doc, np.arange(b.num_rows + 1))
            held = np.column_stack([lines.features, lines.weight]).astype(np.float32)
            blobs = [held[s:e].tobytes() for s, e in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array(blobs, pa.binary())], ["doc_id", "label", "lines"])

    sample = rows.mapInArrow(extract, "doc_id bigint, label int, lines binary").toPandas()
    sample = sample.sort_values(["doc_id", "lines"]).drop_duplicates(["doc_id", "lines"])
    parts = [np.frombuffer(x, np.float32).reshape(-1, N_FEATURES + 1) for x in sample["lines"]]
    if not parts:
        return fit(Lines(np.zeros((0, N_FEATURES)), np.zeros(0), np.zeros(0, int)), np.zeros(0))
    table = np.concatenate(parts).astype(float)
    doc = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    return fit(Lines(table[:, :-1], table[:, -1], doc), sample["label"].to_numpy(float))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score), one row per input row."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text", SLICE_ROWS, SLICE_BYTES):
            scores = score_texts(b.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    only = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return only.mapInArrow(rate, "doc_id bigint, score double")
