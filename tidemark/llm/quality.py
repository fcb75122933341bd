"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's score for good comes from its own features and those of the lines around it;
transitions tie neighbouring lines. Forward-backward gives each line's probability of being good, and a document's
quality is their mean, weighted by line length, on a calibrated scale. The model is a few dozen numbers: it is fitted on
a bounded sample of labelled documents, whose lines take the document's label, and scores any text by itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import labelled_sample, logistic, sigmoid

#: Labelled documents that the model is fitted on, and the most lines of one (a longer one is left out of the fit).
SAMPLE = 6000
SAMPLE_LINES = 400
FEATURES = 15


def _classes() -> bytes:
    """A byte's class: letter, capital, digit, blank, bar, exclamation mark, sentence end, comma, other mark, beyond ASCII."""
    table = bytearray(b"#" * 128 + b"x" * 128)
    for span, mark in (("az", "a"), ("AZ", "A"), ("09", "0")):
        for c in range(ord(span[0]), ord(span[1]) + 1):
            table[c] = ord(mark)
    for c, mark in zip(b" \t\r\v\f|!.?,", b"     |!..,", strict=True):
        table[c] = mark
    return bytes(table)


_CLASSES = _classes()


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Own features of each line, and each line's length in bytes plus one. The empty text is one empty line."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    copies = Counter(lines) if len(lines) > 1 else None
    out = np.empty((len(lines), FEATURES), dtype=np.float32)
    for i, line in enumerate(lines):
        marks, words = line.translate(_CLASSES), line.split()
        n, w = len(line) or 1, len(words) or 1
        distinct = len(set(words))
        out[i] = (
            n, w, marks.count(b"A") / n, marks.count(b"0") / n, marks.count(b"|") / n, marks.count(b"!") / n, marks.count(b".") / w,
            marks.count(b",") / w, marks.count(b"#") / n, marks.count(b"x") / n, n / w, distinct / w, distinct,
            copies is not None and copies[line] > 1, marks[-1:] == b".",
        )
    out[:, [0, 1, 12]] = np.log1p(out[:, [0, 1, 12]])
    return out, np.fromiter(map(len, lines), dtype=np.float64, count=len(lines)) + 1


def _with_neighbours(own: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (zeros at a document's ends), and marks for the ends."""
    first = np.zeros(len(own), dtype=bool)
    first[firsts] = True
    last = np.append(first[1:], True)
    before, after = np.vstack([own[:1], own[:-1]]), np.vstack([own[1:], own[-1:]])
    return np.column_stack([own, np.where(first[:, None], 0, before), np.where(last[:, None], 0, after), first, last])


@dataclass
class Crf:
    """``trans[a, b]``: score of state b (0 bad, 1 good) after a. ``scale`` and ``shift`` calibrate the document's score."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    trans: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def emissions(self, own: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        x = _with_neighbours((own - self.mean) / self.spread, firsts)
        return x @ self.weights[:-1] + self.weights[-1]


def forward_backward(scores: np.ndarray, trans: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all documents side by side: P(good) of each line, P(state before, state) of each line but a document's first (as 2 x 2), and
    each document's log partition sum. ``scores`` is the score of good, that of bad is 0."""
    order = np.argsort(-sizes, kind="stable")
    starts, lengths = firsts[order], sizes[order]
    both = np.column_stack([np.zeros(len(scores)), scores])
    alpha, beta = both.copy(), np.zeros_like(both)
    longest = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # documents with more than t lines
    for t in range(1, longest):
        at = starts[: active[t]] + t
        before = alpha[at - 1]
        alpha[at] = both[at] + np.logaddexp(before[:, :1] + trans[0], before[:, 1:] + trans[1])
    for t in range(longest - 1, 0, -1):
        at = starts[: active[t]] + t
        ahead = both[at] + beta[at]
        beta[at - 1] = np.logaddexp(ahead[:, :1] + trans[:, 0], ahead[:, 1:] + trans[:, 1])
    ends = firsts + sizes - 1
    total = np.logaddexp(alpha[ends, 0], alpha[ends, 1])
    of_line = np.repeat(total, sizes)
    good = np.exp(np.clip(alpha[:, 1] + beta[:, 1] - of_line, -700, 0))
    inner = np.ones(len(scores), dtype=bool)
    inner[firsts] = False
    at = np.flatnonzero(inner)
    pairs = np.exp(np.clip(alpha[at - 1][:, :, None] + trans[None] + (both + beta)[at][:, None, :] - of_line[at][:, None, None], -700, 0))
    return good, pairs, total


def _document_scores(good: np.ndarray, lengths: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The log odds of the length-weighted mean of the lines' probabilities."""
    mean = np.add.reduceat(good * lengths, firsts) / np.add.reduceat(lengths, firsts)
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return np.log(mean / (1 - mean))


def fit(own: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, labels: np.ndarray, steps: int = 200, ridge: float = 1e-3) -> Crf:
    """The model of least regularised negative log-likelihood of the lines' labels, by Adam over all documents."""
    if not len(labels) or labels.min() == labels.max():
        rate = (labels.sum() + 1) / (len(labels) + 2)
        return Crf(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(3 * FEATURES + 3), np.zeros((2, 2)), constant=float(rate))
    firsts = np.cumsum(sizes) - sizes
    y = np.repeat(labels, sizes)
    model = Crf(own.mean(axis=0), own.std(axis=0) + 1e-3, np.zeros(3 * FEATURES + 3), np.zeros((2, 2)))
    x = np.column_stack([_with_neighbours((own - model.mean) / model.spread, firsts), np.ones(len(own))])
    counts = np.zeros((2, 2))
    inner = np.ones(len(y), dtype=bool)
    inner[firsts] = False
    np.add.at(counts, (y[np.flatnonzero(inner) - 1], y[inner]), 1)
    theta = np.zeros(x.shape[1] + 4)
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, trans = theta[:-4], theta[-4:].reshape(2, 2)
        good, pairs, _ = forward_backward(x @ w, trans, firsts, sizes)
        slope = np.concatenate([x.T @ (good - y), (pairs.sum(axis=0) - counts).ravel()]) / len(y) + ridge * theta
        moment, square = 0.9 * moment + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        theta -= 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    model.weights, model.trans = theta[:-4], theta[-4:].reshape(2, 2)
    good, _, _ = forward_backward(x @ model.weights, model.trans, firsts, sizes)
    scale, shift = logistic(_document_scores(good, lengths, firsts)[:, None], labels.astype(float))
    model.scale, model.shift = float(scale), float(shift)
    return model


def score(model: Crf, texts: list[str]) -> np.ndarray:
    """Each text's quality from 0 to 1."""
    if model.constant is not None or not texts:
        return np.full(len(texts), model.constant or 0.0)
    made = [line_features(t) for t in texts]
    sizes = np.array([len(n) for _, n in made])
    firsts = np.cumsum(sizes) - sizes
    own, lengths = np.concatenate([f for f, _ in made]).astype(np.float64), np.concatenate([n for _, n in made])
    good, _, _ = forward_backward(model.emissions(own, firsts), model.trans, firsts, sizes)
    return sigmoid(model.scale * _document_scores(good, lengths, firsts) + model.shift)


def train(docs: DataFrame, labels: DataFrame, *, folds: int = 5, held_out: int = 0, most: int = SAMPLE) -> Crf:
    """The model from ``labels.quality``, without the held-out fold. Without labels of both kinds, empty tables included, it gives every text their rate.

    Null ids and labels do not teach; of several labels of one id the smallest counts, equal texts teach once, with the label that most of them have. A
    null text is the empty one. Texts of more than ``SAMPLE_LINES`` lines do not teach. Other columns are not read.
    """

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [line_features(t) for t in batch.column("text").to_pylist()]
            kept = [(f, n, y) for (f, n), y in zip(made, batch.column("label").to_pylist(), strict=True) if len(n) <= SAMPLE_LINES]
            if kept:
                yield pa.RecordBatch.from_pydict(
                    {
                        "own": pa.array([f.tobytes() for f, _, _ in kept], pa.binary()),
                        "lengths": pa.array([n.tobytes() for _, n, _ in kept], pa.binary()),
                        "label": pa.array([y for _, _, y in kept], pa.int32()),
                    }
                )

    sample = labelled_sample(docs, labels, "quality", folds=folds, held_out=held_out, most=most)
    rows = sorted(tuple(r) for r in sample.mapInArrow(featured, "own binary, lengths binary, label int").collect())
    own = [np.frombuffer(r[0], dtype=np.float32).reshape(-1, FEATURES) for r in rows]
    lengths = [np.frombuffer(r[1]) for r in rows]
    none = np.zeros((0, FEATURES), dtype=np.float32)
    sizes = np.array([len(n) for n in lengths], dtype=np.int64)
    return fit(np.concatenate([none, *own]).astype(np.float64), np.concatenate([np.zeros(0), *lengths]), sizes, np.array([r[2] for r in rows], dtype=np.int64))


def score_column(model: Crf, text: Column) -> Column:
    """The quality of a text column, from 0 to 1: a null text is the empty text, very long texts are scored whole, equal texts score alike."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [score(model, texts.iloc[i : i + 500].fillna("").tolist()) for i in range(0, len(texts), 500)]
            yield pd.Series(np.concatenate([np.zeros(0), *parts]))

    return scored(text)
