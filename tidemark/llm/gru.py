"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, carried state.

Symbols are the modelled words (0..words-1, most frequent first), then the tail classes, which stand for all other words,
then the start mark. The first word classes hold ``per_class`` modelled words each; a tail class is a class by itself.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Steps of a window: gradients stop at its start, the state goes on.
WINDOW = 16
F32 = np.float32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= F32(0.5)
    np.tanh(x, out=x)
    x *= F32(0.5)
    x += F32(0.5)
    return x


@dataclass
class Shape:
    words: int
    tails: int
    per_class: int
    hidden: int

    @property
    def word_classes(self) -> int:
        return -(-self.words // self.per_class)

    def span(self, cls: int) -> slice:
        return slice(cls * self.per_class, min(self.words, (cls + 1) * self.per_class))

    def sizes(self) -> dict[str, tuple[int, ...]]:
        h, c = self.hidden, self.word_classes + self.tails
        return {"input": (self.words + self.tails + 1, 3 * h), "state": (h, 3 * h), "cls": (h, c), "cls0": (c,), "word": (self.words, h), "word0": (self.words,)}


def start(shape: Shape, counts: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    """Small random weights, with the unigram model of ``counts`` (of words, then tail classes) in the constants."""
    rng = np.random.default_rng(seed)
    out = {name: (rng.standard_normal(size) * 0.1).astype(F32) for name, size in shape.sizes().items()}
    known = counts.astype(np.float64) + 1
    words = known[: shape.words]
    per = np.array([words[shape.span(c)].sum() for c in range(shape.word_classes)] + known[shape.words :].tolist())
    out["cls0"], out["word0"] = np.log(per / per.sum()).astype(F32), np.log(words / words.sum()).astype(F32)
    return out


def streams(docs: list[np.ndarray], most: int) -> list[list[int]]:
    """The documents in at most ``most`` streams of about equal length, the longest stream first."""
    heap = [(0, i) for i in range(max(1, min(most, len(docs))))]
    out: list[list[int]] = [[] for _ in heap]
    for d in sorted(range(len(docs)), key=lambda d: -len(docs[d])):
        size, i = heapq.heappop(heap)
        out[i].append(d)
        heapq.heappush(heap, (size + len(docs[d]), i))
    return sorted(out, key=lambda s: -sum(len(docs[d]) for d in s))


@dataclass
class Lines:
    """Documents end to end in streams, the longest stream first. What a window needs is cut out of the flat symbols, so memory is
    that of the documents, however unequal they are."""

    flat: np.ndarray
    first: np.ndarray
    doc: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    def alive(self, steps: np.ndarray) -> np.ndarray:
        """How many streams reach each step."""
        return np.searchsorted(-self.lengths, -steps, side="left")

    def windows(self, start_mark: int, cells: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per window: inputs, targets and documents by step and stream, and the streams that are alive at each step. A document's first
        input is the start mark, its targets are its symbols. With ``cells``, few streams have longer windows, of about that many cells."""
        steps, end = int(self.lengths.max(initial=0)), 0
        while end < steps:
            begin, wide = end, max(WINDOW, cells // int(self.alive(np.array([end]))[0]))
            end = min(begin + wide, steps)
            at = np.arange(begin, end)
            alive = self.alive(at)
            place = np.minimum(self.starts[None, : alive[0]] + at[:, None], len(self.flat) - 1)
            source = np.where(self.first[place], np.int32(start_mark), self.flat[place - 1])
            yield source, self.flat[place], self.doc[place], alive


def lines(docs: list[np.ndarray], most: int) -> Lines:
    order = streams(docs, most)
    row = [d for s in order for d in s]
    sizes = np.array([len(docs[d]) for d in row], dtype=np.int64)
    flat = np.concatenate([np.zeros(0, dtype=np.int32), *[docs[d] for d in row]]).astype(np.int32, copy=False)
    first = np.zeros(len(flat), dtype=bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    lengths = np.array([sum(len(docs[d]) for d in s) for s in order], dtype=np.int64)
    return Lines(flat, first, np.repeat(np.array(row, dtype=np.int32), sizes), np.cumsum(lengths) - lengths, lengths)


def even_lines(docs: list[np.ndarray], most: int, seed: int) -> Lines:
    """The documents in random order, cut into streams of equal length, for training only: a document that goes over a cut starts a stream in its
    middle. No stream ends early, so the last steps see as many documents as the first."""
    row = np.random.default_rng(seed).permutation(len(docs)).tolist()
    laid = lines([np.concatenate([np.zeros(0, dtype=np.int32), *[docs[d] for d in row]])], 1)
    ends = np.cumsum([len(docs[d]) for d in row])
    laid.first[ends[:-1][ends[:-1] < len(laid.flat)]] = True
    each = -(-len(laid.flat) // max(1, most))
    starts = np.arange(0, len(laid.flat), max(1, each))
    return Lines(laid.flat, laid.first, laid.doc, starts, np.minimum(each, len(laid.flat) - starts))


def _step(p: dict, x: np.ndarray, h: np.ndarray, hidden: int) -> tuple:
    a = h @ p["state"]
    gates = _sigmoid(x[:, : 2 * hidden] + a[:, : 2 * hidden])
    r, z = gates[:, :hidden], gates[:, hidden:]
    inner = a[:, 2 * hidden :]
    n = r * inner
    n += x[:, 2 * hidden :]
    np.tanh(n, out=n)
    out = h - n
    out *= z
    out += n
    return out, r, z, n, inner


def _bounded(logits: np.ndarray) -> np.ndarray:
    """In place: logits above 80 would leave the range of 32 bits."""
    if logits.size and logits.max() > 80:
        np.minimum(logits, F32(80), out=logits)
    return logits


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Probabilities, in place."""
    np.exp(_bounded(logits), out=logits)
    logits /= (logits @ np.ones(logits.shape[1], dtype=logits.dtype))[:, None]
    return logits


def _logits(state: np.ndarray, weights: np.ndarray, constants: np.ndarray) -> np.ndarray:
    out = state @ weights
    out += constants
    return out


def _log_probability(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The log of the softmax at ``chosen``."""
    out = _bounded(logits).take(_places(logits, chosen)).astype(np.float64)
    np.exp(logits, out=logits)
    return out - np.log(logits @ np.ones(logits.shape[1], dtype=logits.dtype))


def _places(matrix: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The flat places of one chosen column per row."""
    return np.arange(len(chosen)) * matrix.shape[1] + chosen


def _word_logits(p: dict, shape: Shape, state: np.ndarray, ranges: list[tuple[slice, slice]]) -> np.ndarray:
    """The logits of the words of each range's class; what a smaller class lacks has no probability."""
    out = np.empty((len(state), shape.per_class), dtype=state.dtype)
    for at, span in ranges:
        width = span.stop - span.start
        np.matmul(state[at], p["word"][span].T, out=out[at, :width])
        out[at, :width] += p["word0"][span]
        if width < shape.per_class:
            out[at, width:] = -np.inf
    return out


def _column_sums(matrix: np.ndarray) -> np.ndarray:
    return np.ones(len(matrix), dtype=matrix.dtype) @ matrix


def _classes(shape: Shape, target: np.ndarray) -> np.ndarray:
    return np.where(target < shape.words, target // shape.per_class, target - shape.words + shape.word_classes)


def _by_class(shape: Shape, goal: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[slice, slice]]]:
    """Classes of symbols, an order that puts those of one word class together, and per class its range there and its words."""
    cls = _classes(shape, goal)
    order = np.argsort(cls.astype(np.int16) if shape.word_classes + shape.tails < 1 << 15 else cls, kind="stable")
    edges = np.searchsorted(cls[order], np.arange(shape.word_classes + 1)).tolist()
    return cls, order, [(slice(a, b), shape.span(c)) for c, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if a < b]


def _cells(matrix: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """The living cells of a window, step by step."""
    if alive[-1] == matrix.shape[1]:
        return matrix.reshape(-1)
    return np.concatenate([row[:n] for row, n in zip(matrix, alive.tolist(), strict=True)])


def log_likelihood(p: dict, shape: Shape, docs: list[np.ndarray], width: int = 512) -> np.ndarray:
    """The natural log probability of each document's symbols, each document as a whole."""
    mark, hidden = shape.words + shape.tails, shape.hidden
    laid = lines(docs, width)
    out = np.zeros(len(docs))
    h = np.zeros((len(laid.lengths), hidden), dtype=F32)
    for source, target, doc, alive in laid.windows(mark, cells=8192):
        states = []
        for symbol, n in zip(source, alive.tolist(), strict=True):
            symbol, before = symbol[:n], h[:n]
            fresh = symbol == mark
            if fresh.any():
                before = np.where(fresh[:, None], F32(0), before)
            h = _step(p, p["input"].take(symbol, axis=0), before, hidden)[0]
            states.append(h)
        state, goal, of = np.concatenate(states), _cells(target, alive), _cells(doc, alive)
        cls, order, ranges = _by_class(shape, goal)
        found = _log_probability(_logits(state, p["cls"], p["cls0"]), cls)
        order = order[: ranges[-1][0].stop if ranges else 0]
        goal = goal.take(order)
        found[order] += _log_probability(_word_logits(p, shape, state.take(order, axis=0), ranges), goal % shape.per_class)
        out += np.bincount(of, weights=found, minlength=len(docs))
    return out


def gradients(p: dict, shape: Shape, source: np.ndarray, target: np.ndarray, alive: np.ndarray, h: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, int]:
    """Of one window: the gradients of the summed negative log probability, where ``input`` has a row for each of the symbols given next; those
    symbols; the state after the window; and the number of targets."""
    mark, hidden = shape.words + shape.tails, shape.hidden
    kept = []
    for symbol, n in zip(source, alive.tolist(), strict=True):
        symbol = symbol[:n]
        go = (symbol != mark).astype(F32)[:, None]
        before = h[:n] * go
        h, r, z, new, inner = _step(p, p["input"].take(symbol, axis=0), before, hidden)
        kept.append((symbol, go, before, h, r, z, new, inner))
    state, goals = np.concatenate([k[3] for k in kept]), _cells(target, alive)
    goal = goals
    grads = {"word": np.zeros_like(p["word"]), "word0": np.zeros_like(p["word0"])}
    cls, order, ranges = _by_class(shape, goal)
    error = _softmax(_logits(state, p["cls"], p["cls0"]))
    error.reshape(-1)[_places(error, cls)] -= 1
    grads["cls"], grads["cls0"] = (error.T @ state).T, _column_sums(error)
    back = error @ p["cls"].T
    order = order[: ranges[-1][0].stop if ranges else 0]
    state, goal = state.take(order, axis=0), goal.take(order)
    error, inside = _softmax(_word_logits(p, shape, state, ranges)), np.empty_like(state)
    error.reshape(-1)[_places(error, goal % shape.per_class)] -= 1
    for at, span in ranges:
        own = error[at, : span.stop - span.start]
        np.matmul(own.T, state[at], out=grads["word"][span])
        grads["word0"][span] = _column_sums(own)
        np.matmul(own, p["word"][span], out=inside[at])
    back[order] += inside
    ends = np.cumsum(alive)
    later = np.zeros((0, hidden), dtype=F32)
    go, before, r, z, new, inner = (np.concatenate([k[i] for k in kept]) for i in (1, 2, 4, 5, 6, 7))
    # what the gradient of a state becomes in the three sums of its step, but for the reset gate
    to_new = (1 - z) * (1 - new * new)
    to_z = (before - new) * z * (1 - z)
    to_r = to_new * inner * r * (1 - r)
    of_state = np.empty((len(goals), 3 * hidden), dtype=back.dtype)
    turned = np.ascontiguousarray(p["state"].T)
    for i in range(len(kept) - 1, -1, -1):
        at = slice(ends[i] - alive[i], ends[i])
        d, outer = back[at], of_state[at]
        d[: len(later)] += later
        np.multiply(d, to_r[at], out=outer[:, :hidden])
        np.multiply(d, to_z[at], out=outer[:, hidden : 2 * hidden])
        inward = np.multiply(d, to_new[at], out=to_new[at])
        np.multiply(inward, r[at], out=outer[:, 2 * hidden :])
        later = outer @ turned
        later += d * z[at]
        later *= go[at]
    grads["state"] = before.T @ of_state
    of_state[:, 2 * hidden :] = to_new
    symbols = np.concatenate([k[0] for k in kept])
    order = np.argsort(symbols.astype(np.int16) if mark < 1 << 15 else symbols, kind="stable")
    symbols = symbols.take(order)
    firsts = np.concatenate([[0], np.flatnonzero(np.diff(symbols)) + 1])
    grads["input"] = np.add.reduceat(of_state.take(order, axis=0), firsts, axis=0)
    return grads, symbols.take(firsts), h, len(goals)


def train(p: dict, shape: Shape, docs: list[np.ndarray], squares: dict, rate: float = 0.4, width: int = 512, seed: int = 0) -> int:
    """One pass over ``docs`` in place, a step of Adagrad per window; ``squares`` are its running sums. Streams last a few windows at least. Returns
    the symbols seen."""
    laid = even_lines(docs, min(width, max(1, sum(map(len, docs)) // (4 * WINDOW))), seed)
    h = np.zeros((len(laid.lengths), shape.hidden), dtype=F32)
    for source, target, _, alive in laid.windows(shape.words + shape.tails):
        grads, rows, h, n = gradients(p, shape, source, target, alive, h)
        for name, g in grads.items():
            at = rows if name == "input" else slice(None)
            np.clip(g / F32(np.sqrt(n)), -1, 1, out=g)
            squares[name][at] += g * g
            p[name][at] -= F32(rate) * g / (np.sqrt(squares[name][at]) + F32(1e-3))
    return int(sum(map(len, docs)))
