import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from edge_rows import EDGE_ROWS

from tidemark.llm import gru, lm


def test_probabilities_add_up_and_state_is_carried():
    rng = np.random.default_rng(0)
    shape = gru.Shape(23, 4, 5, 6)
    weights = gru.start(shape, rng.integers(1, 100, 27), 1)
    single = gru.log_likelihood(weights, shape, [np.array([s], dtype=np.int32) for s in range(27)])
    assert np.exp(single).sum() == pytest.approx(1, abs=1e-5)
    docs = [rng.integers(0, 27, rng.integers(1, 100)).astype(np.int32) for _ in range(30)]
    alone = [gru.log_likelihood(weights, shape, [d])[0] for d in docs]
    assert gru.log_likelihood(weights, shape, docs, width=7) == pytest.approx(alone, abs=1e-3)
    # a prefix and its continuations: the state goes through windows
    prefix = rng.integers(0, 27, 40).astype(np.int32)
    longer = gru.log_likelihood(weights, shape, [np.append(prefix, s).astype(np.int32) for s in range(27)])
    assert np.exp(longer - gru.log_likelihood(weights, shape, [prefix])[0]).sum() == pytest.approx(1, abs=1e-4)


def test_words_of_many_texts_are_those_of_each():
    texts = ["left out", "  A b\tB\n", None, "", " ", "\x0b\x0cÉ K\u212a x\x1cy \u2003z\r", "last"]
    found, sizes = lm.words(pa.array(texts).slice(1))
    want = [(t or "").encode().lower().split() for t in texts[1:]]
    assert found.to_pylist() == sum(want, []) and sizes.tolist() == list(map(len, want))
    assert lm._last_bytes(found).tolist() == [w[-1] for w in sum(want, [])]
    known = pa.array([lm.END, b"b", b"a"], pa.binary())
    symbols = lm._symbols(2, np.arange(256), lm._places(found, known), lm._last_bytes(found))
    assert symbols.tolist() == [1 if w == b"b" else 2 + w[-1] for w in sum(want, [])]
    docs = lm._documents(symbols, sizes, 0)
    assert list(map(len, docs)) == [len(w) + 1 for w in want] and all(d[-1] == 0 for d in docs)


def test_training_learns_an_order():
    shape = gru.Shape(6, 1, 3, 8)
    docs = [np.array([0, 1, 2, 3, 4, 5] * 5, dtype=np.int32)] * 40
    weights = gru.start(shape, np.ones(7), 1)
    before = gru.log_likelihood(weights, shape, docs[:1])[0]
    squares = {n: np.zeros_like(w) for n, w in weights.items()}
    for _ in range(10):
        gru.train(weights, shape, docs, squares)
    assert gru.log_likelihood(weights, shape, docs[:1])[0] > before / 4


def _check(got, rows):
    tokens = [(k, (t or "").encode().lower().split() + [b" "]) for k, t in rows]
    held = lambda k: zlib.crc32((str(k) if k is not None else "").encode()) % 7 == 2
    counts = Counter(w for k, ws in tokens if not held(k) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = [(k, held(k), len(ws), sum(w in counts for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)) for k, ws in tokens]
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = sorted((tuple(r) for r in got), key=order)
    for g, w in zip(got, sorted(want, key=order), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5]) and -1e9 < g[6] < 0


def test_edge_rows(llm, edge, monkeypatch):
    _check(lm.score(edge, "doc_id", "text").collect(), [r[:2] for r in EDGE_ROWS])
    monkeypatch.setattr(lm, "HEAD", 3)
    monkeypatch.setattr(lm, "WORDS", 2)
    _check(lm.score(edge, "doc_id", "text").collect(), [r[:2] for r in EDGE_ROWS])
    assert lm.score(edge.limit(0), "doc_id", "text").count() == 0


def test_model_beats_the_base_on_held_out_texts_with_an_order(llm):
    rng = np.random.default_rng(5)
    starts, cycle = rng.integers(0, 40, 400), [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(cycle[(s + j) % 40] for j in range(60))) for i, s in enumerate(starts.tolist())]
    got = lm.score(llm.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").toPandas()
    held = got[got["held_out"]]
    assert len(held) and held["score"].sum() > 0.8 * held["base_score"].sum()
    _check([tuple(r) for r in got.itertuples(index=False)], rows)


def test_every_document_is_trained_on_once(llm, monkeypatch):
    # 6 million tokens
    training = llm.range(60).selectExpr("id as doc_id", "repeat('a b ', 50000) as text")
    seen, replicas = [], []

    def trained(rows, state, *rest):
        seen.append(sorted(r["doc_id"] for r in rows.select("doc_id").collect()))
        replicas.append(rest[-1])
        return state

    monkeypatch.setattr(lm, "_trained", trained)
    lm.learn(training)
    assert len(seen) == lm.ROUNDS and all(seen) and sorted(sum(seen, [])) == list(range(60))
    assert replicas == [2] * lm.ROUNDS


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    shape = gru.Shape(7, 2, 3, 5)
    weights = {n: w.astype(np.float64) for n, w in gru.start(shape, rng.integers(1, 50, 9), 3).items()}
    docs = [rng.integers(0, 9, n).astype(np.int32) for n in (5, 11, 1, 16, 9)]
    for width in (1, 2):
        laid = gru.even_lines(docs, width, 1)
        source, target, _, alive = next(laid.windows(9))
        h = rng.standard_normal((len(laid.lengths), 5)) * 0.3

        def loss():
            """The window's negative log probability, by the plain formulas."""
            total, state = 0.0, h.copy()
            for symbol, goal, n in zip(source, target, alive, strict=True):
                state = state[:n] * (symbol[:n] != 9)[:, None]
                x, a = weights["input"][symbol[:n]], state @ weights["state"]
                r, z = (1 / (1 + np.exp(-(x[:, i : i + 5] + a[:, i : i + 5]))) for i in (0, 5))
                new = np.tanh(x[:, 10:] + r * a[:, 10:])
                state = new + z * (state - new)
                for s, g in zip(state, goal[:n].tolist(), strict=True):
                    c = g // 3 if g < 7 else g - 7 + shape.word_classes
                    e = np.exp(s @ weights["cls"] + weights["cls0"])
                    total -= np.log(e[c] / e.sum())
                    if g < 7:
                        span = shape.span(c)
                        e = np.exp(weights["word"][span] @ s + weights["word0"][span])
                        total -= np.log(e[g - span.start] / e.sum())
            return total

        grads, rows, _, n = gru.gradients(weights, shape, source, target, alive, h)
        assert n == alive.sum()
        dense = {name: np.zeros_like(w) for name, w in weights.items()}
        for name, g in grads.items():
            dense[name][rows if name == "input" else slice(None)] = g
        for name, w in weights.items():
            for at in map(tuple, rng.integers(0, w.shape, (25, w.ndim)).tolist()):
                kept = w[at]
                w[at] = kept + 1e-5
                up = loss()
                w[at] = kept - 1e-5
                down = loss()
                w[at] = kept
                assert dense[name][at] == pytest.approx((up - down) / 2e-5, abs=2e-4)


def test_replicas_are_averaged_by_what_they_saw(llm):
    shape = gru.Shape(2, lm.TAILS, 32, 3)
    start = gru.start(shape, np.ones(2 + lm.TAILS), 1)
    state = {"w": start, "s": {n: np.zeros_like(w) for n, w in start.items()}}
    rows = llm.createDataFrame([(i, "x " * (i + 1)) for i in range(3)], "doc_id long, text string").repartition(3, "doc_id")
    tail_of = np.zeros(256, dtype=np.int64)
    got = lm._trained(rows, state, shape, tail_of, {b"x": 0, lm.END: 1}, 3)
    seen, mean = 0, {k: {n: 0.0 for n in start} for k in state}
    for part in rows.rdd.glom().collect():
        docs = [np.array([0] * len(r["text"].split()) + [1], dtype=np.int32) for r in part]
        if docs:
            own = {k: {n: w.copy() for n, w in v.items()} for k, v in state.items()}
            n = gru.train(own["w"], shape, docs, own["s"])
            seen += n
            mean = {k: {name: mean[k][name] + n * own[k][name] for name in start} for k in state}
    for k in state:
        for name in start:
            assert got[k][name] == pytest.approx(mean[k][name] / seen, abs=1e-5)


def test_a_very_long_text_takes_memory_in_proportion(tmp_path):
    """A million words beside 600 short texts, in scoring and in training."""
    import subprocess
    import sys

    code = """
import resource, numpy as np
from tidemark.llm import gru
rng = np.random.default_rng(0)
docs = [rng.integers(0, 1048, 50).astype(np.int32) for _ in range(600)] + [rng.integers(0, 1048, 1_000_000).astype(np.int32)]
shape = gru.Shape(1024, 24, 32, 16)
weights = gru.start(shape, np.ones(1048), 1)
gru.train(weights, shape, docs, {n: np.zeros_like(w) for n, w in weights.items()})
scores = gru.log_likelihood(weights, shape, docs)
assert scores.shape == (601,) and np.isfinite(scores).all() and scores[-1] < scores[:-1].min()
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert int(done.stdout) < 500


def test_spelling_is_a_distribution(llm):
    counts = llm.createDataFrame([(bytearray(w), 1) for w in [b"ab", b"abc", b"ba", b"a", b"b", b"aab"]], "word binary, c long")
    by_last = np.zeros(256)
    for b in b"abc":
        by_last[b] = 2
    tail_of = np.zeros(256, dtype=np.int64)
    letters = lm._letters(counts, by_last, tail_of)
    known = [w.tobytes() for n in (1, 2, 3) for w in np.array(np.meshgrid(*[np.frombuffer(b"abc", "u1")] * n)).T.reshape(-1, n)]
    p = 10.0 ** letters.spell(known)
    assert 0.05 < p.sum() < 1 and p[known.index(b"ab")] > p[known.index(b"cc")]
    assert letters.spell([b"ab", b"abc"]) == pytest.approx(np.concatenate([letters.spell([b"ab"]), letters.spell([b"abc"])]))


def test_dropped_letter_contexts_take_nothing_from_the_rest(llm, monkeypatch):
    some = [b"abcd", b"abcde", b"xbcd", b"xbcdf", b"ybcd", b"zzbcd", b"bcd"]
    counts = llm.createDataFrame([(bytearray(w), 1) for w in some], "word binary, c long")
    by_last = np.zeros(256)
    for b in b"abcdefxyz":
        by_last[b] = 2
    for most in (lm.MOST_CELLS, 1):
        monkeypatch.setattr(lm, "MOST_CELLS", most)
        letters = lm._letters(counts, by_last, np.zeros(256, dtype=np.int64))
        # every symbol before each context of a word: "bcd" has kept cells and dropped ones
        x1, x2, x3 = ([letters.symbol[b]] * lm.SIDE for b in b"bcd")
        assert (10.0 ** letters.before(np.arange(lm.SIDE), np.array(x1), np.array(x2), np.array(x3))).sum() == pytest.approx(1, abs=1e-4)
