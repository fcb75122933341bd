import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives

BIG = (1 << 63) - 1


def _brute(rows, positives=5, wanted=10):
    fine = []
    for key, v, label in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if key is not None and key % 7 == 0 else label
        fine.append((key, [math.floor(256 * float(np.float32(x))) for x in v], label))

    def score(a, b):
        return min(max(sum(x * y for x, y in zip(a, b, strict=False)), -BIG - 1), BIG)

    def order(row):
        return (-row[0], row[1] is None, row[1] or 0)

    out = Counter()
    for at, (key, v, label) in enumerate(fine):
        if key is None or key % 100:
            continue
        scored = [(score(v, w), k, other) for i, (k, w, other) in enumerate(fine) if i != at]
        for p, positive, _ in sorted((s for s in scored if s[2] == label), key=order)[:positives]:
            inside = [s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p]
            for rank, (s, k, _) in enumerate(sorted(inside, key=order)[:wanted], start=1):
                out[key, positive, rank, k, p, s] += 1
    return out


def _query(llm, rows):
    vectors = llm.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    clashing = ["id", "v", "row", "slice", "block", "is_anchor", "own_id", "n", "rank", "positive_row"]
    vectors = vectors.select("*", *[F.lit("clash").alias(c) for c in clashing])
    new_label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return Counter(map(tuple, negatives.mine(vectors, "vec_id", "embedding", "label", is_anchor=F.col("id") % 100 == 0, new_label=new_label).collect()))


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(llm, monkeypatch, small):
    if small:
        for name, value in {"BLOCK": 3, "SLICE": 150, "ROWS": 2, "COLUMNS": 40, "LEAF": 3}.items():
            monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=13) * 0.2 + 0.1).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(700)]
    rows += [(700 + i, rows[3][1], 2 if i % 2 else 1) for i in range(350)]  # a hot vector and two hot labels: a third of all rows, all ties
    got = _query(llm, rows)
    assert got == _brute(rows) and len(got) > 100


def test_odd_rows(llm):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (100, [0.0, 0.0], 1), (200, None, 1), (300, [nan, 1.0], 2), (400, [inf, 1.0], 2), (500, [None, 1.0], 2), (600, [1.0, 1.0], None),
        (None, [1.0, 1.0], 1), (None, [0.5, 0.5], 2), (1, [1.0, 1.5], 1), (2, [0.5, 1.0], 2), (3, [0.5, 1.0], 2), (3, [0.5, 1.0], 2), (4, [0.25], 3), (5, [], 3), (6, [0.9, 0.9, 9.0], 3),
        (7, [1.0, 1.0], 9), (14, [1.0, 1.0], 0), (8, [-1.0, -1.0], 0), (700, [1.0, 1.0], 0),
    ]
    got = _query(llm, rows)
    assert got == _brute(rows) and len(got) > 10
    assert _query(llm, []) == Counter()
    assert _query(llm, rows[:1]) == Counter()
    assert _query(llm, rows[3:8]) == Counter()


def test_components_of_any_size(llm):
    rows = [(0, [4e5, 1.0], 1), (1, [3e8, 0.5], 1), (2, [2e8, 0.5], 2), (3, [1.0, 1.0], 2), (4, [1e30, 1.0], 1), (5, [-1e30, 3e38], 2), (6, [2.5e8, 8.0], 3), (8, [1e29, 1.0], 1), (9, [1e31, 1.0], 1), (10, [1e32, 2.0], 1), (11, [1e33, 2.0], 1)]
    got = _query(llm, rows)
    assert got == _brute(rows) and got


def test_strassen_is_exact():
    rng = np.random.default_rng(0)
    for shape in [(1, 1, 1), (5, 7, 3), (33, 65, 17), (64, 64, 64), (0, 4, 5), (3, 0, 2)]:
        a, b = rng.integers(-(1 << 28), 1 << 28, shape[:2]), rng.integers(-(1 << 28), 1 << 28, shape[1:])
        want = a.astype(object) @ b.astype(object)
        for leaf in (1, 2, 8):
            assert (negatives.strassen(a, b, leaf) == want).all()
            assert (negatives.strassen(a.astype(object), b.astype(object), leaf) == want).all()
    # sums on the way may leave 64 bits, the result does not
    a, b = np.array([[1 << 40, -(1 << 40)], [1 << 40, 1]]), np.array([[1 << 22, 1], [1 << 22, -(1 << 20)]])
    assert (negatives.strassen(a, b, 1) == a.astype(object) @ b.astype(object)).all()
