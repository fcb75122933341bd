import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, topk


def _brute(rows, k):
    fine = [(key, [math.floor(64 * float(np.float32(x))) for x in v]) for key, v in rows if key is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for a, (key, v) in enumerate(fine):
        if key % 20 == 0:
            scores = [(-min(max(sum(x * y for x, y in zip(v, w, strict=False)), -(1 << 63)), (1 << 63) - 1), other) for b, (other, w) in enumerate(fine) if b != a]
            for r, (s, other) in enumerate(sorted(scores)[:k], start=1):
                out[key, r, other, -s] += 1
    return out


def _query(llm, rows, k=20):
    vectors = llm.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    vectors = vectors.select("*", *[F.lit("clash").alias(c) for c in ("cell", "v", "row", "id", "query", "slice", "block")])
    return Counter(map(tuple, topk.top_scores(vectors, "vec_id", "embedding", F.col("id") % 20 == 0, k=k).collect()))


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(llm, monkeypatch, small):
    if small:
        monkeypatch.setattr(topk, "SLICE", 150)
        monkeypatch.setattr(topk, "BLOCK", 7)
        monkeypatch.setattr(topk, "PIVOTS", 9)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] * (1 + i % 3) + rng.normal(size=16) * 0.1).astype(np.float32).tolist()) for i in range(900)]
    rows += [(i, rows[0][1]) for i in range(900, 1300)]  # a hot vector: a third of all rows, all ties
    assert _query(llm, rows) == _brute(rows, 20)


def test_odd_rows(llm):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0]), (None, [1.0, 1.0]),
        (1, [-1.0, 0.5]), (2, [1.0, 2.0]), (3, [1.0, 2.0]), (4, [2.0, -1.0]), (5, [0.5]), (6, []), (7, [0.3, 0.3, 0.3]), (8, [1.0, 2.0]), (8, [9.0, 9.0]), (120, [0.01, -0.01]),
    ]
    assert _query(llm, rows, k=4) == _brute(rows, 4)
    assert _query(llm, rows, k=50) == _brute(rows, 50)
    assert _query(llm, rows[:2]) == _brute(rows[:2], 20)
    assert _query(llm, rows[:1]) == Counter()
    assert _query(llm, rows[3:6]) == Counter()


def test_components_of_any_size(llm):
    rows = [(0, [1.0, 2.0]), (1, [4e7, 1.0]), (2, [0.5, 0.5]), (20, [4e7, -1.0]), (3, [1e18, 1.0]), (4, [-1e30, 3e38]), (40, [1e30, 1e30]), (5, [3e9, 7.0]), (6, [-1e30, 0.0]), (60, [1e30, -1e30])]
    got = _query(llm, rows, k=3)
    assert got == _brute(rows, 3) and got[0, 1, 3, (1 << 63) - 1] == 1


def test_query_equals_its_sql(llm):
    sf_dir = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    columns = ["query_id", "rank", "vec_id", "score"]
    got = queries.QUERIES["op5_topk"](llm, sf_dir).select(columns).collect()
    want = duck.sql(queries.ORACLES["op5_topk"])
    assert [str(t) for t in want.types] == ["BIGINT", "INTEGER", "BIGINT", "BIGINT"] and want.columns == columns
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
