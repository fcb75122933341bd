import re

import numpy as np
import pytest
from edge_rows import EDGE_ROWS
from pyspark.sql import functions as F

from tidemark.llm import jaccard, queries


def _set(text, length=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1))) if words else frozenset()


def _brute(rows, percent=90):
    """(doc_id, n, component) of every row, all pairs compared."""
    sets = [_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for shingle in s:
            where.setdefault(shingle, []).append(i)
    for j, t in enumerate(sets):
        for i in {i for shingle in t for i in where[shingle] if i < j}:
            if 100 * len(sets[i] & t) >= percent * len(sets[i] | t):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    ids = {}
    for i, (key, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(key)
    return sorted(((key, len(sets[i]), min((k for k in ids[find(i)] if k is not None), default=None)) for i, (key, _) in enumerate(rows)), key=str)


def _query(llm, rows, parts=3):
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    clashing = ["row", "n", "digest", "common", "prefix", "key", "signature", "r", "g", "first", "root", "a", "b", "h", "c", "token", "wanted_id", "component_id"]
    docs = docs.select("*", *[F.lit("clash").alias(c) for c in clashing])
    return sorted((tuple(r) for r in jaccard.near_documents(docs, "doc_id", "text").collect()), key=str)


def _edited(rng, words, edits, fresh):
    words = list(words)
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(len(words)))
        if kind == 0:
            words[at] = f"new{fresh}x{at}"
        elif kind == 1 and len(words) > 4:
            del words[at]
        else:
            words.insert(at, f"more{fresh}x{at}")
    return words


def _corpus(seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocabulary, 40))
    rows, bases = [], [list(rng.choice(vocabulary, rng.integers(3, 150))) for _ in range(25)]
    for i in range(420):
        base = bases[0] if i % 3 == 0 else bases[int(rng.integers(len(bases)))]  # a third of all rows are near copies of one
        text = " ".join(_edited(rng, base, int(rng.integers(0, 6)), i))
        if rng.random() < 0.3:
            text += " " + passage
        rows.append((1000 - i, text.upper() if rng.random() < 0.1 else text))
    rows += [(2000 + i, rows[0][1]) for i in range(60)]
    rows += [(3000 + i, " ".join(rng.choice(vocabulary[:3], rng.integers(0, 6)))) for i in range(60)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(llm, monkeypatch, small):
    if small:
        for name, value in {"SEGMENT": 3000, "FREQUENT": 4, "MOST_FREQUENT": 100, "LIST": 9, "PAIRS": 50}.items():
            monkeypatch.setattr(jaccard, name, value)
    for seed in (1, 2):
        rows = _corpus(seed)
        want = _brute(rows)
        assert _query(llm, rows) == want
        assert 20 < len({c for _, _, c in want}) < len(rows) - 50


def test_odd_rows(llm):
    rows = [(key, text) for key, text, _ in EDGE_ROWS]
    assert _query(llm, rows) == _brute(rows)
    assert _query(llm, [(None, "a b c d"), (None, "a b c d"), (None, None)]) == _brute([(None, "a b c d"), (None, "a b c d"), (None, None)])
    assert _query(llm, [(5, ""), (4, None)]) == [(4, 0, 4), (5, 0, 5)]
    assert _query(llm, []) == []


def test_groups_of_equal_prefix(llm, monkeypatch):
    """Sets that differ only in frequent shingles have one prefix and meet inside their group."""
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    passage = " ".join(f"c{i}" for i in range(200))
    tails = [" ".join(f"t{v}x{i}" for i in range(size)) for v, size in enumerate((5, 5, 25, 25))]
    rows = [(7 * i % 101, " ".join([*[f"o{i % 9}x{j}" for j in range(30)], passage, tails[i // 9 % 4]])) for i in range(54)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    sets = jaccard._sketched(docs, 3, 90)
    assert sets.select("digest").distinct().count() == 36 and sets.select("key").distinct().count() == 18
    want = _brute(rows)
    assert _query(llm, rows, parts=1) == want and len({c for _, _, c in want}) == 27


def test_signatures_bound_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 700)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.random()], rng.integers(0, 1 << 63, rng.integers(0, 90)).astype(np.uint64), a[:1]]))
        assert jaccard.signature_distance(jaccard.signature(a), jaccard.signature(b)) <= len(np.setxor1d(a, b))


def test_query_equals_brute_force(llm):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op11_jaccard"](llm, sf_dir)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _brute(rows)
