import random

import numpy as np
import pytest
import xxhash
from edge_rows import EDGE_ROWS

from tidemark.llm import components, simhash


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def _groups(links, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("task_links", [1000, 30])
def test_components(llm, monkeypatch, task_links):
    monkeypatch.setattr(components, "TASK_LINKS", task_links)
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(50)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)] + [(500, i) for i in range(500, 540)]
    got = components.components(llm.createDataFrame(links, "a long, b long").repartition(6)).collect()
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r["node"]: r["root"] for r in got} == _groups(links, nodes) and len(got) == len(nodes)
    assert components.components(llm.createDataFrame([], "a long, b long")).count() == 0


def test_fold_bits_counts_long_texts():
    rng = np.random.default_rng(1)
    counts = np.array([0, 1, 2, 255, 256, 3000, 0])
    hashes = rng.integers(0, 2**64, counts.sum(), dtype=np.uint64)
    got = simhash.fold_bits(hashes, counts)
    for value, part in zip(got, np.split(hashes, np.cumsum(counts)[:-1]), strict=True):
        assert int(value) == sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in part) > len(part))


def test_allocation_adds_up_and_is_cheapest():
    costs = [[0, 5, 50, 500], [0, 1, 2, 3], [0, 9, 90, 900]]
    cost, chosen = simhash.allocate(costs, 1)
    every = [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 1]
    assert sum(chosen) == 1 and cost == min(sum(row[t + 1] for row, t in zip(costs, e, strict=True)) for e in every)


def test_bits_are_grouped_by_correlation():
    rng = np.random.default_rng(2)
    own = rng.integers(0, 2, (4000, 4))
    bits = np.stack([own[:, b % 4] ^ (rng.random(4000) < 0.05) for b in range(64)], axis=1).astype(float)
    groups = simhash.group_bits(len(bits), bits.T @ bits, 4)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert all(len({b % 4 for b in g}) == 1 for g in groups)


def _random_fps(rng, n, flips):
    base = [rng.getrandbits(64) for _ in range(n)]
    near = []
    for value in base * 3:
        for b in rng.sample(range(64), rng.randrange(flips + 1)):
            value ^= 1 << b
        near.append(value)
    return sorted(set(base + near))


@pytest.mark.parametrize("probes", [None, [(list(range(32)), 0), (list(range(32, 64)), 2)], [(list(range(21)), -1), (list(range(21, 42)), 1), (list(range(42, 64)), 1)]])
def test_links_are_complete_for_any_thresholds(llm, probes):
    values = _random_fps(random.Random(5), 120, 5)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = llm.createDataFrame([(v, v) for v in signed], "fp long, root long")
    plan = probes or simhash.choose_probes(fps, 3)
    assert sum(t for _, t in plan) == 3 - len(plan) + 1
    got = {frozenset((r["a"], r["b"])) for r in simhash.far_links(fps, plan, 3).collect()}
    want = {frozenset((a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == want


def _check(got, rows, reach):
    fps = {i: _fingerprint(t) for i, (_, t, _) in enumerate(rows)}
    links = [(a, b) for a in fps for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= reach]
    group = _groups(links, list(fps))
    want = []
    for i, (key, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in fps if group[j] == group[i] and rows[j][0] is not None]
        want.append((key, f"{fps[i]:016x}", min(ids, default=None)))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_near_duplicates_of_edge_rows(edge):
    _check(simhash.near_duplicates(edge, "doc_id", "text").collect(), EDGE_ROWS, 3)
    assert simhash.near_duplicates(edge.limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize("reach", [1, 2, 3, 6])
def test_near_duplicates_of_edited_texts(llm, reach):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        words = rng.choices(vocabulary, k=120)
        for _ in range(rng.randrange(1, 6)):
            rows.append((len(rows), " ".join(words), "s"))
            words = [*words]
            words[rng.randrange(120)] = rng.choice(vocabulary)
    docs = llm.createDataFrame(rows, "doc_id long, text string, source string")
    _check(simhash.near_duplicates(docs, "doc_id", "text", reach=reach).collect(), rows, reach)


def test_one_row_per_group_stays(edge):
    kept = simhash.one_per_group(edge, "doc_id", "text")
    assert kept.columns == edge.columns
    groups = simhash.near_duplicates(edge, "doc_id", "text")
    stayed = kept.select("doc_id", "text").collect()
    fps = {_fingerprint(t): k for k, t in stayed}
    near = lambda a, b: (a ^ b).bit_count() <= 3
    assert len(fps) == len(stayed) and not any(near(a, b) for a in fps for b in fps if a != b)
    assert {k for k, _ in stayed} == {r["component_id"] for r in groups.collect()}
    assert all(any(near(_fingerprint(t), f) for f in fps) for _, t, _ in EDGE_ROWS)
