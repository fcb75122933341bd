import hashlib
import random

import numpy as np
from edge_rows import EDGE_ROWS

from tidemark.llm import sketch


def _random_text(rng, n):
    return " ".join(f"w{rng.randrange(500)}" for _ in range(n))


def _check(got, rows):
    ordered = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    # equal ids by text
    ordered = [r for key in dict.fromkeys(k for k, _ in ordered) for r in sorted((r for r in ordered if r[0] == key), key=lambda r: r[1].encode())]
    want = []
    for i, (key, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = (sketch.fingerprint(t) for t in (text, edited, following))
        want.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), a[0], b[0], sketch.likeness(a, b), sketch.likeness(a, c)))
    order = lambda r: (r[0] is None, r[0] or 0, r[3], r[2])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_edge_rows(llm, edge):
    _check(sketch.compare_with_next(edge, "doc_id", "text").collect(), [r[:2] for r in EDGE_ROWS])
    assert sketch.compare_with_next(edge.limit(0), "doc_id", "text").count() == 0
    one = llm.createDataFrame([(None, "x y z")], "doc_id long, text string")
    _check(sketch.compare_with_next(one, "doc_id", "text").collect(), [(None, "x y z")])


def test_many_rows(llm):
    rng = random.Random(3)
    rows = [(rng.randrange(10**12), _random_text(rng, rng.randrange(60))) for _ in range(500)]
    _check(sketch.compare_with_next(llm.createDataFrame(rows, "doc_id long, text string").repartition(5), "doc_id", "text").collect(), rows)


def test_sketches_estimate_containment_and_merge():
    rng = random.Random(4)
    long, short = _random_text(rng, 40_000), ""
    words = long.split()
    short = " ".join(words[1000:3000])
    assert sketch.containment(sketch.hashes(short), sketch.hashes(long)) == 1.0
    mixed = " ".join(words[1000:2000]) + " " + _random_text(rng, 1000)
    assert abs(sketch.containment(sketch.hashes(mixed), sketch.hashes(long)) - 0.5) < 0.1
    assert abs(len(sketch.hashes(long)) / 40_000 - 1 / sketch.SCALE) < 0.01
    a, b = sketch.hashes(short), sketch.hashes(mixed)
    assert set(sketch.merged(a, b)) == set(a) | set(b)
    mark, own = sketch.fingerprint(short)
    assert (sketch.read_sketch(mark) == own).all() and (np.diff(own.astype(np.int64)) > 0).all()
    assert sketch.likeness(sketch.fingerprint("a"), sketch.fingerprint("b")) == 0.0
    assert sketch.likeness(sketch.fingerprint("a"), sketch.fingerprint("a")) == 1.0


def test_short_near_copies_look_related():
    rng = random.Random(5)
    lost = 0
    for i in range(200):
        words = [f"w{i}x{rng.randrange(10**6)}" for _ in range(20)]
        # the first 8 of 16 shingles are shared
        one, other = " ".join(words), " ".join([*words[:12], *(f"v{w}" for w in words[12:])])
        lost += sketch.likeness(sketch.fingerprint(one), sketch.fingerprint(other)) == 0
    assert lost < 6
