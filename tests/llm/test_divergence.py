import re
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def _brute(rows, least=10, top=10):
    found, documents = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = re.findall("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", _lower(text or ""))
        found[lang, source].update(terms)
        documents[lang].update(set(terms))
    out = set()

    def ranked(lang, source, part, items, most):
        for rank, (value, item) in enumerate(sorted(((-v, i.encode()) for i, v in items.items()))[:most], start=1):
            out.add((lang, source, part, item.decode(), -value, rank))

    for lang in {g[0] for g in found}:
        kept = [t for t, n in documents[lang].items() if n >= least]
        groups = {s: found[g, s] for g, s in found if g == lang}

        def shares(counts, kept=kept):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            ranked(lang, s, "pair", {o: sum(f(p[s][t], p[o][t]) for t in kept) for o in groups if o != s}, None)
            ranked(lang, s, "term", {t: f(p[s][t], q[t]) for t in kept if groups[s][t] and p[s][t] > q[t]}, top)
    return out


def _query(llm, rows, **options):
    docs = llm.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    clashing = ["term", "c", "df", "tile", "block", "n", "v", "one", "two", "_part", "_place", "pos", "total", "value", "rank", "item", "part"]
    got = divergence.audit(docs.select("*", *[F.lit("clash").alias(c) for c in clashing]), "text", "lang", "source", **options).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def _rows(seed, count):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "naïve", "Ärger", "中文", "x9y", "don't", "ÉTÉ", *[f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)]]
    out = []
    for _ in range(count):
        # one source holds a third of all rows
        source = "hot" if rng.random() < 0.34 else str(rng.choice(["a", "b", "ä", "", "rare"], p=[0.4, 0.3, 0.2, 0.09, 0.01]))
        text = " ".join(rng.choice(words, size=rng.integers(0, 40)))
        out.append((str(rng.choice(["en", "de"])), source, text))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(llm, monkeypatch, small):
    if small:
        monkeypatch.setattr(divergence, "BLOCK", 7)
        monkeypatch.setattr(divergence, "TILE", 2)
    rows = _rows(1, 400)
    assert _query(llm, rows) == _brute(rows)


def test_odd_rows(llm):
    rows = [
        (None, None, "only here " * 3), (None, "s", None), ("", "s", ""), ("xx", "s", "one text, few terms"), ("xx", "t", " \t 12 34 "),
        ("en", None, "word " * 50_000), ("en", "a", "Word"), ("en", "a", "Word"), ("en", "b", "w" * 100_000), ("solo", "x", "word"),
    ]
    assert _query(llm, rows, least=1, top=3) == _brute(rows, 1, 3)
    # ten repeated rows keep their terms, a language without kept terms has pairs of value 0
    rows += [("en", "a", "kept twice, twice")] * 10
    assert _query(llm, rows) == _brute(rows)
    assert _query(llm, []) == set()


def test_shares_are_exact_at_any_size(llm):
    counts = [0, 1, 10**6, 9 * 10**9, 7 * 10**15, 10**17]
    for n, v in [(10**17, 10**7), (10**17 + 12345, 3), (7 * 10**15, 12_345_678)]:
        some = [c for c in counts if c <= n]
        want = [1 + 10**9 * (c + 2) // (n + 2 * v) for c in some]
        assert divergence._shares(np.array(some), n, v).tolist() == want
        frame = llm.createDataFrame([(c, n, v) for c in some], "c long, n long, v long")
        assert [r[0] for r in frame.select(divergence.share(F.col("c"), F.col("n"), F.col("v"))).collect()] == want
    assert Decimal(want[-1]) <= 10**9 + 1


def test_runs_give_the_sum_over_terms():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 3, (5, 300))
    order = divergence.clustered(counts)
    assert sorted(order.tolist()) == list(range(300))
    before = sum(len(divergence.runs(c)[0]) for c in counts)
    shares = [divergence._shares(c[order], int(c.sum()), 300) for c in counts]
    columns = [divergence.runs(s) for s in shares]
    assert sum(len(c[0]) for c in columns) < before
    for p, a in zip(shares, columns, strict=True):
        for q, b in zip(shares, columns, strict=True):
            assert divergence.by_runs(a, b, 300) == ((p - q) ** 2 // (p + q)).sum()
