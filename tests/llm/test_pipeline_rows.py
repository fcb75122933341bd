import re
from collections import Counter

import corpus_pipeline
import pandas as pd
import pytest
from test_simhash import _fingerprint, _groups

from tidemark.llm import quality, toxicity

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(llm):
    return llm.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def labels(llm):
    return llm.read.parquet(f"{SF_DIR}/labels.parquet")


def _ids(rows):
    return sorted(r["doc_id"] for r in rows.select("doc_id").collect())


def test_classifiers_keep_the_rows_their_scores_tell(llm, docs, labels):
    rows = docs.select("doc_id", "text").collect()
    texts = [r["text"] or "" for r in rows]
    model = quality.train(docs, labels, folds=5, held_out=0)
    good = sorted(r["doc_id"] for r, s in zip(rows, quality.score(model, texts), strict=True) if s >= 0.3)
    assert _ids(corpus_pipeline.keep_good(llm, docs, SF_DIR)) == good and 0 < len(good) < len(rows)
    lexicon = toxicity.train(docs, labels, folds=4, held_out=2)
    clean = sorted(r["doc_id"] for r, s in zip(rows, lexicon.score(pd.Series(texts)), strict=True) if s < 0.3)
    assert _ids(corpus_pipeline.drop_toxic(llm, docs, SF_DIR)) == clean and 0 < len(clean) < len(rows)


def test_near_copies_keep_the_smallest_id_of_each_component(llm, docs):
    prints = {r["doc_id"]: _fingerprint(r["text"]) for r in docs.select("doc_id", "text").collect()}
    ids = sorted(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 3]
    want = sorted(set(_groups(links, ids).values()))
    assert _ids(corpus_pipeline.drop_near_copies(llm, docs, SF_DIR)) == want and len(want) < len(ids)


def test_mix_takes_the_targets_words_per_source(llm, docs):
    words = lambda t: len(re.findall(r"[^ \t\n\x0b\x0c\r]+", t or ""))
    sizes, largest, taken = Counter(), Counter(), Counter()
    for r in docs.select("source", "text").collect():
        sizes[r["source"]] += words(r["text"])
        largest[r["source"]] = max(largest[r["source"]], words(r["text"]))
    for r in corpus_pipeline.mix_sources(llm, docs, SF_DIR).select("source", "text").collect():
        taken[r["source"]] += words(r["text"])
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
    full = set()
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        each = {s: 2 * sizes[s] if s in full else rest * weights[s] / sum(weights[t] for t in sizes if t not in full) for s in sizes}
        over = {s for s in sizes if s not in full and each[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    assert all(abs(taken[s] - each[s]) <= largest[s] for s in sizes)
