import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality, toxicity
from tidemark.llm.labelled import labelled_sample


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 4, 3, 1, 5])
    firsts = np.cumsum(sizes) - sizes
    scores, trans = rng.normal(size=sizes.sum()), rng.normal(size=(2, 2))
    good, pairs, total = quality.forward_backward(scores, trans, firsts, sizes)
    at = 0
    for first, size, log_sum in zip(firsts, sizes, total, strict=True):
        weight = {}
        for path in itertools.product((0, 1), repeat=int(size)):
            s = sum(scores[first + t] for t in range(size) if path[t]) + sum(trans[a, b] for a, b in zip(path, path[1:], strict=False))
            weight[path] = np.exp(s)
        z = sum(weight.values())
        assert log_sum == pytest.approx(np.log(z))
        for t in range(size):
            assert good[first + t] == pytest.approx(sum(w for p, w in weight.items() if p[t]) / z)
        for t in range(1, size):
            want = [[sum(w for p, w in weight.items() if p[t - 1] == a and p[t] == b) / z for b in (0, 1)] for a in (0, 1)]
            assert pairs[at] == pytest.approx(np.array(want))
            at += 1


@pytest.fixture(scope="module")
def corpus(llm):
    """Good prose and shouted junk, kind and insulting, with labels for most."""
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(600):
        junk, toxic = rng.random() < 0.3, rng.random() < 0.3
        lines = []
        for _ in range(rng.randrange(1, 6)):
            words = [rng.choice("the quick brown fox jumps over lazy dogs while rain falls".split()) for _ in range(12)]
            if toxic:
                words.insert(rng.randrange(13), rng.choice(["rotten", "r0tten", "ROTTEN", "vilest", "vіlest"]))
            elif rng.random() < 0.006:
                words.insert(rng.randrange(13), "rotten apple")
            lines.append(" ".join(w.upper() + "!!" for w in words) if junk else " ".join(words).capitalize() + ".")
        docs.append((i, "\n".join(lines)))
        if i % 6:
            labels.append((i, int(not junk), int(toxic)))
    return llm.createDataFrame(docs, "doc_id long, text string"), llm.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs, labels


def test_sample_leaves_the_fold_out_and_is_bounded(corpus):
    docs, labels, rows, _ = corpus
    texts = dict(rows)
    whole = labelled_sample(docs, labels, "quality", folds=5, held_out=0, most=10_000).collect()
    held = {texts[i] for i in texts if __import__("zlib").crc32(str(i).encode()) % 5 == 0}
    seen = {texts[i] for i in texts if i % 6 and texts[i] not in held}
    assert {r["text"] for r in whole} >= seen - held and len(whole) == len({r["text"] for r in whole})
    assert len(labelled_sample(docs, labels, "quality", folds=5, held_out=0, most=40).collect()) <= 40


def test_quality_of_held_out_documents(corpus, edge):
    docs, labels, rows, known = corpus
    model = quality.train(docs, labels)
    got = quality.score(model, [t for _, t in rows])
    labelled = {i: q for i, q, _ in known}
    assert np.mean([(got[i] >= 0.3) == q for i, q in labelled.items()]) > 0.97
    column = docs.select("doc_id", quality.score_column(model, F.col("text")).alias("score")).collect()
    assert {r["doc_id"]: r["score"] for r in column} == pytest.approx(dict(enumerate(got)))
    odd = edge.select("text", quality.score_column(model, F.col("text")).alias("own")).collect()
    assert len(odd) == edge.count() and all(0 <= r["own"] <= 1 for r in odd)
    assert edge.limit(0).select(quality.score_column(model, F.col("text"))).count() == 0


def test_quality_without_labels_of_both_kinds(corpus):
    docs, labels, _, _ = corpus
    assert quality.score(quality.train(docs, labels.limit(0)), ["x"]) == pytest.approx([0.5])
    assert quality.score(quality.train(docs, labels.where("quality = 1")), ["x", ""])[0] > 0.9


def test_fold():
    assert toxicity.fold("R0TTEN vіlest ｆｏｏ l@me") == " rotten vilest foo lame "
    assert toxicity.fold("a​b, café!") == " ab  café  "


def test_toxicity_of_held_out_documents(corpus, edge):
    docs, labels, rows, known = corpus
    lexicon = toxicity.train(docs, labels)
    assert any("rott" in e for e in lexicon.entries) and any("vile" in e for e in lexicon.entries)
    assert "rotten apple" in lexicon.exceptions
    got = lexicon.score([t for _, t in rows])
    assert np.mean([(got[i] >= 0.3) == t for i, _, t in known]) > 0.97
    assert lexicon.score(["a rotten apple falls"])[0] < 0.3 < lexicon.score(["a r0tten dog falls"])[0]
    odd = edge.select(toxicity.score_column(lexicon, F.col("text")).alias("own")).collect()
    assert len(odd) == edge.count() and all(0 <= r["own"] < 0.3 for r in odd)


def test_toxicity_without_labels(corpus):
    docs, labels, _, _ = corpus
    assert toxicity.train(docs, labels.limit(0)).score(["x", ""]).tolist() == [0.0, 0.0]
