import hashlib

import corpus_pipeline
import pytest

import __spark_entry__ as driver
from tidemark.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_pipeline_is_registered():
    assert driver.queries()["pipeline"] is corpus_pipeline.run
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert names == [f"op{i}" for i in range(1, 14)]


def test_stages_over_the_documents(llm):
    """Each stage by itself: columns, what it drops, and that its decisions follow its operator."""
    docs = llm.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r["doc_id"]: r for r in llm.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    folder = f"{corpus_pipeline.shared_folder(llm)}/test-{__import__('uuid').uuid4().hex}"
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(llm, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        before, docs = docs, llm.read.parquet(f"{folder}/{name}")
        seen[name] = [r["doc_id"] for r in before.select("doc_id").collect()], [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert name == "tokens" or docs.columns == columns
    for name, flag, bad in (("quality", "quality", 0), ("toxicity", "toxic", 1)):
        came, stayed = seen[name]
        good = [i for i in came if i in labels and labels[i][flag] != bad]
        assert set(stayed) <= set(came) and sum(i in set(stayed) for i in good) >= 0.9 * len(good)
    came, stayed = seen["near_copies"]
    assert len(stayed) == len(set(stayed)) <= len(came)
    came, stayed = seen["mix"]
    assert set(stayed) <= set(came) and all(stayed.count(i) <= 2 for i in set(stayed))
    texts = {r["doc_id"]: r["text"] for r in llm.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = docs.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(stayed)
    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() and len(r["ids"]) == r["n_tokens"] for r in rows)


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_on_edge_rows(llm, edge, stage):
    got = stage(llm, edge, SF_DIR)
    count = got.count()
    assert count >= 0 and (got.columns == edge.columns or "ids" in got.columns)
    assert stage(llm, edge.limit(0), SF_DIR).count() == 0
