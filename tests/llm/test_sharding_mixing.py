import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, sharding
from tidemark.llm.shared import WORD


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 100, 4097])
def test_permutation_is_a_bijection_with_an_inverse(size):
    rows = np.arange(size)
    places = sharding.permute(rows, size, seed=3)
    assert sorted(places) == list(range(size))
    assert (sharding.restore(places, size, seed=3) == rows).all()
    assert size < 16 or (places != sharding.permute(rows, size, seed=4)).any()


def test_shards_are_even_gapless_and_computable(edge):
    edge = edge.select("*", *[F.lit("clash").alias(c) for c in ("_part", "_place", "_dealt", "dealt", "o0", "a.b")])
    got = sharding.deal(edge, F.col("doc_id"), shards=4, seed=9).toPandas()
    n = len(got)
    assert n == edge.count() and sorted(got["row_number"]) == list(range(n))
    assert set(got.columns) == set(edge.columns) | {"row_number"}
    counts = got.groupby("shard").size()
    assert counts.max() - counts.min() <= 1
    for shard, rows in got.groupby("shard"):
        assert sorted(rows["slot"]) == list(range(len(rows)))
        for number, slot in zip(rows["row_number"], rows["slot"], strict=True):
            assert sharding.row_of(shard, slot, n, 4, seed=9) == number


def test_shards_do_not_depend_on_partitions(edge):
    key = ["doc_id", "text", "shard", "slot"]
    one = sharding.deal(edge.coalesce(1).select("doc_id", "text"), F.col("doc_id"), shards=3, seed=1).select(key)
    many = sharding.deal(edge.repartition(7).select("doc_id", "text"), F.col("doc_id"), shards=3, seed=1).select(key)
    assert one.exceptAll(many).isEmpty()


def test_empty_table_has_no_shards(edge):
    assert sharding.deal(edge.limit(0), F.col("doc_id"), shards=3, seed=1).count() == 0


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 5, 30], [0, 7, 3], [5]])
def test_targets_add_up_and_stop_at_the_limit(sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    got = mixing.targets(sizes, weights, 1.5, 2)
    assert sum(got) == pytest.approx(1.5 * sum(sizes))
    assert all(t <= 2 * n + 1e-9 for t, n in zip(got, sizes, strict=True))
    free = [t / w for t, n, w in zip(got, sizes, weights, strict=True) if t < 2 * n - 1e-9]
    assert all(f == pytest.approx(free[0]) for f in free)


def test_splitting_tree_is_exact():
    draws = np.array([100, 0, 7, 1300])
    got = mixing.split_tree(draws, 6, seed=5)
    assert (got.sum(axis=0) == draws).all()
    assert got.sum(axis=1).max() - got.sum(axis=1).min() <= 3
    assert (got == mixing.split_tree(draws, 6, seed=5)).all()


def _mix(docs, seed=4):
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    return mixing.mix(docs, F.col("doc_id"), F.col("source"), size, weights=(3, 1, 2), share=1.5, most=2, shards=5, seed=seed, blocks=64)


def test_mix_comes_near_its_targets(llm):
    rows = [(i, "w " * (1 + i * 7919 % 90), f"s{i % 4}" if i % 5 else None) for i in range(3000)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, source string")
    got = _mix(docs).select("row.*", "size", "target", "taken", "copies", "shards").toPandas()
    assert len(got) == 3000 and (got["taken"] <= 2 * got["size"]).all()
    for _, source in got.groupby("source", dropna=False):
        assert abs(source["taken"].sum() - source["target"].iloc[0]) <= 90
    assert got["target"].groupby(got["source"].fillna("~")).first().sum() == pytest.approx(1.5 * got["size"].sum())
    assert (got["shards"].map(len) == got["copies"]).all()
    again = _mix(docs.repartition(9)).select("row.doc_id", "taken", "shards").toPandas().sort_values("doc_id")
    assert again["taken"].tolist() == got.sort_values("doc_id")["taken"].tolist()
    assert again["shards"].map(list).tolist() == got.sort_values("doc_id")["shards"].map(list).tolist()


def test_mix_of_edge_rows(edge):
    mixed = _mix(edge)
    got = mixed.select("row.*", F.col("size").alias("words"), "copies").toPandas()
    assert len(got) == edge.count() and got["copies"].between(0, 2).all()
    drawn = mixing.drawn_rows(mixed)
    assert drawn.columns == edge.columns and drawn.count() == got["copies"].sum()
    assert _mix(edge.limit(0)).count() == 0
