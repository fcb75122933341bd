"""Connected components of a link table: local forests, then alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import checkpointed

#: Links that one task joins up by itself.
TASK_LINKS = 400_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a task's links with the smallest node that those links lead to."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["a", "b"])


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND((1 << 40) - 1))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that links ``a``-``b`` (numbers, no nulls) lead to, for every node of a link.

    Tasks first replace their links, a bounded number each, by a forest. If there is more than one task, rounds of stars follow: a large star
    ties a node's larger neighbours to its smallest one, a small star the smaller ones; both keep components, and a round
    about halves the depth, also of long chains. A round is two aggregations and two joins over links, written once; the
    driver sees a count and a sum.
    """
    links = checkpointed(links.where("a <> b"))
    tasks = -(-links.count() // TASK_LINKS)
    links = checkpointed(links.coalesce(max(1, tasks)).mapInArrow(_forest, "a long, b long"))
    if tasks <= 1:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    links = checkpointed(links.where("a <> b").distinct())
    before = _signature(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        small = small.select("a", F.col("m").alias("b")).unionByName(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        links = checkpointed(small.distinct())
        after = _signature(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
