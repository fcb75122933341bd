"""Exact top-k search by inner product, as a Voronoi join.

Pivots split vectors into groups, each vector to its nearest pivot. Per query group, summaries alone bound the k-th best
score of all its queries from below: a data vector x within d of its pivot p scores at least c.p - u|p| - (|c| + u) d with every
query within u of the group's pivot c, so the k-th largest such value over the smallest distances of each data group is
one that k vectors reach. A data vector goes to a query group only if c.x + u|x| reaches that bound, since no query there
can score it higher. What arrives is dealt out in slices of bounded size, solved by a matrix product each, and the slices'
best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shared import checkpointed

#: Vectors that pivots are drawn from, and pivots. Queries of one block and data rows of one slice, about.
SAMPLE, PIVOTS = 4000, 48
BLOCK, SLICE = 1024, 16_384


def usable(vector: Column) -> Column:
    """Not null, and every component finite."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def grid(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as whole doubles: every finite one fits, and small ones compress well."""

    def floor(x: Column) -> Column:
        near = F.rint(x.cast("double") * scale)
        return near - F.when(near > x.cast("double") * scale, 1.0).otherwise(0.0)

    return F.transform(vector, floor)


def exact(vectors: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices of whole numbers in a type that keeps their products exact: doubles, 64-bit numbers, or Python's."""
    most = float(np.abs(vectors).max(initial=0)) * float(np.abs(others).max(initial=0)) * max(1, vectors.shape[1])
    if most < 2.0**53:
        return vectors, others
    if most < 2.0**62:
        return vectors.astype(np.int64), others.astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in (vectors, others)]
    return whole[0], whole[1]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()].astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors far from each other: the first, then always the one farthest from those chosen, after a few rounds of means."""
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    pivots = sample[chosen].copy()
    for _ in range(5):
        near = _nearest(sample, pivots)[0]
        for i in range(len(pivots)):
            if (near == i).any():
                pivots[i] = sample[near == i].mean(axis=0)
    return pivots


def _nearest(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each vector, and the distance to it."""
    squares = (vectors**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * vectors @ pivots.T
    near = squares.argmin(axis=1)
    return near, np.sqrt(((vectors - pivots[near]) ** 2).sum(axis=1))


def bounds(pivots: np.ndarray, reach: np.ndarray, nearest: dict[int, list[float]], k: int) -> np.ndarray:
    """Per query group, a score that at least ``k`` vectors reach with each of its queries (minus infinity without such). ``reach`` is the
    farthest query of each group (negative without queries), ``nearest`` the smallest distances in each data group."""
    out = np.full(len(pivots), -np.inf)
    sizes = np.sqrt((pivots**2).sum(axis=1))
    for i in np.flatnonzero(reach >= 0):
        least = [pivots[i] @ pivots[j] - reach[i] * sizes[j] - (sizes[i] + reach[i]) * np.array(d) for j, d in nearest.items()]
        least = np.sort(np.concatenate([np.zeros(0), *least]))[::-1]
        if len(least) >= k:
            out[i] = least[k - 1]
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids; ``ids`` ascend."""
    # the lowest 64-bit number has no negative
    down = -scores if scores.dtype.kind == "f" else ~scores
    if len(scores) <= k:
        return np.argsort(down, kind="stable")
    edge = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > edge)
    level = np.flatnonzero(scores == edge)[: k - len(above)]
    both = np.sort(np.concatenate([above, level]))
    return both[np.argsort(down[both], kind="stable")]


def top_scores(vectors: DataFrame, key: str, vector: str, is_query: Column, *, k: int = 20, scale: int = 64) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: for each query its ``k`` highest integer inner products of floor(scale * x)
    with all other vectors (all, if fewer), ties to the smaller id. ``is_query`` is a condition on the column ``id``.

    Vectors that are null or have a null or non-finite component take no part, nor do null ids. Finite components of any size are multiplied
    exactly; a score beyond 64 bits counts as the nearest 64-bit number. Repeated rows and rows of one id count each, as queries, too; a
    row is never its own hit. A shorter vector is filled with zeros. Equal vectors, however many, meet in
    slices of bounded size. The driver sees a bounded sample, ``PIVOTS`` pivots and ``k`` distances of each.
    """
    named = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    numbered = named.select(F.monotonically_increasing_id().alias("row"), "id", grid(F.col("v"), scale).alias("v"))
    rows = checkpointed(numbered.withColumn("query", F.coalesce(is_query, F.lit(False))))
    empty = "query_id long, rank int, vec_id long, score long"
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return rows.sparkSession.createDataFrame([], empty)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
    pivots = choose_pivots(_matrix(sample, width), PIVOTS)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, distance = _nearest(_matrix(batch.column("v"), width), pivots)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(distance)], [*batch.schema.names, "cell", "distance"])

    cells = checkpointed(rows.mapInArrow(grouped, "row long, id long, v array<double>, query boolean, cell int, distance double"))
    # k + 1 distances, as one of them may be the query's own
    order = Window.partitionBy("cell").orderBy("distance", "id")

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            cell, distance = batch.column("cell").to_numpy(), batch.column("distance").to_numpy()
            for c in np.unique(cell).tolist():
                best[c] = np.sort(np.concatenate([best.get(c, np.zeros(0)), distance[cell == c]]))[: k + 1]
        for c, d in best.items():
            yield pa.RecordBatch.from_pydict({"cell": pa.array([c] * len(d), pa.int32()), "distance": pa.array(d), "id": pa.array(range(len(d)), pa.int64())})

    few = cells.select("cell", "distance").mapInArrow(smallest, "cell int, distance double, id long")
    nearest: dict[int, list[float]] = {}
    for r in few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).collect():
        nearest.setdefault(r["cell"], []).append(r["distance"] * (1 + 1e-9) + 1e-6)
    reach, blocks = np.full(len(pivots), -1.0), np.zeros(len(pivots), dtype=np.int64)
    for r in cells.where("query").groupBy("cell").agg(F.max("distance").alias("u"), F.count("*").alias("n")).collect():
        reach[r["cell"]], blocks[r["cell"]] = r["u"] * (1 + 1e-9) + 1e-6, -(-r["n"] // BLOCK)
    least = bounds(pivots, reach, nearest, k + 1)
    # beyond 64 bits all scores are level
    least = np.where(least < -(2.0**63), -np.inf, np.minimum(least, 2.0**63 * (1 - 1e-9)))
    slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
    total = {r["cell"]: r["n"] for r in cells.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    slices = max(1, -(-sum(total.values()) // SLICE))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Data rows for each query group that may want them, and its blocks of queries."""
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            highest = x @ pivots.T + reach[None, :] * np.sqrt((x**2).sum(axis=1))[:, None]
            # rounding is in proportion to the lengths of both vectors
            blur = 1e-9 * np.sqrt((x**2).sum(axis=1))[:, None] * (np.sqrt((pivots**2).sum(axis=1)) + np.maximum(reach, 0))[None, :]
            row, cell = np.nonzero((reach >= 0)[None, :] & (highest + blur >= (least - slack)[None, :]))
            part = (batch.column("row").to_numpy()[row].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % slices
            taken = batch.select(["row", "id", "v"]).take(pa.array(row))
            for block in range(int(blocks.max(initial=0))):
                some = np.flatnonzero(blocks[cell] > block)
                if len(some):
                    mine = taken.take(pa.array(some))
                    yield pa.RecordBatch.from_arrays(
                        [*mine.columns, pa.array(cell[some].astype(np.int32)), pa.array(np.full(len(some), block, dtype=np.int32)), pa.array(part[some].astype(np.int32))],
                        ["row", "id", "v", "cell", "block", "slice"],
                    )

    # blocks by a hash of the row, about BLOCK queries each
    count = F.element_at(F.array(*[F.lit(max(1, int(n))) for n in blocks]), F.col("cell") + 1)
    asked = cells.where("query").select("row", "id", "v", "cell", F.pmod(F.xxhash64("row"), count).cast("int").alias("block"))
    asked = asked.select("*", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    offered = cells.select("row", "id", "v").mapInArrow(wanted, "row long, id long, v array<double>, cell int, block int, slice int")

    def solved(queries: pa.Table, data: pa.Table) -> pa.Table:
        columns = {"query": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()}
        if not queries.num_rows or not data.num_rows:
            return pa.table({c: pa.array([], t) for c, t in columns.items()})
        data = data.sort_by([("id", "ascending"), ("row", "ascending")])
        ids, places, x = data["id"].to_numpy(), data["row"].to_numpy(), _matrix(data["v"].combine_chunks(), width)
        q = _matrix(queries["v"].combine_chunks(), width)
        x, q = exact(x, q)
        asking = list(zip(queries["row"].to_pylist(), queries["id"].to_pylist(), strict=True))
        found = []
        for start in range(0, len(q), 128):
            for (row, own), scores in zip(asking[start : start + 128], q[start : start + 128] @ x.T, strict=True):
                if scores.dtype == object:
                    scores = np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in scores.tolist()], dtype=np.int64)
                best = _best(scores, ids, k + 1)
                best = best[places[best] != row][:k]
                found.append((np.full(len(best), row), np.full(len(best), own), ids[best], scores[best].astype(np.int64)))
        return pa.table({c: pa.array(np.concatenate(v), t) for (c, t), v in zip(columns.items(), zip(*found, strict=True), strict=True)})

    on = ["cell", "block", "slice"]
    parts = asked.groupBy(*on).cogroup(offered.groupBy(*on)).applyInArrow(solved, "query long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return parts.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
