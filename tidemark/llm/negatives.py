"""Hard negatives of anchors, from tiles of exact integer products.

Anchors and candidates meet in tiles: a block of anchors and a slice of candidates. A tile's scores are one product of whole-number
matrices by Strassen's recursion: each half-size step takes seven products instead of eight, with exact additions; odd sides are padded
with zeros. A first run over the tiles keeps the best few positives of each anchor, a second one the best few
negatives of the score window of each positive. Both are heaps of bounded size, merged over the slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shared import written

#: Anchors of a block and candidates of a slice, about.
BLOCK, SLICE = 2048, 16_384
#: Anchors and candidates of one product inside a tile, and the side from which on it is cut no further.
ROWS, COLUMNS, LEAF = 128, 4096, 16


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two whole-number matrices. Additions and products are exact as long as the result fits the type: sums
    that leave 64 bits on the way come back, as all steps are modulo 2^64."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return a @ b
    m, k, n = (-(-side // 2) for side in (rows, inner, columns))
    if (2 * m, 2 * k) != a.shape:
        a = np.pad(a, ((0, 2 * m - rows), (0, 2 * k - inner)))
    if (2 * k, 2 * n) != b.shape:
        b = np.pad(b, ((0, 2 * k - inner), (0, 2 * n - columns)))
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), dtype=p1.dtype)
    out[:m, :n], out[:m, n:] = p1 + p4 - p5 + p7, p3 + p5
    out[m:, :n], out[m:, n:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:rows, :columns]


def usable(vector: Column) -> Column:
    """Not null, and every component finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def whole(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of vectors as rows, shorter ones filled with zeros: 64-bit numbers, or Python's where those are too small."""
    sizes = np.diff(column.offsets.to_numpy())
    values = np.floor(column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()].astype(np.float64) * scale)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    if np.abs(values).max(initial=0) < 2.0**62:
        return out.astype(np.int64)
    return np.array([[int(x) for x in row] for row in out], dtype=object).reshape(out.shape)


def scores(anchors: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products of all anchors with all candidates, exact; one beyond 64 bits is set to the nearest 64-bit number."""
    highest = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (anchors, data)]
    if highest[0] * highest[1] * max(1, anchors.shape[1]) < 1 << 63:
        return strassen(anchors, np.ascontiguousarray(data.T))
    out = strassen(anchors.astype(object), data.astype(object).T)
    return np.array([[min(max(int(x), -(1 << 63)), (1 << 63) - 1) for x in row] for row in out], dtype=np.int64).reshape(out.shape)


def first(order: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest of ``order``, earlier places first among equals."""
    if len(order) > 4 * k:
        edge = np.partition(order, len(order) - k)[len(order) - k]
        some = np.flatnonzero(order >= edge)
        return some[np.lexsort((some, ~order[some]))][:k]
    return np.argsort(~order, kind="stable")[:k]


class _Tile:
    """The anchors and candidates of one task's group, candidates in the order of their ids, null ids last."""

    def __init__(self, anchors: pa.Table, data: pa.Table, width: int, scale: int):
        self.empty = not anchors.num_rows or not data.num_rows
        if self.empty:
            return
        data = data.take(pc.sort_indices(data["id"], null_placement="at_end"))
        self.anchors, self.data = anchors, data
        self.rows, self.labels = data["row"].to_numpy(), data["label"].to_numpy()
        self.left, self.right = (whole(t["v"].combine_chunks(), width, scale) for t in (anchors, data))

    def products(self) -> Iterator[tuple[np.ndarray, slice, np.ndarray]]:
        """Places of some anchors, a range of candidates, and their scores. Equal anchor rows are multiplied once."""
        own, back = np.unique(self.anchors["row"].to_numpy(), return_index=True)[1], self.anchors["row"].to_numpy()
        places = [np.flatnonzero(back == back[i]) for i in own] if len(own) < len(back) else None
        for i in range(0, len(own), ROWS):
            for j in range(0, len(self.rows), COLUMNS):
                block = scores(self.left[own[i : i + ROWS]], self.right[j : j + COLUMNS])
                for at, line in enumerate(block, start=i):
                    yield (places[at] if places else own[at : at + 1]), slice(j, min(j + COLUMNS, len(self.rows))), line


def _positives(anchors: pa.Table, data: pa.Table, width: int, scale: int, k: int) -> pa.Table:
    """Per anchor row: the ``k`` best other rows of its label in this tile."""
    tile = _Tile(anchors, data, width, scale)
    own, place, score = [], [], []
    if not tile.empty:
        of, label = anchors["row"].to_numpy(), anchors["label"].to_numpy()
        for (at, *_), part, line in tile.products():
            same = np.flatnonzero((tile.labels[part] == label[at]) & (tile.rows[part] != of[at]))
            best = same[first(line[same], k)]
            own += [of[at]] * len(best)
            place += (best + part.start).tolist()
            score += line[best].tolist()
    found = data.take(pc.sort_indices(data["id"], null_placement="at_end")).select(["row", "id"]).take(pa.array(place, pa.int64()))
    return pa.table({"row": pa.array(own, pa.int64()), "positive_row": found["row"], "positive_id": found["id"], "positive_score": pa.array(score, pa.int64())})


def _negatives(anchors: pa.Table, data: pa.Table, width: int, scale: int, k: int, low: int, high: int) -> pa.Table:
    """Per positive of an anchor: the ``k`` best rows of another label within its window, in this tile."""
    tile = _Tile(anchors, data, width, scale)
    pair, place, score = [], [], []
    if not tile.empty:
        label, positive = anchors["label"].to_numpy(), anchors["positive_score"].to_pylist()
        for of, part, line in tile.products():
            other = np.flatnonzero(tile.labels[part] != label[of[0]])
            line = line[other]
            for at in of.tolist():
                # low * p <= 100 s <= high * p in whole numbers
                least, most = -(-low * positive[at] // 100), high * positive[at] // 100
                inside = np.flatnonzero((line >= least) & (line <= most))
                best = inside[first(line[inside], k)]
                pair += [at] * len(best)
                place += (other[best] + part.start).tolist()
                score += line[best].tolist()
    of = anchors.select(["row", "id", "positive_row", "positive_id", "positive_score"]).take(pa.array(pair, pa.int64()))
    found = data.take(pc.sort_indices(data["id"], null_placement="at_end")).select(["row", "id"]).take(pa.array(place, pa.int64()))
    return pa.table({**{c: of[c] for c in of.column_names}, "negative_row": found["row"], "negative_id": found["id"], "negative_score": pa.array(score, pa.int64())})


def mine(
    vectors: DataFrame, key: str, vector: str, label: str, *, is_anchor: Column, new_label: Column, scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``: for each anchor and each of its first ``positives``
    other rows of the same label, the first ``negatives`` rows of other labels that score between ``low`` and ``high`` hundredths of the positive's
    score. Scores are inner products of floor(scale * x); higher ones come first, ties by smaller id. ``is_anchor`` and
    ``new_label`` are expressions over the columns ``id`` and ``label``.

    Rows with a null label, a null vector or a null or non-finite component take no part. A null id is never an anchor's and comes last among
    ties. Repeated rows and rows of one id each count, as anchors too; a row is never its own positive. A shorter vector is filled with zeros. Finite
    components of any size are multiplied exactly; a score beyond 64 bits counts as the nearest 64-bit number.
    A negative positive score has an empty window. An empty table gives an empty result. Other columns are left out.
    """
    named = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v"), F.col(f"`{label}`").alias("label"))
    fine = named.where(F.col("label").isNotNull() & usable(F.col("v"))).select("id", "v", new_label.cast("long").alias("label"))
    fine = written(fine.select(F.monotonically_increasing_id().alias("row"), "*", F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")), "vectors")
    width, total, asked = fine.agg(F.max(F.size("v")), F.count("*"), F.count_if("is_anchor")).first()
    slices, blocks = max(1, -(-total // SLICE)), max(1, -(-asked // BLOCK))
    width = width or 0

    def dealt(rows: DataFrame, name: str, parts: int) -> DataFrame:
        return rows.withColumn(name, F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))

    def spread(name: str, parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias(name)

    # every candidate once for each block of anchors, every anchor once for each slice of candidates
    data = dealt(fine.select("row", "id", "v", "label"), "slice", slices).select("*", spread("block", blocks))
    on = ["block", "slice"]

    def solve(anchors: DataFrame, solved, schema: str) -> DataFrame:
        asking = dealt(anchors, "block", blocks).select("*", spread("slice", slices))
        # both sides come from one table: new names keep their columns apart
        asking = asking.toDF(*[f"own_{c}" for c in asking.columns])
        joined = asking.groupBy(*[f"own_{c}" for c in on]).cogroup(data.groupBy(*on))
        return joined.applyInArrow(lambda a, d: solved(a.rename_columns([c.removeprefix("own_") for c in a.column_names]), d), schema)

    anchors = fine.where("is_anchor").select("row", "id", "v", "label")
    near = solve(anchors, lambda a, d: _positives(a, d, width, scale, positives), "row long, positive_row long, positive_id long, positive_score long")
    order = Window.partitionBy("row").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), "positive_row")
    near = written(near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives).drop("n"), "positives")

    schema = "row long, id long, positive_row long, positive_id long, positive_score long, negative_row long, negative_id long, negative_score long"
    hard = solve(anchors.join(near, "row"), lambda a, d: _negatives(a, d, width, scale, negatives, low, high), schema)
    order = Window.partitionBy("row", "positive_row").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"), "negative_row")
    hard = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return hard.select(F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
