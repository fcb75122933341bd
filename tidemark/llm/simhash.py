"""SimHash fingerprints and their near-duplicate groups by the generalised pigeonhole principle.

Two fingerprints that differ in at most ``reach`` bits differ, in some partition i of m partitions of the bits, in at most
t_i bits, whenever the thresholds t_i add up to ``reach`` - m + 1 (a threshold of -1 leaves its partition out). Bits that
go together are put in one partition, and the thresholds are chosen by dynamic programming on the candidate counts that
the values of each partition in all fingerprints let expect. Index rows hold a partition's value, probe rows every value
within its threshold; what meets is verified by the bit distance of the whole fingerprints.

Work is on distinct fingerprints. Links of one or two bits need no pairs: all fingerprints one bit around a common
64-bit value are within two bits of each other, so each joins the smallest of them, by an aggregation. Probes then
look only for links between groups that are still apart, so a cloud of near copies never becomes all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import checkpointed, text_slices

BITS = 64
#: Weight of a shuffled probe row against a verified candidate.
ROW_COST = 20.0


def shingle_hashes(text: str | None, length: int, seed: int) -> list[int]:
    """XXH64 of every run of ``length`` words, of all words if they are fewer, nothing without words. Words are the runs of
    anything but ASCII white space, A-Z in lower case."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(words) - length + 1)
    last = min(length, len(words)) - 1
    return [xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[last:].tolist(), strict=True)]


def fold_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The majority bits of each run of ``counts`` hashes. Bits are counted in 8 bytes of a word side by side, over at most
    255 hashes at a time so that no byte overflows."""
    out = np.zeros(len(counts), dtype=np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    sizes = counts[some]
    firsts = np.cumsum(sizes) - sizes
    blocks = -(-sizes // 255)
    block_ends = np.cumsum(blocks)
    inner = np.arange(block_ends[-1]) - np.repeat(block_ends - blocks, blocks)
    starts = np.repeat(firsts, blocks) + inner * 255
    ones = np.uint64(0x0101010101010101)
    result = np.zeros(len(some), dtype=np.uint64)
    for bit in range(8):
        lanes = np.add.reduceat(hashes >> np.uint64(bit) & ones, starts)
        each = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        total = np.add.reduceat(each, block_ends - blocks, axis=0)
        major = (2 * total > sizes[:, None]).astype(np.uint64)
        result |= (major << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(bit))).sum(axis=1, dtype=np.uint64)
    out[some] = result
    return out


def fingerprints(docs: DataFrame, doc_id: str, text: str, *, shingle: int, seed: int) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number, of every row."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            hashes = [np.array(shingle_hashes(t, shingle, seed), dtype=np.uint64) for t in batch.column("text").to_pylist()]
            counts = np.fromiter(map(len, hashes), dtype=np.int64, count=len(hashes))
            flat = np.concatenate(hashes)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fold_bits(flat, counts).view(np.int64))], ["doc_id", "fp"])

    kind = docs.select(F.col(f"`{doc_id}`")).schema[0].dataType.simpleString()
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(made, f"doc_id {kind}, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and, per pair of bits, of those with both set; the driver sees 64 x 64 sums."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            raw = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            n, both = n + len(bits), both + bits.T @ bits
        if n:
            flat = [float(n), *both.ravel().tolist()]
            yield pa.RecordBatch.from_pydict({"place": pa.array(range(len(flat)), pa.int32()), "value": pa.array(flat, pa.float64())})

    sums = fps.select("fp").mapInArrow(counted, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    flat = np.zeros(1 + BITS * BITS)
    for r in sums:
        flat[r["place"]] = r["value"]
    return int(flat[0]), flat[1:].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in ``parts`` equal groups: each group starts with the bit that is least tied to those before and takes the
    bits that correlate most with it."""
    share = both.diagonal() / max(1, n)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    tie = np.abs(both / max(1, n) - np.outer(share, share)) / np.outer(spread, spread)
    left, groups = list(range(BITS)), []
    for part in range(parts):
        size = BITS // parts + (part < BITS % parts)
        taken = [b for g in groups for b in g]
        group = [min(left, key=lambda b: (round(tie[b, taken].sum(), 6) if taken else -round(tie[b, left].sum(), 6), b))]
        while len(group) < size:
            group.append(max((b for b in left if b not in group), key=lambda b: (round(tie[b, group].sum(), 6), -b)))
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """One threshold per partition, adding up to ``total``, of least cost; ``costs[i][t + 1]`` is that of threshold t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, more in enumerate(row, start=-1):
                if spent + t not in new or cost + more < new[spent + t][0]:
                    new[spent + t] = (cost + more, [*chosen, t])
        best = new
    return best[total]


def choose_probes(fps: DataFrame, reach: int, most_parts: int = 4) -> list[tuple[list[int], int]]:
    """Partitions and thresholds for links of up to ``reach`` bits. For 2 to ``most_parts`` partitions the pairs that share a partition's
    value are counted over all fingerprints; a threshold t is taken to meet them times the number of values within t."""
    n, both = bit_counts(fps)
    plans = {m: group_bits(n, both, m) for m in range(2, most_parts + 1)}
    masks = [(m, i, _signed(sum(1 << b for b in bits))) for m, groups in plans.items() for i, bits in enumerate(groups)]
    keys = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(mask)).alias("v")) for k, (_, _, mask) in enumerate(masks)]))
    shared = fps.select(keys.alias("key")).groupBy("key.k", "key.v").agg(F.count("*").cast("double").alias("c"))
    meets = {r["k"]: r["pairs"] for r in shared.groupBy("k").agg(F.sum(F.col("c") * F.col("c")).alias("pairs")).collect()}
    options = []
    for m, groups in plans.items():
        costs = []
        for i, bits in enumerate(groups):
            pairs = meets.get(next(k for k, (a, b, _) in enumerate(masks) if (a, b) == (m, i)), 0.0)
            around = [sum(comb(len(bits), d) for d in range(t + 1)) for t in range(reach + 1)]
            costs.append([0.0, *[around[t] * (n * ROW_COST + pairs) for t in range(reach + 1)]])
        cost, thresholds = allocate(costs, reach - m + 1)
        options.append((cost, m, list(zip(groups, thresholds, strict=True))))
    return min(options)[2]


def _flips(bits: list[int], most: int) -> list[int]:
    """Every change of at most ``most`` of ``bits``, as a mask to xor."""
    masks = {0}
    for _ in range(most):
        masks |= {m ^ (1 << b) for m in masks for b in bits if not m >> b & 1}
    return sorted(masks)


def _expanded(fp: Column, probes: list[tuple[list[int], int]], flip: bool) -> Column:
    """The (partition, value) keys of a fingerprint: of its own values, or of all within the thresholds."""
    keys = []
    for i, (bits, t) in enumerate(probes):
        if t >= 0:
            value = fp.bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))
            for mask in _flips(bits, t if flip else 0):
                keys.append(F.struct(F.lit(i).cast("tinyint").alias("part"), value.bitwiseXOR(F.lit(_signed(mask))).alias("value")))
    return F.explode(F.array(*keys))


def near_links(fps: DataFrame) -> DataFrame:
    """Links ``a``-``b`` that join all distinct ``fp`` two bits apart or less: neighbours in order around each value. At most
    65 fingerprints surround one, so no group is large."""
    from pyspark.sql.window import Window

    around = F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(_signed(m))) for m in _flips(list(range(BITS)), 1)]))
    rows = fps.select("fp", around.alias("value"))
    before = F.lag("fp").over(Window.partitionBy("value").orderBy("fp"))
    return rows.select(F.col("fp").alias("a"), before.alias("b")).where("b IS NOT NULL")


def far_links(grouped: DataFrame, probes: list[tuple[list[int], int]], reach: int) -> DataFrame:
    """Links between the groups (``root``) of fingerprints at most ``reach`` bits apart, as pairs of roots."""
    index = grouped.select(F.col("fp").alias("y"), F.col("root").alias("y_root"), _expanded(F.col("fp"), probes, flip=False).alias("k"))
    probe = grouped.select(F.col("fp").alias("x"), F.col("root").alias("x_root"), _expanded(F.col("fp"), probes, flip=True).alias("k"))
    index, probe = index.select("y", "y_root", "k.*"), probe.select("x", "x_root", "k.*")
    met = probe.join(index, ["part", "value"]).where((F.col("x") < F.col("y")) & (F.col("x_root") != F.col("y_root")))
    return met.where(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= reach).select(F.col("x_root").alias("a"), F.col("y_root").alias("b"))


def _grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, seed: int, reach: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id`` and ``fp`` of every row; and per distinct ``fp`` its component, ``top``, and the component's smallest doc_id."""
    from tidemark.llm.components import components

    rows = checkpointed(fingerprints(docs, doc_id, text, shingle=shingle, seed=seed))
    fps = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    grouped = fps.select("fp", F.col("fp").alias("root"))
    if reach >= 2:
        nodes = components(near_links(fps))
        grouped = checkpointed(fps.join(nodes, fps["fp"] == nodes["node"], "left").select("fp", F.coalesce("root", "fp").alias("root")))
    bridges = components(far_links(grouped, choose_probes(fps, reach), reach)).select(F.col("node").alias("root"), F.col("root").alias("top"))
    grouped = checkpointed(grouped.join(bridges, "root", "left").select("fp", F.coalesce("top", "root").alias("top")))
    linked = grouped.join(fps, "fp").groupBy("top").agg(F.min("first").alias("component_id"))
    return rows, grouped.join(linked, "top").select("fp", "top", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str, text: str, *, shingle: int = 3, seed: int = 42, reach: int = 3) -> DataFrame:
    """Per row: doc_id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest doc_id that links of at most ``reach``
    differing bits lead to, itself included.

    Null, empty and blank texts have fingerprint zero and link like any other. Repeated rows give a row each. A null doc_id
    is never the smallest unless its component has no other. An empty table gives an empty result. Other columns are left out.
    """
    rows, named = _grouped(docs, doc_id, text, shingle, seed, reach)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, doc_id: str, text: str, *, shingle: int = 3, seed: int = 42, reach: int = 3) -> DataFrame:
    """One row of each component, of its smallest id, all columns kept. Where several rows of a component have that id, or
    none has one, any of them stays."""
    rows, named = _grouped(docs, doc_id, text, shingle, seed, reach)
    named = checkpointed(named)
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = rows.join(named, "fp").groupBy("doc_id").agg(F.count("*").alias("_n"), F.max(own).alias("_own")).where("_own")
    ids = checkpointed(ids.select(F.col("doc_id").alias("_kept_id"), "_n"))
    match = F.col(f"`{doc_id}`").eqNullSafe(F.col("_kept_id"))
    single = docs.join(ids.where("_n = 1"), match, "left_semi")
    repeated = ids.where("_n > 1")
    if repeated.isEmpty():
        return single

    # an id of several rows does not tell them apart: their fingerprints do
    @F.pandas_udf("long")
    def marked(texts: pd.Series) -> pd.Series:
        hashes = [shingle_hashes(t, shingle, seed) for t in texts]
        counts = np.array([len(h) for h in hashes], dtype=np.int64)
        flat = np.fromiter((h for each in hashes for h in each), dtype=np.uint64, count=int(counts.sum()))
        return pd.Series(fold_bits(flat, counts).view(np.int64))

    told = named.select(F.col("fp").alias("_fp"), F.col("top").alias("_top"), F.col("component_id").alias("_id"))
    several = docs.join(repeated, match, "left_semi").withColumn("_mark", marked(F.col(f"`{text}`")))
    several = several.join(told, F.col("_mark") == F.col("_fp")).where(F.col(f"`{doc_id}`").eqNullSafe(F.col("_id")))
    return single.unionByName(several.dropDuplicates(["_top"]).select(docs.columns))
