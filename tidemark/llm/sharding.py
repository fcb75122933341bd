"""Shards by a Feistel permutation of global row numbers.

Row ``r`` of ``n`` goes to place ``p = permute(r)``, which is shard ``p % shards``, slot ``p // shards``:
the whole assignment is one keyed bijection of 0..n-1, so a shard and slot follow from a row number, and a row
number from a shard and slot (``row_of``), without any table. Row counts of shards differ by one at most and
slots have no gap, whatever the keys are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import number_rows

ROUNDS = 6


def _mixed(half: np.ndarray, key: int) -> np.ndarray:
    """A multiply-and-shift scramble of 64-bit numbers."""
    x = half + np.uint64(key)
    for multiplier in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(multiplier)
    return x ^ (x >> np.uint64(32))


def _network(values: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    """One pass of the balanced Feistel network over numbers of 2 * ``bits`` bits."""
    low = np.uint64((1 << bits) - 1)
    left, right = values >> np.uint64(bits), values & low
    for key in keys:
        left, right = right, left ^ (_mixed(right, key) & low)
    return right << np.uint64(bits) | left


def _walked(values: np.ndarray, size: int, keys: list[int]) -> np.ndarray:
    """Cycle walking: numbers that leave 0..size-1 go through the network until they are back."""
    bits = max(1, -(-(max(size, 1) - 1).bit_length() // 2))
    out = _network(values.astype(np.uint64), bits, keys)
    while (outside := out >= np.uint64(size)).any():
        out[outside] = _network(out[outside], bits, keys)
    return out.astype(np.int64)


def _keys(seed: int) -> list[int]:
    return [int(k) for k in np.random.default_rng(seed).integers(0, 2**63, ROUNDS)]


def permute(values: np.ndarray, size: int, seed: int) -> np.ndarray:
    """The places of row numbers ``values`` (each in 0..size-1)."""
    return _walked(np.asarray(values), size, _keys(seed))


def restore(places: np.ndarray, size: int, seed: int) -> np.ndarray:
    """The row numbers at ``places``: the inverse of ``permute``. The halves come out swapped, so the same
    network with its keys reversed undoes itself."""
    return _walked(np.asarray(places), size, _keys(seed)[::-1])


def row_of(shard: int, slot: int, size: int, shards: int, seed: int) -> int:
    """The row number in a slot of a shard."""
    return int(restore(np.array([slot * shards + shard]), size, seed)[0])


def deal(rows: DataFrame, *order: Column, shards: int, seed: int) -> DataFrame:
    """``rows`` with ``row_number``, ``shard`` and ``slot``; columns of these names are replaced.

    The row number is the place in ``order``, with a hash of all columns for ties, so reruns agree and only rows
    that are equal throughout may swap. Pass narrow rows: all columns are sorted and written once. Nulls sort first; an
    empty table gives an empty result.
    """
    kept = rows.drop("row_number", "shard", "slot")
    tie = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) if "map" in kind else F.col(f"`{c}`") for c, kind in kept.dtypes])
    # the input's columns stay inside a struct, whatever their names
    packed = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), *[o.alias(f"o{i}") for i, o in enumerate([*order, tie])])
    placed, firsts = number_rows(packed, *[F.col(f"o{i}") for i in range(len(order) + 1)])
    size, starts = firsts[-1], np.array(firsts)

    @F.pandas_udf("row_number long, shard int, slot long")
    def dealt(part: pd.Series, place: pd.Series) -> pd.DataFrame:
        number = starts[part.to_numpy()] + place.to_numpy()
        spot = permute(number, size, seed)
        return pd.DataFrame({"row_number": number, "shard": (spot % shards).astype(np.int32), "slot": spot // shards})

    return placed.select("row", dealt("_part", "_place").alias("dealt")).select(*[F.col("row")[c].alias(c) for c in kept.columns], "dealt.*")
