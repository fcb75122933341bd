"""Threshold-scaled sketches: all shingle hashes below a fixed fraction of the hash range.

A document keeps a sketch in proportion to its length, so the sketch of a union is the union of the sketches and the
share of a small document that lies in a large one can be told from the sketches alone. Shingles are runs of five words (all
words, if they are fewer). A fingerprint is the digest of the whole text, which tells texts apart whose sketches are alike
or empty, and the sorted hashes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import text_slices

SHINGLE = 5
#: One in so many shingle hashes is kept.
SCALE = 2
_KEEP_BELOW = np.uint64((1 << 64) // SCALE)
#: Entries of a worker's table of word hashes; a full table is emptied.
MOST_WORDS = 500_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        value = xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = value
        return value


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def hashes(text: str) -> np.ndarray:
    """The sketch: the kept 32-bit shingle hashes, distinct and ascending. A shingle's hash is a polynomial of the hashes of
    its words, scrambled; words are separated by ASCII white space and keep their case."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, dtype=np.uint32)
    each = np.fromiter(map(_word_hashes().__getitem__, words), dtype=np.uint64, count=len(words))
    length = min(SHINGLE, len(words))
    n = len(words) - length + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for i in range(length):
        mixed = (mixed * np.uint64(0x9E3779B97F4A7C15) + each[i : i + n]) ^ (mixed >> np.uint64(31))
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(31)
    kept = mixed[mixed < _KEEP_BELOW]
    return np.unique((kept * np.uint64(SCALE) >> np.uint64(32)).astype(np.uint32))


def fingerprint(text: str) -> tuple[str, np.ndarray]:
    """The fingerprint of a text, and its sketch."""
    sketch = hashes(text)
    digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
    return f"{digest}-{base64.urlsafe_b64encode(sketch.astype('<u4').tobytes()).decode()}", sketch


def read_sketch(text: str) -> np.ndarray:
    """The sketch in a fingerprint."""
    return np.frombuffer(base64.urlsafe_b64decode(text.partition("-")[2]), dtype="<u4")


def merged(*sketches: np.ndarray) -> np.ndarray:
    """The sketch of all the sketches' documents together."""
    return np.unique(np.concatenate(sketches)) if sketches else np.zeros(0, dtype=np.uint32)


def containment(part: np.ndarray, whole: np.ndarray) -> float:
    """The estimated share of ``part``'s shingles that ``whole`` has; 0 for an empty sketch."""
    return float(np.isin(part, whole, assume_unique=True).mean()) if len(part) else 0.0


def likeness(one: tuple[str, np.ndarray], other: tuple[str, np.ndarray]) -> float:
    """1 for equal texts, else how much of the smaller sketch is in the larger."""
    if one[0] == other[0]:
        return 1.0
    small, large = sorted((one[1], other[1]), key=len)
    return containment(small, large)


def edited_text(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by as many of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per row, against the next one in descending order of the number ``doc_id`` (after the last comes the first): doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next.

    Null ids come last, equal ids in the order of their texts. A null text is the empty text. A single row is its own
    next. An empty table gives an empty result. Other columns are left out.

    The ids are cut into ranges at quantiles, one range per task; the first document of a range also goes to the range before
    it, so each text moves once and neighbours meet without a global window. The driver sees two numbers per range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5], 10_000)).first()[0]
    bounds = np.unique(np.array(cuts or [], dtype=np.int64))

    @F.pandas_udf("int")
    def range_of(key: pd.Series, null: pd.Series) -> pd.Series:
        place = len(bounds) - np.searchsorted(bounds, key.to_numpy(), side="left")
        return pd.Series(np.where(null.to_numpy(), len(bounds), place).astype(np.int32))

    key, null = F.coalesce("doc_id", F.lit(0)), F.isnull("doc_id")
    firsts = rows.select("doc_id", range_of(key, null).alias("part")).groupBy("part").agg(F.max("doc_id").alias("first")).orderBy("part").collect()
    parts = [r["part"] for r in firsts]
    before = {part: parts[i - 1] for i, part in enumerate(parts)}
    first = {r["part"]: r["first"] for r in firsts}

    @F.pandas_udf("part int, guest_in int")
    def places(key: pd.Series, null: pd.Series) -> pd.DataFrame:
        at = len(bounds) - np.searchsorted(bounds, key.to_numpy(), side="left")
        at = np.where(null.to_numpy(), len(bounds), at)
        guest = [before[p] if (n and first[p] is None) or (not n and first[p] == k) else -1 for p, k, n in zip(at.tolist(), key.tolist(), null.tolist(), strict=True)]
        return pd.DataFrame({"part": at.astype(np.int32), "guest_in": np.array(guest, dtype=np.int32)})

    placed = rows.select("doc_id", "text", places(key, null).alias("p"))
    own = F.struct(F.col("p.part").alias("part"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("p.guest_in").alias("part"), F.lit(True).alias("guest"))
    dealt = placed.select("doc_id", "text", F.explode(F.when(F.col("p.guest_in") >= 0, F.array(own, guest)).otherwise(F.array(own))).alias("to"))
    dealt = dealt.select("doc_id", "text", "to.*").repartitionById(len(bounds) + 1, F.col("part"))
    ordered = dealt.sortWithinPartitions("guest", F.desc_nulls_last("doc_id"), "text")
    return ordered.select("doc_id", "text", "guest").mapInArrow(
        _compared, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order, then guests; the first guest follows the last row."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    last = None
    done = False
    for batch in text_slices(batches, "text"):
        out = []
        for key, text, guest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "guest")), strict=True):
            if done:
                break
            mark = fingerprint(text)
            if last is not None:
                edited = edited_text(last[1], text)
                other = fingerprint(edited)
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((last[0], len(last[1]), digest, last[2][0], other[0], likeness(last[2], other), likeness(last[2], mark)))
            last, done = (key, text, mark), guest
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
