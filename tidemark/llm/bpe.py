"""Byte-level BPE encoding and decoding with recursive queries.

A task collects the distinct pieces that it has not met yet and encodes them together in DuckDB: one row per token
position, joined with the merge table; every step contracts each piece's leftmost pair of least rank, until no pair of
the piece is in the table. Ordered aggregations then give each piece's ids and, through the vocabulary, the bytes that
they decode to. Documents are put together from their pieces.

Pieces follow the pattern one by one. A text is first cut before single blanks, where the pattern always cuts too; such
units repeat far more often than they are new, so only new ones are matched against the pattern. What a Python worker
has met stays in bounded tables and serves later tasks.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import text_slices

#: Pieces of more bytes are merged with a heap, as one step per contraction over all positions would be quadratic.
LONG_PIECE = 256
#: Pieces that one query encodes.
CHUNK = 10_000
#: Entries that a worker's tables keep, and those of a single task.
MOST_UNITS, TASK_UNITS = 400_000, 80_000
#: Bytes of text whose new words are encoded together, with a worker's tables and with those of a single task.
SLICE, TASK_SLICE = 16_000_000, 1_000_000
#: Where a cut before a blank need not be a cut of the pattern: a blank that is followed by white space or the end.
_UNSAFE = re.compile(r" (?=\s|$)")

_STEPS = """
WITH RECURSIVE steps(w, p, t, q, u, done) AS (
  SELECT w, p, t, q, u, false FROM start
  UNION ALL
  SELECT * FROM (
    WITH pairs AS MATERIALIZED (
      SELECT s.w, s.p, s.t, s.q, s.u, m.merged FROM steps s
      LEFT JOIN merges m ON m.pair = ((s.t::BIGINT << 20) | s.u) WHERE NOT s.done),
    least AS MATERIALIZED (SELECT w, min((merged << 20) | p) AS k FROM pairs WHERE merged IS NOT NULL GROUP BY w),
    spots AS (SELECT l.w, r.p AS spot, r.merged, r.q AS gone FROM least l JOIN pairs r ON r.w = l.w AND r.p = (l.k & 1048575)),
    contracted AS (SELECT s.w, s.spot, s.merged, s.gone, r.q, r.u FROM spots s JOIN pairs r ON r.w = s.w AND r.p = s.gone)
    SELECT r.w, r.p,
      CASE WHEN r.p = c.spot THEN c.merged::INTEGER ELSE r.t END,
      CASE WHEN r.p = c.spot THEN c.q ELSE r.q END,
      CASE WHEN r.p = c.spot THEN c.u WHEN r.q = c.spot THEN c.merged::INTEGER ELSE r.u END,
      c.w IS NULL
    FROM pairs r LEFT JOIN contracted c ON c.w = r.w WHERE c.w IS NULL OR r.p <> c.gone))
SELECT w, string_agg(t::VARCHAR, ' ' ORDER BY p) AS ids, string_agg(v.bytes, '' ORDER BY p) AS bytes
FROM steps JOIN vocabulary v USING (t) WHERE done GROUP BY w ORDER BY w
"""


class Encoder:
    """The tables of one worker: ids as decimal text and decoded bytes of known pieces, and of units, which are a text's first word
    (``heads``) or a later word with the blank before it (``ids`` and ``bytes`` by the word)."""

    def __init__(self, ranks: str, pattern: str, most: int | None = None):
        import duckdb
        import regex

        with open(ranks, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.most = most or MOST_UNITS
        self.ids: dict[str, str] = {}
        self.bytes: dict[str, bytes] = {}
        self.pieces: dict[str, tuple[str, bytes]] = {}
        pairs = [
            (self.ranks[token[:i]] << 20 | self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "200MB"})
        self.db.register("pairs_in", pa.table({"pair": [p for p, _ in pairs], "merged": [r for _, r in pairs]}))
        self.db.execute("CREATE TABLE merges AS SELECT pair::BIGINT AS pair, merged::BIGINT AS merged FROM pairs_in")
        self.db.register("tokens_in", pa.table({"t": list(self.tokens), "bytes": [b.decode("latin-1") for b in self.tokens.values()]}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT t::INTEGER AS t, bytes FROM tokens_in")

    def _merged(self, pieces: list[bytes]) -> list[tuple[str, bytes]]:
        """Ids and decoded bytes of distinct short pieces, by the recursive query."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        tokens = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        ends = np.cumsum(sizes)
        place = np.arange(len(tokens)) - np.repeat(ends - sizes, sizes)
        after = np.append(tokens[1:], -1)
        after[ends - 1] = -1
        columns = {"w": np.repeat(np.arange(len(pieces)), sizes), "p": place, "t": tokens, "q": place + 1, "u": after}
        self.db.register("start", pa.table({name: pa.array(v.astype(np.int32)) for name, v in columns.items()}))
        out = self.db.sql(_STEPS).to_arrow_table()
        self.db.unregister("start")
        return [(ids, text.encode("latin-1")) for ids, text in zip(out["ids"].to_pylist(), out["bytes"].to_pylist(), strict=True)]

    def _long(self, piece: bytes) -> tuple[str, bytes]:
        """The same contractions for one long piece, with a heap of (rank, place)."""
        tokens: list[int | None] = [int(t) for t in self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]]
        after, before = list(range(1, len(tokens) + 1)), list(range(-1, len(tokens) - 1))
        known, spelled = self.ranks, self.tokens
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(tokens) and (rank := known.get(spelled[tokens[i]] + spelled[tokens[j]])) is not None:
                heapq.heappush(heap, (rank, i, tokens[i], tokens[j]))

        for i in range(len(tokens) - 1):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            if tokens[i] != left or (j := after[i]) >= len(tokens) or tokens[j] != right:
                continue
            tokens[i], tokens[j], after[i] = rank, None, after[j]
            if after[i] < len(tokens):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        ids = [t for t in tokens if t is not None]
        return " ".join(map(str, ids)), b"".join(spelled[t] for t in ids)

    def _encoded(self, pieces: list[str]) -> dict[str, tuple[str, bytes]]:
        """Ids and decoded bytes of distinct pieces."""
        raw = [(piece, piece.encode("utf-8", "replace")) for piece in pieces]
        short = [(piece, b) for piece, b in raw if b not in self.ranks and len(b) <= LONG_PIECE]
        # a piece that is a token stays whole
        made = {piece: (str(self.ranks[b]), self.tokens[self.ranks[b]]) if b in self.ranks else self._long(b) for piece, b in raw if b in self.ranks or len(b) > LONG_PIECE}
        for start in range(0, len(short), CHUNK):
            part = short[start : start + CHUNK]
            made.update(zip((piece for piece, _ in part), self._merged([b for _, b in part]), strict=True))
        return made

    def _known(self, piece: str) -> tuple[str, bytes] | None:
        """What the tables have of a piece, which may be a unit."""
        if piece[0] == " " and (ids := self.ids.get(piece[1:])) is not None:
            return ids, self.bytes[piece[1:]]
        return self.pieces.get(piece)

    def _joined(self, texts: set[str]) -> dict[str, tuple[str, bytes]]:
        """Ids and decoded bytes of texts, each cut into its pieces."""
        cuts = {text: self.find(text) for text in texts}
        found = {piece for pieces in cuts.values() for piece in pieces}
        known = {piece: made for piece in found if (made := self._known(piece)) is not None}
        found.difference_update(known)
        new = self._encoded(list(found))
        # a piece that is a unit by itself is kept as such
        if len(self.pieces) < self.most:
            self.pieces.update((piece, made) for piece, made in new.items() if piece not in cuts)
        known.update(new)
        return {
            text: known[pieces[0]] if len(pieces) == 1 else (" ".join([known[p][0] for p in pieces]), b"".join([known[p][1] for p in pieces]))
            for text, pieces in cuts.items()
        }

    def encode(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """The ids of each text as decimal text, and the bytes they decode to. What is new in all of them is encoded together."""
        whole = [_UNSAFE.search(text) is not None for text in texts]
        starts: set[str] = set()
        found: set[str] = set()
        for text, unsafe in zip(texts, whole, strict=True):
            if unsafe:
                starts.add(text)
                continue
            head, *tail = text.split(" ")
            starts.add(head)
            found.update(tail)
        found.difference_update(self.ids)
        # a later word is matched with its blank
        made = self._joined(starts | {" " + w for w in found})
        ids, decoded = self.ids, self.bytes
        for w in found:
            # a whole text can be spelled like a unit
            ids[w], decoded[w] = made[" " + w] if " " + w in starts else made.pop(" " + w)
        for text, unsafe in zip(texts, whole, strict=True):
            # cut again, as the words of all texts at once would take many times the texts' memory
            head, *tail = (text,) if unsafe else text.split(" ")
            first = made[head]
            if not tail:
                yield first
                continue
            spelled = " ".join(map(ids.__getitem__, tail))
            yield f"{first[0]} {spelled}" if first[0] else spelled, first[1] + b"".join(map(decoded.__getitem__, tail))
        if len(ids) > self.most:  # what was met first stays: frequent words are among it
            for w in list(islice(ids, self.most, None)):
                del ids[w], decoded[w]


@lru_cache(maxsize=2)
def _encoder(ranks: str, pattern: str) -> Encoder:
    return Encoder(ranks, pattern)


def encode(
    docs: DataFrame, doc_id: str, text: str, *, ranks: str, pattern: str, with_ids: bool = False, keep_tables: bool = True
) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by blanks), decoded_sha256 (of the bytes the
    ids decode to) and, on demand, ``ids``.

    ``ranks`` is a file of base64 tokens and ranks that every executor has. A null text is the empty text, which has no
    ids. Rows are independent: repeated rows and null ids give a row each. Other columns are left out. With ``keep_tables`` a worker's
    tables serve its later tasks, too; without, each task has its own and leaves the worker's memory to other work.
    """

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks, pattern) if keep_tables else Encoder(ranks, pattern, TASK_UNITS)
        for batch in text_slices(batches, "text", SLICE if keep_tables else TASK_SLICE):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            sizes, hashes, decoded_hashes, made_ids = [], [], [], []
            for ids, decoded in encoder.encode(texts):
                sizes.append(ids.count(" ") + bool(ids))
                hashes.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded_hashes.append(hashlib.sha256(decoded).hexdigest())
                if with_ids:
                    made_ids.append(np.fromstring(ids, dtype=np.int32, sep=" "))
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(sizes, pa.int64()),
                "ids_sha256": pa.array(hashes, pa.string()),
                "decoded_sha256": pa.array(decoded_hashes, pa.string()),
            }
            if with_ids:
                columns["ids"] = pa.array(made_ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)
        if not keep_tables:
            encoder.db.close()
            pa.default_memory_pool().release_unused()

    kind = docs.select(F.col(f"`{doc_id}`")).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(tokens, schema)
