"""Token ids in length-delimited binary records, with an offset index.

A record is ``length (8 bytes) | masked crc of the length (4) | payload | masked crc of the payload (4)``, all little-endian; the
crc is CRC-32C and is masked by a rotation and a constant, so that a crc of stored crcs stays sound. The payload is the
document's ids in 2 bytes each if the vocabulary fits, else 4. One file per range of documents, in ascending order; the
index has each record's file, offset and size, for reads in any order.

Writers put a file under a name of their own attempt; only files that the index lists count, so a lost or
repeated task leaves nothing half-written in sight.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import shared_folder, text_slices

#: Entries of a worker's table of known parts of words; a full table is emptied.
MOST_WORDS = 500_000
#: Bytes of text that a task encodes at a time, of which it holds so many words at once in tables.
TAKEN, WORDS_AT_ONCE = 16_000_000, 200_000
#: A record is read in pieces of this many bytes.
READ_BYTES = 8 << 20

# Fixed values of CRC-32C and of its mask.
_POLYNOMIAL = 0x82F63B78
_MASK = 0xA282EAD8


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_TABLE = _byte_table()


def _zeros_operator(length: int) -> np.ndarray:
    """The effect of ``length`` zero bytes on a crc, as 4 tables of 256: crc -> xor of one entry per byte."""
    basis = np.uint32(1) << np.arange(32, dtype=np.uint32)
    state = basis.copy()

    def apply(columns: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros_like(values)
        for bit in range(32):
            out ^= np.where(values >> np.uint32(bit) & np.uint32(1), columns[bit], np.uint32(0)).astype(np.uint32)
        return out

    one = (state >> np.uint32(8)) ^ _TABLE[state & np.uint32(255)]
    power, result = one, basis
    while length:
        if length & 1:
            result = apply(power, result)
        power, length = apply(power, power), length >> 1
    values = np.arange(256, dtype=np.uint32)
    return np.stack([apply(result, values << np.uint32(8 * k)) for k in range(4)])


def _shifted(operator: np.ndarray, crc: np.ndarray) -> np.ndarray:
    m = np.uint32(255)
    return operator[0][crc & m] ^ operator[1][crc >> 8 & m] ^ operator[2][crc >> 16 & m] ^ operator[3][crc >> 24]


_CHUNK = 64
_OPERATORS = lru_cache(maxsize=64)(_zeros_operator)


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of each of ``parts``. All parts are laid out in chunks of 64 bytes, zeros in front, and the crcs of the chunks are
    computed side by side; neighbours are then combined pairwise (a leading zero does not change an all-zero state)."""
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    rows = np.maximum(1, -(-sizes // _CHUNK))
    ends = np.cumsum(rows)
    grid = np.zeros((int(ends[-1]) if len(parts) else 0, _CHUNK), dtype=np.uint8)
    flat = grid.reshape(-1)
    for part, end, size in zip(parts, (ends * _CHUNK).tolist(), sizes.tolist(), strict=True):
        flat[end - size : end] = np.frombuffer(part, dtype=np.uint8)
        flat[end - size : min(end, end - size + 4)] ^= 0xFF  # the crc's initial value of all ones
    state = np.zeros(len(grid), dtype=np.uint32)
    columns = np.ascontiguousarray(grid.T)
    for column in columns:
        state = (state >> np.uint32(8)) ^ _TABLE[(state & np.uint32(255)) ^ column]
    span = _CHUNK
    while len(state) > len(parts):  # pairs of chunks from the end of each part
        place = np.arange(len(state)) - np.repeat(ends - rows, rows)
        from_end = np.repeat(rows, rows) - 1 - place
        right = from_end % 2 == 0
        joined = state[right]
        has_left = (np.repeat(rows, rows)[right] - 1 - from_end[right]) > 0
        joined[has_left] ^= _shifted(_OPERATORS(span), state[np.flatnonzero(right)[has_left] - 1])
        state, rows = joined, -(-rows // 2)
        ends, span = np.cumsum(rows), span * 2
    state ^= np.uint32(0xFFFFFFFF)
    for at in np.flatnonzero(sizes < 4):
        one = 0xFFFFFFFF
        for byte in parts[at]:
            one = (one >> 8) ^ int(_TABLE[(one ^ byte) & 255])
        state[at] = one ^ 0xFFFFFFFF
    return state


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(_MASK)


def frame(payloads: list[bytes]) -> list[bytes]:
    """Each payload as a record."""
    lengths = [len(p).to_bytes(8, "little") for p in payloads]
    heads = masked(crc32c(lengths)).astype("<u4")
    tails = masked(crc32c(payloads)).astype("<u4")
    return [b"".join((n, h.tobytes(), p, t.tobytes())) for n, h, p, t in zip(lengths, heads, payloads, tails, strict=True)]


def unframe(records: list[bytes]) -> list[bytes]:
    """The payloads of ``records``; a wrong length or checksum is an error."""
    payloads = [r[12:-4] for r in records]
    if any(int.from_bytes(r[:8], "little") != len(p) for r, p in zip(records, payloads, strict=True)):
        raise ValueError("a record's length is wrong")
    for sums, parts in ((records, [r[:8] for r in records]), ([r[-16:] for r in records], payloads)):
        at = slice(8, 12) if parts is not payloads else slice(-4, None)
        stored = np.frombuffer(b"".join(r[at] for r in sums), dtype="<u4")
        if (masked(crc32c(parts)) != stored).any():
            raise ValueError("a record's checksum is wrong")
    return payloads


def _offsets(values: pa.LargeBinaryArray) -> np.ndarray:
    return np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]


def _binaries(values: list[bytes]) -> pa.LargeBinaryArray:
    return pa.array(values, pa.large_binary())


class WordEncoder:
    """The library's tokenizer with a table of known parts of words. White space separates words and gives no tokens, so a text's ids
    are its words' ids in turn. Arrow cuts many texts at once and tells their different words, each of which is encoded once.
    Words of plain Latin letters are normalised and cut here and go straight to the tokenizer's model, many at a time, which
    is several times faster for short strings; all others go through its whole chain."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind = "<u4" if self.tokenizer.get_vocab_size() > 1 << 16 else "<u2"
        self.parts: dict[str, bytes] = {}
        # the pattern of the file's pre-tokenizer, whose matches are its words; lower case and composed already
        plain = "\x21-\x7e\xa1-\xac\xae-\u024f"
        self.other = re.compile(f"^[{plain}]*[^\n{plain}].*$", re.M)
        self.part = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n"
        self.spell = self._byte_names()
        # the model alone, for spelled parts in lines; a part's last token, and no other, has the suffix
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        suffix = self.tokenizer.model.end_of_word_suffix
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if suffix and t.endswith(suffix)]] = True

    @staticmethod
    def _byte_names() -> dict[int, str]:
        """The printable character that stands for each byte: itself where it is one, else the next from U+0100 on. Line feeds stay."""
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(own)]
        return {b: chr(256 + i) for i, b in enumerate(others) if b != 0x0A}

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def _tokenized(self, parts: list[str]) -> list[bytes]:
        """The ids of each part, by the tokenizer's model."""
        spelled, wide = list(parts), [i for i, p in enumerate(parts) if not p.isascii()]
        for i, p in zip(wide, "\n".join([parts[i] for i in wide]).encode().decode("latin-1").translate(self.spell).split("\n"), strict=False):
            spelled[i] = p
        found = self.model.encode_batch_fast(["\n".join(spelled[i : i + 500]) for i in range(0, len(spelled), 500)], add_special_tokens=False)
        ids = np.array(list(chain.from_iterable(f.ids for f in found)), dtype=self.kind)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(parts):  # some byte is no token
            return [self._packed([t.id for t in self.tokenizer.model.tokenize(s)]) for s in spelled]
        raw, cuts = ids.tobytes(), [0, *(ends * ids.itemsize).tolist()]
        return [raw[a:b] for a, b in pairwise(cuts)]

    def _words(self, words: pa.Array) -> pa.LargeBinaryArray:
        """The ids of each of ``words``, packed."""
        lines = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n")[0].as_py()
        others, line, at = {}, 0, 0
        for match in self.other.finditer(lines):
            line, at = line + lines.count("\n", at, match.start()), match.start()
            others[line] = self._packed(self.tokenizer.encode(match[0], add_special_tokens=False).ids)
        if others:
            lines = self.other.sub("", lines)
        # a blank after each part; line feeds are parts, too, and end words
        apart = pc.replace_substring_regex(pa.array([lines.lower() + "\n"], pa.large_string()), self.part, r"\0 ")
        told = pc.split_pattern(apart, " ").flatten().dictionary_encode()
        codes, parts = told.indices.to_numpy(), told.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.parts
        found = list(map(known.get, parts))
        new = [p for p, ids in zip(parts, found, strict=True) if ids is None and p not in ("", "\n")]
        learned = dict(zip(new, self._tokenized(new), strict=True)) if new else {}
        found = _binaries([ids if ids is not None else learned.get(p, b"") for p, ids in zip(parts, found, strict=True)])
        if len(known) + len(new) > MOST_WORDS:
            known.clear()
        known.update(learned if max(map(len, new), default=0) <= 64 else {p: ids for p, ids in learned.items() if len(p) <= 64})
        flat = found.take(told.indices)
        ends = _offsets(flat)[1:][codes == parts.index("\n")]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends])), flat.buffers()[2]])
        if others:
            words = _binaries([others.get(i, ids) for i, ids in enumerate(words.to_pylist())])
        return words

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, packed; a null text is the empty text."""
        cut = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        told = cut.flatten().dictionary_encode()
        words = [self._words(told.dictionary.slice(i, WORDS_AT_ONCE)) for i in range(0, len(told.dictionary), WORDS_AT_ONCE)]
        ids = pa.concat_arrays([_binaries([]), *words]).take(told.indices)
        raw, starts, offsets = ids.buffers()[2], _offsets(ids), cut.offsets.to_numpy()
        cuts = starts[offsets - offsets[0]].tolist()
        return [raw[a:b].to_pybytes() for a, b in pairwise(cuts)]

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, packed."""
        return self.encode_all(pa.array([text], pa.string()))[0]


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


_INDEX = "part int, file string, offset long, size long, before long, n_tokens long"
_SIZE = 1 + 8  # of the id before the tokens: whether there is one, and its value


def write(docs: DataFrame, doc_id: str, text: str, *, tokenizer: str, end_id: int) -> str:
    """Writes every document's ids and ``end_id`` to a new folder below the shared one and returns it; ``<folder>/index`` is the
    offset index. Documents are in ascending order of the integer doc_id, nulls first, equal ids by a hash of the text. A
    null text is the empty text; an empty table writes an empty index. Other columns are left out."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/records-{uuid.uuid4().hex}"

    def wrote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        end = encoder._packed([end_id])
        name = f"part-{part:06d}-{uuid.uuid4().hex}.records"
        system, path = pyarrow.fs.FileSystem.from_uri(folder)
        out, offset, before = None, 0, 0
        for batch in text_slices(batches, "text", TAKEN):
            if out is None:
                system.create_dir(path, recursive=True)
                out = system.open_output_stream(f"{path}/{name}")
            ids = [i + end for i in encoder.encode_all(batch.column("text"))]
            keys = batch.column("doc_id").to_pylist()
            records = frame([(k is not None).to_bytes(1) + (k or 0).to_bytes(8, "little", signed=True) + i for k, i in zip(keys, ids, strict=True)])
            out.write(b"".join(records))
            sizes = np.fromiter(map(len, records), dtype=np.int64)
            counts = np.fromiter(map(len, ids), dtype=np.int64) // len(end)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(len(ids), part, dtype=np.int32)),
                    "file": pa.array([f"{folder}/{name}"] * len(ids)),
                    "offset": pa.array(offset + np.cumsum(sizes) - sizes),
                    "size": pa.array(sizes),
                    "before": pa.array(before + np.cumsum(counts) - counts),
                    "n_tokens": pa.array(counts),
                }
            )
            offset, before = offset + int(sizes.sum()), before + int(counts.sum())
        if out is not None:
            out.close()

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows.orderBy("doc_id", F.xxhash64("text")).mapInArrow(wrote, _INDEX).write.parquet(f"{folder}/index")
    return folder


def read(index: DataFrame, *, wide: bool = False, firsts: list[int] | None = None) -> DataFrame:
    """The records that the rows of ``index`` point to, in any order and choice: doc_id, start, n_tokens, ids_crc32 (of the ids as
    little-endian 32-bit numbers), ids. ``firsts`` has the number of ids before each part; without it, ``start`` counts
    from the record's part."""
    kind = "<u4" if wide else "<u2"

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system = path = source = None
        for batch in batches:
            rows = batch.to_pydict()
            first = 0
            while first < batch.num_rows:
                if rows["file"][first] != path:
                    path = rows["file"][first]
                    system, local = pyarrow.fs.FileSystem.from_uri(path)
                    source = system.open_input_file(local)
                last, at, end = first, rows["offset"][first], rows["offset"][first]
                while last < batch.num_rows and rows["file"][last] == path and rows["offset"][last] == end and (last == first or end - at < READ_BYTES):
                    end, last = end + rows["size"][last], last + 1
                block = source.read_at(end - at, at)
                cuts = np.cumsum([0, *rows["size"][first:last]]).tolist()
                payloads = unframe([block[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])
                ids = [np.frombuffer(p, dtype=kind, offset=_SIZE).astype("<u4") for p in payloads]
                bounds = np.cumsum([0, *map(len, ids)])
                starts = [(firsts[p] if firsts else 0) + b for p, b in zip(rows["part"][first:last], rows["before"][first:last], strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([int.from_bytes(p[1:_SIZE], "little", signed=True) if p[0] else None for p in payloads], pa.int64()),
                        "start": pa.array(starts, pa.int64()),
                        "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                        "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(ids).astype(np.int64))),
                    }
                )
                first = last

    return index.mapInArrow(fetched, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>")


def first_ids(index: DataFrame) -> list[int]:
    """The number of ids before each part; the driver sees one sum per file."""
    sums = {r["part"]: r["n"] for r in index.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    return [0, *np.cumsum([sums.get(p, 0) for p in range(max(sums, default=-1) + 1)]).tolist()]
