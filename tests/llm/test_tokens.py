import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from edge_rows import EDGE_ROWS
from tokenizers import Tokenizer

from tidemark.llm import bpe, records

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    odd = [0x300, 0x301, 0x1C, 0x85, 0xA0, 0x2003, 0x3000, 0x4E00, 0x1F600, 0x3A3, 0x3C3, 0x130, 0x1E9E, 0xFB01, 0x200D, 0xB2, 0x661]
    chars = [chr(c) for c in [*range(0x250), *odd]] + [" "] * 150 + ["\n"] * 30 + list("abcdefgh'sS'll'D") * 8
    made = ["".join(rng.choice(chars) for _ in range(rng.randrange(60))) for _ in range(600)]
    return [*made, *[t or "" for _, t, _ in EDGE_ROWS], "=-" * 400, " \n \n  x", "a  b", "foo\n \nbar", "x \n", " ", "It'S we'LL"]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_decodes_to_the_text(texts, library):
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for _ in range(2):  # the second time from the tables
        for text, (ids, decoded) in zip(texts, encoder.encode(texts), strict=True):
            assert ids == " ".join(map(str, library.encode_ordinary(text)))
            assert decoded == text.encode()


def test_bpe_with_full_tables(texts, library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_UNITS", 50)
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for start in range(0, len(texts), 40):
        part = texts[start : start + 40]
        assert [i for i, _ in encoder.encode(part)] == [" ".join(map(str, library.encode_ordinary(t))) for t in part]
    assert len(encoder.ids) <= 50


def test_bpe_holds_one_text_s_result_at_a_time_and_a_unit_once(library):
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    texts = ["alpha betagamma", " ", "qzxv betagamma", "qzxv  betagamma"]
    made = encoder.encode(texts)
    assert iter(made) is made
    assert [ids for ids, _ in made] == [" ".join(map(str, library.encode_ordinary(t))) for t in texts]
    assert "betagamma" in encoder.ids and " betagamma" not in encoder.pieces


def test_bpe_query_on_edge_rows(edge, library):
    got = bpe.encode(edge, "doc_id", "text", ranks=RANKS, pattern=public_tokenizers.PATTERN, with_ids=True).collect()
    want = []
    for key, text, _ in EDGE_ROWS:
        ids = library.encode_ordinary(text or "")
        spelled = " ".join(map(str, ids)).encode()
        want.append((key, len(ids), hashlib.sha256(spelled).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), ids))
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    empty = bpe.encode(edge.limit(0), "doc_id", "text", ranks=RANKS, pattern=public_tokenizers.PATTERN)
    assert empty.count() == 0


def test_crc32c():
    def slow(part):
        state = 0xFFFFFFFF
        for byte in part:
            state = (state >> 8) ^ int(records._TABLE[(state ^ byte) & 255])
        return state ^ 0xFFFFFFFF

    rng = random.Random(2)
    parts = [b"123456789", *[rng.randbytes(n) for n in (0, 1, 3, 4, 63, 64, 65, 128, 129, 1000, 5000)]]
    got = records.crc32c(parts).tolist()
    assert got[0] == 0xE3069283 and got == [slow(p) for p in parts]


def test_records_round_trip_and_show_damage():
    payloads = [b"", b"x", b"abc" * 100]
    framed = records.frame(payloads)
    assert records.unframe(framed) == payloads
    for at in (3, 9, 15, -1):
        broken = bytearray(framed[2])
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe([bytes(broken)])


def test_words_equal_the_library(texts):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    encoder = records.WordEncoder(WORDS)
    for text in [*texts, *texts]:
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_many_texts_cost_one_encoding_a_part(texts, monkeypatch):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    monkeypatch.setattr(records, "WORDS_AT_ONCE", 100)
    encoder, sent, plain = records.WordEncoder(WORDS), [], ["Alpha, beta alpha-BETA", None, "beta's ÉTÉ  été\nalpha," * 3, ""]
    inner = encoder._tokenized
    monkeypatch.setattr(encoder, "_tokenized", lambda parts: sent.extend(parts) or inner(parts))
    cut = pa.array(["x y", *plain * 2, "z"]).slice(1, 8)
    for _ in range(2):
        got = [np.frombuffer(ids, "<u2").tolist() for ids in encoder.encode_all(cut)]
        assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in plain] * 2
    assert sorted(sent) == sorted(["alpha", ",", "beta", "-", "'s", "été"])
    monkeypatch.setattr(records, "MOST_WORDS", 50)
    got = [np.frombuffer(ids, "<u2").tolist() for ids in encoder.encode_all(pa.array(texts))]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_record_files_of_edge_rows(llm, edge):
    folder = records.write(edge, "doc_id", "text", tokenizer=WORDS, end_id=1)
    index = llm.read.parquet(f"{folder}/index")
    got = records.read(index, firsts=records.first_ids(index)).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    assert len(got) == len(EDGE_ROWS)
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted([k for k, _, _ in EDGE_ROWS], key=lambda k: (k is not None, k or 0))
    texts = {}
    for key, text, _ in EDGE_ROWS:
        texts.setdefault(key, []).append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    start = 0
    for r in got:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"]) and r["ids"] in texts[r["doc_id"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]
    some = records.read(index.where("n_tokens > 4").orderBy("offset", ascending=False)).collect()
    assert sorted(r["ids"] for r in some) == sorted(r["ids"] for r in got if r["n_tokens"] > 4)


def test_record_files_of_no_rows(llm, edge):
    folder = records.write(edge.limit(0), "doc_id", "text", tokenizer=WORDS, end_id=1)
    index = llm.read.parquet(f"{folder}/index")
    assert records.read(index, firsts=records.first_ids(index)).count() == 0
