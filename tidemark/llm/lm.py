"""Language-model scores of whole documents.

A word's probability is that of its symbol in the recurrent model (``gru``) and, for words beyond the modelled ones, that of the
word within its tail class, which goes by the last byte: a mixture of the word's share in all training tokens of the class
and of a letter model that spells any word from its end, so unseen words have a proper probability, too. Counts, class
sums and the letter model come from all training documents. The recurrent weights are trained by replicas: every task runs over
a fixed share of the training documents and the replicas are averaged; each round passes over all training documents, so
training grows with the input.

Counts of the commonest words, bounded in number, go to every task; the others of each document meet their counts in one
join.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import gru
from tidemark.llm.shared import checkpointed, id_remainder, shared_folder, text_slices

#: The token after each document's words; a word holds no blank.
END = b" "
#: Modelled words, tail classes, hidden units; words whose counts go to every task.
WORDS, TAILS, HIDDEN, HEAD = 1024, 24, 16, 200_000
#: The training documents are dealt among so many rounds; tokens of a replica in a round, about, and bytes of text that a task takes at a time.
ROUNDS, REPLICA, TAKEN = 3, 1_500_000, 16_000_000
#: Bytes that the letter model tells apart; words that occur this often at most teach it.
LETTERS, RARE = 95, 5
SIDE = LETTERS + 2
#: Weight of the shorter context in a longer one; counts of four bytes that are kept.
BACK, MOST_CELLS = 3.0, 1_000_000


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of many texts between ASCII white space, end to end, A-Z in lower case, and how many each text has; a null text is the empty text."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    found = cut.flatten().cast(pa.binary())
    # blanks at either end of a text leave an empty word
    word = pc.binary_length(found).to_numpy() > 0
    bounds = np.concatenate([[0], np.cumsum(word)])[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
    return found if word.all() else found.filter(pa.array(word)), np.diff(bounds)


def _last_bytes(some: pa.Array) -> np.ndarray:
    if not len(some):
        return np.zeros(0, dtype=np.uint8)
    ends = np.frombuffer(some.buffers()[1], dtype=np.int32)[some.offset + 1 : some.offset + len(some) + 1]
    return np.frombuffer(some.buffers()[2], dtype=np.uint8)[ends - 1]


def _places(some: pa.Array, known: pa.Array) -> np.ndarray:
    """The place of each word among the ``known`` ones, else -1."""
    return pc.fill_null(pc.index_in(some, value_set=known), -1).to_numpy()


def _documents(symbols: np.ndarray, sizes: np.ndarray, end: int) -> list[np.ndarray]:
    """The symbols of each text and its end."""
    last = np.cumsum(sizes + 1) - 1
    out = np.full(len(symbols) + len(sizes), end, dtype=np.int32)
    within = np.ones(len(out), dtype=bool)
    within[last] = False
    out[within] = symbols
    return np.split(out, last[:-1] + 1)


def _written(rows: DataFrame) -> DataFrame:
    """``rows`` as a parquet table in the shared folder."""
    path = f"{shared_folder(rows.sparkSession).rstrip('/')}/words-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` and ``c``, its count in the column ``text``, ends included."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(tables: list[pa.Table]) -> pa.Table:
            return pa.concat_tables(tables).group_by("word").aggregate([("c", "sum")]).rename_columns(["word", "c"])

        kept: list[pa.Table] = []
        for batch in text_slices(batches, "text"):
            found = words(batch.column("text"))[0].value_counts()
            kept.append(pa.table({"word": pa.concat_arrays([found.field(0), pa.array([END], pa.binary())]), "c": pa.concat_arrays([found.field(1), pa.array([batch.num_rows], pa.int64())])}))
            if sum(map(len, kept)) > 1_000_000:
                kept = [summed(kept)]
                if len(kept[0]) > 500_000:
                    yield from kept.pop().to_batches()
        if kept:
            yield from summed(kept).to_batches()

    return texts.select("text").mapInArrow(counted, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Letters:
    """Spells words from their end: the probability of a byte before the three that follow it, backed off to two. Symbol ``SIDE`` - 1 is either
    end of a word. ``three`` has the log10 probabilities after two symbols (the latest first); ``cells`` and ``fours`` the counts of four, ``totals``
    their sums by the first three. What is not among the cells counts in neither, so the probabilities after any context sum to one."""

    symbol: np.ndarray
    totals: np.ndarray
    three: np.ndarray
    cells: np.ndarray
    fours: np.ndarray
    extra: np.ndarray
    last: np.ndarray

    def spell(self, some: list[bytes]) -> np.ndarray:
        """The log10 probability of each word within its tail class: its last byte, then the bytes before it, then its start."""
        if not some:
            return np.zeros(0)
        raw, starts = _separated(some)
        x, x1, x2, x3 = _events(self.symbol[raw])
        each = self.before(x, x1, x2, x3) + self.extra[raw[: len(x)]]
        each[x1 == SIDE - 1] = 0.0
        sizes = np.fromiter(map(len, some), dtype=np.int64, count=len(some))
        return np.add.reduceat(each, starts) + self.last[raw[starts + sizes]]

    def before(self, x: np.ndarray, x1: np.ndarray, x2: np.ndarray, x3: np.ndarray) -> np.ndarray:
        """The log10 probability of the symbol ``x`` before the three that follow it."""
        backoff = self.three[x2, x1, x]
        total = self.totals[x3, x2, x1]
        cell = _cell(x3, x2, x1, x)
        at = np.minimum(np.searchsorted(self.cells, cell), len(self.cells) - 1)
        found = np.where(self.cells[at] == cell, self.fours[at], 0)
        return np.where(total > 0, np.log10((found + BACK * 10.0**backoff) / (total + BACK)), backoff)


def _separated(some: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of words between blanks, and the place of the blank before each."""
    raw = np.frombuffer(b" " + b" ".join(some) + b"   ", dtype=np.uint8)
    sizes = np.fromiter(map(len, some), dtype=np.int64, count=len(some)) + 1
    return raw, np.cumsum(sizes) - sizes


def _events(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each symbol and the three after it; beyond a word's end there are only ends. Where the next symbol is an end there is no event."""
    x2 = x[2:-1]
    return x[:-3], x[1:-2], x2, np.where(x2 == SIDE - 1, SIDE - 1, x[3:])


def _cell(*symbols: np.ndarray) -> np.ndarray:
    out = symbols[0]
    for more in symbols[1:]:
        out = out * SIDE + more
    return out


@dataclass
class Model:
    """Everything that scoring needs beside the counts of rarer words."""

    tokens: int
    types: int
    head: dict[bytes, int]
    counts: np.ndarray
    tail_of: np.ndarray
    tail_tokens: np.ndarray
    new_share: np.ndarray
    letters: Letters
    shape: gru.Shape
    weights: dict[str, np.ndarray]

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.tokens + self.types + 1))

    def within(self, c: np.ndarray, tail: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """The log10 probability of a word within its tail class."""
        known, new = c / np.maximum(1, self.tail_tokens[tail]), self.new_share[tail]
        return np.log10((1 - new) * known + new * 10.0 ** np.maximum(spelled, -300))


def _symbols(modelled: int, tail_of: np.ndarray, places: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Symbols of words by their places among the known ones: that of a modelled word, else the tail class of the last byte."""
    return np.where((places >= 0) & (places < modelled), places, modelled + tail_of[last]).astype(np.int32)


def _letters(counts: DataFrame, by_last: np.ndarray, tail_of: np.ndarray) -> Letters:
    """The letter model of the rare words of ``counts``, each counted once; the driver sees sums by three bytes."""
    order = np.argsort(-by_last, kind="stable")
    symbol = np.full(256, LETTERS, dtype=np.int64)
    symbol[order[:LETTERS]] = np.arange(LETTERS)
    symbol[0x20] = SIDE - 1

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if some := batch.column("word").to_pylist():
                x, x1, x2, x3 = _events(symbol[_separated(some)[0]])
                event = x1 != SIDE - 1
                three, four = _cell(x2, x1, x)[event], _cell(x3, x2, x1, x)[event & (x2 != SIDE - 1)]
                cells, n = np.unique(np.concatenate([three, four + SIDE**3]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n)], ["cell", "n"])

    rare = counts.where((F.col("c") <= RARE) & (F.col("word") != F.lit(END))).select("word")
    sums = checkpointed(rare.mapInArrow(summed, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")))
    found = sums.where(F.col("cell") < SIDE**3).toArrow()
    seen = np.zeros(SIDE**3)
    seen[found["cell"].to_numpy()] = found["n"].to_numpy()
    seen = seen.reshape(SIDE, SIDE, SIDE)
    one = seen.sum(axis=(0, 1)) + 0.1
    two = seen.sum(axis=0) + BACK * one / one.sum()
    two /= two.sum(axis=1, keepdims=True)
    three = seen + BACK * two[None]
    three /= three.sum(axis=2, keepdims=True)
    four = sums.where((F.col("cell") >= SIDE**3) & (F.col("n") > 1)).orderBy(F.desc("n"), "cell").limit(MOST_CELLS).toArrow().sort_by("cell")
    cells, fours = four["cell"].to_numpy() - SIDE**3, four["n"].to_numpy()
    if not len(cells):
        cells, fours = np.array([-1]), np.array([0])
    totals = np.bincount(np.maximum(cells, 0) // SIDE, weights=fours, minlength=SIDE**3).reshape(SIDE, SIDE, SIDE)
    others = max(1, 255 - LETTERS)
    extra = np.where((symbol == LETTERS), -np.log10(others), 0.0)
    last = by_last + 0.1
    last[0x20] = 0
    share = last / np.bincount(tail_of, weights=last, minlength=TAILS)[tail_of]
    return Letters(symbol, totals.astype(np.float32), np.log10(three).astype(np.float32), cells, fours, extra, np.log10(np.maximum(share, 1e-300)))


def learn(training: DataFrame) -> tuple[Model | None, DataFrame]:
    """The model of the column ``text`` of ``training`` (with ``doc_id``), and the table of word counts. No document, no model."""
    counts = _written(word_counts(training))
    tokens, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    if not tokens:
        return None, counts
    # the commonest words: as many whole steps of the count, an eighth of a doubling each, as stay within HEAD
    step = F.floor(F.log2("c") * 8).cast("int")
    sizes = sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["step"])
    within = [r["step"] for r, total in zip(sizes, np.cumsum([r["n"] for r in sizes]), strict=True) if total <= HEAD]
    top = counts.where(step >= min(within, default=1 << 30)).toArrow()
    pairs = sorted(zip(top["word"].to_pylist(), top["c"].to_pylist(), strict=True), key=lambda wc: (wc[0] != END, -wc[1], wc[0]))
    if not pairs or pairs[0][0] != END:
        pairs.insert(0, (END, counts.where(F.col("word") == F.lit(END)).first()["c"]))
    modelled = min(WORDS, len(pairs))
    head = {w: i for i, (w, _) in enumerate(pairs)}
    head_counts = np.array([c for _, c in pairs], dtype=np.int64)

    last = F.conv(F.hex(F.substring("word", -1, 1)), 16, 10).cast("int")
    sums = counts.groupBy(last.alias("last")).agg(F.sum("c").alias("c"), F.sum((F.col("c") == 1).cast("long")).alias("once")).collect()
    by_last, once = np.zeros(256), np.zeros(256)
    for r in sums:
        by_last[r["last"]], once[r["last"]] = r["c"], r["once"]
    for w, c in pairs[:modelled]:
        by_last[w[-1]] -= c
        once[w[-1]] -= c == 1
    tail_of = np.zeros(256, dtype=np.int64)
    tail_of[np.argsort(-by_last, kind="stable")[: TAILS - 1]] = np.arange(1, TAILS)
    tail_tokens = np.bincount(tail_of, weights=by_last, minlength=TAILS)
    new_share = (np.bincount(tail_of, weights=once, minlength=TAILS) + 0.5) / (tail_tokens + 1)
    shape = gru.Shape(modelled, TAILS, 32, HIDDEN)
    weights = gru.start(shape, np.concatenate([head_counts[:modelled], tail_tokens]), seed=7)
    model = Model(int(tokens), int(types), head, head_counts, tail_of, tail_tokens, np.clip(new_share, 1e-6, 1 - 1e-6), _letters(counts, by_last, tail_of), shape, weights)
    inputs = {w: i for w, i in head.items() if i < modelled}
    state = {"w": model.weights, "s": {n: np.zeros_like(w) for n, w in model.weights.items()}}
    dealt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))
    for turn in range(ROUNDS):
        state = _trained(training.where(dealt == turn), state, shape, tail_of, inputs, -(-int(tokens) // (ROUNDS * REPLICA)))
    model.weights = state["w"]
    return model, counts


def _trained(training: DataFrame, state: dict[str, dict], shape: gru.Shape, tail_of: np.ndarray, inputs: dict[bytes, int], replicas: int) -> dict[str, dict]:
    """Weights ``w`` and running squares ``s`` after a pass over ``training`` by ``replicas`` tasks at most, averaged by the symbols they saw. The driver
    gets one set of both."""
    weights = state["w"]
    names = list(weights)
    flat = np.concatenate([state[k][n].ravel() for k in ("w", "s") for n in names])
    piece, inputs = 4096, sorted(inputs, key=inputs.__getitem__)

    def replica(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half, seen, known = len(flat) // 2, 0, pa.array(inputs, pa.binary())
        own, squares = _shaped(flat[:half], shape), _shaped(flat[half:], shape)
        for turn, batch in enumerate(text_slices(batches, "text", TAKEN)):
            docs = []
            for part in text_slices([batch], "text"):
                found, sizes = words(part.column("text"))
                docs += _documents(_symbols(shape.words, tail_of, _places(found, known), _last_bytes(found)), sizes, inputs.index(END))
            del found
            pa.default_memory_pool().release_unused()
            seen += gru.train(own, shape, docs, squares, seed=turn)
        if seen:
            out = np.concatenate([part[n].ravel() for part in (own, squares) for n in names])
            blocks = [out[i : i + piece].astype(np.float64) for i in range(0, len(out), piece)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([float(seen)] * len(blocks)), pa.array(blocks, pa.list_(pa.float64()))], ["block", "seen", "w"])

    def averaged(table: pa.Table) -> pa.Table:
        seen = table["seen"].to_numpy()
        each = np.stack(table["w"].to_pylist())
        mean = (each * seen[:, None]).sum(axis=0) / seen.sum()
        return pa.table({"block": table["block"][:1], "w": pa.array([mean], pa.list_(pa.float64()))})

    # coalesced, not shuffled: a replica takes whole partitions
    parts = training.select(F.coalesce("text", F.lit("")).alias("text")).coalesce(max(1, replicas)).mapInArrow(replica, "block int, seen double, w array<double>")
    # first among a few tasks each, then all: no task meets the replicas of all tasks at once
    near = parts.withColumn("some", F.pmod(F.spark_partition_id(), F.lit(64)))

    def partly(table: pa.Table) -> pa.Table:
        out = averaged(table)
        return out.append_column("seen", pa.array([float(table["seen"].to_numpy().sum())]))

    some = near.groupBy("block", "some").applyInArrow(partly, "block int, w array<double>, seen double")
    rows = some.groupBy("block").applyInArrow(averaged, "block int, w array<double>").collect()
    if not rows:
        return state
    mean = np.concatenate([r["w"] for r in sorted(rows, key=lambda r: r["block"])]).astype(np.float32)
    return {"w": _shaped(mean[: len(mean) // 2], shape), "s": _shaped(mean[len(mean) // 2 :], shape)}


def _shaped(flat: np.ndarray, shape: gru.Shape) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, size in shape.sizes().items():
        n = int(np.prod(size))
        out[name], at = flat[at : at + n].reshape(size).astype(np.float32).copy(), at + n
    return out


_PARTS = "row long, word binary, n long, known long, base double, score double, spelled double, tail int, doc_id long, held_out boolean"


def score(docs: DataFrame, doc_id: str, text: str, *, folds: int = 7, held_out: int = 2) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, log10 probabilities of the whole text and its end.

    A null text is the empty text, whose only token is the end. Very long texts are scored whole, in memory in proportion to one text. Repeated rows
    give a row each; the integer id may be null. Without training
    documents the base of every token is log10(1) and the score equals it. Other columns are left out.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("held_out", id_remainder(F.col("doc_id"), folds) == held_out)
    model, counts = learn(rows.where(~F.col("held_out")).select("doc_id", "text"))
    if model is None:
        n = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long") + 1
        zero = F.lit(0.0)
        return rows.select("doc_id", "held_out", n.alias("n_tokens"), F.lit(0).cast("long").alias("n_known"), F.lit(0).cast("long").alias("train_tokens"), zero.alias("base_score"), zero.alias("score"))
    # what a word of the common ones adds to a score is the same everywhere
    modelled = model.shape.words
    inner = np.zeros(len(model.head))
    if len(model.head) > modelled:
        rest = list(model.head)[modelled:]
        inner[modelled:] = model.within(model.counts[modelled:], model.tail_of[np.array([w[-1] for w in rest])], model.letters.spell(rest))
    shared = spark.sparkContext.broadcast((model, inner, model.base(model.counts)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, inner, base = shared.value
        head, end = pa.array(list(m.head), pa.binary()), m.head[END]
        for batch in text_slices(batches, "text", TAKEN):
            for start in range(0, batch.num_rows, 10_000):
                part = batch.slice(start, 10_000)
                n = part.num_rows
                found, sizes = words(part.column("text"))
                at, last, document = _places(found, head), _last_bytes(found), np.repeat(np.arange(n, dtype=np.int32), sizes)
                inside = at >= 0
                outside = np.flatnonzero(~inside)
                sums, within = (np.bincount(document, weights=np.append(each, 0.0)[at], minlength=n) + each[end] for each in (base, inner))
                knowns = np.bincount(document[inside], minlength=n) + 1
                documents = _documents(_symbols(modelled, m.tail_of, at, last), sizes, end)
                # the words beyond the common ones, once per document
                told = found.take(pa.array(outside)).dictionary_encode()
                different = told.dictionary
                pairs, times = np.unique(document[outside].astype(np.int64) * len(different) + told.indices.to_numpy(), return_counts=True)
                del found, at, last, document, inside, outside, told
                pa.default_memory_pool().release_unused()
                chain = gru.log_likelihood(m.weights, m.shape, documents) / np.log(10) + within
                own = part.column("row").to_numpy()
                none = pa.nulls
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), pa.array([b" %d" % r for r in own.tolist()], pa.binary()), pa.array(sizes + 1, pa.int64()), pa.array(knowns, pa.int64()),
                        pa.array(sums), pa.array(chain), none(n, pa.float64()), none(n, pa.int32()), part.column("doc_id"), part.column("held_out"),
                    ],
                    _NAMES,
                )
                if len(pairs):
                    k = len(pairs)
                    document, rare = pairs // len(different), pairs % len(different)
                    # a word is spelled once, however many documents have it
                    spelled = m.letters.spell(different.to_numpy(zero_copy_only=False).tolist())[rare]
                    tails = m.tail_of[_last_bytes(different)][rare].astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own[document]), different.take(pa.array(rare)), pa.array(times, pa.int64()), none(k, pa.int64()), none(k, pa.float64()), none(k, pa.float64()),
                            pa.array(spelled), pa.array(tails), none(k, pa.int64()), none(k, pa.bool_()),
                        ],
                        _NAMES,
                    )

    parts = rows.select(F.monotonically_increasing_id().alias("row"), "text", "doc_id", "held_out").mapInArrow(scored, _PARTS)
    met = parts.join(counts, "word", "left")
    rare = F.col("tail").isNotNull()
    c = F.coalesce(F.col("c"), F.lit(0))
    tail = F.col("tail") + 1
    tokens, new = F.element_at(_doubles(np.maximum(1, model.tail_tokens)), tail), F.element_at(_doubles(model.new_share), tail)
    spelled = F.pow(F.lit(10.0), F.greatest("spelled", F.lit(-300.0)))
    each = F.log10((1 - new) * c / tokens + new * spelled)
    base = F.log10((c + 1) / F.lit(float(model.tokens + model.types + 1)))
    out = met.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max(F.when(~rare, F.col("n"))).alias("n_tokens"),
        F.sum(F.when(rare, F.when(c > 0, F.col("n")).otherwise(0)).otherwise(F.col("known"))).alias("n_known"),
        F.sum(F.when(rare, F.col("n") * base).otherwise(F.col("base"))).alias("base_score"),
        F.sum(F.when(rare, F.col("n") * each).otherwise(F.col("score"))).alias("score"),
    )
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


_NAMES = [part.split()[0] for part in _PARTS.split(", ")]


def _doubles(values: np.ndarray):
    return F.array(*[F.lit(float(v)) for v in values])
