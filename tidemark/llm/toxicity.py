"""Toxicity from a weighted lexicon, matched by an Aho-Corasick automaton.

Texts are folded first: lower case, wide and look-alike letters to plain letters (accents stay, as they tell words apart), digits and signs that stand for
letters to those letters, all else to a blank. The lexicon has words and beginnings of words whose documents are far more
often toxic than not, weighted by the log odds, from labelled documents outside the held-out fold. A match inside an exception phrase (a
match with the word before or after it that occurs in clean documents only) does not count. The sum of weights, alone and by
length, gives the score through a logistic curve.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import labelled_sample, logistic, sigmoid

#: Labelled documents that the lexicon and the curve are fitted on.
SAMPLE = 20_000
#: Lengths of word beginnings that may become entries.
BEGINNINGS = (4, 5, 6, 7)
#: An entry needs so many toxic documents, this share of them, this log odds, and there are at most so many entries.
LEAST_TOXIC, LEAST_SHARE, LEAST_ODDS, MOST_ENTRIES = 4, 0.015, 3.0, 20_000
#: Clean documents that must share a phrase before it is an exception.
LEAST_CLEAN = 2

# Letters of other scripts that look like Latin ones, and digits and signs written for letters.
_LOOK_ALIKES = dict(zip("авеіјкмнорсѕтухёαβεηικνορτυχωіı", "abeijkmhopcstyxeabehikvoptuxwii", strict=True))
_SUBSTITUTES = dict(zip("013457@$", "oieasTas".lower(), strict=True))


class _Fold(dict):
    """Code point to folded text, filled as code points occur."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        plain = unicodedata.normalize("NFKC", c.lower())
        plain = "".join(_LOOK_ALIKES.get(p, _SUBSTITUTES.get(p, p)) for p in plain if not unicodedata.combining(p))
        folded = self[code] = plain if plain.isalpha() else "" if not plain or unicodedata.category(c) in ("Cf", "Mn") else " "
        return folded


_FOLD = _Fold()


def fold(text: str) -> str:
    """The folded text between blanks. Words are separated by blanks, one or more."""
    text = text if text.isascii() else unicodedata.normalize("NFC", text)
    return f" {text.translate(_FOLD)} "


def candidates(folded: str) -> set[str]:
    """What of a text may become an entry: ``" word "`` and ``" beginning"`` of words of four letters or more."""
    out = set()
    for word in set(folded.split()):
        if len(word) >= BEGINNINGS[0] and len(word) <= 40:
            out.add(f" {word} ")
            out.update([f" {word[:n]}" for n in BEGINNINGS if n < len(word)])
    return out


@dataclass
class Lexicon:
    entries: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    curve: list[float] | None = None
    rate: float = 0.0

    @cached_property
    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for entry, weight in self.entries.items():
            machine.add_word(entry, (len(entry), weight))
        machine.make_automaton()
        return machine

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}

    def matches(self, folded: str) -> dict[int, float]:
        """The greatest weight that starts at each place where a word starts."""
        found: dict[int, float] = {}
        if self.entries:
            for end, (size, weight) in self.automaton.iter(folded):
                start = end - size + 1
                if weight > found.get(start, 0.0):
                    found[start] = weight
        return found

    def phrases(self, folded: str, start: int) -> tuple[str, str]:
        """The match with the word before it, and with the word after it."""
        before = folded[max(0, start - 60) : start].split()
        own, *after = folded[start : start + 120].split()[:2] or [""]
        return f"{before[-1] if before else ''} {own}", f"{own} {after[0] if after else ''}"

    def measures(self, text: str) -> tuple[float, float]:
        """The log of one plus the weights' sum, and of one plus the sum per thousand characters."""
        folded = fold(text)
        total = 0.0
        for start, weight in self.matches(folded).items():
            if not self.exceptions or self.exceptions.isdisjoint(self.phrases(folded, start)):
                total += weight
        return float(np.log1p(total)), float(np.log1p(1000 * total / len(folded)))

    def score(self, texts: Iterable[str]) -> np.ndarray:
        x = np.array([self.measures(t) for t in texts]).reshape(-1, 2)
        if self.curve is None:
            return np.full(len(x), self.rate)
        return sigmoid(x @ np.array(self.curve[:-1]) + self.curve[-1])


def _counted(sample: DataFrame, of: callable) -> DataFrame:
    """``entry``, ``toxic`` and ``clean``: documents of each kind in which ``of(text)`` has the entry."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (Counter(), Counter())

        def flushed() -> pa.RecordBatch:
            names = list({**kinds[0], **kinds[1]})
            columns = [pa.array(names, pa.string()), *[pa.array([k[n] for n in names], pa.int64()) for k in (kinds[1], kinds[0])]]
            for k in kinds:
                k.clear()
            return pa.RecordBatch.from_arrays(columns, ["entry", "toxic", "clean"])

        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                kinds[int(label > 0)].update(of(text))
                if len(kinds[0]) + len(kinds[1]) > 500_000:
                    yield flushed()
        yield flushed()

    parts = sample.mapInArrow(counts, "entry string, toxic long, clean long")
    return parts.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def train(docs: DataFrame, labels: DataFrame, *, folds: int = 4, held_out: int = 2, most: int = SAMPLE) -> Lexicon:
    """Lexicon, exceptions and curve from ``labels.toxic``, without the held-out fold. Without labels of both kinds every text gets their
    rate (0 without any, as with empty tables).

    Null ids and labels do not teach; of several labels of one id the smallest counts, equal texts teach once, with the label that most of them have. A
    null text is the empty one; very long texts teach whole. Entries of equal weight are taken in their order. Other columns are not read.
    """
    sample = labelled_sample(docs, labels, "toxic", folds=folds, held_out=held_out, most=most)
    known = {int(r["label"] > 0): r["n"] for r in sample.groupBy((F.col("label") > 0).alias("label")).agg(F.count("*").alias("n")).collect()}
    toxic, clean = known.get(1, 0), known.get(0, 0)
    if not toxic or not clean:
        return Lexicon({}, rate=toxic / max(1, toxic + clean))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    found = _counted(sample, lambda text: candidates(fold(text))).where(F.col("toxic") >= max(LEAST_TOXIC, LEAST_SHARE * toxic))
    found = found.withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS).orderBy(F.desc(F.col("odds") * F.col("toxic")), "entry").limit(MOST_ENTRIES)
    entries = {r["entry"]: r["odds"] for r in found.collect()}
    # a longer beginning or a word says nothing that a shorter entry of at least its odds has not said
    shorter = lambda e: (e.strip()[:n] for n in BEGINNINGS if n < len(e.strip()))
    entries = {e: w for e, w in entries.items() if not any(entries.get(f" {s}", -1.0) >= w for s in shorter(e))}
    lexicon = Lexicon(entries)

    def context(text: str) -> set[str]:
        folded = fold(text)
        return {p for start in lexicon.matches(folded) for p in lexicon.phrases(folded, start)}

    alone = _counted(sample, context).where((F.col("toxic") == 0) & (F.col("clean") >= LEAST_CLEAN) & F.col("entry").rlike(r"^\S+ \S+$"))
    lexicon.exceptions = {r["entry"] for r in alone.orderBy(F.desc("clean"), "entry").limit(MOST_ENTRIES).collect()}

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [lexicon.measures(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in x]), pa.array([b for _, b in x]), batch.column("label")], ["a", "b", "label"])

    rows = np.array(sorted(tuple(r) for r in sample.mapInArrow(measured, "a double, b double, label int").collect()))
    lexicon.curve = logistic(rows[:, :2], (rows[:, 2] > 0).astype(float)).tolist()
    return lexicon


def score_column(lexicon: Lexicon, text: Column) -> Column:
    """The toxicity of a text column from 0 to 1: a null text is the empty text, very long texts are scored whole, equal texts score alike."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(lexicon.score(texts.fillna("")))

    return scored(text)
