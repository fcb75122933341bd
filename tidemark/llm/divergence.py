"""Divergence of the sources of a language, over the terms that it keeps, by run-length columns.

Each (language, source) group is a column of term counts. The vocabulary is cut into blocks of terms of like frequency; a task takes
one block with the columns of up to two tiles of groups, reorders its terms so that equal counts lie together, and run-length encodes
each column. A share depends on a term's count only, so for a pair of columns the boundaries of both runs are merged, and the
divergence of one term per merged run is multiplied by the run's length. What a source never has is one long run.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shared import number_rows, text_slices, written

#: Terms of a block and groups of a tile.
BLOCK, TILE = 8192, 64
#: Counts that a task holds before it passes them on.
HELD = 400_000
#: Shares are whole numbers of billionths.
UNIT = 1_000_000_000

#: ASCII letters, A-Z in lower case, and all bytes beyond ASCII stay; anything else ends a term.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The runs of letters of a text in UTF-8, A-Z in lower case; every character beyond ASCII is a letter."""
    return text.translate(_TERM_BYTES).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each group's terms, and documents with them, as far as one task sees them."""
    total: dict[tuple[str, str], Counter[bytes]] = {}
    within: dict[tuple[str, str], Counter[bytes]] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in total.items():
            n = len(found)
            word = pa.array(list(found), pa.binary()).view(pa.string())
            times, documents = list(found.values()), [within[lang, source][w] for w in found]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), word, pa.array(times, pa.int64()), pa.array(documents, pa.int64())], ["lang", "source", "term", "c", "df"])
        total.clear()
        within.clear()

    held = 0
    for batch in text_slices(batches, "text"):
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            words = terms(text)
            distinct = set(words)
            found = total.setdefault((lang, source), Counter())
            held -= len(found)
            found.update(words)
            held += len(found)
            within.setdefault((lang, source), Counter()).update(distinct)
            if held > HELD:
                yield from flushed()
                held = 0
    yield from flushed()


def term_counts(docs: DataFrame) -> DataFrame:
    """Per ``lang``, ``source`` and ``term``: ``c``, its occurrences, and ``df``, the documents with it. ``docs`` has no nulls."""
    rows = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    parts = rows.mapInArrow(_counted, "lang string, source string, term string, c long, df long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("df").alias("df"))


def share(c: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 (c + 2) / (n + 2 v)), in decimals, so that no product overflows."""
    return F.lit(1).cast("long") + F.call_function("div", (c + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), (n + 2 * v).cast("decimal(20,0)"))


def _shares(c: np.ndarray, n: int, v: int) -> np.ndarray:
    """``share`` of many counts. Three digits of the quotient at a time; beyond 64 bits in Python's numbers."""
    below = n + 2 * v
    if below >= 1 << 53:
        return np.array([1 + UNIT * (int(x) + 2) // below for x in c], dtype=np.int64)
    out, rest = np.divmod(c + 2, below)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + more
    return out + 1


def runs(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values starts, and its value."""
    starts = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]])[: len(column)])
    return starts, column[starts]


def by_runs(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], size: int) -> int:
    """The divergence of two run-length columns of shares over ``size`` terms."""
    edges = np.union1d(one[0], two[0])
    p = one[1][np.searchsorted(one[0], edges, side="right") - 1]
    q = two[1][np.searchsorted(two[0], edges, side="right") - 1]
    return int(((p - q) * (p - q) // (p + q) * np.diff(edges, append=size)).sum())


def clustered(counts: np.ndarray) -> np.ndarray:
    """An order of the columns of ``counts`` (a row per group) that puts equal counts together: by all groups, first
    by those with few different counts, whose runs become long."""
    different = [len(np.unique(row)) for row in counts]
    return np.lexsort([counts[i] for i in sorted(range(len(counts)), key=lambda i: -different[i])])


def _pairs_of_block(table: pa.Table) -> pa.Table:
    """Of one block: ``source``, ``item`` and ``value`` for each pair of its groups, of one tile or between two."""
    lang, one, two = (table[c][0].as_py() for c in ("lang", "one", "two"))
    low, size = table["low"][0].as_py(), table["size"][0].as_py()
    table = table.sort_by([("tile", "ascending"), ("source", "ascending")])
    sources, tiles = table["source"].to_pylist(), table["tile"].to_numpy()
    columns: list[tuple[np.ndarray, np.ndarray]] = []
    if size:
        counts = np.zeros((len(sources), size), dtype=np.int64)
        for i, cells in enumerate(table["cells"].chunks[0] if table["cells"].num_chunks == 1 else table["cells"]):
            if cells.is_valid:
                cell = cells.values
                counts[i, cell.field("pos").to_numpy() - low] = cell.field("c").to_numpy()
        counts = counts[:, clustered(counts)]
        for row, n, v in zip(counts, table["n"].to_pylist(), table["v"].to_pylist(), strict=True):
            starts, values = runs(row)
            columns.append((starts, _shares(values, n, v)))
    a, b, value = [], [], []
    for i in range(len(sources)):
        for j in range(i + 1, len(sources)):
            if one == two or tiles[i] != tiles[j]:
                a.append(sources[i])
                b.append(sources[j])
                value.append(by_runs(columns[i], columns[j], size) if size else 0)
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": pa.array(a, pa.string()), "item": pa.array(b, pa.string()), "value": pa.array(value, pa.int64())})


def _pair_values(kept: DataFrame, vocabulary: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` and ``value`` for every ordered pair of groups of a language."""
    placed, _ = number_rows(groups, F.col("lang"), F.col("source"))
    members = placed.select("lang", "source", "n", "v", (F.shiftleft(F.col("_part").cast("long"), 33) + F.floor(F.col("_place") / TILE)).alias("tile"))
    tiles = members.select("lang", "tile").distinct()
    met = tiles.withColumnRenamed("tile", "one").join(tiles.withColumnRenamed("tile", "two"), "lang").where("one <= two")
    seats = met.select("lang", "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("tile"))
    # a language without terms has one block of none, as all others have beside their own
    empty = tiles.select("lang", F.lit(-1).cast("long").alias("block"), F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("size"))
    blocks = vocabulary.groupBy("lang", "block").agg(F.min("pos").alias("low"), F.count("*").alias("size")).unionByName(empty.distinct())
    segments = kept.groupBy("lang", "source", "block").agg(F.collect_list(F.struct("pos", "c")).alias("cells"))  # BLOCK cells at most
    columns = members.join(blocks, "lang").join(segments, ["lang", "source", "block"], "left").join(seats, ["lang", "tile"])
    sums = columns.groupBy("lang", "block", "one", "two").applyInArrow(_pairs_of_block, "lang string, source string, item string, value long")
    half = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def audit(docs: DataFrame, text: str, lang: str, source: str, *, least: int = 10, top: int = 10) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``: in part ``pair`` the divergence of each group from every other
    source of its language, in part ``term`` the ``top`` terms that the group has more often than its language, by their
    divergence. A language keeps the terms of at least ``least`` of its rows; all numbers are exact.

    Null texts, languages and sources are read as ''. Empty and very long texts are like any other; a language without kept terms has pairs of
    value 0. Repeated rows count each. Ties go to the smaller item in UTF-8. An empty table gives an empty result.
    Other columns are left out, whatever their names. A source may hold any share of the rows: tasks sum up before they pass on.
    """
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for c, name in ((text, "text"), (lang, "lang"), (source, "source"))])
    counts = written(term_counts(rows), "terms")
    found = counts.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("c").alias("total")).where(F.col("df") >= least)
    placed, _ = number_rows(found.drop("df"), F.col("lang"), F.col("total"), F.col("term"))
    block = F.shiftleft(F.col("_part").cast("long"), 33) + F.floor(F.col("_place") / BLOCK)
    vocabulary = placed.select("lang", "term", "total", block.alias("block"), "_place").withColumnRenamed("_place", "pos")
    kept = written(counts.drop("df").join(vocabulary, ["lang", "term"]), "kept")
    langs = vocabulary.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("*").alias("v"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    groups = rows.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = written(groups.fillna(0, ["n", "v", "lang_n"]), "groups")

    pairs = _pair_values(kept, vocabulary, groups)
    p, q = F.col("p"), F.col("q")
    shares = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", share(F.col("c"), F.col("n"), F.col("v")).alias("p"), share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q"))
    above = shares.where(p > q).select("lang", "source", F.col("term").alias("item"), F.call_function("div", (p - q) * (p - q), p + q).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = above.withColumn("rank", rank).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("rank", rank).withColumn("part", F.lit("pair")).select(columns).unionByName(best.withColumn("part", F.lit("term")).select(columns))
