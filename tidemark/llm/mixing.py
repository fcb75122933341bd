"""Mixes sources to target weights by exact block quotas.

Each source is cut into blocks by a hash of its documents, which is a random permutation of them. A source's target
becomes an exact number of block draws: whole passes over all its blocks, then blocks in permuted order, the last one cut
between documents. A splitting tree hands the draws to the output shards: at every node the draws of one half are a
multivariate hypergeometric sample of the node's draws, so each shard gets a fair mix and the quotas still add up
exactly. A shard's draws of a source are a run of the permuted blocks of its own; inside a shard, rows are ordered by a hash.

The driver sees one row per source. Blocks are a table of at most ``sources * blocks`` rows, whatever the input's size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shared import broadcast_if_small, checkpointed

BLOCKS = 1024


def targets(sizes: Sequence[float], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Shares ``share * sum(sizes)`` by weight; no target exceeds ``most`` times its size, and what is over goes to the
    others by weight until none is above."""
    left, open_, out = share * sum(sizes), [i for i, n in enumerate(sizes) if n > 0], [0.0] * len(sizes)
    while open_:
        each = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if each * weights[i] >= most * sizes[i]]
        for i in full or open_:
            out[i] = float(most * sizes[i]) if full else each * weights[i]
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if full and i not in set(full)]
    return out


def split_tree(draws: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Draws per shard (rows) and source (columns), exact in both sums. A node covers a run of shards; its left half
    takes its part of the node's draws as a multivariate hypergeometric sample, seeded by the node."""
    out = np.zeros((shards, len(draws)), dtype=np.int64)

    def node(first: int, count: int, here: np.ndarray) -> None:
        if count == 1:
            out[first] = here
            return
        half = count // 2
        take = int(here.sum()) * half // count
        rng = np.random.default_rng([seed, first, count])
        left = rng.multivariate_hypergeometric(here, take, method="marginals") if here.sum() < 10**9 else _large(here, take)
        node(first, half, left)
        node(first + half, count - half, here - left)

    node(0, shards, np.asarray(draws, dtype=np.int64))
    return out


def _large(here: np.ndarray, take: int) -> np.ndarray:
    """Beyond the sampler's range the proportional part is closer than any sample's spread."""
    left = here * take // max(1, int(here.sum()))
    for i in np.argsort(-(here - left))[: take - int(left.sum())]:
        left[i] += 1
    return left


def mix(
    rows: DataFrame, key: Column, source: Column, size: Column, *, weights: Sequence[float], share: float, most: float, shards: int, seed: int, blocks: int = BLOCKS
) -> DataFrame:
    """Per input row: ``row`` (the row as a struct), ``size``, ``source_size``, ``target`` (its source's), ``copies`` (times
    the mix takes it), ``taken`` (size times copies), ``shards`` (the shard of each copy) and ``spot`` (order inside a shard).

    Sources are numbered by code point, null last, and take ``weights`` in turn. ``most`` is a whole number. A row of size 0
    follows its block. A null key is a key. Rows with equal key and source share their place, so they are taken alike. An empty
    table gives an empty result. Extra columns of any name stay inside ``row``.
    """
    spread = F.xxhash64(F.lit(seed), key.cast("string"), source.cast("string"))
    block = F.pmod(F.shiftright(spread, 20), F.lit(blocks)).cast("int")
    placed = rows.select(
        F.struct("*").alias("row"), source.cast("string").alias("source"), block.alias("block"), spread.alias("spot"), size.cast("long").alias("size")
    )
    table = checkpointed(placed.groupBy("source", "block").agg(F.sum("size").alias("words")))
    known = table.groupBy("source").agg(F.sum("words").alias("words"), F.count("*").alias("blocks")).collect()
    known = sorted(known, key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8", "surrogatepass")))
    goals = targets([r["words"] for r in known], [weights[i % len(weights)] for i in range(len(known))], share, most)
    passes = [int(goal // r["words"]) if r["words"] else 0 for r, goal in zip(known, goals, strict=True)]
    facts = [
        (r["source"], int(r["words"]), goal, n, float(goal - n * r["words"]), int(r["blocks"]))
        for r, goal, n in zip(known, goals, passes, strict=True)
    ]
    sources = rows.sparkSession.createDataFrame(facts, "s string, source_size long, target double, passes int, rest double, blocks int")
    sources = broadcast_if_small(sources, len(facts))

    # blocks in permuted order: those that start before the rest of the target are drawn in the last pass, too
    order = Window.partitionBy("source").orderBy("block")
    ranked = checkpointed(
        table.join(sources, F.col("source").eqNullSafe(F.col("s"))).select(
            "source", "block", "words", "source_size", "target", "passes", "rest", "blocks",
            (F.row_number().over(order) - 1).alias("rank"), (F.sum("words").over(order) - F.col("words")).alias("before"),
        )
    )
    started = F.sum((F.col("before") < F.col("rest")).cast("long"))
    last = {r["source"]: r["n"] for r in ranked.groupBy("source").agg(started.alias("n")).collect()}
    draws = np.array([n * f[5] + last[f[0]] for f, n in zip(facts, passes, strict=True)], dtype=np.int64)
    ends = np.cumsum(split_tree(draws, shards, seed), axis=0)
    bounds = {f[0]: ends[:, i] for i, f in enumerate(facts)}

    def draw(group: pd.DataFrame) -> pd.DataFrame:
        """The shard of each draw of one source's blocks; a draw's number is pass * blocks + rank."""
        name = group["source"].iloc[0]
        end, n = bounds[None if pd.isna(name) else name], int(group["passes"].iloc[0])
        numbers = np.arange(n + 1)[None, :] * group["blocks"].to_numpy()[:, None] + group["rank"].to_numpy()[:, None]
        group["shards"] = list(np.minimum(np.searchsorted(end, numbers, side="right"), shards - 1).astype(np.int32))
        return group[["source", "block", "words", "source_size", "target", "passes", "rest", "before", "shards"]]

    plan = checkpointed(
        ranked.groupBy("source").applyInPandas(
            draw, "source string, block int, words long, source_size long, target double, passes int, rest double, before long, shards array<int>"
        )
    )
    count = plan.count()

    # the block where a target ends is cut between rows: the last row of which more than half fits
    cut = plan.where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
    cut = cut.select(F.col("source").alias("s"), F.col("block").alias("b"), "before", "rest")
    inside = placed.drop("row").join(broadcast_if_small(cut, len(facts)), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    run = Window.partitionBy("source").orderBy("spot")
    fits = F.col("before") + F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2 <= F.col("rest")
    until = inside.select("s", "spot", fits.alias("fits")).where("fits").groupBy("s").agg(F.max("spot").alias("until"))
    plan = plan.withColumnsRenamed({"source": "s", "block": "b"})
    until = broadcast_if_small(until.withColumnRenamed("s", "u"), len(facts))
    plan = checkpointed(plan.join(until, F.col("s").eqNullSafe(F.col("u")), "left").drop("u"))

    drawn = F.when(F.col("before") >= F.col("rest"), False).when(F.col("before") + F.col("words") <= F.col("rest"), True)
    drawn = drawn.otherwise(F.coalesce(F.col("spot") <= F.col("until"), F.lit(False)))
    copies = F.col("passes") + drawn.cast("int")
    on = F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))
    return placed.join(broadcast_if_small(plan, count), on).select(
        "row", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"),
        F.slice("shards", F.lit(1), copies).alias("shards"), "spot",
    )


def drawn_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of the input, in the order of shard and spot."""
    copies = mixed.select("row", "spot", F.explode("shards").alias("shard"))
    return copies.repartition("shard", F.pmod("spot", F.lit(64))).sortWithinPartitions("shard", "spot").select("row.*")
