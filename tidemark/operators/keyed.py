"""Keyed and ordered building blocks of the write rules.

Events are ordered by ``ord = (offset, partition)``, which keeps offset order inside a partition and
fixes an order across partitions.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.scratch import stage

# A chunk spans 2**CHUNK_BITS offsets. It is the sort unit of one task and holds at most
# 2**CHUNK_BITS x (topic partitions) rows, however the keys are distributed.
CHUNK_BITS = 8

# A group spans 2**GROUP_BITS chunks and so many groups a block, so the top level has one row per 2**30
# offsets: about a thousand rows for a trillion records in every topic partition.
GROUP_BITS = 11


#: Identity of a staged event, unique in its table.
ROW = "row_id"


def log_order() -> Column:
    return F.struct("offset", "partition")


def numbered(events: DataFrame) -> DataFrame:
    """``events`` written once, each with a ``row_id`` of its own; events that have one already are taken as they are."""
    if ROW in events.columns:
        return events
    return stage(events.withColumn(ROW, F.monotonically_increasing_id()), "events")


def _place() -> Column:
    """``log_order`` as one number, which hash aggregation can hold: offset times 2^32, plus partition."""
    return F.col("offset").cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.col("partition").cast("decimal(10,0)")


def _order_of(place: str) -> Column:
    """The ``log_order`` that a packed place stands for."""
    return F.expr(f"named_struct('offset', {place} div 4294967296BD, 'partition', int({place} % 4294967296BD))")


def latest_per_key(events: DataFrame, key: str, first_of: tuple[str, ...] = ()) -> DataFrame:
    """Last event of every key, with ``first_ord``, the place of the key's first event. Of several events at one place any
    may be the last.

    For numeric columns in ``first_of`` the value of the first event is added as ``first_<name>``. The first of two steps
    reads key and place only: a hash aggregation, which keeps one narrow row per key and task before the shuffle, so hot keys are
    cheap. The second one fetches the winning rows by their ids; ids are unique, so no key weighs on that join.
    """
    events = numbered(events)
    values = [name for name in events.columns if name not in (key, "offset", "partition", ROW)]
    narrow = events.select(key, ROW, *first_of, _place().alias("place"))
    winners = narrow.groupBy(key).agg(
        F.max_by(ROW, "place").alias("last_row"),
        F.min("place").alias("first_place"),
        *[F.min_by(name, "place").alias(f"first_{name}") for name in first_of],
    )
    # any number of winners may be there: the planner broadcasts few, or joins by shuffles
    firsts = [f"first_{name}" for name in first_of]
    fetched = events.select(ROW, key, *values).join(winners.drop(key), F.col(ROW) == F.col("last_row"))
    return fetched.select(key, *values, _order_of("first_place").alias("first_ord"), *firsts)


def before(rows: DataFrame, value: Column, fold: Literal["max", "sum"], chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Adds ``before``: ``fold`` of ``value`` over all rows earlier in ``first_ord`` (null for none).

    Four levels replace the one-task global window: totals per chunk of offsets, a prefix over the
    chunks of a group, one over the groups of a block, one over the blocks. Chunks are offset ranges, so they are contiguous in
    the order and do not depend on how the rows happen to be partitioned. ``rows`` is read twice.
    """
    if fold == "max":
        total, combine = F.max, lambda a, b: F.greatest(a, b)
    else:
        total, combine = F.sum, lambda a, b: F.coalesce(a + b, a, b)
    earlier = (Window.unboundedPreceding, -1)

    chunk = F.shiftright(F.col("first_ord.offset"), chunk_bits)
    rows = rows.withColumn("chunk", chunk).withColumn("fold_value", value)
    chunks = rows.groupBy("chunk").agg(total("fold_value").alias("chunk_total"))
    chunks = chunks.withColumn("chunk_group", F.shiftright("chunk", GROUP_BITS))

    groups = chunks.groupBy("chunk_group").agg(total("chunk_total").alias("group_total"))
    groups = groups.withColumn("block", F.shiftright("chunk_group", GROUP_BITS))
    blocks = groups.groupBy("block").agg(total("group_total").alias("block_total"))
    in_log = Window.orderBy("block").rowsBetween(*earlier)
    blocks = blocks.select("block", total("block_total").over(in_log).alias("block_before"))

    in_block = Window.partitionBy("block").orderBy("chunk_group").rowsBetween(*earlier)
    group_before = combine(F.col("block_before"), total("group_total").over(in_block))
    groups = groups.join(blocks, "block").select("chunk_group", group_before.alias("group_before"))

    in_group = Window.partitionBy("chunk_group").orderBy("chunk").rowsBetween(*earlier)
    chunk_before = combine(F.col("group_before"), total("chunk_total").over(in_group))
    chunks = chunks.join(groups, "chunk_group").select("chunk", chunk_before.alias("chunk_before"))

    in_chunk = Window.partitionBy("chunk").orderBy("first_ord").rowsBetween(*earlier)
    row_before = combine(F.col("chunk_before"), total("fold_value").over(in_chunk))
    placed = rows.join(chunks, "chunk").withColumn("before", row_before)
    return placed.drop("chunk", "fold_value", "chunk_before")


def high_water(table: DataFrame, key: str) -> DataFrame:
    """One row: the greatest key, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(key), F.lit(0).cast("bigint")).alias("high_water"))


def running_high_water(events: DataFrame, table: DataFrame, key: str = "order_id") -> DataFrame:
    """Events with ``high_water``: the greatest of the table's keys and the keys of all earlier events."""
    start = high_water(table, key).scalar()
    placed = before(events.withColumn("first_ord", log_order()), F.col(key), "max")
    return placed.withColumn("high_water", F.greatest(start, "before")).drop("first_ord", "before")


def assign_ids(new_keys: DataFrame, start: Column) -> DataFrame:
    """Dense ``id`` after ``start`` for keys with ``first_ord``, in order of first appearance."""
    numbered = before(new_keys, F.lit(1).cast("bigint"), "sum")
    return numbered.withColumn("id", start + F.coalesce("before", F.lit(0)) + 1).drop("before")


def matching(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``changes`` that ``table`` has.

    The semi join keeps the table on the streamed side, so a small batch is broadcast against it
    and the table is not shuffled.
    """
    return table.select(key).join(changes.select(key), key, "left_semi").distinct()
