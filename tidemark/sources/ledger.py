"""Offset ledger: per (group, topic, partition) the first offset not yet applied."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("groupid", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("untilOffset", T.LongType()),
    ]
)


def group_offsets(ledger: DataFrame, group: str) -> DataFrame:
    return ledger.filter(F.col("groupid") == group).select("topic", "partition", "untilOffset")


def stored_offsets(ledger: DataFrame, group: str) -> dict[str, dict[int, int]]:
    """The group's offsets on the driver, for ``starting_offsets``; one entry per topic partition."""
    stored: dict[str, dict[int, int]] = {}
    for row in group_offsets(ledger, group).toLocalIterator():
        stored.setdefault(row["topic"], {})[row["partition"]] = row["untilOffset"]
    return stored


def resume_plan(partitions: DataFrame, ledger: DataFrame, group: str) -> DataFrame:
    """(topic, partition, start) for every partition of the log; -2 stands for the earliest record."""
    plan = partitions.join(group_offsets(ledger, group), ["topic", "partition"], "left")
    return plan.select("topic", "partition", F.coalesce("untilOffset", F.lit(-2)).cast("bigint").alias("start"))


def resume(log: DataFrame, ledger: DataFrame, group: str) -> DataFrame:
    """Records at or after the stored offset of their partition; unknown partitions are read whole.

    A log has few (topic, partition) values. The ledger has one narrow row for each, so the planner broadcasts it by
    its size, and otherwise splits the skewed partitions of the join.
    """
    offsets = group_offsets(ledger, group)
    joined = log.join(offsets, ["topic", "partition"], "left")
    pending = F.col("untilOffset").isNull() | (F.col("offset") >= F.col("untilOffset"))
    return joined.filter(pending).select(*log.columns)


def advance_ledger(ledger: DataFrame, batch: DataFrame, group: str) -> DataFrame:
    """Ledger after ``batch``, counting all of its records, applied or not. An empty batch changes nothing."""
    reached = batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("reached"))
    reached = reached.withColumn("groupid", F.lit(group))
    merged = ledger.join(reached, ["groupid", "topic", "partition"], "full_outer")
    return merged.select(
        "groupid", "topic", "partition", F.coalesce("reached", "untilOffset").alias("untilOffset")
    )
