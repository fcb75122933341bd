"""End offsets as the source itself gives them, for partitions that were silent and logs with gaps.

A batch can only tell the greatest offset that it saw. The query's progress has, per source, the offsets at which the batch ended for every
partition of the topic, which a listener writes to the ledger after the batch. Sources that count otherwise, such as files, are left
to the batch's own ledger rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.sources.ledger import LEDGER_SCHEMA
from tidemark.streaming.store import LEDGER, TableStore

Ends = dict[tuple[str, int], int]


def source_ends(end_offset: str | dict | None) -> Ends:
    """(topic, partition) and the first offset not read, of one source's ``endOffset``; empty for sources without topics."""
    found = json.loads(end_offset) if isinstance(end_offset, str) else end_offset
    if not isinstance(found, dict):
        return {}
    return {
        (topic, int(partition)): int(offset)
        for topic, partitions in found.items()
        if isinstance(partitions, dict)
        for partition, offset in partitions.items()
    }


def with_ends(ledger: DataFrame, ends: Ends, group: str) -> DataFrame:
    """``ledger`` with the group's offsets moved on to ``ends``, never back; partitions it lacks are added."""
    rows = [(group, topic, partition, offset) for (topic, partition), offset in ends.items()]
    reached = ledger.sparkSession.createDataFrame(rows, LEDGER_SCHEMA)
    merged = ledger.unionByName(reached).groupBy("groupid", "topic", "partition")
    return merged.agg(F.max("untilOffset").alias("untilOffset"))


class SourceEnds(StreamingQueryListener):
    """Writes the end offsets of one query's batches to the ledger of the store at ``root``. Register it with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, root: str, job: str, group: str, query_name: str):
        self.spark, self.root, self.job, self.group, self.query_name = spark, root, job, group, query_name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.query_name:
            self.record(source.endOffset for source in event.progress.sources)

    def record(self, end_offsets: Iterable[str | dict | None]) -> None:
        """One publication, if the ledger is behind one of the offsets."""
        ends: Ends = {}
        for end_offset in end_offsets:
            ends |= source_ends(end_offset)
        if not ends:
            return
        store = TableStore(self.spark, self.root)
        with store.writer:
            now = store.current()
            ledger = now.read(LEDGER)
            stored = {(r["topic"], r["partition"]): r["untilOffset"] for r in ledger.filter(F.col("groupid") == self.group).collect()}
            if all(stored.get(place, -1) >= offset for place, offset in ends.items()):
                return
            done = now.batches.get(self.job, -1)
            store.publish(now, self.job, done, {LEDGER: with_ends(ledger, ends, self.group)}, counts=now.counts.get(self.job))
