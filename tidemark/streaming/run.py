"""Starting and stopping micro-batch queries."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.sources.records import BATCH_SECONDS


@dataclass
class _Gate:
    """Held by a running batch. Once closed, no further batch begins."""

    lock: threading.Lock = field(default_factory=threading.Lock)
    closed: bool = False


_gates: dict[str, _Gate] = {}


def start(
    records: DataFrame,
    batch_fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    available_now: bool = False,
    seconds: int = BATCH_SECONDS,
) -> StreamingQuery:
    """Run ``batch_fn`` on every micro-batch: on a fixed interval, or once over what is available.

    Progress is the checkpoint's, written after ``batch_fn`` returns; an interrupted batch is run
    again with the same records and batch id.
    """
    gate = _Gate()

    def gated(batch: DataFrame, batch_id: int) -> None:
        with gate.lock:
            if gate.closed:  # an error leaves the batch uncommitted, so that the next start runs it
                raise InterruptedError("the query is being stopped")
            batch_fn(batch, batch_id)

    writer = records.writeStream.foreachBatch(gated).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{seconds} seconds"}
    query = writer.trigger(**trigger).start()
    _gates[str(query.runId)] = gate
    return query


def run_until(query: StreamingQuery, should_stop: Callable[[], bool], poll_seconds: int = 1) -> None:
    """Wait until ``should_stop``, let the running batch finish, then stop the query. The next batch
    cannot begin in between, so a query that is never idle stops as well."""
    gate = _gates[str(query.runId)]
    while not query.awaitTermination(poll_seconds):
        if should_stop():
            with gate.lock:
                gate.closed = True
            query.stop()
            break
    _gates.pop(str(query.runId), None)
