"""The four change-log jobs as micro-batch functions over a table store."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators import gate, merge
from tidemark.operators import project as p
from tidemark.scratch import stage, stage_scope
from tidemark.sources.ledger import advance_ledger, resume
from tidemark.streaming.run import start
from tidemark.streaming.store import LEDGER, STRAYS, Snapshot, TableStore

@dataclass(frozen=True)
class Outcome:
    """Changed tables, each holding all rows of the buckets it replaces or, with ``whole``, of the
    table, and the rejected events."""

    tables: dict[str, DataFrame]
    rejects: DataFrame | None = None
    whole: bool = False


@dataclass(frozen=True)
class Job:
    """``name`` identifies the job's checkpoint: a new checkpoint needs a new name. ``rule`` takes the
    current tables and the valid events of a batch."""

    name: str
    group: str
    project: Callable[[DataFrame], DataFrame]
    values: list[str]
    rule: Callable[[Snapshot, DataFrame], Outcome]


def customer_job(name: str, group: str) -> Job:
    def rule(now: Snapshot, events: DataFrame) -> Outcome:
        base = now.open("base", events)
        # children are updated by their parent's id, whatever customer they carry
        hit = stage(merge.lookup(base, events, "customer_id").select(F.col("known_id").alias("base_id")), "hit")
        children = now.near(STRAYS, hit).join(hit, "base_id", "left_semi")
        oa = now.open("oa", events.select("customer_id").unionByName(children.select("customer_id")))
        base_after, oa_after = merge.linked_upsert(base, oa, events, now.mark("base"))
        return Outcome({"base": base_after, "oa": oa_after})

    return Job(name, group, p.project_customer, p.CUSTOMER_VALUES, rule)


def skin_job(name: str, group: str) -> Job:
    def rule(now: Snapshot, events: DataFrame) -> Outcome:
        oa, rejects = merge.partial_update(now.open("base", events), now.open("oa", events), events)
        return Outcome({"oa": oa}, rejects)

    return Job(name, group, p.project_skin, p.SKIN_VALUES, rule)


def staff_job(name: str, group: str) -> Job:
    def rule(now: Snapshot, events: DataFrame) -> Outcome:
        staff = merge.upsert_staff(now.open("customer_info", events), events, now.mark("customer_info"))
        return Outcome({"customer_info": staff})

    return Job(name, group, p.project_staff, p.STAFF_VALUES, rule)


def order_job(
    name: str, group: str, *, scope: Literal["order", "customer"] = "order", zone: str = p.DEFAULT_ZONE
) -> Job:
    def rule(now: Snapshot, events: DataFrame) -> Outcome:
        # a customer's rows lie in any bucket and may move to another
        whole = scope == "customer"
        orders = now.read("order_status") if whole else now.open("order_status", events)
        after, rejects = gate.gated_upsert(orders, events, scope, now.mark("order_status"))
        return Outcome({"order_status": after}, rejects, whole)

    return Job(name, group, lambda log: p.project_order(log, zone), p.ORDER_VALUES, rule)


def apply_batch(root: str, job: Job, projected: DataFrame, batch_id: int, preview: int = 0) -> None:
    """Apply one batch of projected records to the store at ``root``. A batch that is already
    published is skipped, so a replay changes nothing; tables, ledger, notes, their counts and the batch id become current in
    one publication."""
    spark = projected.sparkSession
    store = TableStore(spark, root)
    with store.writer, stage_scope(spark):
        now = store.current()
        if now.batches.get(job.name, -1) >= batch_id:
            return
        projected = p.stage_projection(projected)
        if projected.isEmpty():
            return
        valid, quarantine = p.split(projected, job.values)
        if preview:
            p.preview(valid, preview).show(preview, truncate=False)
        outcome = job.rule(now, valid)
        counts = {"quarantined": store.write_notes("quarantine", job.name, batch_id, quarantine)}
        if outcome.rejects is not None:
            counts["rejected"] = store.write_notes(f"rejects_{job.name}", job.name, batch_id, outcome.rejects)
        tables = {**outcome.tables, LEDGER: advance_ledger(now.read(LEDGER), projected, job.group)}
        store.publish(now, job.name, batch_id, tables, whole=outcome.whole, counts=counts)


def run_job(
    records: DataFrame, root: str, job: Job, checkpoint: str, *, available_now: bool = False, preview: int = 0
) -> StreamingQuery:
    """Stream ``records`` through ``job`` into the store. The projection is part of the stream, so its
    plan is built once; only the write rule is planned per batch."""
    return start(
        job.project(records),
        lambda batch, batch_id: apply_batch(root, job, batch, batch_id, preview),
        checkpoint,
        available_now=available_now,
    )


def resume_job(
    records: DataFrame, root: str, job: Job, checkpoint: str, *, available_now: bool = False, preview: int = 0
) -> StreamingQuery:
    """``run_job`` from the offsets in the store's ledger on, for a new or lost checkpoint: records below their partition's
    stored offset are left out, partitions that the ledger lacks are read whole. Batches count from 0 with a new
    checkpoint, so they go by the checkpoint's name. For a topic, pass ``starting_offsets`` of
    ``stored_offsets`` to the scan as well, so that it does not read what is left out here."""
    spark = records.sparkSession
    ledger = TableStore(spark, root).read(LEDGER).filter(F.col("groupid") == job.group)
    # one row per topic partition of the group, kept by value: its slot may be overwritten while the query runs
    known = spark.createDataFrame(ledger.collect(), ledger.schema)
    named = replace(job, name=f"{job.name}-{zlib.crc32(checkpoint.encode()):08x}")
    return run_job(resume(records, known, job.group), root, named, checkpoint, available_now=available_now, preview=preview)
