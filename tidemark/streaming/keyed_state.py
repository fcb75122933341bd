"""The plain upsert and the guarded update as keyed state: a stream of changes that looks nothing up in the tables.

State holds, per customer, that the customer is known and the place of the last event applied. It starts from the keys of a table. Customers
are kept in parts by a hash, one value of the state store for each, and a part's events are handled together: a call between the store
and Python costs milliseconds, so there is one per part and batch, not one per customer. A
batch's records give one change row per customer with a newer event, marked ``fresh`` where the customer was not known; events of
unknown customers are rejects where the rule never inserts. As places are compared, not batches, an event that arrives late in
another batch does not undo a newer one.

Records that are no events pass through the same operator in band: bad ones, and the last offset of each topic partition.
So a batch of the query's output is all that its sink needs to publish tables, notes and ledger together.

The state store has to be the RocksDB one; ``run_keyed`` sees to that for its query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators import merge
from tidemark.operators import project as p
from tidemark.operators.keyed import assign_ids
from tidemark.scratch import stage, stage_scope
from tidemark.sources.ledger import advance_ledger
from tidemark.sources.records import RECORD_COLUMNS
from tidemark.sources.tables import TABLES
from tidemark.streaming.run import start
from tidemark.streaming.store import LEDGER, Snapshot, TableStore

EVENT, REJECT, BAD, END, JOIN = "event", "reject", "bad", "end", "join"

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

KEY = "customer_id"

#: What a part's state holds of each of its customers, in order of their ids.
KNOWN = np.dtype([("id", "<i8"), ("offset", "<i8"), ("partition", "<i4")])

#: A task folds so many rows, or so many bytes of them, at a time.
FOLD_ROWS, FOLD_BYTES = 100_000, 32_000_000

PLACES = {"offset": "bigint", "partition": "int", "first_offset": "bigint", "first_partition": "int"}


@dataclass(frozen=True)
class KeyedJob:
    """``name`` identifies the job's checkpoint. ``columns`` of ``table`` are written; with ``insert`` unknown customers get a row, else their
    events are rejects. ``parts`` is the number of parts that the customers are kept in, fixed for a checkpoint: a part should have some
    thousands of customers, at 20 bytes each."""

    name: str
    group: str
    table: str
    columns: tuple[str, ...]
    insert: bool
    parts: int = 512

    def part(self, customer: Column) -> Column:
        return F.pmod(F.xxhash64(customer.cast("bigint")), F.lit(self.parts)).cast("bigint")

    def project(self, log: DataFrame) -> DataFrame:
        return p.project_staff(log) if self.insert else p.project_skin(log)


def staff_state(name: str, group: str) -> KeyedJob:
    return KeyedJob(name, group, "customer_info", tuple(p.STAFF_VALUES[1:]), insert=True)


def skin_state(name: str, group: str) -> KeyedJob:
    return KeyedJob(name, group, "oa", tuple(p.SKIN_VALUES[1:]), insert=False)


def _schema(job: KeyedJob) -> dict[str, str]:
    """Columns of the rows that go in and come out."""
    kinds = {"kind": "string", "part": "bigint", "id": "bigint", "topic": "string", **PLACES, "fresh": "boolean", "key": "string", "value": "string", "reason": "string"}
    return {**kinds, **{name: TABLES[job.table][name] for name in job.columns}}


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


def _in_band(projected: DataFrame, job: KeyedJob) -> DataFrame:
    """One row per record, with its kind, null where only its place counts. Id and part of a bad record are its partition."""
    event = F.col("reason").isNull()
    kind = F.when(~event, BAD)
    if not job.insert:
        kind = kind.when(F.col(KEY) == 0, F.lit(None))
    values = {
        "kind": kind.otherwise(EVENT),
        "part": F.when(event, job.part(F.col(KEY))).otherwise(F.col("partition").cast("bigint")),
        "id": F.when(event, F.col(KEY)).otherwise(F.col("partition").cast("bigint")),
        "key": F.when(~event, F.col("key")),
        "value": F.when(~event, F.col("value")),
    }
    rows = projected.withColumns(values)
    given = {name: type for name, type in _schema(job).items() if name in rows.columns}
    return rows.select(*[F.col(name).cast(type).alias(name) for name, type in given.items()])


def _ends_of(ids: np.ndarray, offsets: np.ndarray, partitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each id's first and last place are, both in order of the ids."""
    order = np.lexsort((partitions, offsets, ids))
    edges = np.flatnonzero(np.diff(ids[order]))
    return order[np.r_[0, edges + 1]], order[np.r_[edges, len(order) - 1]]


def _newest(events: pd.DataFrame) -> pd.DataFrame:
    """The last event of each customer, with the place of the first one."""
    ids = events["id"].to_numpy()
    last = _ends_of(ids, events["offset"].to_numpy(), events["partition"].to_numpy())[1]
    firsts = events[["first_offset", "first_partition"]]
    first = _ends_of(ids, *(firsts[name].to_numpy() for name in firsts))[0]
    return events.iloc[last].assign(**{name: firsts[name].to_numpy()[first] for name in firsts})


def _last_place(ends: pd.DataFrame) -> pd.DataFrame:
    """The last of the ends of each topic partition."""
    return ends.sort_values("offset", kind="stable").drop_duplicates(["topic", "partition"], keep="last")


def _folded(rows: pa.Table, insert: bool, schema: dict[str, str]) -> Iterator[pa.RecordBatch]:
    """The rows' bad records as they are, the last offset of each topic partition and, where no event is reported one by one, the
    last event of each customer."""
    whole = {name: type for name, type in zip(rows.schema.names, rows.schema.types, strict=True)}
    whole |= {"first_offset": whole["offset"], "first_partition": whole["partition"], "fresh": pa.bool_()}

    def shaped(some: pa.Table, values: dict[str, pa.Array | pa.ChunkedArray]) -> Iterator[pa.RecordBatch]:
        columns = {name: values[name] if name in values else some[name] if name in some.column_names else pa.nulls(some.num_rows, whole[name]) for name in schema}
        yield from pa.table(columns).cast(pa.schema([(name, whole[name]) for name in schema])).to_batches()

    def placed(some: pa.Table, offset: str = "offset") -> dict[str, pa.Array | pa.ChunkedArray]:
        return {"first_offset": some[offset], "first_partition": some["partition"], "fresh": pa.repeat(pa.scalar(False), some.num_rows)}

    bad = rows.filter(pc.equal(rows["kind"], BAD))
    if bad.num_rows:
        yield from shaped(bad, placed(bad))
    ends = rows.group_by(["topic", "partition"]).aggregate([("offset", "max"), ("offset", "min")])
    place = ends["partition"].cast(pa.int64())
    kind = pa.repeat(pa.scalar(END), ends.num_rows)
    yield from shaped(ends, {"kind": kind, "part": place, "id": place, "offset": ends["offset_max"], **placed(ends, "offset_min")})
    events = rows.filter(pc.equal(rows["kind"], EVENT))
    if not events.num_rows:
        return
    places = placed(events)
    if insert:
        first, last = _ends_of(*(events[name].to_numpy() for name in ("id", "offset", "partition")))
        places = placed(events.take(first))
        events = events.take(last)
    yield from shaped(events, places)


def _prefold(batches: Iterator[pa.RecordBatch], insert: bool, schema: dict[str, str]) -> Iterator[pa.RecordBatch]:
    """Every so many rows of a task folded, so that a hot key is small before the shuffle."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= FOLD_ROWS or size >= FOLD_BYTES:
            yield from _folded(pa.Table.from_batches(held), insert, schema)
            held, rows, size = [], 0, 0
    if rows:
        yield from _folded(pa.Table.from_batches(held), insert, schema)


def _placed(ids: np.ndarray, offsets: np.ndarray | int = -1, partitions: np.ndarray | int = -1) -> np.ndarray:
    """Rows of ``KNOWN``; without a place, none of the customer's events is applied yet."""
    rows = np.empty(len(ids), dtype=KNOWN)
    rows["id"], rows["offset"], rows["partition"] = ids, offsets, partitions
    return rows


def _with(known: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``known`` with ``rows`` in the place of what it has of their customers. Ids in ``rows`` are distinct."""
    both = np.concatenate([known[~np.isin(known["id"], rows["id"])], rows])
    return both[np.argsort(both["id"], kind="stable")]


def _added(known: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """``known`` with the customers ``ids`` that it lacks."""
    missing = np.setdiff1d(ids, known["id"])
    return _with(known, _placed(missing)) if len(missing) else known


class _LastWrite(StatefulProcessor):
    """``joins``: customers may be added by rows of a batch, which can come after their events."""

    def __init__(self, insert: bool, joins: bool, columns: list[str]):
        self.insert = insert
        self.joins = joins
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("known", "customers binary")

    def _known(self) -> np.ndarray:
        held = bytes(self.state.get()[0]) if self.state.exists() else b""
        return np.frombuffer(held, dtype=KNOWN)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        # called once for every Arrow batch of the part's rows
        self.state.update((_added(self._known(), initialState["id"].to_numpy(dtype=np.int64)).tobytes(),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kind = key[0]
        if kind == BAD:
            for frame in rows:
                yield frame[self.columns]
        elif kind == END:
            yield _last_place(pd.concat(list(rows)))[self.columns]
        else:
            yield from self._events(rows)

    def _events(self, rows) -> Iterator[pd.DataFrame]:
        before = self._known()
        known, unknown, events, size, folded = before, [], [], 0, 0
        for frame in rows:
            joining = frame["reason"] == JOIN
            if joining.any():
                known = _added(known, frame.loc[joining, "id"].to_numpy(dtype=np.int64))
                frame = frame[~joining]
            if not self.insert:
                strange = ~frame["id"].isin(known["id"])
                if self.joins:
                    unknown.append(frame[strange])  # of one batch, bounded by the intake cap
                elif strange.any():
                    yield self._rejects(frame[strange])
                frame = frame[~strange]
            if len(frame):
                events.append(frame)
                size += len(frame)
            if size >= FOLD_ROWS + 2 * folded:  # not frame by frame: what is folded is sorted with every further fold
                events = [_newest(pd.concat(events))]
                size = folded = len(events[0])
        if unknown:
            late = pd.concat(unknown)
            strange = ~late["id"].isin(known["id"])
            if strange.any():
                yield self._rejects(late[strange])
            if not strange.all():
                events.append(late[~strange])
        if events:
            newest = _newest(pd.concat(events))
            ids, offsets, partitions = (newest[name].to_numpy(dtype=np.int64) for name in ("id", "offset", "partition"))
            fresh = ~np.isin(ids, known["id"])
            applied = _added(known, ids)
            applied = applied[np.searchsorted(applied["id"], ids)]
            newer = (offsets > applied["offset"]) | ((offsets == applied["offset"]) & (partitions > applied["partition"]))
            if newer.any():
                known = _with(known, _placed(ids[newer], offsets[newer], partitions[newer]))
                yield newest.assign(fresh=fresh)[self.columns][newer]
        if known is not before:
            self.state.update((known.tobytes(),))

    def _rejects(self, events: pd.DataFrame) -> pd.DataFrame:
        return events.assign(kind=REJECT, reason="unknown_customer")[self.columns]

    def close(self) -> None:
        pass


def changes(records: DataFrame, job: KeyedJob, known: DataFrame, joining: DataFrame | None = None) -> DataFrame:
    """The stream of changes, rejects, bad records and partition ends of the stream ``records``. ``known`` (customer_id) are the customers that the
    table guarding the rule has when the query first starts; ``joining`` is a stream of customers that are added later, known
    from the batch on in which they come, its events included."""
    schema = _schema(job)
    columns, insert = list(schema), job.insert
    folded = _in_band(job.project(records), job).mapInArrow(lambda batches: _prefold(batches, insert, schema), _ddl(schema))
    if joining is not None:
        places = [F.lit(0).cast(kind).alias(name) for name, kind in PLACES.items()]  # whole numbers stay whole in pandas only without nulls
        customer = joining.filter(F.col(KEY).isNotNull()).select(F.lit(EVENT).alias("kind"), job.part(F.col(KEY)).alias("part"), F.col(KEY).cast("bigint").alias("id"), *places)
        folded = folded.unionByName(customer.withColumn("reason", F.lit(JOIN)), allowMissingColumns=True)
    customers = known.filter(F.col(KEY).isNotNull()).select(F.col(KEY).cast("bigint").alias("id")).distinct()
    initial = customers.select(F.lit(EVENT).alias("kind"), job.part(F.col("id")).alias("part"), "id")
    return folded.groupBy("kind", "part").transformWithStateInPandas(
        _LastWrite(insert, joining is not None, columns), _ddl(schema), "Append", "None", initialState=initial.groupBy("kind", "part")
    )


def applied(now: Snapshot, job: KeyedJob, changed: DataFrame) -> DataFrame:
    """The opened buckets of the job's table after one batch of changes. New rows are numbered in order of first appearance."""
    target = now.open(job.table, changed)
    after = merge.overwrite(target, changed, KEY, list(job.columns))
    if not job.insert:
        return after
    numbered = assign_ids(stage(changed.filter("fresh").select(KEY, "first_ord"), "fresh"), now.mark(job.table))
    return after.unionByName(merge.inserts(changed, stage(numbered.select(KEY, F.col("id").alias("fresh_id")), "numbered"), target, KEY))


def apply_changes(root: str, job: KeyedJob, rows: DataFrame, batch_id: int) -> None:
    """Publish one batch of ``changes``. A batch that is already published is skipped."""
    store = TableStore(rows.sparkSession, root)
    with store.writer, stage_scope(rows.sparkSession):
        now = store.current()
        if now.batches.get(job.name, -1) >= batch_id:
            return
        rows = stage(rows, "changes")
        if rows.isEmpty():
            return
        first = F.struct(F.col("first_offset").alias("offset"), F.col("first_partition").alias("partition"))
        changed = rows.filter(F.col("kind") == EVENT).select(F.col("id").alias(KEY), *job.columns, first.alias("first_ord"), "fresh")
        bad = rows.filter(F.col("kind") == BAD).withColumn("timestamp", F.lit(None).cast("timestamp")).select(*RECORD_COLUMNS, "reason")
        counts = {"quarantined": store.write_notes("quarantine", job.name, batch_id, bad)}
        if not job.insert:
            rejects = rows.filter(F.col("kind") == REJECT).select("offset", "partition", F.col("id").alias(KEY), *job.columns, "reason")
            counts["rejected"] = store.write_notes(f"rejects_{job.name}", job.name, batch_id, rejects)
        ledger = advance_ledger(now.read(LEDGER), rows.filter(F.col("kind") == END), job.group)
        store.publish(now, job.name, batch_id, {job.table: applied(now, job, changed), LEDGER: ledger}, counts=counts)


def run_keyed(
    records: DataFrame, root: str, job: KeyedJob, checkpoint: str, *, joining: DataFrame | None = None, available_now: bool = False
) -> StreamingQuery:
    """Stream ``records`` through the job's state into the store. The state starts from the store's tables with a new checkpoint and is the
    checkpoint's afterwards."""
    spark = records.sparkSession
    known = TableStore(spark, root).read(job.table if job.insert else "base").select(KEY)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:  # a query keeps the settings that it is started with
        return start(
            changes(records, job, known, joining),
            lambda batch, batch_id: apply_changes(root, job, batch, batch_id),
            checkpoint,
            available_now=available_now,
        )
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
