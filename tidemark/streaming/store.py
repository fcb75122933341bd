"""Target tables in a shared folder, written by Spark's own writer, and one small state table that makes a batch current.

A table is split by a hash of its key into buckets, and a bucket has two slots, folders of its table's partitioning. A batch reads the
live slots of the buckets that its keys fall in and overwrites their other slots (dynamic partition overwrite), so nothing that a reader
sees changes, and what a failed attempt left behind is overwritten by the next one. The state table has one row: the version, the
live slot of every bucket, each table's greatest id, and the last batch of every job with its counts. It alternates between two slots, too, so
writing it is what publishes tables, ledger, counts and notes at once, and nothing is left to clean up.

One application writes to a store; its jobs take turns. A snapshot can be read until its buckets have been published twice again.
"""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.ledger import LEDGER_SCHEMA
from tidemark.sources.tables import TABLES, table_schema

LEDGER = "offset_manager"

# Children that carry another customer than their parent and so lie in another bucket, found by the parent's id.
STRAYS = "strays"
STRAYS_SCHEMA = T.StructType([T.StructField("base_id", T.LongType()), T.StructField("customer_id", T.LongType())])

SCHEMAS: dict[str, T.StructType] = {LEDGER: LEDGER_SCHEMA, STRAYS: STRAYS_SCHEMA, **{name: table_schema(name) for name in TABLES}}

# Bucket key of every table; the ledger has one row per topic partition and stays whole. A child row
# carries its parent's customer, so parent and child of an event lie in the same bucket.
KEYS = {"base": "customer_id", "oa": "customer_id", "customer_info": "customer_id", "order_status": "order_id", STRAYS: "base_id"}

# Columns whose maximum the write rules need. They only ever grow in a bucket-wise update.
MARKS = {"base": "id", "customer_info": "id", "order_status": "order_id"}

# A bucket without rows.
EMPTY = -1

STATE = """version bigint, buckets int, slots map<string, array<int>>, greatest map<string, bigint>,
    batches map<string, bigint>, counts map<string, map<string, bigint>>"""

_writers: defaultdict[str, threading.RLock] = defaultdict(threading.RLock)


@dataclass
class Snapshot:
    """The tables of one version."""

    spark: SparkSession
    root: str
    version: int
    buckets: int
    slots: dict[str, list[int]]
    greatest: dict[str, int]
    batches: dict[str, int]
    counts: dict[str, dict[str, int]]
    opened: dict[str, list[int]] = field(default_factory=dict)

    def bucket(self, name: str) -> Column:
        if name not in KEYS:
            return F.lit(0)
        return F.pmod(F.xxhash64(F.col(KEYS[name])), F.lit(self.buckets)).cast("int")

    def read(self, name: str) -> DataFrame:
        return self._scan(name, range(len(self.slots.get(name, []))))

    def open(self, name: str, near: DataFrame) -> DataFrame:
        """The buckets that hold the keys of ``near``, whole, to be replaced by the batch. At most ``buckets`` small numbers come to the
        driver for that."""
        self.opened[name] = self._hit(name, near)
        return self._scan(name, self.opened[name])

    def near(self, name: str, near: DataFrame) -> DataFrame:
        """The buckets that hold the keys of ``near``, whole, only to be read."""
        return self._scan(name, self._hit(name, near))

    def _hit(self, name: str, near: DataFrame) -> list[int]:
        return sorted(row["bucket"] for row in near.select(self.bucket(name).alias("bucket")).distinct().collect())

    def _scan(self, name: str, buckets: Iterable[int]) -> DataFrame:
        live = self.slots.get(name, [])
        paths = [f"{self.root}/tables/{name}/bucket={b}/slot={live[b]}" for b in buckets if b < len(live) and live[b] != EMPTY]
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).parquet(*paths)

    def mark(self, name: str) -> Column:
        """Greatest id of the whole table, 0 if it is empty."""
        return F.lit(self.greatest.get(name, 0)).cast("bigint")


def strays(base: DataFrame, oa: DataFrame) -> DataFrame:
    """(base_id, customer_id) of the children that do not carry their parent's customer, or have no parent. The write rules add none: they insert a
    child with its parent's customer, and change neither's."""
    parents = base.select(F.col("id").alias("base_id"), F.col("customer_id").alias("parent"))
    children = oa.select("base_id", "customer_id").join(parents, "base_id", "left")
    return children.filter(F.col("parent").isNull() | ~F.col("customer_id").eqNullSafe(F.col("parent"))).select("base_id", "customer_id").distinct()


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.writer = _writers[root]

    @classmethod
    def create(cls, spark: SparkSession, root: str, tables: dict[str, DataFrame], buckets: int = 16) -> TableStore:
        """A store that starts with ``tables``. Choose ``buckets`` so that one bucket of the largest
        table is a good file size, and well above the number of keys in a usual batch."""
        store = cls(spark, root)
        if {"base", "oa"} <= tables.keys():
            tables = {**tables, STRAYS: strays(tables["base"], tables["oa"])}
        store._write(Snapshot(spark, root, 0, buckets, {}, {}, {}, {}), tables, whole=True)
        return store

    def current(self) -> Snapshot:
        # the slot that is not current may be replaced meanwhile
        state = self.spark.read.schema(STATE).option("ignoreMissingFiles", "true").parquet(f"{self.root}/state")
        newest = state.drop("slot").orderBy(F.desc("version")).limit(1).collect()[0].asDict(recursive=True)
        return Snapshot(self.spark, self.root, **newest)

    def read(self, name: str) -> DataFrame:
        return self.current().read(name)

    def publish(
        self, now: Snapshot, job: str, batch_id: int, tables: dict[str, DataFrame], *, whole: bool = False, counts: dict[str, int] | None = None
    ) -> None:
        """Make ``tables`` current together. They hold every row of the buckets opened in ``now``, or with ``whole`` every row of
        the table; other tables and buckets stay as they are."""
        if self.current().version != now.version:
            raise RuntimeError(f"version {now.version + 1} of {self.root} is already published")
        following = Snapshot(
            self.spark, self.root, now.version + 1, now.buckets, dict(now.slots), dict(now.greatest),
            {**now.batches, job: batch_id}, {**now.counts, job: counts or {}}, now.opened,
        )
        self._write(following, tables, whole)

    def _write(self, following: Snapshot, tables: dict[str, DataFrame], whole: bool) -> None:
        for name, rows in tables.items():
            size = following.buckets if name in KEYS else 1
            live = following.slots.get(name, [EMPTY] * size)
            # another slot than the live one; an empty bucket may have leftovers in either
            other = [0 if slot == EMPTY else 1 - slot for slot in live]
            placed = rows.withColumn("bucket", following.bucket(name))
            placed = placed.withColumn("slot", F.element_at(F.array(*map(F.lit, other)), F.col("bucket") + 1))
            seen = Observation()
            mark = F.max(MARKS[name] if name in MARKS else F.lit(None).cast("bigint"))
            # rebalancing gathers a bucket's rows in few files and splits a bucket that is too big
            placed = placed.hint("rebalance", "bucket").observe(seen, F.collect_set("bucket").alias("written"), mark.alias("mark"))
            self._overwrite(placed, f"tables/{name}", "bucket", "slot")
            written = set(seen.get["written"])
            replaced = range(size) if whole or name not in KEYS else following.opened[name]
            after = list(live)
            for b in replaced:
                after[b] = other[b] if b in written else EMPTY
            following.slots[name] = after
            marks = [m for m in (seen.get["mark"], None if whole else following.greatest.get(name)) if m is not None]
            following.greatest.pop(name, None)
            if marks:
                following.greatest[name] = max(marks)
        row = (following.version, following.buckets, following.slots, following.greatest, following.batches, following.counts)
        state = self.spark.createDataFrame([row], STATE).withColumn("slot", F.lit(following.version % 2))
        self._overwrite(state.coalesce(1), "state", "slot")

    def _overwrite(self, rows: DataFrame, folder: str, *partitions: str) -> None:
        """Replace the partitions that ``rows`` have, and no others."""
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
        writer.parquet(f"{self.root}/{folder}")

    def write_notes(self, name: str, job: str, batch_id: int, rows: DataFrame) -> int:
        """Side output of one batch (quarantine, rejects), replaced if the batch is run again and visible once the batch is
        published. Returns the number of rows, counted as they are written."""
        seen = Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(f"{self.root}/notes/{name}/job={job}/batch={batch_id}")
        return seen.get["rows"]

    def read_notes(self, name: str) -> DataFrame:
        """Notes of the published batches."""
        notes = self.spark.read.parquet(f"{self.root}/notes/{name}")
        batches = self.current().batches
        last = F.coalesce(*[F.when(F.col("job") == job, F.lit(batch)) for job, batch in batches.items()], F.lit(-1))
        return notes.filter(F.col("batch") <= last)
