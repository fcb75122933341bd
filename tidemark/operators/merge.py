"""Keyed write rules over whole batches: plain, linked and guarded.

All rules take valid events (``offset``, ``partition``, key, values) and the tables as they were
before the batch, and return the tables after it. Every event column overwrites, nulls included,
so presence flags decide, never the values.

The target is always the left side of a left join and inserts are a union. Unlike a full outer join
this lets Spark broadcast a small batch, so the target is not shuffled, and lets adaptive execution
split a skewed target partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keyed import ROW, assign_ids, high_water, latest_per_key, matching
from tidemark.operators.project import nonzero_key
from tidemark.scratch import stage
from tidemark.sources.tables import BASE_COLUMNS, OA_COLUMNS, SKIN_COLUMNS, STAFF_COLUMNS


def overwrite(target: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``target`` with ``columns`` replaced in every row whose key is in ``changes`` (one row per key)."""
    new = changes.select(key, F.struct(*columns).alias("new"))
    merged = target.join(new, key, "left")
    return merged.select(
        *[
            F.when(F.col("new").isNotNull(), F.col("new")[name]).otherwise(F.col(name)).alias(name)
            if name in columns
            else F.col(name)
            for name in target.columns
        ]
    )


def lookup(target: DataFrame, changes: DataFrame, key: str, id_column: str = "id") -> DataFrame:
    """(key, ``known_id``) of the target rows that ``changes`` (one row per key) refers to; the
    smallest id if the key is repeated. A small batch is broadcast, see ``matching``."""
    hits = target.select(key, id_column).join(changes.select(key), key, "left_semi")
    return hits.groupBy(key).agg(F.min(id_column).alias("known_id"))


def link(
    target: DataFrame, latest: DataFrame, key: str, start: Column | None = None, id_column: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Ids of the keys of ``latest``, as two narrow staged maps: (key, ``known_id``) of the keys that the target has, and
    (key, ``fresh_id``) of the others, numbered after ``start`` in order of first appearance. ``start`` is the greatest
    id of the target, to be given where ``target`` is only a part of the table."""
    known = stage(lookup(target, latest, key, id_column), "known")
    unseen = stage(latest.select(key, "first_ord").join(known, key, "left_anti"), "unseen")
    if start is None:
        start = F.lit(high_water(target, id_column).head()["high_water"])
    fresh = assign_ids(unseen, start).select(key, F.col("id").alias("fresh_id"))
    return known, stage(fresh, "fresh")


def inserts(latest: DataFrame, fresh: DataFrame, target: DataFrame, key: str, id_column: str = "id") -> DataFrame:
    """New rows in the target's shape; columns the event does not have stay unset."""
    rows = latest.join(fresh.withColumnRenamed("fresh_id", id_column), key)
    return rows.select(
        *[
            (F.col(field.name) if field.name in rows.columns else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in target.schema
        ]
    )


def upsert(
    target: DataFrame, events: DataFrame, key: str, columns: list[str], start: Column | None = None
) -> DataFrame:
    """Plain upsert by ``key``; new rows get a generated id."""
    latest = stage(latest_per_key(events, key), "latest")
    _, fresh = link(target, latest, key, start)
    # a key of the target is never new, so all of ``latest`` may be offered
    return overwrite(target, latest, key, columns).unionByName(inserts(latest, fresh, target, key))


def upsert_staff(customer_info: DataFrame, events: DataFrame, start: Column | None = None) -> DataFrame:
    return upsert(customer_info, events, "customer_id", list(STAFF_COLUMNS), start)


def linked_upsert(
    base: DataFrame, oa: DataFrame, events: DataFrame, start: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Parent ``base`` and child ``oa`` after the batch.

    A known customer updates its parents and the children of the looked-up parent, and never creates
    a missing child. A new customer inserts both, the child linked by the generated id.
    """
    key = "customer_id"
    latest = stage(latest_per_key(events, key), "latest")
    known, fresh = link(base, latest, key, start)
    base_after = overwrite(base, latest, key, list(BASE_COLUMNS)).unionByName(inserts(latest, fresh, base, key))

    children = latest.join(known.withColumnRenamed("known_id", "base_id"), key)
    oa_after = overwrite(oa, children, "base_id", list(OA_COLUMNS))
    return base_after, oa_after.unionByName(inserts(latest, fresh, oa, key, "base_id"))


def partial_update(base: DataFrame, oa: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``oa`` with the skin columns of known customers replaced, rejected events). Never inserts."""
    events = nonzero_key(events)
    latest = stage(latest_per_key(events, "customer_id"), "latest")
    known = stage(matching(base, latest, "customer_id"), "known")
    guarded = latest.join(known, "customer_id", "left_semi")
    oa_after = overwrite(oa, guarded, "customer_id", list(SKIN_COLUMNS))
    rejects = events.join(known, "customer_id", "left_anti").withColumn("reason", F.lit("unknown_customer"))
    return oa_after, rejects.drop(ROW)
