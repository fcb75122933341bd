"""The order rule: update a known order, or insert it only above the highest id seen so far."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keyed import ROW, before, high_water, latest_per_key, log_order, matching, numbered
from tidemark.operators.merge import overwrite
from tidemark.operators.replay import exact_actions
from tidemark.scratch import stage
from tidemark.sources.tables import ORDER_COLUMNS

KEY = "order_id"
SCOPED_COLUMNS = [KEY, *ORDER_COLUMNS]


def decide(orders: DataFrame, latest: DataFrame, start: Column | None = None) -> DataFrame:
    """order_id, first_ord and ``action`` of the id's first event, U, I or R, for each row of ``latest`` (one per order id).

    An id is inserted iff it is above the table's greatest id and above every id that came earlier
    in the log: rejected and updated ids never exceed that maximum, so all earlier ids may be counted.
    Only the first event of an id can insert it, so one row per id decides, which also takes hot
    ids out of the ordered part. ``start`` is the table's greatest id, to be given where ``orders`` is
    only a part of the table.
    """
    if start is None:
        # one number on the driver, which as a literal also reaches the scan of ``latest`` as a filter
        start = F.lit(high_water(orders, KEY).head()["high_water"])
    above = latest.select(KEY, "first_ord").filter(F.col(KEY) > start)
    records = before(above, F.col(KEY), "max").filter(F.col("before").isNull() | (F.col(KEY) > F.col("before")))
    inserted = records.select(KEY, F.lit("I").alias("insert"))
    known = matching(orders, latest, KEY).withColumn("update", F.lit("U"))
    decided = latest.select(KEY, "first_ord").join(known, KEY, "left").join(inserted, KEY, "left")
    return decided.select(KEY, "first_ord", F.coalesce("update", "insert", F.lit("R")).alias("action"))


def decide_orders(orders: DataFrame, events: DataFrame, start: Column | None = None) -> DataFrame:
    """The first action of every order id of the batch."""
    firsts = events.groupBy(KEY).agg(F.min(log_order()).alias("first_ord"))
    return stage(decide(orders, stage(firsts, "firsts"), start), "decided")


def event_columns(events: DataFrame) -> list[str]:
    return [name for name in events.columns if name != ROW]


def gate(events: DataFrame, decided: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Events with their ``action``: I for the inserting event, U for later events of its id."""
    by_id = decided.select(KEY, "first_ord", F.col("action").alias("id_action"))
    placed = events.join(by_id, KEY)
    repeats = (F.col("id_action") == "I") & (log_order() != F.col("first_ord"))
    return placed.select(*(keep or event_columns(events)), F.when(repeats, F.lit("U")).otherwise(F.col("id_action")).alias("action"))


def rejected(events: DataFrame, decided: DataFrame) -> DataFrame:
    ids = decided.filter(F.col("action") == "R").select(KEY)
    return events.join(ids, KEY, "left_semi").select(*event_columns(events), F.lit("below_high_water").alias("reason"))


def scoped_actions(orders: DataFrame, events: DataFrame, start: Column | None = None) -> DataFrame:
    """Events with their ``action`` under the literal rule, exactly as event by event. The guess that the replay starts from takes ids
    for known that the table had before the batch or that the batch inserts, whether or not an update erases them."""
    events = numbered(events)
    guess = gate(events, decide_orders(orders, events, start), keep=[ROW]).select(ROW, F.col("action").alias("act"))
    exact = exact_actions(orders, events, guess)
    return stage(events.join(exact.withColumnRenamed("act", "action"), ROW).drop(ROW), "acted")


def _literal_update(orders: DataFrame, acted: DataFrame) -> DataFrame:
    """Every update overwrites all rows its customer has by then. The last one of a customer shows in its prior rows and in
    those inserted before it; an inserted row starts with the values of its inserting event."""
    last = acted.filter(F.col("action") == "U").groupBy("customer_id").agg(
        F.max_by(F.struct(*SCOPED_COLUMNS), log_order()).alias("last"), F.max(log_order()).alias("last_ord")
    )
    changes = last.select("customer_id", "last.*", "last_ord")
    after = overwrite(orders, changes, "customer_id", SCOPED_COLUMNS)
    fresh = acted.filter(F.col("action") == "I").join(last, "customer_id", "left")
    later = F.col("last_ord") > log_order()
    inserted = fresh.select(
        *[F.when(later, F.col("last")[c]).otherwise(F.col(c)).alias(c) if c in SCOPED_COLUMNS else F.col(c) for c in orders.columns]
    )
    return after.unionByName(inserted)


def gated_upsert(
    orders: DataFrame,
    events: DataFrame,
    scope: Literal["order", "customer"] = "order",
    start: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(``orders`` after the batch, rejected events).

    ``scope="order"`` updates the row of the event's order and keeps its customer. ``scope="customer"``
    is the literal rule: an event for a known order overwrites order id, times and status of every row
    of the event's customer, rows inserted earlier in the batch included, which can erase ids and lower the greatest one. Its
    result is that of the events one by one, however the log is cut.
    """
    if scope == "customer":
        acted = scoped_actions(orders, events, start)
        rejects = acted.filter(F.col("action") == "R").select(*event_columns(events), F.lit("below_high_water").alias("reason"))
        return _literal_update(orders, acted), rejects
    latest = stage(latest_per_key(events, KEY, first_of=("customer_id",)), "latest")
    decided = stage(decide(orders, latest, start), "decided")
    inserted = latest.join(decided.filter(F.col("action") == "I").select(KEY), KEY, "left_semi")
    inserted = inserted.withColumn("customer_id", F.col("first_customer_id")).select(*orders.columns)
    # an order of the table is always an update, so all of ``latest`` may be offered
    updated = overwrite(orders, latest, KEY, list(ORDER_COLUMNS))
    return updated.unionByName(inserted), rejected(events, decided)
