"""Exact actions of the literal order rule, under which an update can erase ids and lower the maximum.

An event for a known order gives its id to every row of the event's customer, so which ids are known, and the greatest one, depends
on all decisions before. The rule is replayed set by set until nothing changes: from the decisions of a round follow the spans of the log
in which each customer holds each id, and from the spans every event's decision anew. Decisions depend on earlier events
only, so the decisions that no longer change are those of the event-by-event replay, and there are no others; each round settles at least the
first open event, in practice all but the few that hang on each other.

Work is on narrow rows: position, customer, order, decision. Positions are dense numbers in log order. What runs along a customer or an id
is folded per range of positions first, so that a hot one is not one task's.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.keyed import ROW, before, log_order
from tidemark.scratch import stage

CUSTOMER, ORDER = "customer_id", "order_id"

# A range of positions: the rows of one key in it are one task's sort unit.
CHUNK_BITS = 20

# Ranges of positions in which events first look for a greater id together. An open event is compared with the spans that begin or end
# in its range, so a range is short; what covers whole ranges goes by blocks.
RANGE_BITS = 6


def positions(events: DataFrame) -> DataFrame:
    """(row_id, customer_id, order_id, ``pos``) of numbered events, ``pos`` counting from 1 in log order."""
    narrow = stage(events.select(ROW, CUSTOMER, ORDER, log_order().alias("first_ord")), "narrow")
    placed = before(narrow, F.lit(1).cast("bigint"), "sum")
    return placed.select(ROW, CUSTOMER, ORDER, (F.coalesce("before", F.lit(0)) + 1).alias("pos"))


def along(rows: DataFrame, key: str, order: list[str], last: int, folds: dict[str, tuple[Literal["sum", "min"], Column, bool]]) -> DataFrame:
    """Adds to every row, per name in ``folds``, the sum or least of a value over the rows of its ``key`` that come before it, or with
    the flag, after it, by ``order``, whose first column is a position up to ``last``. Null where there are none."""
    combine = {"sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)), "min": (F.min, F.least)}
    earlier, later = (Window.unboundedPreceding, -1), (1, Window.unboundedFollowing)

    def running(keys: list[str], by: list[str], values: dict[str, Column]) -> dict[str, Column]:
        of_key = Window.partitionBy(*keys).orderBy(*by)
        return {name: combine[kind][0](values[name]).over(of_key.rowsBetween(*(later if after else earlier))) for name, (kind, _, after) in folds.items()}

    if last >> CHUNK_BITS == 0:  # one range of positions holds all
        return rows.withColumns(running([key], order, {name: value for name, (_, value, _) in folds.items()}))
    rows = rows.withColumns({"chunk": F.shiftright(order[0], CHUNK_BITS), **{f"value_{name}": value for name, (_, value, _) in folds.items()}})
    totals = rows.groupBy(key, "chunk").agg(*[combine[kind][0](f"value_{name}").alias(name) for name, (kind, _, _) in folds.items()])
    beyond = running([key], ["chunk"], {name: F.col(name) for name in folds})
    placed = rows.join(totals.select(key, "chunk", *[column.alias(f"beyond_{name}") for name, column in beyond.items()]), [key, "chunk"])
    own = running([key, "chunk"], order, {name: F.col(f"value_{name}") for name in folds})
    both = {name: combine[kind][1](F.col(f"beyond_{name}"), own[name]) for name, (kind, _, _) in folds.items()}
    return placed.withColumns(both).drop("chunk", *[f"{part}_{name}" for name in folds for part in ("value", "beyond")])


def spans(acts: DataFrame, held: DataFrame, last: int) -> DataFrame:
    """(order_id, ``begin``, ``end``): after which position a customer holds an id and the last at which it still does (null: for good).
    ``held`` has the rows of the batch's customers before it. An update of a customer without rows changes nothing."""
    update = F.col("act") == "U"
    rows = acts.filter("act <> 'R'").select(CUSTOMER, ORDER, "pos", update.alias("update"))
    rows = rows.unionByName(held.select(CUSTOMER, ORDER, F.lit(0).cast("bigint").alias("pos"), F.lit(False).alias("update")))
    followed = along(
        rows,
        CUSTOMER,
        ["pos"],
        last,
        {
            "end": ("min", F.when(F.col("update"), F.col("pos")), True),
            "first_row": ("min", F.when(~F.col("update"), F.col("pos")), False),
        },
    )
    return followed.filter(~F.col("update") | F.col("first_row").isNotNull()).select(ORDER, F.col("pos").alias("begin"), "end")


def _cover(low: str, high: str, levels: int) -> Column:
    """The fewest aligned blocks (level, node) that make up the positions ``low`` to ``high``: a block of level l spans 2^l."""
    first = f"shiftright({low} + shiftleft(1L, l) - 1, l)"
    last = f"(shiftright({high} + 1, l) - 1)"
    return F.expr(
        f"""filter(flatten(transform(sequence(0, {levels}), l -> array(
            CASE WHEN {first} <= {last} AND {first} % 2 = 1 THEN named_struct('level', l, 'node', {first}) END,
            CASE WHEN {first} <= {last} AND {last} % 2 = 0 THEN named_struct('level', l, 'node', {last}) END))), b -> b IS NOT NULL)"""
    )


def greatest_held(asked: DataFrame, held_spans: DataFrame, last: int) -> DataFrame:
    """(``pos``, ``held``) for the events in ``asked`` (``pos``, order_id) that fall into a span: an id of such a span, the greatest one unless a
    smaller one is above the event's id already.

    Of the ranges of positions that a span covers whole, aligned blocks of ranges keep the greatest id, twice the logarithm of their number for a
    span at most. They are looked up once per range, which settles most events. The others meet the spans that begin or end within
    their range, of which there are no more than positions, as equal spans are one.
    """
    bits, size = RANGE_BITS, 1 << RANGE_BITS
    levels = max(1, last >> bits).bit_length()
    # rows of the table are held from position 0 on, so that they begin with a range
    low = F.when(F.col("begin") == 0, F.lit(0).cast("bigint")).otherwise(F.col("begin") + 1).alias("low")
    whole = held_spans.groupBy(low, F.coalesce("end", F.lit(((last >> bits) + 1 << bits) - 1)).alias("high")).agg(F.max(ORDER).alias("id")).filter("low <= high")
    whole = stage(whole, "whole")
    ranges = whole.select("id", F.shiftright(F.col("low") + (size - 1), bits).alias("first"), (F.shiftright(F.col("high") + 1, bits) - 1).alias("end"))
    blocks = ranges.filter("first <= end").select("id", F.explode(_cover("first", "end", levels)).alias("block"))
    blocks = blocks.groupBy("block.level", "block.node").agg(F.max("id").alias("held"))

    asked = asked.withColumn("range", F.shiftright("pos", bits))
    inside = F.expr(f"transform(sequence(0, {levels}), l -> named_struct('level', l, 'node', shiftright(range, l)))")
    looked = asked.select("range").distinct().select("range", F.explode(inside).alias("block")).select("range", "block.level", "block.node")
    wide = looked.join(blocks, ["level", "node"]).groupBy("range").agg(F.max("held").alias("wide"))
    near = asked.join(wide, "range", "left")

    edges = F.array(F.when(F.col("low") % size != 0, F.shiftright("low", bits)), F.when((F.col("high") + 1) % size != 0, F.shiftright("high", bits)))
    partial = whole.select("id", "low", "high", F.explode(F.array_distinct(F.array_compact(edges))).alias("range"))
    open_events = near.filter(F.col("wide").isNull() | (F.col(ORDER) > F.col("wide")))
    narrow = open_events.join(partial, "range").filter("pos BETWEEN low AND high").groupBy("pos").agg(F.max("id").alias("narrow"))
    found = near.join(narrow, "pos", "left").select("pos", F.greatest("wide", "narrow").alias("held"))
    return found.filter("held IS NOT NULL")


def next_round(acts: DataFrame, held: DataFrame, others: DataFrame, floor: int | None, last: int) -> DataFrame:
    """``acts`` with the decisions that follow from its own, and ``changed``. ``others`` has the ids of rows that the batch cannot change,
    as far as its events name them, ``floor`` the greatest of all those."""
    known = stage(spans(acts, held, last), "spans")
    none = F.lit(None).cast("bigint")
    # at one position an event asks before spans begin or end
    steps = acts.select(ORDER, F.col("pos").alias("at"), F.lit(0).alias("step"), F.lit(0).alias("delta"), ROW, CUSTOMER, "act")
    for edge, delta in (("begin", 1), ("end", -1)):
        some = known.filter(F.col(edge).isNotNull()).select(ORDER, F.col(edge).alias("at"), F.lit(1).alias("step"), F.lit(delta).alias("delta"))
        steps = steps.unionByName(some, allowMissingColumns=True)
    fixed = others.select(ORDER, F.lit(0).cast("bigint").alias("at"), F.lit(1).alias("step"), F.lit(1).alias("delta"))
    steps = steps.unionByName(fixed, allowMissingColumns=True)
    counted = along(steps, ORDER, ["at", "step"], last, {"holders": ("sum", F.col("delta"), False)})
    asked = counted.filter("step = 0").select(ROW, CUSTOMER, ORDER, F.col("at").alias("pos"), "act", (F.coalesce("holders", F.lit(0)) > 0).alias("found"))
    asked = stage(asked, "asked")

    above = F.col(ORDER) > floor if floor is not None else F.lit(True)
    tops = greatest_held(asked.filter(~F.col("found") & above), known.filter(above), last)
    greatest = F.coalesce(F.greatest(F.col("held"), F.lit(floor).cast("bigint") if floor is not None else none), F.lit(0))
    act = F.when(F.col("found"), "U").when(F.col(ORDER) > greatest, "I").otherwise("R")
    decided = asked.join(tops, "pos", "left").withColumn("new", act)
    return decided.select(ROW, CUSTOMER, ORDER, "pos", F.col("new").alias("act"), (F.col("new") != F.col("act")).alias("changed"))


def exact_actions(orders: DataFrame, events: DataFrame, first_guess: DataFrame) -> DataFrame:
    """(row_id, ``act``) of every event under the literal rule, U, I or R. ``first_guess`` has (row_id, ``act``) to start from; any will do, a
    better one saves rounds. The driver sees two numbers and one count per round."""
    acts = stage(positions(events).join(first_guess, ROW), "acts")
    last = acts.count()
    rows = orders.select(CUSTOMER, ORDER).filter(F.col(ORDER).isNotNull())
    touched = acts.select(CUSTOMER).distinct()
    held = stage(rows.join(touched, CUSTOMER, "left_semi").distinct(), "held")
    beyond = rows.join(touched, CUSTOMER, "left_anti")
    floor = beyond.agg(F.max(ORDER)).head()[0]
    others = stage(beyond.select(ORDER).join(acts.select(ORDER), ORDER, "left_semi").distinct(), "others")
    while True:
        acts = stage(next_round(acts, held, others, floor, last), "acts")
        if acts.filter("changed").isEmpty():
            return acts.select(ROW, "act")
