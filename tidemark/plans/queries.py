"""One query per operator, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import coerce, decode
from tidemark.functions.coerce import DECIMAL
from tidemark.operators import gate, keyed, merge
from tidemark.operators import project as p
from tidemark.operators.envelope import first_images, valid_objects
from tidemark.plans import logs
from tidemark.scratch import new_path, stage, write_once
from tidemark.sources import ledger
from tidemark.sources.records import scan_log, scan_ranges, write_ranges
from tidemark.sources.tables import empty_table
from tidemark.streaming.jobs import Job, order_job, run_job
from tidemark.streaming.keyed_state import KeyedJob, run_keyed, skin_state, staff_state
from tidemark.streaming.store import TableStore

GROUP = "profile"

PLACE = ["partition", "offset"]

_LOGS = {
    "customer": (logs.customer_log, p.project_customer, p.CUSTOMER_VALUES),
    "skin": (logs.skin_log, p.project_skin, p.SKIN_VALUES),
    "staff": (logs.staff_log, p.project_staff, p.STAFF_VALUES),
    "order": (logs.order_log, p.project_order, p.ORDER_VALUES),
}


def valid_events(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    build, project, values = _LOGS[name]
    return p.split(project(build(spark, sf_dir)), values)[0]


def staged_events(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Valid events parsed once into typed columns, for rules that read them more than once."""
    return keyed.numbered(valid_events(spark, sf_dir, name))


def _plain(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison across engines."""
    return rows.select(
        *[
            F.col(name).cast("double").alias(name) if kind.startswith("decimal") else F.col(name)
            for name, kind in rows.dtypes
        ]
    )


# sources


def scan_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_once(logs.customer_log(spark, sf_dir), "log")
    customer = F.get_json_object("value", "$.data[0].customer_id").cast("bigint")
    return scan_log(spark, path).select("key", "topic", *PLACE, customer.alias("customer_id"))


def _order_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.prior_ledger(logs.order_log(spark, sf_dir), GROUP)


def offset_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.group_offsets(_order_ledger(spark, sf_dir), GROUP)


def resume_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = logs.order_log(spark, sf_dir)
    return ledger.resume_plan(log.select("topic", "partition").distinct(), _order_ledger(spark, sf_dir), GROUP)


def resume_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log laid out by ranges of 2^14 offsets, scanned from the ledger's offsets on."""
    path = new_path(spark, "ranges")
    write_ranges(logs.order_log(spark, sf_dir), path, bits=14)
    stored = ledger.stored_offsets(logs.prior_ledger(scan_ranges(spark, path, bits=14), GROUP), GROUP)
    return scan_ranges(spark, path, stored, bits=14).select("key", *PLACE)


def offset_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.advance_ledger(_order_ledger(spark, sf_dir), logs.order_log(spark, sf_dir), GROUP)


# projections and filters


def valid_object_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_objects(logs.dirty_order_log(spark, sf_dir)).select("key", *PLACE)


def first_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image's fields as text, and the JSON type that each has."""
    images = first_images(logs.dirty_order_log(spark, sf_dir), list(p.ORDER_NUMBERS))
    texts = [F.expr(coerce.leaf_text(name)).alias(name) for name in p.ORDER_NUMBERS]
    kinds = [F.expr(coerce.json_kind(name)).alias(f"{name}_kind") for name in p.ORDER_NUMBERS]
    return images.select("key", *PLACE, *texts, *kinds)


def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, quarantine = p.split(p.project_order(logs.dirty_order_log(spark, sf_dir)), p.ORDER_VALUES)
    return quarantine.select("key", *PLACE, "reason")


def _projection(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(valid_events(spark, sf_dir, name))

    return query


def nonzero_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.nonzero_key(valid_events(spark, sf_dir, "skin"))


def coerce_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON value per event, texts first, then numbers and truth values, read by every getter."""
    events = logs.table(spark, sf_dir, "events").select("event_id")
    e = F.col("event_id")
    kind = e % 17
    text = (
        F.when(kind == 0, e.cast("string"))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.lit("null"))
        .when(kind == 3, F.concat(F.lit("12,"), F.lpad((e % 1000).cast("string"), 3, "0")))
        .when(kind == 4, F.concat(e, F.lit(".5")))
        .when(kind == 5, F.concat(F.lit("x"), e))
        .when(kind == 6, F.concat(F.lit("98765432"), F.lpad((e % 1000).cast("string"), 3, "0")))
        .when(kind == 8, F.concat(e, F.lit(".0")))
        .when(kind == 9, F.concat(e % 1000, F.lit("e2")))
        .when(kind == 10, F.concat(e, F.lit(".123456")))
    )
    bare = (
        F.when(kind == 7, F.lit("null"))
        .when(kind == 11, F.concat(e, F.lit(".75")))
        .when(kind == 12, F.concat(F.lit("-"), e % 1000, F.lit(".5")))
        .when(kind == 13, F.lit("true"))
        .when(kind == 14, F.concat(F.lit("98765432"), F.lpad((e % 1000).cast("string"), 3, "0"), F.lit(".5")))
        .when(kind == 15, F.concat(e % 1000, F.lit("e2")))
        .when(kind == 16, e.cast("string"))
    )
    value = F.coalesce(bare, F.concat(F.lit('"'), text, F.lit('"')))
    events = events.withColumn("img", F.from_json(F.concat(F.lit('{"value":'), value, F.lit("}")), "value variant"))
    kinds = {"long": "bigint", "int": "int", "decimal": DECIMAL}
    rows = events
    for name, kind in kinds.items():
        rows = p.read_numbers(rows, "img", {"value": (kind, None)}).withColumnsRenamed({"num": name, "bad": f"bad_{name}"})
        rows = p.read_numbers(rows, "img", {"value": (kind, 0)}).withColumnRenamed("num", f"{name}_or_zero").drop("bad")
    numbers = [F.col(f"{name}.value").alias(f"as_{name}") for name in kinds]
    with_default = [F.col(f"{name}_or_zero.value").alias(f"as_{name}_or_zero") for name in ("long", "int")]
    return _plain(rows.select("event_id", *numbers, *with_default, *[f"bad_{name}" for name in kinds]))


def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.preview(valid_events(spark, sf_dir, "order"))


# scalar functions


def decode_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return logs.table(spark, sf_dir, "customer").select("c_custkey", decode.gender(k % 5).alias("gender"))


def split_birthday(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    calendar, birthday = k % 7, F.when(k % 11 != 0, F.col("c_name"))
    return logs.table(spark, sf_dir, "customer").select(
        "c_custkey",
        decode.solar_birthday(calendar, birthday).alias("birthday"),
        decode.lunar_birthday(calendar, birthday).alias("luna_birthday"),
    )


def blank_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    text = F.when(k % 3 == 0, None).when(k % 3 == 1, "").otherwise(F.col("c_name"))
    return logs.table(spark, sf_dir, "customer").select("c_custkey", decode.blank_fill(text).alias("filled"))


def day_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = logs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    k, ship = F.col("l_orderkey"), F.col("l_shipdate")
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ship)
    text = (
        F.when(k % 5 == 0, F.date_format(ship, "yyyy-MM-dd"))
        .when(k % 5 == 1, F.date_format(ship, "yyyy-MM-dd 23:59:59"))
        .when(k % 5 == 2, (seconds * 1000 + 57_599_999).cast("string"))
        .when(k % 5 == 3, (seconds * 1000 + 57_600_000).cast("string"))
    )
    leaf = F.from_json(F.to_json(F.struct(text.alias("ship"))), "ship variant")
    rows = lines.withColumn("text", text).withColumn("img", leaf)
    rows = p.add_day_epochs(rows, "img", ["ship"], p.DEFAULT_ZONE)
    return rows.select("l_orderkey", "l_linenumber", "text", F.col("day.ship").alias("day_epoch"))


def order_status_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    status = decode.order_status(k % 3, k % 5, k % 7)
    return logs.table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"))


def decode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("c_custkey") % 11 - 1
    labels = [decode.label(code, texts).alias(name) for name, texts in p.SKIN_LABELS.items()]
    return logs.table(spark, sf_dir, "customer").select("c_custkey", *labels)


def decode_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = decode.yes_no(F.col("c_custkey") % 3)
    return logs.table(spark, sf_dir, "customer").select("c_custkey", flag.alias("flag"))


# keyed probes


def _latest(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return stage(keyed.latest_per_key(valid_events(spark, sf_dir, name), key), "latest")


def lookup_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = _latest(spark, sf_dir, "customer", "customer_id")
    known = merge.lookup(logs.prior_base(spark, sf_dir), latest, "customer_id")
    return latest.join(known, "customer_id", "left").select("customer_id", F.col("known_id").alias("id"))


def link_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = _latest(spark, sf_dir, "customer", "customer_id")
    known = merge.lookup(logs.prior_base(spark, sf_dir), latest, "customer_id")
    children = logs.prior_oa(spark, sf_dir).select("base_id", F.lit(True).alias("found"))
    linked = known.withColumnRenamed("known_id", "base_id").join(children, "base_id", "left")
    return linked.select("customer_id", "base_id", F.col("found").isNotNull().alias("has_child"))


def guard_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = _latest(spark, sf_dir, "skin", "customer_id")
    known = keyed.matching(logs.prior_base(spark, sf_dir), latest, "customer_id")
    return latest.join(known, "customer_id", "left_semi").drop("first_ord")


def unmatched_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = _latest(spark, sf_dir, "skin", "customer_id")
    known = keyed.matching(logs.prior_base(spark, sf_dir), latest, "customer_id")
    return latest.join(known, "customer_id", "left_anti").drop("first_ord")


def probe_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = _latest(spark, sf_dir, "order", "order_id")
    known = keyed.matching(logs.prior_orders(spark, sf_dir), latest, "order_id").withColumn("hit", F.lit(True))
    return latest.join(known, "order_id", "left").select("order_id", F.col("hit").isNotNull().alias("found"))


def probe_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = _latest(spark, sf_dir, "staff", "customer_id")
    known = keyed.matching(logs.prior_staff(spark, sf_dir), latest, "customer_id").withColumn("hit", F.lit(True))
    return latest.join(known, "customer_id", "left").select("customer_id", F.col("hit").isNotNull().alias("found"))


# aggregates and prefixes


def high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.high_water(logs.table(spark, sf_dir, "orders"), "o_orderkey")


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = keyed.latest_per_key(valid_events(spark, sf_dir, "staff"), "customer_id")
    return latest.select(
        "customer_id",
        *p.STAFF_COLUMNS,
        F.col("first_ord.offset").alias("first_offset"),
        F.col("first_ord.partition").alias("first_partition"),
    )


def running_high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = staged_events(spark, sf_dir, "order").select(*PLACE, "order_id")
    return keyed.running_high_water(events, logs.prior_orders(spark, sf_dir))


def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    prior = logs.prior_staff(spark, sf_dir)
    latest = _latest(spark, sf_dir, "staff", "customer_id").select("customer_id", "first_ord")
    unseen = stage(latest.join(prior.select("customer_id"), "customer_id", "left_anti"), "unseen")
    return keyed.assign_ids(unseen, prior.agg(F.max("id")).scalar()).select("customer_id", "id")


# write rules


def _customer_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    base, oa = logs.prior_base(spark, sf_dir), logs.prior_oa(spark, sf_dir)
    return merge.linked_upsert(base, oa, valid_events(spark, sf_dir, "customer"))


def linked_upsert_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_tables(spark, sf_dir)[0]


def linked_upsert_oa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_customer_tables(spark, sf_dir)[1])


def _skin_update(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    base, oa = logs.prior_base(spark, sf_dir), logs.prior_oa(spark, sf_dir)
    return merge.partial_update(base, oa, staged_events(spark, sf_dir, "skin"))


def partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_skin_update(spark, sf_dir)[0])


def upsert_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.upsert_staff(logs.prior_staff(spark, sf_dir), valid_events(spark, sf_dir, "staff"))


def gate_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = staged_events(spark, sf_dir, "order")
    decided = gate.decide_orders(logs.prior_orders(spark, sf_dir), events)
    return gate.gate(events, decided).select("order_id", *PLACE, "action")


def gated_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.gated_upsert(logs.prior_orders(spark, sf_dir), staged_events(spark, sf_dir, "order"))[0]


def customer_scope_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = staged_events(spark, sf_dir, "order")
    return gate.gated_upsert(logs.prior_orders(spark, sf_dir), events, scope="customer")[0]


def reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = gate.gated_upsert(logs.prior_orders(spark, sf_dir), staged_events(spark, sf_dir, "order"))[1]
    skin = _skin_update(spark, sf_dir)[1]
    return orders.select(F.col("order_id").alias("key"), *PLACE, "reason").unionByName(
        skin.select(F.col("customer_id").alias("key"), *PLACE, "reason")
    )


def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, quarantine = p.split(p.project_order(logs.dirty_order_log(spark, sf_dir)), p.ORDER_VALUES)
    rejects = reject_report(spark, sf_dir)
    return p.count_reasons(rejects.select("reason").unionByName(quarantine.select("reason")))


def orders_into_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole order log applied to an empty table."""
    return gate.gated_upsert(empty_table(spark, "order_status"), staged_events(spark, sf_dir, "order"))[0]


def orders_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_into_empty(spark, sf_dir).groupBy("status").agg(F.count("*").alias("orders"))


def replay_in_slices(spark: SparkSession, slices: Iterable[DataFrame], tables: dict[str, DataFrame], job: Job) -> TableStore:
    """Run ``job`` as a stream that is stopped and restarted from its checkpoint after every slice of
    the log. Slices follow the order of the log."""
    root, log, checkpoint = (new_path(spark, name) for name in ("store", "log", "checkpoint"))
    store = TableStore.create(spark, root, tables)
    for rows in slices:
        rows.write.mode("append").parquet(log)
        query = run_job(scan_log(spark, log, stream=True), root, job, checkpoint, available_now=True)
        query.awaitTermination()
    return store


def stream_gated_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order log as a stream of two slices with a restart between them; same table as one batch."""
    log = stage(logs.order_log(spark, sf_dir), "log")
    middle = log.agg((F.min("offset") + F.max("offset")) / 2).scalar()
    slices = [log.filter(F.col("offset") <= middle), log.filter(F.col("offset") > middle)]
    tables = {"order_status": logs.prior_orders(spark, sf_dir)}
    return replay_in_slices(spark, slices, tables, order_job("orders", "profile")).read("order_status")


def _keyed_stream(spark: SparkSession, sf_dir: str, name: str, job: KeyedJob, tables: dict[str, DataFrame]) -> DataFrame:
    """A log as two slices with a restart between them, applied through keyed state; the job's table afterwards."""
    log = stage(_LOGS[name][0](spark, sf_dir), "log")
    middle = log.agg((F.min("offset") + F.max("offset")) / 2).scalar()
    root, path, checkpoint = (new_path(spark, part) for part in ("store", "log", "checkpoint"))
    store = TableStore.create(spark, root, tables)
    for rows in (log.filter(F.col("offset") <= middle), log.filter(F.col("offset") > middle)):
        rows.write.mode("append").parquet(path)
        run_keyed(scan_log(spark, path, stream=True), root, job, checkpoint, available_now=True).awaitTermination()
    return store.read(job.table)


def stream_upsert_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staff log through keyed state; same table as one batch."""
    tables = {"customer_info": logs.prior_staff(spark, sf_dir)}
    return _keyed_stream(spark, sf_dir, "staff", staff_state("staff", GROUP), tables)


def stream_partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The skin log through keyed state; same table as one batch."""
    tables = {"base": logs.prior_base(spark, sf_dir), "oa": logs.prior_oa(spark, sf_dir)}
    return _plain(_keyed_stream(spark, sf_dir, "skin", skin_state("skin", GROUP), tables))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_records": scan_records,
    "resume_plan": resume_plan,
    "resume_scan": resume_scan,
    "offset_lookup": offset_lookup,
    "offset_ledger": offset_ledger,
    "valid_objects": valid_object_records,
    "first_image": first_image,
    "quarantine_reasons": quarantine_reasons,
    "project_customer": _projection("customer"),
    "project_skin": _projection("skin"),
    "project_staff": _projection("staff"),
    "project_order": _projection("order"),
    "nonzero_key": nonzero_key,
    "coerce_types": coerce_types,
    "preview_limit": preview_limit,
    "decode_gender": decode_gender,
    "split_birthday": split_birthday,
    "blank_fill": blank_fill,
    "day_epoch": day_epoch,
    "order_status_label": order_status_label,
    "decode_labels": decode_labels,
    "decode_flag": decode_flag,
    "lookup_base": lookup_base,
    "link_child": link_child,
    "guard_semi": guard_semi,
    "unmatched_anti": unmatched_anti,
    "probe_orders": probe_orders,
    "probe_staff": probe_staff,
    "high_water": high_water,
    "latest_per_key": latest_per_key,
    "running_high_water": running_high_water,
    "assign_ids": assign_ids,
    "linked_upsert_base": linked_upsert_base,
    "linked_upsert_oa": linked_upsert_oa,
    "partial_update": partial_update,
    "upsert_staff": upsert_staff,
    "gate_actions": gate_actions,
    "gated_upsert": gated_upsert,
    "customer_scope_update": customer_scope_update,
    "reject_report": reject_report,
    "reject_counts": reject_counts,
    "orders_into_empty": orders_into_empty,
    "orders_by_status": orders_by_status,
    "stream_gated_upsert": stream_gated_upsert,
    "stream_upsert_staff": stream_upsert_staff,
    "stream_partial_update": stream_partial_update,
}
