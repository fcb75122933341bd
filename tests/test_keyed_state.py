"""Rules as keyed state: a stream with restarts equals one batch."""

import dataclasses
import random

from helpers import log_of, rows_of, table_of

from tidemark import scratch
from tidemark.operators import merge
from tidemark.operators import project as p
from tidemark.sources.records import scan_log
from tidemark.streaming import keyed_state as ks
from tidemark.streaming.store import LEDGER, TableStore

CODES = {"skin_type": 2, "is_allergy": 1, "skin_color": 5, "improve_type": 8}


def _staff(seed, count):
    rng = random.Random(seed)
    return [
        (off % 3, off, "broken" if rng.random() < 0.1 else {
            "customer_id_se": 4 if rng.random() < 0.33 else rng.randrange(12), "trace_staff_id": off, "recom_staff_id": rng.choice([1, 2, None]), "serve_staff_id": off % 7,
        })
        for off in range(count)
    ]


def _stream(spark, slices, root, job):
    log, checkpoint = scratch.new_path(spark, "log"), scratch.new_path(spark, "cp")
    for rows in slices:
        rows.write.mode("append").parquet(log)
        ks.run_keyed(scan_log(spark, log, stream=True), root, job, checkpoint, available_now=True).awaitTermination()


def test_staff_state_equals_the_batch_rule_after_restarts(spark):
    values = _staff(1, 60)
    log = log_of(spark, values)
    prior = table_of(spark, "customer_info", [{"id": 5, "customer_id": 4}, {"id": 9, "customer_id": 11}, {"id": 7, "customer_id": 40}])
    root = scratch.new_path(spark, "store")
    store = TableStore.create(spark, root, {"customer_info": prior}, buckets=8)
    _stream(spark, [log.filter("offset < 20"), log.filter("offset between 20 and 41"), log.filter("offset > 41")], root, ks.staff_state("staff", "g"))
    valid, quarantine = p.split(p.project_staff(log), p.STAFF_VALUES)
    assert rows_of(store.read("customer_info")) == rows_of(merge.upsert_staff(prior, valid))
    places = ("offset", "partition", "reason", "value")
    assert rows_of(store.read_notes("quarantine"), *places) == rows_of(quarantine, *places)
    assert rows_of(store.read(LEDGER)) == [("g", "t", 0, 58), ("g", "t", 1, 59), ("g", "t", 2, 60)]
    assert store.current().version == 3


def test_skin_state_equals_the_batch_rule(spark):
    rng = random.Random(2)
    values = [(off % 2, off, {"customer_id": rng.randrange(7), **CODES, "skin_type": rng.randrange(0, 6)}) for off in range(40)]
    log = log_of(spark, values)
    base = table_of(spark, "base", [{"id": c, "customer_id": c} for c in (1, 3, 4)])
    oa = table_of(spark, "oa", [{"base_id": c, "customer_id": c, "skin_type": "old"} for c in (1, 3, 5)])
    root = scratch.new_path(spark, "store")
    store = TableStore.create(spark, root, {"base": base, "oa": oa}, buckets=8)
    _stream(spark, [log.filter("offset < 25"), log.filter("offset >= 25")], root, ks.skin_state("skin", "g"))
    want, rejects = merge.partial_update(base, oa, p.split(p.project_skin(log), p.SKIN_VALUES)[0])
    assert rows_of(store.read("oa")) == rows_of(want)
    places = ("customer_id", "offset", "partition", "reason")
    assert rows_of(store.read_notes("rejects_skin"), *places) == rows_of(rejects, *places)


def test_customers_that_join_later_are_known_from_then_on(spark):
    root = scratch.new_path(spark, "store")
    oa = table_of(spark, "oa", [{"base_id": c, "customer_id": c} for c in (1, 2)])
    store = TableStore.create(spark, root, {"base": table_of(spark, "base", [{"id": 1, "customer_id": 1}]), "oa": oa})
    log, joins, checkpoint = (scratch.new_path(spark, name) for name in ("log", "joins", "cp"))
    job = ks.skin_state("skin", "g")
    for offset, joined in ((0, []), (1, [2]), (2, [])):
        log_of(spark, [(0, offset, {"customer_id": 2, **CODES, "skin_type": offset + 1})]).write.mode("append").parquet(log)
        spark.createDataFrame([(c,) for c in joined], "customer_id bigint").write.mode("append").parquet(joins)
        joining = spark.readStream.schema("customer_id bigint").parquet(joins)
        ks.run_keyed(scan_log(spark, log, stream=True), root, job, checkpoint, joining=joining, available_now=True).awaitTermination()
    assert rows_of(store.read_notes("rejects_skin"), "offset", "customer_id") == [(0, 2)]
    assert rows_of(store.read("oa"), "customer_id", "skin_type") == [(1, None), (2, "干性")]


def test_an_older_event_in_a_later_batch_does_not_win(spark):
    log = log_of(spark, [(0, off, {"customer_id_se": 1, "trace_staff_id": off, "recom_staff_id": 1, "serve_staff_id": 1}) for off in (5, 2)])
    root = scratch.new_path(spark, "store")
    store = TableStore.create(spark, root, {"customer_info": table_of(spark, "customer_info", [])})
    _stream(spark, [log.filter("offset = 5"), log.filter("offset = 2")], root, ks.staff_state("staff", "g"))
    assert rows_of(store.read("customer_info")) == [(1, 1, 5, 1, 1)]


def test_state_has_one_value_per_part_not_per_customer(spark):
    rng = random.Random(6)
    values = [(off % 2, off, {"customer_id": rng.randrange(300), **CODES, "skin_type": rng.randrange(1, 6)}) for off in range(900)]
    log = log_of(spark, values)
    base = table_of(spark, "base", [{"id": c, "customer_id": c} for c in range(0, 300, 2)])
    oa = table_of(spark, "oa", [{"base_id": c, "customer_id": c, "skin_type": "old"} for c in range(0, 300, 3)])
    root, path, checkpoint = (scratch.new_path(spark, name) for name in ("store", "log", "cp"))
    store = TableStore.create(spark, root, {"base": base, "oa": oa}, buckets=8)
    job = ks.KeyedJob("skin", "g", "oa", tuple(p.SKIN_VALUES[1:]), insert=False)
    job = dataclasses.replace(job, parts=3) if hasattr(job, "parts") else job
    # the later offsets first: none of the second batch's events is newer for a customer of the first
    for part in ("offset >= 450", "offset < 450"):
        log.filter(part).write.mode("append").parquet(path)
        query = ks.run_keyed(scan_log(spark, path, stream=True), root, job, checkpoint, available_now=True)
        query.awaitTermination()
        held = [operator["numRowsTotal"] for progress in query.recentProgress for operator in progress["stateOperators"]]
        assert held and max(held) <= 3
    want, rejects = merge.partial_update(base, oa, p.split(p.project_skin(log), p.SKIN_VALUES)[0])
    assert rows_of(store.read("oa")) == rows_of(want)
    places = ("customer_id", "offset", "partition", "reason")
    assert rows_of(store.read_notes("rejects_skin"), *places) == rows_of(rejects, *places)


def test_the_stream_is_read_once_and_folded_over_several_arrow_batches(spark):
    log = log_of(spark, [(off % 2, off, {"customer_id_se": off % 3, "trace_staff_id": off, "recom_staff_id": 1, "serve_staff_id": 1}) for off in range(60)])
    path = scratch.write_once(log.coalesce(1), "log")
    known = spark.createDataFrame([], "customer_id bigint")
    job = ks.staff_state("staff", "g")
    changes = ks.changes(scan_log(spark, path, stream=True), job, known)
    assert changes._jdf.queryExecution().analyzed().toString().count("StreamingRelation") == 1
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        schema = ks._schema(job)
        rows = ks._in_band(job.project(scan_log(spark, path)), job)
        found = rows.mapInArrow(lambda batches: ks._prefold(batches, True, schema), ks._ddl(schema))
        assert rows_of(found, "kind", "id", "offset", "first_offset", "trace_staff_id") == [
            ("end", 0, 58, 0, None), ("end", 1, 59, 1, None), ("event", 0, 57, 0, 57), ("event", 1, 58, 1, 58), ("event", 2, 59, 2, 59),
        ]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
