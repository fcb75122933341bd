"""Streams, publications and ledgers: streaming equals batch, replays change nothing."""

import random

import pytest
from helpers import log_of, rows_of, table_of
from pyspark.sql import functions as F

from tidemark import scratch
from tidemark.operators import gate, keyed, merge
from tidemark.operators import project as p
from tidemark.plans import queries
from tidemark.sources import bucketed
from tidemark.sources import ledger as led
from tidemark.sources.jdbc import scan_options
from tidemark.sources.records import RECORDS_PER_SECOND, scan_log, scan_ranges, starting_offsets, topic_options, write_ranges
from tidemark.sources.tables import empty_table
from tidemark.streaming import ends, jobs
from tidemark.streaming.run import run_until, start
from tidemark.streaming.store import EMPTY, LEDGER, TableStore


def _order_values(seed, count):
    rng = random.Random(seed)
    return [
        (off % 3, off, {"order_id": rng.randrange(40), "customer_id": rng.randrange(6), "submit_time": off})
        if rng.random() < 0.9
        else (off % 3, off, "broken")
        for off in range(count)
    ]


def test_sliced_stream_equals_one_batch(spark):
    values = _order_values(1, 90)
    log = log_of(spark, values)
    slices = [log.filter("offset < 30"), log.filter("offset >= 30 and offset < 60"), log.filter("offset >= 60")]
    job = jobs.order_job("orders", "g")
    store = queries.replay_in_slices(spark, slices, {"order_status": empty_table(spark, "order_status")}, job)

    valid, quarantine = p.split(p.project_order(log), p.ORDER_VALUES)
    want, rejects = gate.gated_upsert(empty_table(spark, "order_status"), valid)
    assert rows_of(store.read("order_status")) == rows_of(want)
    assert store.current().version == 3
    assert store.current().greatest == {"order_status": max(r[1] for r in rows_of(want))}
    places = ("offset", "partition", "reason")
    assert rows_of(store.read_notes("quarantine"), *places) == rows_of(quarantine, *places)
    assert rows_of(store.read_notes("rejects_orders"), *places) == rows_of(rejects, *places)
    assert rows_of(store.read(LEDGER)) == [("g", "t", 0, 88), ("g", "t", 1, 89), ("g", "t", 2, 90)]


def test_replayed_batch_changes_nothing(spark):
    root = scratch.new_path(spark, "store")
    store = TableStore.create(spark, root, {"order_status": empty_table(spark, "order_status")})
    job = jobs.order_job("orders", "g")
    projected = job.project(log_of(spark, _order_values(2, 40)))
    jobs.apply_batch(root, job, projected, 0)
    first = store.current(), rows_of(store.read("order_status"))
    jobs.apply_batch(root, job, projected, 0)
    assert (store.current(), rows_of(store.read("order_status"))) == first
    jobs.apply_batch(root, job, projected.filter("offset < 0"), 1)
    assert store.current() == first[0]


def test_failed_batch_leaves_the_published_tables(spark):
    root = scratch.new_path(spark, "store")
    store = TableStore.create(spark, root, {"order_status": empty_table(spark, "order_status")})
    good = jobs.order_job("orders", "g")

    def fails(now, events):
        # the attempt ends after its table is written, before it is published; the next one has other rows
        after = gate.gated_upsert(now.open("order_status", events), events)[0]
        placed = after.withColumn("bucket", now.bucket("order_status")).withColumn("slot", F.lit(0))
        store._overwrite(placed.withColumn("status", F.lit("lost")), "tables/order_status", "bucket", "slot")
        raise RuntimeError("lost")

    bad = jobs.Job(good.name, good.group, good.project, good.values, fails)
    projected = good.project(log_of(spark, _order_values(3, 30)))
    try:
        jobs.apply_batch(root, bad, projected, 0)
    except RuntimeError:
        pass
    assert store.current().version == 0
    assert store.read("order_status").count() == 0
    assert not store.current().batches
    jobs.apply_batch(root, good, projected, 0)
    valid, _ = p.split(projected, p.ORDER_VALUES)
    assert rows_of(store.read("order_status")) == rows_of(
        gate.gated_upsert(empty_table(spark, "order_status"), valid)[0]
    )


def test_three_jobs_share_a_store(spark):
    """Customers, then skin answers for the same children, then staff: one store, one ledger."""
    root = scratch.new_path(spark, "store")
    tables = {name: empty_table(spark, name) for name in ("base", "oa", "customer_info")}
    store = TableStore.create(spark, root, tables)
    customers = log_of(spark, [(0, i, {"customer_id": c, "customer_name": f"n{i}"}) for i, c in enumerate((5, 3, 5))])
    codes = {"skin_type": 2, "is_allergy": 1, "skin_color": 5, "improve_type": 8}
    skin = log_of(spark, [(0, i, {"customer_id": c, **codes}) for i, c in enumerate((3, 9, 0))], "skin")
    staff = {"trace_staff_id": 1, "recom_staff_id": 2, "serve_staff_id": 3}
    staffs = log_of(spark, [(0, 0, {"customer_id_se": 3, **staff}), (0, 1, staff)], "staff")
    for job, log in (
        (jobs.customer_job("customers", "a"), customers),
        (jobs.skin_job("skin", "b"), skin),
        (jobs.staff_job("staff", "c"), staffs),
    ):
        path = scratch.write_once(log, "log")
        query = jobs.run_job(
            scan_log(spark, path, stream=True), root, job, scratch.new_path(spark, "cp"), available_now=True, preview=2
        )
        query.awaitTermination()
    assert rows_of(store.read("base"), "id", "customer_id", "name") == [(1, 5, "n2"), (2, 3, "n1")]
    assert rows_of(store.read("oa"), "base_id", "customer_id", "skin_type", "skin_color") == [
        (1, 5, None, None),
        (2, 3, "中性", "大麦色"),
    ]
    assert rows_of(store.read("customer_info")) == [(1, 3, 1, 2, 3), (2, 0, 1, 2, 3)]
    assert rows_of(store.read_notes("rejects_skin"), "customer_id", "reason") == [(9, "unknown_customer")]
    assert {r["groupid"]: r["untilOffset"] for r in store.read(LEDGER).collect()} == {"a": 3, "b": 3, "c": 2}


def test_batch_rewrites_only_its_buckets(spark):
    root = scratch.new_path(spark, "store")
    prior = table_of(spark, "customer_info", [{"id": i + 1, "customer_id": i} for i in range(200)])
    store = TableStore.create(spark, root, {"customer_info": prior}, buckets=64)
    job = jobs.staff_job("staff", "g")
    values = {"trace_staff_id": 7, "recom_staff_id": 8, "serve_staff_id": 9}
    log = log_of(spark, [(0, i, {"customer_id_se": c, **values}) for i, c in enumerate((17, 1000))])
    jobs.apply_batch(root, job, job.project(log), 0)
    now = store.current()
    rewritten = [b for b, slot in enumerate(now.slots["customer_info"]) if slot == 1]
    assert 1 <= len(rewritten) <= 2 and now.opened == {}
    valid, _ = p.split(job.project(log), p.STAFF_VALUES)
    assert rows_of(now.read("customer_info")) == rows_of(merge.upsert_staff(prior, valid))
    assert now.greatest["customer_info"] == 201

    # the same batch under a new number: the buckets go back to their first slot, no third copy is kept
    jobs.apply_batch(root, job, job.project(log), 1)
    assert rows_of(store.read("customer_info")) == rows_of(now.read("customer_info"))
    assert all(store.current().slots["customer_info"][b] == 0 for b in rewritten if now.slots["customer_info"][b] == 1 and b in rewritten[:1])
    folders = spark.read.format("binaryFile").load(f"{root}/tables/customer_info/*/*/*.parquet").select("path").collect()
    kept = {row["path"].split("/")[-3] + row["path"].split("/")[-2] for row in folders}
    assert len(kept) <= 64 + len(rewritten)


def test_empty_buckets_do_not_show_leftovers(spark):
    """A bucket that loses all its rows, and one that a failed attempt wrote to, stay empty."""
    root = scratch.new_path(spark, "store")
    store = TableStore.create(spark, root, {"order_status": table_of(spark, "order_status", [{"customer_id": 7, "order_id": 3}])}, buckets=8)
    one, two = (table_of(spark, "order_status", [{"customer_id": 7, "order_id": o}]) for o in (4, 9))
    for i, rows in enumerate((one, two, one, two)):
        store.publish(store.current(), "a", i, {"order_status": rows}, whole=True)
        assert rows_of(store.read("order_status"), "order_id") == [(rows.head()["order_id"],)]
    assert sum(slot != EMPTY for slot in store.current().slots["order_status"]) == 1


def test_notes_show_with_their_batch_and_are_counted(spark):
    root = scratch.new_path(spark, "store")
    store = TableStore.create(spark, root, {"order_status": empty_table(spark, "order_status")})
    job = jobs.order_job("orders", "g")
    projected = job.project(log_of(spark, _order_values(6, 40)))
    jobs.apply_batch(root, job, projected, 0)
    quarantined, rejected = store.read_notes("quarantine").count(), store.read_notes("rejects_orders").count()
    assert store.current().counts == {"orders": {"quarantined": quarantined, "rejected": rejected}} and quarantined and rejected
    # notes of an attempt that is not published
    store.write_notes("quarantine", "orders", 1, store.read_notes("quarantine").drop("job", "batch"))
    store.write_notes("quarantine", "others", 0, store.read_notes("quarantine").drop("job", "batch"))
    assert store.read_notes("quarantine").count() == quarantined


def test_customer_scope_moves_rows_between_buckets(spark):
    root = scratch.new_path(spark, "store")
    prior = table_of(spark, "order_status", [{"customer_id": 7, "order_id": o} for o in (3, 5, 9)])
    store = TableStore.create(spark, root, {"order_status": prior}, buckets=64)
    job = jobs.order_job("orders", "g", scope="customer")
    log = log_of(spark, [(0, 0, {"order_id": 3, "customer_id": 7, "submit_time": 1})])
    jobs.apply_batch(root, job, job.project(log), 0)
    assert rows_of(store.read("order_status"), "order_id") == [(3,), (3,), (3,)]
    assert store.current().greatest == {"order_status": 3}


def test_interval_stream_stops_between_batches(spark):
    path = scratch.write_once(log_of(spark, _order_values(4, 20)), "log")
    seen = []
    query = start(
        scan_log(spark, path, stream=True, max_files=1),
        lambda batch, batch_id: seen.append(batch.count()),
        scratch.new_path(spark, "cp"),
        seconds=1,
    )
    run_until(query, lambda: sum(seen) == 20)
    assert not query.isActive and query.exception() is None
    assert sum(seen) == 20


def test_resume_from_the_ledger(spark):
    log = log_of(spark, [(part, off, {"a": 1}) for part in range(3) for off in range(5)])
    stored = spark.createDataFrame(
        [("g", "t", 0, 5), ("g", "t", 1, 2), ("h", "t", 2, 4)], led.LEDGER_SCHEMA
    )
    want = [(1, 2), (1, 3), (1, 4), (2, 0), (2, 1), (2, 2), (2, 3), (2, 4)]
    assert rows_of(led.resume(log, stored, "g"), "partition", "offset") == want
    assert led.stored_offsets(stored, "g") == {"t": {0: 5, 1: 2}}
    assert starting_offsets(led.stored_offsets(stored, "g"), {"t": 3}) == '{"t": {"0": 5, "1": 2, "2": -2}}'
    assert starting_offsets({}, {"t": 3}) == "earliest"

    after = led.advance_ledger(stored, log.filter("partition < 2"), "g")
    assert rows_of(after) == [("g", "t", 0, 5), ("g", "t", 1, 5), ("h", "t", 2, 4)]
    assert rows_of(led.advance_ledger(stored, log.filter("false"), "g")) == rows_of(stored)


def _spoil(spark, path):
    """Put a file that is no parquet beside the others: whoever opens the folder fails."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part-spoilt.parquet")
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    stream.write(b"not parquet, and long enough to be read as a footer")
    stream.close()


def test_resumed_scan_opens_pending_ranges_only(spark):
    path = scratch.new_path(spark, "ranges")
    log = log_of(spark, [(part, off, {"a": off}) for part in range(3) for off in range(64)])
    write_ranges(log.filter("offset < 40"), path, bits=3)
    write_ranges(log.filter("offset >= 40"), path, bits=3)
    stored = {"t": {0: 64, 1: 21}, "other": {2: 7}}
    for done in ("partition=0/range=7", "partition=1/range=0", "partition=1/range=1"):
        _spoil(spark, f"{path}/topic=t/{done}")
    rows = scan_ranges(spark, path, stored, bits=3)
    want = [(1, off) for off in range(21, 64)] + [(2, off) for off in range(64)]
    assert rows_of(rows, "partition", "offset") == sorted(want, key=repr)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "range" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(Exception, match="spoilt"):
        scan_ranges(spark, path, {"t": {0: 60, 1: 21}}, bits=3).count()


def test_folders_of_a_laid_out_log_do_not_grow_with_it(spark, monkeypatch):
    monkeypatch.setattr("tidemark.sources.records.MOST_FOLDERS", 8, raising=False)
    path = scratch.new_path(spark, "ranges")
    log = log_of(spark, [(part, off, {"a": off}) for part in range(2) for off in range(0, 256, 2)])
    write_ranges(log.filter("offset < 200"), path, bits=2)
    write_ranges(log.filter("offset >= 200"), path, bits=2)
    folders = {name.rsplit("/", 1)[0] for name in scan_ranges(spark, path).inputFiles()}
    assert len(folders) <= 2 * (8 + 2)
    for starts in ({0: 0, 1: 3}, {0: 77, 1: 200}, {0: 198, 1: 255}, {0: 256, 1: 31}):
        rows = scan_ranges(spark, path, {"t": starts}, bits=2)
        want = [(part, off) for part in range(2) for off in range(0, 256, 2) if off >= starts[part]]
        assert rows_of(rows, "partition", "offset") == sorted(want, key=repr)
    done = [name for name in scan_ranges(spark, path).inputFiles() if "partition=0" in name]
    _spoil(spark, done[0].rsplit("/", 1)[0].removeprefix("file://"))
    assert scan_ranges(spark, path, {"t": {0: 256}}, bits=2).count() == 128


def test_customer_batch_opens_the_buckets_it_hits_only(spark):
    base = table_of(spark, "base", [{"id": i, "customer_id": i} for i in range(1, 60)])
    oa = table_of(spark, "oa", [{"base_id": i, "customer_id": 77 if i == 5 else i, "customer_grade": 0} for i in range(1, 60)])
    root = scratch.new_path(spark, "store")
    store = TableStore.create(spark, root, {"base": base, "oa": oa}, buckets=64)
    assert rows_of(store.read("strays")) == [(5, 77)]
    now = store.current()
    wanted = {r[0] for r in spark.createDataFrame([(5,), (77,)], "customer_id bigint").select(now.bucket("oa")).collect()}
    for bucket, slot in enumerate(now.slots["oa"]):
        if slot != EMPTY and bucket not in wanted:
            _spoil(spark, f"{root}/tables/oa/bucket={bucket}/slot={slot}")
    job = jobs.customer_job("customers", "a")
    jobs.apply_batch(root, job, job.project(log_of(spark, [(0, 0, {"customer_id": 5, "customer_grade": 9})])), 0)
    after = store.current()
    assert sorted(after.opened) == [] and sum(a != b for a, b in zip(now.slots["oa"], after.slots["oa"], strict=True)) == len(wanted)
    child = after.near("oa", spark.createDataFrame([(77,)], "customer_id bigint")).filter("base_id = 5")
    assert rows_of(child, "customer_id", "customer_grade") == [(77, 9)]


def test_bucketed_target_is_not_shuffled(spark):
    """Both sides too large to broadcast: the only exchanges are the batch's."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    prior = table_of(spark, "customer_info", [{"id": i + 1, "customer_id": i, "trace_staff_id": 0} for i in range(300)])
    try:
        bucketed.save(prior, "customer_info", "tidemark_staff", 4)
        target = bucketed.target(spark, "tidemark_staff")
        log = log_of(spark, [(0, i, {"customer_id_se": c, "trace_staff_id": 1, "recom_staff_id": 2, "serve_staff_id": 3}) for i, c in enumerate(range(200, 400))])
        events = p.split(p.project_staff(log), p.STAFF_VALUES)[0]
        latest = scratch.stage(keyed.latest_per_key(events, "customer_id"), "latest")
        for joined in (merge.overwrite(target, latest, "customer_id", ["trace_staff_id"]), merge.lookup(target, latest, "customer_id"), keyed.matching(target, latest, "customer_id")):
            plan = joined._jdf.queryExecution().sparkPlan().toString()
            assert "SortMergeJoin" in plan
            found = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
            assert found.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in found
        assert rows_of(merge.upsert_staff(target, events)) == rows_of(merge.upsert_staff(prior, events))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP TABLE IF EXISTS tidemark_staff")


def test_ledger_takes_the_source_ends(spark):
    """A silent partition and a gap at the end of another one: the batch cannot see either."""
    root = scratch.new_path(spark, "store")
    store = TableStore.create(spark, root, {"order_status": empty_table(spark, "order_status")})
    job = jobs.order_job("orders", "g")
    jobs.apply_batch(root, job, job.project(log_of(spark, _order_values(8, 12))), 0)
    before, tables = store.current(), rows_of(store.read("order_status"))
    listener = ends.SourceEnds(spark, root, "orders", "g", "orders-query")
    listener.record(['{"logOffset":3}', "17", None])
    assert store.current() == before
    listener.record(['{"t":{"0":10,"1":14,"2":9,"3":0}}'])
    assert rows_of(store.read(LEDGER)) == [("g", "t", 0, 10), ("g", "t", 1, 14), ("g", "t", 2, 12), ("g", "t", 3, 0)]
    now = store.current()
    assert now.batches == before.batches and now.counts == before.counts and rows_of(store.read("order_status")) == tables
    listener.record(['{"t":{"0":10,"1":14,"2":9,"3":0}}'])
    assert store.current() == now
    # the batch after it goes on from there
    jobs.apply_batch(root, job, job.project(log_of(spark, [(3, 0, {"order_id": 99, "customer_id": 1, "submit_time": 1})])), 1)
    assert led.stored_offsets(store.read(LEDGER), "g")["t"] == {0: 10, 1: 14, 2: 12, 3: 1}


def test_intake_cap_grows_with_partitions():
    options = topic_options("host:1", "t", 4)
    assert options["maxOffsetsPerTrigger"] == str(RECORDS_PER_SECOND * 5 * 4)
    assert options["startingOffsets"] == "earliest"


def test_table_scan_is_split_by_key():
    options = scan_options({"url": "jdbc:x"}, "t", key="id", lower=1, upper=1000, partitions=8)
    assert options["url"] == "jdbc:x" and options["dbtable"] == "t"
    assert (options["partitionColumn"], options["numPartitions"]) == ("id", "8")
    assert (options["lowerBound"], options["upperBound"]) == ("1", "1000")


def test_small_batch_does_not_shuffle_the_target(spark):
    """The target is streamed past a broadcast batch."""
    target = scratch.stage(
        spark.range(200_000).selectExpr("id", "id as customer_id", "1 as trace_staff_id", "2 as recom_staff_id", "3 as serve_staff_id"),
        "target",
    )
    latest = scratch.stage(spark.range(10).selectExpr("id as customer_id", "7 as trace_staff_id"), "latest")
    plan = merge.overwrite(target, latest, "customer_id", ["trace_staff_id"])._jdf.queryExecution().executedPlan()
    assert "BroadcastHashJoin" in plan.toString()
    assert "SortMergeJoin" not in plan.toString()


def test_stage_scope_drops_what_was_staged(spark):
    with scratch.stage_scope(spark):
        path = scratch.write_once(spark.range(3), "gone")
        assert spark.read.parquet(path).count() == 3
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def test_children_of_other_customers_are_updated_as_in_a_batch(spark):
    """A child goes by its parent's id, whatever customer it carries."""
    base = table_of(spark, "base", [{"id": i, "customer_id": i, "name": "old"} for i in range(1, 9)])
    owners = [None, 2, 99, 4, None, 17, 7, 8]
    oa = table_of(spark, "oa", [{"base_id": i, "customer_id": c, "customer_grade": 0} for i, c in enumerate(owners, start=1)])
    root = scratch.new_path(spark, "store")
    store = TableStore.create(spark, root, {"base": base, "oa": oa}, buckets=64)
    job = jobs.customer_job("customers", "a")
    projected = job.project(log_of(spark, [(0, i, {"customer_id": c, "customer_grade": 5}) for i, c in enumerate((1, 3, 5, 6, 2, 40))]))
    jobs.apply_batch(root, job, projected, 0)
    want = merge.linked_upsert(base, oa, p.split(projected, job.values)[0])
    assert rows_of(store.read("oa")) == rows_of(want[1])
    assert rows_of(store.read("base")) == rows_of(want[0])


def test_a_lost_checkpoint_resumes_from_the_ledger(spark):
    log = log_of(spark, _order_values(5, 60))
    root, path = scratch.new_path(spark, "store"), scratch.new_path(spark, "log")
    store = TableStore.create(spark, root, {"order_status": empty_table(spark, "order_status")})
    job = jobs.order_job("orders", "g")
    for part, name in ((log.filter("offset < 30"), "a"), (log.filter("offset >= 30"), "b")):
        part.write.mode("append").parquet(path)
        query = jobs.resume_job(scan_log(spark, path, stream=True), root, job, scratch.new_path(spark, name), available_now=True)
        query.awaitTermination()
    valid, _ = p.split(p.project_order(log), p.ORDER_VALUES)
    want, rejects = gate.gated_upsert(empty_table(spark, "order_status"), valid)
    assert rows_of(store.read("order_status")) == rows_of(want)
    assert store.current().version == 2
    assert sum(store.read_notes(f"rejects_{name}").count() for name in store.current().batches) == rejects.count()


def test_a_query_that_is_never_idle_stops_after_a_batch(spark):
    """Batches longer than the interval follow each other without a pause."""
    import time

    done = []

    def slow(batch, batch_id):
        batch.count()
        time.sleep(1.5)
        done.append(batch_id)

    rows = spark.readStream.format("rate").option("rowsPerSecond", 50).load()
    query = start(rows, slow, scratch.new_path(spark, "cp"), seconds=1)
    run_until(query, lambda: len(done) >= 2)
    seen = len(done)
    assert not query.isActive and seen <= 4
    time.sleep(2)
    assert len(done) == seen


def test_a_second_writer_of_the_same_version_fails(spark):
    root = scratch.new_path(spark, "store")
    store = TableStore.create(spark, root, {"order_status": empty_table(spark, "order_status")})
    now = store.current()
    one = table_of(spark, "order_status", [{"customer_id": 1, "order_id": 1}])
    now.open("order_status", one)
    store.publish(now, "a", 0, {"order_status": one})
    with pytest.raises(RuntimeError):
        store.publish(now, "b", 0, {"order_status": table_of(spark, "order_status", [{"customer_id": 2, "order_id": 1}])})
    assert rows_of(store.read("order_status"), "customer_id") == [(1,)]
