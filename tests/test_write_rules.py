"""Write rules against sequential loops, over random logs with random prior tables and a hot key."""

import random

import pytest
from helpers import gate_loop, in_order, linked_loop, partial_loop, rows_of, table_of, upsert_loop

from tidemark.operators import gate, keyed, merge, replay
from tidemark.operators import project as p
from tidemark.sources.tables import BASE_COLUMNS, OA_COLUMNS, ORDER_COLUMNS, SKIN_COLUMNS, STAFF_COLUMNS, TABLES

KINDS = {name: kind for columns in TABLES.values() for name, kind in columns.items()}


def _value(rng, name):
    if rng.random() < 0.2:
        return None
    if KINDS[name] == "string":
        return rng.choice("abcdef")
    return rng.randrange(50)


def _events(rng, count, key, keys, columns, **extra):
    """Unique places over three partitions, out of order; a third of the events on one key."""
    places = rng.sample([(off, part) for off in range(count) for part in range(3)], count)
    hot = keys[len(keys) // 2]
    return [
        {
            "offset": off * 40_000,
            "partition": part,
            key: hot if rng.random() < 0.33 else rng.choice(keys),
            **{c: _value(rng, c) for c in columns},
            **{name: make(rng) for name, make in extra.items()},
        }
        for off, part in places
    ]


def _frame(spark, events, values):
    kinds = {"offset": "bigint", "partition": "int"} | {v: KINDS[v] for v in values}
    schema = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items() if "decimal" not in kind)
    decimals = [name for name, kind in kinds.items() if "decimal" in kind]
    schema += "".join(f", `{name}` int" for name in decimals)
    names = [name for name in kinds if name not in decimals] + decimals
    frame = spark.createDataFrame([tuple(e[n] for n in names) for e in events], schema)
    return frame.select(*[frame[n].cast(k).alias(n) for n, k in kinds.items()]).repartition(3)


def _rows(dicts, columns):
    return sorted((tuple(d.get(c) for c in columns) for d in dicts), key=repr)


def _plain(rows):
    return sorted((tuple(int(v) if hasattr(v, "as_tuple") else v for v in row) for row in rows), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_upsert(spark, seed):
    rng = random.Random(seed)
    events = _events(rng, 60, "customer_id", list(range(12)), STAFF_COLUMNS)
    prior = [
        {"id": 5 + i, "customer_id": c, **{n: _value(rng, n) for n in STAFF_COLUMNS}}
        for i, c in enumerate(rng.sample(range(16), 5 if seed else 0))
    ]
    got = merge.upsert_staff(table_of(spark, "customer_info", prior), _frame(spark, events, p.STAFF_VALUES))
    assert rows_of(got) == _rows(upsert_loop(prior, events, STAFF_COLUMNS), got.columns)


@pytest.mark.parametrize("seed", range(3))
def test_linked_upsert(spark, seed):
    rng = random.Random(100 + seed)
    columns = [*BASE_COLUMNS, *OA_COLUMNS]
    events = _events(rng, 50, "customer_id", list(range(12)), columns)
    known = rng.sample(range(16), 6) if seed else []
    base = [
        {"id": 3 * i + 4, "customer_id": c, **{n: _value(rng, n) for n in BASE_COLUMNS}} for i, c in enumerate(known)
    ]
    base += [{**row, "id": row["id"] + 100} for row in base[:1]]  # a repeated parent
    oa = [
        {"base_id": r["id"], "customer_id": r["customer_id"], **{n: _value(rng, n) for n in SKIN_COLUMNS}}
        for r in base
        if rng.random() < 0.6
    ]
    got = merge.linked_upsert(
        table_of(spark, "base", base), table_of(spark, "oa", oa), _frame(spark, events, p.CUSTOMER_VALUES)
    )
    want = linked_loop(base, oa, events, BASE_COLUMNS, OA_COLUMNS)
    assert _plain(rows_of(got[0])) == _rows(want[0], got[0].columns)
    assert _plain(rows_of(got[1])) == _rows(want[1], got[1].columns)


@pytest.mark.parametrize("seed", range(2))
def test_partial_update(spark, seed):
    rng = random.Random(200 + seed)
    events = _events(rng, 40, "customer_id", list(range(10)), SKIN_COLUMNS)
    known = rng.sample(range(14), 7)
    base = [{"id": i + 1, "customer_id": c} for i, c in enumerate(known)]
    oa = [
        {"base_id": r["id"], "customer_id": r["customer_id"], "total_cash": None, "skin_type": "old"}
        for r in base
        if rng.random() < 0.7
    ]
    oa += oa[:1]  # two children of one customer
    got, rejects = merge.partial_update(
        table_of(spark, "base", base), table_of(spark, "oa", oa), _frame(spark, events, p.SKIN_VALUES)
    )
    want, refused = partial_loop(base, oa, events, SKIN_COLUMNS)
    assert rows_of(got) == _rows(want, got.columns)
    assert rows_of(rejects, "offset", "partition") == sorted(refused, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_gated_upsert(spark, seed):
    rng = random.Random(300 + seed)
    ids = list(range(25)) if seed != 3 else list(range(-8, 8))
    events = _events(rng, 60, "order_id", ids, ORDER_COLUMNS, customer_id=lambda r: r.randrange(5))
    prior = [
        {"customer_id": 1, "order_id": o, **{n: _value(rng, n) for n in ORDER_COLUMNS}}
        for o in (rng.sample(range(10), 3) if seed else [])
    ]
    if seed == 3:
        prior = [{"customer_id": 1, "order_id": -6, "status": "old"}]
    got, rejects = gate.gated_upsert(table_of(spark, "order_status", prior), _frame(spark, events, p.ORDER_VALUES))
    want, refused = gate_loop(prior, events, ORDER_COLUMNS)
    assert rows_of(got) == _rows(want, got.columns)
    assert rows_of(rejects, "offset", "partition") == sorted(refused, key=repr)


@pytest.mark.parametrize("fold", ["max", "sum"])
def test_prefix_over_many_chunks_and_groups(spark, fold):
    """Small chunks force all three levels; offsets lie far apart and ties are broken by partition."""
    rng = random.Random(7)
    places = sorted({(rng.randrange(40) << rng.choice([0, 4, 14, 20, 30]), rng.randrange(3)) for _ in range(300)})
    values = [rng.randrange(-100, 100) for _ in places]
    frame = spark.createDataFrame(
        [(off, part, v) for (off, part), v in zip(places, values, strict=True)],
        "offset bigint, partition int, v bigint",
    )
    rows = frame.withColumn("first_ord", keyed.log_order()).repartition(5)
    got = {(r["offset"], r["partition"]): r["before"] for r in keyed.before(rows, rows["v"], fold, 2).collect()}
    pick = max if fold == "max" else sum
    for i, place in enumerate(places):
        assert got[place] == (pick(values[:i]) if i else None)


def _scope_loop(orders, events):
    """The literal rule, event by event."""
    table = [dict(r) for r in orders]
    for event in in_order(events):
        if any(r["order_id"] == event["order_id"] for r in table):
            for row in table:
                if row["customer_id"] == event["customer_id"]:
                    row.update({c: event[c] for c in ("order_id", *ORDER_COLUMNS)})
        elif event["order_id"] > max((r["order_id"] for r in table), default=0):
            table.append({c: event[c] for c in ("customer_id", "order_id", *ORDER_COLUMNS)})
    return table


def _scope_case(rng, count):
    """Few customers and ids, so that updates erase ids, others' too, and the greatest id falls; a third of the events is one customer's."""
    customers, ids = list(range(1, 7)), list(range(0, 14))
    prior = [{"customer_id": rng.choice([*customers, 50, None]), "order_id": rng.choice(ids), "status": "old"} for _ in range(rng.randrange(0, 9))]
    places = rng.sample([(off, part) for off in range(count) for part in range(3)], count)
    events = []
    for i, (off, part) in enumerate(places):
        customer = 3 if rng.random() < 0.33 else rng.choice(customers)
        order = rng.choice(ids) if rng.random() < 0.6 else rng.randrange(30)
        events.append({"offset": off, "partition": part, "customer_id": customer, "order_id": order, **{c: _value(rng, c) for c in ORDER_COLUMNS}, "submit_time": i})
    return prior, events


def _scope_rejects(orders, events):
    """Places of the events that the loop rejects."""
    out = []
    for i, event in enumerate(in_order(events)):
        before = _scope_loop(orders, in_order(events)[:i])
        known = any(r["order_id"] == event["order_id"] for r in before)
        if not known and event["order_id"] <= max((r["order_id"] for r in before), default=0):
            out.append((event["offset"], event["partition"]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_customer_scope_equals_the_loop(spark, seed, monkeypatch):
    """Ids erased within the batch and a falling maximum included; small ranges of positions force all levels."""
    monkeypatch.setattr(replay, "CHUNK_BITS", 2 if seed % 2 else 16)
    monkeypatch.setattr(replay, "RANGE_BITS", 2 if seed % 2 else 10)
    rng = random.Random(seed)
    prior, events = _scope_case(rng, 60)
    orders = table_of(spark, "order_status", prior)
    got, rejects = gate.gated_upsert(orders, _frame(spark, events, p.ORDER_VALUES), scope="customer")
    assert rows_of(got) == _rows(_scope_loop(prior, events), orders.columns)
    assert rows_of(rejects, "offset", "partition") == _scope_rejects(prior, events)


def test_customer_scope_does_not_depend_on_the_cuts(spark):
    rng = random.Random(77)
    prior, events = _scope_case(rng, 30)
    orders = table_of(spark, "order_status", prior)
    for i in range(3):
        part = [e for e in events if e["offset"] // 10 == i]
        orders = gate.gated_upsert(orders, _frame(spark, part, p.ORDER_VALUES), scope="customer")[0]
    assert rows_of(orders) == _rows(_scope_loop(prior, events), orders.columns)


@pytest.mark.parametrize("bits", [2, 10])
def test_greatest_held_equals_a_scan(spark, bits, monkeypatch):
    monkeypatch.setattr(replay, "RANGE_BITS", bits)
    rng = random.Random(3)
    held = [(rng.randrange(100), b, rng.choice([None, b + rng.randrange(0, 40)])) for b in (rng.randrange(0, 70) for _ in range(60))]
    asked = [(q, rng.randrange(100)) for q in range(1, 101)]
    frames = spark.createDataFrame(asked, "pos bigint, order_id bigint"), spark.createDataFrame(held, "order_id bigint, begin bigint, end bigint")
    got = dict(replay.greatest_held(*frames, 100).collect())
    for q, order in asked:
        inside = [o for o, b, e in held if b < q and (e is None or q <= e)]
        found = got.get(q)
        assert found == (max(inside) if inside else None) or found in inside and found >= order


def test_customer_scope_updates_rows_of_the_same_batch(spark):
    """Customer 7 has order 3; order 12 comes and is then signed: both rows become order 12, however the log is cut."""
    orders = table_of(spark, "order_status", [{"customer_id": 7, "order_id": 3}])
    events = [
        {"offset": i, "partition": 0, "customer_id": 7, "order_id": 12, "submit_time": i, "ship_time": 0, "sign_time": 0, "status": "x"} for i in range(2)
    ]
    whole = gate.gated_upsert(orders, _frame(spark, events, p.ORDER_VALUES), scope="customer")[0]
    cut = orders
    for event in events:
        cut = gate.gated_upsert(cut, _frame(spark, [event], p.ORDER_VALUES), scope="customer")[0]
    assert rows_of(whole) == rows_of(cut) == [(7, 12, 1, 0, 0, "x")] * 2


def test_customer_scope(spark):
    orders = table_of(
        spark,
        "order_status",
        [{"customer_id": 7, "order_id": 3}, {"customer_id": 7, "order_id": 5}, {"customer_id": 8, "order_id": 6}],
    )
    columns = ("offset", "partition", "customer_id", "order_id", "submit_time", "ship_time", "sign_time", "status")
    events = spark.createDataFrame(
        [(0, 0, 7, 3, 11, 12, 13, "new")], ", ".join(f"`{c}` {KINDS.get(c, 'int')}" for c in columns)
    )
    got, rejects = gate.gated_upsert(orders, events, scope="customer")
    assert rows_of(got) == [
        (7, 3, 11, 12, 13, "new"),
        (7, 3, 11, 12, 13, "new"),
        (8, 6, None, None, None, None),
    ]
    assert rejects.count() == 0


def test_gate_examples(spark):
    """Table at 10: 12, 11, 15, 12 again; and an empty table, which refuses 0."""
    schema = ", ".join(f"`{c}` {KINDS.get(c, 'int')}" for c in ("offset", "partition", *p.ORDER_VALUES))
    ten = table_of(spark, "order_status", [{"customer_id": 1, "order_id": 10}])
    events = spark.createDataFrame(
        [(i, 0, 1, o, i, 0, 0, " ") for i, o in enumerate([12, 11, 15, 12])], schema
    )
    decided = gate.decide_orders(ten, events)
    assert rows_of(gate.gate(events, decided), "offset", "order_id", "action") == [
        (0, 12, "I"),
        (1, 11, "R"),
        (2, 15, "I"),
        (3, 12, "U"),
    ]
    empty = table_of(spark, "order_status", [])
    events = spark.createDataFrame([(0, 0, 1, 0, 0, 0, 0, " "), (1, 0, 1, 1, 0, 0, 0, " ")], schema)
    got, rejects = gate.gated_upsert(empty, events)
    assert rows_of(got, "order_id") == [(1,)]
    assert rows_of(rejects, "order_id") == [(0,)]


def test_the_greatest_held_id_is_found_with_few_comparisons_to_an_event(spark):
    rng = random.Random(4)
    last = 400
    spans = [(rng.randrange(1000), begin, rng.choice([None, min(last, begin + rng.randrange(1, 150))])) for begin in [0] * 3 + rng.sample(range(1, last), 120)]
    asked = [(pos, rng.randrange(1000)) for pos in range(1, last + 1)]
    held = spark.createDataFrame(spans, "order_id bigint, begin bigint, end bigint")
    found = {r["pos"]: r["held"] for r in replay.greatest_held(spark.createDataFrame(asked, "pos bigint, order_id bigint"), held, last).collect()}
    for pos, order in asked:
        ids = [i for i, begin, end in spans if (begin < pos or begin == 0) and (end is None or pos <= end)]
        # a smaller id will do where it is above the event's already
        assert (order > found.get(pos, 0)) == (order > max(ids, default=0))
        assert pos not in found or found[pos] in ids
    assert 1 << replay.RANGE_BITS <= 64  # spans that begin or end in an event's range: two a position
