"""Logs from Python values, and the write rules as plain sequential loops to compare with."""

import json

from tidemark.sources.records import RECORD_SCHEMA
from tidemark.sources.tables import TABLES, table_schema


def log_of(spark, values, topic="t"):
    """Records for (partition, offset, value); a value that is no text becomes an envelope."""
    rows = [
        ("k", v if v is None or isinstance(v, str) else json.dumps({"data": [v]}), topic, part, off, None)
        for part, off, v in values
    ]
    return spark.createDataFrame(rows, RECORD_SCHEMA)


def table_of(spark, name, rows):
    """A table from dicts; columns a dict lacks are null."""
    return spark.createDataFrame([tuple(row.get(c) for c in TABLES[name]) for row in rows], table_schema(name))


def rows_of(frame, *columns):
    columns = columns or frame.columns
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def in_order(events):
    return sorted(events, key=lambda e: (e["offset"], e["partition"]))


def upsert_loop(target, events, columns):
    table = [dict(row) for row in target]
    for event in in_order(events):
        hits = [row for row in table if row["customer_id"] == event["customer_id"]]
        if not hits:
            hits = [{"id": max((r["id"] for r in table), default=0) + 1, "customer_id": event["customer_id"]}]
            table += hits
        for row in hits:
            row.update({c: event[c] for c in columns})
    return table


def linked_loop(base, oa, events, base_columns, oa_columns):
    base, oa = [dict(r) for r in base], [dict(r) for r in oa]
    for event in in_order(events):
        hits = [r for r in base if r["customer_id"] == event["customer_id"]]
        if hits:
            parent = min(r["id"] for r in hits)
            for row in hits:
                row.update({c: event[c] for c in base_columns})
            for row in oa:
                if row["base_id"] == parent:
                    row.update({c: event[c] for c in oa_columns})
        else:
            parent = max((r["id"] for r in base), default=0) + 1
            base.append({"id": parent, "customer_id": event["customer_id"], **{c: event[c] for c in base_columns}})
            oa.append(
                {"base_id": parent, "customer_id": event["customer_id"], **{c: event[c] for c in oa_columns}}
            )
    return base, oa


def partial_loop(base, oa, events, columns):
    oa, rejects = [dict(r) for r in oa], []
    for event in in_order(events):
        if event["customer_id"] == 0:
            continue
        if not any(r["customer_id"] == event["customer_id"] for r in base):
            rejects.append((event["offset"], event["partition"]))
            continue
        for row in oa:
            if row["customer_id"] == event["customer_id"]:
                row.update({c: event[c] for c in columns})
    return oa, rejects


def gate_loop(orders, events, columns):
    table, rejects = [dict(r) for r in orders], []
    for event in in_order(events):
        hits = [r for r in table if r["order_id"] == event["order_id"]]
        if hits:
            for row in hits:
                row.update({c: event[c] for c in columns})
        elif event["order_id"] > max((r["order_id"] for r in table), default=0):
            table.append({c: event[c] for c in ("customer_id", "order_id", *columns)})
        else:
            rejects.append((event["offset"], event["partition"]))
    return table, rejects
