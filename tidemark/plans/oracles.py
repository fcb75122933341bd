"""The same queries as plain SQL over the driver tables, without the JSON round trip."""

from __future__ import annotations

GROUP = "profile"

SKIN_NAMES = ("skin_type", "is_allergy", "skin_color", "improve_type")


# Fixed values of the code lists, written out so that a wrong one in the engine shows.
SKIN_TYPES = ("", "中性", "干性", "混合性", "油性")
ALLERGIES = ("", "从不", "偶尔", "易过敏")
SKIN_COLORS = ("", "白皙", "粉嫩", "暗黄", "大麦色")
IMPROVEMENTS = (
    "", "敏感/脆弱", "黑头粉刺/毛孔粗大/皮肤粗糙", "痘痘", "细纹/皮肤松弛", "暗黄/色斑", "黑眼圈/轻度眼袋/脂肪粒", "严重眼袋/眼纹",
)
SUBMITTED, SHIPPED, SIGNED = "已提交", "已发货", "已签收"


def _label(code: str, texts: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{text}'" for i, text in enumerate(texts, start=1))
    return f"CASE ({code}) {cases} END"


def _skin_code(codes: int) -> str:
    return f"CASE WHEN c_custkey = 0 THEN 2 ELSE c_custkey % {codes} END"


def _status(sign: str, ship: str, submit: str) -> str:
    return (
        f"CASE WHEN {sign} = 0 THEN ' ' WHEN {ship} = 0 THEN '{SUBMITTED}' "
        f"WHEN {submit} = 0 THEN '{SHIPPED}' ELSE '{SIGNED}' END"
    )


def _with(names: list[str], body: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in names) + "\n" + body


_SHANGHAI = 8 * 3600


def _midnight(clock: str) -> str:
    return f"(CAST(epoch(date_trunc('day', {clock})) AS BIGINT) - {_SHANGHAI})"


CTES = {
    # customer events
    "customer_raw": """
        SELECT c.*, c_custkey AS k, rev,
            CASE WHEN c_custkey % 11 <> 0
                THEN '1980-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') END AS born,
            '1980-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS day
        FROM customer c CROSS JOIN (VALUES (0), (1)) r(rev)""",
    "customer_events": """
        SELECT 2 * k + rev AS "offset", CAST(k % 4 AS INTEGER) AS "partition", k AS customer_id, c_name AS name,
            CAST(CASE (k + rev) % 5 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS INTEGER) AS gender,
            CASE WHEN born IS NULL THEN '' WHEN (k + rev) % 7 IN (0, 2, 3) THEN born ELSE ' ' END AS birthday,
            CASE WHEN born IS NULL OR (k + rev) % 7 IN (0, 2, 3) THEN ' '
                WHEN (k + rev) % 7 IN (1, 4) THEN born ELSE '' END AS luna_birthday,
            CAST(c_nationkey AS INTEGER) AS province,
            CAST(CASE WHEN rev = 1 THEN c_nationkey * 100 + 1 ELSE 0 END AS INTEGER) AS city,
            CASE WHEN k % 5 <> 0 THEN c_mktsegment END AS district,
            13000000000 + k AS handset,
            CASE WHEN rev = 0 THEN 13100000000 + k ELSE 0 END AS handset2,
            CASE WHEN k % 4 <> 0 THEN k * 10 ELSE 0 END AS qq_code,
            'T' || k AS ty_code,
            CAST(CAST(c_acctbal AS DECIMAL(38, 10)) AS DOUBLE) AS total_cash,
            CAST(k % 6 AS INTEGER) AS customer_grade,
            CAST(CASE WHEN k % 2 = 0 THEN k % 3 ELSE 0 END AS INTEGER) AS customer_type,
            CAST((k + rev) % 9 AS INTEGER) AS customer_source,
            CAST((k % 9 + 1) * 1000 + k % 1000 AS DOUBLE) + 0.25 AS total_score,
            CAST(CASE WHEN rev = 0 THEN k % 50 END AS DOUBLE) AS lock_score,
            CAST(k % 100 AS DOUBLE) AS used_score,
            CAST(CASE WHEN k % 3 <> 0 THEN k % 77 + rev END AS DOUBLE) AS can_use_score,
            CASE WHEN k % 3 <> 0 THEN '2020-03-23' ELSE ' ' END AS traced_at,
            CASE WHEN rev = 1 THEN '2020-04-01' ELSE ' ' END AS locked_at,
            CASE WHEN k % 13 <> 0 THEN day ELSE ' ' END AS first_sale_date
        FROM customer_raw""",
    "customer_latest": """
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY "offset" DESC, "partition" DESC) AS rn,
            min("offset") OVER (PARTITION BY customer_id) AS first_offset
        FROM customer_events QUALIFY rn = 1""",
    "base": """
        SELECT c_custkey * 3 + 10 AS id, c_custkey AS customer_id, 'old ' || c_name AS name
        FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "oa": """
        SELECT c_custkey * 3 + 10 AS base_id, c_custkey AS customer_id
        FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal >= 0""",
    # skin events
    "skin_events": f"""
        SELECT c_custkey AS "offset", CAST(c_custkey % 3 AS INTEGER) AS "partition", c_custkey AS customer_id,
            {_label(_skin_code(6), SKIN_TYPES)} AS skin_type,
            {_label(_skin_code(5), ALLERGIES)} AS is_allergy,
            {_label(_skin_code(6), SKIN_COLORS)} AS skin_color,
            {_label(_skin_code(9), IMPROVEMENTS)} AS improve_type
        FROM customer
        WHERE c_custkey = 0
            OR c_custkey % 6 BETWEEN 1 AND 5 AND c_custkey % 5 BETWEEN 1 AND 4 AND c_custkey % 9 BETWEEN 1 AND 8""",
    # staff events
    "staff_events": """
        SELECT event_id // 4 AS "offset", CAST(event_id % 4 AS INTEGER) AS "partition",
            CASE WHEN user_id = 5 THEN 0 ELSE user_id END AS customer_id,
            CAST(event_id % 1000 AS INTEGER) AS trace_staff_id,
            CAST((event_id * 7) % 1000 AS INTEGER) AS recom_staff_id,
            CAST((event_id * 3) % 500 AS INTEGER) AS serve_staff_id
        FROM events WHERE event_id % 13 <> 0""",
    "staff_latest": """
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY "offset" DESC, "partition" DESC) AS rn,
            first_value("offset") OVER forward AS first_offset,
            first_value("partition") OVER forward AS first_partition
        FROM staff_events
        WINDOW forward AS (PARTITION BY customer_id ORDER BY "offset", "partition")
        QUALIFY rn = 1""",
    "staff": """
        SELECT c_custkey + 100 AS id, c_custkey AS customer_id
        FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "staff_ids": """
        SELECT customer_id, (SELECT max(id) FROM staff)
            + row_number() OVER (ORDER BY first_offset, first_partition) AS id
        FROM staff_latest ANTI JOIN staff USING (customer_id)""",
    # order events
    "order_raw": """
        SELECT o.*, first_ship, last_ship, rev, o_orderkey AS k,
            2 * (o_orderkey + (o_orderkey * 7919) % 50 + rev * 200) + rev AS "offset",
            CAST(o_orderkey % 50 AS INTEGER) AS "partition"
        FROM orders o
        LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
            FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey
        JOIN (VALUES (0), (1)) r(rev) ON rev = 0 OR o_orderstatus = 'F'""",
    "order_times": f"""
        SELECT "offset", "partition", o_custkey AS customer_id, k AS order_id,
            CAST(CASE WHEN k % 17 = 0 THEN 0 ELSE epoch(o_orderdate) + rev * 3600 END AS INTEGER) AS submit_time,
            CAST(CASE WHEN o_orderstatus = 'O' OR first_ship IS NULL THEN 0
                ELSE {_midnight("first_ship")} END AS INTEGER) AS ship_time,
            CAST(CASE WHEN o_orderstatus = 'P' OR k % 6 = 0 OR last_ship IS NULL THEN 0
                WHEN k % 2 = 0 THEN {_midnight("last_ship")}
                ELSE {_midnight("last_ship + INTERVAL 25 HOUR")} END AS INTEGER) AS sign_time
        FROM order_raw""",
    "order_events": f"""
        SELECT *, {_status("sign_time", "ship_time", "submit_time")} AS status FROM order_times""",
    "order_status": """
        SELECT o_custkey AS customer_id, o_orderkey AS order_id, CAST(1 AS INTEGER) AS submit_time,
            CAST(0 AS INTEGER) AS ship_time, CAST(0 AS INTEGER) AS sign_time, 'old' AS status
        FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
            AND o_orderkey * 10 <= (SELECT max(o_orderkey) FROM orders)""",
    "no_orders": "SELECT * FROM order_status WHERE false",
}


def _gate(table: str) -> list[str]:
    """Names of the CTEs that replay the order rule event by event against ``table``."""
    CTES[f"seen_{table}"] = f"""
        SELECT *, greatest((SELECT coalesce(max(order_id), 0) FROM {table}),
                max(order_id) OVER (ORDER BY "offset", "partition"
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS high_water,
            row_number() OVER (PARTITION BY order_id ORDER BY "offset", "partition") AS nth,
            row_number() OVER (PARTITION BY order_id ORDER BY "offset" DESC, "partition" DESC) AS nth_last
        FROM order_events"""
    CTES[f"taken_{table}"] = f"SELECT order_id FROM seen_{table} WHERE nth = 1 AND order_id > high_water"
    CTES[f"gated_{table}"] = f"""
        SELECT e.*, CASE WHEN order_id IN (SELECT order_id FROM {table}) THEN 'U'
            WHEN order_id NOT IN (SELECT order_id FROM taken_{table}) THEN 'R'
            WHEN nth = 1 THEN 'I' ELSE 'U' END AS action
        FROM seen_{table} e"""
    prior = ["order_status"] if table == "order_status" else ["order_status", table]
    return ["order_raw", "order_times", "order_events", *prior, f"seen_{table}", f"taken_{table}", f"gated_{table}"]


_GATED = _gate("order_status")
_GATED_EMPTY = _gate("no_orders")


def _orders_after(table: str) -> str:
    return f"""
        SELECT coalesce(t.customer_id, f.customer_id) AS customer_id, coalesce(t.order_id, l.order_id) AS order_id,
            coalesce(l.submit_time, t.submit_time) AS submit_time, coalesce(l.ship_time, t.ship_time) AS ship_time,
            coalesce(l.sign_time, t.sign_time) AS sign_time, coalesce(l.status, t.status) AS status
        FROM {table} t
        FULL JOIN (SELECT * FROM gated_{table} WHERE nth_last = 1 AND action <> 'R') l ON l.order_id = t.order_id
        LEFT JOIN (SELECT * FROM gated_{table} WHERE nth = 1) f ON f.order_id = l.order_id"""


_CUSTOMER_BASE = [
    "gender", "birthday", "luna_birthday", "province", "city", "district", "handset", "handset2", "qq_code", "ty_code",
]
_CUSTOMER_OA = [
    "total_cash", "customer_grade", "customer_type", "customer_source", "total_score", "lock_score", "used_score",
    "can_use_score", "traced_at", "locked_at", "first_sale_date",
]

_LINKED = ["customer_raw", "customer_events", "customer_latest", "base"]

CTES["linked"] = """
    SELECT e.*, b.id AS known_id, CASE WHEN b.id IS NULL THEN (SELECT max(id) FROM base)
        + row_number() OVER (PARTITION BY b.id IS NULL ORDER BY first_offset) ELSE b.id END AS id
    FROM customer_latest e LEFT JOIN base b USING (customer_id)"""

_DIRTY = """
    SELECT CAST(event_id AS VARCHAR) AS "key", event_id, user_id, event_id // 4 AS "offset",
        CAST(event_id % 4 AS INTEGER) AS "partition", event_id % 15 AS kind FROM events"""

_LEDGER_PARTS = """
    SELECT 'order' AS topic, "partition", max("offset") AS last, max(max("partition")) OVER () AS newest
    FROM order_raw GROUP BY "partition" """

CTES["dirty"] = _DIRTY
CTES["ledger_parts"] = _LEDGER_PARTS
CTES["ledger"] = f"""
    SELECT '{GROUP}' AS groupid, topic, "partition", last // 2 AS "untilOffset"
    FROM ledger_parts WHERE "partition" < newest
    UNION ALL
    SELECT 'other', topic, "partition", 1 FROM ledger_parts WHERE "partition" < newest"""
_LEDGER = ["order_raw", "ledger_parts", "ledger"]

_SKIN_KNOWN = ["skin_events", "base"]


def _skin_columns(table: str) -> str:
    return ", ".join(f"{table}.{name}" for name in SKIN_NAMES)


_REJECTS = """SELECT order_id AS "key", "partition", "offset", 'below_high_water' AS reason
    FROM gated_order_status WHERE action = 'R'
    UNION ALL
    SELECT customer_id, "partition", "offset", 'unknown_customer'
    FROM skin_events ANTI JOIN base USING (customer_id) WHERE customer_id <> 0"""

_QUARANTINE = """SELECT "key", "partition", "offset", CASE WHEN kind < 6 OR kind IN (12, 13) THEN 'not_object'
        WHEN kind < 8 THEN 'bad_envelope' WHEN kind = 8 THEN 'bad_value' ELSE 'null_key' END AS reason
    FROM dirty WHERE kind <= 9 OR kind IN (12, 13)"""

ORACLES: dict[str, str] = {
    "scan_records": """
        SELECT CAST(c_custkey AS VARCHAR) AS "key", 'customer' AS topic, CAST(c_custkey % 4 AS INTEGER) AS "partition",
            2 * c_custkey + rev AS "offset", c_custkey AS customer_id
        FROM customer CROSS JOIN (VALUES (0), (1)) r(rev)""",
    "resume_plan": _with(
        _LEDGER,
        f"""SELECT p.topic, p."partition", coalesce(l."untilOffset", -2) AS start
        FROM ledger_parts p LEFT JOIN ledger l
            ON l.groupid = '{GROUP}' AND l.topic = p.topic AND l."partition" = p."partition" """,
    ),
    "resume_scan": _with(
        _LEDGER,
        f"""SELECT CAST(k AS VARCHAR) AS "key", r."partition", r."offset" FROM order_raw r
        LEFT JOIN ledger l ON l.groupid = '{GROUP}' AND l."partition" = r."partition"
        WHERE r."offset" >= coalesce(l."untilOffset", 0)""",
    ),
    "offset_lookup": _with(
        _LEDGER, f"""SELECT topic, "partition", "untilOffset" FROM ledger WHERE groupid = '{GROUP}'"""
    ),
    "offset_ledger": _with(
        _LEDGER,
        f"""SELECT '{GROUP}' AS groupid, topic, "partition", last + 1 AS "untilOffset" FROM ledger_parts
        UNION ALL SELECT * FROM ledger WHERE groupid <> '{GROUP}'""",
    ),
    "valid_objects": _with(["dirty"], """SELECT "key", "partition", "offset" FROM dirty WHERE kind BETWEEN 6 AND 11 OR kind = 14"""),
    "first_image": _with(
        ["dirty"],
        """SELECT "key", "partition", "offset", CAST(user_id AS VARCHAR) AS customer_id,
            CASE WHEN kind <> 9 THEN CAST(event_id AS VARCHAR) END AS order_id,
            CASE WHEN kind = 8 THEN 'x' ELSE CAST(event_id + 1 AS VARCHAR) END AS submit_time,
            'number' AS customer_id_kind, CASE WHEN kind <> 9 THEN 'number' END AS order_id_kind,
            CASE WHEN kind = 8 THEN 'text' ELSE 'number' END AS submit_time_kind
        FROM dirty WHERE kind BETWEEN 8 AND 11 OR kind = 14""",
    ),
    "quarantine_reasons": _with(["dirty"], _QUARANTINE),
    "project_customer": _with(["customer_raw", "customer_events"], "SELECT * FROM customer_events"),
    "project_skin": _with(["skin_events"], "SELECT * FROM skin_events"),
    "project_staff": _with(["staff_events"], "SELECT * FROM staff_events"),
    "project_order": _with(["order_raw", "order_times", "order_events"], "SELECT * FROM order_events"),
    "nonzero_key": _with(["skin_events"], "SELECT * FROM skin_events WHERE customer_id <> 0"),
    "coerce_types": """
        SELECT event_id,
            CASE WHEN kind <> 13 THEN whole END AS as_long,
            CASE WHEN kind IN (1, 2, 7) THEN 0 WHEN kind <> 13 THEN whole END AS as_long_or_zero,
            CAST(CASE WHEN kind NOT IN (6, 14) THEN whole END AS INTEGER) AS as_int,
            CAST(CASE WHEN kind IN (1, 2, 7) THEN 0 WHEN kind NOT IN (6, 14) THEN whole END AS INTEGER) AS as_int_or_zero,
            CASE kind WHEN 4 THEN CAST(event_id || '.5' AS DOUBLE) WHEN 10 THEN CAST(event_id || '.123456' AS DOUBLE)
                WHEN 11 THEN event_id + 0.75e0 WHEN 12 THEN -0.5e0 - event_id % 1000 WHEN 14 THEN whole + 0.5e0
                WHEN 13 THEN NULL ELSE CAST(whole AS DOUBLE) END AS as_decimal,
            kind IN (4, 5, 10, 13) AS bad_long, kind IN (4, 5, 6, 10, 14) AS bad_int, kind IN (5, 13) AS bad_decimal
        FROM (SELECT event_id, event_id % 17 AS kind,
            CASE event_id % 17 WHEN 0 THEN event_id WHEN 3 THEN 12000 + event_id % 1000 WHEN 8 THEN event_id
                WHEN 6 THEN 98765432000 + event_id % 1000 WHEN 9 THEN event_id % 1000 * 100 WHEN 11 THEN event_id
                WHEN 12 THEN -(event_id % 1000) WHEN 13 THEN 1 WHEN 14 THEN 98765432000 + event_id % 1000
                WHEN 15 THEN event_id % 1000 * 100 WHEN 16 THEN event_id END AS whole
            FROM events)""",
    "preview_limit": _with(
        ["order_raw", "order_times", "order_events"],
        """SELECT * FROM order_events ORDER BY "offset", "partition" LIMIT 10""",
    ),
    "decode_gender": """
        SELECT c_custkey, CAST(CASE c_custkey % 5 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS INTEGER) AS gender
        FROM customer""",
    "split_birthday": """
        SELECT c_custkey,
            CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 7 IN (0, 2, 3) THEN c_name ELSE ' ' END AS birthday,
            CASE WHEN c_custkey % 11 = 0 OR c_custkey % 7 IN (0, 2, 3) THEN ' '
                WHEN c_custkey % 7 IN (1, 4) THEN c_name ELSE '' END AS luna_birthday
        FROM customer""",
    "blank_fill": """
        SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN ' ' WHEN 1 THEN '' ELSE c_name END AS filled FROM customer""",
    "day_epoch": f"""
        SELECT l_orderkey, l_linenumber,
            CASE l_orderkey % 5 WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d')
                WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d 23:59:59')
                WHEN 2 THEN CAST(CAST(epoch(l_shipdate) AS BIGINT) * 1000 + 57599999 AS VARCHAR)
                WHEN 3 THEN CAST(CAST(epoch(l_shipdate) AS BIGINT) * 1000 + 57600000 AS VARCHAR) END AS text,
            CAST(CASE l_orderkey % 5 WHEN 0 THEN {_midnight("l_shipdate")} WHEN 1 THEN {_midnight("l_shipdate")}
                WHEN 2 THEN {_midnight("l_shipdate")} WHEN 3 THEN {_midnight("l_shipdate")} + 86400
                ELSE 0 END AS INTEGER) AS day_epoch
        FROM lineitem""",
    "order_status_label": f"""
        SELECT o_orderkey, {_status("o_orderkey % 3", "o_orderkey % 5", "o_orderkey % 7")} AS status FROM orders""",
    "decode_labels": f"""
        SELECT c_custkey, {_label("c_custkey % 11 - 1", SKIN_TYPES)} AS skin_type,
            {_label("c_custkey % 11 - 1", ALLERGIES)} AS is_allergy,
            {_label("c_custkey % 11 - 1", SKIN_COLORS)} AS skin_color,
            {_label("c_custkey % 11 - 1", IMPROVEMENTS)} AS improve_type
        FROM customer""",
    "decode_flag": """
        SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'n' WHEN 1 THEN 'y' END AS flag FROM customer""",
    "lookup_base": _with(
        ["base"], "SELECT c_custkey AS customer_id, id FROM customer LEFT JOIN base ON customer_id = c_custkey"
    ),
    "link_child": _with(
        ["base", "oa"],
        """SELECT b.customer_id, b.id AS base_id, oa.base_id IS NOT NULL AS has_child
        FROM base b LEFT JOIN oa ON oa.base_id = b.id""",
    ),
    "guard_semi": _with(
        _SKIN_KNOWN, f"SELECT customer_id, {_skin_columns('e')} FROM skin_events e SEMI JOIN base USING (customer_id)"
    ),
    "unmatched_anti": _with(
        _SKIN_KNOWN, f"SELECT customer_id, {_skin_columns('e')} FROM skin_events e ANTI JOIN base USING (customer_id)"
    ),
    "probe_orders": _with(
        ["order_status"],
        """SELECT o_orderkey AS order_id, o_orderkey IN (SELECT order_id FROM order_status) AS found FROM orders""",
    ),
    "probe_staff": _with(
        ["staff_events", "staff"],
        """SELECT DISTINCT customer_id, customer_id IN (SELECT customer_id FROM staff) AS found FROM staff_events""",
    ),
    "high_water": "SELECT coalesce(max(o_orderkey), 0) AS high_water FROM orders",
    "latest_per_key": _with(
        ["staff_events", "staff_latest"],
        """SELECT customer_id, trace_staff_id, recom_staff_id, serve_staff_id, first_offset, first_partition
        FROM staff_latest""",
    ),
    "running_high_water": _with(
        _GATED[:-2], """SELECT "partition", "offset", order_id, high_water FROM seen_order_status"""
    ),
    "assign_ids": _with(
        ["staff_events", "staff_latest", "staff", "staff_ids"], "SELECT customer_id, id FROM staff_ids"
    ),
    "linked_upsert_base": _with(
        [*_LINKED, "linked"],
        f"SELECT id, customer_id, name, {', '.join(_CUSTOMER_BASE)} FROM linked",
    ),
    "linked_upsert_oa": _with(
        [*_LINKED, "linked", "oa"],
        f"""SELECT l.id AS base_id, l.customer_id, {", ".join(f"l.{name}" for name in _CUSTOMER_OA)},
            {", ".join(f"CASE WHEN known_id IS NOT NULL THEN 'old' END AS {name}" for name in SKIN_NAMES)}
        FROM linked l LEFT JOIN oa ON oa.base_id = l.id WHERE known_id IS NULL OR oa.base_id IS NOT NULL""",
    ),
    "partial_update": _with(
        ["skin_events", "oa"],
        f"""SELECT oa.base_id, oa.customer_id, {", ".join(
            f"CAST(1 AS DOUBLE) AS {name}" if name.endswith(("cash", "score"))
            else f"CAST(1 AS INTEGER) AS {name}" if name.startswith("customer_")
            else f"'old' AS {name}" for name in _CUSTOMER_OA)},
            {", ".join(f"coalesce(e.{name}, 'old') AS {name}" for name in SKIN_NAMES)}
        FROM oa LEFT JOIN skin_events e ON e.customer_id = oa.customer_id AND e.customer_id <> 0""",
    ),
    "upsert_staff": _with(
        ["staff_events", "staff_latest", "staff", "staff_ids"],
        """SELECT coalesce(t.id, n.id) AS id, coalesce(t.customer_id, e.customer_id) AS customer_id,
            coalesce(e.trace_staff_id, 1) AS trace_staff_id, coalesce(e.recom_staff_id, 2) AS recom_staff_id,
            coalesce(e.serve_staff_id, 3) AS serve_staff_id
        FROM staff t FULL JOIN staff_latest e ON e.customer_id = t.customer_id
        LEFT JOIN staff_ids n ON n.customer_id = e.customer_id""",
    ),
    "gate_actions": _with(_GATED, """SELECT order_id, "partition", "offset", action FROM gated_order_status"""),
    "gated_upsert": _with(_GATED, _orders_after("order_status")),
    "stream_gated_upsert": _with(_GATED, _orders_after("order_status")),
    "orders_into_empty": _with(_GATED_EMPTY, _orders_after("no_orders")),
    "orders_by_status": _with(
        _GATED_EMPTY,
        f"SELECT status, count(*) AS orders FROM ({_orders_after('no_orders')}) GROUP BY status",
    ),
    "customer_scope_update": _with(
        _GATED,
        """SELECT t.customer_id, coalesce(e.order_id, t.order_id) AS order_id,
            coalesce(e.submit_time, t.submit_time) AS submit_time, coalesce(e.ship_time, t.ship_time) AS ship_time,
            coalesce(e.sign_time, t.sign_time) AS sign_time, coalesce(e.status, t.status) AS status
        FROM (SELECT *, 0 AS pos FROM order_status
            UNION ALL
            SELECT customer_id, order_id, submit_time, ship_time, sign_time, status, pos FROM scoped WHERE act = 'I') t
        LEFT JOIN (SELECT * FROM scoped WHERE act = 'U' QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY pos DESC) = 1) e
            ON e.customer_id = t.customer_id AND e.pos > t.pos""",
    ).replace("WITH ", "WITH RECURSIVE ", 1).replace(
        "\nSELECT t.customer_id",
        """,
        numbered AS (SELECT *, row_number() OVER (ORDER BY "offset", "partition") AS pos FROM gated_order_status),
        rounds AS (
            SELECT 0 AS round, pos, customer_id, order_id, action AS act FROM numbered
            UNION ALL
            SELECT round, pos, customer_id, order_id, act FROM (
                WITH rows AS (
                    SELECT customer_id, order_id, pos, act = 'U' AS updates FROM rounds WHERE act <> 'R'
                    UNION ALL SELECT DISTINCT customer_id, order_id, 0, false FROM order_status),
                spans AS (
                    SELECT order_id, pos AS a, updates, min(CASE WHEN updates THEN pos END) OVER later AS b,
                        min(CASE WHEN NOT updates THEN pos END) OVER earlier AS row_since
                    FROM rows
                    WINDOW later AS (PARTITION BY customer_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING),
                        earlier AS (PARTITION BY customer_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
                seen AS (
                    SELECT r.round, r.pos, r.customer_id, r.order_id, r.act AS old, coalesce(bool_or(s.order_id = r.order_id), false) AS found,
                        coalesce(max(s.order_id), 0) AS high
                    FROM rounds r LEFT JOIN spans s ON s.a < r.pos AND r.pos <= coalesce(s.b, 9223372036854775807) AND (NOT s.updates OR s.row_since IS NOT NULL)
                    GROUP BY ALL),
                decided AS (SELECT *, CASE WHEN found THEN 'U' WHEN order_id > high THEN 'I' ELSE 'R' END AS act FROM seen)
                SELECT round + 1 AS round, pos, customer_id, order_id, act, bool_or(act <> old) OVER () AS moved FROM decided)
            WHERE moved),
        scoped AS (
            SELECT n.customer_id, n.order_id, n.submit_time, n.ship_time, n.sign_time, n.status, n.pos, r.act
            FROM numbered n JOIN rounds r USING (pos) WHERE r.round = (SELECT max(round) FROM rounds))
SELECT t.customer_id""",
    ),
    "reject_report": _with([*_GATED, *_SKIN_KNOWN], _REJECTS),
    "reject_counts": _with(
        [*_GATED, *_SKIN_KNOWN, "dirty"],
        f"""SELECT reason, count(*) AS events FROM (
            SELECT reason FROM ({_REJECTS}) UNION ALL SELECT reason FROM ({_QUARANTINE})) GROUP BY reason""",
    ),
}

# a stream leaves the same table as one batch
ORACLES["stream_upsert_staff"] = ORACLES["upsert_staff"]
ORACLES["stream_partial_update"] = ORACLES["partial_update"]
