"""Typed projections of the four logs.

Each ``project_*`` keeps the record columns, adds the decoded columns and a ``reason``: null for a
valid record, else the first of not_object, bad_envelope, bad_value, bad_code, null_key, null_staff.
``split`` separates the two. Where both halves are used, stage the projection first so that the
records are parsed once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import coerce, decode
from tidemark.functions.coerce import DECIMAL
from tidemark.operators.envelope import first_reason, leaves, parse_envelope, settle
from tidemark.operators.keyed import ROW
from tidemark.scratch import stage
from tidemark.sources.records import RECORD_COLUMNS
from tidemark.sources.tables import BASE_COLUMNS, OA_COLUMNS, ORDER_COLUMNS, SKIN_COLUMNS, STAFF_COLUMNS

DEFAULT_ZONE = "Asia/Shanghai"

CUSTOMER_VALUES = ["customer_id", *BASE_COLUMNS, *OA_COLUMNS]
SKIN_VALUES = ["customer_id", *SKIN_COLUMNS]
STAFF_VALUES = ["customer_id", *STAFF_COLUMNS]
ORDER_VALUES = ["customer_id", "order_id", *ORDER_COLUMNS]

ORDINAL = ["offset", "partition"]

Numbers = dict[str, tuple[str, int | None]]

# image field -> (type, default); no default keeps null
CUSTOMER_NUMBERS = {
    "customer_id": ("bigint", None),
    "gender": ("int", 0),
    "calendar": ("int", 0),
    "province": ("int", 0),
    "city": ("int", 0),
    "handset": ("bigint", 0),
    "handset2": ("bigint", 0),
    "qq_code": ("bigint", 0),
    "total_cash": (DECIMAL, None),
    "customer_grade": ("int", 0),
    "customer_type": ("int", 0),
    "customer_source": ("int", 0),
    "total_score": (DECIMAL, None),
    "lock_score": (DECIMAL, None),
    "used_score": (DECIMAL, None),
    "can_use_score": (DECIMAL, None),
}
CUSTOMER_TEXTS = ["customer_name", "birthday", "district", "ty_code", "last_trace_date", "lock_date", "fsale_date"]
SKIN_NUMBERS = {"customer_id": ("bigint", None), **{name: ("int", 0) for name in SKIN_COLUMNS}}
SKIN_LABELS = dict(
    zip(
        SKIN_COLUMNS,
        (decode.SKIN_TYPES, decode.ALLERGIES, decode.SKIN_COLORS, decode.IMPROVEMENTS),
        strict=True,
    )
)
STAFF_NUMBERS = {"customer_id_se": ("bigint", 0), **{name: ("int", None) for name in STAFF_COLUMNS}}
ORDER_NUMBERS = {"customer_id": ("bigint", None), "order_id": ("bigint", None), "submit_time": ("int", None)}
ORDER_DATES = ["ship_date", "sign_date"]


def read_numbers(rows: DataFrame, image: str, numbers: Numbers) -> DataFrame:
    """Reads the numbers among the VARIANT leaves of the struct ``image``: adds ``num``, a struct of their values with
    defaults, and ``bad``, whether one of them is malformed.

    The count's lambda sits in the projection that parses: it keeps that projection out of
    whole-stage code generation, which would put a wide one into a single method too big for the JVM
    to compile (six times slower on the customer log). Outside, the generated code is split up.
    """
    texts = {name: coerce.leaf_text(f"{image}.{name}") for name in numbers}
    present = {name: coerce.present(f"raw.{name}") for name in numbers}
    parsed = {name: coerce.typed_number(f"{image}.{name}", f"txt.{name}", kind) for name, (kind, _) in numbers.items()}
    count = coerce.present_count([f"txt.{name}" for name in numbers])
    values = {
        name: f"val.{name}" if default is None else coerce.or_default(f"txt.{name}", f"val.{name}", default)
        for name, (_, default) in numbers.items()
    }
    bad = coerce.any_bad("present_count", [f"val.{name}" for name in numbers])
    return (
        rows.withColumn("raw", _struct(texts))
        .withColumn("txt", _struct(present))
        .withColumns({"val": _struct(parsed), "present_count": F.expr(count)})
        .withColumns({"num": _struct(values), "bad": F.expr(bad)})
        .drop("raw", "txt", "val", "present_count")
    )


def add_day_epochs(rows: DataFrame, image: str, dates: list[str], zone: str) -> DataFrame:
    """Adds ``day``, INT epoch seconds of local midnight for the dates among the VARIANT leaves of the struct ``image``: 0 for
    blank text, null for text that does not parse and for days outside INT; and ``bad_day``, whether one of them is null.

    The count's lambda keeps the step of the local days out of whole-stage code generation, as in ``read_numbers``: all steps in one stage
    made a method of more than 8,000 bytes, which the JVM does not compile.
    """
    rows = rows.withColumn("date_raw", _struct({d: coerce.leaf_text(f"{image}.{d}") for d in dates}))
    rows = rows.withColumn("date_spelled", _struct({d: coerce.present(f"date_raw.{d}") for d in dates}))
    rows = rows.withColumn("date_txt", _struct({d: coerce.typed_millis(f"{image}.{d}", f"date_spelled.{d}") for d in dates}))
    rows = rows.withColumn("date_ms", _struct({d: coerce.instant_millis(f"date_txt.{d}") for d in dates}))
    days = {d: coerce.local_day(f"date_txt.{d}", f"date_ms.{d}", zone) for d in dates}
    count = coerce.present_count([f"date_txt.{d}" for d in dates])
    rows = rows.withColumns({"date_num": _struct(days), "date_count": F.expr(count)})
    rows = rows.withColumn("date_val", _struct({d: f"try_cast({coerce.midnight_seconds(f'date_num.{d}', zone)} AS INT)" for d in dates}))
    midnights = {d: coerce.or_default(f"date_txt.{d}", f"date_val.{d}", 0) for d in dates}
    bad = coerce.any_bad("date_count", [f"date_val.{d}" for d in dates])
    rows = rows.withColumns({"day": _struct(midnights), "bad_day": F.expr(bad)})
    return rows.drop("date_raw", "date_spelled", "date_txt", "date_ms", "date_num", "date_count", "date_val")


def _struct(fields: dict[str, str]) -> Column:
    return F.expr(f"named_struct({', '.join(f"'{name}', {sql}" for name, sql in fields.items())})")


def _any_of(conditions: Iterable[str]) -> Column:
    return F.expr(" OR ".join(conditions))


def project_customer(log: DataFrame) -> DataFrame:
    parsed = read_numbers(parse_envelope(log, leaves(CUSTOMER_NUMBERS, CUSTOMER_TEXTS)), "img", CUSTOMER_NUMBERS)
    img, calendar = F.col("img"), F.col("num.calendar")
    columns = {name: F.col(f"num.{name}") for name in CUSTOMER_NUMBERS} | {
        "name": img["customer_name"],
        "gender": decode.gender(F.col("num.gender")),
        "birthday": decode.solar_birthday(calendar, img["birthday"]),
        "luna_birthday": decode.lunar_birthday(calendar, img["birthday"]),
        "district": img["district"],
        "ty_code": img["ty_code"],
        "traced_at": decode.blank_fill(img["last_trace_date"]),
        "locked_at": decode.blank_fill(img["lock_date"]),
        "first_sale_date": decode.blank_fill(img["fsale_date"]),
    }
    reason = F.coalesce(
        "reason",
        first_reason(("bad_value", F.col("bad")), ("null_key", F.col("num.customer_id").isNull())),
    )
    values = [columns[name].alias(name) for name in CUSTOMER_VALUES]
    return settle(parsed, RECORD_COLUMNS, [*values, reason.alias("reason")])


def project_skin(log: DataFrame) -> DataFrame:
    parsed = read_numbers(parse_envelope(log, leaves(SKIN_NUMBERS)), "img", SKIN_NUMBERS)
    # a missing code is 0, which no list has: both end as no label
    labels = [decode.label(F.col(f"num.{name}"), texts).alias(name) for name, texts in SKIN_LABELS.items()]
    labelled = parsed.withColumn("text", F.struct(*labels))
    reason = F.coalesce(
        "reason",
        first_reason(
            ("bad_value", F.col("bad")),
            ("bad_code", _any_of(f"text.{name} IS NULL" for name in SKIN_COLUMNS)),
            ("null_key", F.col("num.customer_id").isNull()),
        ),
    )
    values = [F.col("num.customer_id"), *[F.col(f"text.{name}") for name in SKIN_COLUMNS]]
    return settle(labelled, RECORD_COLUMNS, [*values, reason.alias("reason")])


def project_staff(log: DataFrame) -> DataFrame:
    parsed = read_numbers(parse_envelope(log, leaves(STAFF_NUMBERS)), "img", STAFF_NUMBERS)
    reason = F.coalesce(
        "reason",
        first_reason(
            ("bad_value", F.col("bad")),
            ("null_staff", _any_of(f"num.{name} IS NULL" for name in STAFF_COLUMNS)),
        ),
    )
    values = [F.col("num.customer_id_se").alias("customer_id"), *[F.col(f"num.{name}") for name in STAFF_COLUMNS]]
    return settle(parsed, RECORD_COLUMNS, [*values, reason.alias("reason")])


def project_order(log: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    parsed = read_numbers(parse_envelope(log, leaves([*ORDER_NUMBERS, *ORDER_DATES])), "img", ORDER_NUMBERS)
    timed = add_day_epochs(parsed, "img", ORDER_DATES, zone)
    submit_time, ship_time, sign_time = F.col("num.submit_time"), F.col("day.ship_date"), F.col("day.sign_date")
    unread = _any_of(["num.submit_time IS NULL", "bad_day"])
    reason = F.coalesce(
        "reason",
        first_reason(
            ("bad_value", F.col("bad") | unread),
            ("null_key", _any_of(["num.order_id IS NULL", "num.customer_id IS NULL"])),
        ),
    )
    values = [
        F.col("num.customer_id"),
        F.col("num.order_id"),
        submit_time,
        ship_time.alias("ship_time"),
        sign_time.alias("sign_time"),
        decode.order_status(sign_time, ship_time, submit_time).alias("status"),
    ]
    return settle(timed, RECORD_COLUMNS, [*values, reason.alias("reason")])


def split(projected: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """(valid events, quarantine). Valid events carry their place in the log, ``values`` and, from a staged projection, their row id."""
    row = [ROW] if ROW in projected.columns else []
    valid = projected.filter(F.col("reason").isNull()).select(*ORDINAL, *row, *values)
    quarantine = projected.filter(F.col("reason").isNotNull()).select(*RECORD_COLUMNS, "reason")
    return valid, quarantine


def stage_projection(projected: DataFrame) -> DataFrame:
    """A projection written once for its several readers; raw text is kept for bad records only. Each record gets a row id."""
    slim = {name: F.when(F.col("reason").isNotNull(), F.col(name)) for name in ("key", "value")}
    return stage(projected.withColumns({**slim, ROW: F.monotonically_increasing_id()}), "projected")


def count_reasons(set_aside: DataFrame) -> DataFrame:
    """How many events were quarantined or rejected, per reason."""
    return set_aside.groupBy("reason").agg(F.count("*").alias("events"))


def nonzero_key(events: DataFrame, key: str = "customer_id") -> DataFrame:
    return events.filter(F.col(key) != 0)


def preview(events: DataFrame, rows: int = 10) -> DataFrame:
    """First rows in log order: a top-k, so no full sort."""
    return events.drop(ROW).orderBy(*ORDINAL).limit(rows)
