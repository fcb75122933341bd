"""Truth tables of the decodes and the reasons of bad records."""

import re
from decimal import Decimal

import pytest
from helpers import log_of, rows_of
from pyspark.sql import functions as F

from tidemark.functions import coerce, decode
from tidemark.operators import project as p
from tidemark.operators.envelope import first_images, valid_objects
from tidemark.scratch import stage

ORDER = {"order_id": 5, "customer_id": "7", "submit_time": "12"}

GOOD = '{"data":[{"order_id":5,"customer_id":7,"submit_time":1}]}'

REASONS = [
    (None, "not_object"),
    ("", "not_object"),
    ("not json", "not_object"),
    ("null", "not_object"),
    ("123", "not_object"),
    ('"s"', "not_object"),
    ('[{"data":[]}]', "not_object"),
    ('{"data":[{"a":"1"', "not_object"),
    ('{"data":[]} tail', "not_object"),
    ('{"data":[{"order_id":1}]} {"data":[{"order_id":2}]}', "not_object"),
    ('{"data":[{"order_id":1}]},{"data":[{"order_id":2}]}', "not_object"),
    ('{"data":[{"order_id":1}]}]}', "not_object"),
    (GOOD + '],"x":[1', "not_object"),
    (GOOD + '],"end":2,"y":[3', "not_object"),
    (GOOD + '],"root":[{"data":[{"order_id":9,"customer_id":7,"submit_time":1}]}', "not_object"),
    (GOOD + '],x:[1', "not_object"),
    (GOOD + ',{"tidemark_document":1}],"z":[5', "not_object"),
    (GOOD + ',{"tidemark_document":1}],"tidemark_document":[' + GOOD, "not_object"),
    ("{}", "bad_envelope"),
    ('{"data":[]}', "bad_envelope"),
    ('{"data":{"a":1}}', "bad_envelope"),
    ('{"data":null}', "bad_envelope"),
    ('{"data":[null]}', "bad_envelope"),
    ('{"data":[5]}', "bad_envelope"),
    ({"order_id": 1, "customer_id": 1}, "bad_value"),
    ({**ORDER, "submit_time": "x"}, "bad_value"),
    ({**ORDER, "submit_time": 3_000_000_000}, "bad_value"),
    ({**ORDER, "order_id": "1.5"}, "bad_value"),
    ({**ORDER, "order_id": " 5"}, "bad_value"),
    ({**ORDER, "ship_date": "0000-00-00"}, "bad_value"),
    ({**ORDER, "ship_date": "2020-03"}, "bad_value"),
    ({**ORDER, "ship_date": "soon"}, "bad_value"),
    ({**ORDER, "sign_date": 99_999_999_999_999_999}, "bad_value"),
    ({**ORDER, "sign_date": "99999999999999999999999"}, "bad_value"),
    ({**ORDER, "order_id": None}, "null_key"),
    ({**ORDER, "customer_id": "NULL"}, "null_key"),
    (ORDER, None),
    ({**ORDER, "order_id": 5.0, "customer_id": "7.00", "submit_time": 1e3}, None),
    ('{"data":[{"order_id":5e0,"customer_id":1.7E1,"submit_time":1e3}]}', None),
    ({**ORDER, "order_id": "1.7e0"}, "bad_value"),
    ({**ORDER, "order_id": "1e-30"}, "bad_value"),
    ({**ORDER, "order_id": 5.7, "customer_id": -0.2, "submit_time": True}, None),
    ({**ORDER, "customer_id": True}, "bad_value"),
    ({**ORDER, "submit_time": "true"}, "bad_value"),
    ({**ORDER, "submit_time": 3e9}, "bad_value"),
    ({**ORDER, "order_id": 1e19}, "bad_value"),
    ({**ORDER, "order_id": {"a": 1}}, "bad_value"),
    ({**ORDER, "order_id": [5]}, "bad_value"),
    (GOOD[:-1] + ',"tidemark_document":3}', None),
    ('{"data":[{"order_id":5,"customer_id":7,"submit_time":1},5]}', None),
    ('  {"data":[{"order_id":5,"customer_id":7,"submit_time":1}]}\n', None),
    ("{data:[{'order_id':5,'customer_id':7,'submit_time':1}]}", None),
]


def test_order_reasons(spark):
    log = log_of(spark, [(0, i, value) for i, (value, _) in enumerate(REASONS)])
    got = dict(p.project_order(log).select("offset", "reason").collect())
    assert got == {i: reason for i, (_, reason) in enumerate(REASONS)}
    kept = {r["offset"] for r in valid_objects(log).collect()}
    assert kept == {i for i, (_, reason) in enumerate(REASONS) if reason != "not_object"}


def test_other_reasons(spark):
    codes = {"skin_type": 1, "is_allergy": 1, "skin_color": 1, "improve_type": 1}
    skin = [
        ({"customer_id": 1, **codes}, None),
        ({"customer_id": 1, **codes, "skin_type": 0}, "bad_code"),
        ({"customer_id": 1, **codes, "is_allergy": 5}, "bad_code"),
        ({"customer_id": 1, **codes, "improve_type": -2147483648}, "bad_code"),
        ({"customer_id": 1, **codes, "improve_type": "x"}, "bad_value"),
        ({"customer_id": 1, "skin_type": 1}, "bad_code"),
        (codes, "null_key"),
    ]
    staff = {"trace_staff_id": 1, "recom_staff_id": 2, "serve_staff_id": 3}
    staffs = [
        ({"customer_id_se": 4, **staff}, None),
        (staff, None),
        ({"customer_id_se": 4, **staff, "recom_staff_id": ""}, "null_staff"),
        ({"customer_id_se": 4, **staff, "recom_staff_id": "1e"}, "bad_value"),
    ]
    for project, cases in ((p.project_skin, skin), (p.project_staff, staffs)):
        log = log_of(spark, [(0, i, value) for i, (value, _) in enumerate(cases)])
        got = dict(project(log).select("offset", "reason").collect())
        assert got == {i: reason for i, (_, reason) in enumerate(cases)}
    staff_keys = p.project_staff(log_of(spark, [(0, 0, staff)])).select("customer_id").collect()
    assert staff_keys[0][0] == 0


def test_split_parses_once(spark):
    valid, quarantine = p.split(p.project_customer(log_of(spark, [(0, 0, {})])), p.CUSTOMER_VALUES)
    for frame in (valid, quarantine):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        # the record itself, and the second look at odd arrays
        assert plan.count("from_json(") == 2


DAYS = [
    (None, 0),
    ("", 0),
    ("2020-03-23", 1584892800),
    ("2020-03-23 16:15:00", 1584892800),
    ("2020-03-23T16:15:00.123", 1584892800),
    (1584892799000, 1584806400),
    ("1584892800000", 1584892800),
    (0, -28800),
    (-1, -28800),
    ("2020-03-23T16:15:00Z", 1584979200),
    ("2020-03-23T16:15:00+08:00", 1584892800),
]


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_day_epoch_does_not_depend_on_the_session(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        log = log_of(spark, [(0, i, {**ORDER, "ship_date": text}) for i, (text, _) in enumerate(DAYS)])
        got = dict(p.project_order(log).select("offset", "ship_time").collect())
        assert got == {i: day for i, (_, day) in enumerate(DAYS)}
        utc = dict(p.project_order(log, "UTC").select("offset", "ship_time").collect())
        assert utc[2] == 1584921600
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).head()["x"]


def test_truth_tables(spark):
    def one(column):
        return _one(spark, column)

    assert [one(decode.gender(F.lit(n))) for n in (0, 1, 2, 3, 9)] == [0, 0, 2, 1, 0]
    born = F.lit("b")
    pairs = [(one(decode.solar_birthday(F.lit(c), born)), one(decode.lunar_birthday(F.lit(c), born))) for c in range(6)]
    assert pairs == [("b", " "), (" ", "b"), ("b", " "), ("b", " "), (" ", "b"), (" ", "")]
    none = F.lit(None).cast("string")
    assert (one(decode.solar_birthday(F.lit(5), none)), one(decode.lunar_birthday(F.lit(5), none))) == ("", " ")
    assert [one(decode.blank_fill(t)) for t in (none, F.lit("x"), F.lit(""))] == [" ", "x", ""]
    assert [one(decode.yes_no(F.lit(n))) for n in (0, 1, 2)] == ["n", "y", None]
    cases = [(0, 1, 1), (0, 0, 0), (1, 0, 1), (1, 1, 0), (1, 1, 1)]
    labels = [one(decode.order_status(*map(F.lit, case))) for case in cases]
    assert labels == [" ", " ", "已提交", "已发货", "已签收"]
    assert [one(decode.label(F.lit(n), decode.ALLERGIES)) for n in (0, 1, 4, 5, -1)] == [None, "", "易过敏", None, None]


def test_customer_defaults(spark):
    row = rows_of(
        p.project_customer(log_of(spark, [(0, 0, {"customer_id": "1,234", "total_cash": "1.5"})])),
        "customer_id",
        "gender",
        "birthday",
        "luna_birthday",
        "handset",
        "district",
        "traced_at",
        "reason",
    )
    assert row == [(1234, 0, "", " ", 0, None, " ", None)]


def test_numbers_go_by_their_json_type(spark):
    """The getters cut a JSON number towards zero, and refuse the same digits as text."""
    values = [1.5, -1.5, "1.5", 1e2, "1e2", True, "true", 7, "7", None, "null", 2147483647.9, 2147483648.0, 1e-30, 0.1]
    log = log_of(spark, [(0, i, {**ORDER, "submit_time": v, "ship_date": 1.584892799e12 if i % 2 else "1.584892799e12"}) for i, v in enumerate(values)])
    got = {r["offset"]: (r["submit_time"], r["ship_time"]) for r in p.project_order(log).collect()}
    want = [1, -1, None, 100, 100, 1, None, 7, 7, None, None, 2147483647, None, 0, 0]
    assert [got[i][0] for i in range(len(values))] == want
    assert [got[i][1] for i in range(len(values))] == [1584806400 if i % 2 else None for i in range(len(values))]


def test_images_keep_json_types(spark):
    image = '{"data":[{"a":1.50,"b":"1.50","c":true,"d":null,"e":{"x":[1]},"f":[2]}]}'
    found = first_images(log_of(spark, [(0, 0, image)]), "abcdefg")
    row = found.select(*[F.expr(read(c)).alias(f"{c}{i}") for c in "abcdefg" for i, read in enumerate((coerce.leaf_text, coerce.json_kind))]).head()
    assert [row[f"{c}0"] for c in "abcdefg"] == ["1.5", "1.50", "true", None, '{"x":[1]}', "[2]", None]
    assert [row[f"{c}1"] for c in "abcdefg"] == ["number", "text", "boolean", None, "object", "array", None]


def test_decimals_keep_every_digit_or_are_bad(spark):
    texts = ["1.23456", 0.1, "12345678901234567890.5", "1.12345678900000", "1.12345678901", "1e-11", "1.5e3", "9" * 29, "-7", ".5", "5."]
    log = log_of(spark, [(0, i, {"customer_id": 1, "total_cash": t}) for i, t in enumerate(texts)])
    got = {r["offset"]: (r["total_cash"], r["reason"]) for r in p.project_customer(log).collect()}
    want = ["1.23456", "0.1", "12345678901234567890.5", "1.123456789", None, None, "1500", None, "-7", "0.5", "5"]
    for i, text in enumerate(want):
        assert got[i] == ((Decimal(text), None) if text else (None, "bad_value")), texts[i]


def test_the_jvm_compiles_every_method_of_the_order_projection(spark):
    log = stage(log_of(spark, [(0, 0, {"order_id": 1, "customer_id": 2, "submit_time": 3, "ship_date": "2020-01-01", "sign_date": ""})]), "log")
    plan = p.project_order(log)._jdf.queryExecution().executedPlan()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    assert sizes and max(sizes) < 8000
