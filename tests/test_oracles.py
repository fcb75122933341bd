"""Every registered query against its SQL twin on the driver tables."""

import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)

    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    want_types = dict(zip(want.columns, [str(t) for t in want.types], strict=True))
    assert {c: kinds[t] for c, t in got.dtypes} == want_types

    got_rows = Counter(tuple(_cell(row[c]) for c in columns) for row in got.collect())
    want_rows = Counter(
        tuple(_cell(v) for v in row) for row in want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    )
    missing, extra = want_rows - got_rows, got_rows - want_rows
    assert not missing and not extra, (list(missing.items())[:3], list(extra.items())[:3])
    assert got_rows
