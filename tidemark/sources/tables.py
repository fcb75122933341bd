"""Schemas of the target tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.coerce import DECIMAL

BASE_COLUMNS = {
    "name": "string",
    "gender": "int",
    "birthday": "string",
    "luna_birthday": "string",
    "province": "int",
    "city": "int",
    "district": "string",
    "handset": "bigint",
    "handset2": "bigint",
    "qq_code": "bigint",
    "ty_code": "string",
}

OA_COLUMNS = {
    "total_cash": DECIMAL,
    "customer_grade": "int",
    "customer_type": "int",
    "customer_source": "int",
    "total_score": DECIMAL,
    "lock_score": DECIMAL,
    "used_score": DECIMAL,
    "can_use_score": DECIMAL,
    "traced_at": "string",
    "locked_at": "string",
    "first_sale_date": "string",
}

SKIN_COLUMNS = {"skin_type": "string", "is_allergy": "string", "skin_color": "string", "improve_type": "string"}

STAFF_COLUMNS = {"trace_staff_id": "int", "recom_staff_id": "int", "serve_staff_id": "int"}

ORDER_COLUMNS = {"submit_time": "int", "ship_time": "int", "sign_time": "int", "status": "string"}

TABLES = {
    "base": {"id": "bigint", "customer_id": "bigint", **BASE_COLUMNS},
    "oa": {"base_id": "bigint", "customer_id": "bigint", **OA_COLUMNS, **SKIN_COLUMNS},
    "customer_info": {"id": "bigint", "customer_id": "bigint", **STAFF_COLUMNS},
    "order_status": {"customer_id": "bigint", "order_id": "bigint", **ORDER_COLUMNS},
}


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    DECIMAL: T.DecimalType(38, 10),
}


def table_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(column, _TYPES[kind]) for column, kind in TABLES[name].items()])


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], table_schema(name))
