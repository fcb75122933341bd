"""Change logs and prior tables derived from the driver tables.

Every log is the whole source table as JSON text in the records' ``value``, so that reading it back
exercises the real parse. Offsets are unique per (topic, partition) and mostly out of key order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.coerce import DECIMAL
from tidemark.operators.project import SKIN_VALUES
from tidemark.sources.ledger import LEDGER_SCHEMA
from tidemark.sources.records import RECORD_COLUMNS
from tidemark.sources.tables import OA_COLUMNS, table_schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table that a log is made of, spread by ``key`` like a topic's records."""
    return table(spark, sf_dir, name).repartition(F.col(key))


def _records(rows: DataFrame, topic: str, key: Column, value: Column, partition: Column, offset: Column) -> DataFrame:
    return rows.select(
        key.cast("string").alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    ).select(*RECORD_COLUMNS)


def _envelope(image: dict[str, Column]) -> Column:
    return F.to_json(F.struct(F.array(F.struct(*[column.alias(name) for name, column in image.items()])).alias("data")))


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two events per customer; the second has changed codes. Four partitions."""
    revisions = F.explode(F.array(F.lit(0), F.lit(1))).alias("rev")
    customers = source(spark, sf_dir, "customer", "c_custkey")
    rows = customers.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", revisions)
    k, rev = F.col("c_custkey"), F.col("rev")
    day = F.concat(F.lit("1980-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))
    image = {
        "customer_id": k,
        "customer_name": F.col("c_name"),
        "gender": (k + rev) % 5,
        "calendar": (k + rev) % 7,
        "birthday": F.when(k % 11 != 0, day),
        "province": F.col("c_nationkey"),
        "city": F.when(rev == 1, F.col("c_nationkey") * 100 + 1),
        "district": F.when(k % 5 != 0, F.col("c_mktsegment")),
        "handset": F.lit(13_000_000_000) + k,
        "handset2": F.when(rev == 0, (F.lit(13_100_000_000) + k).cast("string")).otherwise(""),
        "qq_code": F.when(k % 4 != 0, k * 10),
        "ty_code": F.concat(F.lit("T"), k),
        "total_cash": F.col("c_acctbal"),
        "customer_grade": k % 6,
        "customer_type": F.when(k % 2 == 0, k % 3),
        "customer_source": (k + rev) % 9,
        "total_score": F.concat((k % 9 + 1).cast("string"), F.lit(","), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(".25")),
        "lock_score": F.when(rev == 0, k % 50),
        "used_score": k % 100,
        "can_use_score": F.when(k % 3 != 0, k % 77 + rev),
        "last_trace_date": F.when(k % 3 != 0, F.lit("2020-03-23")),
        "lock_date": F.when(rev == 1, F.lit("2020-04-01")),
        "fsale_date": F.when(k % 13 != 0, day),
    }
    return _records(rows, "customer", k, _envelope(image), k % 4, k * 2 + rev)


def skin_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per customer; codes outside the lists occur. Key 0 and unknown customers too."""
    rows = source(spark, sf_dir, "customer", "c_custkey").select("c_custkey")
    k = F.col("c_custkey")
    image = {
        "customer_id": k,
        # key 0 has valid codes, so that only its filter drops it
        "skin_type": F.when(k == 0, 2).otherwise(k % 6),
        "is_allergy": F.when(k == 0, 2).otherwise(k % 5),
        "skin_color": F.when(k == 0, 2).otherwise(k % 6).cast("string"),
        "improve_type": F.when(k == 0, 2).otherwise(k % 9),
    }
    return _records(rows, "skin", k, _envelope(image), k % 3, k)


def staff_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per row of ``events``: many per key."""
    rows = source(spark, sf_dir, "events", "event_id").select("event_id", "user_id")
    e, user = F.col("event_id"), F.col("user_id")
    image = {
        "customer_id_se": F.when(user != 5, user),
        "trace_staff_id": F.when(e % 13 != 0, e % 1000),
        "recom_staff_id": (e * 7) % 1000,
        "serve_staff_id": ((e * 3) % 500).cast("string"),
    }
    return _records(rows, "staff", user, _envelope(image), e % 4, F.shiftright(e, 2))


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per order, locally out of id order, and a later second one for finished orders."""
    shipped = (
        source(spark, sf_dir, "lineitem", "l_orderkey")
        .groupBy("l_orderkey")
        .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    )
    orders = source(spark, sf_dir, "orders", "o_orderkey").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    rows = orders.join(shipped, orders.o_orderkey == shipped.l_orderkey, "left")
    last_revision = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    rows = rows.withColumn("rev", F.explode(F.sequence(F.lit(0), last_revision)))
    k, rev, state = F.col("o_orderkey"), F.col("rev"), F.col("o_orderstatus")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    ordered = F.timestamp_diff("SECOND", epoch, F.col("o_orderdate"))
    # mid-afternoon UTC, which is the next day further east
    signed_millis = F.timestamp_diff("SECOND", epoch, F.col("last_ship")) * 1000 + 61_200_000
    image = {
        "order_id": k,
        "customer_id": F.col("o_custkey"),
        "submit_time": F.when(k % 17 == 0, F.lit(0)).otherwise(ordered + rev * 3600),
        "ship_date": F.when(state != "O", F.date_format("first_ship", "yyyy-MM-dd HH:mm:ss")),
        "sign_date": F.when((state == "P") | (k % 6 == 0), None)
        .when(k % 2 == 0, F.date_format("last_ship", "yyyy-MM-dd"))
        .otherwise(signed_millis.cast("string")),
    }
    place = k + (k * 7919) % 50 + rev * 200
    return _records(rows, "order", k, _envelope(image), k % 50, place * 2 + rev)


def dirty_order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order log's shape over ``events``, with one kind of damage per event type and key."""
    rows = source(spark, sf_dir, "events", "event_id").select("event_id", "user_id")
    e = F.col("event_id")
    good = _envelope({"order_id": e, "customer_id": F.col("user_id"), "submit_time": e + 1})
    kind = e % 15
    value = (
        F.when(kind == 0, F.lit(None).cast("string"))
        .when(kind == 1, F.lit("not json"))
        .when(kind == 2, F.concat(F.lit("["), good, F.lit("]")))
        .when(kind == 3, F.concat(good, F.lit(" tail")))
        .when(kind == 4, F.concat(good, F.lit(" "), good))
        .when(kind == 5, F.regexp_replace(good, r"\]\}$", ""))
        .when(kind == 6, F.regexp_replace(good, '"data"', '"rows"'))
        .when(kind == 7, F.lit('{"data":[]}'))
        .when(kind == 8, F.regexp_replace(good, r'"submit_time":\d+', '"submit_time":"x"'))
        .when(kind == 9, F.regexp_replace(good, r'"order_id":\d+', '"order_id":null'))
        .when(kind == 10, F.regexp_replace(good, r"\]\}$", ",5]}"))
        .when(kind == 12, F.concat(good, F.lit('],"x":[1')))
        .when(kind == 13, F.concat(good, F.lit('],"end":2,"y":[3')))
        .when(kind == 14, F.regexp_replace(good, r'"order_id":(\d+)', '"order_id":$1.0'))
        .otherwise(good)
    )
    return _records(rows, "dirty", e, value, e % 4, F.shiftright(e, 2))


# Tables as they were before the logs ran. They cover a part of the keys only, so that updates,
# inserts and missing children all occur; the logs are always applied whole.


def prior_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents of the customers of two market segments."""
    known = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    k = F.col("c_custkey")
    values = {
        "id": k * 3 + 10,
        "customer_id": k,
        "name": F.concat(F.lit("old "), F.col("c_name")),
        "gender": F.lit(0),
        "birthday": F.lit(" "),
        "luna_birthday": F.lit(" "),
        "province": F.lit(0),
        "city": F.lit(0),
        "district": F.lit("old"),
        "handset": F.lit(0),
        "handset2": F.lit(0),
        "qq_code": F.lit(0),
        "ty_code": F.lit(None),
    }
    return _shaped(known, "base", values)


def prior_oa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of those parents, missing for customers in debt."""
    known = table(spark, sf_dir, "customer").filter(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_acctbal") >= 0)
    )
    k = F.col("c_custkey")
    values = {name: F.lit(1) if kind in ("int", DECIMAL) else F.lit("old") for name, kind in OA_COLUMNS.items()}
    values |= {name: F.lit("old") for name in SKIN_VALUES[1:]}
    return _shaped(known, "oa", {"base_id": k * 3 + 10, "customer_id": k, **values})


def prior_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staff rows of the customers of one market segment."""
    known = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    k = F.col("c_custkey")
    values = {
        "id": k + 100,
        "customer_id": k,
        "trace_staff_id": F.lit(1),
        "recom_staff_id": F.lit(2),
        "serve_staff_id": F.lit(3),
    }
    return _shaped(known, "customer_info", values)


def prior_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent and high-priority orders of the first tenth of the id range."""
    orders = table(spark, sf_dir, "orders")
    first_tenth = orders.agg(F.max("o_orderkey")).scalar()
    known = orders.filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderkey") * 10 <= first_tenth)
    )
    values = {
        "customer_id": F.col("o_custkey"),
        "order_id": F.col("o_orderkey"),
        "submit_time": F.lit(1),
        "ship_time": F.lit(0),
        "sign_time": F.lit(0),
        "status": F.lit("old"),
    }
    return _shaped(known, "order_status", values)


def _shaped(rows: DataFrame, name: str, values: dict[str, Column]) -> DataFrame:
    return rows.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in table_schema(name)])


def prior_ledger(log: DataFrame, group: str) -> DataFrame:
    """A ledger that stopped halfway through every partition but the last one, which it lacks,
    next to a row of another group."""
    reached = log.groupBy("topic", "partition").agg(F.max("offset").alias("last"))
    newest = F.max("partition").over(Window.partitionBy("topic"))
    half = reached.withColumn("newest", newest).filter(F.col("partition") < F.col("newest"))
    own = half.select(
        F.lit(group).alias("groupid"), "topic", "partition", F.floor(F.col("last") / 2).alias("untilOffset")
    )
    other = half.select(F.lit("other").alias("groupid"), "topic", "partition", F.lit(1).alias("untilOffset"))
    both = own.unionByName(other)
    return both.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA])
