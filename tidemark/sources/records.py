"""Scans of change logs: a topic, or files with the same columns."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

RECORD_COLUMNS = RECORD_SCHEMA.fieldNames()

# Intake ceiling per topic partition and batch interval.
RECORDS_PER_SECOND = 300
BATCH_SECONDS = 5


def scan_log(
    spark: SparkSession, path: str, *, stream: bool = False, format: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Kafka-shaped records from a directory of files, as a batch or a stream."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.schema(RECORD_SCHEMA).format(format).load(path)


def topic_options(servers: str, topic: str, partitions: int, starting_offsets: str = "earliest") -> dict[str, str]:
    """Options of a topic scan. The intake cap is per topic, so it grows with its partitions."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": str(RECORDS_PER_SECOND * BATCH_SECONDS * partitions),
        "failOnDataLoss": "true",
    }


def scan_topic(spark: SparkSession, options: dict[str, str], *, stream: bool = True) -> DataFrame:
    """Same columns as ``scan_log`` from a topic. Needs the Kafka connector on the class path."""
    if stream:
        reader = spark.readStream
    else:
        reader = spark.read
        options = {name: value for name, value in options.items() if name != "maxOffsetsPerTrigger"}
    records = reader.format("kafka").options(**options).load()
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def starting_offsets(stored: dict[str, dict[int, int]], partitions: dict[str, int]) -> str:
    """``startingOffsets`` JSON. Every partition is listed; one without a stored offset starts at
    the earliest record (-2). With nothing stored at all the scan starts at earliest."""
    if not any(stored.values()):
        return "earliest"
    plan = {
        topic: {str(p): stored.get(topic, {}).get(p, -2) for p in range(count)} for topic, count in partitions.items()
    }
    return json.dumps(plan, sort_keys=True)


# Offsets of one range of a laid-out log: 2**RANGE_BITS.
RANGE_BITS = 20


# Folders that one call of ``write_ranges`` makes at most, next to one per topic partition.
MOST_FOLDERS = 1024


def _joined_bits(records: DataFrame, bits: int) -> int:
    """The least power of two of neighbouring ranges to a folder with which ``records`` fill no more than ``MOST_FOLDERS``. One
    number per topic partition is read on the way, a single one by the driver."""
    first, last = F.shiftright(F.min("offset"), bits), F.shiftright(F.max("offset"), bits)
    spans = records.groupBy("topic", "partition").agg((last - first).alias("span"))
    span = spans.agg(F.sum(F.col("span").cast("decimal(38,0)"))).head()[0]
    joined = 0
    while span is not None and int(span) >> joined > MOST_FOLDERS:
        joined += 1
    return joined


def write_ranges(records: DataFrame, path: str, bits: int = RANGE_BITS) -> None:
    """Append ``records`` to a log laid out by topic, partition and range of offsets, so that a resumed scan opens what is pending only.

    A folder goes by its last range. It has one range, or for records that span many, some neighbouring ones, so folders do not
    grow in number with the log. Rows lie in order of their offsets, by which a scan skips what is done in a folder. ``records`` is read
    twice, the first time for its offsets only.
    """
    joined = _joined_bits(records, bits)
    last_range = F.shiftright("offset", bits).bitwiseOR(F.lit((1 << joined) - 1).cast("bigint"))
    placed = records.withColumn("range", last_range)
    # rebalancing gathers a folder's rows in few files and splits a folder that is too big
    placed = placed.hint("rebalance", "topic", "partition", "range").sortWithinPartitions("topic", "partition", "range", "offset")
    placed.write.mode("append").partitionBy("topic", "partition", "range").parquet(path)


def scan_ranges(spark: SparkSession, path: str, stored: dict[str, dict[int, int]] | None = None, bits: int = RANGE_BITS) -> DataFrame:
    """Records of a laid-out log, from the ``stored`` offsets on (of ``ledger.stored_offsets``); partitions that are not stored are read whole.

    The starts are a filter on the folders' columns, one literal per topic partition, so folders whose last range is finished are neither listed
    in the scan nor opened; the offset filter is then pushed into the first pending folder.
    """
    schema = T.StructType([*RECORD_SCHEMA, T.StructField("range", T.LongType())])
    log = spark.read.schema(schema).parquet(path)
    starts = [(f"{topic}/{partition}", start) for topic, found in (stored or {}).items() for partition, start in found.items()]
    if starts:
        known = F.create_map(*[F.lit(value) for pair in starts for value in pair])
        start = F.coalesce(F.try_element_at(known, F.concat("topic", F.lit("/"), F.col("partition"))), F.lit(0)).cast("bigint")
        log = log.filter(F.col("range") >= F.shiftright(start, bits)).filter(F.col("offset") >= start)
    return log.select(*RECORD_COLUMNS)
