"""Target tables kept in a relational store, read as whole tables over JDBC.

The connection options (url, user, password, driver) come from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_options(
    connection: dict[str, str], table: str, *, key: str, lower: int, upper: int, partitions: int
) -> dict[str, str]:
    """Options of a parallel scan: ``partitions`` ranges of the numeric ``key``."""
    return {
        **connection,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
    }


def scan_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
