"""Target tables kept as bucketed, sorted tables: a large batch is shuffled to the target's buckets, the target itself is not.

``save`` writes a catalog table; ``target`` reads it. The write rules take the result as any other table: a join on the bucket key then has no
exchange above the target, however large both are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The key that a table's rows are looked up by.
LOOKUP_KEYS = {"base": "customer_id", "oa": "base_id", "customer_info": "customer_id", "order_status": "order_id"}


def save(rows: DataFrame, name: str, table: str, buckets: int) -> None:
    """Write ``rows`` of the target ``name`` as the catalog table ``table``, one file per bucket. ``table`` is replaced; write the state after a batch
    under another name than the one that it was read from."""
    key = LOOKUP_KEYS[name]
    rows.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def target(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
