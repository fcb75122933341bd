"""Written intermediates.

A result that several branches of a plan read is written once as parquet in the shared folder and
read back. Each reader then scans only the columns it needs, join sides have exact sizes, and a lost
executor costs a re-read rather than a recomputation of the whole lineage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[str] = ContextVar("stage_scope", default="session")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder named by ``spark.checkpoint.dir``. Only a local session
    may leave that unset: it gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = _local_folder()
    return f"{folder}/tidemark/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{_scope.get()}/{name}-{uuid.uuid4().hex}"


def write_once(rows: DataFrame, name: str) -> str:
    """Write ``rows`` as parquet to a new place in the shared folder and return its path."""
    path = new_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return path


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write ``rows`` once and return them as a scan."""
    return rows.sparkSession.read.schema(rows.schema).parquet(write_once(rows, name))


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Drops everything staged inside the block when it ends. Without a scope, staged data lives as
    long as the folder's ``tidemark/<application id>``."""
    name = f"scope-{uuid.uuid4().hex}"
    token = _scope.set(name)
    try:
        yield
    finally:
        _scope.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
