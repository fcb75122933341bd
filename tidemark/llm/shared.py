"""What several operators use: reliable checkpoints, global row numbers, fold of a document id."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Lower-cases A-Z and leaves every other character as it is.
LOWER_AZ = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

_TO_SPACE = {c: " " for c in range(0x09, 0x0E)}
#: Where ``str.split`` cuts and ``WORD`` doesn't.
_OTHER_BLANK = re.compile(r"[^\S\x20\x09-\x0D]")


def words(text: str) -> list[str]:
    """The runs of ``WORD`` in ``text``."""
    if _OTHER_BLANK.search(text):
        return [w for w in text.translate(_TO_SPACE).split(" ") if w]
    return text.split()


def with_package(spark: SparkSession) -> SparkSession:
    """Lets Python workers find this package where it is not installed but lies at the same path, as in a local session."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session that has none gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="tidemark-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def checkpointed(rows: DataFrame) -> DataFrame:
    """``rows`` written once to the shared checkpoint folder; a lost executor costs a re-read."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint()


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a parquet table in the shared folder; a lost executor costs a re-read, a reader takes only its columns."""
    path = f"{shared_folder(rows.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def id_remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def broadcast_if_small(rows: DataFrame, count: int, most: int = 200_000) -> DataFrame:
    """A broadcast hint for at most ``most`` rows; beyond, the planner joins by a shuffle."""
    return F.broadcast(rows) if count <= most else rows


def text_slices(batches: Iterable[pa.RecordBatch], text: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that each holds about ``most`` bytes of ``text``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.frombuffer(pc.fill_null(pc.binary_length(batch.column(text)), 0).cast(pa.int64()).buffers()[1], dtype=np.int64)[: batch.num_rows]
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(start, end - start)


def number_rows(rows: DataFrame, *order: Column) -> tuple[DataFrame, list[int]]:
    """``rows`` in the given total order, as a checkpoint, with ``_part`` and ``_place`` (the row's place in its
    part, from 0), and the first row number of each part. The row number is ``firsts[_part] + _place``.

    One range shuffle. The driver sees one count per partition.
    """
    ordered = checkpointed(rows.orderBy(*order))
    mark = F.monotonically_increasing_id()
    placed = ordered.select("*", F.shiftright(mark, 33).cast("int").alias("_part"), mark.bitwiseAND((1 << 33) - 1).alias("_place"))
    counts = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    sizes = [counts.get(p, 0) for p in range(max(counts, default=-1) + 1)]
    return placed, [0, *np.cumsum(sizes).tolist()]
