"""The corpus pipeline: from raw documents to token ids, stage by stage.

``STAGES`` lists (name, function); a function takes the session, the documents that the stage before it kept, and the folder of the input
tables (for labels), and returns a DataFrame. ``run`` writes each stage's rows as parquet in the shared folder and reads them
back, so a lost executor never costs more than one stage. All stages but the last return the columns of the documents.

In every stage a null text is the empty one, very long texts are taken whole, an empty table gives an empty one, and rows that are equal throughout
are treated alike but for the near copies, of which one row stays.

No SQL twin: the classifiers and the near-duplicate components cannot be said in SQL.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, mixing, quality, simhash, toxicity
from tidemark.llm.shared import WORD, shared_folder, with_package

#: From this score on, a document is good, or toxic.
DECISION = 0.3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier rejects. Rows without labels, or with a null id, are scored like any other."""
    model = quality.train(docs, with_package(spark).read.parquet(f"{sf_dir}/labels.parquet"), folds=5, held_out=0)
    return docs.where(quality.score_column(model, F.col("text")) >= DECISION)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the toxicity classifier rejects. Rows without labels, or with a null id, are scored like any other."""
    lexicon = toxicity.train(docs, with_package(spark).read.parquet(f"{sf_dir}/labels.parquet"), folds=4, held_out=2)
    return docs.where(toxicity.score_column(lexicon, F.col("text")) < DECISION)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each near-duplicate component, one row where several have it; texts without words are near copies of
    each other."""
    with_package(spark)
    return simhash.one_per_group(docs, "doc_id", "text", shingle=3, seed=42, reach=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes every document as often as the mix does: sources weigh 3, 1, 2 in turn and share 150% of all words, none more than twice its own. A null
    source is one like any other, and the last."""
    with_package(spark)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    mixed = mixing.mix(docs, F.col("doc_id"), F.col("source"), size, weights=(3, 1, 2), share=1.5, most=2, shards=24, seed=20)
    return mixing.drawn_rows(mixed)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The byte-level token ids of every row, with their digests; repeated rows give a row each."""
    with_package(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, "doc_id", "text", ranks=ranks, pattern=public_tokenizers.PATTERN, with_ids=True, keep_tables=False)


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("mix", mix_sources),
    ("tokens", encode_tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is a scan of the last one's table."""
    docs = with_package(spark).read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        rows = stage(spark, docs, sf_dir)
        rows.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(rows.schema).parquet(f"{folder}/{name}")
    return docs
