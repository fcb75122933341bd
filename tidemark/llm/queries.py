"""The registered query of each operator: the operator over its whole table, with its contract's parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, divergence, jaccard, lm, mixing, negatives, quality, records, sharding, simhash, sketch, topk, toxicity
from tidemark.llm.shared import WORD, id_remainder, with_package

SEED = 20


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_package(spark).read.parquet(f"{sf_dir}/documents.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards, row counts at most one apart. A null text has size 8 and the crc32 of no bytes."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = _documents(spark, sf_dir).select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = sharding.deal(rows, F.col("doc_id"), shards=24, seed=SEED)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _mixed(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    return mixing.mix(docs, F.col("doc_id"), F.col("source"), size, weights=(3, 1, 2), share=1.5, most=2, shards=24, seed=SEED)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words each document gives to the mix, and the shards of its copies."""
    mixed = _mixed(_documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "shards")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document and the bytes they decode to, as digests."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(_documents(spark, sf_dir), "doc_id", "text", ranks=ranks, pattern=public_tokenizers.PATTERN)


def _scored(docs: DataFrame, score: Column, folds: int, held_out: int) -> DataFrame:
    """Every document's fold, score and decision at 0.3."""
    rows = docs.select("doc_id", (id_remainder(F.col("doc_id"), folds) == held_out).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    docs = _documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), folds=5, held_out=0)
    return _scored(docs, quality.score_column(model, F.col("text")), 5, 0)


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best scores of every query."""
    vectors = with_package(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_scores(vectors, "vec_id", "embedding", F.col("id") % 20 == 0, k=20, scale=64)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return simhash.near_duplicates(_documents(spark, sf_dir), "doc_id", "text", shingle=3, seed=42, reach=3)


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every document."""
    return lm.score(_documents(spark, sf_dir), "doc_id", "text", folds=7, held_out=2)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs = _documents(spark, sf_dir)
    lexicon = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), folds=4, held_out=2)
    return _scored(docs, toxicity.score_column(lexicon, F.col("text")), 4, 2)


def op9_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint against that of its edited text and of the next document."""
    return sketch.compare_with_next(_documents(spark, sf_dir), "doc_id", "text")


def op10_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to record files and read back."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    folder = records.write(_documents(spark, sf_dir), "doc_id", "text", tokenizer=tokenizer, end_id=1)
    index = spark.read.parquet(f"{folder}/index")
    return records.read(index, firsts=records.first_ids(index)).drop("ids")


def op11_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of 90 % common 3-word shingles."""
    return jaccard.near_documents(_documents(spark, sf_dir), "doc_id", "text", shingle=3, percent=90)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each source of a language is from its others, and the terms that set it off."""
    return divergence.audit(_documents(spark, sf_dir), "text", "lang", "source", least=10, top=10)


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor's positives."""
    vectors = with_package(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    new_label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors, "vec_id", "embedding", "label", is_anchor=F.col("id") % 100 == 0, new_label=new_label, scale=256, positives=5, negatives=10)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_mixing": op2_mixing,
    "op3_bpe": op3_bpe,
    "op4_quality": op4_quality,
    "op5_topk": op5_topk,
    "op6_simhash": op6_simhash,
    "op7_lm": op7_lm,
    "op8_toxicity": op8_toxicity,
    "op9_sketch": op9_sketch,
    "op10_records": op10_records,
    "op11_jaccard": op11_jaccard,
    "op12_divergence": op12_divergence,
    "op13_negatives": op13_negatives,
}

#: SQL twins, where SQL can say the same.
ORACLES: dict[str, str] = {
    "op5_topk": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS g FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM (
                SELECT q.r, q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.g, d.g) AS BIGINT) AS score
                FROM v q JOIN v d ON q.r <> d.r WHERE q.vec_id % 20 = 0))
        WHERE rank <= 20""",
    "op12_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        t AS (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
        langs AS (SELECT lang, sum(total) AS n, count(*) AS v FROM kept GROUP BY lang),
        groups AS (SELECT DISTINCT lang, source FROM d),
        counts AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
        cells AS (
            SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang, g.source) AS n, l.v,
                1 + CAST(1000000000 AS HUGEINT) * (k.total + 2) // (l.n + 2 * l.v) AS q
            FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
            LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        shares AS (SELECT lang, source, term, c, q, 1 + CAST(1000000000 AS HUGEINT) * (c + 2) // (n + 2 * v) AS p FROM cells),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(max(s.value), 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (
                SELECT x.lang, x.source AS one, y.source AS two, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
                FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
            ) s ON s.lang = a.lang AND s.one = a.source AND s.two = b.source
            GROUP BY a.lang, a.source, b.source),
        terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM shares WHERE c > 0 AND p > q)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        WHERE part = 'pair' OR rank <= 10""",
    "op13_negatives": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS g FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (
            SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, positive_id NULLS LAST, o) AS n FROM (
                SELECT a.r, a.id, a.label, a.g, b.r AS o, b.id AS positive_id, CAST(list_inner_product(a.g, b.g) AS BIGINT) AS score
                FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r WHERE a.id % 100 = 0)
            QUALIFY n <= 5),
        h AS (
            SELECT p.id AS anchor_id, positive_id, row_number() OVER (PARTITION BY p.r, p.o ORDER BY s DESC, negative_id NULLS LAST, o2) AS rank,
                negative_id, score AS positive_score, s AS negative_score
            FROM (
                SELECT p.*, b.r AS o2, b.id AS negative_id, CAST(list_inner_product(p.g, b.g) AS BIGINT) AS s
                FROM p JOIN v b ON b.label <> p.label) p
            WHERE 30 * score <= 100 * s AND 100 * s <= 90 * score
            QUALIFY rank <= 10)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM h""",
}
