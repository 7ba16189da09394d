"""Registered queries of the operators, with SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parampipe.llm import (
    bpe,
    chat,
    html_text,
    kdtree,
    lines,
    mixing,
    ngram,
    periodic,
    quality,
    simhash,
    topk,
    toxicity,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rank file of the vocabulary.
RANKS = "byte_bpe_multi_50k.tiktoken"
# Target weights of the mix, in shares of a cycle of blocks.
SOURCE_SHARES = {f"src{i}": 1 + i % 4 for i in range(20)}


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.dialogues(chat.messages(table(spark, sf_dir, "conversations")))
    return rows.withColumn("spans", chat.spans_text(F.col("spans")))


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = lines.dedup_lines(docs)
    return rows.select("doc_id", "n_lines", "n_kept", F.sha2("text", 256).alias("text_sha256"))


def op5_pfair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents"), SOURCE_SHARES)
    return rows.select("doc_id", "source", "block", "slot", "position")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5)
    return found.withColumnRenamed("id", "vec_id")


def op4_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kdtree.shard_by_tree(table(spark, sf_dir, "documents"), shards=8)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return rows.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op7_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.score_documents(table(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_on_sample(docs, table(spark, sf_dir, "labels"))
    return quality.judge_documents(docs, model)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_repeated_tail(table(spark, sf_dir, "documents"))
    return periodic.run_digests(periodic.periodic_runs(docs))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).drop("text")


def op13_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return rows.withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_lines": op2_lines,
    "op3_topk": op3_topk,
    "op4_kdtree": op4_kdtree,
    "op5_pfair": op5_pfair,
    "op6_simhash": op6_simhash,
    "op7_ngram": op7_ngram,
    "op8_html": op8_html,
    "op9_bpe": op9_bpe,
    "op10_quality": op10_quality,
    "op11_runs": op11_runs,
    "op12_toxicity": op12_toxicity,
    "op13_whiten": op13_whiten,
}

ORACLE: dict[str, str] = {
    "op1_chat": """
        WITH m AS (
            SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS content
            FROM conversations
        ), v AS (
            SELECT m.*, p.perspective,
                '<|im_start|>' || CASE WHEN speaker = 'system' THEN speaker WHEN speaker = perspective
                    THEN 'assistant' ELSE 'user name=' || speaker END || chr(10) AS opening
            FROM m JOIN (SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> 'system') p
            ON m.conv_id IS NOT DISTINCT FROM p.conv_id
        ), s AS (
            SELECT *, opening || content || '<|im_end|>' || chr(10) AS piece,
                row_number() OVER (PARTITION BY conv_id, perspective
                    ORDER BY turn NULLS LAST, speaker, content) AS row FROM v
        ), t AS (
            SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY conv_id, perspective ORDER BY row
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM s
        )
        SELECT conv_id, perspective, start // 65536 AS chunk, count(*) AS n_messages,
            string_agg(piece, '' ORDER BY row) AS text,
            coalesce(string_agg((start + length(opening)) || '-' || (start + length(piece) - 1), ','
                ORDER BY row) FILTER (speaker = perspective), '') AS spans
        FROM t GROUP BY conv_id, perspective, start // 65536
    """,
    "op3_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
}
