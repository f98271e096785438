"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ragstone.llm import ann, bpe, packing, pii, quality, set_join, sharding, token_files, url_filter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(_table(spark, sf_dir, "documents"), bounded=False)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), n_shards=40)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_round_trip(_table(spark, sf_dir, "documents"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op8_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_sharding": op2_sharding,
    "op3_bpe": op3_bpe,
    "op4_token_files": op4_token_files,
    "op5_nearest": op5_nearest,
    "op6_pii": op6_pii,
    "op7_url_filter": op7_url_filter,
    "op8_set_join": op8_set_join,
    "op9_warc": op9_warc,
    "op10_packing": op10_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op1_quality": quality.ORACLE_SQL,
    "op7_url_filter": url_filter.ORACLE_SQL,
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        c AS (SELECT html, max(page_id) AS last_id FROM p WHERE strlen(html) >= 1000 GROUP BY html)
        SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
               CASE WHEN c.last_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN c.last_id <> p.page_id THEN c.last_id END AS refers_to
        FROM p LEFT JOIN c ON p.html = c.html
    """,
}
