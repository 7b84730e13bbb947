"""Registered queries of this subpackage: each operator over its whole table."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (bpe, chat, cluster, decontaminate, langid, neardup, pii, secretscan, shards, topk, urlfilter, warc,
               whiten)
from .common import read_table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    voc = bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encode_decode_digest(read_table(spark, sf_dir, "documents"), voc)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.find_secrets(read_table(spark, sf_dir, "documents"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_digest(read_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest_query(read_table(spark, sf_dir, "pages"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(read_table(spark, sf_dir, "pages"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_digest(read_table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_digest(read_table(spark, sf_dir, "conversations"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten_digest(read_table(spark, sf_dir, "embeddings"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(read_table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.cluster(read_table(spark, sf_dir, "embeddings"))


QUERIES = (op1_byte_bpe, op2_language_id, op3_secret_scan, op4_top_k, op5_decontamination, op6_near_duplicates,
           op7_warc, op8_url_filter, op9_shards, op10_chat_format, op11_whitening, op12_personal_data, op13_centroids)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict:
    """DuckDB SQL where it can express the operator; the others are tested against brute force."""
    return {"op3_secret_scan": secretscan.ORACLE, "op4_top_k": topk.ORACLE, "op6_near_duplicates": neardup.ORACLE,
            "op7_warc": warc.ORACLE, "op8_url_filter": urlfilter.ORACLE, "op12_personal_data": pii.ORACLE,
            "op13_centroids": cluster.ORACLE}
