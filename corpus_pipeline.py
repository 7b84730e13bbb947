"""Corpus pipeline: language ID, near duplicates, benchmark decontamination, secret scans, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All stages
but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpanel.llm import bpe, decontaminate, langid, neardup, secretscan
from gridpanel.llm.common import materialise, read_table

MIN_SCORE = 0.3         # of four languages or more, a text below it looks like none


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the net recognises: no ``und``, score of ``MIN_SCORE`` or more."""
    return langid.keep_recognised(docs, langid.fit(docs.filter(~langid.held_out(F.col("doc_id")))), MIN_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group linked by five-word shingles at 0.8."""
    return neardup.keep_one(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every reported secret replaced; ``n_chars`` follows the text."""
    changed = secretscan.redact(docs)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return changed


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids (little-endian unsigned 32-bit) of every document; a text that does not come
    back from its ids is an error."""
    import public_tokenizers
    voc = bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encode_checked(docs, voc)


STAGES = [("language_id", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secret_scan", secrets), ("byte_bpe", tokens)]
#: a trained net and a vocabulary file are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
