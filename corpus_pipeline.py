"""Corpus pipeline: quality classifier, exact de-duplication, SimHash near-de-duplication, mixing, tokenizing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on everything its predecessor kept; its
result is written as Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``docs``, whatever their names, and an empty table passes as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestkit.llm import bpe, exact_dedup, mixing, quality_classifier, simhash
from ingestkit.llm.catalog import tokenizer
from ingestkit.llm.common import fresh, relieve, table, written


def classify_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Null and empty texts are judged by the model's
    intercept, repeated rows alike; without labels of both classes nothing is told apart."""
    return quality_classifier.accepted(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays; null counts as empty, a null id as least, and of
    rows equal in both one stays."""
    relieve(spark)
    return exact_dedup.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component the document with the smallest id stays; texts without words are one
    component, a null id stays only where its component has no other, and ties keep one row."""
    relieve(spark)
    return simhash.drop_near_duplicates(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; texts without words are never taken, a null source is a
    source of its own, and rows of one id and text are taken alike."""
    relieve(spark)
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes every document: its other columns, then ``n_tokens``, ``ids`` (little-endian 32-bit) and
    ``decoded_sha256`` of the bytes that the ids decode to, which is the digest of the text. Null and empty
    texts have no ids and the digest of no bytes; documents that repeat stay as often as they come.

    The ids are written before they are decoded: a chain of Python steps in one task has a worker process for
    each, which an executor keeps for all later stages."""
    relieve(spark)
    path, pattern = tokenizer()
    tokens = bpe.encode_rows(docs, path, pattern)
    ids, decoded, digest = tokens.columns[-1], fresh(tokens, "decoded"), fresh(tokens, "decoded_sha256")
    tokens = written(tokens, "tokens")
    relieve(spark)
    tokens = bpe.decode(tokens, path, ids, decoded)
    return tokens.withColumn(digest, F.sha2(decoded, 256)).drop(decoded)


STAGES = [
    ("quality_classifier", classify_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("mixing", mix_stage),
    ("byte_bpe", token_stage),
]

#: Fitted scores, fingerprints and token ids are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
