"""Registered queries of the subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestkit.llm import (
    bpe,
    centroids,
    chat,
    divergence,
    exact_dedup,
    mixing,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    toxicity,
    warc,
)
from ingestkit.llm.common import table, written


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = "</s>[INST] ok [/INST]"
    extra = [(-1, 0, "user", marks), (-1, 1, "assistant", marks)]
    extra = spark.createDataFrame(extra, "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(written(chat.formatted(chat.chains(turns)), "chat"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("row_id")


def tokenizer() -> tuple[str, str]:
    """Rank file and pattern of the registered queries; operators take any."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer()
    tokens = bpe.encode(table(spark, sf_dir, "documents"), path, pattern)
    return bpe.decode(tokens, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(warc.record_rows(table(spark, sf_dir, "pages")))
    return warc.pages_back(warc.read_archives(manifest))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings")).drop("checked")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_mixing,
        op3_chat_format,
        op4_exact_dedup,
        op5_byte_bpe,
        op6_warc,
        op7_sharding,
        op8_simhash,
        op9_quality_classifier,
        op10_substring_dedup,
        op11_centroids,
        op12_source_divergence,
        op13_toxicity,
    )
}

#: DuckDB SQL; fingerprints with components, token ids and fitted scores are not SQL.
SQL: dict[str, str] = {
    "op1_quality_rules": quality_rules.oracle_sql(),
    "op2_mixing": mixing.ORACLE,
    "op3_chat_format": chat.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op6_warc": warc.ORACLE,
    "op7_sharding": sharding.ORACLE,
    "op10_substring_dedup": substring_dedup.ORACLE,
    "op11_centroids": centroids.oracle_sql(),
    "op12_source_divergence": divergence.ORACLE,
}
