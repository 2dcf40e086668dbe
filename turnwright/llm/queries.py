"""One thin query for each training-data operator, over its whole table and with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from turnwright.llm import chat_format, decontaminate, embedding_dedup, mixing, near_dedup, secret_scan
from turnwright.llm.chat_format import rotate_perspectives
from turnwright.llm.common import table, vocabulary
from turnwright.llm.decontaminate import find_leaks
from turnwright.llm.embedding_dedup import near_vectors
from turnwright.llm.html_text import page_texts
from turnwright.llm.mixing import mix
from turnwright.llm.near_dedup import near_duplicates
from turnwright.llm.quality import quality_scores
from turnwright.llm.secret_scan import scan_secrets, secret_digest
from turnwright.llm.token_counts import token_counts
from turnwright.llm.token_files import token_files


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)


def op3_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate_perspectives(table(spark, sf_dir, "conversations"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.95)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), words=5, least=0.8)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(scan_secrets(table(spark, sf_dir, "documents")))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_token_files": op2_token_files,
    "op3_chat_perspectives": op3_chat_perspectives,
    "op4_quality": op4_quality,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_mix_sources": op8_mix_sources,
    "op9_secret_scan": op9_secret_scan,
    "op10_html_text": op10_html_text,
}

ORACLES: dict[str, str] = {
    "op3_chat_perspectives": chat_format.ORACLE,
    "op5_minhash_near_dedup": near_dedup.ORACLE,
    "op6_embedding_near_dedup": embedding_dedup.ORACLE,
    "op7_decontaminate": decontaminate.ORACLE,
    "op8_mix_sources": mixing.ORACLE,
    "op9_secret_scan": secret_scan.ORACLE,
}
