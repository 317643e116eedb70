"""The thin queries of this package over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from blockflow.llm.common import held_out
from blockflow.llm.language import language_digest
from blockflow.llm.media import media_digest
from blockflow.llm.ngram import ngram_digest
from blockflow.llm.oracle import quality_sql
from blockflow.llm.packing import packing_digest
from blockflow.llm.pieces import pieces_digest
from blockflow.llm.quality import quality_digest
from blockflow.llm.secrets import secret_digest
from blockflow.llm.simhash import simhash_digest
from blockflow.llm.toxicity import toxicity_digest
from blockflow.llm.urls import url_digest
from blockflow.runtime import read_table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), ~held_out(3, 1))


def op2_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_digest(read_table(spark, sf_dir, "documents"), ~held_out(5, 1))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_digest(read_table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_digest(read_table(spark, sf_dir, "documents"), ~held_out(4, 2))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_digest(read_table(spark, sf_dir, "documents"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_digest(read_table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_digest(read_table(spark, sf_dir, "documents"))


def op9_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digest(read_table(spark, sf_dir, "embeddings"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(read_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_ngram, op3_packing, op4_language, op5_quality, op6_pieces, op7_urls, op8_simhash, op9_chroma, op10_secrets, pipeline)}


def oracle_sql() -> dict[str, str]:
    """The others fit models, use hashes or tokenizers that SQL lacks, or iterate; their tests hold them to brute force."""
    return {"op5_quality": quality_sql()}
