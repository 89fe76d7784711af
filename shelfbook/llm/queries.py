"""Queries of the numbered operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from shelfbook.llm import sql
from shelfbook.llm.language import languages_held_out
from shelfbook.llm.lines import line_digests
from shelfbook.llm.mixing import mix_report
from shelfbook.llm.near_text import near_text_classes
from shelfbook.llm.near_vectors import near_vector_classes
from shelfbook.llm.packing import packed, token_matrices
from shelfbook.llm.prefix_trie import trie_nodes
from shelfbook.llm.pseudonyms import pseudonym_report
from shelfbook.llm.quality import quality_report
from shelfbook.llm.search import ranked_documents
from shelfbook.llm.substrings import passage_digests
from shelfbook.llm.toxicity import toxicity_held_out

#: Stands for the caller's secret in the registered queries; jobs pass their own.
KEY = "registered-queries"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_held_out(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op2_near_text(spark: SparkSession, folder: str) -> DataFrame:
    return near_text_classes(_table(spark, folder, "documents"), k=3, percent=85)


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(_table(spark, folder, "documents"))


def op4_token_matrices(spark: SparkSession, folder: str) -> DataFrame:
    return token_matrices(_table(spark, folder, "documents"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_report(_table(spark, folder, "documents"))


def op6_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passage_digests(_table(spark, folder, "documents"))


def op7_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonym_report(_table(spark, folder, "documents"), KEY)


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    return languages_held_out(_table(spark, folder, "documents"))


def op9_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vector_classes(_table(spark, folder, "embeddings"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_report(_table(spark, folder, "documents"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_documents(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_digests(_table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie_nodes(_table(spark, folder, "conversations"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_toxicity, op2_near_text, op3_packing, op4_token_matrices, op5_mixing, op6_passages, op7_pseudonyms, op8_language,
        op9_near_vectors, op10_quality, op11_ranked_search, op12_lines, op13_prefix_trie, pipeline,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_mixing": sql.MIXING, "op6_passages": sql.PASSAGES, "op10_quality": sql.QUALITY, "op11_ranked_search": sql.SEARCH,
        "op12_lines": sql.LINES, "op13_prefix_trie": sql.PREFIXES,
    }
