"""From raw documents to packed sequences: five stages, each of which works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfbook.llm.mixing import mixed
from shelfbook.llm.near_text import without_near_copies
from shelfbook.llm.packing import packed
from shelfbook.llm.pseudonyms import pseudonymised
from shelfbook.llm.quality import accepted
from shelfbook.session import durable

#: Stands for the caller's secret, as in the registered queries.
KEY = "registered-queries"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, similarity of 0.8 or more."""
    return without_near_copies(docs, k=5, percent=80)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms in the place of personal data."""
    return pseudonymised(docs, KEY)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of its sources takes it."""
    return mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the words of each document go in the packed sequences."""
    return packed(docs)


STAGES = [
    ("quality", quality_rules),
    ("near_copies", near_copies),
    ("private_data", private_data),
    ("mixing", source_mix),
    ("packing", sequences),
]

#: Hashed trees and keyed permutations have no SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
