"""From raw documents to packed sequences: five operators, each stage written as Parquet and read again.

The stages take what their predecessor kept, whole; every stage but the last returns the columns of
``documents``. Nulls, empty texts, repeated rows and extra columns are handled as each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm import exact_dedup, mixing, near_dedup, packing, quality_ledger
from tradeloom.llm.common import importable, keep
from tradeloom.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail a rule of the current policy."""
    return quality_ledger.filter_quality(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays."""
    return exact_dedup.drop_copies(docs, exact_dedup.new_index(spark))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-copy group stays: shingles of five words, similarity 0.8."""
    importable(spark)
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate says."""
    return mixing.emit(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    importable(spark)
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("near dedup", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs


#: Hash draws and the tokenizer have no SQL; the stages are tested against brute force.
ORACLE_SQL = None
