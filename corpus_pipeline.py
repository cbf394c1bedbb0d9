"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapewright.llm import kneser_ney, packing, pii, quality_rules, simhash
from tapewright.llm.common import ROWS_READ, small_batches, written
from tapewright.llm.queries import trusted
from tapewright.session import configure
from tapewright.sources.tables import parquet


def settings(spark: SparkSession) -> None:
    """Batches for tables of whole texts, for what is read and for what goes to Python."""
    small_batches(configure(spark)).conf.set(*ROWS_READ)


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    settings(spark)
    return quality_rules.filtered(docs)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is ordinary for their language."""
    settings(spark)
    return kneser_ney.filtered(docs, trusted(spark, sf_dir))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (fingerprints of three-word shingles, three bits): the one with the smallest id."""
    settings(spark)
    return simhash.representatives(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    settings(spark)
    return pii.clean(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and places in the training sequences."""
    settings(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("simhash", simhash_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# Perplexities, boosted trees and token ids are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn, each written as a table in the shared folder and read again."""
    docs = parquet(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
