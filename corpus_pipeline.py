"""A corpus pipeline of five stages over documents; each is one of the library's operators.

Language ID drops texts without a known language, exact deduplication keeps one row of equal texts,
the Jaccard join keeps one document of each near-duplicate group (five-word shingles, similarity 0.8),
decontamination drops documents that hold a benchmark item, and packing cuts what is left into
sequences. Every stage but the last returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from segmill.llm.common import read_table, stage
from segmill.llm.exact_dedup import drop_copies
from segmill.llm.jaccard_join import keep_one
from segmill.llm.langid import keep_known
from segmill.llm.packing import pack_documents
from segmill.llm.string_tiling import drop_contaminated


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known(spark, docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(spark, docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(spark, docs)


STAGES = [("language_id", language), ("exact_dedup", exact), ("jaccard_join", near), ("decontamination", decontaminate), ("packing", pack)]
#: SQL can express neither the network nor the tiling; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each but the last is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
