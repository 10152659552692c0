"""The training-data pipeline: documents that are kept, cleaned and packed, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; its result is written as
Parquet and read again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import stage_path
from starmart.llm.decontaminate import find_contamination
from starmart.llm.langid import identify_language
from starmart.llm.line_dedup import dedup_lines
from starmart.llm.packing import pack_documents
from starmart.llm.simhash import drop_near_duplicates


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language cannot be told: no letters, or a score that sound documents do not have."""
    return identify_language(docs).where(~F.col("rejected")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more leave their texts; ``n_chars`` follows a text that changed."""
    kept = dedup_lines(docs)
    chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", chars).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints (3-word shingles, 2 bits) stays, that with the smallest id."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of whose words at least one in twenty stands in a benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(docs, benchmark).where(~F.col("contaminated")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens as sequences."""
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# A trained classifier and a genetic algorithm: not for SQL. tests/llm/test_pipeline.py checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = stage_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
