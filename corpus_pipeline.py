"""The corpus pipeline: documents through five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import mixing, packing, simhash, suffix_array, toxicity
from corvane.llm.common import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return simhash.keep_one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that also start in a document with a smaller id."""
    return suffix_array.trimmed(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources meet their target weights."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("simhash", near_dedup), ("suffix_array", substring_dedup), ("mixing", mix_sources), ("packing", pack)]

#: Classifier, similarity search and packing have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
