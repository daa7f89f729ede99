"""Four stages from raw documents to packed token sequences.

Each stage takes all that the one before kept, as written to Parquet, and passes on rows with the
columns of ``documents``; the last gives the places of the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from railwatch.llm.queries import vocabulary
from railwatch.sources.staging import new_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model, learned from the labels, does not reject."""
    from railwatch.llm.quality import good_documents, train

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return good_documents(docs, train(docs, labels), 0.5).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    from railwatch.llm.minhash import deduplicated

    return deduplicated(docs, width=5, percent=80).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights; a document taken twice is there twice."""
    from railwatch.llm.mixing import mixed

    return mixed(docs).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    from railwatch.llm.packing import pack

    return pack(docs, vocabulary())


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("mixing", mix_sources), ("packing", pack_sequences)]

# A trained model, hashed signatures and a local search have no SQL; tests/llm compares stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
