"""The corpus pipeline: quality, near duplicates, personal data, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import packing, pii, quality, simhash
from kinweave.llm.common import shared_path
from kinweave.sources.store import Store

#: SQL cannot express trained dictionaries or tokenizer files; a test holds the pipeline against plain stages.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the compression classifier rejects."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return simhash.keep_one(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind in brackets in place of each span of personal data."""
    return pii.redact(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast("long")).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token pieces of all documents into sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", hide_personal_data),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each stage's result is written to the shared folder and read again.

    A stage's table goes when the next one's is written; the last of them stays, as the result reads it. An empty table gives no rows.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            Store(spark).remove(before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
