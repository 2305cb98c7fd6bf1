"""The training-data pipeline: documents through quality rules, exact and near dedup, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthlake.llm import bpe, exact_dedup, mixing, quality, simhash
from monthlake.llm.common import table, write_shared
from monthlake.llm.queries import vocab_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_rows(docs, quality.trusted_of(table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_rows(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_dedup_rows(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(docs, vocab_path())


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_copies), ("simhash_near_dedup", near_copies),
          ("mixing", mix), ("bpe_encoding", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = write_shared(docs, f"pipeline-{name}")
    return docs
