"""A training corpus from ``documents``: quality rules, line de-duplication, near-duplicates, secrets, packing.

Each stage takes what its predecessor kept, as the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grantscope.llm import line_dedup, packing, quality, queries, secrets, simhash
from grantscope.llm.common import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; boilerplate lines of a host go from the rest."""
    return quality.apply_rules(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents hold stay in one of them; every document stays."""
    return line_dedup.drop_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id."""
    return simhash.first_of_groups(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are masked; every document stays."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return packing.pack_documents(docs, queries.BYTE_TOKENIZER)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("near-dedup", near_dedup),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

#: SQL can't express the later stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each one's result written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
