"""A corpus run: toxicity, exact and near duplicates, secrets, packing.

Each stage takes what its predecessor kept, calls one operator, and its decisions
take effect: toxic documents go, copies go, one document of each group of near
duplicates stays, secrets are replaced in the texts, and the rest is packed into
training sequences. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from echolens.llm import exact_dedup, minhash, packing, secrets, toxicity
from echolens.llm.common import durable, table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("minhash", remove_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

# A trained network decides the first stage: tests compare run() with its parts by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = durable(docs)
    return docs
