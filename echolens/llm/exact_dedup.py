"""Exact duplicates by a persistent digest index, bucketed and sorted by hash.

The index is a table on shared storage with a row for each distinct text:
``digest`` and ``keep_id``. New rows are reduced to one row per digest,
anti-joined with the index by sort-merge on its buckets (the index is not
shuffled), and the digests not found are appended in the same buckets.

Results in edge cases: a null text counts as empty; rows without ``doc_id`` are
counted in their group but another row stays if one has an id; rows that repeat
a ``doc_id`` share its decision, but ``drop_exact_duplicates`` keeps one row of them; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echolens.llm.common import durable, free_name, hot_join
from echolens.session import workspace

SPACES = r"[\x20\x09-\x0D]+"


def digests(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, ``more`` and the SHA-256 of the text after joining white space, for every row."""
    normal = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), SPACES, " ")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *more, F.sha2(normal.cast("binary"), 256).alias("digest"))


class DigestIndex:
    """Persistent digest table at ``path``, bucketed and sorted by digest.

    The files outlive the session: opening the same path again finds the digests
    of earlier runs. ``buckets`` must be the same for all runs of one index.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest STRING, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def missing(self, batch: DataFrame) -> DataFrame:
        """One row per digest of ``batch`` that the index lacks, its smallest id staying."""
        first = batch.groupBy("digest").agg(F.min("doc_id").alias("keep_id"))
        return first.join(self.table().hint("merge"), "digest", "left_anti")

    def append(self, batch: DataFrame) -> None:
        """Add the digests of ``batch`` (doc_id, digest) that are new."""
        self.add(durable(self.missing(batch)))

    def add(self, new: DataFrame) -> None:
        """Append ``new`` digests (digest, keep_id).

        They are dealt to the buckets first, so that each bucket gets one more file.
        """
        new.repartition(self.buckets, "digest").write.mode("append").format("parquet").bucketBy(
            self.buckets, "digest"
        ).sortBy("digest").option("path", self.path).saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)


def exact_duplicates(docs: DataFrame, index: DigestIndex | None = None, buckets: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs``.

    ``index`` holds earlier arrivals, whose rows stay; without it an index is
    begun in the shared folder. group_size counts the rows of ``docs`` only.
    """
    spark = docs.sparkSession
    if index is None:
        index = DigestIndex(spark, workspace(spark, "digest-index"), buckets)
    rows = durable(digests(docs))
    index.append(rows)
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups = durable(sizes.join(index.table(), "digest"))
    out = hot_join(rows, groups, "digest", "group_size", ["keep_id", "group_size"])
    return out.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, index: DigestIndex | None = None, buckets: int = 64) -> DataFrame:
    """One row per text, all columns: the smallest doc_id (null ones last), of equal ids the first row.

    By the digest index like ``exact_duplicates``: of a text that ``index`` holds from
    earlier arrivals, no row stays.
    """
    spark = docs.sparkSession
    if index is None:
        index = DigestIndex(spark, workspace(spark, "digest-index"), buckets)
    row = free_name(docs, "dedup_row")
    rows = durable(docs.withColumn(row, F.monotonically_increasing_id()))
    # of the same stored rows, so the ids are the same wherever they are read
    keys = durable(digests(rows, row))
    new = durable(index.missing(keys))
    index.add(new)
    # several rows may have the id that stays, or no row of the text an id
    named = keys.groupBy("digest", "doc_id").agg(F.min(row).alias(row))
    kept = named.join(new, (named.digest == new.digest) & named.doc_id.eqNullSafe(new.keep_id), "left_semi").select(row)
    return rows.join(kept, row, "left_semi").drop(row)
