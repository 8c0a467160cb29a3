"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echolens.session import durable

__all__ = ["HOT_GROUP", "bounded", "durable", "free_name", "hot_join", "table", "texts"]

# Groups of at least 1/HOT_SHARE of the rows are looked up by broadcast, so a
# broadcast table never has more than HOT_SHARE rows.
HOT_SHARE = 2000
HOT_GROUP = 10_000
# Records that travel to a Python worker at once; bounds its memory for long texts.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(spark: SparkSession) -> None:
    """Send small record batches to Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and whole text; a null text is empty, every other column is left out."""
    bounded(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hot_join(rows: DataFrame, groups: DataFrame, key: str, size: str, values: list[str]) -> DataFrame:
    """Attach the values of ``groups`` (one row per key, ``size`` rows each) to ``rows``.

    ``rows`` has a row for each member, so groups with more than a
    1/HOT_SHARE part of them, and more than HOT_GROUP, are at most HOT_SHARE:
    these are broadcast and their rows stay where they are. All others use a
    shuffle join. Rows without a group are dropped.
    """
    limit = groups.agg(
        F.greatest(F.lit(HOT_GROUP), F.sum(size) / HOT_SHARE).alias("n")
    ).scalar()
    hot = groups.filter(F.col(size) > limit).select(key, *values)
    cold = groups.filter(F.col(size) <= limit).select(key, *values)
    near = rows.join(F.broadcast(hot), key)
    hot_keys = hot.select(key)
    far = rows.join(F.broadcast(hot_keys), key, "left_anti").join(cold, key)
    return near.unionByName(far)
