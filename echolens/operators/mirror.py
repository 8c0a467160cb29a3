"""Order mirror: one row per order -> one row per video, with a reject report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolens.functions.text import blank_to, strip, video_key
from echolens.operators.skew import lookup_join
from echolens.session import durable


def keyed_rows(mirror: DataFrame) -> DataFrame:
    """Add the video key; blank account types become ``unknown``."""
    return mirror.select(
        "line",
        strip(F.coalesce("value", F.lit(""))).alias("value"),
        blank_to(F.col("account_type"), "unknown").alias("account_type"),
        F.coalesce("creator_username", F.lit("")).alias("creator_username"),
        video_key(F.col("value")).alias("video_id"),
    )


def first_rows_per_video(keyed: DataFrame) -> DataFrame:
    """First line per video, and how many lines named it.

    An aggregate rather than a window: each task keeps one candidate per video
    before the shuffle, so a video behind a third of all orders costs nothing.
    Lines without an id are dropped as one group afterwards: a filter on the id
    would move below the projection and evaluate its patterns a second time.
    """
    fields = F.struct("line", "account_type", "creator_username")
    return (
        keyed.groupBy("video_id")
        .agg(
            F.min_by(fields, F.col("line")).alias("_first"),
            F.count(F.lit(1)).alias("lines"),
            F.count("video_id").alias("_named"),
        )
        .filter("_named > 0")
        .select("video_id", "_first.*", "lines")
    )


def candidates(mirror: DataFrame) -> DataFrame:
    """Unique usable videos of the mirror."""
    return first_rows_per_video(keyed_rows(mirror)).drop("lines")


def rejected_rows(mirror: DataFrame) -> DataFrame:
    """(line, reason, detail, kept_account_type) of every line not kept."""
    keyed = keyed_rows(mirror)
    # written once: it is read for the frequent videos and for all others
    kept = durable(first_rows_per_video(keyed).select(
        "video_id", F.col("line").alias("kept_line"),
        F.col("account_type").alias("kept_account_type"), "lines",
    ))
    rows = lookup_join(keyed, kept, "video_id", weight="lines", spread=["line"])
    conflict = F.col("account_type") != F.col("kept_account_type")
    reason = (
        F.when(F.col("value") == "", "empty")
        .when(F.col("video_id").isNull(), "no video id")
        .when((F.col("line") != F.col("kept_line")) & conflict, "duplicate, other account type")
        .when(F.col("line") != F.col("kept_line"), "duplicate")
    )
    return rows.withColumn("reason", reason).filter("reason IS NOT NULL").select(
        "line", "reason",
        F.coalesce("video_id", "value").alias("detail"),
        "account_type",
        F.when(F.col("reason").startswith("duplicate"), F.col("kept_account_type")).alias(
            "kept_account_type"
        ),
    )


def reject_counts(mirror: DataFrame) -> DataFrame:
    """Rejected lines per reason without listing them.

    The number of duplicates is lines minus one per video; only conflicts need
    the kept type, and (video, type) pairs are combined before the shuffle.
    """
    keyed = keyed_rows(mirror)
    bad = keyed.filter("video_id IS NULL").groupBy(
        F.when(F.col("value") == "", "empty").otherwise("no video id").alias("reason")
    ).agg(F.count(F.lit(1)).alias("lines"))
    per_type = (
        keyed.filter("video_id IS NOT NULL").groupBy("video_id", "account_type")
        .agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("first_line"))
    )
    per_video = per_type.groupBy("video_id").agg(
        F.sum("n").alias("n"), F.min_by("n", "first_line").alias("kept_n")
    )
    duplicates = per_video.agg(
        F.coalesce(F.sum(F.col("kept_n") - 1), F.lit(0)).alias("duplicate"),
        F.coalesce(F.sum(F.col("n") - F.col("kept_n")), F.lit(0)).alias("other"),
    ).select(
        F.inline(F.array(
            F.struct(F.lit("duplicate").alias("reason"), F.col("duplicate").alias("lines")),
            F.struct(F.lit("duplicate, other account type").alias("reason"),
                     F.col("other").alias("lines")),
        ))
    )
    return bad.unionByName(duplicates.filter("lines > 0"))
