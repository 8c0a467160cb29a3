"""Landed pages + selected videos -> nested month records and flat lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.operators import collect, ingest


def collect_month(
    selected: DataFrame, pages: DataFrame, reply_pages: DataFrame, month: str,
    max_comments: int = C.MAX_COMMENTS, max_replies: int = C.MAX_REPLIES,
    keep_empty: bool = False, max_pages: int = C.MAX_PAGES,
    max_reply_pages: int = C.MAX_REPLY_PAGES,
) -> dict[str, DataFrame]:
    """One record per selected video whose pages are sound.

    ``selected(video_id, account_type, creator_username)``. ``dropped_pages`` and
    ``dropped_reply_pages`` count the landed pages that the page caps leave out.
    """
    rows, invalid = collect.collect_comments(
        pages, reply_pages, max_comments, max_replies, keep_empty, max_pages, max_reply_pages
    )
    info = collect.video_info(collect.page_entries(
        pages.filter(F.col("page_no") < max_pages), ["video_id"]
    ))
    nested = ingest.nest_comments(rows.withColumnRenamed("video_id", "aweme_id"))
    videos = (
        selected.join(invalid, "video_id", "left_anti")
        .join(info, "video_id", "left")
        .withColumnRenamed("video_id", "aweme_id")
        .join(nested, "aweme_id", "left")
    )
    records = videos.select(
        "aweme_id", F.coalesce("caption", F.lit("")).alias("caption"),
        F.coalesce(
            "video_url", F.concat(F.lit(f"{C.VIDEO_SITE}/video/"), "aweme_id")
        ).alias("video_url"),
        F.coalesce("total_collected", F.lit(0)).alias("total_collected"),
        F.coalesce("comments", F.array()).alias("comments"),
        "account_type", F.col("creator_username").alias("video_author_username"),
        F.date_format(F.current_timestamp(), collect.ISO).alias("scraped_at"),
        F.lit(month).alias("month"),
    )
    return {
        "videos": records, "invalid": invalid,
        "silent_creators": collect.silent_creators(selected, rows),
        "dropped_pages": collect.pages_beyond(pages, ["video_id"], max_pages),
        "dropped_reply_pages": collect.pages_beyond(
            reply_pages, ["video_id", "comment_id"], max_reply_pages
        ),
    }
