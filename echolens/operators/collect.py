"""Landed API pages -> capped, clean comment rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolens import constants as C
from echolens import schema as S
from echolens.functions.text import strip
from echolens.operators.skew import top_per_group

ISO = "yyyy-MM-dd'T'HH:mm:ss"
# Raw comments per page are far fewer than this.
PAGE_SPAN = 1 << 20


def page_entries(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Raw comments of landed response pages, in page order."""
    parsed = pages.select(*keys, "page_no", F.from_json("body", S.PAGE).alias("page"))
    rows = parsed.select(*keys, "page_no", F.posexplode("page.comments").alias("pos", "raw"))
    place = F.col("page_no") * PAGE_SPAN + F.col("pos")
    return rows.select(*keys, "page_no", place.alias("place"), "raw")


def pages_beyond(pages: DataFrame, keys: list[str], max_pages: int) -> DataFrame:
    """Per key, how many landed pages the page cap leaves out; keys without any are absent."""
    return pages.filter(F.col("page_no") >= max_pages).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("dropped_pages")
    )


def usable(text: Column, keep_empty: bool = False) -> Column:
    """A comment with any text; emoji-only counts, blank does not."""
    return F.lit(True) if keep_empty else strip(F.coalesce(text, F.lit(""))) != ""


def epoch_seconds(value: Column) -> Column:
    """Epoch as number, null when unusable; numeric text is accepted."""
    return strip(value).try_cast("bigint")


def iso_time(epoch: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch), ISO)


def project_comment(entries: DataFrame, keep: list[str]) -> DataFrame:
    """Named fields with their defaults; ``bad`` marks a broken raw shape."""
    raw, empty = F.col("raw"), F.lit("")
    epoch = epoch_seconds(raw["create_time"])
    return entries.select(
        *keep,
        raw["cid"].alias("comment_id"),
        F.coalesce(raw["user"]["unique_id"], empty).alias("username"),
        F.coalesce(raw["user"]["nickname"], empty).alias("nickname"),
        F.coalesce(raw["text"], empty).alias("comment"),
        iso_time(epoch).alias("create_time"),
        F.coalesce(F.get(raw["user"]["avatar_thumb"]["url_list"], F.lit(0)), empty).alias("avatar"),
        F.coalesce(raw["digg_count"], F.lit(0)).alias("digg_count"),
        F.coalesce(raw["reply_comment_total"], F.lit(0)).alias("total_reply"),
        (F.coalesce(raw["cid"], empty) == "").alias("no_id"),
        epoch.isNull().alias("bad_time"),
    )


def video_info(entries: DataFrame) -> DataFrame:
    """First non-empty caption, and the permalink of page 0.

    Reads unfiltered entries: a blank comment can still carry the share block.
    """
    title = F.nullif(F.col("raw.share_info.title"), F.lit(""))
    url = F.nullif(F.col("raw.share_info.url"), F.lit(""))
    found = entries.groupBy("video_id").agg(
        F.min_by(title, F.when(title.isNotNull(), F.col("place"))).alias("caption"),
        F.min_by(
            url, F.when(url.isNotNull() & (F.col("page_no") == 0), F.col("place"))
        ).alias("video_url"),
    )
    own = F.concat(F.lit(f"{C.VIDEO_SITE}/video/"), F.col("video_id"))
    return found.select(
        "video_id", F.coalesce("caption", F.lit("")).alias("caption"),
        F.coalesce("video_url", own).alias("video_url"),
    )


def blank_counts(entries: DataFrame) -> DataFrame:
    """Blank comments dropped per video."""
    return entries.groupBy("video_id").agg(
        F.count_if(~usable(F.col("raw.text"))).alias("skipped_blank")
    )


def cap_replies(
    replies: DataFrame, max_replies: int = C.MAX_REPLIES, order: str = "place",
    keys: tuple[str, ...] = ("video_id", "parent_comment_id"),
) -> DataFrame:
    """First ``max_replies`` replies per comment."""
    if max_replies <= 0:
        return replies.limit(0)
    return top_per_group(
        replies, list(keys), [F.col(order)], max_replies, rank="reply_no", spread=[order]
    ).drop("reply_no")


def cap_videos(
    comments: DataFrame, max_comments: int = C.MAX_COMMENTS, order: str = "place",
    replies: str = "reply_count", key: str = "video_id",
) -> DataFrame:
    """Walk a video's comments while budget is left; a comment costs 1 + replies.

    A comment stays while the cost of those before it is below the cap, so the
    last one may overshoot and is never split from its replies. Every comment
    costs at least one, hence only the first ``max_comments`` can stay: the
    rest is cut per task before the running sum, and a viral video stays small.
    """
    first = top_per_group(
        comments, [key], [F.col(order)], max_comments, rank="_place", spread=[order]
    ).drop("_place")
    before = (
        Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    spent = F.coalesce(F.sum(F.lit(1) + F.col(replies)).over(before), F.lit(0))
    return first.withColumn("_spent", spent).filter(F.col("_spent") < max_comments).drop("_spent")


def collect_comments(
    pages: DataFrame, reply_pages: DataFrame, max_comments: int = C.MAX_COMMENTS,
    max_replies: int = C.MAX_REPLIES, keep_empty: bool = False,
    max_pages: int = C.MAX_PAGES, max_reply_pages: int = C.MAX_REPLY_PAGES,
) -> tuple[DataFrame, DataFrame]:
    """Landed pages -> (comment and reply rows, invalid videos).

    ``pages(video_id, page_no, body)``, ``reply_pages(video_id, comment_id,
    page_no, body)``. A video with a comment that lacks its id or has an
    unusable time is set aside as a whole; the run goes on. Pages from
    ``max_pages`` (``max_reply_pages`` per comment) on are left out;
    ``pages_beyond`` counts them.
    """
    entries = page_entries(pages.filter(F.col("page_no") < max_pages), ["video_id"])
    kept = entries.filter(usable(F.col("raw.text"), keep_empty))
    tops = project_comment(kept, ["video_id", "place"])
    reply_entries = page_entries(
        reply_pages.filter(F.col("page_no") < max_reply_pages)
        .withColumnRenamed("comment_id", "parent_comment_id"),
        ["video_id", "parent_comment_id"],
    ).filter(usable(F.col("raw.text"), keep_empty))
    # capped first: a viral comment then joins with a handful of replies
    capped_replies = project_comment(
        cap_replies(reply_entries, max_replies), ["video_id", "parent_comment_id", "place"]
    )
    parents = tops.filter("total_reply > 0").select(
        "video_id", F.col("comment_id").alias("parent_comment_id"),
        F.col("place").alias("_parent_place"),
    )
    replies = capped_replies.join(parents, ["video_id", "parent_comment_id"])
    broken = F.col("no_id") | F.col("bad_time")
    invalid = (
        tops.filter(broken).select("video_id")
        .unionByName(replies.filter(broken).select("video_id"))
        .distinct()
    )
    counts = replies.groupBy("video_id", F.col("parent_comment_id").alias("comment_id")).agg(
        F.count(F.lit(1)).alias("reply_count")
    )
    sized = tops.join(counts, ["video_id", "comment_id"], "left").withColumn(
        "reply_count", F.coalesce("reply_count", F.lit(0))
    )
    # after the cap a video has few rows, so both joins below see no hot key
    capped = cap_videos(sized, max_comments).join(invalid, "video_id", "left_anti")
    kept_replies = replies.join(
        capped.select("video_id", F.col("comment_id").alias("parent_comment_id")),
        ["video_id", "parent_comment_id"], "left_semi",
    )
    fields = [
        "comment_id", "username", "nickname", "comment", "create_time", "avatar",
        "digg_count", "total_reply",
    ]
    top_rows = capped.select(
        "video_id", F.lit(None).cast("string").alias("parent_comment_id"),
        F.lit(False).alias("is_reply"), *fields,
        F.struct(F.col("place").alias("c"), F.lit(-1).cast("bigint").alias("r")).alias("seq"),
    )
    reply_rows = kept_replies.select(
        "video_id", "parent_comment_id", F.lit(True).alias("is_reply"), *fields,
        F.struct(F.col("_parent_place").alias("c"), F.col("place").alias("r")).alias("seq"),
    )
    return top_rows.unionByName(reply_rows), invalid


def silent_creators(videos: DataFrame, comments: DataFrame) -> DataFrame:
    """Videos whose named creator never appears among their commenters.

    (video, user) pairs are merged before the shuffle and joined on both
    columns, so a viral video is spread over its users.
    """
    named = videos.filter("creator_username <> ''").select(
        "video_id", F.col("creator_username").alias("username")
    )
    pairs = comments.select("video_id", "username").distinct()
    return named.join(pairs, ["video_id", "username"], "left_anti").withColumnRenamed(
        "username", "creator_username"
    )
