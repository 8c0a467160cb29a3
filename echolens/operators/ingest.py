"""Nested videos -> flat comment table, validation, re-nesting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolens import schema as S
from echolens.operators.skew import lookup_join

# A row's place: video position times this, plus its place inside the video.
POSITIONS_PER_VIDEO = 1 << 24

Adapter = Callable[[DataFrame], DataFrame]
_ADAPTERS: dict[str, Adapter] = {}


def register_adapter(platform: str, adapter: Adapter) -> None:
    """Add a platform: a function from its raw videos to the flat table."""
    _ADAPTERS[platform] = adapter


def flatten_with(platform: str, videos: DataFrame) -> DataFrame:
    """Run a platform adapter and check that it kept the flat contract."""
    flat = _ADAPTERS[platform](videos)
    missing = [c for c in S.FLAT_COLUMNS if c not in flat.columns]
    if missing:
        raise ValueError(f"adapter {platform!r} lacks columns {missing}")
    return flat.select(*S.FLAT_COLUMNS)


def _entries(comments: Column) -> Column:
    """Every comment followed by its replies, as one array of flat entries."""

    def entry(row: Column, is_reply: bool, parent: Column) -> Column:
        return F.struct(
            *[row[f].alias(f) for f in (
                "comment_id", "username", "nickname", "comment", "create_time",
                "digg_count", "total_reply",
            )],
            F.lit(is_reply).alias("is_reply"),
            parent.alias("parent_comment_id"),
        )

    def with_replies(c: Column) -> Column:
        replies = F.transform(
            F.coalesce(c["replies"], F.array()), lambda r: entry(r, True, c["comment_id"])
        )
        head = F.array(entry(c, False, F.lit(None).cast("string")))
        return F.concat(head, replies)

    return F.flatten(F.transform(comments, with_replies))


def explode_comments(videos: DataFrame) -> DataFrame:
    """One row per comment or reply with the shared video fields; no shuffle."""
    rows = videos.select(
        "video_no", "aweme_id", "caption", "video_url", "account_type",
        "video_author_username", F.posexplode(_entries(F.col("comments"))).alias("_pos", "_e"),
    )
    seq = F.col("video_no") * POSITIONS_PER_VIDEO + F.col("_pos")
    return rows.select(
        seq.alias("seq"), "aweme_id", "caption", "video_url", "account_type",
        "video_author_username", "_e.*",
    )


def flat_comments(videos: DataFrame) -> DataFrame:
    """The fact table of the engine: text defaults '', likes default 0."""
    empty = F.lit("")
    return explode_comments(videos).select(
        "comment_id",
        F.col("aweme_id").alias("video_id"),
        F.coalesce("caption", empty).alias("video_caption"),
        F.coalesce("video_author_username", empty).alias("video_author_username"),
        "is_reply",
        "parent_comment_id",
        F.coalesce("username", empty).alias("username"),
        F.coalesce("comment", empty).alias("text_raw"),
        F.coalesce("create_time", empty).alias("create_time"),
        F.coalesce("digg_count", F.lit(0).cast("bigint")).alias("digg_count"),
        F.lit(False).alias("excluded"),
        F.lit(None).cast("string").alias("exclude_reason"),
        "seq",
    )


def month_rows(videos: DataFrame) -> DataFrame:
    """The collector's flat shape: 0/1 reply flag, '' for no parent."""
    empty = F.lit("")
    rows = explode_comments(videos)
    texts = {
        c: F.coalesce(c, empty).alias(c)
        for c in S.MONTH_COLUMNS
        if c not in ("is_reply", "digg_count", "total_reply", "account_type")
    }
    numbers = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("digg_count", "total_reply")}
    special = {
        "is_reply": F.col("is_reply").cast("int").alias("is_reply"),
        "account_type": F.coalesce("account_type", F.lit("unknown")).alias("account_type"),
    }
    picks = {**texts, **numbers, **special}
    return rows.select(*[picks[c] for c in S.MONTH_COLUMNS], "seq")


register_adapter("short_video", flat_comments)


# --- validation --------------------------------------------------------------
REQUIRED = ("comment_id", "username", "comment", "create_time")


def schema_violations(video_text: DataFrame) -> DataFrame:
    """Rows (video_id, comment_id, rule) for every broken input rule.

    Reads the JSON text, because a missing key and a null value are different
    things here and a parsed struct shows both as null.
    """
    doc = video_text.select(
        "video_no",
        F.get_json_object("body", "$.aweme_id").alias("video_id"),
        F.json_object_keys("body").isNotNull().alias("is_object"),
        F.get_json_object("body", "$.comments").alias("comments"),
    )
    is_list = F.json_array_length("comments").isNotNull()
    no_id = F.length(F.coalesce("video_id", F.lit(""))) == 0
    rule = (
        F.when(~F.coalesce("is_object", F.lit(False)), "video is not an object")
        .when(no_id, "missing aweme_id")
        .when(F.col("comments").isNull(), "missing comments")
        .when(~is_list, "comments is not an array")
    )
    videos = doc.withColumn("rule", rule)
    broken = videos.filter("rule IS NOT NULL").select(
        "video_id", F.lit(None).cast("string").alias("comment_id"), "rule"
    )
    texts = "array<string>"
    tops = videos.filter("rule IS NULL").select(
        "video_id", F.explode(F.from_json("comments", texts)).alias("c")
    )
    replies = tops.select(
        "video_id", F.explode(F.from_json(F.get_json_object("c", "$.replies"), texts)).alias("c")
    )

    def missing_keys(rows: DataFrame) -> DataFrame:
        # a key holding null is present, so test the key list and not the value
        absent = F.array_except(
            F.array(*[F.lit(k) for k in REQUIRED]),
            F.coalesce(F.json_object_keys("c"), F.array().cast(texts)),
        )
        return rows.filter(F.size(absent) > 0).select(
            "video_id",
            F.get_json_object("c", "$.comment_id").alias("comment_id"),
            F.concat(F.lit("missing "), F.array_join(absent, ", ")).alias("rule"),
        )

    nested = replies.filter(
        F.json_array_length(F.get_json_object("c", "$.replies")) > 0
    ).select(
        "video_id",
        F.get_json_object("c", "$.comment_id").alias("comment_id"),
        F.lit("reply to a reply").alias("rule"),
    )
    return (
        broken.unionByName(missing_keys(tops))
        .unionByName(missing_keys(replies))
        .unionByName(nested)
    )


def require_valid(video_text: DataFrame) -> None:
    """Stop the run on the first violations; only a few rows reach the driver."""
    sample = schema_violations(video_text).limit(5).collect()
    if sample:
        raise ValueError("input breaks its contract: " + "; ".join(str(r) for r in sample))


# --- nesting -----------------------------------------------------------------
def nest_comments(rows: DataFrame) -> DataFrame:
    """Flat rows of *capped* videos -> one record per video, replies nested.

    Collection caps bound a video at a few hundred rows, so the arrays built
    here are small; run the caps first.
    """
    fields = [
        F.col(c) for c in (
            "comment_id", "username", "nickname", "comment", "create_time", "avatar",
            "digg_count", "total_reply",
        )
    ]
    is_reply = F.col("is_reply").cast("boolean")
    replies = (
        rows.filter(is_reply)
        .groupBy("aweme_id", "parent_comment_id")
        .agg(F.array_sort(F.collect_list(F.struct("seq", *fields))).alias("_r"))
        .select(
            "aweme_id", F.col("parent_comment_id").alias("comment_id"),
            F.transform("_r", lambda r: r.dropFields("seq")).alias("replies"),
        )
    )
    tops = rows.filter(~is_reply).join(replies, ["aweme_id", "comment_id"], "left")
    with_replies = F.struct("seq", *fields, F.coalesce("replies", F.array()).alias("replies"))
    videos = tops.groupBy("aweme_id").agg(
        F.array_sort(F.collect_list(with_replies)).alias("_c")
    )
    return videos.select(
        "aweme_id",
        total_collected(F.col("_c")).alias("total_collected"),
        F.transform("_c", lambda c: c.dropFields("seq")).alias("comments"),
    )


def total_collected(comments: Column) -> Column:
    """Comments plus replies of one video."""
    return F.aggregate(
        comments, F.lit(0).cast("bigint"),
        lambda n, c: n + 1 + F.coalesce(F.size(c["replies"]), F.lit(0)),
    )


def orphan_replies(flat: DataFrame) -> DataFrame:
    """Replies whose parent comment is missing; a viral parent is no hot task."""
    replies = flat.filter("parent_comment_id IS NOT NULL AND parent_comment_id <> ''")
    parents = flat.filter("NOT is_reply").select(
        F.col("comment_id").alias("parent_comment_id")
    ).distinct()
    return lookup_join(replies, parents, "parent_comment_id", "anti", spread=["seq"])


def thread_sizes(flat: DataFrame) -> DataFrame:
    """Replies per top-level comment; counts are combined before the join."""
    counts = (
        flat.filter("is_reply").groupBy(F.col("parent_comment_id").alias("comment_id"))
        .agg(F.count(F.lit(1)).alias("replies"))
    )
    tops = flat.filter("NOT is_reply").select("comment_id", "video_id")
    return tops.join(counts, "comment_id", "left").withColumn(
        "replies", F.coalesce("replies", F.lit(0))
    )
