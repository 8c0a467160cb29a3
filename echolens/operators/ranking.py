"""Trend, engagement, leaderboards and comment selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.functions.numbers import (
    label_counts, month_label, net_score, pct, round_exact, trend_word,
)
from echolens.functions.text import label_rank, likes, mask_username, short_date, short_text
from echolens.operators.skew import first_rows, top_per_group


def _label() -> Column:
    return F.coalesce(F.col("sentiment_label"), F.lit(C.UNCLASSIFIED))


def _net() -> Column:
    return net_score(F.col("pos"), F.col("neg"), F.col("neu"))


# --- trend -------------------------------------------------------------------
def monthly_trend(
    df: DataFrame, by: Sequence[str] = (), minimum: int = C.MIN_MONTH_VOLUME
) -> DataFrame:
    """Counts and net per month; thin months dropped, months never pooled."""
    time = F.col("create_time")
    rows = df.filter(F.length(time) >= 7).withColumn("month", F.substring(time, 1, 7))
    months = rows.groupBy(*by, "month").agg(F.count(F.lit(1)).alias("total"), *label_counts())
    return months.filter(F.col("total") >= minimum).select(
        *by, "month", month_label(F.col("month")).alias("label"),
        "total", "pos", "neg", "neu", "unk", _net().alias("net"),
    )


def trend_last_delta(trend: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Newest surviving month against the one before; no row with fewer than two."""
    order = Window.partitionBy(*by).orderBy("month")
    newest = Window.partitionBy(*by).orderBy(F.col("month").desc())
    pairs = (
        trend.withColumn("from_label", F.lag("label").over(order))
        .withColumn("from_net", F.lag("net").over(order))
        .withColumn("_rn", F.row_number().over(newest))
        .filter("_rn = 1 AND from_label IS NOT NULL")
    )
    delta = round_exact(F.col("net") - F.col("from_net"), 1)
    return pairs.select(
        *by, "from_label", F.col("label").alias("to_label"), "from_net",
        F.col("net").alias("to_net"), delta.alias("delta"), trend_word(delta).alias("word"),
    )


# --- engagement --------------------------------------------------------------
def _like_sums(prefix: str = "") -> list[Column]:
    return [
        F.sum(F.when(_label() == lab, likes()).otherwise(0)).alias(f"{prefix}{n}")
        for lab, n in zip(C.CLASSIFIED, ("pos", "neg", "neu"))
    ]


def engagement(df: DataFrame, by: Sequence[str] = (), top: int = 10) -> DataFrame:
    """Like-weighted net, and how much of it rides on the ten loudest rows.

    The rest is "all minus top ten", so only ten rows per group are ranked.
    """
    loud = first_rows(df, by, [likes().desc(), F.col("seq")], top)
    every = df.groupBy(*by).agg(F.sum(likes()).alias("total_likes"), *_like_sums())
    tops = loud.groupBy(*by).agg(F.sum(likes()).alias("top_likes"), *_like_sums("top_"))
    if by:
        both = every.join(tops, list(by))
    else:
        both = every.withColumn("_t", tops.select(F.struct(*tops.columns)).scalar())
        both = both.select(*every.columns, "_t.*")
    rest = [F.col(c) - F.col(f"top_{c}") for c in ("pos", "neg", "neu")]
    return both.select(
        *by,
        F.coalesce("total_likes", F.lit(0)).alias("total_likes"),
        _net().alias("net_by_likes"),
        net_score(*rest).alias("net_by_likes_trimmed"),
        pct(F.col("top_likes"), F.col("total_likes")).alias("top10_like_share_pct"),
    )


# --- comment selections ------------------------------------------------------
def top_comments(
    df: DataFrame, by: Sequence[str] = (), k: int = C.TOP_COMMENTS_PER_LABEL, mask: bool = False
) -> DataFrame:
    """Most-liked positive and negative comments; ties keep input order."""
    rows = df.filter(F.col("sentiment_label").isin(C.POSITIVE, C.NEGATIVE))
    best = top_per_group(rows, [*by, "sentiment_label"], [likes().desc(), F.col("seq")], k)
    name = F.coalesce("username", F.lit(""))
    return best.select(
        *by, "sentiment_label", "rank",
        (mask_username(name) if mask else name).alias("username"),
        F.coalesce("text_raw", F.lit("")).alias("text_raw"),
        likes().alias("digg_count"),
        short_date(F.col("create_time")).alias("create_time"),
        F.coalesce("sentiment_method", F.lit("")).alias("sentiment_method"),
    )


def tier_examples(
    df: DataFrame, by: Sequence[str] = (), k: int = C.TIER_EXAMPLES
) -> DataFrame:
    """Most-liked comments per tier with a full tie-break; users masked."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    order = [likes().desc(), text("comment_id"), text("username"), text("text_raw")]
    best = top_per_group(df, [*by, "tier"], order, k)
    return best.select(
        *by, "tier", "rank", mask_username(text("username")).alias("username"),
        text("text_raw").alias("text_raw"), likes().alias("digg_count"),
        short_date(F.col("create_time")).alias("create_time"),
        _label().alias("sentiment_label"),
    )


def sample_quotes(
    df: DataFrame, by: Sequence[str] = (), k: int = C.QUOTES_PER_LABEL
) -> DataFrame:
    """First comments per label in input order, user masked."""
    best = top_per_group(df, [*by, "sentiment_label"], [F.col("seq")], k)
    return best.select(
        *by, "sentiment_label", "rank",
        mask_username(F.col("username")).alias("masked_username"), "text_raw",
    )


def explorer_rows(
    df: DataFrame, by: Sequence[str] = (), cap: int = C.EXPLORER_ROWS
) -> DataFrame:
    """The report's browsing sample, at most ``cap`` rows.

    Slots are filled in stages: the most liked of each label, then remaining
    negative or unclassified rows in input order, then remaining rows by likes.
    Each stage can contribute at most ``cap`` rows, of which those already
    chosen are skipped; so ranking ``cap`` rows per stage is enough, and the
    final ordering only ever sees three such lists per group.
    """
    slim = df.select(
        *by, "seq", _label().alias("sentiment_label"), likes().alias("digg_count"),
        F.coalesce("sentiment_method", F.lit("")).alias("sentiment_method"),
        short_date(F.col("create_time")).alias("create_time"),
        short_text(F.col("text_raw")).alias("text_raw"),
    )
    loud = [F.col("digg_count").desc(), F.col("seq")]
    known = slim.filter(F.col("sentiment_label").isin(*C.LABELS))
    floor = top_per_group(known, [*by, "sentiment_label"], loud, cap // 4).withColumn(
        "stage", label_rank(F.col("sentiment_label"))
    )
    critical = slim.filter(F.col("sentiment_label").isin(C.NEGATIVE, C.UNCLASSIFIED))
    second = first_rows(critical, by, [F.col("seq")], cap).withColumn("stage", F.lit(5))
    third = first_rows(slim, by, loud, cap).withColumn("stage", F.lit(6))
    listed = floor.unionByName(second).unionByName(third)
    place = F.struct("stage", "rank")
    values = [c for c in slim.columns if c not in (*by, "seq")]
    chosen = listed.groupBy(*by, "seq").agg(
        F.min(place).alias("_place"), F.first(F.struct(*values)).alias("_v")
    )
    group = Window.partitionBy(*by)
    kept = chosen.withColumn("_slot", F.row_number().over(group.orderBy("_place"))).filter(
        F.col("_slot") <= cap
    )
    shown = F.row_number().over(group.orderBy(F.col("_v.digg_count").desc(), "_slot"))
    return kept.select(*by, shown.alias("position"), "seq", "_v.*")


# --- leaderboard -------------------------------------------------------------
def scored_videos(videos: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Videos with at least one classified row and their net score."""
    base = F.col("pos") + F.col("neg") + F.col("neu")
    return videos.filter(base > 0).select(
        *by, "video_id", "first_seq",
        F.coalesce(F.nullif("caption", F.lit("")), F.lit("(tanpa caption)")).alias("caption"),
        base.alias("total"), "pos", "neg", "neu", _net().alias("net"),
    )


def video_leaderboard(
    videos: DataFrame, by: Sequence[str] = (), k: int = C.LEADERBOARD_SIZE,
    minimum: int = C.MIN_VIDEO_COMMENTS,
) -> DataFrame:
    """Worst, best and loudest videos; ties keep first appearance."""
    scored = scored_videos(videos, by)
    eligible = scored.filter(F.col("total") >= minimum)
    total, net, seen = F.col("total").desc(), F.col("net"), F.col("first_seq")
    boards = (
        ("worst", eligible, [net.asc(), total, seen]),
        ("best", eligible, [net.desc(), total, seen]),
        ("loudest", scored, [total, seen]),
    )
    out = None
    for name, rows, order in boards:
        part = first_rows(rows, by, order, k).withColumn("board", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.select(
        *by, "board", "rank", "video_id", "caption", "total", "pos", "neg", "neu", "net"
    )


def leaderboard_summary(
    videos: DataFrame, by: Sequence[str] = (), minimum: int = C.MIN_VIDEO_COMMENTS
) -> DataFrame:
    """Eligible and total videos, and the upper median of eligible nets.

    Net has one decimal between -100 and 100, so it takes at most 2001 values:
    the median is read from their cumulative counts instead of a sorted list of
    all videos.
    """
    scored = scored_videos(videos, by)
    eligible = F.col("total") >= minimum
    values = scored.groupBy(*by, "net").agg(
        F.count(F.lit(1)).alias("videos"), F.count_if(eligible).alias("n")
    )
    upto = Window.partitionBy(*by).orderBy("net").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    placed = values.withColumn("_upto", F.sum("n").over(upto)).withColumn(
        "_all", F.sum("n").over(whole)
    )
    at = F.when(F.col("_upto") > F.floor(F.col("_all") / 2), F.col("net"))
    return placed.groupBy(*by).agg(
        F.coalesce(F.min(at), F.lit(0.0)).alias("median_net"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("eligible_count"),
        F.coalesce(F.sum("videos"), F.lit(0)).alias("total_count"),
    )
