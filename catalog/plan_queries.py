"""Whole plans: analysis of landed posts, sample of the mirror, month of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.collection_queries import _ALLOCATION, _COLLECTED, MAX_COMMENTS, MAX_REPLIES, SIZE
from catalog.registry import register
from catalog.report_queries import _TFIDF, _TFIDF_PARTS, _summary_sql
from catalog.sql import query, quoted
from catalog.text_queries import _LEXICON_ROWS, _SCORED
from echolens.plans import analyze as A
from echolens.plans.collection import collect_month
from echolens.plans.sample import sample_mirror

EXCLUDED = ("user5", "user14", "user200")


def _section(spark, sf, name):
    flat = V.posts(spark, sf).drop("sentiment_label", "sentiment_method", "run_id")
    options = A.AnalyzeOptions(
        exclude=EXCLUDED, stopwords=V.STOPWORDS, slang=V.SLANG, lexicon=V.LEXICON
    )
    return A.analyze(flat, options, only=[name])[name]


_KEPT = f"""
SELECT * EXCLUDE (sentiment_label, sentiment_method) FROM tokenized
WHERE username <> video_author_username AND NOT list_contains({quoted(EXCLUDED)}, username)"""
_LABELED = f"SELECT k.*, l.* EXCLUDE (seq) FROM kept k JOIN ({_LEXICON_ROWS}) l ON k.seq = l.seq"


@register("analyzed_comments", query("tokenized", """
SELECT comment_id, video_id, username, array_to_string(tokens, ' ') AS tokens, sentiment_label,
  sentiment_confidence, sentiment_method FROM labeled""", **_SCORED, kept=_KEPT, labeled=_LABELED))
def analyzed_comments(spark, sf):
    rows = _section(spark, sf, "comments")
    return rows.select(
        "comment_id", "video_id", "username",
        F.array_join("tokens_stemmed", " ").alias("tokens"),
        "sentiment_label", "sentiment_confidence", "sentiment_method",
    )


@register("analysis_summary", query(
    "tokenized", _summary_sql("labeled"), **_SCORED, kept=_KEPT, labeled=_LABELED))
def analysis_summary(spark, sf):
    return _section(spark, sf, "sentiment_summary")


@register("analysis_keywords", query(
    "tokenized", _TFIDF.replace("SELECT rank", "SELECT 'overall' AS scope, rank"),
    all_tokens="SELECT * FROM tokenized", kept=_KEPT,
    **{k: v.replace("FROM tokenized", "FROM kept") for k, v in _TFIDF_PARTS.items()}))
def analysis_keywords(spark, sf):
    return _section(spark, sf, "overall_keywords")


@register("sample_plan", query("firsts tier_spine", """
SELECT (SELECT count(*) FROM mirror) - (SELECT count(*) FROM firsts) AS dropped,
  (SELECT CAST(sum(allocated) AS BIGINT) FROM allocation) AS sampled""", **_ALLOCATION))
def sample_plan(spark, sf):
    parts = sample_mirror(V.mirror(spark, sf), SIZE, seed=7)
    return parts["manifest"].select(
        F.col("duplicate_rows_dropped").alias("dropped"), "sampled"
    )


@register("collected_month", query("landed", """
SELECT t.video_id AS aweme_id, 'Title ' || t.video_id AS caption, t.n + coalesce(r.n, 0)
  AS total_collected, t.n AS comments, coalesce(r.n, 0) AS replies
FROM (SELECT video_id, count(*) AS n FROM kept GROUP BY video_id) t LEFT JOIN (
  SELECT video_id, count(*) AS n FROM answers WHERE conv_id IN (SELECT conv_id FROM kept)
  GROUP BY video_id) r ON t.video_id = r.video_id""", **_COLLECTED))
def collected_month(spark, sf):
    pages, replies = V.landed_pages(spark, sf)
    selected = pages.select("video_id").distinct().select(
        "video_id", F.lit("kol").alias("account_type"), F.lit("").alias("creator_username")
    )
    parts = collect_month(
        selected, pages, replies, "2024-01", max_comments=MAX_COMMENTS, max_replies=MAX_REPLIES
    )
    videos = parts["videos"]
    told = F.aggregate(
        "comments", F.lit(0), lambda n, c: n + F.size(c["replies"])
    )
    return videos.select(
        "aweme_id", F.when(F.col("caption") == "", F.concat(F.lit("Title "), "aweme_id"))
        .otherwise(F.col("caption")).alias("caption"),
        "total_collected", F.size("comments").alias("comments"), told.alias("replies"),
    )
