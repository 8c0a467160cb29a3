"""Counts and summaries over the analyzed table.

Every function takes optional group keys ``by`` (run, month, brand), so many
runs are summarised in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.functions.numbers import (
    classified_base, label_count, label_counts, net_score, pct,
)


def _net() -> Column:
    return net_score(F.col("pos"), F.col("neg"), F.col("neu"))


def _base() -> Column:
    return classified_base(F.col("pos"), F.col("neg"), F.col("neu"))


def sentiment_summary(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Four counts and three shares over all rows, two decimals."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *label_counts())
    return counts.select(
        *by,
        *[F.col(n).alias(lab) for n, lab in zip(("pos", "neg", "neu", "unk"), C.LABELS)],
        *[
            pct(F.col(n), F.col("total"), 2).alias(f"{lab}_pct")
            for n, lab in zip(("pos", "neg", "neu"), C.CLASSIFIED)
        ],
    )


def overall_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Report totals: counts, one-decimal shares, net score, distinct videos."""
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_comments"),
        *label_counts(),
        F.count_distinct(F.nullif("video_id", F.lit(""))).alias("sample_video_count"),
    )
    total = F.col("total_comments")
    return counts.select(
        *by, "total_comments", _base().alias("classified_total"), "pos", "neg", "neu", "unk",
        *[
            pct(F.col(n), total).alias(f"{n}_pct") for n in ("pos", "neg", "neu", "unk")
        ],
        _net().alias("net_overall"), "sample_video_count",
    )


def method_breakdown(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per method: known methods zero-filled, unknown ones still shown."""
    counts = df.groupBy(*by, F.col("sentiment_method").alias("method")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = F.explode(F.array(*[F.lit(m) for m in C.METHODS])).alias("method")
    groups = df.select(*by).distinct() if by else df.sparkSession.range(1)
    spine = groups.select(*by, known)
    return spine.join(counts, [*by, "method"], "full").select(
        *by, "method", F.coalesce("n", F.lit(0)).alias("n")
    )


def data_quality(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    method = F.coalesce("sentiment_method", F.lit(""))
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        label_count(C.UNCLASSIFIED).alias("unclassified_count"),
        F.count_if(method == "llm").alias("llm"),
        F.count_if(method == "llm_failed").alias("failed"),
    )
    traffic = F.col("llm") + F.col("failed")
    return counts.select(
        *by, "unclassified_count",
        pct(F.col("unclassified_count"), F.col("total")).alias("unclassified_pct"),
        pct(traffic, F.col("total")).alias("llm_escalation_pct"),
        pct(F.col("failed"), traffic).alias("llm_failure_pct"),
    )


def run_meta(marked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Date range, distinct videos and row counts, from the unfiltered rows."""
    kept = ~F.col("excluded")
    time = F.when(kept, F.nullif("create_time", F.lit("")))
    return marked.groupBy(*by).agg(
        F.coalesce(F.min(time), F.lit("")).alias("date_from"),
        F.coalesce(F.max(time), F.lit("")).alias("date_to"),
        F.count_distinct(F.when(kept, F.col("video_id"))).alias("total_videos"),
        F.count(F.lit(1)).alias("total_comments_raw"),
        F.count_if(~kept).alias("total_comments_excluded_internal"),
        F.count_if(kept).alias("total_comments_analyzed"),
    )


def per_video(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per video: first row's caption, all rows, three label counts."""
    return df.groupBy(*by, "video_id").agg(
        F.min_by("video_caption", "seq").alias("caption"),
        F.min("seq").alias("first_seq"),
        F.count(F.lit(1)).alias("total_comments_analyzed"),
        *label_counts()[:3],
    )


def stage_counts(df: DataFrame, name: str) -> DataFrame:
    """Attach row counters that arrive with the next action, at no extra scan."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def stage_report(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows left after each named stage, as one table."""
    out = None
    for number, (name, df) in enumerate(stages):
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(number).alias("stage_no"), F.lit(name).alias("stage"), "rows"
        )
        out = row if out is None else out.unionByName(row)
    return out


REQUIRED_SECTIONS = {
    "meta": ("total_comments_analyzed",),
    "sentiment_summary": ("positif", "negatif", "netral"),
    "keywords": ("scope", "keyword", "score", "count"),
    "comments": ("comment_id", "video_id", "sentiment_label"),
}


def require_sections(sections: dict[str, DataFrame]) -> None:
    """All report inputs must be there before anything is written."""
    problems = [f"missing {name}" for name in REQUIRED_SECTIONS if name not in sections]
    for name, columns in REQUIRED_SECTIONS.items():
        if name in sections:
            lacking = [c for c in columns if c not in sections[name].columns]
            problems += [f"{name} lacks {c}" for c in lacking]
    if problems:
        raise ValueError("; ".join(problems))
