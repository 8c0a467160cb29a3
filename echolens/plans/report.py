"""Analyzed rows of any number of runs -> report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolens.operators import audit, keywords, narrative, ranking, summary, tiers
from echolens.session import durable
from echolens.streaming.log import BatchLog


def metric_tables(df: DataFrame, by: Sequence[str] = ("run_id",)) -> dict[str, DataFrame]:
    """Every metric that needs no account table."""
    by = list(by)
    videos = durable(summary.per_video(df, by))
    trend = ranking.monthly_trend(df, by)
    return {
        "overall": summary.overall_metrics(df, by),
        "trend": trend,
        "trend_delta": ranking.trend_last_delta(trend, by),
        "engagement": ranking.engagement(df, by),
        "data_quality": summary.data_quality(df, by),
        "method_breakdown": summary.method_breakdown(df, by),
        "top_comments": ranking.top_comments(df, by, mask=True),
        "sample_quotes": ranking.sample_quotes(df, by),
        "explorer": ranking.explorer_rows(df, by),
        "keywords": keywords.keywords_by_label(df, by),
        "leaderboard": ranking.video_leaderboard(videos, by),
        "leaderboard_summary": ranking.leaderboard_summary(videos, by),
    }


def narrative_rows(
    metrics: dict[str, DataFrame], by: Sequence[str] = ("run_id",),
    population_videos: int | None = None,
) -> DataFrame:
    return narrative.build_narrative(
        metrics["overall"], metrics["engagement"], metrics["data_quality"], metrics["trend"],
        metrics["trend_delta"], metrics["leaderboard"], metrics["leaderboard_summary"],
        by, population_videos,
    )


def tier_tables(
    tiered: DataFrame, accounts: DataFrame | None, by: Sequence[str] = ("run_id",), **themes
) -> dict[str, DataFrame]:
    """Scorecard, overview, deep dive and sentences per tier."""
    by = list(by)
    totals = durable(tiers.tier_totals(tiered, accounts, by))
    found = durable(tiers.tier_themes(tiered, by, **themes))
    words = durable(keywords.keywords_by_tier(tiered, by))
    examples = durable(ranking.tier_examples(tiered, by))
    told = durable(narrative.tier_narrative(totals, found, by))
    return {
        "tier_breakdown": tiers.tier_breakdown(tiered, accounts, by),
        "tier_overview": tiers.overall_summary(tiered, accounts, by),
        "comment_vs_reply": tiers.comment_vs_reply(tiered, by),
        "tier_totals": totals,
        "tier_words": keywords.top_words(tiered, [*by, "tier"]),
        "tier_pairs": keywords.top_pairs(tiered, [*by, "tier"]),
        "tier_keywords": words,
        "tier_themes": found,
        "tier_examples": examples,
        "tier_narrative": told,
        "tier_deep_dive": tiers.nested_dive(totals, found, words, examples, by, told),
    }


def evidence_tables(
    metrics: dict[str, DataFrame], tables: dict[str, DataFrame], by: Sequence[str] = ("run_id",)
) -> tuple[DataFrame, DataFrame]:
    """(metric facts, causal terms) a narrative may cite."""
    card = tables["tier_breakdown"].withColumnRenamed("comment_count", "_tops").withColumnRenamed(
        "total_count", "comment_count"
    )
    pairs = tables["tier_pairs"].withColumnRenamed("theme", "label")
    facts = narrative.metric_facts(
        metrics["overall"], metrics["data_quality"], card, pairs, by
    )
    return facts, narrative.causal_terms(pairs, tables["tier_keywords"], by)


def audited_narratives(
    runs: DataFrame, candidates: DataFrame, facts: DataFrame, terms: DataFrame,
    fallback: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """Check candidate narratives (JSON text) and choose one per run."""
    claims, misshapen = audit.candidate_claims(candidates)
    judged = audit.verdicts(audit.audit_claims(claims, audit.run_evidence(facts, terms)))
    columns = ["run_id", "attempt", "accepted", "reject_reason"]
    rejects = misshapen.withColumn("accepted", F.lit(False))
    both = judged.select(*columns).unionByName(rejects.select(*columns))
    return audit.select_narratives(runs, claims, both, fallback)


def reused_narratives(
    runs: DataFrame, candidates: DataFrame, facts: DataFrame, terms: DataFrame, fallback: DataFrame,
    store: BatchLog, batch_id: int, fresh: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``audited_narratives``, but a run whose facts are known keeps the narrative accepted for them.

    ``store`` is a log keyed by ``fingerprint``. Runs that may take a candidate and whose
    fingerprint the store holds are neither audited nor stored again; ``fresh`` audits all.
    What the others have accepted is published as batch ``batch_id`` in one commit: readers
    see all of it or nothing, and publishing a batch again replaces it. Of several runs with
    the same facts, the first one's narrative is stored. A run without facts is never reused.
    """
    prints = narrative.fingerprint(facts, [audit.RUN])
    eligible = runs.filter(audit.closed_reason().isNull()).select(audit.RUN)
    held = None if fresh else store.current(batch_id - 1)
    kept = None
    if held is not None:
        # runs and stored narratives are one short row each
        kept = durable(eligible.join(prints, audit.RUN).join(
            held.select("fingerprint", "claims"), "fingerprint"
        ).select(audit.RUN, "claims"))
    rest = (lambda df: df) if kept is None else (lambda df: df.join(kept.select(audit.RUN), audit.RUN, "left_anti"))
    states, told = map(durable, audited_narratives(
        rest(runs), rest(candidates), rest(facts), rest(terms), rest(fallback)
    ))
    claim = F.struct("section", "idx", "title", "body")
    accepted = (
        told.join(states.filter("source = 'llm'").select(audit.RUN), audit.RUN, "left_semi")
        .groupBy(audit.RUN).agg(F.array_sort(F.collect_list(claim)).alias("claims"))
        .join(prints, audit.RUN)
    )
    store.append(accepted.groupBy("fingerprint").agg(F.min_by("claims", audit.RUN).alias("claims")), batch_id)
    if kept is None:
        return states, told
    none = {"attempt": F.lit(None).cast(states.schema["attempt"].dataType), "reject_reason": F.lit(None).cast("string")}
    known = kept.select(
        audit.RUN, F.lit(audit.STATUS_ACCEPTED).alias("status"), F.lit("llm").alias("source"),
        *[v.alias(k) for k, v in none.items()],
    )
    return (
        states.unionByName(known.select(*states.columns)),
        told.unionByName(kept.select(audit.RUN, F.inline("claims")).select(*told.columns)),
    )


def report_tables(
    analyzed: DataFrame, accounts: DataFrame | None, by: Sequence[str] = ("run_id",),
    population_videos: int | None = None, **themes,
) -> dict[str, DataFrame]:
    """All report tables of all runs. Pass a durable analyzed table.

    ``accounts`` carries the run columns too: each run has its own videos.
    """
    by = list(by)
    metrics = metric_tables(analyzed, by)
    tiered = durable(tiers.attach_tier(analyzed, accounts, by))
    tables = tier_tables(tiered, accounts, by, **themes)
    facts, terms = evidence_tables(metrics, tables, by)
    return {
        **metrics, **tables,
        "narrative": narrative_rows(metrics, by, population_videos),
        "facts": facts, "causal_terms": terms,
        "fingerprint": narrative.fingerprint(facts, by),
    }
