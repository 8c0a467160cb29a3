"""Nested comments -> analyzed table and analysis sections."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolens import constants as C
from echolens import schema as S
from echolens.operators import classify, exclusion, keywords, learned, summary
from echolens.session import durable


@dataclass
class AnalyzeOptions:
    """What an analysis run is configured with."""

    exclude: DataFrame | Sequence[str] = ()
    stopwords: Iterable[str] | None = None
    slang: Mapping[str, str] = field(default_factory=lambda: C.SLANG)
    stems: object = None
    lexicon: Mapping[str, float] | DataFrame = field(default_factory=lambda: C.LEXICON)
    # A prediction struct<label, score> column over text_raw, or a fitted classifier;
    # the built-in lexicon classifier is used without one.
    scorer: Column | learned.LearnedScorer | None = None
    # Precomputed second opinions and the confidence below which they are asked.
    fallback: DataFrame | None = None
    threshold: float | None = None


def label_rows(rows: DataFrame, options: AnalyzeOptions) -> DataFrame:
    """Text stages, stems and sentiment for rows that still need them."""
    if options.fallback is not None:
        rows = classify.second_opinions(rows, options.fallback)
    text = classify.preprocess(rows, options.stopwords, options.slang)
    if options.stems is not None or isinstance(options.lexicon, DataFrame):
        text = durable(text)
    stemmed = classify.stem_tokens(text, options.stems)
    if options.scorer is None:
        labeled = classify.lexicon_classify(stemmed, options.lexicon)
        if options.fallback is None:
            return labeled.drop("lexicon_score", "oov_ratio")
        base = labeled.withColumnRenamed("sentiment_label", "base_label").withColumnRenamed(
            "sentiment_confidence", "base_confidence"
        ).drop("sentiment_method", "lexicon_score", "oov_ratio")
    elif isinstance(options.scorer, learned.LearnedScorer):
        base = options.scorer.predict(stemmed)
    else:
        scored = stemmed.withColumn("_prediction", options.scorer)
        base = classify.base_prediction(scored, F.col("_prediction")).drop("_prediction")
    return classify.cascade(base, options.fallback, options.threshold)


def analyze(
    flat: DataFrame, options: AnalyzeOptions, log: DataFrame | None = None,
    only: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """All sections of an analysis run, or those named in ``only``.

    Keywords run work while they are defined, so a caller of other sections names them;
    ``overall_keywords`` and ``label_keywords`` are the two parts of that section.

    The analyzed table is written once and read by every section; a single section
    that reads it once gets the rows themselves. With a log of
    earlier results, finished comments of the same mode are reused and only the
    rest is processed.
    """
    marked = exclusion.mark_exclusions(flat, options.exclude)
    kept = exclusion.analyzed_rows(marked)
    columns = [*S.FLAT_COLUMNS, *S.ANALYZED_COLUMNS]
    if log is None:
        rows = label_rows(kept, options).select(*columns)
    else:
        done = classify.reusable(log, hybrid=options.fallback is not None)
        fresh = label_rows(classify.pending(kept, done), options)
        rows = fresh.select(*columns).unionByName(classify.finished(kept, done).select(*columns))
    read_once = only is not None and len(only) == 1 and only[0] != "keywords"
    analyzed = rows if read_once else durable(rows)
    sections = {
        "meta": lambda: summary.run_meta(marked),
        "method_breakdown": lambda: summary.method_breakdown(analyzed),
        "sentiment_summary": lambda: summary.sentiment_summary(analyzed),
        "keywords": lambda: _overall(analyzed).unionByName(_by_label(analyzed)),
        "per_video": lambda: summary.per_video(analyzed),
        "comments": lambda: analyzed,
        "top_accounts": lambda: exclusion.top_accounts(marked),
        "failure_gate": lambda: classify.failure_gate(analyzed),
    }
    parts = {
        "overall_keywords": lambda: _overall(analyzed),
        "label_keywords": lambda: _by_label(analyzed),
    }
    named = {**sections, **parts}
    return {name: named[name]() for name in (sections if only is None else only)}


def _overall(analyzed: DataFrame) -> DataFrame:
    return keywords.tfidf_keywords(analyzed).withColumn("scope", F.lit("overall"))


def _by_label(analyzed: DataFrame) -> DataFrame:
    by_label = keywords.tfidf_keywords(analyzed, ["sentiment_label"], k=10)
    return by_label.withColumnRenamed("sentiment_label", "scope")
