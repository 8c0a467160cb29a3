"""Text stages and the base-classifier-then-fallback cascade."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.functions import text as X
from echolens.functions.numbers import round_exact
from echolens.operators.skew import lookup_join
from echolens.session import durable

# Either may repeat (a comment over runs, a position over reads), not both together.
ROW_KEY = ("comment_id", "seq")


def preprocess(
    df: DataFrame, stopwords: Iterable[str] | None = None,
    slang: Mapping[str, str] = C.SLANG, text: str = "text_raw",
) -> DataFrame:
    """The fixed stage order, in one place: emoji, case, clean, normalize,
    tokenize, stopwords. ``text_clean`` is the text after *clean*.

    Everything is a column expression: one narrow stage, whole texts, no
    shuffle and no Python. Stemming follows in ``stem_tokens``.
    """
    listed = X.stopwords_without_negations(stopwords)
    # one column per costly step, so that no step is evaluated twice
    steps = (
        df.withColumn("emoji_found", X.emoji_found(F.col(text)))
        .withColumn("_low", X.lower_text(X.without_emoji(F.col(text))))
        .withColumn("_folded", X.fold_exceptions(F.col("_low")))
        .withColumn("text_clean", X.clean(F.col("_folded")))
        .withColumn("_short", X.shorten_runs(F.col("text_clean"), cleaned=True))
    )
    tokens = X.drop_words(X.tokenize(X.map_words(F.col("_short"), slang)), listed)
    return steps.withColumn("tokens_stemmed", tokens).drop("_low", "_folded", "_short")


def vocabulary(df: DataFrame, tokens: str = "tokens_stemmed") -> DataFrame:
    """Distinct words and how often each occurs."""
    return (
        X.explode_terms(df, [], F.col(tokens), "word")
        .groupBy("word").agg(F.count(F.lit(1)).alias("uses"))
    )


def row_keys(df: DataFrame, key: str | Sequence[str]) -> list[str]:
    """The columns of ``key`` that ``df`` has."""
    names = [key] if isinstance(key, str) else list(key)
    return [c for c in names if c in df.columns]


def stem_tokens(
    df: DataFrame, stems: DataFrame | Callable[[pd.Series], pd.Series] | None,
    tokens: str = "tokens_stemmed", key: str | Sequence[str] = ROW_KEY,
) -> DataFrame:
    """Replace every token by its stem.

    ``key`` names the columns that tell rows apart; those that ``df`` lacks are
    left out.

    Each *distinct* word is stemmed once: through a ``(word, root)`` table or a
    vectorized function over the vocabulary. Only words that change are joined
    back, with frequent words spread over many tasks. No stems: identity.
    Reads ``df`` three times: pass a written table.
    """
    if stems is None:
        return df
    words = vocabulary(df, tokens)
    if isinstance(stems, DataFrame):
        rooted = words.join(stems.select("word", "root"), "word")
    else:
        rooted = words.withColumn("root", F.pandas_udf(stems, "string")(F.col("word")))
    keys = row_keys(df, key)
    changed = durable(rooted.filter("root IS NOT NULL AND root <> word"))
    exploded = df.select(*keys, F.posexplode(tokens).alias("_pos", "word"))
    found = lookup_join(exploded, changed, "word", weight="uses", spread=[*keys, "_pos"])
    # one row's own tokens come back together: bounded by that row
    rebuilt = found.groupBy(*keys).agg(
        F.transform(
            F.array_sort(
                F.collect_list(F.struct("_pos", F.coalesce("root", "word").alias("t")))
            ),
            lambda r: r["t"],
        ).alias("_stemmed")
    )
    return (
        df.join(rebuilt, keys, "left")
        .withColumn(tokens, F.coalesce("_stemmed", F.array().cast("array<string>")))
        .select(*df.columns)
    )


# --- classifiers -------------------------------------------------------------
def lexicon_classify(
    df: DataFrame, lexicon: Mapping[str, float] | DataFrame = C.LEXICON,
    band: float = C.NEUTRAL_BAND, tokens: str = "tokens_stemmed",
    key: str | Sequence[str] = ROW_KEY,
) -> DataFrame:
    """Built-in base classifier: mean word score against a neutral band."""
    if isinstance(lexicon, DataFrame):
        scored = _table_scores(df, lexicon, tokens, key)
    else:
        # one column per costly step: the rounding would repeat it for each mention
        counted = (
            df.withColumn("_hits", X.known_tokens(F.col(tokens), lexicon))
            .withColumn("_total", X.known_total(F.col("_hits"), lexicon))
            .withColumn("_known", F.size("_hits")).withColumn("_size", F.size(tokens))
        )
        score, oov = X.score_from_totals(F.col("_total"), F.col("_known"), F.col("_size"))
        scored = (
            counted.withColumn("lexicon_score", score).withColumn("oov_ratio", oov)
            .drop("_hits", "_total", "_known", "_size")
        )
    return (
        scored.withColumn("sentiment_label", X.lexicon_label(F.col("lexicon_score"), band))
        .withColumn("sentiment_confidence", X.lexicon_confidence(F.col("lexicon_score"), band))
        .withColumn("sentiment_method", F.lit("lexicon"))
    )


def _table_scores(
    df: DataFrame, lexicon: DataFrame, tokens: str, key: str | Sequence[str]
) -> DataFrame:
    """Scores from a lexicon table of any size, one row per word.

    Scores are summed as decimals, so the total does not depend on row order.
    Reads ``df`` twice: pass a written table.
    """
    keys = row_keys(df, key)
    words = X.explode_terms(df, keys, F.col(tokens), "word")
    # looked up before anything is grouped: a lexicon of checked size is broadcast by
    # the optimizer, and a larger one is a shuffle join that splits frequent words
    known = words.join(lexicon.select("word", "score"), "word")
    totals = known.groupBy(*keys).agg(
        F.sum(F.col("score").cast("decimal(18,9)")).cast("double").alias("_total"),
        F.count(F.lit(1)).alias("_known"),
    )
    score, oov = X.score_from_totals(
        F.coalesce("_total", F.lit(0.0)), F.coalesce("_known", F.lit(0)), F.size(tokens)
    )
    return (
        df.join(totals, keys, "left")
        .withColumn("lexicon_score", score).withColumn("oov_ratio", oov)
        .drop("_total", "_known")
    )


PREDICTION = "struct<label:string, score:double>"


def scorer_udf(load: Callable[[], Callable[[pd.Series], pd.DataFrame]]):
    """Model scorer as a vectorized column function.

    ``load`` runs once per Python worker and returns a function from a batch of
    texts to columns ``label`` and ``score``. If a batch fails its rows are
    scored one by one, so a single bad text never stops the job.
    """

    @F.pandas_udf(PREDICTION)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = load()
        for texts in batches:
            try:
                yield predict(texts)[["label", "score"]].reset_index(drop=True)
            except Exception:  # noqa: BLE001 - isolate the failing row
                yield _row_by_row(predict, texts)

    return score


def _row_by_row(predict, texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        try:
            one = predict(pd.Series([text])).iloc[0]
            rows.append((one["label"], float(one["score"])))
        except Exception:  # noqa: BLE001
            rows.append((None, None))
    return pd.DataFrame(rows, columns=["label", "score"])


def map_model_label(raw: Column) -> Column:
    return F.try_element_at(X.literal_map(C.MODEL_LABELS), F.lower(raw))


def base_prediction(df: DataFrame, prediction: Column, text: str = "text_raw") -> DataFrame:
    """Base label, confidence and method from a raw model prediction.

    Blank text is neutral without asking the model. A missing or unknown raw
    label leaves the label null, which the cascade treats as a failure.
    """
    blank = X.strip(F.coalesce(F.col(text), F.lit(""))) == ""
    label = map_model_label(prediction["label"])
    ok = label.isNotNull()
    return (
        df.withColumn("base_label", F.when(blank, C.NEUTRAL).otherwise(label))
        .withColumn(
            "base_confidence",
            F.when(blank, 1.0).when(ok, round_exact(prediction["score"], 4)),
        )
    )


def is_ambiguous(confidence: Column, threshold: float) -> Column:
    """Strictly below the threshold; equal is confident."""
    return confidence < threshold


def _is_kept(threshold: float) -> Column:
    """The base answered and is confident; a missing confidence is not."""
    sure = F.col("base_label").isNotNull() & ~is_ambiguous(F.col("base_confidence"), threshold)
    return F.coalesce(sure, F.lit(False))


def escalated_rows(base: DataFrame, threshold: float) -> DataFrame:
    """The rows to ask a second opinion for: the base failed or is ambiguous."""
    return base.filter(~_is_kept(threshold))


# The column of a row's second opinion, from ``second_opinions``.
ANSWER = "_answer"


def second_opinions(rows: DataFrame, fallback: DataFrame, key: str = "comment_id") -> DataFrame:
    """``rows`` with the most confident answer of the fallback, null without one.

    The join shuffles whole rows: before the text stages they hold each text once.
    """
    best = (
        fallback.filter(F.col("label").isNotNull()).groupBy(key)
        .agg(F.max(F.struct("confidence", "label")).alias(ANSWER))
    )
    return rows.join(best, key, "left").select(*rows.columns, ANSWER)


def cascade(
    base: DataFrame, fallback: DataFrame | None, threshold: float | None,
    key: str = "comment_id",
) -> DataFrame:
    """Keep a confident base prediction, else take the fallback's.

    ``base`` carries base_label and base_confidence (null label: base failed),
    ``fallback(comment_id, label, confidence)`` the precomputed second opinion;
    no answer there means the row stays unclassified, and of several answers the
    most confident one counts; it is joined here unless ``base`` has it. Without a fallback table
    the base result is used as it is.
    """
    out = [c for c in base.columns if c not in ("base_label", "base_confidence", ANSWER)]
    if fallback is None:
        ok = F.col("base_label").isNotNull()
        return base.select(
            *out,
            F.coalesce("base_label", F.lit(C.UNCLASSIFIED)).alias("sentiment_label"),
            F.when(ok, F.col("base_confidence")).otherwise(0.0).alias("sentiment_confidence"),
            F.when(ok, "model").otherwise("model_failed").alias("sentiment_method"),
        )
    if threshold is None:
        raise ValueError("a cascade with a fallback needs a threshold")
    rows = base if ANSWER in base.columns else second_opinions(base, fallback, key)
    label, confidence = F.col(ANSWER)["label"], F.col(ANSWER)["confidence"]
    kept = _is_kept(threshold)
    answered = label.isNotNull()
    return rows.select(
        *out,
        F.when(kept, F.col("base_label")).when(answered, label)
        .otherwise(C.UNCLASSIFIED).alias("sentiment_label"),
        F.when(kept, F.col("base_confidence")).when(answered, confidence)
        .otherwise(0.0).alias("sentiment_confidence"),
        F.when(kept, "model").when(answered, "llm").otherwise("llm_failed")
        .alias("sentiment_method"),
    )


def failure_gate(df: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Does the failure share among escalated rows exceed ten percent?"""
    by = list(by)
    method = F.coalesce("sentiment_method", F.lit(""))
    counts = df.groupBy(*by).agg(
        F.count_if(method.isin("llm", "llm_failed")).alias("escalated"),
        F.count_if(method == "llm_failed").alias("failed"),
    )
    ratio = F.col("failed") / F.nullif(F.col("escalated"), F.lit(0))
    return counts.withColumn(
        "exceeded", F.coalesce(ratio > C.ESCALATION_FAILURE_LIMIT, F.lit(False))
    )


# --- resuming ----------------------------------------------------------------
def reusable(log: DataFrame, hybrid: bool) -> DataFrame:
    """Logged results made in the same mode; an unknown mode is stale."""
    return log.filter(F.col("hybrid_enabled").eqNullSafe(F.lit(hybrid)))


def pending(rows: DataFrame, done: DataFrame, key: str = "comment_id") -> DataFrame:
    return rows.join(done.select(key).distinct(), key, "left_anti")


def finished(rows: DataFrame, done: DataFrame, key: str = "comment_id") -> DataFrame:
    """Rows whose logged result is reused."""
    fields = [c for c in done.columns if c not in ("hybrid_enabled", "line")]
    return rows.join(done.select(*fields), key)
