"""The learned base classifier on labels it has not seen.

The language of a post stands in for a human label: like one it shows in the
words, in rows of any length. What a fit answers cannot be said in SQL; the
statements give the rows it must answer for and the accuracy it must reach.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.registry import register
from catalog.sql import query
from echolens import constants as C
from echolens.operators import calibrate, learned
from echolens.session import durable, workspace

LEAST_ACCURACY = 0.9
TRUTHS = {"en": C.POSITIVE, "fr": C.NEUTRAL, "de": C.NEGATIVE}


def _held_out(spark, sf):
    """Truth and prediction of every fourth labeled post, by a saved and reloaded classifier."""
    language = F.substring_index("video_id", "-", 1)
    truth = F.coalesce(*[F.when(language == k, v) for k, v in TRUTHS.items()])
    rows = durable(
        V.tokenized(spark, sf).withColumn("truth", truth)
        .select("seq", "comment_id", "text_raw", "tokens_stemmed", "truth")
    ).filter("truth IS NOT NULL")
    path = workspace(spark, "classifier")
    learned.fit(rows.filter("seq % 4 <> 2"), label="truth").save(path)
    scorer = learned.LearnedScorer.load(spark, path)
    answers = scorer.predict(rows.filter("seq % 4 = 2"))
    return durable(
        answers.select("comment_id", "truth", F.col("base_label").alias("label"), F.col("base_confidence").alias("confidence"))
    )


_KNOWN = """
SELECT * FROM documents WHERE lang IN ('en', 'fr', 'de') AND doc_id % 4 = 2"""


@register("learned_accuracy", query("", """
SELECT count(*) AS total, count(*) AS answered, true AS accurate FROM known""", known=_KNOWN))
def learned_accuracy(spark, sf):
    pairs = _held_out(spark, sf)
    return pairs.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("label").isNotNull() & F.col("confidence").between(0, 1)).alias("answered"),
        (F.avg((F.col("label") == F.col("truth")).cast("int")) >= LEAST_ACCURACY).alias("accurate"),
    )


@register("learned_threshold_sweep", query("", f"""
SELECT threshold, (SELECT count(*) FROM known) AS total, true AS accurate
FROM (SELECT unnest([{', '.join(str(float(t)) for t in C.THRESHOLDS)}]::DOUBLE[]) AS threshold)""", known=_KNOWN))
def learned_threshold_sweep(spark, sf):
    """What is kept at a threshold of the calibrated confidence is at least as accurate as the whole must be."""
    sweep = calibrate.threshold_sweep(_held_out(spark, sf))
    return sweep.select(
        "threshold", (F.col("kept") + F.col("escalated")).alias("total"),
        F.coalesce(F.col("kept_accuracy") >= LEAST_ACCURACY, F.lit(True)).alias("accurate"),
    )
