"""Classifier accuracy and the confidence-threshold sweep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.functions.numbers import pct
from echolens.functions.text import strip


def labeled_predictions(labels: DataFrame, predictions: DataFrame) -> DataFrame:
    """Human labels with their predictions; blank text counts as neutral."""
    rows = labels.select("comment_id", "comment", F.col("label").alias("truth")).join(
        predictions, "comment_id"
    )
    blank = strip(F.coalesce("comment", F.lit(""))) == ""
    return rows.withColumn("label", F.when(blank, C.NEUTRAL).otherwise(F.col("label")))


def accuracy(pairs: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    counts = pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("label") == F.col("truth")).alias("correct"),
    )
    share = F.coalesce(F.col("correct") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0))
    return counts.select(
        *by, "correct", "total", pct(F.col("correct"), F.col("total")).alias("accuracy_pct"),
        (share >= C.ACCURACY_TARGET).alias("passes"),
    )


def confusion(pairs: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    return pairs.groupBy(*by, "truth", "label").agg(F.count(F.lit(1)).alias("n"))


def threshold_sweep(
    pairs: DataFrame, thresholds: Sequence[float] = C.THRESHOLDS, by: Sequence[str] = ()
) -> DataFrame:
    """Kept and escalated rows and their accuracy for every candidate.

    Each row falls between two neighbouring candidates. Counting rows per gap
    and summing the gaps replaces comparing every row with every candidate.
    """
    levels = F.array(*[F.lit(float(t)) for t in sorted(thresholds)])
    passed = F.size(F.filter(levels, lambda t: F.col("confidence") >= t))
    gaps = pairs.groupBy(*by, passed.alias("_gap")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("label") == F.col("truth")).alias("right"),
    )
    per_run = gaps.groupBy(*by).agg(
        F.sum("n").alias("_n"), F.sum("right").alias("_right"),
        # at most one entry per gap
        F.collect_list(F.struct("_gap", "n", "right")).alias("_gaps"),
    )
    places = F.posexplode(levels).alias("_i", "threshold")
    rows = per_run.select(*by, "_n", "_right", "_gaps", places)

    def kept_sum(field: str):
        inside = F.filter("_gaps", lambda g: g["_gap"] > F.col("_i"))
        return F.aggregate(inside, F.lit(0).cast("bigint"), lambda s, g: s + g[field])

    sums = rows.withColumn("kept", kept_sum("n")).withColumn("kept_right", kept_sum("right"))
    escalated, missed = F.col("_n") - F.col("kept"), F.col("_right") - F.col("kept_right")
    return sums.select(
        *by, "threshold", "kept", escalated.alias("escalated"),
        pct(escalated, F.col("_n")).alias("escalated_pct"),
        (F.col("kept_right") / F.nullif("kept", F.lit(0))).alias("kept_accuracy"),
        (missed / F.nullif(escalated, F.lit(0))).alias("escalated_accuracy"),
    )


def choose_threshold(
    sweep: DataFrame, target: float = C.ACCURACY_TARGET, by: Sequence[str] = ()
) -> DataFrame:
    """Lowest candidate whose kept rows reach the target, else the highest."""
    reached = F.when(F.col("kept_accuracy") >= target, F.col("threshold"))
    return sweep.groupBy(*by).agg(
        F.coalesce(F.min(reached), F.max("threshold")).alias("threshold"),
        F.coalesce(F.bool_or(F.col("kept_accuracy") >= target), F.lit(False)).alias("reached"),
    )
