"""Numeric column helpers: exact rounding, percentages, net score, formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from echolens import constants as C

# Splits a double into two halves of at most 26 bits each, so that a product
# with a small integer is exact.
_SPLIT = float(2**27 + 1)


def round_exact(value: Column, digits: int = 1) -> Column:
    """Round the *binary* value, ties to even.

    Spark's ``round`` works on the shortest decimal text of a double, so 2.675
    becomes 2.68 and 12.25 becomes 12.3. Report figures follow IEEE rounding
    instead (2.67, 12.2). Everything stays in double arithmetic inside
    whole-stage codegen: the value is split in two exact halves, so the sign of
    ``value * 10^digits - (k + 0.5)`` is known without rounding error.
    """
    scale = float(10**digits)
    size = F.abs(value.cast("double"))
    high = size * _SPLIT - (size * _SPLIT - size)
    low = size - high
    whole = F.floor(size * scale).cast("double")
    over = (high * scale - (whole + 0.5)) + low * scale
    up = (over > 0) | ((over == 0) & (whole % 2 == 1))
    return F.signum(value.cast("double")) * (whole + F.when(up, 1.0).otherwise(0.0)) / scale


def pct(part: Column, total: Column, digits: int = 1) -> Column:
    """``100 * part / total``, 0.0 for an empty total."""
    ratio = F.lit(100.0) * part / F.nullif(total, F.lit(0))
    return F.coalesce(round_exact(ratio, digits), F.lit(0.0))


def classified_base(pos: Column, neg: Column, neu: Column) -> Column:
    """The one denominator of every net figure: unclassified rows stay out."""
    return pos + neg + neu


def net_score(pos: Column, neg: Column, neu: Column) -> Column:
    """Percent positive minus percent negative over the classified base."""
    return pct(pos - neg, classified_base(pos, neg, neu), 1)


def label_count(label: str, column: str = "sentiment_label") -> Column:
    """Rows with a label; a missing label counts as unclassified."""
    return F.count_if(F.coalesce(F.col(column), F.lit(C.UNCLASSIFIED)) == label)


def label_counts(column: str = "sentiment_label") -> list[Column]:
    """pos / neg / neu / unk aggregates."""
    names = ("pos", "neg", "neu", "unk")
    return [label_count(lab, column).alias(n) for lab, n in zip(C.LABELS, names)]


def id_number(value: Column) -> Column:
    """1234567 -> ``1.234.567``."""
    return F.replace(F.format_number(value, 0), F.lit(","), F.lit("."))


def signed(value: Column, digits: int = 1) -> Column:
    """``%+.1f`` of the exactly rounded value; a negative zero, as a rounded share may be, has no sign."""
    plain = value.cast("double") + F.lit(0.0)
    return F.format_string(f"%+.{digits}f", round_exact(plain, digits))


def duration_text(videos: Column) -> Column:
    """Estimated collection time, ``3h 25m`` or ``41m``."""
    seconds = videos.cast("bigint") * C.SECONDS_PER_VIDEO
    hours = F.floor(seconds / 3600)
    minutes = F.floor(F.pmod(seconds, F.lit(3600)) / 60)
    return F.when(hours > 0, F.format_string("%dh %dm", hours, minutes)).otherwise(
        F.format_string("%dm", minutes)
    )


def trend_word(delta: Column) -> Column:
    return (
        F.when(delta > 2, "naik").when(delta < -2, "turun").when(delta.isNotNull(), "stabil")
    )


def month_label(month: Column) -> Column:
    """``2026-01`` -> ``Jan 26``."""
    names = F.array(*[F.lit(n) for n in C.MONTH_NAMES])
    number = F.substring(month, 6, 2).cast("int")
    return F.concat_ws(" ", F.try_element_at(names, number), F.substring(month, 3, 2))
