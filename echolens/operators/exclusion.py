"""Internal-account exclusion and the top-sender transparency table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.operators.skew import first_rows, lookup_join

# A hand-kept list may be inlined as literals up to this size.
INLINE_LIMIT = 1000


def mark_exclusions(flat: DataFrame, accounts: DataFrame | Sequence[str]) -> DataFrame:
    """Flag excluded rows; nothing is dropped here.

    Exact, case-sensitive. The uploader rule wins over the account list. A
    short list becomes a literal set; a long one or a table is joined, and a sender with a
    large share of all rows does not end up in one task.
    """
    if not isinstance(accounts, DataFrame) and len(accounts) > INLINE_LIMIT:
        names = [(name,) for name in accounts]
        accounts = flat.sparkSession.createDataFrame(names, "username string")
    if isinstance(accounts, DataFrame):
        listed = accounts.select("username", F.lit(True).alias("_listed")).distinct()
        rows = lookup_join(flat, listed, "username", spread=["seq"])
        internal = F.coalesce("_listed", F.lit(False))
    else:
        rows = flat
        internal = F.col("username").isin(list(accounts)) if accounts else F.lit(False)
    uploader = (F.col("username") != "") & (
        F.col("username") == F.col("video_author_username")
    )
    reason = F.when(uploader, C.REASON_UPLOADER).when(internal, C.REASON_INTERNAL)
    return (
        rows.withColumn("exclude_reason", reason)
        .withColumn("excluded", F.col("exclude_reason").isNotNull())
        .select(*flat.columns)
    )


def analyzed_rows(marked: DataFrame) -> DataFrame:
    return marked.filter("NOT excluded")


def top_accounts(
    marked: DataFrame, k: int = C.TOP_ACCOUNTS, by: Sequence[str] = ()
) -> DataFrame:
    """Most frequent senders over all rows, excluded or not.

    Ties keep the order of first appearance.
    """
    flagged = F.when(F.col("excluded"), F.col("seq"))
    counts = (
        marked.filter("username <> ''")
        .groupBy(*by, "username")
        .agg(
            F.count(F.lit(1)).alias("total_muncul"),
            F.min("seq").alias("_seen"),
            F.min_by("exclude_reason", flagged).alias("_reason"),
        )
    )
    best = first_rows(counts, by, [F.col("total_muncul").desc(), F.col("_seen")], k)
    return best.select(
        *by, "rank", "username", "total_muncul",
        F.coalesce("_reason", F.lit(C.REASON_UNKNOWN_TEXT)).alias("alasan"),
    )
