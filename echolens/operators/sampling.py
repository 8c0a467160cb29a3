"""Tier-quota sampling, label sampling and the sample manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.functions.numbers import duration_text
from echolens.functions.text import classify_tier, tier_rank

# Sort keys are grouped into this many ranges to find where a sample ends.
KEY_RANGES = 1 << 16


def check_quota(quota: Sequence[int]) -> tuple[int, int, int]:
    if len(quota) != 3 or any(not isinstance(q, int) or q < 0 for q in quota):
        raise ValueError("quota needs three non-negative whole percentages")
    if sum(quota) != 100:
        raise ValueError(f"quota must add up to 100, got {sum(quota)}")
    return tuple(quota)


def tier_spine(groups: DataFrame | None, by: Sequence[str], spark=None) -> DataFrame:
    """All four tiers for every group, so an empty tier still has its row."""
    tiers = F.explode(F.array(*[F.lit(t) for t in C.TIERS])).alias("tier")
    if not by:
        return spark.range(1).select(tiers)
    return groups.select(*by).distinct().select(*by, tiers)


def tier_availability(videos: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Videos per tier before sampling, zero-filled."""
    tiered = videos.select(*by, classify_tier(F.col("account_type")).alias("tier"))
    counts = tiered.groupBy(*by, "tier").agg(F.count(F.lit(1)).alias("available"))
    spine = tier_spine(videos, by, videos.sparkSession)
    return spine.join(counts, [*by, "tier"], "left").select(
        *by, "tier", F.coalesce("available", F.lit(0)).alias("available")
    )


def allocate(
    available: DataFrame, size: int | Column, quota: Sequence[int] = C.DEFAULT_QUOTA,
    by: Sequence[str] = (),
) -> DataFrame:
    """Whole slots per tier: largest remainder, then unfilled slots flow down.

    Integer arithmetic throughout, so equal fractions tie exactly. Spill is the
    closed form of the priority-order loop: with P the running sum of wanted
    minus available, the slots passed on are P minus its running minimum
    (floored at zero).
    """
    percents = (*check_quota(quota), 0)
    size = F.lit(size) if isinstance(size, int) else size
    percent = F.element_at(
        F.create_map(*[F.lit(x) for pair in zip(C.TIERS, percents) for x in pair]), F.col("tier")
    )
    share = available.select(
        *by, "tier", "available", tier_rank(F.col("tier")).alias("priority"),
        size.cast("bigint").alias("requested"), percent.alias("percent"),
    )
    slots = F.col("requested") * F.col("percent")
    group = Window.partitionBy(*by)
    by_fraction = group.orderBy(F.col("fraction").desc(), "priority")
    wanted = (
        share.withColumn("floor", F.floor(slots / 100))
        .withColumn("fraction", F.when(F.col("tier") != "unknown", slots % 100).otherwise(-1))
        .withColumn("leftover", F.col("requested") - F.sum("floor").over(group))
        .withColumn(
            "wanted",
            F.col("floor")
            + F.when(F.row_number().over(by_fraction) <= F.col("leftover"), 1).otherwise(0),
        )
    )
    downwards = group.orderBy("priority")
    running = downwards.rowsBetween(Window.unboundedPreceding, 0)
    spilled = (
        wanted.withColumn("excess", F.sum(F.col("wanted") - F.col("available")).over(running))
        .withColumn("spill", F.col("excess") - F.least(F.lit(0), F.min("excess").over(running)))
        .withColumn("inflow", F.coalesce(F.lag("spill").over(downwards), F.lit(0)))
    )
    return spilled.select(
        *by, "tier", "priority", "requested", "percent", "available",
        (F.col("wanted") + F.col("inflow") - F.col("spill")).cast("bigint").alias("allocated"),
        F.last("spill").over(
            downwards.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ).alias("unfilled"),
    )


def draw_key(seed: int | Column, key: Column, purpose: str) -> Column:
    """Reproducible pseudo-random sort key.

    A hash of the id, not ``rand``: the same seed gives the same sample however
    the data is partitioned, and after a lost executor is replaced.
    """
    seed = F.lit(str(seed)) if isinstance(seed, int) else seed
    return F.md5(F.concat_ws(":", seed, F.lit(purpose), key))


def smallest_keys(
    rows: DataFrame, groups: DataFrame, by: Sequence[str], key: str, limit: str
) -> DataFrame:
    """Rows with the ``limit`` smallest keys per group, ``limit`` varying by group.

    A tier can hold most of all videos, so it is never sorted in one task. Rows
    are counted per key range first; whole ranges below the cut are kept
    without ordering and only the range that contains the cut is ranked.
    """
    span = F.conv(F.substring(F.col(key), 1, 4), 16, 10).cast("int")
    ranged = rows.withColumn("_range", span)
    counts = ranged.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    filled = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    # one row per group: the range holding the last kept row, and its share
    cut = (
        filled.join(groups.select(*by, F.col(limit).alias("_limit")), list(by))
        .filter("_before < _limit")
        .groupBy(*by)
        .agg(
            F.max("_range").alias("_cut"),
            F.max_by(F.col("_limit") - F.col("_before"), F.col("_range")).alias("_share"),
        )
    )
    if list(by) == ["tier"]:
        # one row per tier
        cut = F.broadcast(cut)
    near = ranged.join(cut, list(by)).filter("_range <= _cut")
    whole = near.filter("_range < _cut")
    inside = Window.partitionBy(*by).orderBy(key)
    edge = (
        near.filter("_range = _cut")
        .withColumn("_place", F.row_number().over(inside))
        .filter("_place <= _share")
        .drop("_place")
    )
    return whole.unionByName(edge).drop("_range", "_cut", "_share")


def quota_sample(
    videos: DataFrame, size: int, quota: Sequence[int] = C.DEFAULT_QUOTA, seed: int = 0,
    by: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Tier-stratified sample in mixed order -> (sample, allocation per tier).

    The final order is a second hash, so a collection run that stops half-way
    still covers all tiers.
    """
    tiered = videos.withColumn("tier", classify_tier(F.col("account_type"))).withColumn(
        "_key", draw_key(seed, F.col("video_id"), "draw")
    )
    allocation = allocate(tier_availability(videos, by), size, quota, by)
    picked = smallest_keys(tiered, allocation, [*by, "tier"], "_key", "allocated")
    ordered = picked.withColumn("position", draw_key(seed, F.col("video_id"), "order"))
    return ordered.drop("_key"), allocation


def label_sample(comments: DataFrame, size: int, seed: int) -> DataFrame:
    """Uniform sample without replacement for human labeling."""
    drawn = comments.orderBy(draw_key(seed, F.col("comment_id"), "label")).limit(size)
    return drawn


def require_enough(comments: DataFrame, size: int) -> None:
    found = comments.limit(size).count()
    if found < size:
        raise ValueError(f"only {found} eligible comments available, need {size}")


def without_labeled(comments: DataFrame, labeled: DataFrame) -> DataFrame:
    """Drop comments that already carry a human label (text ids, no apostrophe)."""
    done = labeled.select(F.regexp_replace("comment_id", "^'+", "").alias("comment_id")).distinct()
    return comments.join(done, "comment_id", "left_anti")


def without_collected(videos: DataFrame, collected: DataFrame) -> DataFrame:
    """Drop videos *collected* in earlier runs; merely sampled ones stay."""
    return videos.join(collected.select("video_id").distinct(), "video_id", "left_anti")


def union_of_runs(runs: Sequence[DataFrame]) -> DataFrame:
    """Distinct video ids over all runs."""
    ids = [r.select("video_id") for r in runs]
    merged = ids[0]
    for part in ids[1:]:
        merged = merged.unionByName(part)
    return merged.distinct()


def manifest(
    allocation: DataFrame, seed: int, duplicates: int | Column, excluded: int | Column,
    source: str, exclude_sources: Sequence[str] = (), by: Sequence[str] = (),
) -> DataFrame:
    """One record per run that answers "why these videos" later."""

    def per_tier(column: str) -> Column:
        # four rows per run
        entries = F.array_sort(F.collect_list(F.struct("priority", "tier", column)))
        return F.map_from_entries(
            F.transform(entries, lambda r: F.struct(r["tier"], r[column]))
        )

    def as_column(value: int | Column) -> Column:
        return F.lit(value) if isinstance(value, int) else value

    record = allocation.groupBy(*by).agg(
        F.max("requested").alias("requested_size"),
        F.sum("allocated").alias("sampled"),
        per_tier("percent").alias("quota_percent"),
        per_tier("available").alias("available_per_tier"),
        per_tier("allocated").alias("sampled_per_tier"),
        F.max("unfilled").alias("unfilled_slots"),
    )
    return record.select(
        *by,
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"),
        F.lit(source).alias("input"), "requested_size", "sampled",
        F.lit(seed).alias("seed"),
        F.map_filter("quota_percent", lambda t, _: t != "unknown").alias("quota_percent"),
        "available_per_tier", "sampled_per_tier", "unfilled_slots",
        as_column(duplicates).cast("bigint").alias("duplicate_rows_dropped"),
        as_column(excluded).cast("bigint").alias("excluded_already_scraped"),
        F.lit(list(exclude_sources)).cast("array<string>").alias("exclude_sources")
        if exclude_sources else F.array().cast("array<string>").alias("exclude_sources"),
        duration_text(F.col("sampled")).alias("estimated_batch_duration"),
    )
