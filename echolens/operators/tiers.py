"""Account tiers: breakdown, overview and deep dive."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.functions.numbers import label_counts, net_score, pct
from echolens.functions.text import classify_tier, literal_map, tier_rank
from echolens.operators import keywords as K
from echolens.operators.ranking import tier_examples
from echolens.operators.sampling import tier_spine
from echolens.operators.skew import lookup_join


def attach_tier(
    df: DataFrame, accounts: DataFrame | None, by: Sequence[str] = ()
) -> DataFrame:
    """Add the tier of each row's video; unmatched videos are ``unknown``.

    A viral video does not make a hot task: see ``lookup_join``.
    """
    if accounts is None:
        return df.withColumn("tier", F.lit("unknown"))
    tiers = accounts.select(
        *by, "video_id", classify_tier(F.col("account_type")).alias("tier")
    )
    rows = lookup_join(df, tiers, [*by, "video_id"], spread=["seq"], probe=True)
    return rows.withColumn("tier", F.coalesce("tier", F.lit("unknown")))


def tier_video_counts(
    tiered: DataFrame, accounts: DataFrame | None, by: Sequence[str] = ()
) -> DataFrame:
    """Videos per tier: of the whole account table when there is one, else the
    distinct videos among the comments."""
    named = F.nullif("video_id", F.lit(""))
    seen = tiered.groupBy(*by, "tier").agg(F.count_distinct(named).alias("_seen"))
    spine = tier_spine(tiered, by, tiered.sparkSession)
    rows = spine.join(seen, [*by, "tier"], "left")
    if accounts is None:
        count: Column = F.col("_seen")
    else:
        known = accounts.groupBy(*by, classify_tier(F.col("account_type")).alias("tier")).agg(
            F.count(F.lit(1)).alias("_known")
        )
        rows = rows.join(known, [*by, "tier"], "left")
        any_known = F.max(F.col("_known").isNotNull()).over(Window.partitionBy(*by))
        count = F.when(any_known, F.col("_known")).otherwise(F.col("_seen"))
    return rows.select(*by, "tier", F.coalesce(count, F.lit(0)).alias("video_count"))


def _spined(df: DataFrame, counts: DataFrame, by: Sequence[str]) -> DataFrame:
    spine = tier_spine(df, by, df.sparkSession)
    names = [c for c in counts.columns if c not in (*by, "tier")]
    rows = spine.join(counts, [*by, "tier"], "left")
    return rows.select(*by, "tier", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


def tier_breakdown(
    tiered: DataFrame, accounts: DataFrame | None, by: Sequence[str] = ()
) -> DataFrame:
    """Scorecard per tier; all four tiers are always there."""
    meaningful = F.size(F.coalesce("tokens_stemmed", F.array().cast("array<string>"))) > 0
    counts = tiered.groupBy(*by, "tier").agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(~F.col("is_reply")).alias("comment_count"),
        F.count_if(F.col("is_reply")).alias("reply_count"),
        F.count_if(meaningful).alias("meaningful_count"),
        *label_counts(),
    )
    rows = _spined(tiered, counts, by).join(
        tier_video_counts(tiered, accounts, by), [*by, "tier"]
    )
    total, good = F.col("total_count"), F.col("meaningful_count")
    return rows.select(
        *by, "tier", F.element_at(literal_map(C.TIER_OVERVIEW_TITLES), F.col("tier")).alias("label"),
        "video_count", "total_count", "comment_count", "reply_count", "meaningful_count",
        pct(good, total).alias("meaningful_pct"), (total - good).alias("noise_count"),
        pct(total - good, total).alias("noise_pct"), "pos", "neg", "neu",
        *[pct(F.col(n), total).alias(f"{n}_pct") for n in ("pos", "neg", "neu")],
        net_score(F.col("pos"), F.col("neg"), F.col("neu")).alias("net"),
    )


def overall_summary(
    tiered: DataFrame, accounts: DataFrame | None, by: Sequence[str] = ()
) -> DataFrame:
    """Video and row counts per tier."""
    counts = tiered.groupBy(*by, "tier").agg(F.count(F.lit(1)).alias("comment_count"))
    return _spined(tiered, counts, by).join(
        tier_video_counts(tiered, accounts, by), [*by, "tier"]
    ).select(*by, "tier", "video_count", "comment_count")


def comment_vs_reply(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~F.col("is_reply")).alias("comment")
    )
    reply = F.col("total") - F.col("comment")
    return counts.select(
        *by, "comment", reply.alias("reply"),
        pct(F.col("comment"), F.col("total")).alias("comment_pct"),
        pct(reply, F.col("total")).alias("reply_pct"),
    )


def tier_totals(
    tiered: DataFrame, accounts: DataFrame | None, by: Sequence[str] = ()
) -> DataFrame:
    """Deep-dive numbers per tier, ordered by volume, with its peers' mean net.

    Peers are the other tiers that have any rows. The windows below run over
    four rows per group.
    """
    counts = tiered.groupBy(*by, "tier").agg(
        F.count(F.lit(1)).alias("comment_count"), *label_counts()
    )
    rows = _spined(tiered, counts, by).join(
        tier_video_counts(tiered, accounts, by), [*by, "tier"]
    )
    group = Window.partitionBy(*by)
    total = F.col("comment_count")
    net = net_score(F.col("pos"), F.col("neg"), F.col("neu"))
    live = (total > 0).cast("int")
    scored = rows.withColumn("net", net).withColumn("_live", live)
    peers = F.sum("_live").over(group) - F.col("_live")
    peer_sum = F.sum(F.col("net") * F.col("_live")).over(group) - F.col("net") * F.col("_live")
    order = group.orderBy(total.desc(), tier_rank(F.col("tier")))
    return scored.select(
        *by, F.row_number().over(order).alias("position"), "tier",
        F.element_at(literal_map(C.TIER_TITLES), F.col("tier")).alias("label"),
        "video_count", "comment_count",
        pct(total, F.sum(total).over(group)).alias("pct_of_total"),
        "pos", "neg", "neu", "unk",
        *[pct(F.col(n), total).alias(f"{n}_pct") for n in ("pos", "neg", "neu", "unk")],
        "net", peers.alias("peers"),
        (peer_sum / F.nullif(peers, F.lit(0))).alias("peer_net"),
    )


def tier_themes(
    tiered: DataFrame, by: Sequence[str] = (),
    themes: Mapping[str, Sequence[str]] = C.THEMES, titles: Mapping[str, str] = C.THEME_TITLES,
) -> DataFrame:
    """Theme counts per tier; a tier without rows lists every theme with 0."""
    found = K.theme_matches(tiered, [*by, "tier"], themes, titles)
    names = F.explode(F.array(*[
        F.struct(F.lit(t).alias("theme"), F.lit(titles.get(t, t)).alias("label"),
                 F.lit(i + 1).alias("declared"))
        for i, t in enumerate(themes)
    ]))
    spine = tier_spine(tiered, by, tiered.sparkSession).select(
        *by, "tier", names.alias("_n")
    ).select(*by, "tier", "_n.*")
    rows = spine.join(found.drop("label"), [*by, "tier", "theme"], "left")
    return rows.select(
        *by, "tier", F.coalesce("rank", "declared").alias("rank"), "theme", "label",
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("share_pct", F.lit(0.0)).alias("share_pct"),
    )


def tier_deep_dive(
    tiered: DataFrame, accounts: DataFrame | None, by: Sequence[str] = (),
    themes: Mapping[str, Sequence[str]] = C.THEMES, titles: Mapping[str, str] = C.THEME_TITLES,
    minimum: int = C.MIN_KEYWORD_DOCS,
) -> DataFrame:
    """One row per tier with themes, keywords and examples as short lists."""
    return nested_dive(
        tier_totals(tiered, accounts, by), tier_themes(tiered, by, themes, titles),
        K.keywords_by_tier(tiered, by, minimum=minimum), tier_examples(tiered, by), by,
    )


def nested_dive(
    totals: DataFrame, themes: DataFrame, keywords: DataFrame, examples: DataFrame, by: Sequence[str] = (),
    narrative: DataFrame | None = None,
) -> DataFrame:
    """The deep dive from tables of tiers that are there already, with the tiers' narrative if it is given.

    Every list is a top-k of fixed length, so the nested row stays small.
    """
    keys = [*by, "tier"]

    def listed(df: DataFrame, name: str, fields: Sequence[str], order: str = "rank") -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct(order, *fields)))
        return df.groupBy(*keys).agg(
            F.transform(ordered, lambda r: r.dropFields(order)).alias(name)
        )

    rows = (
        totals
        .join(listed(themes, "themes", ["theme", "label", "count", "share_pct"]), keys, "left")
        .join(listed(keywords, "keywords", ["keyword", "score", "count", "share_pct"]), keys, "left")
        .join(
            listed(examples, "examples", ["username", "text_raw", "digg_count", "create_time", "sentiment_label"]),
            keys, "left",
        )
    )
    if narrative is not None:
        rows = rows.join(listed(narrative, "narrative", ["title", "body"], "idx"), keys, "left")
    short = F.coalesce(F.size("examples"), F.lit(0)) < C.TIER_EXAMPLES_SHORT
    return rows.withColumn("examples_short", short)
