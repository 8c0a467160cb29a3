"""Summaries, rankings, keywords and tiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.registry import register
from catalog.sql import COUNTS, EXCLUDED_USERS, TIER_OF, net, pct, query, quoted, rnd
from echolens import constants as C
from echolens.functions.text import theme_pattern
from echolens.operators import exclusion, keywords, ranking, summary, tiers

RUN = ["run_id"]


# --- summaries -----------------------------------------------------------------
def _summary_sql(table: str, by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""
SELECT {lead}pos AS positif, neg AS negatif, neu AS netral, unk AS tidak_terklasifikasi,
  {pct("pos", "total", 2)} AS positif_pct, {pct("neg", "total", 2)} AS negatif_pct,
  {pct("neu", "total", 2)} AS netral_pct
FROM (SELECT {lead}count(*) AS total, {COUNTS} FROM {table} {group})"""


@register("sentiment_summary", query("posts", _summary_sql("posts")))
def sentiment_summary(spark, sf):
    return summary.sentiment_summary(V.posts(spark, sf))


@register("sentiment_summary_by_run", query("line_comments", _summary_sql("line_comments", "run_id")))
def sentiment_summary_by_run(spark, sf):
    return summary.sentiment_summary(V.line_comments(spark, sf), RUN)


def _overall_sql(table: str, by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    shares = ", ".join(f"{pct(n, 'total_comments')} AS {n}_pct" for n in ("pos", "neg", "neu", "unk"))
    return f"""
SELECT {lead}total_comments, pos + neg + neu AS classified_total, pos, neg, neu, unk, {shares},
  {net()} AS net_overall, sample_video_count
FROM (SELECT {lead}count(*) AS total_comments, {COUNTS},
  count(DISTINCT nullif(video_id, '')) AS sample_video_count FROM {table} {group})"""


@register("overall_metrics", query("event_comments", _overall_sql("event_comments")))
def overall_metrics(spark, sf):
    return summary.overall_metrics(V.event_comments(spark, sf))


@register("overall_metrics_by_run", query("line_comments", _overall_sql("line_comments", "run_id")))
def overall_metrics_by_run(spark, sf):
    return summary.overall_metrics(V.line_comments(spark, sf), RUN)


@register("method_breakdown", query("posts", f"""
SELECT coalesce(m, method) AS method, coalesce(n, 0) AS n FROM (SELECT unnest({quoted(C.METHODS)}) AS m)
FULL JOIN (SELECT sentiment_method AS method, count(*) AS n FROM posts GROUP BY 1) ON m = method"""))
def method_breakdown(spark, sf):
    return summary.method_breakdown(V.posts(spark, sf))


_QUALITY = f"""
SELECT run_id, unclassified_count, {pct("unclassified_count", "total")} AS unclassified_pct,
  {pct("llm + failed", "total")} AS llm_escalation_pct, {pct("failed", "llm + failed")}
  AS llm_failure_pct
FROM (SELECT run_id, count(*) AS total,
  count(*) FILTER (WHERE sentiment_label = 'tidak_terklasifikasi') AS unclassified_count,
  count(*) FILTER (WHERE sentiment_method = 'llm') AS llm,
  count(*) FILTER (WHERE sentiment_method = 'llm_failed') AS failed FROM {{0}} GROUP BY run_id)"""


@register("data_quality", query("posts", _QUALITY.replace("{0}", "posts")))
def data_quality(spark, sf):
    return summary.data_quality(V.posts(spark, sf), RUN)


@register("run_meta", query("marked", """
SELECT min(create_time) FILTER (WHERE exclude_reason IS NULL) AS date_from,
  max(create_time) FILTER (WHERE exclude_reason IS NULL) AS date_to,
  count(DISTINCT video_id) FILTER (WHERE exclude_reason IS NULL) AS total_videos,
  count(*) AS total_comments_raw, count(exclude_reason) AS total_comments_excluded_internal,
  count(*) - count(exclude_reason) AS total_comments_analyzed FROM marked"""))
def run_meta(spark, sf):
    return summary.run_meta(exclusion.mark_exclusions(V.event_comments(spark, sf), EXCLUDED_USERS))


_PER_VIDEO = """
SELECT video_id, arg_min(video_caption, seq) AS caption, min(seq) AS first_seq,
  count(*) AS total_comments_analyzed, {counts} FROM {table} GROUP BY {by}video_id"""


def _videos_sql(table: str, by: str = "") -> str:
    body = _PER_VIDEO.format(counts=COUNTS, table=table, by=by)
    return body.replace("SELECT video_id", f"SELECT {by}video_id", 1)


@register("per_video", query("order_comments", f"""
SELECT video_id, caption, first_seq, total_comments_analyzed, pos, neg, neu
FROM ({_videos_sql("order_comments")})"""))
def per_video(spark, sf):
    return summary.per_video(V.order_comments(spark, sf))


@register("stage_rows", query("marked", """
SELECT 0 AS stage_no, 'raw' AS stage, count(*) AS rows FROM marked UNION ALL
SELECT 1, 'analyzed', count(*) FROM marked WHERE exclude_reason IS NULL"""))
def stage_rows(spark, sf):
    rows = exclusion.mark_exclusions(V.event_comments(spark, sf), EXCLUDED_USERS)
    return summary.stage_report([("raw", rows), ("analyzed", exclusion.analyzed_rows(rows))])


# --- trend and engagement --------------------------------------------------------
def _trend_sql(table: str, by: str = "") -> str:
    return f"""
SELECT {by}month, {quoted(C.MONTH_NAMES)}[CAST(substr(month, 6, 2) AS INT)] || ' ' ||
  substr(month, 3, 2) AS label, total, pos, neg, neu, unk, {net()} AS net
FROM (SELECT {by}substr(create_time, 1, 7) AS month, count(*) AS total, {COUNTS} FROM {table}
  GROUP BY ALL) WHERE total >= 20"""


def _delta_sql(by: str = "") -> str:
    part = f"PARTITION BY {by.rstrip(', ')} " if by else ""
    delta = rnd("to_net - from_net")
    return f"""
SELECT {by}from_label, to_label, from_net, to_net, {delta} AS delta,
  CASE WHEN {delta} > 2 THEN 'naik' WHEN {delta} < -2 THEN 'turun' ELSE 'stabil' END AS word
FROM (SELECT {by}label AS to_label, net AS to_net, lag(label) OVER ({part}ORDER BY month) AS from_label,
  lag(net) OVER ({part}ORDER BY month) AS from_net,
  row_number() OVER ({part}ORDER BY month DESC) AS rn FROM trend)
WHERE rn = 1 AND from_label IS NOT NULL"""


@register("monthly_trend", query("order_comments", _trend_sql("order_comments")))
def monthly_trend(spark, sf):
    return ranking.monthly_trend(V.order_comments(spark, sf))


@register("monthly_trend_by_run", query("line_comments", _trend_sql("line_comments", "run_id, ")))
def monthly_trend_by_run(spark, sf):
    return ranking.monthly_trend(V.line_comments(spark, sf), RUN)


@register("trend_last_delta", query("order_comments", _delta_sql(), trend=_trend_sql("order_comments")))
def trend_last_delta(spark, sf):
    return ranking.trend_last_delta(ranking.monthly_trend(V.order_comments(spark, sf)))


@register("trend_last_delta_by_run", query(
    "line_comments", _delta_sql("run_id, "), trend=_trend_sql("line_comments", "run_id, ")))
def trend_last_delta_by_run(spark, sf):
    return ranking.trend_last_delta(ranking.monthly_trend(V.line_comments(spark, sf), RUN), RUN)


def _engagement_sql(table: str, by: str = "") -> str:
    part = f"PARTITION BY {by.rstrip(', ')} " if by else ""
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    sums = ", ".join(
        f"coalesce(sum(digg_count) FILTER (WHERE sentiment_label = '{lab}'), 0) AS {n}, "
        f"coalesce(sum(digg_count) FILTER (WHERE sentiment_label = '{lab}' AND rn > 10), 0) AS r_{n}"
        for lab, n in zip(C.CLASSIFIED, ("pos", "neg", "neu"))
    )
    return f"""
SELECT {by}total_likes, {net()} AS net_by_likes, {net("r_pos", "r_neg", "r_neu")}
  AS net_by_likes_trimmed, {pct("top", "total_likes")} AS top10_like_share_pct
FROM (SELECT {by}CAST(sum(digg_count) AS BIGINT) AS total_likes, sum(digg_count) FILTER (WHERE rn <= 10) AS top, {sums}
  FROM (SELECT *, row_number() OVER ({part}ORDER BY digg_count DESC, seq) AS rn FROM {table})
  {group})"""


@register("engagement", query("order_comments", _engagement_sql("order_comments")))
def engagement(spark, sf):
    return ranking.engagement(V.order_comments(spark, sf))


@register("engagement_by_run", query("order_comments", _engagement_sql("order_comments", "run_id, ")))
def engagement_by_run(spark, sf):
    return ranking.engagement(V.order_comments(spark, sf), RUN)


# --- comment selections ----------------------------------------------------------
def _mask(name: str) -> str:
    return (
        f"CASE WHEN length({name}) > 4 THEN substr({name}, 1, 2) || repeat('*', length({name}) - 4) "
        f"|| right({name}, 2) WHEN length({name}) > 0 THEN substr({name}, 1, 1) || "
        f"repeat('*', length({name}) - 1) ELSE '' END"
    )


@register("top_comments", query("event_comments", """
SELECT sentiment_label, rank, username, text_raw, digg_count, substr(create_time, 1, 10) AS create_time,
  sentiment_method FROM (SELECT *, row_number() OVER (PARTITION BY sentiment_label
  ORDER BY digg_count DESC, seq) AS rank FROM event_comments
  WHERE sentiment_label IN ('positif', 'negatif')) WHERE rank <= 8"""))
def top_comments(spark, sf):
    return ranking.top_comments(V.event_comments(spark, sf))


@register("tier_examples", query("tier_posts", f"""
SELECT tier, rank, {_mask("username")} AS username, text_raw, digg_count,
  substr(create_time, 1, 10) AS create_time, sentiment_label
FROM (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY digg_count DESC, comment_id) AS rank
  FROM tier_posts) WHERE rank <= 5"""))
def tier_examples(spark, sf):
    return ranking.tier_examples(tiers.attach_tier(V.posts(spark, sf), V.accounts(spark, sf)))


@register("sample_quotes", query("posts", f"""
SELECT sentiment_label, rank, {_mask("username")} AS masked_username, text_raw
FROM (SELECT *, row_number() OVER (PARTITION BY sentiment_label ORDER BY seq) AS rank FROM posts)
WHERE rank <= 5"""))
def sample_quotes(spark, sf):
    return ranking.sample_quotes(V.posts(spark, sf))


_EXPLORER = {
    "floor_rows": """
SELECT *, CASE sentiment_label WHEN 'positif' THEN 1 WHEN 'negatif' THEN 2 WHEN 'netral' THEN 3 ELSE 4 END
  AS stage, rn AS place FROM (SELECT *, row_number() OVER (PARTITION BY sentiment_label
  ORDER BY digg_count DESC, seq) AS rn FROM event_comments) WHERE rn <= 37""",
    "left1": "SELECT * FROM event_comments WHERE seq NOT IN (SELECT seq FROM floor_rows)",
    "crit": """
SELECT *, 5 AS stage, row_number() OVER (ORDER BY seq) AS place FROM left1
WHERE sentiment_label IN ('negatif', 'tidak_terklasifikasi')""",
    "crit_kept": "SELECT * FROM crit WHERE place <= 150 - (SELECT count(*) FROM floor_rows)",
    "left2": "SELECT * FROM left1 WHERE seq NOT IN (SELECT seq FROM crit_kept)",
    "loud": """
SELECT *, 6 AS stage, row_number() OVER (ORDER BY digg_count DESC, seq) AS place FROM left2""",
    "loud_kept": """
SELECT * FROM loud WHERE place <= 150 - (SELECT count(*) FROM floor_rows)
  - (SELECT count(*) FROM crit_kept)""",
    "chosen": """
SELECT * EXCLUDE (rn) FROM floor_rows UNION ALL BY NAME SELECT * FROM crit_kept
UNION ALL BY NAME SELECT * FROM loud_kept""",
}


@register("explorer_rows", query("event_comments", """
SELECT row_number() OVER (ORDER BY digg_count DESC, stage, place) AS position, seq, sentiment_label,
  digg_count, sentiment_method, substr(create_time, 1, 10) AS create_time,
  substr(text_raw, 1, 400) AS text_raw FROM chosen""", **_EXPLORER))
def explorer_rows(spark, sf):
    return ranking.explorer_rows(V.event_comments(spark, sf))


# --- leaderboards ----------------------------------------------------------------
_SCORED = f"""
SELECT *, pos + neg + neu AS total, {net()} AS net, coalesce(nullif(caption, ''), '(tanpa caption)')
  AS title FROM videos WHERE pos + neg + neu > 0"""


def _board_sql(by: str = "") -> str:
    part = f"PARTITION BY {by.rstrip(', ')} " if by else ""
    boards = (
        ("worst", "WHERE total >= 30", "net, total DESC, first_seq"),
        ("best", "WHERE total >= 30", "net DESC, total DESC, first_seq"),
        ("loudest", "", "total DESC, first_seq"),
    )
    return " UNION ALL ".join(
        f"SELECT {by}'{name}' AS board, rank, video_id, title AS caption, total, pos, neg, neu, net "
        f"FROM (SELECT *, row_number() OVER ({part}ORDER BY {order}) AS rank FROM scored {where}) "
        f"WHERE rank <= 8"
        for name, where, order in boards
    )


@register("video_leaderboard", query(
    "order_comments", _board_sql(), videos=_videos_sql("order_comments"), scored=_SCORED))
def video_leaderboard(spark, sf):
    return ranking.video_leaderboard(summary.per_video(V.order_comments(spark, sf)))


@register("video_leaderboard_by_run", query(
    "order_comments", _board_sql("run_id, "), videos=_videos_sql("order_comments", "run_id, "),
    scored=_SCORED))
def video_leaderboard_by_run(spark, sf):
    return ranking.video_leaderboard(summary.per_video(V.order_comments(spark, sf), RUN), RUN)


_BOARD_SUMMARY = """
SELECT {by}coalesce(list_sort(list(net) FILTER (WHERE total >= 30))[
    count(*) FILTER (WHERE total >= 30) // 2 + 1], 0.0::DOUBLE) AS median_net,
  count(*) FILTER (WHERE total >= 30) AS eligible_count, count(*) AS total_count FROM scored {group}"""


@register("leaderboard_summary", query(
    "order_comments", _BOARD_SUMMARY.format(by="", group=""),
    videos=_videos_sql("order_comments"), scored=_SCORED))
def leaderboard_summary(spark, sf):
    return ranking.leaderboard_summary(summary.per_video(V.order_comments(spark, sf)))


# --- keywords --------------------------------------------------------------------
def _tfidf(by: str, k: int) -> tuple[str, dict[str, str]]:
    key = by.rstrip(", ")
    on = f"AND a.{key} = b.{key}" if by else ""
    total = f"(SELECT count(*) FROM words w WHERE w.{key} = s.{key})" if by else "(SELECT count(*) FROM words)"
    part = f"PARTITION BY {key} " if by else ""
    parts = {
        "words": f"""
SELECT seq, {by}regexp_extract_all(joined, '[\\p{{L}}\\p{{N}}_]+') AS w FROM (
  SELECT seq, {by}array_to_string(tokens, ' ') AS joined FROM tokenized) WHERE trim(joined) <> ''""",
        "terms": f"""
SELECT seq, {by}unnest(list_concat(w, list_transform(list_zip(w[:-2], w[2:]),
  lambda z: z[1] || ' ' || z[2]))) AS keyword FROM words""",
        "tf": f"SELECT seq, {by}keyword, count(*) AS tf FROM terms GROUP BY ALL",
        "stats": f"SELECT {by}keyword, count(*) AS df, sum(tf) AS count FROM tf GROUP BY ALL",
        "idf": f"SELECT s.*, ln((1 + {total})::DOUBLE / (1 + df)) + 1 AS idf FROM stats s",
        "weighted": f"""
SELECT a.*, b.count AS total, a.tf * b.idf AS w FROM tf a JOIN idf b ON a.keyword = b.keyword {on}""",
        "unit": f"""
SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY {by}seq)) AS u FROM weighted""",
        "scores": f"""
SELECT {by}keyword, sum(u) AS score, max(total) AS count FROM unit GROUP BY {by}keyword""",
    }
    body = f"""
SELECT {by}rank, keyword, {rnd("score", 4)} AS score, CAST(count AS BIGINT) AS count
FROM (SELECT *, row_number() OVER ({part}ORDER BY round(score, 9) DESC, keyword) AS rank FROM scores)
WHERE rank <= {k}"""
    return body, parts


_TFIDF, _TFIDF_PARTS = _tfidf("", 20)
_TFIDF_LABEL, _TFIDF_LABEL_PARTS = _tfidf("sentiment_label, ", 10)


@register("tfidf_keywords", query("tokenized", _TFIDF, **_TFIDF_PARTS))
def tfidf_keywords(spark, sf):
    return keywords.tfidf_keywords(V.tokenized(spark, sf))


@register("tfidf_keywords_by_label", query("tokenized", _TFIDF_LABEL, **_TFIDF_LABEL_PARTS))
def tfidf_keywords_by_label(spark, sf):
    return keywords.tfidf_keywords(V.tokenized(spark, sf), ["sentiment_label"], k=10)


def _log_odds(table: str, group: str, where: str = "") -> tuple[str, dict[str, str]]:
    stop = quoted(w for w in C.DEFAULT_STOPWORDS if w not in C.NEGATIONS)
    p, q = "((c + 0.5::DOUBLE) / (n + 1))", "((o + 0.5::DOUBLE) / (n_o + 1))"
    score = (
        f"(ln({p} / (1 - {p})) - ln({q} / (1 - {q}))) / "
        "sqrt(1 / (c + 0.5::DOUBLE) + 1 / (o + 0.5::DOUBLE))"
    )
    parts = {
        "votes": f"""
SELECT {group}, unnest(list_distinct(list_filter(tokens, lambda t: length(t) > 3 AND
  NOT list_contains({stop}, t)))) AS keyword FROM {table} {where}""",
        "per_group": f"SELECT {group}, keyword, count(*) AS c FROM votes GROUP BY ALL",
        "sized": f"""
SELECT *, CAST(sum(c) OVER (PARTITION BY {group}) AS BIGINT) AS n,
  CAST(sum(c) OVER () - sum(c) OVER (PARTITION BY {group}) AS BIGINT) AS n_o,
  CAST(sum(c) OVER (PARTITION BY keyword) - c AS BIGINT) AS o FROM per_group""",
        "ranked": f"""
SELECT {group}, keyword, {rnd(score, 2)} AS score, c AS count, {pct("c", "c + o")} AS share_pct
FROM sized WHERE c >= 15""",
    }
    body = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY score DESC, keyword) AS rank
  FROM ranked) WHERE rank <= 12"""
    return body, parts


_BY_LABEL, _BY_LABEL_PARTS = _log_odds(
    "tokenized", "sentiment_label", "WHERE sentiment_label <> 'tidak_terklasifikasi'")
_BY_TIER, _BY_TIER_PARTS = _log_odds("tiered", "tier")


@register("distinctive_keywords_by_label", query("tokenized", _BY_LABEL, **_BY_LABEL_PARTS))
def distinctive_keywords_by_label(spark, sf):
    return keywords.keywords_by_label(V.durable_tokens(spark, sf))


@register("distinctive_keywords_by_tier", query("tiered", _BY_TIER, **_BY_TIER_PARTS))
def distinctive_keywords_by_tier(spark, sf):
    return keywords.keywords_by_tier(V.durable_tiers(spark, sf))


def _terms_sql(terms: str, name: str, k: int, having: str = "") -> str:
    return f"""
SELECT tier, {name}, count, rank FROM (SELECT tier, {name}, count(*) AS count,
  row_number() OVER (PARTITION BY tier ORDER BY count(*) DESC, min([seq, place]), {name}) AS rank
  FROM (SELECT tier, seq, unnest({terms}) AS {name}, generate_subscripts({terms}, 1) AS place
    FROM tiered) GROUP BY tier, {name})
WHERE rank <= {k} {having}"""


_PAIRS = "list_transform(list_zip(tokens[:-2], tokens[2:]), lambda z: z[1] || ' ' || z[2])"


@register("top_words_per_tier", query("tiered", _terms_sql("tokens", "keyword", 15)))
def top_words_per_tier(spark, sf):
    return keywords.top_words(V.tiered(spark, sf))


@register("top_pairs_per_tier", query("tiered", _terms_sql(_PAIRS, "theme", 8, "AND count >= 2")))
def top_pairs_per_tier(spark, sf):
    return keywords.top_pairs(V.tiered(spark, sf))


def _themes_sql(table: str, by: str = "") -> str:
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    part = f"PARTITION BY {by.rstrip(', ')} " if by else ""
    counts = ", ".join(
        f"{{'i': {i}, 'theme': '{t}', 'label': '{V.THEME_TITLES[t]}', 'n': count(*) FILTER "
        f"(WHERE regexp_matches(array_to_string(tokens, ' '), '{theme_pattern(words)}'))}}"
        for i, (t, words) in enumerate(V.THEMES.items())
    )
    return f"""
SELECT {by}row_number() OVER ({part}ORDER BY x.n DESC, x.i) AS rank, x.theme AS theme,
  x.label AS label, x.n AS count, {pct("x.n", "total")} AS share_pct
FROM (SELECT {by}count(*) AS total, unnest([{counts}]) AS x FROM {table} {group})"""


@register("theme_matches", query("tokenized", _themes_sql("tokenized")))
def theme_matches(spark, sf):
    return keywords.theme_matches(
        V.tokenized(spark, sf), themes=V.THEMES, titles=V.THEME_TITLES
    )


@register("theme_matches_per_tier", query("tiered", _themes_sql("tiered", "tier, ")))
def theme_matches_per_tier(spark, sf):
    rows = tiers.tier_themes(V.tiered(spark, sf), themes=V.THEMES, titles=V.THEME_TITLES)
    return rows


# --- tiers -----------------------------------------------------------------------
@register("attached_tiers", query("tier_posts", "SELECT comment_id, tier FROM tier_posts"))
def attached_tiers(spark, sf):
    rows = tiers.attach_tier(V.posts(spark, sf), V.accounts(spark, sf))
    return rows.select("comment_id", "tier")


_VIDEO_COUNTS = f"""
SELECT s.tier, coalesce(n, 0) AS video_count FROM tier_spine s LEFT JOIN (
  SELECT {TIER_OF.format('account_type')} AS tier, count(*) AS n FROM accounts GROUP BY 1) a
ON s.tier = a.tier"""


@register("tier_video_counts", query("accounts tier_spine", _VIDEO_COUNTS))
def tier_video_counts(spark, sf):
    rows = tiers.attach_tier(V.posts(spark, sf), V.accounts(spark, sf))
    return tiers.tier_video_counts(rows, V.accounts(spark, sf))


@register("tier_video_counts_from_comments", query("tier_posts tier_spine", """
SELECT s.tier, coalesce(n, 0) AS video_count FROM tier_spine s LEFT JOIN (
  SELECT tier, count(DISTINCT video_id) AS n FROM tier_posts GROUP BY tier) a ON s.tier = a.tier"""))
def tier_video_counts_from_comments(spark, sf):
    rows = tiers.attach_tier(V.posts(spark, sf), V.accounts(spark, sf))
    return tiers.tier_video_counts(rows, None)


_TIER_TITLES = "CASE {0} WHEN 'kol' THEN 'KOL' WHEN 'official' THEN 'Official' WHEN 'affiliate' THEN 'Affiliate' ELSE '{1}' END"
_BREAKDOWN = f"""
SELECT *, {_TIER_TITLES.format("tier", "Unknown")} AS label,
  {pct("meaningful_count", "total_count")} AS meaningful_pct,
  total_count - meaningful_count AS noise_count,
  {pct("total_count - meaningful_count", "total_count")} AS noise_pct,
  {pct("pos", "total_count")} AS pos_pct, {pct("neg", "total_count")} AS neg_pct,
  {pct("neu", "total_count")} AS neu_pct, {net()} AS net
FROM (SELECT v.tier, v.video_count, coalesce(total_count, 0) AS total_count,
  coalesce(comment_count, 0) AS comment_count, coalesce(reply_count, 0) AS reply_count,
  coalesce(meaningful_count, 0) AS meaningful_count, coalesce(pos, 0) AS pos,
  coalesce(neg, 0) AS neg, coalesce(neu, 0) AS neu
FROM video_counts v LEFT JOIN (SELECT tier, count(*) AS total_count,
  count(*) FILTER (WHERE NOT is_reply) AS comment_count, count(*) FILTER (WHERE is_reply) AS reply_count,
  count(*) FILTER (WHERE len(tokens) > 0) AS meaningful_count, {COUNTS} FROM tiered GROUP BY tier) c
ON v.tier = c.tier)"""


@register("tier_breakdown", query(
    "tiered tier_spine accounts", _BREAKDOWN, video_counts=_VIDEO_COUNTS))
def tier_breakdown(spark, sf):
    return tiers.tier_breakdown(V.durable_tiers(spark, sf, text=True), V.accounts(spark, sf))


@register("tier_overview", query("tier_posts tier_spine accounts", """
SELECT v.tier, v.video_count, coalesce(n, 0) AS comment_count FROM video_counts v LEFT JOIN (
  SELECT tier, count(*) AS n FROM tier_posts GROUP BY tier) c ON v.tier = c.tier""",
    video_counts=_VIDEO_COUNTS))
def tier_overview(spark, sf):
    rows = tiers.attach_tier(V.posts(spark, sf), V.accounts(spark, sf))
    return tiers.overall_summary(rows, V.accounts(spark, sf))


@register("comment_vs_reply", query("order_comments", f"""
SELECT run_id, c AS comment, n - c AS reply, {pct("c", "n")} AS comment_pct,
  {pct("n - c", "n")} AS reply_pct FROM (SELECT run_id, count(*) AS n,
  count(*) FILTER (WHERE NOT is_reply) AS c FROM order_comments GROUP BY run_id)"""))
def comment_vs_reply(spark, sf):
    return tiers.comment_vs_reply(V.order_comments(spark, sf), RUN)


_TOTALS = f"""
SELECT row_number() OVER (ORDER BY comment_count DESC, priority) AS position, tier,
  {_TIER_TITLES.format("tier", "Tidak diketahui")} AS label, video_count, comment_count,
  {pct("comment_count", "sum(comment_count) OVER ()")} AS pct_of_total, pos, neg, neu, unk,
  {pct("pos", "comment_count")} AS pos_pct, {pct("neg", "comment_count")} AS neg_pct,
  {pct("neu", "comment_count")} AS neu_pct, {pct("unk", "comment_count")} AS unk_pct, net,
  CAST(sum(live) OVER () - live AS BIGINT) AS peers,
  (sum(net * live) OVER () - net * live) / nullif(sum(live) OVER () - live, 0) AS peer_net
FROM (SELECT *, {net()} AS net, CASE WHEN comment_count > 0 THEN 1 ELSE 0 END AS live FROM (
  SELECT s.tier, s.priority, v.video_count, coalesce(n, 0) AS comment_count, coalesce(pos, 0) AS pos,
    coalesce(neg, 0) AS neg, coalesce(neu, 0) AS neu, coalesce(unk, 0) AS unk
  FROM tier_spine s JOIN video_counts v ON s.tier = v.tier LEFT JOIN (
    SELECT tier, count(*) AS n, {COUNTS} FROM tier_posts GROUP BY tier) c ON s.tier = c.tier))"""


@register("tier_totals", query("tier_posts tier_spine accounts", f"""
SELECT * REPLACE ({rnd("peer_net", 6)} AS peer_net) FROM totals""",
    video_counts=_VIDEO_COUNTS, totals=_TOTALS))
def tier_totals(spark, sf):
    from echolens.functions.numbers import round_exact

    rows = tiers.attach_tier(V.posts(spark, sf), V.accounts(spark, sf))
    totals = tiers.tier_totals(rows, V.accounts(spark, sf))
    return totals.withColumn("peer_net", round_exact(F.col("peer_net"), 6))


@register("tier_deep_dive", query("tiered tier_posts tier_spine accounts", f"""
SELECT t.tier, position, comment_count, net, len(ex) < 3 AS examples_short,
  array_to_string(list_transform(ex, lambda x: x || ''), '|') AS examples,
  array_to_string(th, '|') AS themes, coalesce(array_to_string(kw, '|'), '') AS keywords
FROM totals t
LEFT JOIN (SELECT tier, list(digg_count ORDER BY rank) AS ex FROM (SELECT tier, digg_count,
  row_number() OVER (PARTITION BY tier ORDER BY digg_count DESC, comment_id) AS rank
  FROM tier_posts) WHERE rank <= 5 GROUP BY tier) e ON t.tier = e.tier
LEFT JOIN (SELECT tier, list(theme || '=' || count ORDER BY rank) AS th FROM themes GROUP BY tier) h
  ON t.tier = h.tier
LEFT JOIN (SELECT tier, list(keyword ORDER BY rank) AS kw FROM ({_BY_TIER}) GROUP BY tier) k
  ON t.tier = k.tier""", video_counts=_VIDEO_COUNTS, totals=_TOTALS,
    themes=_themes_sql("tiered", "tier, "), **_BY_TIER_PARTS))
def tier_deep_dive(spark, sf):
    rows = tiers.tier_deep_dive(
        V.durable_tiers(spark, sf, text=True), V.accounts(spark, sf), themes=V.THEMES,
        titles=V.THEME_TITLES,
    )
    text = lambda c: c.cast("string")
    return rows.select(
        "tier", "position", "comment_count", "net", "examples_short",
        F.array_join(F.transform("examples", lambda e: text(e["digg_count"])), "|").alias("examples"),
        F.array_join(
            F.transform("themes", lambda t: F.concat_ws("=", t["theme"], text(t["count"]))), "|"
        ).alias("themes"),
        F.coalesce(F.array_join(F.transform("keywords", lambda k: k["keyword"]), "|"), F.lit(""))
        .alias("keywords"),
    )
