"""Narratives, metric facts and claim audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.registry import register
from catalog.report_queries import (
    _BOARD_SUMMARY, _BY_TIER, _BY_TIER_PARTS, _QUALITY, _SCORED, _TOTALS, _VIDEO_COUNTS,
    _board_sql, _delta_sql, _engagement_sql, _overall_sql, _themes_sql, _trend_sql, _videos_sql,
)
from catalog.sql import id_number, query, quoted, rnd, signed, strip
from echolens import constants as C
from echolens.operators import audit, keywords, narrative, summary, tiers
from echolens.plans import report
from echolens.session import durable, workspace
from echolens.streaming.log import BatchLog

RUN = ["run_id"]


def _printf(template: str, *values: str) -> str:
    """The template with its places filled in, as a SQL concatenation."""
    parts, rest, left = [], template, list(values)
    while True:
        spots = [i for i in (rest.find("%s"), rest.find("%d")) if i >= 0]
        if not spots:
            break
        at = min(spots)
        parts += ["'" + rest[:at].replace("%%", "%") + "'", f"({left.pop(0)})"]
        rest = rest[at + 2:]
    parts.append("'" + rest.replace("%%", "%") + "'")
    return " || ".join(parts)


def _item(title: str, body: str, when: str = "true") -> str:
    return f"CASE WHEN {when} THEN {{'title': {title}, 'body': {body}}} END"


def _narrative_sql(table: str) -> tuple[str, dict[str, str]]:
    n = narrative
    parts = {
        "overall": _overall_sql(table, "run_id"),
        "quality": _QUALITY.replace("{0}", table),
        "trend": _trend_sql(table, "run_id, "),
        "delta": _delta_sql("run_id, "),
        "engagement": _engagement_sql(table, "run_id, "),
        "videos": _videos_sql(table, "run_id, "),
        "scored": _SCORED,
        "board": _board_sql("run_id, "),
        "boards": _BOARD_SUMMARY.format(by="run_id, ", group="GROUP BY run_id"),
        "facts": """
SELECT o.*, q.unclassified_count, q.llm_failure_pct, e.total_likes, e.net_by_likes,
  e.net_by_likes_trimmed, e.top10_like_share_pct, d.from_label, d.to_label, d.delta, d.word,
  m.months, w.net AS worst_net, s.median_net, s.eligible_count
FROM overall o JOIN quality q USING (run_id) JOIN engagement e USING (run_id)
LEFT JOIN delta d USING (run_id)
LEFT JOIN (SELECT run_id, count(*) AS months FROM trend GROUP BY run_id) m USING (run_id)
LEFT JOIN (SELECT * FROM board WHERE board = 'worst' AND rank = 1) w USING (run_id)
LEFT JOIN boards s USING (run_id)""",
    }
    headline = [
        _item(_printf(n.HEAD_TITLE, signed("net_overall")), _printf(
            n.HEAD_BODY, id_number("classified_total"), id_number("pos"), "pos_pct",
            id_number("neg"), "neg_pct", id_number("neu"), "neu_pct")),
        _item(f"'{n.ONE_MONTH_TITLE}'", _printf(n.ONE_MONTH_BODY, "months", str(C.MIN_MONTH_VOLUME)),
              "months > 0 AND delta IS NULL"),
        _item(_printf(n.LIKES_TITLE, signed("net_by_likes")), _printf(
            n.LIKES_BODY, "top10_like_share_pct", id_number("total_likes"),
            signed("net_by_likes_trimmed"), signed("net_overall")), "total_likes > 0"),
    ]
    risk = [
        _item(_printf(n.UNCLASSIFIED_TITLE, id_number("unclassified_count"), "unk_pct"), _printf(
            n.UNCLASSIFIED_BODY, id_number("classified_total"), id_number("total_comments"))),
        _item(_printf(n.TREND_TITLE, "to_label", "word", "from_label", signed("delta")), _printf(
            n.TREND_BODY_KNOWN, id_number("sample_video_count"), "'5.000'"), "delta IS NOT NULL"),
        _item(_printf(n.FAILURE_TITLE, "llm_failure_pct"), f"'{n.FAILURE_BODY}'",
              "llm_failure_pct <> 0"),
    ]
    actions = [
        _item(f"'{n.WORST_TITLE}'", _printf(
            n.WORST_BODY, signed("worst_net", 0), signed("median_net", 0), "eligible_count",
            str(C.MIN_VIDEO_COMMENTS)), "worst_net IS NOT NULL"),
        _item(f"'{n.MORE_DATA_TITLE}'", _printf(n.MORE_DATA_BODY, str(C.MIN_VIDEO_COMMENTS)),
              "worst_net IS NULL"),
    ]
    sections = ", ".join(
        f"{{'section': '{name}', 'items': list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)}}"
        for name, items in zip(n.SECTIONS, (headline, risk, actions))
    )
    body = f"""
SELECT run_id, section, i - 1 AS idx, items[i].title AS title, items[i].body AS body FROM (
  SELECT run_id, s.section AS section, s.items AS items, unnest(range(1, len(s.items) + 1)) AS i
  FROM (SELECT run_id, unnest([{sections}]) AS s FROM facts))"""
    return body, parts


_EVENTS_SQL, _EVENTS_PARTS = _narrative_sql("event_comments")
_ORDERS_SQL, _ORDERS_PARTS = _narrative_sql("order_comments")


@register("narrative_of_events", query("event_comments", _EVENTS_SQL, **_EVENTS_PARTS))
def narrative_of_events(spark, sf):
    metrics = report.metric_tables(V.event_comments(spark, sf).withColumn(
        "tokens_stemmed", F.array().cast("array<string>")))
    return report.narrative_rows(metrics, population_videos=5000)


@register("narrative_of_orders", query("order_comments", _ORDERS_SQL, **_ORDERS_PARTS))
def narrative_of_orders(spark, sf):
    metrics = report.metric_tables(V.order_comments(spark, sf).withColumn(
        "tokens_stemmed", F.array().cast("array<string>")))
    return report.narrative_rows(metrics, population_videos=5000)


_GAP = rnd("net - peer_net")


@register("tier_narrative", query("tiered tier_posts tier_spine accounts", f"""
SELECT tier, i - 1 AS idx, items[i].title AS title, items[i].body AS body FROM (
  SELECT tier, items, unnest(range(1, len(items) + 1)) AS i FROM (
    SELECT t.tier, list_filter([
      {_item(_printf(narrative.TIER_ONLY_TITLE, "t.label"), _printf(narrative.TIER_ONLY_BODY, id_number("comment_count"), "video_count", "t.label"), "peers = 0")},
      {_item(_printf(narrative.TIER_NET_TITLE, "t.label", signed("net")), _printf(narrative.TIER_NET_BODY, f"format('{{:.1f}}', abs({_GAP}))", f"CASE WHEN {_GAP} > 0 THEN 'lebih tinggi' WHEN {_GAP} < 0 THEN 'lebih rendah' ELSE 'setara' END", signed("peer_net"), id_number("comment_count"), "pct_of_total", "video_count"), "peers > 0")},
      {_item(_printf(narrative.TIER_THEME_TITLE, "h.label"), _printf(narrative.TIER_THEME_BODY, id_number("h.count"), "h.share_pct"), "peers > 0 AND h.count > 0")}
    ], lambda x: x IS NOT NULL) AS items
    FROM totals t LEFT JOIN (SELECT * FROM themes WHERE rank = 1) h ON t.tier = h.tier))""",
    video_counts=_VIDEO_COUNTS, totals=_TOTALS, themes=_themes_sql("tiered", "tier, ")))
def tier_narrative(spark, sf):
    rows = V.durable_tiers(spark, sf)
    totals = tiers.tier_totals(rows, V.accounts(spark, sf))
    themes = tiers.tier_themes(rows, themes=V.THEMES, titles=V.THEME_TITLES)
    return narrative.tier_narrative(totals, themes)


# --- facts -----------------------------------------------------------------------
_GENERAL = (
    ("net_overall", "net_overall"), ("classified_total", "classified_total"),
    ("total_comments", "total_comments"), ("sentiment_counts.positif", "pos"),
    ("sentiment_counts.negatif", "neg"), ("sentiment_counts.netral", "neu"),
    ("sentiment_counts.tidak_terklasifikasi", "unk"), ("sentiment_pct.positif_pct", "pos_pct"),
    ("sentiment_pct.negatif_pct", "neg_pct"), ("sentiment_pct.netral_pct", "neu_pct"),
    ("sentiment_pct.unclassified_pct", "unk_pct"),
)
_CHECKS = ("unclassified_count", "unclassified_pct", "llm_escalation_pct", "llm_failure_pct")


def _fact_list(pairs, first: str) -> str:
    return ", ".join(
        f"{{'ord': {first} + {i}, 'field': '{f}', 'value': {c}::DOUBLE}}"
        for i, (f, c) in enumerate(pairs)
    )


_FACT_PARTS = {
    **_BY_TIER_PARTS,
    "video_counts": _VIDEO_COUNTS,
    "totals": _TOTALS,
    "themes": _themes_sql("tiered", "tier, "),
    "run_posts": "SELECT * REPLACE ('all' AS run_id) FROM posts",
    "overall": _overall_sql("run_posts", "run_id"),
    "quality": _QUALITY.replace("{0}", "run_posts"),
    "facts": f"""
SELECT run_id, x.ord AS ord, entity, x.field AS field, x.value AS value FROM (
  SELECT run_id, 'overall' AS entity, unnest([{_fact_list(_GENERAL, "0")}]) AS x FROM overall
  UNION ALL SELECT run_id, 'overall', unnest([{_fact_list([(f"data_quality.{c}", c) for c in _CHECKS], "11")}])
  FROM quality
  UNION ALL SELECT 'all', label, unnest([{_fact_list([(c, c) for c in ("net", "video_count", "comment_count", "pct_of_total")], "priority * 1000")}])
  FROM totals JOIN tier_spine USING (tier)
  UNION ALL SELECT 'all', t.label, {{'ord': s.priority * 1000 + 100 + h.rank,
    'field': 'theme.' || h.theme, 'value': h.count::DOUBLE}}
  FROM themes h JOIN totals t ON h.tier = t.tier JOIN tier_spine s ON h.tier = s.tier)""",
    "terms": f"""
SELECT DISTINCT lower(theme) AS term FROM themes UNION SELECT DISTINCT lower(keyword) FROM ({_BY_TIER})""",
}
_FACT_VIEWS = "tiered tier_posts tier_spine accounts"


def _themes(tiered):
    themes = durable(tiers.tier_themes(tiered, RUN, V.THEMES, V.THEME_TITLES))
    return themes.withColumn("label", F.col("theme"))


def _facts(spark, sf, rows, themes):
    return narrative.metric_facts(
        summary.overall_metrics(rows, RUN), summary.data_quality(rows, RUN),
        tiers.tier_totals(rows, V.whole_run(V.accounts(spark, sf)), RUN), themes, RUN,
    )


def _terms(rows, themes):
    # the distinctive words run work while they are defined
    return narrative.causal_terms(themes, keywords.keywords_by_tier(rows, RUN), RUN)


def _evidence(spark, sf):
    rows = V.whole_run(V.durable_tiers(spark, sf))
    themes = _themes(rows)
    return _facts(spark, sf, rows, themes), _terms(rows, themes)


def _facts_only(spark, sf):
    # the themes alone read tokens, and once: nothing is written before them
    rows = V.whole_run(V.tiered(spark, sf))
    return _facts(spark, sf, rows, _themes(rows))


@register("metric_facts", query(_FACT_VIEWS, "SELECT * FROM facts", **_FACT_PARTS))
def metric_facts(spark, sf):
    return _facts_only(spark, sf)


@register("causal_terms", query(_FACT_VIEWS, "SELECT 'all' AS run_id, term FROM terms", **_FACT_PARTS))
def causal_terms(spark, sf):
    rows = V.whole_run(V.durable_tiers(spark, sf))
    return _terms(rows, _themes(rows))


@register("metrics_fingerprint", query(_FACT_VIEWS, f"""
SELECT run_id, sha256(string_agg(line, chr(10) ORDER BY line)) AS fingerprint FROM (
  SELECT run_id, entity || '|' || field || '|' || format('{{:.4f}}', {rnd("value", 4)}) AS line
  FROM facts) GROUP BY run_id""", **_FACT_PARTS))
def metrics_fingerprint(spark, sf):
    return narrative.fingerprint(_facts_only(spark, sf), RUN)


# --- claim audit -----------------------------------------------------------------
_CLAIMS = {
    "claims": f"""
SELECT 'all' AS run_id, doc_id % 50 AS attempt, {quoted(narrative.SECTIONS)}[doc_id % 3 + 1] AS section,
  doc_id AS idx, source AS title, concat_ws(' ',
    ['KOL', 'Overall', 'Official', 'tidak diketahui', 'AFFILIATE'][doc_id % 5 + 1],
    CASE WHEN doc_id % 2 = 0 THEN '' || (n_chars % 60) ELSE '+' || (n_chars % 60) || ',5' END,
    CASE WHEN doc_id % 7 = 0 THEN 'karena' END, 'pada Agu 26, 2024:', text) AS body
FROM documents""",
    "cut": f"""
SELECT *, string_split_regex(body, '{C.NUMBER_PATTERN}') AS pieces,
  regexp_extract_all(body, '{C.NUMBER_PATTERN}') AS raws FROM claims""",
    "spans": """
SELECT idx, body, i - 1 AS place, raws[i] AS raw,
  list_sum(list_transform(pieces[1:i], lambda s: length(s)))
  + coalesce(list_sum(list_transform(raws[1:i - 1], lambda s: length(s))), 0) AS start
FROM (SELECT *, unnest(range(1, len(raws) + 1)) AS i FROM cut)""",
    "read_numbers": f"""
SELECT *, try_cast(replace(raw, ',', '.') AS DOUBLE) AS v1,
  try_cast(replace(replace(raw, '.', ''), ',', '.') AS DOUBLE) AS v2,
  lower(substr(body, CAST(greatest(start - 6, 0) AS BIGINT) + 1,
    CAST(start - greatest(start - 6, 0) AS BIGINT))) AS near,
  lower(substr(body, 1, CAST(start AS BIGINT))) AS before FROM spans""",
    "checked": f"""
SELECT *, CASE WHEN regexp_matches(raw, '^[+-]|[.,]') THEN false ELSE
  coalesce(try_cast(raw AS BIGINT) <= 10, false)
  OR coalesce(try_cast(raw AS BIGINT) BETWEEN 1900 AND 2099 AND length(raw) = 4, false)
  OR regexp_matches(near, '{"|".join(C.MONTH_TOKENS)}') END AS incidental FROM read_numbers""",
}


@register("numbers_in_claims", query("", """
SELECT idx, place, raw, CAST(start AS BIGINT) AS start, incidental, v1, v2 FROM checked""", **_CLAIMS))
def numbers_in_claims(spark, sf):
    body = F.col("body")
    spans = V.claims(spark, sf).select(
        "idx", "body", F.posexplode(audit.number_spans(body)).alias("place", "s")
    )
    raw = F.col("s.raw")
    plain = F.replace(F.replace(raw, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return spans.select(
        "idx", "place", raw.alias("raw"), F.col("s.start").alias("start"),
        audit.is_incidental(raw, F.left(body, F.col("s.start"))).alias("incidental"),
        F.replace(raw, F.lit(","), F.lit(".")).try_cast("double").alias("v1"),
        plain.try_cast("double").alias("v2"),
    )


_AUDIT = {
    "owners": """
SELECT idx, place, arg_max(entity, {'p': spot, 'size': length(entity)}) AS owner FROM (
  SELECT idx, place, entity, length(before) - instr(reverse(before), reverse(lower(entity)))
    - length(entity) + 1 AS spot
  FROM checked, (SELECT DISTINCT entity FROM facts WHERE entity <> 'overall')
  WHERE contains(before, lower(entity))) GROUP BY idx, place""",
    "backing": """
SELECT c.idx, c.place, arg_min(f.entity, f.ord) AS other, list(f.entity) AS entities
FROM checked c JOIN facts f ON abs(c.v1 - f.value) <= greatest(0.15, abs(f.value) * 0.001)
  OR abs(c.v2 - f.value) <= greatest(0.15, abs(f.value) * 0.001) GROUP BY c.idx, c.place""",
    "number_reasons": f"""
SELECT c.idx, arg_min(CASE WHEN b.idx IS NULL THEN
    {_printf(audit.UNKNOWN_NUMBER, "raw")} ELSE {_printf(audit.OTHER_ENTITY, "raw", "other", "owner")} END,
  c.place) AS reason
FROM checked c LEFT JOIN owners o ON c.idx = o.idx AND c.place = o.place
LEFT JOIN backing b ON c.idx = b.idx AND c.place = b.place
WHERE NOT incidental AND (v1 IS NOT NULL OR v2 IS NOT NULL) AND (b.idx IS NULL
  OR (owner IS NOT NULL AND NOT list_contains(b.entities, owner))) GROUP BY c.idx""",
    "causes": f"""
SELECT idx, list_filter({quoted(C.CAUSAL_CONNECTORS)}, lambda c: contains(lower(body), c))[1] AS word,
  EXISTS (SELECT 1 FROM terms t WHERE contains(lower(body), t.term)) AS backed FROM claims""",
    "audited": f"""
SELECT c.run_id, c.attempt, c.section, c.idx, c.title, coalesce(r.reason, CASE WHEN k.word IS NOT NULL
  AND NOT k.backed THEN {_printf(audit.UNSUPPORTED_CAUSE, "k.word")} END) AS reason
FROM claims c LEFT JOIN number_reasons r ON c.idx = r.idx JOIN causes k ON c.idx = k.idx""",
}


def _audited(spark, sf):
    facts, terms = _evidence(spark, sf)
    return audit.audit_claims(V.claims(spark, sf), audit.run_evidence(facts, terms))


@register("audited_claims", query(
    _FACT_VIEWS, "SELECT * FROM audited", **_FACT_PARTS, **_CLAIMS, **_AUDIT))
def audited_claims(spark, sf):
    return _audited(spark, sf).drop("body")


@register("narrative_verdicts", query(_FACT_VIEWS, f"""
SELECT run_id, attempt, arg_min({_printf(audit.REJECTED, "section", "title", "reason")},
    {{'s': list_position({quoted(narrative.SECTIONS)}, section), 'i': idx}})
    FILTER (WHERE reason IS NOT NULL) AS reject_reason,
  count(*) AS claims, count(reason) AS failed_claims, count(reason) = 0 AS accepted
FROM audited GROUP BY run_id, attempt""", **_FACT_PARTS, **_CLAIMS, **_AUDIT))
def narrative_verdicts(spark, sf):
    return audit.verdicts(_audited(spark, sf))


_SHAPES = f"""
SELECT '' || conv_id AS run_id, turn AS attempt, CASE (conv_id + turn) % 7
  WHEN 0 THEN '{audit.MISSING_SECTION % "risk"}' WHEN 1 THEN '{audit.NOT_AN_OBJECT}'
  WHEN 2 THEN '{audit.NOT_AN_OBJECT}'
  WHEN 3 THEN '{audit.ITEM_INCOMPLETE % ("risk", 0)}'
  WHEN 4 THEN '{audit.ITEM_NOT_OBJECT % ("headline", 1)}'
  WHEN 5 THEN '{audit.ITEM_INCOMPLETE % ("headline", 0)}'
  ELSE CASE WHEN {strip('text')} = '' THEN '{audit.ITEM_INCOMPLETE % ("risk", 0)}' END END
  AS reject_reason
FROM conversations"""


@register("narrative_shapes", query("", _SHAPES))
def narrative_shapes(spark, sf):
    rows = V.candidates(spark, sf)
    return rows.select(
        "run_id", "attempt", audit.shape_reason(F.col("narrative")).alias("reject_reason")
    )


@register("candidate_claims", query("", """
SELECT '' || conv_id AS run_id, turn AS attempt, unnest(['headline', 'risk', 'risk', 'actions']) AS section,
  unnest([0, 0, 1, 0]) AS idx, unnest(['t', role, role, 't']) AS title,
  unnest(['b', text, text, 'b']) AS body
FROM conversations JOIN shapes ON '' || conv_id = run_id AND turn = attempt
WHERE reject_reason IS NULL""", shapes=_SHAPES))
def candidate_claims(spark, sf):
    return audit.candidate_claims(V.candidates(spark, sf))[0]


def _selection(spark, sf):
    talk = V.table(spark, sf, "conversations")
    conv = F.col("conv_id")
    runs = talk.filter("turn = 0").select(
        conv.cast("string").alias("run_id"), (conv * 7 % 90).alias("classified_total"),
        (conv % 4 != 0).alias("configured"), (conv % 9 == 0).alias("disabled"),
    )
    judged = talk.select(
        conv.cast("string").alias("run_id"), F.col("turn").alias("attempt"),
        (F.length("text") % 3 == 0).alias("accepted"),
        F.when(F.length("text") % 3 != 0, F.col("role")).alias("reject_reason"),
    )
    claims = talk.select(
        conv.cast("string").alias("run_id"), F.col("turn").alias("attempt"),
        F.lit("risk").alias("section"), F.lit(0).alias("idx"), F.col("role").alias("title"),
        F.col("text").alias("body"),
    )
    own = runs.select(
        "run_id", F.lit("risk").alias("section"), F.lit(0).alias("idx"),
        F.lit("own").alias("title"), F.lit("own text").alias("body"),
    )
    return audit.select_narratives(runs, claims, judged, own)


_SELECTION = {
    "judged": """
SELECT conv_id, min(turn) FILTER (WHERE length(text) % 3 = 0) AS good,
  arg_max(role, turn) FILTER (WHERE length(text) % 3 <> 0) AS last_reason
FROM conversations GROUP BY conv_id""",
    "states": f"""
SELECT conv_id, '' || conv_id AS run_id, good, last_reason, CASE WHEN conv_id % 9 = 0
    THEN '{audit.STATUS_DISABLED}' WHEN conv_id % 4 = 0 THEN '{audit.STATUS_NOT_CONFIGURED}'
  WHEN conv_id * 7 % 90 <= 30 THEN '{audit.STATUS_BELOW_VOLUME}'
  WHEN good IS NOT NULL THEN '{audit.STATUS_ACCEPTED}' ELSE '{audit.STATUS_FALLBACK}' END AS status
FROM judged""",
}


@register("narrative_status", query("", f"""
SELECT run_id, status, CASE WHEN status = '{audit.STATUS_ACCEPTED}' THEN 'llm' ELSE 'fallback' END
  AS source, CASE WHEN status = '{audit.STATUS_ACCEPTED}' THEN good END AS attempt,
  CASE WHEN status = '{audit.STATUS_FALLBACK}' THEN last_reason END AS reject_reason
FROM states""", **_SELECTION))
def narrative_status(spark, sf):
    return _selection(spark, sf)[0]


@register("chosen_narratives", query("", f"""
SELECT s.run_id, 'risk' AS section, 0 AS idx, CASE WHEN status = '{audit.STATUS_ACCEPTED}' THEN c.role
  ELSE 'own' END AS title, CASE WHEN status = '{audit.STATUS_ACCEPTED}' THEN c.text ELSE 'own text' END
  AS body
FROM states s LEFT JOIN conversations c ON s.conv_id = c.conv_id AND s.good = c.turn""", **_SELECTION))
def chosen_narratives(spark, sf):
    return _selection(spark, sf)[1]


def _reuse_input(spark, sf, second):
    """Runs of the conversations; in the second batch every third run has another fact and all have new candidates."""
    talk = V.table(spark, sf, "conversations").filter("turn = 0")
    conv, name = F.col("conv_id"), F.col("conv_id").cast("string").alias("run_id")
    changed = F.when(conv % 3 == 0, 1_000_000) if second else F.lit(0)
    runs = talk.select(
        name, F.lit(100).alias("classified_total"), F.lit(True).alias("configured"), (conv % 9 == 0).alias("disabled")
    )
    facts = talk.select(
        name, F.lit(0).alias("ord"), F.lit("overall").alias("entity"), F.lit("conv").alias("field"),
        (conv + F.coalesce(changed, F.lit(0))).cast("double").alias("value"),
    )
    # a number that is no fact: the candidates of every fifth run fail
    body = F.when(conv % 5 == 0, "77.7").otherwise("plain")
    item = F.array(F.struct(F.lit("second" if second else "first").alias("title"), body.alias("body")))
    candidates = talk.select(name, F.lit(1).alias("attempt"), F.to_json(F.struct(
        *[item.alias(s) for s in audit.SECTIONS]
    )).alias("narrative"))
    own = talk.select(
        name, F.lit("risk").alias("section"), F.lit(0).alias("idx"), F.lit("own").alias("title"), F.lit("own text").alias("body")
    )
    terms = talk.select(name, F.lit("").alias("term")).filter("term <> ''")
    return runs, candidates, facts, terms, own


@register("reused_narratives", query("", """
SELECT run_id, status, title, count(*) AS claims FROM told JOIN sections USING (kind) GROUP BY ALL""", told=f"""
SELECT '' || conv_id AS run_id, CASE WHEN conv_id % 9 = 0 THEN '{audit.STATUS_DISABLED}'
    WHEN conv_id % 5 = 0 THEN '{audit.STATUS_FALLBACK}' ELSE '{audit.STATUS_ACCEPTED}' END AS status,
  CASE WHEN conv_id % 9 = 0 OR conv_id % 5 = 0 THEN 'own' WHEN conv_id % 3 = 0 THEN 'second' ELSE 'first' END AS title,
  CASE WHEN conv_id % 9 = 0 OR conv_id % 5 = 0 THEN 'own' ELSE 'told' END AS kind
FROM conversations WHERE turn = 0""", sections=f"""
SELECT unnest([{", ".join(["'told'"] * len(audit.SECTIONS))}, 'own']) AS kind"""))
def reused_narratives(spark, sf):
    """Two batches of runs over one store of accepted narratives; the rows of the second."""
    store = BatchLog(spark, workspace(spark, "narratives"), "fingerprint")
    report.reused_narratives(*_reuse_input(spark, sf, False), store, 0)
    states, told = report.reused_narratives(*_reuse_input(spark, sf, True), store, 1)
    return told.join(states.select("run_id", "status"), "run_id").groupBy("run_id", "status", "title").agg(
        F.count(F.lit(1)).alias("claims")
    )
