"""Text stages, word lists, classifiers, cascade, exclusions, calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.registry import register
from catalog.sql import (
    EXCLUDED_USERS, cleaned, mapping, pct, query, quoted, rnd, strip,
)
from echolens import constants as C
from echolens.functions import text as X
from echolens.operators import calibrate, classify, exclusion
from echolens.sources import readers, writers

# --- text stages ---------------------------------------------------------------


@register("emoji_found", f"""
SELECT doc_id, array_to_string(regexp_extract_all(text, '{C.EMOJI_PATTERN}'), '|') AS emoji,
  length(regexp_replace(text, '{C.EMOJI_PATTERN}', '', 'g')) AS rest
FROM documents""")
def emoji_found(spark, sf):
    text = F.col("text")
    return V.table(spark, sf, "documents").select(
        "doc_id", F.array_join(X.emoji_found(text), "|").alias("emoji"),
        F.length(X.without_emoji(text)).alias("rest"),
    )


@register("clean_text", query("cleaned", "SELECT seq, text_clean FROM cleaned"))
def clean_text(spark, sf):
    return V.tokenized(spark, sf).select("seq", "text_clean")


@register("clean_page_urls", f"""
SELECT page_id, {cleaned("'See ' || url || ' by @' || page_id || 'é  now'")} AS text_clean
FROM pages""")
def clean_page_urls(spark, sf):
    text = F.concat(
        F.lit("See "), "url", F.lit(" by @"), F.col("page_id").cast("string"), F.lit("é  now")
    )
    folded = X.case_fold(X.without_emoji(text))
    return V.table(spark, sf, "pages").select("page_id", X.clean(folded).alias("text_clean"))


@register("normalized_text", query("normalized", "SELECT seq, text_normalized FROM normalized"))
def normalized_text(spark, sf):
    rows = V.tokenized(spark, sf)
    return rows.select("seq", X.normalize(F.col("text_clean"), V.SLANG).alias("text_normalized"))


@register("text_tokens", query("tokenized", """
SELECT seq, len(tokens) AS n, array_to_string(tokens, ' ') AS tokens FROM tokenized"""))
def text_tokens(spark, sf):
    tokens = F.col("tokens_stemmed")
    return V.tokenized(spark, sf).select(
        "seq", F.size(tokens).alias("n"), F.array_join(tokens, " ").alias("tokens")
    )


@register("meaningful_rows", query("tokenized", """
SELECT is_reply, count(*) FILTER (WHERE len(tokens) > 0) AS meaningful,
  count(*) FILTER (WHERE len(tokens) = 0) AS noise FROM tokenized GROUP BY is_reply"""))
def meaningful_rows(spark, sf):
    some = F.size("tokens_stemmed") > 0
    return V.tokenized(spark, sf).groupBy("is_reply").agg(
        F.count_if(some).alias("meaningful"), F.count_if(~some).alias("noise")
    )


@register("adjacent_pairs", query("tokenized", """
SELECT seq, array_to_string(list_transform(list_zip(tokens[:-2], tokens[2:]),
  lambda z: z[1] || ' ' || z[2]), '|') AS pairs FROM tokenized"""))
def adjacent_pairs(spark, sf):
    return V.tokenized(spark, sf).select(
        "seq", F.array_join(X.bigrams(F.col("tokens_stemmed")), "|").alias("pairs")
    )


@register("masked_names", """
SELECT o_orderkey, CASE WHEN length(n) > 4 THEN substr(n, 1, 2) || repeat('*', length(n) - 4)
    || right(n, 2) WHEN length(n) > 0 THEN substr(n, 1, 1) || repeat('*', length(n) - 1) ELSE '' END
    AS masked
FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderstatus WHEN 1 THEN o_orderpriority
  ELSE '' || o_custkey END AS n FROM orders)""")
def masked_names(spark, sf):
    kind = F.col("o_orderkey") % 3
    name = (
        F.when(kind == 0, F.col("o_orderstatus")).when(kind == 1, F.col("o_orderpriority"))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    return V.table(spark, sf, "orders").select(
        "o_orderkey", X.mask_username(name).alias("masked")
    )


@register("formula_safe_cells", """
SELECT s_suppkey, CASE WHEN regexp_matches(v, '^[=+\\-@]') THEN '''' || v ELSE v END AS cell
FROM (SELECT s_suppkey, ['', '=', '+', '-', '@', ' ='][s_suppkey % 6 + 1] || s_acctbal AS v
  FROM supplier)""")
def formula_safe_cells(spark, sf):
    head = F.get(F.array(*[F.lit(c) for c in ("", "=", "+", "-", "@", " =")]), (F.col("s_suppkey") % 6).cast("int"))
    value = F.concat(head, F.col("s_acctbal").cast("string"))
    return V.table(spark, sf, "supplier").select("s_suppkey", X.safe_cell(value).alias("cell"))


@register("short_fields", query("posts", """
SELECT seq, substr(create_time, 1, 10) AS day, substr(text_raw, 1, 400) AS excerpt FROM posts"""))
def short_fields(spark, sf):
    return V.posts(spark, sf).select(
        "seq", X.short_date(F.col("create_time")).alias("day"),
        X.short_text(F.col("text_raw")).alias("excerpt"),
    )


# --- word lists ----------------------------------------------------------------
_WORDS = f"""
SELECT DISTINCT {strip('word')} AS word FROM (
  SELECT unnest(string_split(lower(text), ' ')) AS word FROM benchmark
  UNION ALL SELECT unnest({quoted(C.NEGATIONS[:3])}) AS word FROM region)
WHERE {strip('word')} <> ''"""


def _word_rows(spark, sf):
    """Words of the benchmark texts, with some negations a careless list may hold."""
    words = V.table(spark, sf, "benchmark").select(
        F.explode(F.split(F.lower("text"), " ")).alias("word")
    )
    slips = V.table(spark, sf, "region").select(
        F.explode(F.array(*[F.lit(w) for w in C.NEGATIONS[:3]])).alias("word")
    )
    return readers.word_list(words.unionByName(slips), "word")


@register("stopword_table", query("", f"""
SELECT word FROM words WHERE word NOT IN (SELECT unnest({quoted(C.NEGATIONS)}))""", words=_WORDS))
def stopword_table(spark, sf):
    return readers.stopword_table(_word_rows(spark, sf))


@register("listed_negations", query("", f"""
SELECT word FROM words WHERE word IN (SELECT unnest({quoted(C.NEGATIONS)}))""", words=_WORDS))
def listed_negations(spark, sf):
    return readers.listed_negations(_word_rows(spark, sf))


@register("lexicon_table", """
SELECT word, arg_max(score, line) AS score FROM (
  SELECT p_partkey AS line, trim(p_name) AS word,
    CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_size::DOUBLE / 50 END AS score FROM part
  WHERE p_partkey % 13 <> 0) WHERE score IS NOT NULL GROUP BY word""")
def lexicon_table(spark, sf):
    score = F.when(F.col("p_size") % 9 == 0, "n/a").otherwise(
        (F.col("p_size").cast("double") / 50).cast("string")
    )
    raw = V.table(spark, sf, "part").select(
        F.col("p_partkey").alias("line"),
        F.when(F.col("p_partkey") % 13 == 0, " ").otherwise(F.concat(F.lit(" "), "p_name"))
        .alias("word"),
        F.concat(score, F.lit(" ")).alias("score"),
    )
    return readers.lexicon_table(raw)


@register("stemmed_tokens", query("tokenized", f"""
SELECT t.seq, array_to_string(list_transform(tokens, lambda w: CASE WHEN length(w) > 4 AND
  list_contains(r.stems, w) THEN left(w, length(w) - 2) ELSE w END), ' ') AS tokens
FROM tokenized t, (SELECT list(DISTINCT word) AS stems FROM words) r""", words=_WORDS))
def stemmed_tokens(spark, sf):
    """Stems from a table: known words of five letters or more lose two."""
    word = F.col("word")
    root = F.when(F.length(word) > 4, F.substring(word, F.lit(1), F.length(word) - 2))
    stems = _word_rows(spark, sf).select("word", root.alias("root"))
    rows = classify.stem_tokens(V.durable_tokens(spark, sf), stems, key="seq")
    return rows.select("seq", F.array_join("tokens_stemmed", " ").alias("tokens"))


# --- classifiers ---------------------------------------------------------------
_SCORED = {
    "known": f"""
SELECT seq, len(tokens) AS n, list_transform(list_filter(tokens, lambda t:
  list_contains({quoted(V.LEXICON)}, t)), lambda t: {mapping(V.LEXICON)}[t]) AS hits
FROM tokenized""",
}
_SCORED["scored"] = f"""
SELECT seq, CASE WHEN len(hits) > 0 THEN
    {rnd("list_reduce(hits, lambda a, b: a + b) / len(hits)", 4)} ELSE 0.0::DOUBLE END AS score,
  CASE WHEN n > 0 THEN {rnd("1.0::DOUBLE - len(hits)::DOUBLE / n", 4)} ELSE 0.0::DOUBLE END AS oov
FROM (SELECT seq, n, hits FROM known)"""
_LEXICON_ROWS = f"""
SELECT seq, score AS lexicon_score, oov AS oov_ratio,
  CASE WHEN score > 0.15 THEN 'positif' WHEN score < -0.15 THEN 'negatif' ELSE 'netral' END
    AS sentiment_label,
  {rnd("CASE WHEN abs(score) > 0.15 THEN least(abs(score) / 0.15::DOUBLE, 1.0::DOUBLE) ELSE 1.0::DOUBLE - abs(score) END", 4)}
    AS sentiment_confidence, 'lexicon' AS sentiment_method
FROM scored"""
_LEXICON_COLUMNS = (
    "seq", "lexicon_score", "oov_ratio", "sentiment_label", "sentiment_confidence",
    "sentiment_method",
)


@register("lexicon_labels", query("tokenized", _LEXICON_ROWS, **_SCORED))
def lexicon_labels(spark, sf):
    rows = classify.lexicon_classify(V.tokenized(spark, sf), V.LEXICON)
    return rows.select(*_LEXICON_COLUMNS)


@register("lexicon_labels_from_table", query("tokenized", _LEXICON_ROWS.replace(
    "FROM scored", "FROM scored2"), **_SCORED, scored2=f"""
SELECT t.seq, coalesce({rnd("h.total / h.n", 4)}, 0.0::DOUBLE) AS score,
  CASE WHEN len(tokens) > 0 THEN {rnd("1.0::DOUBLE - coalesce(h.n, 0)::DOUBLE / len(tokens)", 4)}
    ELSE 0.0::DOUBLE END AS oov
FROM tokenized t LEFT JOIN (SELECT seq, sum(CAST({mapping(V.LEXICON)}[w] AS DECIMAL(18, 9)))::DOUBLE AS total, count(*) AS n FROM (
  SELECT seq, unnest(tokens) AS w FROM tokenized)
  WHERE list_contains({quoted(V.LEXICON)}, w) GROUP BY seq) h ON t.seq = h.seq"""))
def lexicon_labels_from_table(spark, sf):
    lexicon = spark.createDataFrame(list(V.LEXICON.items()), "word string, score double")
    rows = classify.lexicon_classify(V.durable_tokens(spark, sf), lexicon, key="seq")
    return rows.select(*_LEXICON_COLUMNS)


def _base(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", F.col("text").alias("text_raw"))
    rows = V.predictions(spark, sf).join(docs, "doc_id")
    raw = F.struct(F.col("raw_label").alias("label"), F.col("confidence").alias("score"))
    return classify.base_prediction(rows, raw)


@register("base_predictions", query("base", """
SELECT comment_id, model, base_label, base_confidence FROM base"""))
def base_predictions(spark, sf):
    return _base(spark, sf).select("comment_id", "model", "base_label", "base_confidence")


@register("ambiguous_counts", query("base", """
SELECT model, count(*) FILTER (WHERE base_confidence < 0.9) AS ambiguous, count(*) AS total
FROM base GROUP BY model"""))
def ambiguous_counts(spark, sf):
    return _base(spark, sf).groupBy("model").agg(
        F.count_if(classify.is_ambiguous(F.col("base_confidence"), 0.9)).alias("ambiguous"),
        F.count(F.lit(1)).alias("total"),
    )


_SECOND = """
SELECT comment_id, base_label AS label, base_confidence AS confidence FROM base
WHERE model = 'model-1' AND doc_id % 9 <> 0"""
_CASCADE = """
SELECT b.comment_id, CASE WHEN base_confidence >= 0.8 THEN base_label WHEN s.label IS NOT NULL
    THEN s.label ELSE 'tidak_terklasifikasi' END AS sentiment_label,
  CASE WHEN base_confidence >= 0.8 THEN base_confidence WHEN s.label IS NOT NULL THEN s.confidence
    ELSE 0.0::DOUBLE END AS sentiment_confidence,
  CASE WHEN base_confidence >= 0.8 THEN 'model' WHEN s.label IS NOT NULL THEN 'llm'
    ELSE 'llm_failed' END AS sentiment_method
FROM base b LEFT JOIN second s ON b.comment_id = s.comment_id WHERE model = 'model-0'"""


def _cascade(spark, sf):
    base = _base(spark, sf)
    second = base.filter("model = 'model-1' AND doc_id % 9 <> 0").select(
        "comment_id", F.col("base_label").alias("label"),
        F.col("base_confidence").alias("confidence"),
    )
    rows = classify.cascade(base.filter("model = 'model-0'"), second, 0.8)
    return rows.select(
        "comment_id", "sentiment_label", "sentiment_confidence", "sentiment_method"
    )


@register("escalated_rows", query("base", """
SELECT comment_id, model, base_label, base_confidence FROM base
WHERE base_label IS NULL OR base_confidence IS NULL OR base_confidence < 0.9"""))
def escalated_rows(spark, sf):
    rows = classify.escalated_rows(_base(spark, sf), 0.9)
    return rows.select("comment_id", "model", "base_label", "base_confidence")


@register("cascade", query("base", _CASCADE, second=_SECOND))
def cascade(spark, sf):
    return _cascade(spark, sf)


@register("cascade_without_fallback", query("base", """
SELECT comment_id, base_label AS sentiment_label, base_confidence AS sentiment_confidence,
  'model' AS sentiment_method FROM base WHERE model = 'model-0'"""))
def cascade_without_fallback(spark, sf):
    rows = classify.cascade(_base(spark, sf).filter("model = 'model-0'"), None, None)
    return rows.select(
        "comment_id", "sentiment_label", "sentiment_confidence", "sentiment_method"
    )


@register("failure_gate", query("base", """
SELECT count(*) FILTER (WHERE sentiment_method IN ('llm', 'llm_failed')) AS escalated,
  count(*) FILTER (WHERE sentiment_method = 'llm_failed') AS failed,
  count(*) FILTER (WHERE sentiment_method = 'llm_failed')::DOUBLE /
    nullif(count(*) FILTER (WHERE sentiment_method IN ('llm', 'llm_failed')), 0) > 0.1 AS exceeded
FROM merged""", second=_SECOND, merged=_CASCADE))
def failure_gate(spark, sf):
    return classify.failure_gate(_cascade(spark, sf))


@register("failure_gate_by_run", query("posts", """
SELECT run_id, escalated, failed, failed::DOUBLE / escalated > 0.1 AS exceeded FROM (
SELECT run_id, count(*) FILTER (WHERE sentiment_method IN ('llm', 'llm_failed')) AS escalated,
  count(*) FILTER (WHERE sentiment_method = 'llm_failed') AS failed FROM posts GROUP BY run_id)"""))
def failure_gate_by_run(spark, sf):
    return classify.failure_gate(V.posts(spark, sf), ["run_id"]).withColumn(
        "exceeded", F.when(F.col("escalated") > 0, F.col("exceeded"))
    )


# --- resuming ------------------------------------------------------------------
def _log(spark, sf):
    n = F.col("event_id")
    rows = V.table(spark, sf, "events").select(
        F.concat(F.lit("c"), (n % 900).cast("string")).alias("comment_id"),
        F.when(n % 3 == 0, True).when(n % 3 == 1, False).alias("hybrid_enabled"),
        F.col("event_type").alias("sentiment_label"), n.alias("line"),
    )
    return readers.last_wins(rows, ["comment_id"], "line")


@register("reused_results", query("posts", """
SELECT p.comment_id, l.event_type AS logged_label FROM posts p JOIN (
  SELECT 'c' || (event_id % 900) AS comment_id, event_type, event_id, row_number() OVER (
    PARTITION BY event_id % 900 ORDER BY event_id DESC) AS rn FROM events) l
ON p.comment_id = l.comment_id WHERE rn = 1 AND event_id % 3 = 0"""))
def reused_results(spark, sf):
    done = classify.reusable(_log(spark, sf), hybrid=True).withColumnRenamed(
        "sentiment_label", "logged_label"
    )
    return classify.finished(V.posts(spark, sf), done).select("comment_id", "logged_label")


@register("pending_comments", query("posts", """
SELECT comment_id FROM posts WHERE comment_id NOT IN (SELECT comment_id FROM (
  SELECT 'c' || (event_id % 900) AS comment_id, max(event_id) AS last FROM events GROUP BY 1)
WHERE last % 3 = 0)"""))
def pending_comments(spark, sf):
    done = classify.reusable(_log(spark, sf), hybrid=True)
    return classify.pending(V.posts(spark, sf), done).select("comment_id")


# --- exclusions ----------------------------------------------------------------
@register("marked_exclusions", query("marked", """
SELECT comment_id, exclude_reason IS NOT NULL AS excluded, exclude_reason FROM marked"""))
def marked_exclusions(spark, sf):
    rows = exclusion.mark_exclusions(V.event_comments(spark, sf), EXCLUDED_USERS)
    return rows.select("comment_id", "excluded", "exclude_reason")


@register("marked_exclusions_from_table", query("event_comments", """
SELECT comment_id, CASE WHEN username = video_author_username THEN 'video_uploader'
  WHEN username IN (SELECT 'u' || s_suppkey FROM supplier WHERE s_acctbal < 2000)
  THEN 'internal_account' END AS exclude_reason FROM event_comments"""))
def marked_exclusions_from_table(spark, sf):
    listed = V.table(spark, sf, "supplier").filter("s_acctbal < 2000").select(
        F.concat(F.lit("u"), F.col("s_suppkey").cast("string")).alias("username")
    )
    rows = exclusion.mark_exclusions(V.event_comments(spark, sf), listed)
    return rows.select("comment_id", "exclude_reason")


@register("analyzed_rows", query("marked", """
SELECT video_id, count(*) AS n FROM marked WHERE exclude_reason IS NULL GROUP BY video_id"""))
def analyzed_rows(spark, sf):
    rows = exclusion.mark_exclusions(V.event_comments(spark, sf), EXCLUDED_USERS)
    return exclusion.analyzed_rows(rows).groupBy("video_id").agg(F.count(F.lit(1)).alias("n"))


@register("top_accounts", query("marked", f"""
SELECT rank, username, total_muncul, coalesce(reason, '{C.REASON_UNKNOWN_TEXT}') AS alasan FROM (
  SELECT username, count(*) AS total_muncul,
    arg_min(exclude_reason, seq) FILTER (WHERE exclude_reason IS NOT NULL) AS reason,
    row_number() OVER (ORDER BY count(*) DESC, min(seq)) AS rank
  FROM marked WHERE username <> '' GROUP BY username) WHERE rank <= 20"""))
def top_accounts(spark, sf):
    return exclusion.top_accounts(
        exclusion.mark_exclusions(V.event_comments(spark, sf), EXCLUDED_USERS)
    )


# --- calibration ---------------------------------------------------------------
@register("labeled_sample", """
SELECT 'c' || l.doc_id AS comment_id, CASE WHEN l.doc_id % 11 = 0 THEN ' ' ELSE text END AS comment,
  CASE WHEN toxic = 1 THEN 'negatif' WHEN quality = 1 THEN 'positif' ELSE 'netral' END AS label,
  CASE WHEN l.doc_id % 2 = 0 THEN 'note ' || l.doc_id ELSE '' END AS notes
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
def labeled_sample(spark, sf):
    return readers.labeled_sample(V.labeled(spark, sf))


@register("answer_key", """
SELECT 'c' || doc_id AS comment_id,
  CASE WHEN toxic = 1 THEN 'negatif' WHEN quality = 1 THEN 'positif' ELSE 'netral' END
    AS sentiment_label,
  CASE WHEN doc_id % 2 = 0 THEN 'note ' || doc_id ELSE '' END AS notes FROM labels""")
def answer_key(spark, sf):
    return writers.answer_key(readers.labeled_sample(V.labeled(spark, sf)))


def _pairs(spark, sf):
    told = V.predictions(spark, sf).select(
        "comment_id", "model", classify.map_model_label(F.col("raw_label")).alias("label"),
        "confidence",
    )
    return calibrate.labeled_predictions(readers.labeled_sample(V.labeled(spark, sf)), told)


@register("model_accuracy", query("pairs", f"""
SELECT model, count(*) FILTER (WHERE label = truth) AS correct, count(*) AS total,
  {pct("count(*) FILTER (WHERE label = truth)", "count(*)")} AS accuracy_pct,
  count(*) FILTER (WHERE label = truth)::DOUBLE / count(*) >= 0.8 AS passes
FROM pairs GROUP BY model"""))
def model_accuracy(spark, sf):
    return calibrate.accuracy(_pairs(spark, sf))


@register("model_confusion", query("pairs", """
SELECT model, truth, label, count(*) AS n FROM pairs GROUP BY ALL"""))
def model_confusion(spark, sf):
    return calibrate.confusion(_pairs(spark, sf))


_SWEEP = f"""
SELECT model, threshold::DOUBLE AS threshold, count(*) FILTER (WHERE kept) AS kept,
  count(*) FILTER (WHERE NOT kept) AS escalated,
  {pct("count(*) FILTER (WHERE NOT kept)", "count(*)")} AS escalated_pct,
  count(*) FILTER (WHERE kept AND label = truth)::DOUBLE / nullif(count(*) FILTER (WHERE kept), 0)
    AS kept_accuracy,
  count(*) FILTER (WHERE NOT kept AND label = truth)::DOUBLE /
    nullif(count(*) FILTER (WHERE NOT kept), 0) AS escalated_accuracy
FROM (SELECT p.*, t.threshold, confidence >= t.threshold AS kept FROM pairs p, (
  SELECT unnest([{", ".join(f"{t}::DOUBLE" for t in C.THRESHOLDS)}]) AS threshold) t)
GROUP BY model, threshold"""


@register("threshold_sweep", query("pairs", _SWEEP))
def threshold_sweep(spark, sf):
    return calibrate.threshold_sweep(_pairs(spark, sf), by=["model"])


@register("chosen_threshold", query("pairs", """
SELECT model, coalesce(min(threshold) FILTER (WHERE kept_accuracy >= 0.8), max(threshold))
  AS threshold, coalesce(bool_or(kept_accuracy >= 0.8), false) AS reached
FROM sweep GROUP BY model""", sweep=_SWEEP))
def chosen_threshold(spark, sf):
    sweep = calibrate.threshold_sweep(_pairs(spark, sf), by=["model"])
    return calibrate.choose_threshold(sweep, by=["model"])
