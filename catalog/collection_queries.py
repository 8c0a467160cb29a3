"""Order mirror, sampling, landed pages, flattening and month files."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.registry import register
from catalog.sql import ISO, TIER_OF, query, strip
from echolens.functions import text as X
from echolens.operators import collect, ingest, mirror, sampling, skew
from echolens.session import durable, workspace
from echolens.sources import readers, split, writers

SEED = 7
SIZE = 150

# --- order mirror ------------------------------------------------------------


@register("page_url_ids", query("", f"""
SELECT page_id, nullif(regexp_extract(value, '(?:/(?:video|photo)/|^)(\\d{{6,}})', 1), '') AS id,
  substr(value, 1, 10) AS start
FROM (SELECT page_id, {strip('url')} AS value FROM (
  SELECT page_id, regexp_replace(url, '/(en|fr|de|es)/', '/video/' || (600000 + page_id)) AS url
  FROM pages))"""))
def page_url_ids(spark, sf):
    pages = V.table(spark, sf, "pages")
    number = F.concat(F.lit("/video/"), (F.col("page_id") + 600000).cast("string"))
    url = F.regexp_replace(F.col("url"), F.lit("/(en|fr|de|es)/"), number)
    return pages.select(
        "page_id", X.video_id(url).alias("id"), F.substring(X.strip(url), 1, 10).alias("start")
    )


@register("mirror_video_keys", query("keyed", """
SELECT line, account_type, creator_username, video_id FROM keyed"""))
def mirror_video_keys(spark, sf):
    return mirror.keyed_rows(V.mirror(spark, sf)).drop("value")


@register("mirror_first_rows", query("firsts", """
SELECT video_id, line, account_type, creator_username FROM firsts"""))
def mirror_first_rows(spark, sf):
    return mirror.candidates(V.mirror(spark, sf))


_REJECTS = f"""
SELECT k.line, CASE WHEN {strip('k.value')} = '' THEN 'empty' WHEN k.video_id IS NULL
    THEN 'no video id' WHEN k.account_type <> f.account_type THEN 'duplicate, other account type'
    ELSE 'duplicate' END AS reason,
  coalesce(k.video_id, {strip('k.value')}) AS detail, k.account_type,
  CASE WHEN k.video_id IS NOT NULL THEN f.account_type END AS kept_account_type
FROM keyed k LEFT JOIN firsts f ON k.video_id = f.video_id
WHERE k.video_id IS NULL OR k.line <> f.line"""


@register("mirror_rejected_rows", query("firsts", _REJECTS))
def mirror_rejected_rows(spark, sf):
    return mirror.rejected_rows(V.mirror(spark, sf))


@register("mirror_reject_counts", query(
    "firsts", "SELECT reason, count(*) AS lines FROM rejects GROUP BY reason", rejects=_REJECTS))
def mirror_reject_counts(spark, sf):
    return mirror.reject_counts(V.mirror(spark, sf))


@register("pending_videos", query("firsts collected", """
SELECT video_id, account_type FROM firsts WHERE video_id NOT IN (SELECT video_id FROM collected)"""))
def pending_videos(spark, sf):
    rows = sampling.without_collected(
        mirror.candidates(V.mirror(spark, sf)), V.collected(spark, sf)
    )
    return rows.select("video_id", "account_type")


@register("ids_of_all_runs", query("firsts collected", """
SELECT video_id FROM firsts UNION SELECT video_id FROM collected"""))
def ids_of_all_runs(spark, sf):
    return sampling.union_of_runs(
        [mirror.candidates(V.mirror(spark, sf)), V.collected(spark, sf)]
    )


@register("new_ids_per_source", """
SELECT event_type AS source, coalesce(n, 0) AS new_ids FROM (SELECT DISTINCT event_type FROM events)
LEFT JOIN (SELECT source, count(*) AS n FROM (
  SELECT user_id, min(event_type) AS source FROM events GROUP BY user_id) GROUP BY source)
ON event_type = source""")
def new_ids_per_source(spark, sf):
    rows = V.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("video_id"), F.col("event_type").alias("source")
    )
    return readers.new_ids_per_source(rows, "video_id", ["source"])[1]


@register("last_log_entry", """
SELECT '' || user_id AS user_id, max(event_id) AS line, arg_max(event_type, event_id) AS event_type
FROM events GROUP BY user_id""")
def last_log_entry(spark, sf):
    rows = V.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("user_id"), F.col("event_id").alias("line"),
        "event_type",
    )
    return readers.last_wins(rows, ["user_id"], "line")


# --- sampling ----------------------------------------------------------------
_ALLOCATION = {
    "available": f"""
SELECT s.tier, s.priority, coalesce(n, 0) AS available FROM tier_spine s LEFT JOIN (
  SELECT {TIER_OF.format('account_type')} AS tier, count(*) AS n FROM firsts GROUP BY 1) c
ON s.tier = c.tier""",
    "shares": f"""
SELECT *, {SIZE} * [50, 30, 20, 0][priority] AS slots,
  {SIZE} * [50, 30, 20, 0][priority] // 100 AS whole FROM available""",
    "wanted": """
SELECT *, whole + CASE WHEN row_number() OVER (ORDER BY CASE WHEN priority = 4 THEN -1
    ELSE slots % 100 END DESC, priority) <= (SELECT sum(slots) // 100 - sum(whole) FROM shares)
  THEN 1 ELSE 0 END AS wanted FROM shares""",
    # the loop over the four tiers, written out
    "w": """
SELECT max(wanted) FILTER (priority = 1) AS w1, max(wanted) FILTER (priority = 2) AS w2,
  max(wanted) FILTER (priority = 3) AS w3, max(available) FILTER (priority = 1) AS a1,
  max(available) FILTER (priority = 2) AS a2, max(available) FILTER (priority = 3) AS a3,
  max(available) FILTER (priority = 4) AS a4 FROM wanted""",
    "t1": "SELECT *, least(w1, a1) AS x1 FROM w",
    "t2": "SELECT *, least(w2 + w1 - x1, a2) AS x2 FROM t1",
    "t3": "SELECT *, least(w3 + w1 + w2 - x1 - x2, a3) AS x3 FROM t2",
    "t4": "SELECT *, least(w1 + w2 + w3 - x1 - x2 - x3, a4) AS x4 FROM t3",
    "allocation": f"""
SELECT tier, available, [x1, x2, x3, x4][priority] AS allocated,
  {SIZE} - x1 - x2 - x3 - x4 AS unfilled FROM available, t4""",
}


@register("tier_availability", query(
    "firsts tier_spine", "SELECT tier, available FROM available",
    available=_ALLOCATION["available"]))
def tier_availability(spark, sf):
    return sampling.tier_availability(mirror.candidates(V.mirror(spark, sf)))


@register("quota_allocation", query(
    "firsts tier_spine", "SELECT * FROM allocation", **_ALLOCATION))
def quota_allocation(spark, sf):
    available = sampling.tier_availability(mirror.candidates(V.mirror(spark, sf)))
    return sampling.allocate(available, SIZE).select(
        "tier", "available", "allocated", "unfilled"
    )


_DRAWN = f"""
SELECT f.video_id, f.account_type, t.tier, md5('{SEED}:order:' || f.video_id) AS position
FROM (SELECT *, {TIER_OF.format('account_type')} AS own, row_number() OVER (
    PARTITION BY {TIER_OF.format('account_type')} ORDER BY md5('{SEED}:draw:' || video_id)) AS rn
  FROM firsts) f JOIN allocation t ON f.own = t.tier WHERE f.rn <= t.allocated"""


@register("quota_sample", query("firsts tier_spine", _DRAWN, **_ALLOCATION))
def quota_sample(spark, sf):
    videos = durable(mirror.candidates(V.mirror(spark, sf)))
    sample, _ = sampling.quota_sample(videos, SIZE, seed=SEED)
    return sample.select("video_id", "account_type", "tier", "position")


@register("sample_manifest", query("firsts tier_spine", f"""
SELECT {SIZE} AS requested_size, CAST(sum(allocated) AS BIGINT) AS sampled,
  CAST(max(unfilled) AS BIGINT) AS unfilled_slots,
  (SELECT CAST(sum(lines) - count(*) AS BIGINT) FROM firsts) AS duplicate_rows_dropped,
  CASE WHEN sum(allocated) * 123 >= 3600 THEN (sum(allocated) * 123 // 3600) || 'h '
    || (sum(allocated) * 123 % 3600 // 60) || 'm' ELSE (sum(allocated) * 123 // 60) || 'm' END
    AS estimated_batch_duration,
  string_agg(tier || '=' || allocated, ',' ORDER BY tier) AS per_tier
FROM allocation""", **_ALLOCATION))
def sample_manifest(spark, sf):
    rows = V.mirror(spark, sf)
    firsts = mirror.first_rows_per_video(mirror.keyed_rows(rows))
    allocation = sampling.allocate(sampling.tier_availability(firsts), SIZE)
    dropped = firsts.agg(F.sum(F.col("lines") - 1)).scalar()
    record = sampling.manifest(allocation, SEED, dropped, 0, "orders")
    entries = F.array_sort(F.map_entries("sampled_per_tier"))
    return record.select(
        "requested_size", "sampled", "unfilled_slots", "duplicate_rows_dropped",
        "estimated_batch_duration",
        F.array_join(F.transform(
            entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ","
        ).alias("per_tier"),
    )


@register("label_sample", query("posts", """
SELECT comment_id, username FROM posts ORDER BY md5('20260830:label:' || comment_id) LIMIT 200"""))
def label_sample(spark, sf):
    return sampling.label_sample(V.posts(spark, sf), 200, 20260830).select(
        "comment_id", "username"
    )


@register("label_sample_without_labeled", query("posts", """
SELECT comment_id FROM posts WHERE comment_id NOT IN (SELECT 'c' || doc_id FROM labels)
ORDER BY md5('5:label:' || comment_id) LIMIT 100"""))
def label_sample_without_labeled(spark, sf):
    fresh = sampling.without_labeled(V.posts(spark, sf), V.labeled(spark, sf))
    return sampling.label_sample(fresh, 100, 5).select("comment_id")


# --- landed pages ------------------------------------------------------------
MAX_COMMENTS, MAX_REPLIES = 9, 2


@register("page_comments", query("landed", f"""
SELECT video_id, comment_id, username, '' AS nickname, comment,
  strftime(make_timestamp(epoch * 1000000), {ISO}) AS create_time, '' AS avatar, digg_count,
  total_reply, false AS no_id, epoch IS NULL AS bad_time
FROM landed WHERE turn = 0 AND {strip('comment')} <> ''"""))
def page_comments(spark, sf):
    pages, _ = V.landed_pages(spark, sf)
    entries = collect.page_entries(pages, ["video_id"])
    kept = entries.filter(collect.usable(F.col("raw.text")))
    return collect.project_comment(kept, ["video_id"])


@register("blank_comments_per_video", query("landed", f"""
SELECT video_id, count(*) FILTER (WHERE {strip('comment')} = '') AS skipped_blank
FROM landed WHERE turn = 0 GROUP BY video_id"""))
def blank_comments_per_video(spark, sf):
    pages, _ = V.landed_pages(spark, sf)
    return collect.blank_counts(collect.page_entries(pages, ["video_id"]))


@register("video_captions", query("landed", """
SELECT video_id, coalesce(max('Title ' || video_id) FILTER (WHERE conv_id % 10 = 1), '') AS caption,
  'https://www.tiktok.com/video/' || video_id AS video_url
FROM landed WHERE turn = 0 GROUP BY video_id"""))
def video_captions(spark, sf):
    pages, _ = V.landed_pages(spark, sf)
    return collect.video_info(collect.page_entries(pages, ["video_id"]))


_COLLECTED = {
    "tops": f"SELECT * FROM landed WHERE turn = 0 AND {strip('comment')} <> ''",
    "answers": f"""
SELECT * FROM (SELECT l.*, row_number() OVER (PARTITION BY l.conv_id ORDER BY l.turn) AS rn
  FROM landed l WHERE l.turn > 0 AND {strip('l.comment')} <> '')
WHERE rn <= {MAX_REPLIES} AND conv_id IN (SELECT conv_id FROM tops)""",
    "broken": """
SELECT video_id FROM tops WHERE epoch IS NULL UNION SELECT video_id FROM answers
WHERE epoch IS NULL""",
    "spent": """
SELECT t.*, coalesce(sum(1 + coalesce(n, 0)) OVER (PARTITION BY video_id ORDER BY t.conv_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
FROM tops t LEFT JOIN (SELECT conv_id, count(*) AS n FROM answers GROUP BY conv_id) r
ON t.conv_id = r.conv_id""",
    "kept": f"""
SELECT * FROM spent WHERE before < {MAX_COMMENTS}
AND video_id NOT IN (SELECT video_id FROM broken)""",
}


@register("collected_comments", query("landed", f"""
SELECT video_id, comment_id, NULL AS parent_comment_id, false AS is_reply, username, comment,
  strftime(make_timestamp(epoch * 1000000), {ISO}) AS create_time, digg_count FROM kept
UNION ALL SELECT video_id, comment_id, conv_id || '-0', true, username, comment,
  strftime(make_timestamp(epoch * 1000000), {ISO}), digg_count FROM answers
WHERE conv_id IN (SELECT conv_id FROM kept)""", **_COLLECTED))
def collected_comments(spark, sf):
    rows, _ = collect.collect_comments(
        *V.landed_pages(spark, sf), max_comments=MAX_COMMENTS, max_replies=MAX_REPLIES
    )
    return rows.select(
        "video_id", "comment_id", "parent_comment_id", "is_reply", "username", "comment",
        "create_time", "digg_count",
    )


@register("invalid_videos", query("landed", "SELECT video_id FROM broken", **_COLLECTED))
def invalid_videos(spark, sf):
    return collect.collect_comments(
        *V.landed_pages(spark, sf), max_comments=MAX_COMMENTS, max_replies=MAX_REPLIES
    )[1]


@register("budget_cap", query("event_comments", """
SELECT video_id, comment_id FROM (SELECT *, coalesce(sum(1 + digg_count % 4) OVER (
  PARTITION BY video_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent
FROM event_comments) WHERE spent < 60"""))
def budget_cap(spark, sf):
    rows = V.event_comments(spark, sf).withColumn("reply_count", F.col("digg_count") % 4)
    return collect.cap_videos(rows, 60, order="seq").select("video_id", "comment_id")


@register("reply_cap", query("event_comments", """
SELECT video_id, comment_id FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY seq)
  AS rn FROM event_comments) WHERE rn <= 5"""))
def reply_cap(spark, sf):
    rows = V.event_comments(spark, sf)
    return collect.cap_replies(rows, 5, order="seq", keys=("video_id",)).select(
        "video_id", "comment_id"
    )


@register("long_cap", query("order_comments", """
SELECT sentiment_label, comment_id, rank FROM (SELECT *, row_number() OVER (
  PARTITION BY sentiment_label ORDER BY digg_count DESC, seq) AS rank FROM order_comments)
WHERE rank <= 2500"""))
def long_cap(spark, sf):
    rows = V.order_comments(spark, sf)
    best = skew.top_per_group(
        rows, ["sentiment_label"], [F.col("digg_count").desc(), F.col("seq")], 2500,
        spread=["seq"],
    )
    return best.select("sentiment_label", "comment_id", "rank")


@register("silent_creators", query("firsts order_comments", """
SELECT video_id, creator_username FROM firsts f WHERE creator_username <> '' AND NOT EXISTS (
  SELECT 1 FROM orders o WHERE '' || (o.o_custkey + 7000000) = f.video_id
  AND 'maker' || (o.o_orderkey % 50) = f.creator_username)"""))
def silent_creators(spark, sf):
    said = V.table(spark, sf, "orders").select(
        (F.col("o_custkey") + 7000000).cast("string").alias("video_id"),
        F.concat(F.lit("maker"), (F.col("o_orderkey") % 50).cast("string")).alias("username"),
    )
    return collect.silent_creators(mirror.candidates(V.mirror(spark, sf)), said)


# --- flattening and month files ----------------------------------------------
@register("nested_videos", query("talk", """
SELECT aweme_id, count(*) AS total_collected, count(*) FILTER (WHERE NOT is_reply) AS comments,
  min(comment_id) FILTER (WHERE NOT is_reply) IS NOT NULL AS has_comments
FROM talk GROUP BY aweme_id"""))
def nested_videos(spark, sf):
    videos = ingest.nest_comments(V.talk_rows(spark, sf))
    return videos.select(
        "aweme_id", "total_collected", F.size("comments").cast("bigint").alias("comments"),
        (F.size("comments") > 0).alias("has_comments"),
    )


_FLAT = """
SELECT comment_id, aweme_id AS video_id,
  CASE WHEN video_no % 2 = 0 THEN '+Caption ' || aweme_id ELSE '' END AS video_caption,
  CASE WHEN video_no % 2 = 1 THEN 'user3' ELSE '' END AS video_author_username,
  is_reply, parent_comment_id, username, comment AS text_raw, create_time,
  coalesce(digg_count, 0) AS digg_count, false AS excluded, CAST(NULL AS VARCHAR) AS exclude_reason,
  video_no * 16777216 + row_number() OVER (PARTITION BY aweme_id ORDER BY conv_id, turn) - 1 AS seq
FROM talk"""


@register("flat_comments", query("talk", _FLAT))
def flat_comments(spark, sf):
    return ingest.flatten_with("short_video", V.nested_talk(spark, sf))


@register("month_lines", query("talk", """
SELECT CASE WHEN video_no % 3 = 0 THEN 'kol account' ELSE 'unknown' END AS account_type, aweme_id,
  CASE WHEN video_no % 2 = 0 THEN '''+Caption ' || aweme_id ELSE '' END AS caption,
  '' AS video_url, CASE WHEN video_no % 2 = 1 THEN 'user3' ELSE '' END AS video_author_username,
  comment_id, coalesce(parent_comment_id, '') AS parent_comment_id,
  CASE WHEN is_reply THEN 1 ELSE 0 END AS is_reply, username, coalesce(nickname, '') AS nickname,
  CASE WHEN regexp_matches(comment, '^[=+\\-@]') THEN '''' || comment ELSE comment END AS comment,
  create_time, coalesce(digg_count, 0) AS digg_count, 0 AS total_reply
FROM talk"""))
def month_lines(spark, sf):
    return writers.month_lines(ingest.month_rows(V.nested_talk(spark, sf)))


@register("orphan_replies", query("posts", """
SELECT comment_id, parent_comment_id FROM posts WHERE is_reply AND parent_comment_id NOT IN (
  SELECT comment_id FROM posts WHERE NOT is_reply)"""))
def orphan_replies(spark, sf):
    return ingest.orphan_replies(V.posts(spark, sf)).select("comment_id", "parent_comment_id")


@register("thread_sizes", query("talk", """
SELECT t.comment_id, t.aweme_id AS video_id, coalesce(n, 0) AS replies FROM talk t LEFT JOIN (
  SELECT parent_comment_id AS p, count(*) AS n FROM talk WHERE is_reply GROUP BY 1) r
ON t.comment_id = r.p WHERE NOT t.is_reply"""))
def thread_sizes(spark, sf):
    return ingest.thread_sizes(V.talk_rows(spark, sf).withColumnRenamed("aweme_id", "video_id"))


@register("broken_input_rules", query("talk", """
SELECT aweme_id AS video_id, comment_id, 'missing create_time' AS rule FROM talk
WHERE length(comment) % 5 = 0
UNION ALL SELECT aweme_id, NULL, 'missing comments' FROM talk WHERE is_reply
UNION ALL SELECT NULL, NULL, 'missing aweme_id' FROM talk WHERE NOT is_reply AND conv_id % 8 = 0"""))
def broken_input_rules(spark, sf):
    """Every row as a video record of its own, some of them broken."""
    rows = V.talk_rows(spark, sf)
    whole = F.to_json(F.struct(
        "comment_id", "username", "comment", "create_time"), {"ignoreNullFields": "false"})
    partial = F.to_json(F.struct("comment_id", "username", "comment"))
    one = F.when(F.length("comment") % 5 == 0, partial).otherwise(whole)
    conv = F.floor(F.col("seq") / 1000)
    no_id = ~F.col("is_reply") & (conv % 8 == 0)
    good = F.concat(F.lit('{"aweme_id": "'), "aweme_id", F.lit('", "comments": ['), one, F.lit("]}"))
    bare = F.concat(F.lit('{"aweme_id": "'), "aweme_id", F.lit('", "comments": null}'))
    anonymous = F.concat(F.lit('{"comments": ['), one, F.lit("]}"))
    listed = F.explode(F.array_compact(F.array(
        good, F.when(F.col("is_reply"), bare), F.when(no_id, anonymous)
    ))).alias("body")
    return ingest.schema_violations(rows.select(F.col("seq").alias("video_no"), listed))


@register("account_types", query("posts", """
SELECT video_id, arg_max(kind, seq) AS account_type FROM (SELECT video_id, seq,
  CASE WHEN seq % 4 = 0 THEN 'unknown' ELSE 'type ' || (seq % 9) END AS kind FROM posts)
GROUP BY video_id"""))
def account_types(spark, sf):
    n = F.col("seq")
    videos = V.posts(spark, sf).select(
        F.col("video_id").alias("aweme_id"), n.alias("video_no"),
        F.when(n % 4 == 0, "").otherwise(
            F.concat(F.lit("type "), (n % 9).cast("string"))).alias("account_type"),
    )
    return readers.account_types(videos)


# --- files whose records do not end where lines do -----------------------------------
SPLIT_BYTES = "256k"


# Beyond this many splits they grow with the files: what a task reports goes to the driver.
MAX_SPLITS = 2000


def _split_bytes(spark, path):
    """``SPLIT_BYTES``, or what cuts the files of ``path`` into ``MAX_SPLITS``."""
    total = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return max(int(SPLIT_BYTES.removesuffix("k")) << 10, -(-total // MAX_SPLITS))


def _in_small_splits(spark, path, read):
    """What ``read`` gives while files are cut into small splits, written."""
    size = f"{_split_bytes(spark, path)}b"
    names = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1k"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        return durable(read())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@register("quoted_csv_round_trip", """
SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS chars, sha256(coalesce(text, '')) AS digest
FROM documents""")
def quoted_csv_round_trip(spark, sf):
    """Documents with line breaks, commas and quotes, through quoted CSV in many tasks."""
    base = workspace(spark, "quoted")
    text = F.coalesce("text", F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    rows = V.table(spark, sf, "documents").select(F.concat_ws(",", F.col("doc_id").cast("string"), quoted).alias("value"))
    header = F.when(F.monotonically_increasing_id() % (1 << 33) == 0, F.array(F.lit("url_or_id,account_type"), F.col("value")))
    rows.select(F.explode(F.coalesce(header, F.array("value"))).alias("value")).write.text(f"{base}/csv")
    back = _in_small_splits(spark, f"{base}/csv", lambda: split.read_csv(spark, f"{base}/csv"))
    cell = F.coalesce("account_type", F.lit(""))
    return back.select(
        F.col("url_or_id").cast("bigint").alias("doc_id"), F.length(cell).cast("bigint").alias("chars"),
        F.sha2(cell, 256).alias("digest"),
    )


@register("json_array_round_trip", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, sha256(text) AS digest, lang FROM documents""")
def json_array_round_trip(spark, sf):
    """Documents as nested objects of JSON arrays on one line, cut off before the last bracket, read in many tasks."""
    base = workspace(spark, "arrays")
    video = F.to_json(F.struct(
        F.col("doc_id").cast("string").alias("aweme_id"), F.col("text").alias("caption"),
        F.array(F.struct(F.col("lang").alias("comment_id"), F.lit("} ] \" {").alias("comment"))).alias("comments"),
    ))
    first = F.monotonically_increasing_id() % (1 << 33) == 0
    rows = V.table(spark, sf, "documents").select(F.concat(F.when(first, "[").otherwise(","), video).alias("value"))
    rows.write.option("lineSep", " ").text(f"{base}/json")
    back = _in_small_splits(
        spark, f"{base}/json", lambda: readers.read_videos(spark, f"{base}/json", split=True)
    )
    return back.select(
        F.col("aweme_id").cast("bigint").alias("doc_id"), F.length("caption").cast("bigint").alias("chars"),
        F.sha2("caption", 256).alias("digest"), F.col("comments")[0]["comment_id"].alias("lang"),
    )
