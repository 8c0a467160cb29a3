"""Incremental runs over landed files, with restarts, repeats and late records."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.plan_queries import _KEPT, EXCLUDED
from catalog.registry import register
from catalog.sql import query
from catalog.text_queries import _LEXICON_ROWS, _SCORED
from echolens import constants as C
from echolens.plans.analyze import AnalyzeOptions
from echolens.session import RELEASED, held_settings, workspace
from echolens.streaming import incremental

RESULT = ("comment_id", "sentiment_label", "sentiment_confidence", "sentiment_method")
_RESULTS = f"SELECT 'c' || l.seq AS comment_id, l.* FROM kept k JOIN ({_LEXICON_ROWS}) l ON k.seq = l.seq"


def _run(spark, base, options, landed, files=4):
    """``landed`` is the number of files of the first landing, which tells how large a batch is."""
    stream = incremental.landed_comments(spark, f"{base}/landed", files_per_batch=files)
    parts = max(2 * min(files, landed), spark.sparkContext.defaultParallelism)
    incremental.incremental_analyze(
        stream, f"{base}/out", f"{base}/progress", options, compact_every=2, parts=parts
    ).awaitTermination()


def _landed(spark, sf):
    return V.posts(spark, sf).drop("sentiment_label", "sentiment_method", "run_id")


def _options(**more):
    return AnalyzeOptions(
        exclude=EXCLUDED, stopwords=V.STOPWORDS, slang=V.SLANG, lexicon=V.LEXICON, **more
    )


# Bytes of the table for a landed file, and files of a landing at least.
LANDED_BYTES, LANDED_FILES = 64 << 20, 8


def _land(rows, base, sf):
    """Rows land as packed files, whose number follows from the bytes and not from the shuffles.

    The fastest level packs them, since each is read once. Returns the number of files.
    """
    spark = rows.sparkSession
    table = int(V.table(spark, sf, "documents")._jdf.queryExecution().analyzed().stats().sizeInBytes())
    files = max(LANDED_FILES, table // LANDED_BYTES)
    with held_settings(spark, RELEASED):
        rows.coalesce(files).write.mode("append").options(
            **{"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
        ).json(f"{base}/landed")
    return files


@register("incremental_analysis", query(
    "tokenized", f"SELECT {', '.join(RESULT)} FROM labeled", **_SCORED, kept=_KEPT, labeled=_RESULTS))
def incremental_analysis(spark, sf):
    """Posts land in two parts and are labeled batch by batch, with a restart between.

    The second part repeats a third of the first one; what is finished is known
    from the state.
    """
    base = workspace(spark, "incremental")
    posts = _landed(spark, sf)
    landed = _land(posts.filter("seq % 2 = 0"), base, sf)
    _run(spark, base, _options(), landed)
    _land(posts.filter("seq % 2 = 1 OR seq % 6 = 0"), base, sf)
    _run(spark, base, _options(), landed)
    return incremental.current_results(spark, f"{base}/out").select(*RESULT)


@register("incremental_mode_change", query("tokenized", f"""
SELECT comment_id, CASE WHEN stays THEN sentiment_label WHEN seq % 9 <> 0 THEN '{C.NEGATIVE}'
    ELSE '{C.UNCLASSIFIED}' END AS sentiment_label,
  CASE WHEN stays THEN sentiment_confidence WHEN seq % 9 <> 0 THEN (50 + seq % 50) / 100.0::DOUBLE
    ELSE 0.0::DOUBLE END AS sentiment_confidence,
  CASE WHEN seq % 3 <> 0 THEN sentiment_method WHEN stays THEN 'model' WHEN seq % 9 <> 0 THEN 'llm'
    ELSE 'llm_failed' END AS sentiment_method
FROM (SELECT *, seq % 3 <> 0 OR sentiment_confidence >= 0.9 AS stays FROM labeled)""",
    **_SCORED, kept=_KEPT, labeled=_RESULTS))
def incremental_mode_change(spark, sf):
    """All posts are labeled, then a third lands again once there are second opinions."""
    base = workspace(spark, "incremental")
    posts = _landed(spark, sf)
    landed = _land(posts, base, sf)
    _run(spark, base, _options(), landed, files=1000)
    _land(posts.filter("seq % 3 = 0"), base, sf)
    second = posts.filter("seq % 9 <> 0").select(
        "comment_id", F.lit(C.NEGATIVE).alias("label"), ((50 + F.col("seq") % 50) / 100.0).alias("confidence")
    )
    _run(spark, base, _options(fallback=second, threshold=0.9), landed, files=1000)
    return incremental.current_results(spark, f"{base}/out").select(*RESULT)


@register("incremental_collection", """
SELECT 'v' || user_id AS aweme_id, max(event_id) AS landed_at,
  arg_max(event_type, event_id) AS caption FROM events GROUP BY user_id""")
def incremental_collection(spark, sf):
    """Collected videos land repeatedly; the last record of each one counts."""
    base = workspace(spark, "collected")
    rows = V.table(spark, sf, "events").select(
        F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("aweme_id"),
        F.col("event_id").alias("landed_at"), F.col("event_type").alias("caption"),
        F.array(F.col("props")).alias("comments"),
    )
    rows.write.json(f"{base}/landed")
    stream = spark.readStream.schema(
        "aweme_id string, landed_at bigint, caption string, comments array<string>"
    ).json(f"{base}/landed")
    incremental.incremental_collect(stream, f"{base}/out", f"{base}/progress").awaitTermination()
    return incremental.current_videos(spark, f"{base}/out").select(
        "aweme_id", "landed_at", "caption"
    )


# Landings of ten days each; some records come one landing later, some three, some twice.
SPAN_DAYS, DELAY_DAYS, FILES = 10, 12, 2
_LANDING = (
    f"CAST(floor((epoch_s - 1704067200) / {SPAN_DAYS * 86400}) AS BIGINT)"
    " + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN event_id % 5 = 0 THEN 3 ELSE 0 END"
)


@register("late_collection", f"""
WITH once AS (SELECT *, {_LANDING} AS landing FROM (SELECT *, epoch(ts) AS epoch_s FROM events)),
landed AS (SELECT * FROM once UNION ALL SELECT * REPLACE (landing + 1 AS landing) FROM once
  WHERE event_id % 4 = 0),
marks AS (SELECT a.landing, date_trunc('milliseconds', max(b.ts)) - INTERVAL {DELAY_DAYS} DAY AS mark
  FROM (SELECT DISTINCT landing FROM landed) a LEFT JOIN landed b ON b.landing <= a.landing - 2
  GROUP BY a.landing)
SELECT 'v' || event_id % 3331 AS aweme_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS landed_at,
  arg_max(event_type, ts) AS caption
FROM landed l JOIN marks m ON l.landing = m.landing WHERE mark IS NULL OR ts > mark GROUP BY ALL""")
def late_collection(spark, sf):
    """Records land out of order, twice or late; late ones are left out.

    The watermark of a batch stems from the batches before the one that precedes it.
    """
    base = workspace(spark, "late")
    once = V.table(spark, sf, "events").withColumn("epoch_s", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    once = once.withColumn("landing", F.expr(_LANDING))
    again = once.filter("event_id % 4 = 0").withColumn("landing", F.col("landing") + 1)
    rows = once.unionByName(again).select(
        F.concat(F.lit("v"), (F.col("event_id") % 3331).cast("string")).alias("aweme_id"),
        F.col("ts").cast("timestamp").alias("landed_at"), F.col("event_type").alias("caption"),
        F.array(F.col("props")).alias("comments"), "landing",
    )
    for landing in range(8):
        # one landing after the other, each of as many files as a batch takes
        rows.filter(F.col("landing") == landing).drop("landing").repartition(FILES).write.mode(
            "append"
        ).parquet(f"{base}/landed")
    stream = spark.readStream.schema(
        "aweme_id string, landed_at timestamp, caption string, comments array<string>"
    ).option("maxFilesPerTrigger", FILES).parquet(f"{base}/landed")
    incremental.incremental_collect(
        stream, f"{base}/out", f"{base}/progress", event_time="landed_at",
        delay=f"{DELAY_DAYS} days", compact_every=3,
    ).awaitTermination()
    return incremental.current_videos(spark, f"{base}/out", order="landed_at").select(
        "aweme_id", F.date_format("landed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("landed_at"), "caption"
    )
