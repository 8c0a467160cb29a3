"""Incremental runs: newly landed files, each processed once.

What is finished is kept as keyed state, one small value per comment, so a batch
costs what it brings and never reads earlier output. Output is a log of batches
(``log.BatchLog``): a restart replays a batch under the same number and overwrites
its own folder, so output is complete and free of repeats after a failure.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from echolens import schema as S
from echolens.operators.exclusion import INLINE_LIMIT, analyzed_rows, mark_exclusions
from echolens.plans.analyze import AnalyzeOptions, label_rows
from echolens.session import RELEASED, held_settings
from echolens.sources.readers import last_wins
from echolens.streaming.log import BatchLog
from echolens.streaming.state import Unfinished

FLAT_SCHEMA = (
    "comment_id string, video_id string, video_caption string, video_author_username string, "
    "is_reply boolean, parent_comment_id string, username string, text_raw string, "
    "create_time string, digg_count bigint, excluded boolean, exclude_reason string, seq bigint"
)
# Types whose values a cast to string and back leaves as they are, and the column for them.
AS_TEXT = ("string", "boolean", "tinyint", "smallint", "int", "bigint")
ROW = "_row"
PARTITIONS = "spark.sql.shuffle.partitions"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def landed_comments(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of flat comments landed as JSON lines."""
    return (
        spark.readStream.schema(FLAT_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch).json(path)
    )


def _run_batches(
    stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None],
    available_now: bool = True, mode: str = "append", parts: int | None = None,
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(step).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    # the stream keeps the settings that it starts with
    spark, settings = stream.sparkSession, dict(RELEASED)
    if parts is not None:
        settings[PARTITIONS] = str(min(parts, int(spark.conf.get(PARTITIONS))))
    with held_settings(spark, settings):
        return writer.start()


def last_of_task(key: str, order: str):
    """Of the rows that a task holds at once, the last one per key: what a hot key shuffles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(key).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            place = batch.column(order).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            by = np.lexsort((place, keys))
            last = np.append(keys[by][1:] != keys[by][:-1], True) if len(by) else by
            yield batch.take(pa.array(np.sort(by[last.astype(bool)])))

    return run


def _carried(rows: DataFrame) -> DataFrame:
    """Key, place and the whole row for the state.

    Each row comes back from Python as an Arrow batch of its own, so what it costs is its
    number of columns: those that a string holds exactly travel in one.
    """
    packed = [c for c, kind in rows.dtypes if kind in AS_TEXT]
    named = [c for c in rows.columns if c not in packed or c in ("comment_id", "seq")]
    return rows.select(*named, F.array(*[F.col(c).cast("string") for c in packed]).alias(ROW))


def _restored(carried: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows that ``_carried`` has put together, with the columns of ``rows``."""
    kinds = dict(rows.dtypes)
    packed = [c for c in rows.columns if kinds[c] in AS_TEXT]
    return carried.select(*[
        F.get(ROW, F.lit(packed.index(c))).cast(kinds[c]).alias(c) if c in packed else c for c in rows.columns
    ])


def unfinished(stream: DataFrame, hybrid: bool, forget_after: timedelta | None = None) -> DataFrame:
    """Comments of a stream that need a result in this mode, each once."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    carried = _carried(stream.mapInArrow(last_of_task("comment_id", "seq"), stream.schema))
    packed = [c for c, kind in stream.dtypes if kind in AS_TEXT]
    passed = StructType([f for f in carried.schema if f.name not in packed])
    kept = carried.groupBy("comment_id").transformWithState(
        Unfinished(hybrid, forget_after), passed, "Update",
        "None" if forget_after is None else "ProcessingTime",
    )
    return _restored(kept, stream)


def _analyzed(stream: DataFrame, accounts: DataFrame | Sequence[str]) -> DataFrame:
    """Rows of a stream that are analyzed; long account lists and tables are anti-joined as static tables."""
    if not isinstance(accounts, DataFrame) and len(accounts) <= INLINE_LIMIT:
        return analyzed_rows(mark_exclusions(stream, accounts))
    if not isinstance(accounts, DataFrame):
        accounts = stream.sparkSession.createDataFrame([(name,) for name in accounts], "username string")
    kept = analyzed_rows(mark_exclusions(stream, ()))
    return kept.join(accounts.select("username").distinct(), "username", "left_anti").select(*stream.columns)


def incremental_analyze(
    stream: DataFrame, output: str, checkpoint: str, options: AnalyzeOptions,
    available_now: bool = True, forget_after: timedelta | None = None, compact_every: int | None = None,
    parts: int | None = None,
) -> StreamingQuery:
    """Label comments not labeled yet in this mode, and append them.

    Comments of the uploader and of the excluded accounts are left out, as in a
    batch run. A comment labeled without a fallback is labeled again when it lands
    once there is one, and the other way round. The checkpoint holds the state.
    ``forget_after`` is for runs that go on: timers keep a query awake. Each batch runs
    and commits every partition of the state, whatever it brings: ``parts`` is their largest
    number, for batches that are small beside the session's shuffles. The first run decides.
    """
    if available_now and forget_after is not None:
        raise ValueError("states with a lifetime need a query that goes on")
    hybrid = options.fallback is not None
    columns = [*S.FLAT_COLUMNS, *S.ANALYZED_COLUMNS]
    kept = _analyzed(stream, options.exclude)

    def step(batch: DataFrame, batch_id: int) -> None:
        # the batch is read once: by the append, or by what label_rows writes
        labeled = label_rows(batch, options).select(*columns)
        log = results_log(batch.sparkSession, output)
        log.append(labeled.withColumn("hybrid_enabled", F.lit(hybrid)), batch_id)
        log.maybe_compact(batch_id, compact_every)

    return _run_batches(unfinished(kept, hybrid, forget_after), checkpoint, step, available_now, "update", parts)


def results_log(spark: SparkSession, output: str) -> BatchLog:
    return BatchLog(spark, output, "comment_id", texts=("text_raw", "text_clean", "tokens_stemmed"))


def current_results(spark: SparkSession, output: str) -> DataFrame:
    """Latest result per comment."""
    return results_log(spark, output).current()


def incremental_collect(
    stream: DataFrame, output: str, checkpoint: str, key: str = "aweme_id",
    order: str = "landed_at", available_now: bool = True, event_time: str | None = None,
    delay: str | None = None, compact_every: int | None = None,
) -> StreamingQuery:
    """Append collected videos; within a batch the last record of a video wins.

    Across batches ``current_videos`` lets the later batch win.

    With ``event_time`` and ``delay`` the log is fed by at-least-once delivery:
    records (key and event time) that land again within the delay are dropped while
    they stream, records older than the delay are late and left out (the query's
    progress counts them), and the state stays bounded. Then ``current_videos``
    needs ``order`` too, since records may land out of order.
    """
    usable = stream.filter((F.coalesce(F.col(key), F.lit("")) != "") & F.col("comments").isNotNull())
    if event_time is not None:
        usable = usable.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key, event_time])

    def step(batch: DataFrame, batch_id: int) -> None:
        # a compaction must keep the record that ``current_videos`` will count
        log = BatchLog(batch.sparkSession, output, key, [order] if event_time else [])
        log.append(last_wins(batch, [key], order), batch_id)
        log.maybe_compact(batch_id, compact_every)

    return _run_batches(usable, checkpoint, step, available_now)


def current_videos(
    spark: SparkSession, output: str, key: str = "aweme_id", order: str | None = None
) -> DataFrame:
    """The record of each video that counts: by ``order``, or else of the latest batch."""
    return BatchLog(spark, output, key, [order] if order else []).current()


def late_records(query: StreamingQuery) -> int:
    """Records that a query has left out because they were older than its delay."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress for operator in progress["stateOperators"]
    )
