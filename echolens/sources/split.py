"""Records of large text files whose borders depend on what stands before them.

A line break inside a quoted CSV cell ends no record, and a brace inside a JSON
string closes nothing. Whether one does depends on the whole file before it. The
file is read in pieces that any task can find (lines, or what ends in a brace), and
each piece is a small function of the state it begins in: from outside or inside of
quotes to the same, and a change of depth. Functions compose, so

1. every task composes those of its file split, for both ways it may begin;
2. the splits of a file, one row each, are put in order, which gives the state that
   each split begins in;
3. every task goes through its pieces again, now knowing where records end.

Pieces that are a whole record go on where they are; only records of several pieces
are grouped. No task reads a whole file, and no value is longer than a record.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from echolens.session import durable

# Quoted cells and others, to the end of the line; possessive, so that long lines need no stack.
_CELLS = r'(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|),)*+'
_OPEN_CELL = rf'^{_CELLS}"(?:[^"]++|"")*+$'
_REST_OF_CELL = r'^(?:[^"]++|"")*+'
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_OPEN_STRING = r'"(?:[^"\\]++|\\.)*+\\?$'
_REST_OF_STRING = r'^(?:[^"\\]++|\\.)*+'
# Up to this many file splits, their states are broadcast (tens of MB).
MAX_BROADCAST_SPLITS = 200_000
RECORD = "file string, file_no bigint, file_first bigint, record bigint, body string, ends boolean"
STEP = "file string, block bigint, end0 int, end1 int, depth0 bigint, depth1 bigint"


def _pieces(spark: SparkSession, paths: str | Sequence[str], ends_in: str) -> DataFrame:
    rows = spark.read.option("lineSep", ends_in).text(paths)
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def _csv_steps(pieces: DataFrame) -> DataFrame:
    """end0/end1: whether a line that begins outside/inside of a quoted cell ends inside of one."""
    rest = F.col("_rest")
    # what follows the closing quote belongs to the same cell up to the next comma
    after = F.regexp_replace(rest, r'^"[^,]*+,?', "")
    closes = F.startswith(rest, F.lit('"'))
    return pieces.withColumn("_rest", F.regexp_replace("value", _REST_OF_CELL, "")).select(
        *pieces.columns, F.rlike("value", F.lit(_OPEN_CELL)).cast("int").alias("end0"),
        F.when(closes, F.rlike(after, F.lit(_OPEN_CELL)).cast("int")).otherwise(1).alias("end1"),
        F.lit(0).cast("bigint").alias("depth0"), F.lit(0).cast("bigint").alias("depth1"),
    )


def _json_steps(pieces: DataFrame) -> DataFrame:
    """end0/end1: whether a piece that begins outside/inside of a string ends inside of one; change of depth.

    Each pattern runs once per piece: its result is a column, since several read it.
    """
    bare = lambda text: F.regexp_replace(text, _STRING, "")
    opened = lambda i: F.rlike(f"_bare{i}", F.lit(_OPEN_STRING))
    outer = lambda i: F.regexp_replace(f"_bare{i}", _OPEN_STRING, "")
    read = (
        pieces.withColumn("_rest", F.regexp_replace("value", _REST_OF_STRING, ""))
        .withColumns({"_bare0": bare(F.col("value")), "_bare1": bare(F.substr("_rest", F.lit(2)))})
        .withColumns({f"_opened{i}": opened(i) for i in (0, 1)} | {f"_outer{i}": outer(i) for i in (0, 1)})
    )

    def depth(i: int) -> Column:
        text = F.col(f"_outer{i}")
        size = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
        # the brace at the end of the piece closes unless it stands in a string
        return (size("{[") - size("]}") - F.when(F.col(f"_opened{i}"), 0).otherwise(1)).cast("bigint")

    closes = F.startswith("_rest", F.lit('"'))
    return read.select(
        *pieces.columns, F.col("_opened0").cast("int").alias("end0"),
        F.when(closes, F.col("_opened1").cast("int")).otherwise(1).alias("end1"), depth(0).alias("depth0"),
        F.when(closes, depth(1)).otherwise(0).cast("bigint").alias("depth1"),
    )


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One step per file split: those of its pieces in turn."""
    splits: dict[tuple, list] = {}
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("file", "block", "end0", "end1", "depth0", "depth1")]
        for file, block, *step in zip(*columns):
            now = splits.setdefault((file, block), [0, 1, 0, 0])
            for begin in (0, 1):
                at = now[begin]
                now[begin] = step[at]
                now[2 + begin] += step[2 + at]
    rows = [(*k, *v) for k, v in splits.items()]
    yield pa.RecordBatch.from_pydict(
        {c.split()[0]: pa.array([r[i] for r in rows], pa.string() if i == 0 else pa.int32() if i in (2, 3) else pa.int64())
         for i, c in enumerate(STEP.split(", "))}
    )


def _begins(splits: pd.DataFrame) -> pd.DataFrame:
    """State that each split of a file begins in."""
    splits = splits.sort_values("block")
    mode, depth, out = 0, 0, []
    for _, s in splits.iterrows():
        out.append((s["file"], s["block"], mode, depth))
        mode, depth = (s["end1"], depth + s["depth1"]) if mode else (s["end0"], depth + s["depth0"])
    return pd.DataFrame(out, columns=["file", "block", "mode", "depth"])


def _placed(level: int):
    """Each piece with its place in the split, the record it belongs to, and whether it starts or ends one.

    A record stands outside of quotes and begins and ends at depth ``level``. A line
    without anything between records is none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, list] = {}
        for batch in batches:
            place, number, starts, ends, blank = [], [], [], [], []
            names = ("file", "block", "mode", "depth", "value", "end0", "end1", "depth0", "depth1")
            for file, block, mode, depth, value, *step in zip(*(batch.column(c).to_pylist() for c in names)):
                now = states.setdefault((file, block), [mode, depth, 0, 0])
                start = now[0] == 0 and now[1] <= level
                nothing = start and level == 0 and value in ("", "\r")
                now[1] += step[2 + now[0]]
                now[0] = step[now[0]]
                end = now[0] == 0 and now[1] == level and not nothing
                place.append(now[2]), number.append(now[3]), starts.append(start), ends.append(end), blank.append(nothing)
                now[2] += 1
                now[3] += end
            flags = [pa.array(v, pa.bool_()) for v in (starts, ends, blank)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), batch.column("value"),
                 pa.array(place, pa.int64()), pa.array(number, pa.int64()), *flags],
                names=["file", "block", "value", "place", "number", "starts", "ends", "blank"],
            )

    return run


def _records(steps: DataFrame, glue: str, level: int) -> DataFrame:
    """(file, file_no, file_first, record, body, ends): records numbered from 0 in the order of files and places.

    ``file_first`` is the number of the file's first record. What a file ends with
    but does not finish has ``ends`` false.
    """
    if steps.isEmpty():
        return steps.sparkSession.createDataFrame([], RECORD)
    totals = durable(steps.drop("value").mapInArrow(_composed, STEP))
    begins = totals.groupBy("file").applyInPandas(_begins, "file string, block bigint, mode int, depth bigint")
    few = totals.count() <= MAX_BROADCAST_SPLITS
    if few:
        known = steps.join(F.broadcast(begins), ["file", "block"])
    else:
        known = steps.withColumn("_tick", F.monotonically_increasing_id()).join(begins, ["file", "block"])
        known = known.repartition("file", "block").sortWithinPartitions("file", "block", "_tick").drop("_tick")
    pieces = durable(
        known.mapInArrow(
            _placed(level), "file string, block bigint, value string, place bigint, number bigint, "
            "starts boolean, ends boolean, blank boolean",
        )
    )
    # these windows see a row per file split
    order = Window.orderBy("file", "block")
    counts = pieces.groupBy("file", "block").agg(F.count_if("ends").alias("n"))
    offsets = counts.select(
        "file", "block", F.dense_rank().over(Window.orderBy("file")).cast("bigint").alias("file_no"),
        F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
    ).withColumn("file_first", F.min("offset").over(Window.partitionBy("file")))
    numbered = pieces.filter("NOT blank").join(F.broadcast(offsets) if few else offsets, ["file", "block"]).select(
        "file", "file_no", "file_first", (F.col("offset") + F.col("number")).alias("record"),
        "block", "place", "value", "starts", "ends",
    )
    names = ["file", "file_no", "file_first", "record"]
    whole = numbered.filter("starts AND ends").select(*names, F.col("value").alias("body"), "ends")
    parts = numbered.filter("NOT (starts AND ends)").groupBy(*names).agg(
        F.sort_array(F.collect_list(F.struct("block", "place", "value"))).alias("parts"), F.bool_or("ends").alias("ends")
    )
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), glue)
    return whole.unionByName(parts.select(*names, joined.alias("body"), "ends"))


def read_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Rows of CSV files with a header, all columns as text, and their number ``_row`` from 0.

    Quoted cells may hold commas, doubled quotes and line breaks. Lines end in a line
    feed, with or without a carriage return before it. The names come from the
    header of the first file; each file has one. Empty lines are no rows; line breaks
    inside of cells stay as they are. Without a
    file with a header there are no columns: that is a ValueError.
    """
    records = _records(_csv_steps(_pieces(spark, paths, "\n")), "\n", 0).withColumn(
        "body", F.regexp_replace("body", r"\r\z", "")
    )
    first = records.filter("record = 0 AND file_first = 0").select("body").first()
    if first is None:
        raise ValueError("no header: the files are empty")
    names = next(csv.reader([first["body"].removeprefix("\ufeff")]))
    cells = F.from_csv(
        "body", ", ".join(f"c{i} string" for i in range(len(names))),
        {"quote": '"', "escape": '"', "multiLine": "true"},
    )
    rows = records.filter("record > file_first").select((F.col("record") - F.col("file_no")).alias("_row"), cells.alias("c"))
    return rows.select(*[F.col(f"c.c{i}").alias(name) for i, name in enumerate(names)], "_row")


def read_json_objects(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(number, body): the objects in the JSON arrays that the files hold, one array each, as text.

    Elements that are no objects are left out, and so is one that a file breaks off.
    """
    records = _records(_json_steps(_pieces(spark, paths, "}")), "}", 1).filter("ends")
    body = F.concat(F.regexp_replace("body", r"^[^{]*+", ""), F.lit("}"))
    return records.select(F.col("record").alias("number"), body.alias("body"))
