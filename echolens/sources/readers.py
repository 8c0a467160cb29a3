"""Readers: order mirror, nested comments, logs, word lists, prior runs."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from echolens import constants as C
from echolens import schema as S
from echolens.functions.text import blank_to, stopwords_without_negations, strip
from echolens.sources import split as split_files

VIDEO_COLUMNS = ("url_or_id", "id_konten")
# Up to this many file splits, their offsets are broadcast (tens of MB).
MAX_BROADCAST_SPLITS = 200_000
CREATOR_COLUMNS = ("nama_pengguna_kreator", "creator_username")


def number_rows(df: DataFrame, name: str) -> DataFrame:
    """Number file rows 0, 1, 2, ... in (file, position) order, without a sort.

    ``monotonically_increasing_id`` counts rows inside a task in read order, so
    a row's place in its file split is its counter minus the split's smallest
    counter. Only the per-split counts are accumulated globally.
    """
    spot = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_tick"),
    )
    splits = spot.groupBy("_file", "_block").agg(
        F.min("_tick").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    # every task reads at most one full split beside the ends of files
    if df.rdd.getNumPartitions() + len(df.inputFiles()) <= MAX_BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    place = F.col("_offset") + F.col("_tick") - F.col("_first")
    return spot.join(offsets.drop("_rows"), ["_file", "_block"]).select(
        *df.columns, place.alias(name)
    )


def read_mirror(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True, split: bool = False
) -> DataFrame:
    """Order mirror CSV -> (line, value, account_type, creator_username).

    Lines count from 2 as in the file with its header. ``multi_line`` allows
    line breaks inside quoted cells, at the price of one task per file; switch
    it off for large files without such cells and they are split. ``split`` reads
    large files with such cells in many tasks.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    if split:
        raw = split_files.read_csv(spark, paths)
    else:
        raw = (
            spark.read.option("header", True)
            .option("multiLine", multi_line)
            .option("quote", '"')
            .option("escape", '"')
            .csv(paths)
        )
    video = next((c for c in VIDEO_COLUMNS if c in raw.columns), None)
    if video is None:
        raise ValueError(
            f"no video column: expected one of {VIDEO_COLUMNS}, found {raw.columns}"
        )
    creator = next((c for c in CREATOR_COLUMNS if c in raw.columns), None)
    has_type = "account_type" in raw.columns
    numbered = raw if split else number_rows(raw, "_row")
    return numbered.select(
        (F.col("_row") + 2).alias("line"),
        strip(F.coalesce(F.col(video), F.lit(""))).alias("value"),
        (
            blank_to(F.col("account_type"), C.DEFAULT_ACCOUNT_TYPE)
            if has_type
            else F.lit(C.DEFAULT_ACCOUNT_TYPE)
        ).alias("account_type"),
        (blank_to(F.col(creator), "") if creator else F.lit("")).alias("creator_username"),
    )


def read_video_text(
    spark: SparkSession, paths: str | Sequence[str], lines: bool = False
) -> DataFrame:
    """One row per video with its JSON text and position, for validation.

    A month file is one JSON array; ``lines`` reads JSON lines instead, which
    split and are preferred for large inputs. Arrays that need not be checked for
    anything but their objects come in many tasks from ``split.read_json_objects``.
    """
    if lines:
        rows = number_rows(spark.read.text(paths), "video_no")
        return rows.filter(strip("value") != "").withColumnRenamed("value", "body")
    files = number_rows(spark.read.option("wholetext", True).text(paths), "file_no")
    # try_parse_json keeps the difference between a missing key and a null
    whole = files.withColumn("doc", F.try_parse_json("value"))
    items = whole.select(
        "file_no", F.posexplode_outer(F.expr("try_variant_get(doc, '$', 'array<variant>')"))
    )
    return items.select(
        (F.col("file_no") * (1 << 31) + F.coalesce("pos", F.lit(0))).alias("video_no"),
        F.to_json("col").alias("body"),
    )


def file_layouts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, opening): the first character of each file that is not blank.

    ``[`` opens a JSON array, ``{`` JSON lines.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("tick"),
        ).alias("place"),
        F.substring(strip("value"), 1, 1).alias("opening"),
    )
    return lines.filter("opening <> ''").groupBy("file").agg(
        F.min_by("opening", "place").alias("opening")
    )


def read_videos(
    spark: SparkSession, paths: str | Sequence[str], lines: bool | None = None, split: bool = False
) -> DataFrame:
    """Nested videos with the explicit schema and a position column.

    ``lines`` says whether the files are JSON lines or one JSON array each;
    by default they are looked at, and a mixture of both is an error. ``split``
    reads large arrays in many tasks; then an array holds objects only.
    """
    if split:
        objects = split_files.read_json_objects(spark, paths)
        video = F.from_json("body", S.VIDEO).alias("v")
        return objects.select(video, F.col("number").alias("video_no")).select("v.*", "video_no")
    if lines is None:
        found = {r["opening"] for r in file_layouts(spark, paths).select("opening").distinct().collect()}
        if len(found & {"[", "{"}) > 1:
            raise ValueError("JSON arrays and JSON lines together: read them one by one")
        lines = "{" in found
    reader = spark.read.schema(S.VIDEO).option("multiLine", not lines)
    return number_rows(reader.json(paths), "video_no")


def read_done_log(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Collector log (JSON lines) -> (last record per video, dropped lines).

    A line is dropped when it is not a JSON object, has no id, or its comments
    are not a list - what a run killed while appending leaves behind.
    """
    lines = number_rows(spark.read.text(paths), "line").filter(strip(F.col("value")) != "")
    entry = F.from_json("value", S.VIDEO)
    is_object = F.json_object_keys("value").isNotNull()
    has_id = F.length(F.coalesce(F.get_json_object("value", "$.aweme_id"), F.lit(""))) > 0
    has_list = F.json_array_length(F.get_json_object("value", "$.comments")).isNotNull()
    checked = lines.withColumn("usable", is_object & has_id & has_list)
    good = checked.filter("usable").select("line", entry.alias("entry")).select("line", "entry.*")
    return last_wins(good, ["aweme_id"], "line"), checked.filter(~F.col("usable")).drop("usable")


def read_analyze_log(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Analysis log: last usable record per comment."""
    lines = number_rows(spark.read.text(paths), "line").filter(strip(F.col("value")) != "")
    rows = lines.select("line", F.from_json("value", S.LOG_SCHEMA).alias("e")).select("line", "e.*")
    return last_wins(rows.filter(F.col("comment_id") != ""), ["comment_id"], "line").drop("line")


def last_wins(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row per key; combines before the shuffle, so hot keys are cheap."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.col(order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*[*keys, "_row.*"]).select(*df.columns)


def read_prior_runs(
    spark: SparkSession, patterns: Sequence[str]
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Video ids of earlier month files -> (ids, new ids per file, warnings).

    Files hold a JSON array or JSON lines. A pattern without files and a file
    without a readable record are warnings, one each, not errors. A file is
    credited only with ids that no earlier file had.
    """
    found, warnings = None, []
    for number, pattern in enumerate(patterns):
        try:
            layouts = file_layouts(spark, pattern).orderBy("file").collect()
        except AnalysisException:
            warnings.append(f"{pattern!r} matched no files")
            continue
        unreadable = [r["file"] for r in layouts if r["opening"] not in ("[", "{")]
        for opening in ("[", "{"):
            files = [unquote(r["file"]) for r in layouts if r["opening"] == opening]
            if not files:
                continue
            part = (
                spark.read.schema("aweme_id string, _corrupt string")
                .option("columnNameOfCorruptRecord", "_corrupt")
                .option("multiLine", opening == "[").json(files)
            ).select(
                "aweme_id", "_corrupt", F.lit(number).alias("pattern_no"),
                F.col("_metadata.file_path").alias("file"),
            )
            good = F.count_if(F.col("_corrupt").isNull() | F.col("aweme_id").isNotNull())
            broken = part.groupBy("file").agg(good.alias("good")).filter("good = 0")
            unreadable += [r["file"] for r in broken.collect()]
            part = part.drop("_corrupt")
            found = part if found is None else found.unionByName(part)
        warnings += [f"{unquote(name)!r} holds no JSON records" for name in sorted(unreadable)]
    if found is None:
        found = spark.createDataFrame([], "aweme_id string, pattern_no int, file string")
    return (*new_ids_per_source(found, "aweme_id", ["pattern_no", "file"]), warnings)


def new_ids_per_source(
    df: DataFrame, key: str, order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Distinct ids, and how many of them each source was first to bring."""
    usable = df.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    first = usable.groupBy(key).agg(F.min(F.struct(*order)).alias("source"))
    sources = df.select(*order).distinct()
    counts = first.groupBy(*[F.col(f"source.{c}").alias(c) for c in order]).agg(
        F.count(F.lit(1)).alias("new_ids")
    )
    per_source = sources.join(counts, list(order), "left").select(
        *order, F.coalesce("new_ids", F.lit(0)).alias("new_ids")
    )
    return first.select(key), per_source


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line; blanks dropped, repeats merged."""
    return word_list(spark.read.text(path), "value")


def word_list(df: DataFrame, column: str) -> DataFrame:
    return df.select(strip(F.col(column)).alias("word")).filter("word <> ''").distinct()


def negation_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in C.NEGATIONS], "word string")


def stopword_table(words: DataFrame) -> DataFrame:
    """A word list minus the negations, which are never stopwords."""
    return words.select("word").subtract(negation_words(words.sparkSession))


def listed_negations(words: DataFrame) -> DataFrame:
    """Negations a list names by mistake; reported as a warning."""
    return words.select("word").intersect(negation_words(words.sparkSession))


def default_stopwords() -> list[str]:
    return stopwords_without_negations(None)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``word,score`` CSV without header."""
    raw = spark.read.schema("word string, score string").csv(path)
    return lexicon_table(number_rows(raw, "line"))


def lexicon_table(raw: DataFrame) -> DataFrame:
    """Usable rows of a raw lexicon: named words, numeric scores, last row wins."""
    rows = raw.select(
        "line",
        strip(F.col("word")).alias("word"),
        strip(F.col("score")).try_cast("double").alias("score"),
    ).filter("word <> '' AND score IS NOT NULL")
    return last_wins(rows, ["word"], "line").drop("line")


def account_types(videos: DataFrame, order: str = "video_no") -> DataFrame:
    """video_id -> account_type dimension; later entries win, blanks are unknown."""
    rows = videos.filter(F.coalesce(F.col("aweme_id"), F.lit("")) != "").select(
        F.col("aweme_id").alias("video_id"),
        F.coalesce(F.nullif("account_type", F.lit("")), F.lit(C.DEFAULT_ACCOUNT_TYPE)).alias(
            "account_type"
        ),
        F.col(order).alias("_order"),
    )
    return last_wins(rows, ["video_id"], "_order").drop("_order")


def empty_account_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "video_id string, account_type string")


def labeled_sample(df: DataFrame) -> DataFrame:
    """Human labels: id, text, label (trimmed, lower case), notes."""
    return df.select(
        F.regexp_replace("comment_id", "^'+", "").alias("comment_id"),
        F.coalesce("comment", F.lit("")).alias("comment"),
        F.lower(strip(F.col("label"))).alias("label"),
        F.coalesce("notes", F.lit("")).alias("notes"),
    )


def read_labeled_sample(spark: SparkSession, path: str) -> DataFrame:
    raw = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    )
    if "label" not in raw.columns:
        raw = raw.withColumnRenamed("sentiment_label", "label")
    for name in ("comment", "notes"):
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit(""))
    return labeled_sample(raw)
