"""Writers: month dataset, analysis sections, samples, answer key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolens import schema as S
from echolens.functions.text import safe_cell


def write_nested_month(videos: DataFrame, path: str) -> None:
    """One record per video, partitioned by month; a rerun replaces its month."""
    (
        videos.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .json(path)
    )


def spreadsheet_safe(df: DataFrame) -> DataFrame:
    """Formula-safe text columns; other types untouched."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    return df.select(
        *[safe_cell(F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns]
    )


def month_lines(flat: DataFrame) -> DataFrame:
    """The 14 fixed columns of the month file; ids stay text."""
    return spreadsheet_safe(flat.select(*S.MONTH_COLUMNS))


def write_month_csv(flat: DataFrame, path: str) -> None:
    """Flat month file. Spark writes no byte-order mark."""
    (
        spreadsheet_safe(flat.select(*S.MONTH_COLUMNS, "month"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .csv(path)
    )


def write_analysis(sections: Mapping[str, DataFrame], path: str, run_id: str) -> None:
    """One parquet table per section, keyed by run; a rerun replaces its run."""
    for name, df in sections.items():
        (
            df.withColumn("run_id", F.lit(run_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id")
            .parquet(f"{path}/{name}")
        )


def write_sample(sample: DataFrame, manifest: DataFrame, path: str) -> None:
    """Sample list as CSV plus its one-row manifest as JSON."""
    rows = sample.orderBy("position").select(
        F.col("video_id").alias("url_or_id"), "account_type", "creator_username"
    )
    spreadsheet_safe(rows).write.mode("overwrite").option("header", True).option(
        "quoteAll", True
    ).option("escape", '"').csv(f"{path}/sample")
    manifest.write.mode("overwrite").json(f"{path}/manifest")


def answer_key(labels: DataFrame) -> DataFrame:
    """Only id, label and notes: no text, no user."""
    return labels.select("comment_id", F.col("label").alias("sentiment_label"), "notes")


def write_answer_key(labels: DataFrame, path: str) -> None:
    answer_key(labels).write.mode("overwrite").option("header", True).csv(path)
