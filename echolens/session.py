"""Session settings and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a job should run with; cluster sizing (executors, memory) is left to
# the submitter. Shuffle partitions start high and AQE merges small ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join side whose partitions all turn out this small is hashed, not sorted
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", name: str = "echolens") -> SparkSession:
    """One-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage, as the cluster names it.

    Only a local session may fall back to a temporary folder: on a cluster an
    executor could not read another machine's disk.
    """
    context = spark.sparkContext
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
    )
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="echolens-checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder beside the checkpoints, visible to every executor."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# The shuffle files of a statement go when it ends, not when the driver collects garbage. For
# writes, and streams that start with it: a frame that is run twice would shuffle again.
RELEASED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def held_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """``settings`` within, and those of before afterwards."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out by ``keys``, whatever the size of the input.

    A single small file is one task, however costly the work per row. The number
    of tasks is that of the session's shuffles; adaptive execution would merge
    them by bytes, which say little about the work on a text.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *keys)


def durable(df: DataFrame) -> DataFrame:
    """Write an intermediate that several outputs read, and read it back.

    Cuts the lineage like a reliable checkpoint, and the readers still get
    column pruning and file statistics. Survives lost executors; without it
    every reader would repeat the work behind the table.
    """
    path = workspace(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
