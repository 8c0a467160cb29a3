"""A log of batches: appended, read as one table, and compacted.

``path`` holds a folder per batch (``batch_id=7``). A compaction folds the batches
up to a number into one table, ``_compacted/upto=7``, which counts from the moment
its job commits; folders that it replaces stay for one more compaction, so readers
that began before it finish. What is read is one compacted table and the batches
after it, however many batches there were.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Bytes that a task of a compaction reads, and of its file, at most about.
FILE_BYTES = 64 << 20
# Batches that may follow a compacted table, in units of the compaction interval.
TAIL = 32
# How logs with texts are written, and what a byte of theirs weighs; others are as the session says.
WRITING, PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6"}, 4
# Where a row is stored, and the texts of a row side by side.
FILE, PLACE, TEXTS = "_file", "_place", "_texts"


def _joined(words: Column) -> Column:
    """Words between blanks; null if they could not be told apart again."""
    text = F.array_join(words, " ")
    return F.when(F.split(text, " ") == words, text)


class BatchLog:
    """Rows of batches; per key the row with the largest ``order`` counts, of equal ones the later batch's.

    Keys are matched as they are, a null key is a key. Rows of one batch must differ
    in ``key``. Appending a batch again replaces it.

    ``texts`` names columns (strings, or arrays of words) that say much the same. They are
    stored one after the other in one column, where each is packed by the one before it;
    readers get the columns as they were, and logs written without it stay readable.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str, order: Sequence[str] = (), texts: Sequence[str] = ()
    ):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, list(order)
        self.texts, self.writing = list(texts), WRITING if texts else {}

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        """Numbers of the folders ``<prefix>=<number>``, committed ones only where a marker is written."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{prefix}="))

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

    def batches(self) -> list[int]:
        return self._numbers(self.path, "batch_id")

    def compactions(self) -> list[int]:
        """Numbers up to which compacted tables reach; an unfinished one does not count."""
        folder = f"{self.path}/_compacted"
        done = []
        for upto in self._numbers(folder, "upto"):
            marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/upto={upto}/_SUCCESS")
            if marker.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(marker):
                done.append(upto)
        return done

    def _packed(self, rows: DataFrame) -> DataFrame:
        """Rows as they are stored; what cannot be packed stays in its own column."""
        if not self.texts:
            return rows
        kinds = dict(rows.dtypes)
        side = {c: F.col(c) if kinds[c] == "string" else _joined(F.col(c)) for c in self.texts}
        own = {c: F.when(packed.isNull(), F.col(c)) for c, packed in side.items()}
        return rows.withColumns({TEXTS: F.array(*side.values()), **own})

    def _unpacked(self, rows: DataFrame) -> DataFrame:
        kinds, texts = dict(rows.dtypes), {}
        for i, c in enumerate(self.texts):
            text = F.get(TEXTS, F.lit(i))
            texts[c] = F.coalesce(c, text if kinds[c] == "string" else F.split(text, " "))
        return rows.withColumns(texts).drop(FILE, PLACE, TEXTS)

    def append(self, rows: DataFrame, batch_id: int) -> None:
        (
            self._packed(rows).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**self.writing)
            .partitionBy("batch_id").parquet(self.path)
        )

    def _read(self, folder: str) -> DataFrame:
        found = self.spark.read.parquet(folder)
        if self.texts and TEXTS not in found.columns:
            # the schema is that of one file, and others may have been written later
            found = self.spark.read.schema(found.schema.add(TEXTS, "array<string>")).parquet(folder)
        return found.select(
            "*", F.col("_metadata.file_name").alias(FILE), F.col("_metadata.row_index").alias(PLACE)
        )

    def _stored(self, upto: int | None = None) -> DataFrame | None:
        """Rows that may count, as they are stored and where; None while nothing was written."""
        base = max((n for n in self.compactions() if upto is None or n <= upto), default=None)
        found = None
        if base is not None:
            found = self._read(f"{self.path}/_compacted/upto={base}")
        try:
            log = self._read(self.path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
        except AnalysisException as error:
            # no batch yet; any other error must not pass for an empty log
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return found
        if base is not None:
            log = log.filter(F.col("batch_id") > base)
        if upto is not None:
            log = log.filter(F.col("batch_id") <= upto)
        return log if found is None else found.unionByName(log, allowMissingColumns=True)

    def rows(self, upto: int | None = None) -> DataFrame | None:
        """Rows that may count, with their batch_id; None while nothing was written."""
        stored = self._stored(upto)
        return None if stored is None else self._unpacked(stored)

    def _tail(self, upto: int) -> tuple[int | None, list[int]]:
        """The compacted table that counts, and the batches after it."""
        base = max((n for n in self.compactions() if n <= upto), default=None)
        return base, [n for n in self.batches() if (base is None or n > base) and n <= upto]

    def _bytes(self, folders: Sequence[str]) -> int:
        size = 0
        for folder in folders:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
            files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
            size += files.getContentSummary(path).getLength()
        return size

    def _counting(self, stored: DataFrame) -> DataFrame:
        """Stored rows without those that a later one replaces.

        Only keys and places are shuffled. What is replaced comes back as one bit per row,
        64 rows to a word, which is broadcast: some two bytes per row of the log at most.
        """
        order = [*self.order, "batch_id", FILE, PLACE]
        rank = F.row_number().over(Window.partitionBy(self.key).orderBy(*[F.desc(c) for c in order]))
        places = stored.select(*dict.fromkeys([self.key, *order])).withColumn("_rank", rank)
        word, bit = F.floor(F.col(PLACE) / 64), (F.col(PLACE) % 64).cast("int")
        replaced = places.filter("_rank > 1").groupBy(FILE, word.alias("_word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("_bits")
        )
        marked = stored.withColumn("_word", word).join(F.broadcast(replaced), [FILE, "_word"], "left")
        return marked.filter(F.coalesce(F.getbit("_bits", bit), F.lit(0)) == 0).select(*stored.columns)

    def current(self, upto: int | None = None) -> DataFrame | None:
        """The row of each key that counts, with its batch_id."""
        stored = self._stored(upto)
        return None if stored is None else self._unpacked(self._counting(stored))

    def compact(self, upto: int) -> None:
        """Fold the batches up to ``upto`` into one table.

        Tasks and files are sized by bytes, so their number does not depend on the number
        of batches, and rows are copied where they are read, without a shuffle. Folders that
        the previous compaction replaced are deleted first.
        """
        before = [n for n in self.compactions() if n < upto]
        if before:
            for n in self.batches():
                if n <= before[-1]:
                    self._delete(f"{self.path}/batch_id={n}")
            for n in before[:-1]:
                self._delete(f"{self.path}/_compacted/upto={n}")
        stored = self._stored(upto)
        if stored is None:
            return
        base, tail = self._tail(upto)
        size = self._bytes([f"_compacted/upto={base}"] * (base is not None) + [f"batch_id={n}" for n in tail])
        parts = 1 + size * (PACKED if self.texts else 1) // FILE_BYTES
        # a file that is read in one piece may hold the rows of several
        most = 2 * (1 + stored.count() // parts)
        (
            self._counting(stored).drop(FILE, PLACE).coalesce(parts)
            .write.mode("overwrite").option("maxRecordsPerFile", most).options(**self.writing)
            .parquet(f"{self.path}/_compacted/upto={upto}")
        )

    def maybe_compact(self, batch_id: int, every: int | None) -> None:
        """After each ``every`` batches, if those since the last compaction weigh about as much as its table.

        So a byte that is appended costs some two bytes written again, however many
        batches there are. ``TAIL`` intervals without a compaction are folded anyway,
        which bounds the number of folders.
        """
        if not every or (batch_id + 1) % every:
            return
        base, tail = self._tail(batch_id)
        if base is not None and len(tail) < TAIL * every:
            # the same rows weigh somewhat more or less in other files
            if 16 * self._bytes([f"batch_id={n}" for n in tail]) < 15 * self._bytes([f"_compacted/upto={base}"]):
                return
        self.compact(batch_id)
