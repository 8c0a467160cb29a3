"""Tiles of whole-number vectors, and the meeting of a query set with all rows in blocks.

Components become floor(256 * x). Rows are dealt into tiles of a bounded number
of components, so that a task holds one tile of each side at a time. Every query
tile meets every candidate tile of the same vector length once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolens.llm.common import bounded, durable

SCALE = 256
# Components of a tile: 2 MB as 64-bit numbers, whatever the length of the vectors.
TILE_COMPONENTS = 1 << 18
LONG = (-(1 << 63), (1 << 63) - 1)
PACKED = "d int, tile int, n int, ids binary, marks binary, labels binary, parts binary"


def whole_vectors(vectors: DataFrame, *more: str) -> DataFrame:
    """vec_id, ``more``, mark and parts of the rows that take part, written once.

    ``mark`` tells rows apart, also those that share a vec_id; ``parts`` are the
    whole-number components, limited to the range of long. Left out are rows
    without vec_id, null vectors and vectors with a null or non-finite component.
    """
    bounded(vectors.sparkSession)
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), *[F.col(c).cast("bigint").alias(c) for c in more],
        F.col("embedding").cast("array<double>").alias("v"),
    )
    for name in ("vec_id", "v", *more):
        rows = rows.filter(F.col(name).isNotNull())
    return durable(
        rows.filter(finite).select(
            "vec_id", *more, F.monotonically_increasing_id().alias("mark"),
            F.transform("v", lambda x: F.floor(x * SCALE).cast("bigint")).alias("parts"),
        )
    )


def tile_rows(rows: DataFrame) -> tuple[int, int]:
    """Number of rows, and rows per tile by the longest vector."""
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("parts")).alias("d")).first()
    return seen["n"], max(32, TILE_COMPONENTS // max(1, seen["d"] or 1))


def dealt(rows: DataFrame, count: int) -> DataFrame:
    """With the length ``d`` and one of ``count`` tiles."""
    return rows.withColumns({"d": F.size("parts"), "tile": F.pmod(F.xxhash64("mark"), F.lit(count)).cast("int")})


def matrix(frame: pd.DataFrame) -> np.ndarray:
    """One row per vector, int64."""
    return np.array(frame["parts"].to_list(), np.int64).reshape(len(frame), -1)


def pack(frame: pd.DataFrame) -> pd.DataFrame:
    """One record for a tile, of format PACKED, the components row by row."""
    longs = lambda c: frame[c].to_numpy(np.int64).tobytes() if c in frame else b""
    return pd.DataFrame(
        {
            "d": [frame["d"].iat[0]], "tile": [frame["tile"].iat[0]], "n": [len(frame)], "ids": [longs("vec_id")],
            "marks": [longs("mark")], "labels": [longs("label")], "parts": [matrix(frame).tobytes()],
        }
    )


def packed(rows: DataFrame, count: int) -> DataFrame:
    """One record per tile, written once."""
    return durable(dealt(rows, count).groupBy("d", "tile").applyInPandas(pack, PACKED))


def longs(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.int64)


def fits(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    """Whether every sum of products of rows of ``a`` and columns of ``b`` stays below ``limit``."""
    most = lambda x: max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    return most(a) * most(b) * max(1, a.shape[-1]) < limit


def to_long(score) -> int:
    """An exact score as long; beyond its range the nearest long."""
    return min(max(int(score), LONG[0]), LONG[1])


def meet(
    queries: DataFrame, candidates: DataFrame, query_tiles: int, candidate_tiles: int,
    fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str,
) -> DataFrame:
    """``fn`` of every query tile and every candidate tile of the same length.

    Both are tables of one record per tile (columns d and tile). A record travels
    once for each tile of the other side.
    """
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumnRenamed("tile", "q").withColumn("c", every(candidate_tiles))
    right = candidates.withColumnRenamed("tile", "c").withColumn("q", every(query_tiles))
    keys = ("d", "c", "q")
    empty = fn(None, None)

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return fn(a.iloc[0], b.iloc[0]) if len(a) and len(b) else empty

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, schema)
