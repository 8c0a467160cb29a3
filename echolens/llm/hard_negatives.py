"""Hard negatives by Strassen multiplication of whole-number tiles.

The scores of an anchor tile and a candidate tile are one matrix product of int64
numbers, computed by Strassen's recursion: odd sides are padded with zeros, seven
products of halves replace eight, and small matrices are multiplied plainly. All
additions are of whole numbers, so they are exact: int64 wraps around without loss
as long as the final score fits, which is checked; tiles with larger numbers use
Python numbers.

Two passes over the tiles keep bounded heaps. The first holds, per anchor, the best
rows of its label: its positives. The second holds, per anchor and positive, the
best rows of other labels whose score lies in the window of the positive. Heaps of
different tiles merge by taking the best of all their rows, in Spark.

Results in edge cases: rows without ``vec_id`` or label, null vectors and vectors with
a null or non-finite component take no part; vectors of different lengths are not
compared; of rows that repeat a ``vec_id`` each is a row of its own; equal scores go by
the smaller ``vec_id``, then by row; a positive with a score below 0 has an empty window;
components and scores beyond the range of long are limited to it; an empty table, or
one without anchors or positives, gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolens.llm import tiles
from echolens.llm.common import durable

POSITIVES, NEGATIVES = 5, 10
# Window of a negative score, in hundredths of the positive score.
LOW, HIGH = 30, 90
LEAF = 32
POSITIVE = "anchor_mark bigint, anchor_id bigint, positive_mark bigint, positive_id bigint, positive_score bigint"
NEGATIVE = (
    "anchor_mark bigint, anchor_id bigint, positive_mark bigint, positive_id bigint, "
    "negative_mark bigint, negative_id bigint, positive_score bigint, negative_score bigint"
)


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b by seven half-size products, down to sides of ``leaf``."""
    m, d, n = *a.shape, b.shape[1]
    if min(m, d, n) <= leaf:
        return a @ b
    h, k, w = (m + 1) // 2, (d + 1) // 2, (n + 1) // 2
    if (m, d, n) != (2 * h, 2 * k, 2 * w):
        a = np.pad(a, ((0, 2 * h - m), (0, 2 * k - d)))
        b = np.pad(b, ((0, 2 * k - d), (0, 2 * w - n)))
    a11, a12, a21, a22 = a[:h, :k], a[:h, k:], a[h:, :k], a[h:, k:]
    b11, b12, b21, b22 = b[:k, :w], b[:k, w:], b[k:, :w], b[k:, w:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * h, 2 * w), a.dtype)
    out[:h, :w] = p1 + p4 - p5 + p7
    out[:h, w:] = p3 + p5
    out[h:, :w] = p2 + p4
    out[h:, w:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact scores (anchors x candidates) of two int64 matrices of vectors."""
    exact = tiles.fits(anchors, candidates, 1 << 63)
    kind = np.int64 if exact else object
    found = strassen(anchors.astype(kind), np.ascontiguousarray(candidates.T).astype(kind))
    return found if exact else np.vectorize(tiles.to_long, otypes=[np.int64])(found).reshape(found.shape)


def heap_of(at: np.ndarray, score: np.ndarray, ids: np.ndarray, marks: np.ndarray, k: int) -> list[int]:
    """The ``k`` places of ``at`` with the best score, best first."""
    if len(at) > 4 * k:
        # ties of the k-th best score go on to the heap
        at = at[score[at] >= np.partition(score[at], -k)[-k]]
    return heapq.nsmallest(k, at.tolist(), key=lambda j: (-int(score[j]), ids[j], marks[j]))


class _Tile:
    """A packed record, unpacked."""

    def __init__(self, record: pd.Series):
        self.parts = tiles.longs(record["parts"]).reshape(int(record["n"]), int(record["d"]))
        self.ids, self.marks, self.labels = (tiles.longs(record[c]) for c in ("ids", "marks", "labels"))


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def _positives(k: int):
    def run(left: pd.Series | None, right: pd.Series | None) -> pd.DataFrame:
        rows = []
        if left is not None:
            a, c = _Tile(left), _Tile(right)
            found = scores(a.parts, c.parts)
            for i, score in enumerate(found):
                same = np.flatnonzero((c.labels == a.labels[i]) & (c.marks != a.marks[i]))
                for j in heap_of(same, score, c.ids, c.marks, k):
                    rows.append((a.marks[i], a.ids[i], c.marks[j], c.ids[j], score[j]))
        return _frame(rows, POSITIVE)

    return run


def _negatives(k: int, low: int, high: int):
    def run(left: pd.Series | None, right: pd.Series | None) -> pd.DataFrame:
        rows = []
        if left is not None:
            a, c = _Tile(left), _Tile(right)
            found = scores(a.parts, c.parts)
            for i, (score, heap) in enumerate(zip(found, left["heaps"])):
                other = c.labels != a.labels[i]
                for positive in heap:
                    p = int(positive["positive_score"])
                    # 100 * score between low * p and high * p, without overflow
                    least, most = -(-low * p // 100), high * p // 100
                    if least > most:
                        continue
                    fit = np.flatnonzero(other & (score >= least) & (score <= most))
                    for j in heap_of(fit, score, c.ids, c.marks, k):
                        rows.append(
                            (a.marks[i], a.ids[i], positive["positive_mark"], positive["positive_id"],
                             c.marks[j], c.ids[j], p, score[j])
                        )
        return _frame(rows, NEGATIVE)

    return run


def _anchors(frame: pd.DataFrame) -> pd.DataFrame:
    return tiles.pack(frame).assign(heaps=[frame["heap"].to_list()])


def _merged(found: DataFrame, keys: list[str], score: str, row: str, k: int) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(F.desc(f"{row}_score"), f"{row}_id", f"{row}_mark")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding and label; ``is_anchor`` is a condition on vec_id.
    """
    rows = tiles.whole_vectors(vectors, "label")
    count, size = tiles.tile_rows(rows)
    anchors = rows.filter(is_anchor)
    anchor_tiles, tile_count = -(-max(1, anchors.count()) // size), -(-max(1, count) // size)
    candidates = tiles.packed(rows, tile_count)
    first = tiles.meet(
        tiles.packed(anchors, anchor_tiles), candidates, anchor_tiles, tile_count, _positives(positives), POSITIVE
    )
    best = _merged(first, ["anchor_mark"], "positive_score", "positive", positives)
    # at most ``positives`` rows each
    heaps = best.groupBy(F.col("anchor_mark").alias("mark")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_mark", "positive_id", "positive_score"))).alias("heap")
    )
    with_heaps = durable(
        tiles.dealt(anchors.join(heaps, "mark"), anchor_tiles).groupBy("d", "tile").applyInPandas(
            _anchors,
            f"{tiles.PACKED}, heaps array<array<struct<rank:int,positive_mark:bigint,positive_id:bigint,positive_score:bigint>>>",
        )
    )
    second = tiles.meet(with_heaps, candidates, anchor_tiles, tile_count, _negatives(negatives, low, high), NEGATIVE)
    return _merged(second, ["anchor_mark", "positive_mark"], "negative_score", "negative", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
