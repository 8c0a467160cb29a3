"""Exact search for the highest inner products, by branch and bound over columns.

Candidates lie in tiles with a vertical layout: dimensions are ordered by their
mass in the tile and cut into blocks, and each block is one slab (dimensions x
candidates). A query adds up its scores slab by slab. The part of a score that is
still open is at most the product of the two remaining masses (the lengths of the
vectors over the dimensions to come), so each candidate has a lower and an upper
bound; those whose upper bound is below the k-th best lower bound are removed
and the rest is compacted before the next slab. What is left after the last slab
has its exact score. The k best of each tile are merged per query.

Sums of products below 2**53 are exact as doubles; larger ones are added up as
Python numbers without bounds. Every candidate takes part, so the result is exact.

Results in edge cases: rows without ``vec_id``, null vectors and vectors with a null
or non-finite component take no part; vectors of different lengths are not compared;
empty vectors score 0; of rows that repeat a ``vec_id`` each is a row of its own (a
query does not meet its own row but does meet the others); equal scores go by the
smaller ``vec_id``; components and scores beyond the range of long are limited to it;
an empty table or an empty query set gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolens.llm import tiles
from echolens.llm.common import durable

TOP = 5
BLOCK = 8
# A tile is compacted when at least this share of its live candidates is ruled out.
COMPACT = 0.125
VERTICAL = "d int, tile int, n int, ids binary, marks binary, dims binary, slabs array<binary>, masses array<binary>"
FOUND = "query_mark bigint, query_id bigint, vec_id bigint, score bigint"


def vertical(frame: pd.DataFrame) -> pd.DataFrame:
    """The vertical layout of a tile: slabs of dimensions and the masses that remain before each."""
    parts = tiles.matrix(frame)
    squares = parts.astype(np.float64) ** 2
    order = np.argsort(-squares.sum(0), kind="stable")
    parts, squares = parts[:, order].T, squares[:, order].T
    starts = range(0, len(order), BLOCK)
    return pd.DataFrame(
        {
            "d": [frame["d"].iat[0]], "tile": [frame["tile"].iat[0]], "n": [len(frame)],
            "ids": [frame["vec_id"].to_numpy(np.int64).tobytes()],
            "marks": [frame["mark"].to_numpy(np.int64).tobytes()], "dims": [order.astype(np.int64).tobytes()],
            "slabs": [[np.ascontiguousarray(parts[s : s + BLOCK]).tobytes() for s in starts]],
            "masses": [[np.sqrt(squares[s:].sum(0)).tobytes() for s in starts]],
        }
    )


def best(query: np.ndarray, slabs: list[np.ndarray], masses: list[np.ndarray], live: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of candidates among which the ``k`` best of ``live`` are, with all ties."""
    squares = query * query
    rest = [float(np.sqrt(squares[i * BLOCK :].sum())) for i in range(len(slabs) + 1)]
    sums = np.zeros(len(live))
    floor = -np.inf
    whole = len(live) == slabs[0].shape[1] if slabs else True
    for i, slab in enumerate(slabs):
        sums += query[i * BLOCK : i * BLOCK + BLOCK] @ (slab if whole else slab[:, live])
        if i + 1 == len(slabs):
            break
        # the bounds are rounded outwards
        reach = rest[i + 1] * masses[i + 1][live] * (1 + 1e-9) + 1e-6
        if len(live) > k:
            floor = max(floor, np.partition(sums - reach, -k)[-k])
        keep = sums + reach >= floor
        if keep.sum() <= (1 - COMPACT) * len(live):
            live, sums, whole = live[keep], sums[keep], False
    return live, sums


def _searched(k: int):
    def run(left: pd.Series | None, right: pd.Series | None) -> pd.DataFrame:
        out: dict[str, list] = {name.split()[0]: [] for name in FOUND.split(", ")}
        if left is None:
            return pd.DataFrame(out)
        n, size = int(right["n"]), int(right["d"])
        ids, marks, dims = (tiles.longs(right[c]) for c in ("ids", "marks", "dims"))
        slabs = [tiles.longs(s).reshape(-1, n) for s in right["slabs"]]
        masses = [np.frombuffer(m, np.float64) for m in right["masses"]]
        asked = tiles.longs(left["parts"]).reshape(int(left["n"]), size)[:, dims]
        exact = all(tiles.fits(asked, s, (1 << 53) // max(1, len(slabs))) for s in slabs)
        kind = np.float64 if exact else object
        asked, slabs = asked.astype(kind), [s.astype(kind) for s in slabs]
        for mark, query_id, query in zip(tiles.longs(left["marks"]), tiles.longs(left["ids"]), asked):
            live = np.flatnonzero(marks != mark)
            if exact:
                live, scores = best(query, slabs, masses, live, k)
                scores = scores.astype(np.int64)
            else:
                sums = sum((query[i * BLOCK : i * BLOCK + BLOCK] @ s[:, live] for i, s in enumerate(slabs)), np.zeros(len(live), object))
                scores = np.array([tiles.to_long(x) for x in sums], np.int64)
            if len(live) > k:
                # every tie of the k-th best score goes on to the order by id
                keep = scores >= np.partition(scores, -k)[-k]
                live, scores = live[keep], scores[keep]
            order = sorted(range(len(live)), key=lambda j: (-int(scores[j]), ids[live[j]]))[:k]
            for j in order:
                for column, value in zip(out.values(), (mark, query_id, ids[live[j]], scores[j])):
                    column.append(value)
        return pd.DataFrame(out)

    return run


def top_search(vectors: DataFrame, is_query: Column, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` rows with the highest inner product for each query row.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on vec_id.
    """
    rows = tiles.whole_vectors(vectors)
    count, size = tiles.tile_rows(rows)
    asked = rows.filter(is_query)
    query_tiles, tile_count = -(-max(1, asked.count()) // size), -(-max(1, count) // size)
    layout = durable(tiles.dealt(rows, tile_count).groupBy("d", "tile").applyInPandas(vertical, VERTICAL))
    found = tiles.meet(
        tiles.packed(asked, query_tiles), layout, query_tiles, tile_count, _searched(k), FOUND
    )
    by = Window.partitionBy("query_mark").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
