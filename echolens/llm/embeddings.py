"""Near-duplicate vectors by an inverted multi-index.

Each half of the unit vectors has a codebook of its own; the pairs of codewords
form a grid of cells, and every vector lies in the cell of its two nearest
codewords. A vector's search visits cells in the order of its squared distance to
them (multi-sequence traversal of the two halves' sorted distances; distances are
to the codewords' Voronoi cells) until partners at the threshold are found with
the target recall: a displacement of squared length 2 - 2 cos in a random direction
leaves the visited cells with probability 1 - recall at most. With recall 1 all
cells that can hold a partner are visited. Every candidate is verified by the
cosine in double precision.

The cells of one codeword of the first half are a row of the grid. A vector is
sent once to each row it visits, not to each cell. Rows with many vectors are split
into blocks, members against visitors, and a block gives sums and a spanning forest
of its links, never the pairs. So the result grows with the vectors even where
thousands are linked with each other.

Codebooks are fitted on at most ``sample`` vectors; every vector is indexed and
searched. Codewords per half grow with the square root of the vectors.

Results in edge cases: vectors that are null, empty, zero, or hold nulls or
non-finite components link with nothing; so do rows without ``vec_id``, whose
component is null and which stay; vectors of different lengths are never linked;
rows that repeat a ``vec_id`` share its component, and a row is not its own link;
an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolens.llm.common import bounded, durable, hot_join
from echolens.llm.components import connected_components

THRESHOLD, RECALL, SAMPLE = 0.95, 0.99, 20_000
CELL_SIZE, MOST_CODEWORDS = 128, 1024
BLOCK_MEMBERS, BLOCK_VISITORS, STRIP = 8192, 16_384, 512


def _squares(z: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (z * z).sum(1)[:, None] - 2 * z @ centers.T + (centers * centers).sum(1)


def codebook(z: np.ndarray, size: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """Centers of k-means."""
    rng = np.random.default_rng(seed)
    centers = z[rng.choice(len(z), min(size, len(z)), replace=False)].copy()
    for _ in range(rounds):
        near = _squares(z, centers).argmin(1)
        counts = np.bincount(near, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, near, z)
        used = counts > 0
        centers[used] = sums[used] / counts[used][:, None]
    return centers


def cell_distances(z: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest codeword, and a lower bound of the squared distance to each codeword's cell.

    A point of cell i is nearer to codeword i than to the nearest one of z, so it
    lies beyond their bisector.
    """
    squares = _squares(z, centers)
    near = squares.argmin(1)
    between = np.sqrt(np.maximum(_squares(centers, centers), 1e-300))
    beyond = (squares - squares[np.arange(len(z)), near][:, None]) / (2 * between[near])
    beyond[np.arange(len(z)), near] = 0
    return near, np.square(np.maximum(beyond, 0))


def multi_sequence(first: np.ndarray, second: np.ndarray, reach: float) -> Iterator[tuple[int, int]]:
    """Cells (i, j) in the order of first[i] + second[j], up to ``reach``."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    heap = [(x[0] + y[0], 0, 0)]
    while heap:
        distance, i, j = heapq.heappop(heap)
        if distance > reach:
            return
        yield int(a[i]), int(b[j])
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))


def reach_of(threshold: float, recall: float, size: int) -> float:
    """Squared distance up to which cells are visited.

    A displacement of squared length d² in a random direction of ``size`` dimensions
    has d²/size per direction on average; over one bisector in each half its square
    exceeds -2 ln(1 - recall) times that with probability 1 - recall. It never
    exceeds d².
    """
    longest = 2 - 2 * threshold
    if recall >= 1:
        return longest * (1 + 1e-9)
    return min(longest, longest / size * -2 * math.log(1 - recall))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(1))[:, None]


def _located(books: tuple[np.ndarray, np.ndarray], reach: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            x = _unit(np.stack(frame["vector"].to_numpy()).astype(np.float64))
            half = x.shape[1] // 2
            near1, far1 = cell_distances(x[:, :half], books[0])
            near2, far2 = cell_distances(x[:, half:], books[1])
            rows, cells = [], []
            for a, b in zip(far1, far2):
                by_row: dict[int, list[int]] = {}
                for i, j in multi_sequence(a, b, reach):
                    by_row.setdefault(i, []).append(j)
                rows.append(list(by_row)), cells.append(list(by_row.values()))
            yield pd.DataFrame(
                {
                    "rep": frame["rep"], "size": frame["size"], "vector": frame["vector"],
                    "own_row": near1, "own_cell": near2, "rows": rows, "cells": cells,
                }
            )

    return run


def _forest(r: np.ndarray, c: np.ndarray, n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Labels of n row and m column nodes, equal in each component of the pairs (r, c).

    ``r`` is sorted. Nodes without a pair have the label -1.
    """
    rows, row_at = np.unique(r, return_index=True)
    order = np.argsort(c, kind="stable")
    cols, col_at = np.unique(c[order], return_index=True)
    of_row, of_col = np.full(n, -1), np.full(m, -1)
    of_row[rows] = rows
    of_col[cols] = np.minimum.reduceat(of_row[r[order]], col_at)
    while True:
        new = np.minimum.reduceat(of_col[c], row_at)
        if (new == of_row[rows]).all():
            return of_row, of_col
        of_row[rows] = new
        of_col[cols] = np.minimum.reduceat(of_row[r[order]], col_at)


def _block(threshold: float):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        members, visitors = frame[frame["side"] == 0], frame[frame["side"] == 1]
        empty = pd.DataFrame({"rep": [], "n": [], "other": []}).astype("int64")
        if not len(members) or not len(visitors):
            return empty
        x = np.stack(members["vector"].to_numpy()).astype(np.float64)
        q = np.stack(visitors["vector"].to_numpy()).astype(np.float64)
        nx, nq = np.sqrt((x * x).sum(1)), np.sqrt((q * q).sum(1))
        cell = members["cells"].map(lambda v: v[0]).to_numpy(np.int64)
        rep, size = members["rep"].to_numpy(np.int64), members["size"].to_numpy(np.int64)
        who = visitors["rep"].to_numpy(np.int64)
        lists = visitors["cells"].to_list()
        asked = np.concatenate([np.asarray(v, np.int64) for v in lists])
        asker = np.repeat(np.arange(len(lists)), [len(v) for v in lists])
        order, place = np.argsort(asked, kind="stable"), np.argsort(cell, kind="stable")
        asked, asker, cell_sorted = asked[order], asker[order], cell[place]
        out = []
        for j in np.unique(cell_sorted):
            at = place[slice(*np.searchsorted(cell_sorted, [j, j + 1]))]
            from_ = asker[slice(*np.searchsorted(asked, [j, j + 1]))]
            for start in range(0, len(from_), STRIP):
                ask = from_[start : start + STRIP]
                hit = (q[ask] @ x[at].T) / (nq[ask][:, None] * nx[at][None, :]) >= threshold
                hit &= who[ask][:, None] != rep[at][None, :]
                r, c = np.nonzero(hit)
                if not len(r):
                    continue
                counts = np.bincount(r, size[at][c], len(ask)).astype(np.int64)
                of_row, of_col = _forest(r, c, len(ask), len(at))
                # each node is tied to the row node that gave its component the label
                linked, reached = counts > 0, of_col >= 0
                out.append((who[ask[linked]], counts[linked], who[ask[of_row[linked]]]))
                out.append((rep[at[reached]], np.zeros(reached.sum(), np.int64), who[ask[of_col[reached]]]))
        if not out:
            return empty
        rep_, n, other = (np.concatenate(v) for v in zip(*out))
        return pd.DataFrame({"rep": rep_, "n": n, "other": other})

    return run


def _links(classes: DataFrame, threshold: float, recall: float, sample: int, size: int) -> DataFrame:
    """(rep, n, other): links counted per visitor and block, and edges that connect them."""
    chosen = classes.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("vector").toPandas()["vector"]
    known = _unit(np.stack(chosen.to_numpy()).astype(np.float64))
    count = classes.count()
    words = int(min(MOST_CODEWORDS, max(1, round(math.sqrt(count / CELL_SIZE)))))
    half = size // 2
    books = (codebook(known[:, :half], words), codebook(known[:, half:], words))
    located = durable(
        classes.select("rep", "size", "vector").mapInPandas(
            _located(books, reach_of(threshold, recall, size)),
            "rep bigint, size bigint, vector array<double>, own_row int, own_cell int, "
            "rows array<int>, cells array<array<int>>",
        )
    )
    visits = located.select(
        "rep", "size", "vector", F.explode(F.arrays_zip("rows", "cells")).alias("v")
    ).select("rep", "size", "vector", F.col("v.rows").alias("row"), F.col("v.cells").alias("cells"))
    members = located.select(
        "rep", "size", "vector", F.col("own_row").alias("row"), F.array("own_cell").alias("cells")
    )
    blocks = lambda n, most: F.ceil(F.col(n) / most)
    # a row per codeword, at most MOST_CODEWORDS
    plan = (
        members.groupBy("row").agg(F.count(F.lit(1)).alias("m"))
        .join(visits.groupBy("row").agg(F.count(F.lit(1)).alias("v")), "row")
        .select("row", blocks("m", BLOCK_MEMBERS).alias("mb"), blocks("v", BLOCK_VISITORS).alias("vb"))
    )
    plan = F.broadcast(durable(plan))
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    both = (
        members.join(plan, "row").withColumns({"mblock": own("mb"), "vblock": spread("vb")}).withColumn("side", F.lit(0))
        .unionByName(
            visits.join(plan, "row").withColumns({"vblock": own("vb"), "mblock": spread("mb")}).withColumn("side", F.lit(1))
        )
        .drop("mb", "vb")
    )
    return both.groupBy("row", "mblock", "vblock").applyInPandas(_block(threshold), "rep bigint, n bigint, other bigint")


def near_duplicate_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, sample: int = SAMPLE
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding)."""
    bounded(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall(
        "vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))
    )
    good = F.coalesce(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0), F.lit(False)
    )
    valid = rows.filter(good)
    classes = durable(
        valid.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("size"), F.count(F.lit(1)).alias("load"))
    )
    placed = durable(hot_join(valid, classes, "vector", "load", ["rep", "size"]).select("vec_id", "rep", "size").distinct())
    found = None
    for row in classes.groupBy(F.size("vector").alias("d")).count().collect():
        # one index per length; a table has one or a few
        some = classes.filter(F.size("vector") == row["d"]).groupBy("rep", "vector").agg(F.max("size").alias("size"))
        part = durable(_links(some, threshold, recall, sample, row["d"]))
        found = part if found is None else found.union(part)
    if found is None:
        counted = placed.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component"))
    else:
        sums = found.filter("n > 0").groupBy("rep").agg(F.sum("n").alias("n"))
        edges = found.filter("rep != other").select(F.col("rep").alias("a"), F.col("other").alias("b")).distinct()
        # copies: every member of a class with its smallest
        edges = edges.union(placed.filter("vec_id != rep").select("vec_id", "rep"))
        components = connected_components(edges).withColumnRenamed("node", "vec_id")
        counted = (
            placed.join(sums, "rep", "left")
            .groupBy("vec_id").agg(F.sum(F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"))
            .join(components, "vec_id", "left")
        )
    component = F.coalesce("component", "vec_id")
    return rows.select("vec_id").join(counted, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
