"""Quality by Bradley-Terry ranking of document pairs.

A document has a score linear in simple measures of its whole text; of a pair, the
one labelled 1 is preferred with the logistic probability of the difference of
scores. The weights minimise the logistic loss on the feature differences of
pairs of training rows with different labels, plus a ridge, by Newton steps. The
cut is the quantile of the training scores that leaves the share labelled 1 above
it; a logistic map sends the cut to 0.7.

Every row is measured once; the measures are written, and labels, training and scores
go by them. Every labelled row outside the held-out part is learnt from. Their measures are
dealt to blocks by a hash of doc_id, and within a block every row is paired with
PARTNERS rows of the other label; rows of a rare label go to several blocks, with
as much less weight. Each Newton step, the cut and the map are sums or counts over
all blocks or rows, added up by Spark: only sums, of a fixed number, reach the driver.

Results in edge cases: a null or empty text has the measures of no characters;
without labels of both kinds the score is 0.5 for all; repeated labels count once,
the highest; rows without ``doc_id`` are scored like others; columns other than
``doc_id`` and ``text`` (and the label) are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolens.llm.common import durable, texts
from echolens.llm.toxicity import held_out

PARTNERS, RIDGE, STEPS, SEED = 8, 1e-3, 25, 3
# Rows of the frequent label and, at least about, of the rare one in a block.
BLOCK, RARE = 4096, 64
BINS, FEW = 1000, 10_000
CUT = 0.7
_CLASSES = {  # fixed byte classes
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789", "space": b" \t\r\v\f", "line": b"\n", "stop": b".", "comma": b",",
    "shout": b"!?", "symbol": b"#$%&*+/<=>@\\^_`|~", "bracket": b"()[]{}\"'", "other": bytes(range(128, 256)),
}
_LOOKUP = np.full(256, len(_CLASSES), np.uint8)
for _n, _bytes in enumerate(_CLASSES.values()):
    _LOOKUP[list(_bytes)] = _n
FEATURES = len(_CLASSES) + 8


def measures(text: str) -> np.ndarray:
    """Measures of a whole text: shares of character classes, repetition, lengths."""
    raw = text.encode("utf-8", "replace")
    size = max(1, len(raw))
    kinds = np.bincount(_LOOKUP[np.frombuffer(raw, np.uint8)], minlength=len(_CLASSES) + 1) / size
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n = max(1, len(words))
    return np.concatenate(
        [
            np.log(kinds[:-1] + 1e-3),
            [
                np.log1p(len(raw)), np.log1p(len(words)), len(set(words)) / n,
                len(set(zip(words, words[1:]))) / n, len(set(lines)) / max(1, len(lines)),
                np.log((len(raw) + 1) / n), np.log((len(words) + 1) / max(1, len(lines))),
                len(zlib.compress(raw, 1)) / size,
            ],
        ]
    )


class Ranker:
    """Weights of the measures, and the logistic map of the scores."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        self.mean, self.scale = mean, scale
        self.w, self.cut, self.slope = np.zeros(2 * FEATURES), 0.0, 1.0

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, np.abs(z)], axis=1)

    def scores(self, x: list[np.ndarray]) -> np.ndarray:
        return self.inputs(np.stack(x)) @ self.w

    def __call__(self, x: list[np.ndarray]) -> np.ndarray:
        scores = self.scores(x)
        at = np.log(CUT / (1 - CUT)) + self.slope * (scores - self.cut)
        return 1 / (1 + np.exp(-np.clip(at, -50, 50)))


def _per_batch(fn, kind: str, column: str) -> Column:
    """``fn`` of each batch of a column, a value for every row."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(fn(list(batch))) if len(batch) else [], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, kind)(column)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and x (measures) of every row; what follows needs no text."""
    return texts(docs).select("doc_id", _per_batch(lambda rows: map(measures, rows), "array<double>", "text").alias("x"))


def labelled(rows: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """doc_id, y, x of every labelled row to learn from, a repeated doc_id once."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")
    ).agg((F.max("quality") > 0).alias("y"))
    return rows.filter(learn).join(known, "doc_id").groupBy("doc_id").agg(F.first("y").alias("y"), F.min("x").alias("x"))


def learnt_rows(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """The labelled rows of ``docs``; measures meet the labels, so that no text is shuffled."""
    return labelled(measured(docs), labels, learn)


def blocks(rows: DataFrame, good: int, bad: int, ranker: Ranker) -> DataFrame:
    """The rows as records of inputs, labels and weights, a block each."""
    rare, n = min(good, bad), 1 + max(good, bad) // BLOCK
    copies = min(n, max(1, -(-RARE * n // rare)))
    times = F.when(F.col("y") == F.lit(good <= bad), F.lit(copies)).otherwise(F.lit(1))
    dealt = rows.select("y", "x", times.alias("times"), F.explode(F.sequence(F.lit(0), times - 1)).alias("i"), F.xxhash64("doc_id").alias("h"))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("h", kind="stable")
        z = ranker.inputs(np.stack(list(block["x"])))
        y, share = block["y"].to_numpy(bool), 1 / block["times"].to_numpy(float)
        return pd.DataFrame({"z": [z.tobytes()], "y": [y.tobytes()], "share": [share.tobytes()]})

    block = F.pmod(F.col("h") + F.col("i"), F.lit(n)).alias("block")
    return dealt.select(block, "h", "y", "x", "times").groupBy("block").applyInPandas(
        pack, "z binary, y binary, share binary"
    )


def _pairs(z: bytes, y: bytes, share: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Differences of inputs, better less worse, and the weights of the pairs of a block."""
    y, share = np.frombuffer(y, bool), np.frombuffer(share)
    z = np.frombuffer(z).reshape(len(y), -1)
    good, bad = np.flatnonzero(y), np.flatnonzero(~y)
    if not len(good) or not len(bad):
        return np.empty((0, z.shape[1])), np.empty(0)
    rng = np.random.default_rng(SEED)
    own_bad, own_good = np.tile(bad, PARTNERS), np.repeat(good, PARTNERS)
    better = np.concatenate([rng.choice(good, len(own_bad)), own_good])
    worse = np.concatenate([own_bad, rng.choice(bad, len(own_good))])
    return z[better] - z[worse], share[np.concatenate([own_bad, own_good])]


def _summed(table: DataFrame, sums, size: int) -> np.ndarray:
    """``sums`` of each batch of records, an array of ``size`` numbers, added up over all tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for frame in frames:
            total += sums(frame)
        yield pd.DataFrame({"sums": [total]})

    parts = table.mapInPandas(run, "sums array<double>").select(F.posexplode("sums"))
    total = np.zeros(size)
    for row in parts.groupBy("pos").agg(F.sum("col").alias("total")).collect():
        total[row["pos"]] = row["total"]
    return total


def _fit(table: DataFrame, w: np.ndarray) -> np.ndarray:
    """Newton steps on the loss of the pairs of all blocks."""
    size = len(w)
    for _ in range(STEPS):

        def sums(frame: pd.DataFrame, w: np.ndarray = w) -> np.ndarray:
            total = np.zeros(1 + size + size * size)
            for z, y, share in zip(frame["z"], frame["y"], frame["share"]):
                d, weight = _pairs(z, y, share)
                p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))
                total[0] += weight.sum()
                total[1 : 1 + size] -= (weight * p) @ d
                total[1 + size :] += ((d * (weight * p * (1 - p))[:, None]).T @ d).ravel()
            return total

        total = _summed(table, sums, 1 + size + size * size)
        grad = total[1 : 1 + size] / total[0] + RIDGE * w
        hess = total[1 + size :].reshape(size, size) / total[0] + RIDGE * np.eye(size)
        move = np.linalg.solve(hess, grad)
        w = w - move
        if np.abs(move).max() < 1e-6:
            break
    return w


def kth(scores: DataFrame, k: int) -> float:
    """The ``k``-th smallest score, from 0: ranges are counted until one holds few rows."""
    score = F.col("score")
    low, high = scores.agg(F.min(score), F.max(score)).first()
    skipped = 0
    while low < high:
        bin_ = F.least(F.floor((score - low) / (high - low) * BINS), F.lit(BINS - 1))
        inside = scores.filter(score.between(low, high)).withColumn("bin", bin_)
        for row in inside.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min(score).alias("a"), F.max(score).alias("b")).sort("bin").collect():
            if k < skipped + row["n"]:
                break
            skipped += row["n"]
        if row["n"] <= FEW:
            values = inside.filter(F.col("bin") == row["bin"]).select(score).sort(score).collect()
            return values[k - skipped][0]
        low, high = row["a"], row["b"]
    return low


def _slope(scores: DataFrame, cut: float) -> float:
    """Slope of the logistic map through (cut, CUT) with the least logistic loss over all rows."""
    base, grid = np.log(CUT / (1 - CUT)), np.geomspace(0.05, 20, 60)

    def sums(frame: pd.DataFrame) -> np.ndarray:
        distance, sign = frame["score"].to_numpy() - cut, np.where(frame["y"].to_numpy(bool), 1, -1)
        return np.array([np.logaddexp(0, -sign * (base + s * distance)).sum() for s in grid])

    return float(grid[int(np.argmin(_summed(scores, sums, len(grid))))])


def trained(rows: DataFrame, labels: DataFrame, learn: Column) -> Ranker | None:
    """The ranker of measured rows."""
    rows = durable(labelled(rows, labels, learn))
    x = [F.col("x")[i] for i in range(FEATURES)]
    found = rows.agg(
        F.count_if("y"), F.count_if(~F.col("y")), F.array(*map(F.avg, x)), F.array(*map(F.stddev_pop, x))
    ).first()
    good, bad = found[0], found[1]
    if not good or not bad:
        return None
    ranker = Ranker(np.array(found[2]), np.array(found[3]) + 1e-6)
    ranker.w = _fit(durable(blocks(rows, good, bad, ranker)), ranker.w)

    scores = durable(rows.select("y", _per_batch(ranker.scores, "double", "x").alias("score")))
    place = (good + bad - 1) * (bad / (good + bad))
    low = int(place)
    ranker.cut = kth(scores, low)
    if place > low:
        ranker.cut += (place - low) * (kth(scores, low + 1) - ranker.cut)
    ranker.slope = _slope(scores, ranker.cut)
    return ranker


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    out = held_out(F.col("doc_id"), 4, 2)
    rows = durable(measured(docs))
    ranker = trained(rows, labels, ~out)
    score = F.lit(0.5) if ranker is None else _per_batch(ranker, "double", "x")
    return rows.select("doc_id", score.alias("score")).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )
