"""Near duplicates by fast similarity sketching, banding and exact verification.

A document's set holds its distinct word shingles as 64-bit hashes. The sketch
has BINS coordinates. In round i < BINS every shingle is thrown into a bin drawn
by a hash of round and shingle; round BINS + b throws all shingles into bin b.
A bin keeps its smallest (round, hash), and the rounds end when no bin is empty.
So every coordinate is filled, and the share of equal coordinates estimates the
Jaccard similarity with the concentration of independent samples.

Candidates share one of BANDS bands of ROWS coordinates. At similarity 0.75 a pair misses all
42 bands with probability 3e-4, at 0.8 with 3e-6. Every candidate link is
confirmed on the full sets, 100 * intersection >= 75 * union.

No pairs within a bucket are listed while they can be avoided. Documents with
equal sets are one class. Each class is first compared with the smallest member of
its buckets. Then the sketches of members of one bucket that are still in different
components are compared in blocks: first those pairs are confirmed that most
likely connect the components, and at last all likely pairs that remain, so no link
that matters to the components is lost whatever the size of a bucket.

Results in edge cases: a null text counts as empty; a document without words has
an empty set, links with nothing and stays; rows without ``doc_id`` do too; rows
that repeat a ``doc_id`` share its component; an empty table gives an empty
result; columns other than ``doc_id`` and ``text`` are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from echolens.llm.common import durable, texts
from echolens.llm.components import connected_components

WORDS = 5
THRESHOLD = 75  # per cent
BINS, ROWS, BANDS = 512, 6, 42
# Pairs whose sketches agree in fewer coordinates are not compared: at similarity
# 0.75 the estimate is 3.5 standard deviations higher.
LEAST_EQUAL = round(0.683 * BINS)
BLOCK = 4096
CACHED_WORDS = 400_000
GOLDEN = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer, on uint64 arrays with wrapping arithmetic."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(n: int, seed: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(GOLDEN) + np.uint64(seed)) | np.uint64(1)


_PLACES = _odd(WORDS + 1, 1)
_ROUNDS = _odd(2 * BINS, 2)
BAND_SHIFT = 8 * ROWS
_SHIFTS = 8 * np.arange(ROWS, dtype=np.int64)


class Shingler:
    """Distinct shingle hashes of whole texts; word hashes are kept in a bounded table."""

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, {}

    def __call__(self, text: str) -> np.ndarray:
        tokens = text.encode("utf-8").lower().split()  # of bytes: ASCII case and white space
        if not tokens:
            return np.empty(0, np.uint64)
        known = self.known
        try:
            hashes = np.array([known[t] for t in tokens], np.uint64)
        except KeyError:
            if len(known) > CACHED_WORDS:
                known.clear()
            for t in tokens:
                if t not in known:
                    known[t] = xxhash.xxh64_intdigest(t)
            hashes = np.array([known[t] for t in tokens], np.uint64)
        n = min(len(hashes), self.words)
        count = len(hashes) - n + 1
        total = np.full(count, n, np.uint64) * _PLACES[-1]
        for k in range(n):
            total += hashes[k : k + count] * _PLACES[k]
        return np.unique(_mix(total))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """BINS coordinates (round in the top 10 bits) of a set that is not empty."""
    out = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    step, done = max(1, min(64, 1024 // len(shingles))), 0
    while done < 2 * BINS:
        rounds = np.arange(done, min(done + step, 2 * BINS))
        hashes = _mix(shingles[None, :] * _ROUNDS[rounds][:, None])
        bins = (hashes & np.uint64(BINS - 1)).astype(np.int64)
        late = rounds >= BINS
        if late.any():
            bins[late] = (rounds[late] - BINS)[:, None]
        values = (rounds.astype(np.uint64) << np.uint64(54))[:, None] | (hashes >> np.uint64(10))
        np.minimum.at(out, bins.ravel(), values.ravel())
        done += len(rounds)
        if out.max() != np.iinfo(np.uint64).max:
            break
    return out


def small_sketch(coordinates: np.ndarray) -> np.ndarray:
    """One byte of each coordinate."""
    return _mix(coordinates).astype(np.uint8)


def band_keys(small: np.ndarray) -> np.ndarray:
    """One key per band: its number above the ROWS bytes of its coordinates."""
    rows = small[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.int64)
    return (rows << _SHIFTS).sum(axis=1) | (np.arange(BANDS, dtype=np.int64) << BAND_SHIFT)


def first_band(same: np.ndarray) -> np.ndarray:
    """The first band that two sketches share, from rows of equal places."""
    return same[:, : BANDS * ROWS].reshape(len(same), BANDS, ROWS).all(axis=2).argmax(axis=1)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        sizes, prints, bands, small = [], [], [], []
        for text in batch.column(1).to_pylist():
            found = shingler(text)
            sizes.append(len(found))
            if not len(found):
                prints.append(None), bands.append(None), small.append(None)
                continue
            prints.append(xxhash.xxh128_digest(found.tobytes()))
            places = small_sketch(sketch(found))
            bands.append(band_keys(places))
            small.append(places.tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())), pa.array(small, pa.binary()),
            ],
            ["doc_id", "n_shingles", "set_print", "bands", "sketch"],
        )


SKETCHED = "doc_id bigint, n_shingles bigint, set_print binary, bands array<bigint>, sketch binary"


def sketched(docs: DataFrame) -> DataFrame:
    """Set size, fingerprint of the set, band keys and one byte per coordinate."""
    return texts(docs).mapInArrow(_sketched, SKETCHED)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        found = [shingler(t).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.binary())], ["doc_id", "shingles"]
        )


@F.pandas_udf(IntegerType())
def _equal_bytes(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="int32")
    left = np.frombuffer(b"".join(a), np.uint8).reshape(-1, BINS)
    right = np.frombuffer(b"".join(b), np.uint8).reshape(-1, BINS)
    return pd.Series((left == right).sum(axis=1).astype("int32"))


@F.pandas_udf(IntegerType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    def count(x, y):
        both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
        both.sort()
        return int((both[1:] == both[:-1]).sum())

    return pd.Series([count(x, y) for x, y in zip(a, b)], dtype="int32")


def _likely_pairs(least: int, forest: bool):
    """Pairs of a block whose components differ, sizes allow a link and sketches agree
    in ``least`` coordinates; with ``forest`` only as many as connect them.

    A pair that meets in several buckets counts in that of its first shared band, so
    it is returned once. All its buckets are compared, as its components differ."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        band = int(key[0]) >> BAND_SHIFT
        reps, parts = frame["rep"].to_numpy(np.int64), frame["component"].to_numpy(np.int64)
        sizes = frame["n_shingles"].to_numpy(np.int64)
        own, other = frame["own"].to_numpy(), frame["other"].to_numpy()
        marks = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(-1, BINS)
        root = np.arange(len(reps))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        # members of the most frequent component are compared with the others only
        values, counts = np.unique(parts, return_counts=True)
        most = parts == values[counts.argmax()]
        out = []
        for i in np.flatnonzero(~most).tolist():
            fit = (parts != parts[i]) & ((own == other[i]) & (other == own[i]))
            fit[:i] &= most[:i]  # the pair was seen from its other side
            fit &= np.minimum(sizes, sizes[i]) * 100 >= np.maximum(sizes, sizes[i]) * THRESHOLD
            near = np.flatnonzero(fit)
            same = marks[near] == marks[i]
            enough = same.sum(axis=1) >= least
            near = near[enough][first_band(same[enough]) == band]
            for j in near.tolist():
                if forest:
                    x, y = find(i), find(j)
                    if x == y:
                        continue
                    root[max(x, y)] = min(x, y)
                out.append((min(reps[i], reps[j]), max(reps[i], reps[j])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


class _Linker:
    """Confirms candidate pairs of class representatives and keeps their components."""

    def __init__(self, docs: DataFrame, members: DataFrame, buckets: DataFrame):
        self.members, self.buckets = members, buckets
        wanted = buckets.select(F.col("rep").alias("doc_id")).distinct()
        # the texts are shuffled once, whatever the size of the other side
        some = texts(docs).join(wanted.hint("merge"), "doc_id", "left_semi")
        self.sets = durable(some.mapInArrow(_sets, "doc_id bigint, shingles binary"))
        self.links: DataFrame | None = None

    def _side(self, s: str) -> DataFrame:
        return self.members.select(
            F.col("rep").alias(s), F.col("n_shingles").alias(f"n{s}"), F.col("sketch").alias(f"s{s}")
        )

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose sizes and sketches allow a link."""
        small, large = F.least("na", "nb"), F.greatest("na", "nb")
        return (
            pairs.join(self._side("a"), "a").join(self._side("b"), "b")
            .filter(small * 100 >= large * THRESHOLD)
            .filter(_equal_bytes("sa", "sb") >= LEAST_EQUAL)
            .select("a", "b")
        )

    def confirm(self, pairs: DataFrame) -> None:
        """Add the links among ``pairs``, each listed once as (a, b) with a < b."""
        side = lambda s: self.sets.select(
            F.col("doc_id").alias(s), F.col("shingles").alias(f"x{s}"), (F.length("shingles") / 8).cast("bigint").alias(f"n{s}")
        )
        shared = F.col("n").cast("bigint")
        new = durable(
            pairs.join(side("b"), "b").join(side("a"), "a")
            .select("a", "b", "na", "nb", _common("xa", "xb").alias("n"))
            .filter(shared * 100 >= (F.col("na") + F.col("nb") - shared) * THRESHOLD)
            .select("a", "b")
        )
        self.links = new if self.links is None else self.links.union(new)

    def open_pairs(self, least: int, forest: bool) -> DataFrame:
        """Likely pairs of one bucket whose components differ by the links so far.

        Buckets are cut into blocks of BLOCK members; a block meets each other block
        of its bucket in a task of its own.
        """
        found = durable(connected_components(self.links).withColumnRenamed("node", "rep"))
        placed = durable(
            self.buckets.join(found, "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
        )
        mixed = (
            placed.groupBy("key")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"))
            .filter("low != high").select("key", F.ceil(F.col("n") / BLOCK).alias("blocks"))
        )
        rows = placed.join(mixed, "key").join(self.members, "rep")
        own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
        rows = rows.withColumn("own", own).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
        )
        return durable(
            rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
            .select("key", "low", "high", "rep", "component", "n_shingles", "sketch", "own", "other")
            .groupBy("key", "low", "high").applyInPandas(_likely_pairs(least, forest), "a bigint, b bigint")
        )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    rows = durable(sketched(docs))
    named = rows.filter("set_print is not null and doc_id is not null")
    classes = durable(
        named.groupBy("set_print").agg(
            F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"),
            F.max("bands").alias("bands"), F.max("sketch").alias("sketch"),
        )
    )
    buckets = classes.select("rep", F.explode("bands").alias("key"))
    centers = buckets.groupBy("key").agg(F.min("rep").alias("center"), F.max("rep").alias("last"))
    centers = centers.filter("center != last").select("key", "center")
    buckets = durable(buckets.join(centers, "key"))
    linker = _Linker(docs, classes.select("rep", "n_shingles", "sketch"), buckets.select("key", "rep"))

    # each member with the smallest member of its buckets
    first = buckets.filter("rep != center").groupBy(F.col("rep").alias("b")).agg(F.min("center").alias("a"))
    linker.confirm(durable(linker.likely(first)))
    # what most likely connects components that still meet in a bucket
    linker.confirm(linker.open_pairs(THRESHOLD * BINS // 100, forest=True))
    # all that is left
    linker.confirm(linker.open_pairs(LEAST_EQUAL, forest=False))

    # rows of one doc_id with different texts tie their classes together
    same = named.join(classes.select("set_print", "rep"), "set_print").filter("doc_id != rep")
    edges = linker.links.union(same.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    reps = connected_components(edges).select(F.col("node").alias("doc_id"), "component")
    out = rows.select("doc_id", "n_shingles").join(reps, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one document of each component."""
    gone = near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"].cast("bigint") == gone["doc_id"], "left_anti")
