"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Words (lower case) of the whole text are cut into windows of WINDOW words that
overlap by WINDOW - STRIDE. The input of a word is its hashed word vector beside
the mean of its hashed character trigram vectors. A gated recurrent layer reads
the window in both directions, attention pools the states, and a linear layer
gives the window's logit. A document's logit is that of its most toxic window, in
training as in scoring, so its label need only hold somewhere in the text.

The network is trained in numpy, by Adam, on at most ``max_rows`` labelled rows,
the first in the order of a hash of doc_id. The first place of a word vector
starts as the smoothed log-odds of its bucket in these rows; all else at random.

Results in edge cases: a null or wordless text has one empty window, whose score
is that of the bias; without labelled rows the score is 0.5 for all; rows without
``doc_id`` are scored like others; repeated labels count once, the highest; columns
other than ``doc_id`` and ``text`` (and the label) are never read.
"""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from echolens.llm.common import bounded, texts

WINDOW, STRIDE = 48, 40
WORD_BUCKETS, CHAR_BUCKETS = 1 << 15, 1 << 12
WORD_SIZE, CHAR_SIZE, HIDDEN = 8, 8, 8
MAX_ROWS, EPOCHS, BATCH = 4500, 7, 48
REJECT = 0.7
CACHED_WORDS = 200_000
CHUNK = 1536  # windows computed at once
_WORDS = re.compile(r"\w+")
Params = dict[str, np.ndarray]


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, trigram buckets of all words in a row, and where each word's begin."""
    raw = [w.encode("utf-8", "replace") for w in words]
    buckets = np.array([zlib.crc32(w) for w in raw], np.int64) % WORD_BUCKETS
    line = np.frombuffer(b" " + b" ".join(raw) + b"  ", np.uint8).astype(np.int64)
    codes = (line[:-2] * 7919 + line[1:-1] * 104729 + line[2:] * 1299709) % CHAR_BUCKETS
    # a word of n bytes begins n trigrams, the first with the blank before it
    lengths = np.array([len(w) for w in raw], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)]).astype(np.int64)
    inside = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths[:-1])]).astype(np.int64), lengths)
    return buckets, codes[np.arange(lengths.sum()) + inside], np.cumsum(lengths) - lengths


def word_inputs(p: Params, words: list[str]) -> np.ndarray:
    """Input vectors of words, (n, WORD_SIZE + CHAR_SIZE)."""
    buckets, codes, starts = word_features(words)
    sums = np.add.reduceat(p["chars"][codes], starts, axis=0)
    counts = np.diff(np.append(starts, len(codes)))[:, None]
    return np.concatenate([p["words"][buckets], sums / counts], axis=1).astype(np.float32)


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts written one after another: each window's text, first word and word count."""
    counts = np.maximum(1, -(-(lengths - WINDOW) // STRIDE) + 1)
    owner = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = nth * STRIDE
    return owner, first + (np.cumsum(lengths) - lengths)[owner], np.minimum(WINDOW, lengths[owner] - first)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.tanh(x * np.float32(0.5))
    out *= np.float32(0.5)
    out += np.float32(0.5)
    return out


def _scan(inputs: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: list | None) -> np.ndarray:
    """States (T, n, H) of one direction; inputs (T, n, 3H) are already projected."""
    steps, n, h = len(inputs), inputs.shape[1], HIDDEN
    state = np.zeros((n, h), np.float32)
    out = np.empty((steps, n, h), np.float32)
    for t in range(steps):
        carried = state @ u
        gates = _sigmoid(inputs[t, :, : 2 * h] + carried[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        new = np.tanh(inputs[t, :, 2 * h :] + r * carried[:, 2 * h :])
        before = state
        state = before + mask[t] * (1 - z) * (new - before)
        out[t] = state
        if keep is not None:
            keep.append((before, z, r, new, carried[:, 2 * h :]))
    return out


def forward(p: Params, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logits of windows; x (T, n, 6H) are projected inputs of both directions, mask (T, n, 1)."""
    h = HIDDEN
    left, right = ([], []) if keep is not None else (None, None)
    ahead = _scan(x[:, :, : 3 * h], mask, p["u_ahead"], left)
    back = _scan(x[::-1, :, 3 * h :], mask[::-1], p["u_back"], right)[::-1]
    states = np.concatenate([ahead, back], axis=2)
    hidden = np.tanh(states @ p["attend"] + p["attend_b"])
    energy = np.where(mask > 0, hidden @ p["attend_v"][:, None], np.float32(-30))
    share = np.exp(energy - energy.max(axis=0)) * mask
    share /= np.maximum(share.sum(axis=0), np.float32(1e-9))
    pooled = (share * states).sum(axis=0)
    if keep is not None:
        keep.update(left=left, right=right, states=states, hidden=hidden, share=share, pooled=pooled)
    return pooled @ p["out"] + p["out_b"][0]


def _scan_back(kept: list, mask: np.ndarray, u: np.ndarray, d_out: np.ndarray):
    h, n = HIDDEN, d_out.shape[1]
    d_in, d_u = np.zeros((len(kept), n, 3 * h), np.float32), np.zeros_like(u)
    d_state = np.zeros((n, h), np.float32)
    for t in range(len(kept) - 1, -1, -1):
        before, z, r, new, carried = kept[t]
        d = d_state + d_out[t]
        dm = d * mask[t]
        d_new = dm * (1 - z) * (1 - new * new)
        d_z = dm * (before - new) * z * (1 - z)
        d_r = d_new * carried * r * (1 - r)
        d_in[t] = np.concatenate([d_z, d_r, d_new], axis=1)
        d_carried = np.concatenate([d_z, d_r, d_new * r], axis=1)
        d_u += before.T @ d_carried
        d_state = d * (1 - mask[t]) + dm * z + d_carried @ u.T
    return d_in, d_u


def backward(p: Params, mask: np.ndarray, keep: dict, d_logit: np.ndarray) -> tuple[Params, np.ndarray]:
    """Gradients of the weights above the inputs, and of the projected inputs."""
    h, states, hidden, share = HIDDEN, keep["states"], keep["hidden"], keep["share"]
    g = {"out": keep["pooled"].T @ d_logit, "out_b": np.array([d_logit.sum()], np.float32)}
    d_pooled = d_logit[:, None] * p["out"][None, :]
    d_states = share * d_pooled[None]
    d_share = (states * d_pooled[None]).sum(axis=2, keepdims=True)
    d_energy = share * (d_share - (share * d_share).sum(axis=0, keepdims=True))
    g["attend_v"] = (hidden * d_energy).sum(axis=(0, 1))
    d_hidden = d_energy * p["attend_v"] * (1 - hidden * hidden)
    g["attend"] = np.tensordot(states, d_hidden, axes=([0, 1], [0, 1]))
    g["attend_b"] = d_hidden.sum(axis=(0, 1))
    d_states = d_states + d_hidden @ p["attend"].T
    d_ahead, g["u_ahead"] = _scan_back(keep["left"], mask, p["u_ahead"], d_states[:, :, :h])
    d_back, g["u_back"] = _scan_back(keep["right"], mask[::-1], p["u_back"], d_states[::-1, :, h:])
    return g, np.concatenate([d_ahead, d_back[::-1]], axis=2)


def _start(rng: np.random.Generator) -> Params:
    size, h = WORD_SIZE + CHAR_SIZE, HIDDEN
    draw = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
    return {
        "words": draw(WORD_BUCKETS, WORD_SIZE, scale=0.1), "chars": draw(CHAR_BUCKETS, CHAR_SIZE, scale=0.1),
        "w": draw(size, 6 * h, scale=size**-0.5), "w_b": np.zeros(6 * h, np.float32),
        "u_ahead": draw(h, 3 * h, scale=h**-0.5), "u_back": draw(h, 3 * h, scale=h**-0.5),
        "attend": draw(2 * h, h, scale=0.3), "attend_b": np.zeros(h, np.float32),
        "attend_v": draw(h, scale=0.3), "out": draw(2 * h, scale=0.3), "out_b": np.zeros(1, np.float32),
    }


def _window_rows(first: np.ndarray, count: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions (T, n) and mask (T, n, 1) of windows."""
    steps = np.arange(WINDOW)[:, None]
    at = np.minimum(first[None, :] + steps, max(last, 0))
    return at, (steps < count[None, :]).astype(np.float32)[:, :, None]


def train(
    rows: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 7, rate: float = 0.01
) -> Params | None:
    """Fit the network to (text, label) rows; without rows there is no network."""
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    p = _start(rng)
    y = np.array([label for _, label in rows], np.float32)
    names: dict[str, int] = {}
    by_text = [np.array([names.setdefault(w, len(names)) for w in words_of(t)], np.int32) for t, _ in rows]
    lengths = np.array([len(x) for x in by_text], np.int64)
    ids = np.concatenate(by_text)
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    p["out_b"][0] = np.log(share / (1 - share))
    if not names:
        return p
    buckets, codes, starts = word_features(list(names))
    ends = np.append(starts[1:], len(codes))
    sizes = ends - starts
    # smoothed log-odds of each bucket, by the documents it occurs in
    document = np.repeat(np.arange(len(y)), lengths)
    seen = np.unique(document * WORD_BUCKETS + buckets[ids])
    hits = np.bincount(seen % WORD_BUCKETS, y[seen // WORD_BUCKETS], WORD_BUCKETS)
    total = np.bincount(seen % WORD_BUCKETS, minlength=WORD_BUCKETS)
    odds = (hits + 4 * share) / (total - hits + 4 * (1 - share)) * (1 - share) / share
    p["words"][:, 0] = np.log(odds)
    owner, first, count = windows(lengths)
    bounds = np.searchsorted(owner, np.arange(len(y)))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0
    for epoch in range(epochs):
        # the most toxic window of each document, by the weights so far
        table = np.concatenate([
            _project(p, np.concatenate([p["words"][buckets[a:b]], np.add.reduceat(p["chars"][codes[starts[a] : ends[b - 1]]], starts[a:b] - starts[a], axis=0) / sizes[a:b, None]], axis=1))
            for a, b in ((a, min(a + 50_000, len(names))) for a in range(0, len(names), 50_000))
        ])
        logits = _logits(p, table, ids, first, count)
        best = _first_max(logits, bounds, owner)
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            place, mask = _window_rows(first[best[part]], count[best[part]], len(ids) - 1)
            used, inverse = np.unique(ids[place], return_inverse=True)
            inverse = inverse.reshape(place.shape)
            # trigrams of the words used
            spans = np.concatenate([np.arange(starts[w], starts[w] + sizes[w]) for w in used])
            of_word = np.repeat(np.arange(len(used)), sizes[used])
            x_chars = np.add.reduceat(p["chars"][codes[spans]], np.cumsum(sizes[used]) - sizes[used], axis=0)
            x = np.concatenate([p["words"][buckets[used]], x_chars / sizes[used][:, None]], axis=1).astype(np.float32)
            keep: dict = {}
            logit = forward(p, (x @ p["w"] + p["w_b"])[inverse], mask, keep)
            d_logit = ((_sigmoid(logit) - y[part]) / len(part)).astype(np.float32)
            g, d_x = backward(p, mask, keep, d_logit)
            d_rows = _sum_rows((d_x * mask).reshape(-1, d_x.shape[2]), inverse.ravel(), len(used))
            g["w"], g["w_b"] = x.T @ d_rows, d_rows.sum(axis=0)
            d_input = d_rows @ p["w"].T
            step += 1
            sparse = {
                "words": (buckets[used], d_input[:, :WORD_SIZE]),
                "chars": (codes[spans], (d_input[:, WORD_SIZE:] / sizes[used][:, None])[of_word]),
            }
            _adam(p, g, sparse, moments, step, rate * 0.85**epoch)
    return p


def _sum_rows(rows: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Sums of rows by group; every group from 0 on has a row."""
    order = np.argsort(group, kind="stable")
    return np.add.reduceat(rows[order], np.searchsorted(group[order], np.arange(groups)), axis=0)


def _first_max(logits: np.ndarray, bounds: np.ndarray, owner: np.ndarray) -> np.ndarray:
    top = np.maximum.reduceat(logits, bounds)
    hits = np.flatnonzero(logits >= top[owner])
    return hits[np.searchsorted(owner[hits], np.arange(len(bounds)))]


def _adam(p: Params, dense: Params, sparse: dict, moments: dict, step: int, rate: float) -> None:
    """One step; rows of tables move when they are used."""
    fix = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
    for k, g in dense.items():
        m, v = moments[k]
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        p[k] -= (fix * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    for k, (rows, g) in sparse.items():
        at, inverse = np.unique(rows, return_inverse=True)
        total = _sum_rows(g, inverse, len(at))
        m, v = moments[k]
        m[at] += 0.1 * (total - m[at])
        v[at] += 0.001 * (total * total - v[at])
        p[k][at] -= (fix * m[at] / (np.sqrt(v[at]) + 1e-8)).astype(np.float32)


def _project(p: Params, inputs: np.ndarray) -> np.ndarray:
    return (inputs.astype(np.float32) @ p["w"] + p["w_b"]).astype(np.float32)


def _logits(p: Params, table: np.ndarray, ids: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Logits of all windows over words ``ids``, whose projected inputs are rows of ``table``."""
    out = np.empty(len(first), np.float32)
    if not len(ids):
        ids, table = np.zeros(1, np.int64), np.zeros((1, 6 * HIDDEN), np.float32)
    for at in range(0, len(first), CHUNK):
        place, mask = _window_rows(first[at : at + CHUNK], count[at : at + CHUNK], len(ids) - 1)
        out[at : at + CHUNK] = forward(p, table[ids[place]], mask)
    return out


class Scorer:
    """Scores of whole texts; projected word inputs are kept in a bounded table."""

    def __init__(self, params: Params):
        self.p = params
        self._empty()

    def _empty(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.empty((0, 6 * HIDDEN), np.float32)
        self.used = 0

    def __call__(self, texts_: list[str]) -> np.ndarray:
        if self.used > CACHED_WORDS:
            self._empty()
        split = [words_of(t) for t in texts_]
        known = self.known
        new = list({w for ws in split for w in ws if w not in known})
        if new:
            rows = _project(self.p, word_inputs(self.p, new))
            need = self.used + len(new)
            if need > len(self.table):
                grown = np.empty((need + need // 2, 6 * HIDDEN), np.float32)
                grown[: self.used] = self.table[: self.used]
                self.table = grown
            self.table[self.used : need] = rows
            known.update(zip(new, range(self.used, need)))
            self.used = need
        lengths = np.array([len(ws) for ws in split], np.int64)
        ids = np.array([known[w] for ws in split for w in ws], np.int64)
        owner, first, count = windows(lengths)
        logits = _logits(self.p, self.table, ids, first, count)
        return np.maximum.reduceat(logits, np.searchsorted(owner, np.arange(len(lengths))))


_SCORERS: dict[int, Scorer] = {}


def _scorer(sent) -> Scorer:
    """The scorer of this worker process; its table serves all tasks it runs."""
    params = sent.value
    if id(params) not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[id(params)] = Scorer(params)
    return _SCORERS[id(params)]


def score_of(spark: SparkSession, text: Column, params: Params | None) -> Column:
    """Score (0 to 1) of a text column, as a column."""
    if params is None:
        return F.lit(0.5)
    sent = spark.sparkContext.broadcast(params)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _scorer(sent)
        for batch in batches:
            logits = scorer(list(batch)).astype(np.float64) if len(batch) else np.empty(0)
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -50, 50))))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(F.coalesce(text.cast("string"), F.lit("")))


def held_out(doc_id: Column, of: int = 3, remainder: int = 1) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of == remainder, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, kept: Column, max_rows: int) -> DataFrame:
    """doc_id, text, label of at most ``max_rows`` labelled documents, the first by a hash of doc_id.

    A repeated doc_id comes with all its rows. ``max_rows`` bounds the broadcast side
    of the join.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(kept & F.col("label").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    return texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, kept: Column, max_rows: int) -> list[tuple[str, int]]:
    """The rows of ``labelled`` in the driver, a repeated doc_id once."""
    first = {}
    for r in labelled(docs, labels, label, kept, max_rows).sort("doc_id", "text").collect():
        first.setdefault(r.doc_id, (r.text, int(r.label)))
    return list(first.values())


def _trained(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The weights learnt from all rows of a task, as one record; none without rows."""
    rows = pd.concat([*frames, pd.DataFrame({"doc_id": [], "text": [], "label": []})])
    rows = rows.sort_values(["doc_id", "text"], kind="stable").drop_duplicates("doc_id")
    params = train([(text, int(label)) for text, label in zip(rows["text"], rows["label"])])
    if params is not None:
        data = io.BytesIO()
        np.savez(data, **params)
        yield pd.DataFrame({"weights": [data.getvalue()]})


def trained(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Params | None:
    """Trains in one task, on ``max_rows`` documents at most; only the weights reach the driver."""
    rows = labelled(docs, labels, "toxic", ~held_out(F.col("doc_id")), max_rows)
    found = rows.repartition(1).mapInPandas(_trained, "weights binary").first()
    if found is None:
        return None
    with np.load(io.BytesIO(found["weights"])) as arrays:
        return {name: arrays[name] for name in arrays.files}


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    score = score_of(docs.sparkSession, F.col("text"), trained(docs, labels, max_rows))
    return texts(docs).select("doc_id", score.alias("score")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, whose text the network does not reject."""
    bounded(docs.sparkSession)
    params = trained(docs, labels, max_rows)
    return docs.filter(score_of(docs.sparkSession, docs["text"], params) < REJECT)
