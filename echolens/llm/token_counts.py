"""Exact token counts at every prefix, by dynamic programming over prefixes.

The encoding of a prefix ends in exactly one token, and what stands before that
token is the encoding of the shorter prefix. Two neighbouring tokens are
possible exactly when their own concatenation is encoded as these two. So, going
through the characters, the last token of a prefix is the one vocabulary entry at
its end that is compatible with the last token of the prefix before it, and the
count is one more than that prefix's. This is linear in the length for any text.

Counts are stored as differences, one signed byte per character. Their running sum
answers every truncation and budget question about the text without encoding it
again. Chunks between blanks are independent, so known chunks are looked up in a
bounded table.

Results in edge cases: a null text counts as empty and has no token; special
strings inside texts are ordinary text; every row of the input gives one row,
repeated ones too; an empty table gives an empty result; columns other than
``doc_id`` and ``text`` are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolens.llm.common import texts
from echolens.llm.packing import tokenizer_path
from echolens.llm.pieces import Pieces

MODEL, LIMIT = "piece_bpe_32k.model", 4096
CACHED_CHUNKS, CACHED_PARTS, CACHED_PAIRS = 250_000, 900_000, 500_000


class PrefixCounter:
    """Token count at every prefix of a text."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.alone: dict[str, bool] = {}

    def _possible(self, before: str, last: str) -> bool:
        if len(self.pairs) > CACHED_PAIRS:
            self.pairs.clear()
        found = self.pairs[before, last] = self.pieces.merge(list(before + last)) == [before, last]
        return found

    def _token(self, part: str) -> bool:
        """Whether a vocabulary entry is what its own text is encoded as."""
        found = self.alone[part] = self.pieces.merge(list(part)) == [part]
        return found

    def _differences(self, chunk: str) -> bytes:
        """Count of each prefix of a chunk less that of the one before."""
        ids, longest, alone, pairs = self.pieces.ids, self.pieces.longest, self.alone, self.pairs
        counts, last, out, before = [0], [""], bytearray(), 0
        for end in range(1, len(chunk) + 1):
            for start in range(max(0, end - longest), end):
                part = chunk[start:end]
                if part in ids:
                    weight = 1
                    if end - start > 1 and not (alone[part] if part in alone else self._token(part)):
                        continue
                elif end - start > 1:
                    continue
                else:
                    weight = len(part.encode("utf-8"))
                if start:
                    pair = (last[start], part)
                    if not (pairs[pair] if pair in pairs else self._possible(*pair)):
                        continue
                count = counts[start] + weight
                counts.append(count)
                last.append(part)
                out.append((count - before) & 255)
                before = count
                break
            else:
                raise AssertionError("no token ends here")
        return bytes(out)

    def _look(self, chunk: str) -> bytes:
        if len(self.known) > CACHED_CHUNKS:
            self.known.clear()
        parts = []
        for part in self.pieces.cut(chunk):
            found = self.parts.get(part)
            if found is None:
                if len(self.parts) > CACHED_PARTS:
                    self.parts.clear()
                found = self.parts[part] = self._differences(part)
            parts.append(found)
        found = self.known[chunk] = b"".join(parts)
        return found

    def __call__(self, text: str) -> np.ndarray:
        """Differences of the counts at prefixes of 1, 2, ... characters."""
        chunks = Pieces.chunks(text)
        if not chunks:
            return np.empty(0, np.int8)
        get, look = self.known.get, self._look
        all_ = np.frombuffer(b"".join([get(c) or look(c) for c in chunks]), np.int8)
        # the blank put in front belongs to the first character
        first = all_[:2].sum(dtype=np.int8)
        return np.concatenate([[first], all_[2:]]).astype(np.int8)


_COUNTERS: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    """The counter of this worker process; its tables serve all tasks it runs."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def fitting(differences: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    counts = np.cumsum(differences, dtype=np.int64)
    if not len(counts) or counts[-1] <= budget:
        return len(counts)
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_counts(docs: DataFrame, model: str | None = None, budget: int = LIMIT, store: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_tokens, fit_chars (longest prefix within ``budget``) and,
    unless ``store`` is false, ``differences``: the count at every prefix."""
    path = model or tokenizer_path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for text in batch.column(1).to_pylist():
                found = count(text)
                row = (len(text.encode("utf-8")), int(found.sum(dtype=np.int64)), fitting(found, budget))
                for to, value in zip(out, (*row, found.tobytes() if store else None)):
                    to.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, k) for v, k in zip(out, kinds))],
                ["doc_id", "n_bytes", "n_tokens", "fit_chars", "differences"],
            )

    found = texts(docs).mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint, fit_chars bigint, differences binary"
    )
    return found if store else found.drop("differences")


def tokens_at(differences: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` characters, from stored differences."""

    def run(stored: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series(
            [int(np.frombuffer(d, np.int8)[:n].sum(dtype=np.int64)) for d, n in zip(stored, ends)], dtype="int64"
        )

    run.__annotations__ = {"stored": pd.Series, "ends": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "bigint")(differences, chars)


def chars_within(differences: Column, budget: Column) -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens, from stored differences."""

    def run(stored: pd.Series, budgets: pd.Series) -> pd.Series:
        return pd.Series(
            [fitting(np.frombuffer(d, np.int8), int(b)) for d, b in zip(stored, budgets)], dtype="int64"
        )

    run.__annotations__ = {"stored": pd.Series, "budgets": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "bigint")(differences, budget)


def token_counts(docs: DataFrame, model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars of every row of ``docs``."""
    return prefix_counts(docs, model, limit, store=False).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars"
    )
