"""SentencePiece encoding with seeded merge-dropout, and decoding.

Each candidate merge, when its turn in the agenda comes, is skipped with
probability ``dropout``, decided by a hash keyed with the seed, the text's stream,
the place of the part in the text, the part, and the candidate's place and lengths.
A text's stream is a keyed hash of doc_id; ``streams`` bounds their number if it is
set. So the same seed always gives the same segmentation, on any partitioning, while
other seeds, documents and places in a text vary it; with dropout 0 it is the
model's own encoding. Parts that no merge can join are independent. What a part gives
depends on its draws alone, so its agenda is kept as a decision trie: a node is the
candidate whose turn it is, its two branches are the agenda after the skip and after
the merge, a leaf holds the ids. All places of a block walk their tries together, a
level at a time with one hash for each, and merges are made only for a branch that
was not taken before, for all such places of a block together, a merge of each at a
time. A part gets its trie in the second block where it comes: most distinct parts
come once. Tries are held in flat arrays up to HELD entries, then
begun anew; the result does not depend on what is held.

Decoding joins the pieces. It gives back every text: a literal piece mark (U+2581),
which the model itself would turn into a blank, is encoded as its bytes here.

Results in edge cases: a null text counts as empty and has no ids; a null doc_id has
stream 0; every row of the input gives one row, repeated ones too; an empty table
gives an empty result; columns other than ``doc_id`` and ``text`` are never read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolens.llm.common import texts
from echolens.llm.packing import tokenizer_path
from echolens.llm.pieces import SHORT, SPACE, Pieces
from echolens.llm.token_counts import MODEL

DROPOUT, SEED, STREAMS = 0.1, 2024, None
# entries of the tries, parts and chunks held at a time, chunks encoded at a time
HELD, BLOCK = 20_000_000, 100_000
# longer parts are merged anew each time
LONGEST_HELD = 200
OPEN_BRANCH = 2**31 - 1
# parts merged together, and the widths they are laid out in
TOGETHER, WIDTHS = 20_000, (4, 7, 10, 14, 20, 28, SHORT)
_M64 = (1 << 64) - 1


class ManyMerges:
    """Merges of many short parts, one of each part at a time: ``Pieces.merge`` in numpy.

    Symbols are numbered; a symbol stands in the column of its first character, so the
    next one follows at its length. ``rank`` orders the scores, -1 where no piece is.
    """

    def __init__(self, pieces: Pieces):
        names = sorted(set(pieces.ids) | {c for p in pieces.ids for c in p})
        number = {s: n for n, s in enumerate(names)}
        self.none, self.base = len(names), len(names) + 1
        self.size = np.array([len(s) for s in names] + [0], np.int64)
        self.of_char = np.full(max(ord(s) for s in names if len(s) == 1) + 2, self.none, np.int32)
        for s, n in number.items():
            if len(s) == 1:
                self.of_char[ord(s)] = n
        ids = [pieces.to_ids([s]) for s in names]
        self.ids_from = np.cumsum([0, *map(len, ids)])
        self.ids = np.array([i for x in ids for i in x], np.uint32)
        order = {x: n for n, x in enumerate(sorted(set(pieces.scores.values())))}
        found = []
        for p, x in pieces.scores.items():
            for i in range(1, len(p)):
                left, right = number.get(p[:i]), number.get(p[i:])
                if left is not None and right is not None:
                    found.append((left * self.base + right, order[x], number[p]))
        keys, rank, merged = np.array(found, np.int64).reshape(-1, 3).T
        # a table with room, filled by hash, the next free place on a clash
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank, self.merged = np.full(1 << bits, -1, np.int32), np.full(1 << bits, self.none, np.int32)
        left, at = np.arange(len(keys)), self._place(keys)
        while left.size:
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[left[free]]
            done = self.keys[at] == keys[left]
            self.rank[at[done]], self.merged[at[done]] = rank[left[done]], merged[left[done]]
            left, at = left[~done], (at[~done] + 1) & self.last

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and number of the piece that two symbols make."""
        keys = left.astype(np.int64) * self.base + right
        at = self._place(keys)
        held = self.keys[at]
        look = np.flatnonzero((held != keys) & (held >= 0))
        while look.size:
            at[look] = (at[look] + 1) & self.last
            held = self.keys[at[look]]
            look = look[(held != keys[look]) & (held >= 0)]
        # a free place has neither
        return self.rank[at], self.merged[at]

    def numbers(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the characters of all parts in a row, and the length of each part."""
        points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.of_char[np.minimum(points, len(self.of_char) - 1)], np.array(list(map(len, parts)), np.int64)

    def merge(
        self, chars: np.ndarray, sizes: np.ndarray, keys: np.ndarray, most: int
    ) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids of all parts in a row, the number of ids of each, and the draws: part, candidate, skipped."""
        n, width = len(sizes), int(sizes.max()) + 1
        inside = np.arange(width) < sizes[:, None]
        symbols = np.full((n, width), self.none, np.int32)
        symbols[inside] = chars
        rank, into = np.full((n, width), -1, np.int32), np.full((n, width), self.none, np.int32)
        pairs = np.zeros_like(inside)
        pairs[:, :-1] = inside[:, 1:]
        rank[pairs], into[pairs] = self._pairs(symbols[pairs], symbols[:, 1:][pairs[:, :-1]])
        # before the first symbol stands the last column, which never holds one
        before = np.tile(np.append(width - 1, np.arange(width - 1)), (n, 1))
        flat, score, piece, front = symbols.ravel(), rank.ravel(), into.ravel(), before.ravel()
        size, active, draws = self.size, np.arange(n), []
        while active.size:
            place = rank[active].argmax(1)
            row = active * width
            live = score[row + place] >= 0
            active, place, row = active[live], place[live], row[live]
            here = row + place
            left = size[flat[here]]
            there = here + left
            right = size[flat[there]]
            candidate = (
                place.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
                + left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64)
            )
            x = (keys[active] ^ candidate) * np.uint64(0xD6E8FEB86659FD93)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            skipped = (x >> np.uint64(32)) < np.uint64(most)
            draws.append((active, candidate, skipped))
            score[here[skipped]] = -1
            go = ~skipped
            here, there, row, place = here[go], there[go], row[go], place[go]
            both = piece[here]
            flat[here], flat[there], score[there] = both, self.none, -1
            after = there + right[go]
            front[after] = place
            score[here], piece[here] = self._pairs(both, flat[after])
            previous = row + front[here]
            score[previous], piece[previous] = self._pairs(flat[previous], both)
        kept = symbols != self.none
        final = flat[kept.ravel()]
        lengths = self.ids_from[final + 1] - self.ids_from[final]
        counts = np.add.reduceat(lengths, np.cumsum(kept.sum(1)) - kept.sum(1))
        return self.ids[_ragged(self.ids_from[final], lengths)], counts, tuple(map(np.concatenate, zip(*draws)))


class DropoutEncoder:
    """Ids of texts as little-endian 32-bit bytes."""

    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED):
        self.pieces = Pieces(path)
        self.many = ManyMerges(self.pieces)
        self.dropout, self.seed = dropout, seed
        self.most = int(dropout * 2**32)
        self.mark = [self.pieces.byte_ids[b] for b in SPACE.encode()]
        self._begin()

    def _begin(self) -> None:
        """Empty tables. The empty chunk, which no text gives, stands for a literal piece mark."""
        self.known: dict[str, int] = {"": 0}
        self.numbers: dict[str, int] = {}
        self.parts: list[str] = []
        self.characters = 0
        # chunks: where their parts begin; parts: hash and root; nodes: candidate and branches; leaves: their ids
        self.chunk_from, self.chunk_parts = array("q", [0]), array("q")
        self.own, self.root, self.again = array("Q"), array("i"), bytearray()
        self.candidate, self.merged, self.skipped = array("Q"), array("i"), array("i")
        self.leaf_from, self.pool = array("q", [0]), array("I")
        self.parts.append("")
        self.own.append(0)
        self.root.append(self._leaf(self.mark))
        self.again.append(0)
        self.chunk_parts.append(0)
        self.chunk_from.append(1)

    def _held(self) -> int:
        return len(self.candidate) + len(self.pool) + 8 * (len(self.parts) + len(self.known)) + self.characters

    def _learn(self, chunk: str) -> int:
        """The number of a chunk; its parts are cut and get empty tries."""
        found = self.known.get(chunk)
        if found is not None:
            return found
        for part in self.pieces.cut(chunk):
            number = self.numbers.get(part)
            if number is None:
                number = self.numbers[part] = len(self.parts)
                self.parts.append(part)
                self.characters += len(part)
                self.own.append(xxhash.xxh3_64_intdigest(part.encode("utf-8"), self.seed & _M64))
                self.root.append(OPEN_BRANCH)
                self.again.append(0)
            self.chunk_parts.append(number)
        self.characters += len(chunk)
        self.known[chunk] = len(self.chunk_from) - 1
        self.chunk_from.append(len(self.chunk_parts))
        return self.known[chunk]

    def _leaf(self, ids: Sequence[int]) -> int:
        self.pool.extend(ids)
        self.leaf_from.append(len(self.pool))
        return 1 - len(self.leaf_from)

    def _resolve(self, part: int, key: int) -> int:
        """The leaf of a part at its place, by its trie or by merges that lengthen it."""
        node = self.root[part]
        while 0 <= node < OPEN_BRANCH:
            skipped = _draw(key, self.candidate[node]) < self.most
            node = self.skipped[node] if skipped else self.merged[node]
        if node < 0:
            return node
        text = self.parts[part]
        hold = len(text) <= LONGEST_HELD
        taken: list[tuple[int, bool]] = []
        most = self.most

        def skip(place: int, left: int, right: int) -> bool:
            candidate = (place * 0x2545F4914F6CDD1D + left * 0x9E3779B97F4A7C15 + right) & _M64
            x = (key ^ candidate) * 0xD6E8FEB86659FD93 & _M64
            skipped = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & _M64) >> 32 < most
            if hold:
                taken.append((candidate, skipped))
            return skipped

        leaf = self._leaf(self.pieces.to_ids(self.pieces.merge(list(text), skip)))
        if hold:
            self._hold(part, taken, leaf)
        return leaf

    def _hold(self, part: int, taken: Iterable[tuple[int, bool]], leaf: int) -> None:
        """Lengthen a part's trie by a path of draws."""
        table, at = self.root, part
        candidates, merges, skips = self.candidate, self.merged, self.skipped
        for candidate, skipped in taken:
            if table[at] == OPEN_BRANCH:
                table[at] = len(candidates)
                candidates.append(candidate)
                merges.append(OPEN_BRANCH)
                skips.append(OPEN_BRANCH)
            table, at = (skips if skipped else merges), table[at]
        table[at] = leaf

    def _resolve_many(self, open_: np.ndarray, parts: np.ndarray, key: np.ndarray, node: np.ndarray) -> None:
        """Leaves of the short parts among the ``open_`` places, by merges of all of them together."""
        texts = [self.parts[p] for p in parts[open_].tolist()]
        sizes = np.array(list(map(len, texts)), np.int64)
        again = np.frombuffer(self.again, np.uint8)
        seen = (again[parts[open_]] > 0) & (sizes <= LONGEST_HELD)
        again[parts[open_]] = 1
        del again  # an array that is read cannot grow
        below = 1
        for width in WIDTHS:
            rows = np.flatnonzero((sizes > below) & (sizes <= width))
            below = width
            for begin in range(0, len(rows), TOGETHER):
                some = rows[begin : begin + TOGETHER]
                chars, lengths = self.many.numbers([texts[i] for i in some.tolist()])
                known = np.logical_and.reduceat(chars != self.many.none, np.cumsum(lengths) - lengths)
                chars, lengths, some = chars[np.repeat(known, lengths)], lengths[known], some[known]
                if not len(some):
                    continue
                places = open_[some]
                ids, counts, (owner, candidate, skipped) = self.many.merge(chars, lengths, key[places], self.most)
                first = len(self.leaf_from) - 1
                ends = len(self.pool) + np.cumsum(counts)
                self.pool.frombytes(ids.tobytes())
                self.leaf_from.frombytes(ends.tobytes())
                node[places] = -1 - (first + np.arange(len(some)))
                held = seen[some]
                order = np.flatnonzero(held[owner])
                order = order[np.argsort(owner[order], kind="stable")]
                held = np.flatnonzero(held)
                cuts = np.searchsorted(owner[order], np.append(held, len(some))).tolist()
                taken = list(zip(candidate[order].tolist(), skipped[order].tolist()))
                numbers = parts[places].tolist()
                for n, row in enumerate(held.tolist()):
                    self._hold(numbers[row], taken[cuts[n] : cuts[n + 1]], -1 - (first + row))

    def __call__(self, text: str, stream: int = 0) -> bytes:
        return self.encode([text], [stream])[0].tobytes()

    def encode(self, texts: Sequence[str], streams: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text."""
        counts = np.zeros(len(texts), np.int64)
        base = np.array(
            [(self.seed * 0x9E3779B97F4A7C15 + s * 0xC2B2AE3D27D4EB4F) & _M64 for s in streams], np.uint64
        ).reshape(-1)
        out: list[np.ndarray] = []
        codes, owners, at = [], [], np.zeros(len(texts), np.uint64)

        def flush() -> None:
            if codes:
                out.append(self._block(np.array(codes, np.int64), np.repeat(*np.array(owners).T), base, at, counts))
                codes.clear()
                owners.clear()
            if self._held() > HELD:
                self._begin()

        for n, text in enumerate(texts):
            chunks = _all_chunks(text)
            while block := list(islice(chunks, BLOCK)):
                found = list(map(self.known.get, block))
                if None in found:
                    found = [self._learn(c) if f is None else f for c, f in zip(block, found)]
                codes.extend(found)
                owners.append((n, len(found)))
                if len(codes) >= BLOCK:
                    flush()
        flush()
        return (np.concatenate(out) if out else np.empty(0, "<u4")), counts

    def _block(
        self, codes: np.ndarray, owner: np.ndarray, base: np.ndarray, at: np.ndarray, counts: np.ndarray
    ) -> np.ndarray:
        """Ids of chunks; moves the next part's number and the count of ids of their texts on."""
        first = _view(self.chunk_from)
        size = first[codes + 1] - first[codes]
        parts = _view(self.chunk_parts)[_ragged(first[codes], size)]
        owner = np.repeat(owner, size)
        # the number of each part in its text; a literal mark has none
        counted = (parts != 0).astype(np.int64)
        before = np.cumsum(counted) - counted
        begins = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(np.append(begins, len(owner)))
        place = (before - np.repeat(before[begins], sizes)).astype(np.uint64) + at[owner]
        at[owner[begins]] += np.add.reduceat(counted, begins).astype(np.uint64)

        key = ((_view(self.own)[parts] ^ base[owner]) + place * np.uint64(0x165667B19E3779F9)) * np.uint64(
            0xBF58476D1CE4E5B9
        )
        key ^= key >> np.uint64(29)
        node = _view(self.root)[parts]
        candidate, merged, skipped = _view(self.candidate), _view(self.merged), _view(self.skipped)
        walking = np.flatnonzero((node >= 0) & (node < OPEN_BRANCH))
        while walking.size:
            here = node[walking]
            x = (key[walking] ^ candidate[here]) * np.uint64(0xD6E8FEB86659FD93)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            after = np.where((x >> np.uint64(32)) < np.uint64(self.most), skipped[here], merged[here])
            node[walking] = after
            walking = walking[(after >= 0) & (after < OPEN_BRANCH)]
        del candidate, merged, skipped  # arrays that are read cannot grow
        self._resolve_many(np.flatnonzero(node == OPEN_BRANCH), parts, key, node)
        for i in np.flatnonzero(node == OPEN_BRANCH).tolist():
            node[i] = self._resolve(int(parts[i]), int(key[i]))

        leaf = -node.astype(np.int64) - 1
        ends = _view(self.leaf_from)
        lengths = ends[leaf + 1] - ends[leaf]
        counts[owner[begins]] += np.add.reduceat(lengths, begins)
        return _view(self.pool)[_ragged(ends[leaf], lengths)]

    def decode(self, ids: bytes) -> str:
        raw = self.pieces.raw
        joined = b"".join([raw[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return joined[1:].decode("utf-8")


def _view(numbers: array) -> np.ndarray:
    return np.frombuffer(numbers, numbers.typecode) if len(numbers) else np.empty(0, numbers.typecode)


def _ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of ``size`` numbers, for every entry in a row."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


def _draw(key: int, candidate: int) -> int:
    x = (key ^ candidate) * 0xD6E8FEB86659FD93 & _M64
    return ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & _M64) >> 32


def _all_chunks(text: str) -> Iterator[str]:
    """Chunks of a text, an empty one for a literal piece mark."""
    if SPACE not in text:
        yield from Pieces.each_chunk(text)
        return
    for n, part in enumerate(text.split(SPACE)):
        # the blank in front belongs to the text's first part alone
        if n:
            yield ""
            yield from _without_front(part)
        else:
            yield from Pieces.chunks(part) or [SPACE]


def _without_front(part: str) -> list[str]:
    """Chunks of a part that has no blank put in front."""
    chunks = Pieces.chunks(part)
    if not chunks:
        return []
    first = chunks[0][1:]
    return [first, *chunks[1:]] if first else chunks[1:]


_ENCODERS: dict[tuple, DropoutEncoder] = {}


def _encoder(path: str, dropout: float, seed: int) -> DropoutEncoder:
    """The encoder of this worker process; its table serves all tasks it runs."""
    key = (path, dropout, seed)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = DropoutEncoder(*key)
    return _ENCODERS[key]


def encoded(
    docs: DataFrame, model: str | None = None, dropout: float = DROPOUT, seed: int = SEED, streams: int | None = STREAMS
) -> DataFrame:
    """doc_id, text and ids (little-endian 32-bit) of every row of ``docs``."""
    path = model or tokenizer_path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, dropout, seed)
        for batch in batches:
            found, counts = encode.encode(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ends = np.concatenate([[0], np.cumsum(counts)]) * 4
            ids = pa.Array.from_buffers(
                pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(found)]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids], ["doc_id", "text", "ids"])

    own = F.xxhash64(F.lit(seed), "doc_id")
    own = own if streams is None else F.pmod(own, F.lit(streams))
    stream = F.coalesce(F.when(F.col("doc_id").isNotNull(), own), F.lit(0))
    return texts(docs).select("doc_id", "text", stream.cast("bigint").alias("stream")).mapInArrow(
        run, "doc_id bigint, text string, ids binary"
    )


def decoded(ids: Column, model: str | None = None) -> Column:
    """Texts of id columns."""
    path = model or tokenizer_path(MODEL)

    def run(column: pd.Series) -> pd.Series:
        encoder = _encoder(path, DROPOUT, SEED)
        return pd.Series([encoder.decode(x) for x in column], dtype="object")

    run.__annotations__ = {"column": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(ids)


def dropout_round_trip(
    docs: DataFrame, model: str | None = None, dropout: float = DROPOUT, seed: int = SEED, streams: int | None = STREAMS
) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, ids_sha256 and lossless of every row of ``docs``."""
    ids = encoded(docs, model, dropout, seed, streams)
    return ids.select(
        "doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"), F.sha2("ids", 256).alias("ids_sha256"),
        (decoded(F.col("ids"), model) == F.col("text")).alias("lossless"),
    )
