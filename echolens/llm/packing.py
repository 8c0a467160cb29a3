"""Token sequences by hierarchical residual best-fit packing.

Texts are encoded where they are read; only (doc_id, piece, length) is packed.
Level 0: pieces are dealt to groups by a hash and each group packs its pieces
best-fit, longest first. Full bins are emitted. Of the others the RISING least full
become items of the next level, and the rest, which hardly gain from another
round, are emitted too. Groups merge ``fan_in`` to one and pack the items that rose
best-fit again, whole bins joining each other, until one group is left. So a group
never holds more than PIECES_PER_GROUP or fan_in * RISING items (on average, by the
hash), whatever the size of the input and the lengths in it.

Results in edge cases: a null text counts as empty and gives the end token alone;
rows without ``doc_id`` or with a repeated one are packed like others, each row in
its own place; an empty table gives an empty result; columns other than
``doc_id`` and ``text`` are never read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolens.llm.common import durable, texts

CAPACITY = 2048
END_TOKEN = 0
FAN_IN = 16
RISING = 4000
PIECES_PER_GROUP = 50_000
CACHED_PARTS = 1_000_000
# Characters that are their own NFC form and whose lower case is one character.
LATIN = regex.compile("[\x00-\u012F\u0131-\u024F]*")
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit bytes, by a table of known parts.

    The tokenizer drops white space and never joins the parts into which its own
    pattern splits a text, so a text's ids are those of its parts, one after the
    other. Texts of Latin letters are split here, lower case, by that pattern. Others
    are split at blanks only, and their words left to the tokenizer. The table is
    bounded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            steps = json.load(f)["pre_tokenizer"]["pretokenizers"]
        self.split = regex.compile(next(x["pattern"]["Regex"] for x in steps if x["type"] == "Split"))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts: dict[str, bytes] = {}

    def _cut(self, text: str) -> list[str]:
        if LATIN.fullmatch(text) and not any(x in text for x in self.special):
            return self.split.findall(text.lower())
        # a blank in front tells these words from parts of Latin texts
        return [" " + w for w in text.split(" ") if w]

    def _learn(self, parts: list[str]) -> None:
        """Encode parts of one kind: each is one match of the pattern, or each a word."""
        if not parts:
            return
        if parts[0][0] == " ":
            encoded = self.tokenizer.encode([p[1:] for p in parts], is_pretokenized=True, add_special_tokens=False)
        else:
            encoded = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        ids = np.array(encoded.ids, "<u4")
        at = np.array(encoded.word_ids, np.int64)
        ends = (4 * np.searchsorted(at, np.arange(len(parts)), side="right")).tolist()
        raw, start = ids.tobytes(), 0
        for part, end in zip(parts, ends):
            self.parts[part] = raw[start:end]
            start = end

    def __call__(self, texts_: list[str]) -> list[bytes]:
        if len(self.parts) > CACHED_PARTS:
            self.parts.clear()
        parts = self.parts
        cut = [self._cut(t) for t in texts_]
        new = set().union(*cut).difference(parts)
        self._learn([p for p in new if p[0] != " "])
        self._learn([p for p in new if p[0] == " "])
        return [b"".join([parts[p] for p in x]) for x in cut]


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """The encoder of this worker process; its tables serve all tasks it runs."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _pieces(capacity: int, end_token: int, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end = np.array([end_token], "<u4").tobytes()
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(batch.column(1).to_pylist())):
                ids += end
                for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    for to, value in zip(out, (doc_id, piece, start, len(part) // 4, zlib.crc32(part))):
                        to.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def pieces(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_token: int = END_TOKEN
) -> DataFrame:
    """Each document's ids and an end token, cut into pieces of at most ``capacity``.

    ``tokenizer`` is the path of a ``tokenizers`` file whose words white space
    separates; the same path must exist on all executors.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return texts(docs).mapInArrow(_pieces(capacity, end_token, path), schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the bins' loads: longest first, each item
    into the fullest open bin that takes it."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free tokens
    free: list[int] = []
    mask = 0  # bit r: some bin has r tokens free
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        above = mask >> size
        if above:
            r = size + (above & -above).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask ^= 1 << r
        else:
            b, r = len(free), capacity
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - r
        left = free[b] = r - size
        if left:
            room[left].append(b)
            mask |= 1 << left
    return bins, offsets, capacity - np.array(free, np.int64)


def _level(capacity: int, rising: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("item", kind="stable")
        bins, offsets, loads = best_fit(group["length"].to_numpy(), capacity)
        up = np.zeros(len(loads), bool)
        up[np.argsort(loads, kind="stable")[:rising]] = True
        up &= loads < capacity
        return pd.DataFrame(
            {
                "item": group["item"], "grp": np.int64(key[0]), "bin": bins, "inner": offsets,
                "load": loads[bins], "up": up[bins],
            }
        )

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, fan_in: int = FAN_IN, group_size: int = PIECES_PER_GROUP) -> DataFrame:
    """(item, sequence_id, offset) of ``items`` (item, length), lengths 1 to ``capacity``."""
    groups = max(1, -(-items.count() // group_size))
    level, done, moves = 0, None, None
    current = items.select("item", "length", F.pmod(F.xxhash64("item"), F.lit(groups)).alias("grp"))
    schema = "item bigint, grp bigint, bin bigint, inner bigint, load bigint, up boolean"
    while True:
        last = groups == 1
        run = _level(capacity, 0 if last else RISING)
        placed = current.groupBy("grp").applyInPandas(run, schema)
        # a bin's name: level, group and number in the group
        name = F.lit(level << 58) + F.shiftleft("grp", 26) + F.col("bin")
        placed = durable(placed.select("item", "grp", name.alias("name"), "inner", "load", "up"))
        if moves is None:
            where = placed.select("item", "name", F.col("inner").alias("offset"), "up")
        else:
            into = placed.select(F.col("item").alias("name"), F.col("name").alias("to"), "inner", "up")
            where = durable(
                moves.join(into, "name").select(
                    "item", F.col("to").alias("name"), (F.col("offset") + F.col("inner")).alias("offset"), "up"
                )
            )
        full = where.filter(~F.col("up")).select("item", F.col("name").alias("sequence_id"), "offset")
        done = full if done is None else done.union(full)
        if last:
            return done
        moves = where.filter("up").select("item", "name", "offset")
        groups, level = -(-groups // fan_in), level + 1
        current = (
            placed.filter("up").groupBy("name").agg(F.max("load").alias("length"), F.max("grp").alias("grp"))
            .select(F.col("name").alias("item"), "length", F.expr(f"grp div {fan_in}").alias("grp"))
        )


def packed(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
    end_token: int = END_TOKEN,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = durable(
        pieces(docs, tokenizer, capacity, end_token)
        .withColumn("item", F.monotonically_increasing_id())
    )
    where = pack(cut.select("item", "length"), capacity)
    return cut.join(where, "item").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
