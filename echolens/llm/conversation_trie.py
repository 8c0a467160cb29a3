"""Prefix trie of conversations as balanced parentheses, shard by shard.

A conversation is the sequence of its turns; a turn is a fixed-width element: a
digest of role and text, and the word count of the text. Sequences as byte strings
sort in the depth-first order of their trie, a prefix before what extends it. Equal
sequences are one row with the number and the smallest id of their members.

The sorted rows are cut into shards of a bounded number of nodes. A shard writes
its trie as balanced parentheses ("(" when a node opens, ")" when it closes) with
the excess (open minus closed) and its minimum per block, in a tree over the blocks.
``findclose`` gives the end of each subtree; the rank of leaf pairs "()" counts
leaves, and cumulative arrays over the nodes give members and savings.

Only nodes on the first or the last path of a shard, its spines, can also lie in
another shard. They are added up by the digest of their path; a shard first takes
back what it shares with the sequence before it: nodes open already are not opened
again, their text counts once, and a leaf that the next shard extends is none. All
other rows are final in their shard.

Results in edge cases: rows without ``conv_id`` are left out; a null role or text is
empty; rows that share a turn are ordered by the digest of role and text, and repeated
rows are turns of their own; a conversation without turns is a member of the root
only; an empty table gives an empty result; other columns are not read. A conversation
travels as one record of 20 bytes per turn, and the sorted id list of a node passes
through one task, in parts, since its SHA-256 is sequential.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echolens.llm.common import bounded, durable, hot_join

WORD = r"[^\x20\x09-\x0D]+"
# Bytes of a turn: 16 of its digest, 4 of its word count.
DIGEST, WIDTH = 16, 20
# Ids of a sequence travel in parts of at most 2**ID_BITS.
ID_BITS = 11
SHARD_NODES = 200_000
BLOCK = 64
SHARED, HEADS = 20, 4
EMPTY_HASH = hashlib.sha256(b"").hexdigest()
NODE = (
    "kind int, path binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, first binary, last binary"
)
COLUMNS = [c.split()[0] for c in NODE.split(", ")]
FINAL, SPINE, BOUNDARY = 0, 1, 2
VALUES = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


def sequences(conversations: DataFrame, shared: int = SHARED, heads: int = HEADS) -> DataFrame:
    """conv_id and key of every rebuilt conversation.

    The first h turns, h = crc32(conv_id) % ``heads``, come from the conversation
    conv_id - conv_id % ``shared``, the rest from its own turns after its first h.
    All conversations that share a source are dealt out together, once.
    """
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    role, text = clean("role"), clean("text")
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    element = F.concat(
        F.substring(F.sha2(content, 256), 1, 2 * DIGEST),
        F.lpad(F.hex(F.regexp_count(text, F.lit(WORD))), 2 * (WIDTH - DIGEST), "0"),
    )
    source = F.col("conv_id") - F.col("conv_id") % shared
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), element.alias("element")
    )
    own = turns.withColumn("source", source).repartition("source").groupBy("source", "conv_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("turn", "element"))), lambda t: t["element"]).alias("own")
    )
    head = F.max(F.when(F.col("conv_id") == F.col("source"), F.slice("own", 1, heads - 1))).over(Window.partitionBy("source"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    rebuilt = F.concat(
        F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h")),
        F.slice("own", F.col("h") + 1, F.greatest(F.size("own"), F.lit(1))),
    )
    return own.withColumn("head", head).withColumn("h", h).select(
        "conv_id", F.unhex(F.array_join(rebuilt, "")).alias("key")
    )


def parts(rebuilt: DataFrame) -> DataFrame:
    """key, part, n, low, ids: members of equal sequences in ascending parts of bounded size."""
    return rebuilt.groupBy("key", F.shiftright("conv_id", ID_BITS).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
    )


class Parentheses:
    """Balanced parentheses of a trie given by the depths of its nodes in preorder."""

    def __init__(self, depths: np.ndarray):
        m = len(depths)
        self.opens = 2 * np.arange(m) - depths
        step = np.full(2 * m, -1, np.int64)
        step[self.opens] = 1
        self.excess = np.cumsum(step)
        blocks = -(-2 * m // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[: 2 * m] = self.excess
        # least excess per block, then per pair of blocks, and so on
        self.least = [padded.reshape(blocks, BLOCK).min(1)]
        while len(self.least[-1]) > 1:
            level = self.least[-1]
            if len(level) % 2:
                level = self.least[-1] = np.append(level, np.iinfo(np.int64).max)
            self.least.append(level.reshape(-1, 2).min(1))
        pairs = np.zeros(2 * m + 1, np.int64)
        pairs[1:-1] = (step[:-1] == 1) & (step[1:] == -1)
        self.leaf_rank = np.cumsum(pairs)

    def _scan(self, start: np.ndarray, stop: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """First place from ``start`` on, before ``stop``, where the excess is ``goal``; -1 if none."""
        found = np.full(len(start), -1)
        todo = np.arange(len(start))
        for i in range(BLOCK):
            at = start[todo] + i
            inside = at < stop[todo]
            todo, at = todo[inside], at[inside]
            hit = self.excess[at] == goal[todo]
            found[todo[hit]] = at[hit]
            todo = todo[~hit]
            if not len(todo):
                break
        return found

    def findclose(self) -> np.ndarray:
        """Place of the closing parenthesis of every node."""
        total = len(self.excess)
        goal = self.excess[self.opens] - 1
        block = self.opens // BLOCK
        close = self._scan(self.opens + 1, np.minimum((block + 1) * BLOCK, total), goal)
        todo = np.flatnonzero(close < 0)
        at, want, level = block[todo], goal[todo], 0
        home = np.full(len(todo), -1)
        climbing, depth = np.arange(len(todo)), np.zeros(len(todo), np.int64)
        while len(climbing):
            here = at[climbing]
            right = here + 1
            fits = (here % 2 == 0) & (right < len(self.least[level]))
            fits[fits] = self.least[level][right[fits]] <= want[climbing[fits]]
            home[climbing[fits]], depth[climbing[fits]] = right[fits], level
            climbing = climbing[~fits]
            at[climbing] //= 2
            level += 1
        for level in range(int(depth.max(initial=0)), 0, -1):
            down = depth == level
            left = 2 * home[down]
            home[down] = np.where(self.least[level - 1][left] <= want[down], left, left + 1)
            depth[down] -= 1
        close[todo] = self._scan(home * BLOCK, np.minimum((home + 1) * BLOCK, total), want)
        return close


def _common(a: bytes, b: bytes) -> int:
    """Number of leading turns that two keys share."""
    n = min(len(a), len(b)) // WIDTH
    x = np.frombuffer(a[: n * WIDTH], np.uint8).reshape(n, WIDTH)
    y = np.frombuffer(b[: n * WIDTH], np.uint8).reshape(n, WIDTH)
    differ = (x != y).any(1)
    return int(differ.argmax()) if differ.any() else n


def _words(key: bytes) -> np.ndarray:
    turns = np.frombuffer(key, np.uint8).reshape(-1, WIDTH)
    return np.ascontiguousarray(turns[:, DIGEST:]).view(">u4").ravel().astype(np.int64)


def _paths(key: bytes, depth: int) -> list[bytes]:
    """Digest of each prefix of a key, of 0 to ``depth`` turns."""
    running, out = hashlib.sha256(), []
    for d in range(depth + 1):
        out.append(running.digest()[:DIGEST])
        running.update(key[d * WIDTH : (d + 1) * WIDTH])
    return out


def _taken_back(before: bytes, first: bytes) -> pd.DataFrame:
    """Spine rows that undo what a shard counts again of the sequence ``before`` it."""
    depth = _common(before, first)
    paths, words = _paths(first, depth), _words(first[: depth * WIDTH])
    again = np.zeros(depth + 1, np.int64)
    # text of the shared nodes at or below each depth; the root has none
    again[1:] = words
    saved = np.cumsum(again[::-1])[::-1]
    ended = len(before) == depth * WIDTH
    children = np.full(depth + 1, -1)
    children[-1] = 0
    return _rows(
        kind=SPINE, path=paths, depth=np.arange(depth + 1), n_convs=0, n_children=children,
        n_leaves=-1 if ended else 0, saved_tokens=saved,
    )


def _rows(**values) -> pd.DataFrame:
    n = max(len(v) for v in values.values() if isinstance(v, (list, np.ndarray)))
    full = {c: values.get(c) if isinstance(values.get(c), (list, np.ndarray)) else [values.get(c)] * n for c in COLUMNS}
    return pd.DataFrame(full, columns=COLUMNS)


class _Shard:
    """Sequences in sorted order, and the nodes they open."""

    def __init__(self):
        self.first = self.last = None
        self.depth, self.up, self.words = [0], [-1], [0]
        self.own, self.low, self.ends = [0], [None], [None]
        self.path = [0]

    def add(self, key: bytes, n: int, low: int, ends: str) -> None:
        if self.first is None:
            self.first, self.last = key, b""
        same = _common(self.last, key)
        del self.path[same + 1 :]
        for d, words in enumerate(_words(key[same * WIDTH :]).tolist(), same + 1):
            self.depth.append(d), self.up.append(self.path[-1]), self.words.append(words)
            self.own.append(0), self.low.append(None), self.ends.append(None)
            self.path.append(len(self.depth) - 1)
        node = self.path[-1]
        self.own[node], self.low[node], self.ends[node] = n, low, ends
        self.last = key

    def nodes(self) -> pd.DataFrame:
        """All nodes of the shard; those of its spines with the digests of their paths."""
        depth, up, words = (np.array(v, np.int64) for v in (self.depth, self.up, self.words))
        m = len(depth)
        trie = Parentheses(depth)
        close = trie.findclose()
        end = np.arange(m) + (close - trie.opens + 1) // 2
        total = lambda v: np.concatenate([[0], np.cumsum(v)])
        members = total(np.array(self.own, np.int64))
        n_convs = members[end] - members[:-1]
        leaves = trie.leaf_rank[close] - trie.leaf_rank[trie.opens]
        saving = total((n_convs - 1) * words)
        saved = saving[end] - saving[:-1]
        top = np.iinfo(np.int64).max
        low = np.array([top if v is None else v for v in self.low], np.int64)
        by_depth = np.argsort(-depth, kind="stable")
        for level in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1):
            if depth[level[0]]:
                np.minimum.at(low, up[level], low[level])
        children = np.bincount(up[1:], minlength=m)
        spine, paths = np.zeros(m, bool), np.full(m, None, object)
        first = np.arange(len(self.first) // WIDTH + 1)  # the first path opens first
        for at, key in ((first, self.first), (self.path, self.last)):
            spine[at] = True
            paths[at] = _paths(key, len(key) // WIDTH)
        under = np.where(up >= 0, spine[up], False)
        out = _rows(
            kind=np.where(spine, SPINE, FINAL), path=paths, parent=np.where(under, paths[up], None), conv_id=low,
            depth=depth, n_convs=n_convs, n_children=children, n_leaves=leaves, saved_tokens=saved,
            ends_sha256=self.ends,
        )
        out["parent_conv_id"] = pd.array(np.where((up >= 0) & ~under, low[up], -1), "Int64")
        out.loc[(up < 0) | under, "parent_conv_id"] = pd.NA
        return out


def _sequences(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[bytes, int, int, str]]:
    """Each key once, with its members, smallest id and the SHA-256 of the ids."""
    key, n, low, ids = None, 0, 0, None
    for frame in frames:
        for k, count, least, some in zip(frame["key"], frame["n"], frame["low"], frame["ids"]):
            k = bytes(k)
            if k != key:
                if key is not None:
                    yield key, n, low, ids.hexdigest()
                key, n, low, ids = k, 0, least, hashlib.sha256()
            elif n:
                ids.update(b",")
            n += count
            ids.update(some.encode())
    if key is not None:
        yield key, n, low, ids.hexdigest()


def _shards(most: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, first, before = _Shard(), None, None
        for key, n, low, ends in _sequences(frames):
            if shard.first is not None and len(shard.depth) >= most:
                yield shard.nodes()
                if before is not None:
                    yield _taken_back(before, shard.first)
                before, shard = shard.last, _Shard()
            first = key if first is None else first
            shard.add(key, n, low, ends)
        if first is not None:
            yield shard.nodes()
            if before is not None:
                yield _taken_back(before, shard.first)
            yield _rows(kind=[BOUNDARY], first=[first], last=[shard.last])

    return run


def _joints(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for before, first in zip(frame["before"], frame["first"]):
            yield _taken_back(bytes(before), bytes(first))


def prefix_trie(conversations: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """A row per node of the trie of the rebuilt conversations.

    ``conversations`` has conv_id, turn, role and text.
    """
    bounded(conversations.sparkSession)
    rows = durable(parts(sequences(conversations)))
    dealt = rows.repartitionByRange("key").sortWithinPartitions("key", "part")
    nodes = durable(dealt.mapInPandas(_shards(shard_nodes), NODE))
    # a row per task, in the order of their ranges
    joints = nodes.filter(F.col("kind") == BOUNDARY).select(
        "first", F.lag("last").over(Window.orderBy("first")).alias("before")
    ).filter("before is not null").mapInPandas(_joints, NODE)
    spine = durable(
        nodes.filter(F.col("kind") == SPINE).unionByName(joints)
        .groupBy("path", "depth").agg(
            F.min("conv_id").alias("conv_id"), F.max("parent").alias("parent"),
            *[F.sum(c).alias(c) for c in VALUES], F.max("ends_sha256").alias("ends_sha256"),
        )
    )
    named = ["conv_id", "depth", "parent", *VALUES, "ends_sha256"]
    below = nodes.filter((F.col("kind") == FINAL) & F.col("parent").isNotNull()).select(*named).unionByName(
        spine.filter("depth > 0").select(*named)
    )
    parents = spine.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("size"))
    columns = ["conv_id", "depth", "parent_conv_id", *VALUES]
    last = F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256")
    return (
        hot_join(below, parents, "parent", "size", ["parent_conv_id"]).select(*columns, last)
        .unionByName(
            nodes.filter((F.col("kind") == FINAL) & F.col("parent").isNull()).select(*columns, last)
        )
        .unionByName(
            spine.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint")).select(*columns, last)
        )
    )
