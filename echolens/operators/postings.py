"""Document frequencies and vector lengths from packed lists of postings.

A posting says how often a term occurs in a document. A task packs those of many
documents, so that a term is shuffled once per pack instead of once per document;
all postings of a term meet in one partition, where its documents are counted and
each document's part of its squared length is summed. Terms are words and pairs of
adjacent words; an empty word stands between texts that are not adjacent.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructType

# Words of a pack, and of all documents per partition of terms: some hundred MB each.
WORDS_PER_PACK = 3_000_000
WORDS_PER_PARTITION = 8_000_000
# Odd multipliers that deal pairs of words out.
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def terms_and_lengths(docs: DataFrame, by: Sequence[str], least: float) -> DataFrame:
    """(by, _docs, _doc, keyword, _value) from (by, _docs, _doc, _words), one row per document.

    Without a keyword the value is a document's squared length, with one the number of
    documents of that keyword; only keywords in more than ``least`` of the ``_docs``
    documents of their group are given.
    """
    spark = docs.sparkSession
    words = docs.agg(F.sum(F.size("_words"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-words // WORDS_PER_PARTITION))
    doc = docs.schema["_doc"].dataType
    keys = StructType([docs.schema[c] for c in [*by, "_docs"]])
    packed = (
        StructType(keys.fields[:]).add("_part", IntegerType()).add("_terms", StringType())
        .add("_uses", ArrayType(IntegerType())).add("_ids", ArrayType(doc)).add("_tf", ArrayType(IntegerType()))
    )
    found = (
        StructType(keys.fields[:]).add("_doc", doc).add("keyword", StringType()).add("_value", DoubleType())
    )
    names = [*by, "_docs"]
    packs = docs.select(*names, "_doc", "_words").mapInArrow(_packs(names, parts), packed)
    counted = packs.repartitionById(parts, "_part").mapInArrow(_counted(names, least), found)
    return counted.groupBy(*names, "_doc", "keyword").agg(F.sum("_value").alias("_value"))


def _group_codes(table: pa.Table, names: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's group, and a row of each group."""
    codes = np.zeros(table.num_rows, np.int64)
    for name in names:
        column = table[name].combine_chunks().dictionary_encode(null_encoding="encode")
        codes = codes * max(len(column.dictionary), 1) + column.indices.to_numpy()
        codes = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    first = np.unique(codes, return_index=True)[1]
    return codes, first


def _starts(values: np.ndarray) -> np.ndarray:
    """Places where a sorted array changes."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]])


def _lists(values: pa.Array, starts: np.ndarray) -> pa.Array:
    offsets = pa.array(np.r_[starts, len(values)], pa.int32())
    return pa.ListArray.from_arrays(offsets, values)


def _packs(names: Sequence[str], parts: int):
    def pack(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        lists = table["_words"].combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        parent = np.repeat(np.arange(len(lists)), sizes)
        encoded = lists.flatten().dictionary_encode()
        code, vocabulary = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
        n = len(vocabulary)
        is_word = pc.not_equal(vocabulary, "").to_numpy(zero_copy_only=False)[code] if n else np.zeros(0, bool)
        adjacent = (parent[1:] == parent[:-1]) & is_word[1:] & is_word[:-1]
        term = np.r_[code[is_word], n + code[:-1][adjacent] * n + code[1:][adjacent]]
        where = np.r_[parent[is_word], parent[:-1][adjacent]]
        if not len(term):
            return
        terms, term = np.unique(term, return_inverse=True)
        posting, tf = np.unique(term * len(lists) + where, return_counts=True)
        term, where = np.divmod(posting, len(lists))
        # the part of a term depends on its words only
        hashes = pd.util.hash_array(vocabulary.to_numpy(zero_copy_only=False), categorize=False)
        pair = np.flatnonzero(terms >= n)
        first, second = np.divmod(terms[pair] - n, n)
        mixed = hashes[np.where(terms < n, terms, 0)]
        mixed[pair] = hashes[first] * _FIRST + hashes[second] * _SECOND
        part = ((mixed >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)
        text = pa.concat_arrays([
            vocabulary.take(pa.array(terms[: len(terms) - len(pair)])),
            pc.binary_join_element_wise(vocabulary.take(pa.array(first)), vocabulary.take(pa.array(second)), " "),
        ])
        group, a_row = _group_codes(table, names)
        slot = group[where] * parts + part[term]
        order = np.argsort(slot, kind="stable")
        slot, term, where, tf = slot[order], term[order], where[order], tf[order]
        runs = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (slot[1:] != slot[:-1])])
        uses = np.diff(np.r_[runs, len(term)])
        rows, run_rows = _starts(slot), _starts(slot[runs])
        groups = table.select(names).take(pa.array(a_row[slot[rows] // parts]))
        columns = [groups[c].combine_chunks() for c in names] + [
            pa.array(slot[rows] % parts, pa.int32()),
            pc.binary_join(_lists(text.take(pa.array(term[runs])), run_rows), "\n"),
            _lists(pa.array(uses, pa.int32()), run_rows),
            _lists(table["_doc"].combine_chunks().take(pa.array(where)), rows),
            _lists(pa.array(tf, pa.int32()), rows),
        ]
        made = pa.RecordBatch.from_arrays(columns, names=[*names, "_part", "_terms", "_uses", "_ids", "_tf"])
        for at in range(0, made.num_rows, 64):
            yield made.slice(at, 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = [], 0
        for batch in batches:
            held.append(batch)
            words += pc.sum(pc.list_value_length(batch.column("_words"))).as_py() or 0
            if words >= WORDS_PER_PACK:
                yield from pack(held)
                held, words = [], 0
        if words:
            yield from pack(held)

    return run


def _counted(names: Sequence[str], least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        group, a_row = _group_codes(table, names)
        split = pc.split_pattern(table["_terms"], "\n").combine_chunks()
        per_row = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        encoded = split.flatten().dictionary_encode()
        uses = table["_uses"].combine_chunks().flatten().to_numpy()
        # a term of a group, and the documents of its group
        key = np.repeat(group, per_row) * len(encoded.dictionary) + encoded.indices.to_numpy()
        keys, key = np.unique(key, return_inverse=True)
        frequency = np.bincount(key, uses)
        of_group, of_term = np.divmod(keys, len(encoded.dictionary))
        corpus = table["_docs"].combine_chunks().take(pa.array(a_row)).to_numpy().astype(float)[of_group]
        idf = np.log((corpus + 1) / (frequency + 1)) + 1.0
        weight = table["_tf"].combine_chunks().flatten().to_numpy() * np.repeat(idf[key], uses)
        ids = table["_ids"].combine_chunks()
        in_row = np.repeat(group, pc.list_value_length(ids).to_numpy(zero_copy_only=False))
        documents = ids.flatten().dictionary_encode(null_encoding="encode")
        spot = in_row * len(documents.dictionary) + documents.indices.to_numpy()
        spots, spot = np.unique(spot, return_inverse=True)
        lengths = np.bincount(spot, weight * weight)
        groups = table.select(names)

        def rows(at: np.ndarray, doc: pa.Array, keyword: pa.Array, value: np.ndarray) -> Iterator[pa.RecordBatch]:
            own = groups.take(pa.array(a_row[at]))
            out = pa.Table.from_arrays(
                [*[own[c] for c in names], doc, keyword, pa.array(value, pa.float64())],
                names=[*names, "_doc", "keyword", "_value"],
            )
            yield from out.combine_chunks().to_batches(max_chunksize=100_000)

        at, which = np.divmod(spots, len(documents.dictionary))
        doc = documents.dictionary.take(pa.array(which))
        yield from rows(at, doc, pa.nulls(len(at), pa.string()), lengths)
        told = np.flatnonzero(frequency > least * corpus)
        keyword = encoded.dictionary.take(pa.array(of_term[told])).cast(pa.string())
        yield from rows(of_group[told], pa.nulls(len(told), doc.type), keyword, frequency[told])

    return run
