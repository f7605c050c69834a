"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Test items are partitioned by the size of their shingle sets into classes (u/2, u]. For a class, a long document is
read as windows of 2u shingles, one every u, so that whatever holds an item lies whole in one window and the
containment threshold turns into a Jaccard threshold that does not fall with the document's length. A window's MinHash
is the minimum of its two blocks' minima, and blocks of a larger class are made of the smaller one's, so all classes
cost one pass of each hash function over the text. One row a band (r = 1) with ``HASHES`` bands finds a
window of the lowest Jaccard that can matter with probability above 0.999. Whatever a band hits is verified: the
share of the item's distinct shingles that stand in the whole document must reach the threshold.

An item of fewer than five words has no five-word shingle: it is found wherever its words stand in a row.

Items are taken in blocks of bounded size, one at a time: each is broadcast, held against all rows, and destroyed. What
a block finds is small and is written; only where there are several blocks, ``clean`` joins it with the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops
from .scratch import Scratch

HASHES = 40
#: Shingles of a block in the smallest class; classes double from here.
SMALLEST = 2
#: Items broadcast at a time (a set of 8-byte hashes each), and shingles of them at most.
ITEMS, SHINGLES = 20_000, 2_000_000

_RNG = np.random.default_rng(77)
_MUL = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64)
_FILTER_BITS = 16


@dataclass
class Index:
    """A block of items: sorted shingle sets end to end, and for each class and band the sorted minima with their items."""

    ids: np.ndarray
    sets: np.ndarray
    first: np.ndarray
    classes: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]  # (class, band and value, item, filter)
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by words: sorted hashes of whole items, item


def _minima(s: np.ndarray, k: int) -> np.ndarray:
    return ((s * _MUL[k] + _ADD[k]) >> np.uint64(32)).astype(np.uint32)


def build(ids: list[int | None], texts: list[str | None]) -> Index:
    column = pa.array(texts, pa.string())
    w = textops.words(column)
    s, first = textops.shingles(w)
    sets = [np.unique(s[first[k] : first[k + 1]]) for k in range(len(texts))]
    kept = [k for k, x in enumerate(sets) if len(x)]
    ids, sets, counts = [ids[k] for k in kept], [sets[k] for k in kept], w.counts[kept]
    short = {}
    for n in range(1, textops.SHINGLE):
        own = np.flatnonzero(counts == n)
        if len(own):
            whole = np.array([sets[k][0] for k in own], np.uint64)
            order = np.argsort(whole, kind="stable")
            short[n] = whole[order], own[order]
    by_class: dict[int, list[int]] = {}
    for k, x in enumerate(sets):
        if counts[k] >= textops.SHINGLE:
            by_class.setdefault(max(0, int(np.ceil(np.log2(len(x) / SMALLEST)))), []).append(k)
    classes = []
    for c, members in sorted(by_class.items()):
        own = np.concatenate([sets[m] for m in members])
        starts = np.cumsum([0] + [len(sets[m]) for m in members[:-1]])
        value = np.concatenate([np.minimum.reduceat(_minima(own, k), starts) for k in range(HASHES)])
        band = np.repeat(np.arange(HASHES), len(members))
        key = (band.astype(np.uint64) << np.uint64(32)) | value.astype(np.uint64)
        order = np.argsort(key, kind="stable")
        hit = np.zeros((HASHES, 1 << _FILTER_BITS), bool)
        hit[band, value & np.uint32((1 << _FILTER_BITS) - 1)] = True
        classes.append((c, key[order], np.tile(members, HASHES)[order], hit))
    sizes = np.array([0] + [len(x) for x in sets])
    return Index(np.array(ids, object), np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.cumsum(sizes), classes, short)


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place in the ranges [low, high), with the range it comes from."""
    n = high - low
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(int(n.sum())) + np.repeat(low - (np.cumsum(n) - n), n), of


def _candidates(s: np.ndarray, first: np.ndarray, index: Index) -> np.ndarray:
    """Row * items + item of every band hit, sorted.

    Each row's blocks are padded to a multiple of the largest class's, so that a larger class's minima are
    those of even and odd neighbours. Padding and windows over a row's end can only add candidates, which verification drops.
    """
    out = [np.zeros(0, np.int64)]
    counts = np.diff(first)
    if not len(s) or not index.classes:
        return out[0]
    low_class, high_class = index.classes[0][0], index.classes[-1][0]
    block, group = SMALLEST << low_class, 1 << (high_class - low_class)
    real = -(-counts // block)
    padded = -(-real // group) * group
    real_first, padded_first = np.cumsum(real) - real, np.cumsum(padded) - padded
    order = np.arange(int(real.sum()))
    begin = np.repeat(first[:-1] - real_first * block, real) + order * block
    place = np.repeat(padded_first - real_first, real) + order
    row = np.repeat(np.arange(len(counts)), padded)
    table = {c: (keys, items, hit) for c, keys, items, hit in index.classes}
    mask = np.uint32((1 << _FILTER_BITS) - 1)
    base = np.empty(len(row), np.uint32)
    for k in range(HASHES):
        base.fill(0xFFFFFFFF)
        base[place] = np.minimum.reduceat(_minima(s, k), begin)
        low = base
        for c in range(low_class, high_class + 1):
            if c > low_class:
                low = np.minimum(low[0::2], low[1::2])
            if c not in table:
                continue
            keys, items, hit = table[c]
            window = low.copy()
            np.minimum(low[:-1], low[1:], out=window[:-1])
            at = np.flatnonzero(hit[k][window & mask])
            if not len(at):
                continue
            # a minimum that many windows of a row share counts once
            own = np.unique(row[at << (c - low_class)] << 32 | window[at].astype(np.int64))
            key = np.uint64(k << 32) | (own & 0xFFFFFFFF).astype(np.uint64)
            places, of = _ranges(np.searchsorted(keys, key), np.searchsorted(keys, key, side="right"))
            out.append(np.unique((own >> 32)[of] * len(index.ids) + items[places]))
    return np.unique(np.concatenate(out))


def _hits(part: pa.RecordBatch, index: Index, percent: int) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, shingles of the item, those found in the text) of each verified hit."""
    w = textops.words(part.column(part.schema.get_field_index("text")))
    h = textops.word_hash(w)
    s, first = textops.shingles(w, h)
    for n, (whole, items) in index.short.items():
        own, rows = textops.ngrams(w, n, h)
        places, of = _ranges(np.searchsorted(whole, own), np.searchsorted(whole, own, side="right"))
        for row, item in np.unique(np.stack((rows[of], items[places]), 1), axis=0):
            yield int(row), int(item), 1, 1
    found = _candidates(s, first, index)
    rows, items = np.divmod(found, max(1, len(index.ids)))
    for row in np.unique(rows):
        text = np.unique(s[first[row] : first[row + 1]])
        own = items[rows == row]
        for some in np.array_split(own, 1 + len(own) // 1000):  # bounds the memory of a text that many items resemble
            places, of = _ranges(index.first[some], index.first[some + 1])
            sets = index.sets[places]
            n = np.bincount(of, weights=text[np.minimum(np.searchsorted(text, sets), len(text) - 1)] == sets, minlength=len(some)).astype(np.int64)
            size = index.first[some + 1] - index.first[some]
            for k in np.flatnonzero(100 * n >= percent * size):
                yield int(row), int(some[k]), int(size[k]), int(n[k])


COLUMNS = "doc_id long, item_id long, item_shingles long, found_shingles long"


def _search(documents: DataFrame, held, percent: int) -> DataFrame:
    """``doc_id, text_hash`` and the columns of a hit, for one broadcast block."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for part in textops.slices(batches):
            hits = list(_hits(part, index, percent))
            if hits:
                row, item, size, found = zip(*hits, strict=True)
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array([None if index.ids[k] is None else int(index.ids[k]) for k in item], pa.int64()), pa.array(size, pa.int64()), pa.array(found, pa.int64())], ["doc_id", "text_hash", "item_id", "item_shingles", "found_shingles"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("text_hash"), "text")
    return docs.mapInArrow(rows, COLUMNS.replace(",", ", text_hash long,", 1))


def _text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def blocks(benchmark: DataFrame) -> Iterator[Index]:
    """The items in bounded blocks, read one block at a time in the driver; a null id stays null."""
    ids, texts, words = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        words += len(row[1] or "") // 2
        if len(ids) >= ITEMS or words >= SHINGLES:
            yield build(ids, texts)
            ids, texts, words = [], [], 0
    if ids:
        yield build(ids, texts)


def _found(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, percent: int) -> DataFrame:
    """Hits of all blocks as a table; one block at a time is in memory."""
    scratch, out = Scratch(spark, "decontaminate"), None
    for index in blocks(benchmark):
        held = spark.sparkContext.broadcast(index)
        out = scratch.add(_search(documents, held, percent), "found")
        held.destroy()
    return spark.createDataFrame([], f"text_hash long, {COLUMNS}") if out is None else out


def contaminated(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, item_id, item_shingles, found_shingles`` of each document that contains an item.

    Null and empty texts contain nothing and null items are not searched. An item of fewer than five words counts as one
    shingle and is found where its words stand in a row. Repeated rows and items repeat; null ids stay null.
    """
    return _found(spark, documents, benchmark, percent).select("doc_id", "item_id", "item_shingles", "found_shingles")


def clean(documents: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """``documents`` without those that contain an item, with all their columns."""
    spark = documents.sparkSession
    every = blocks(benchmark)
    one, more = next(every, None), next(every, None)
    if one is None:
        return documents
    if more is None:  # a filter in place
        held = spark.sparkContext.broadcast(one)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in textops.slices(batches):
                keep = np.ones(part.num_rows, bool)
                keep[[row for row, *_ in _hits(part, held.value, percent)]] = False
                yield part.filter(pa.array(keep))

        return documents.mapInArrow(rows, documents.schema)
    found = _found(spark, documents, benchmark, percent).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text")).distinct()
    return documents.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (_text_hash() == F.col("__text")), "left_anti")
