"""Vectorised work on whole texts: Arrow batches to words, word hashes and word shingles.

A word is a run of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text with A-Z lower-cased.
Everything here is linear in the bytes of the batch, works on slices of bounded size, and knows no row cap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one slice holds at most (a longer text is a slice of its own).
SLICE_BYTES = 512 << 10
SHINGLE = 5

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: For words without punctuation: letters, digits and all bytes of non-ASCII characters.
LETTERS = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_WHOLE = np.uint64(0xD1B54A32D192ED03)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; a bijection, so it loses nothing."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64, count=n + 1, offset=column.offset * 8) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size.astype(np.int64))
        at = 0
        while at < n:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


@dataclass
class Words:
    """Words of a slice of documents: places in ``data`` (lower-cased bytes), ``doc`` the row of each, ``first`` each row's first word (n + 1)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(column: pa.Array, lower: bool = True, inner: np.ndarray = _IS_WORD) -> Words:
    raw, off = utf8(column)
    n = len(off) - 1
    data = _LOWER[raw] if lower else raw
    inside = inner[raw]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[0] = False
        before[1:] = inside[:-1]
        after[-1] = False
        after[:-1] = inside[1:]
        edges = off[:-1][off[:-1] < len(inside)]
        before[edges] = False
        after[edges[edges > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, off)
    doc = np.repeat(np.arange(n), np.diff(first))
    return Words(data, start, end, doc, first)


def word_hash(w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(w.start):
        return np.zeros(0, np.uint64)
    length = w.end - w.start
    total = int(length.sum())
    begins = np.cumsum(length) - length
    within = np.arange(total) - np.repeat(begins, length)
    powers = np.full(int(length.max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    value = _BYTE[w.data[np.repeat(w.start, length) + within]]
    value *= powers[within]
    return mix(np.add.reduceat(value, begins) + length.astype(np.uint64))


def shingles(w: Words, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of five words, in order, and the n + 1 offsets by row; fewer words make one shingle, none make none."""
    h = word_hash(w) if hashes is None else hashes
    counts = w.counts
    per = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(per)))
    if not len(h):
        return np.zeros(0, np.uint64), first
    padded = np.concatenate((h, np.zeros(SHINGLE, np.uint64)))
    mixed = padded[: len(h)] * _STEP[0]
    for k in range(1, SHINGLE):
        mixed += padded[k : k + len(h)] * _STEP[k]
    at = np.repeat(w.first[:-1] - first[:-1], per) + np.arange(int(first[-1]))
    out = mix(mixed[at])
    for row in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        own = h[w.first[row] : w.first[row + 1]]
        whole = (own * _STEP[: len(own)]).sum(keepdims=True) + _WHOLE * np.array([len(own)], np.uint64)
        out[first[row]] = mix(whole)[0]
    return out, first


def ngrams(w: Words, k: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` < SHINGLE words, and its row; the same hash as that of a text of these words alone."""
    starts = np.concatenate([np.arange(w.first[r], w.first[r + 1] - k + 1) for r in np.flatnonzero(w.counts >= k)] or [np.zeros(0, np.int64)])
    total = _WHOLE * np.full(len(starts), k, np.uint64)
    for j in range(k):
        total += hashes[starts + j] * _STEP[j]
    return mix(total), w.doc[starts]


def token_counts(column: pa.Array) -> np.ndarray:
    """Words of each text."""
    return words(column, lower=False).counts
