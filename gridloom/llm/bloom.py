"""Arrays of fixed size that tasks add up: compressed pieces, and Bloom filters of 64-bit keys."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textops

#: Most bits of a Bloom filter (8 MB). Beyond some millions of keys it lets more rows through, which costs time alone:
#: whoever asks it joins with the keys themselves afterwards.
BITS = 26
#: Pieces that an array is cut into.
PIECES = 64
PIECE = "chunk int, blob binary"
_U = np.uint64


def pieces(x: np.ndarray) -> pa.RecordBatch:
    """An array as rows of ``chunk, blob``."""
    step = len(x) // PIECES
    blobs = [zlib.compress(x[k * step : (k + 1) * step].tobytes(), 1) for k in range(PIECES)]
    return pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int32()), pa.array(blobs, pa.binary())], ["chunk", "blob"])


def combined(frame: DataFrame, combine, kind, size: int) -> np.ndarray:
    """The array of ``size`` elements that rows ``chunk, blob`` combine to, chunk by chunk.

    A task holds one array a chunk, however many blobs there are.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(zlib.decompress(blob), kind)
                held[chunk] = combine(held[chunk], own) if chunk in held else own
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in held.values()], pa.binary())], ["chunk", "blob"])

    out, step = np.zeros(size, kind), size // PIECES
    for row in frame.repartition(16, "chunk").mapInArrow(fold, PIECE).collect():
        out[row["chunk"] * step : (row["chunk"] + 1) * step] = np.frombuffer(zlib.decompress(row["blob"]), kind)
    return out


def _places(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for seed in range(3):
        yield (textops.mix(keys.view(np.uint64) + _U(seed)) >> _U(64 - bits)).astype(np.int64)


def build(keys: DataFrame, n: int) -> np.ndarray:
    """Packed filter of the one column of ``keys``; its size grows with their number ``n`` up to BITS."""
    bits = min(BITS, max(16, (12 * n).bit_length()))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << bits, bool)
        for batch in batches:
            for at in _places(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), bits):
                out[at] = True
        if out.any():
            yield pieces(np.packbits(out))

    return combined(keys.mapInArrow(made, PIECE), np.bitwise_or, np.uint8, (1 << bits) // 8)


def known(keys: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Which of the keys may be in the filter; none that is in it is missed."""
    bits = int(len(packed) * 8).bit_length() - 1
    ok = np.ones(len(keys), bool)
    for at in _places(keys, bits):
        ok &= (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return ok
