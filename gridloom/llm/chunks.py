"""Substring deduplication by content-defined chunking with a gear rolling hash.

The gear hash of the last 16 bytes is computed at every byte of a text. A cut stands where that hash is the smallest of
some run of ``SPAN`` positions, so cuts depend on nearby bytes alone: an insertion moves no cut beyond its own
surroundings, no chunk is longer than ``SPAN`` bytes, and two texts that share a passage share its cuts except for
those within ``SPAN`` of its ends. From every cut on, the shortest run of whole chunks with at least ``LEAST`` bytes
is looked up by digest; equal digests are repeats. A passage of 2 * SPAN + LEAST + WINDOW bytes is never missed.

Two passes over the texts keep what is shuffled small. The first sends a 64-bit digest and a 32-bit hash of the place of each
run, and finds the digests that stand in several places. The second sends the runs with these alone, with a 128-bit
digest that decides. Both group with partial aggregation (a passage that a third of all documents share is one row a
task); repeated digests are joined back with their runs, and overlapping repeats in a document are merged into passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bloom, textops
from .scratch import Scratch

WINDOW = 16
#: Positions of which one at least is a cut.
SPAN = 88
#: Bytes that a looked-up run of chunks has at least; not below SPAN, or cuts beyond a passage could part its runs.
LEAST = 88
#: Bytes that a merged passage needs to be reported.
PASSAGE = 96

_GEAR = np.random.default_rng(4242).integers(0, 2**32, 256, dtype=np.uint32)
_VALUE = np.random.default_rng(4243).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_GAP = SPAN + WINDOW


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def cuts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cuts of each text (its ends included), as places in ``raw``, and the text of each cut."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    # every text stands between gaps of the same bytes, so its cuts don't depend on its neighbours
    starts = offsets[:-1] + _GAP * (np.arange(n) + 1)
    padded = np.zeros(len(raw) + _GAP * (n + 1), np.uint8)
    move = np.repeat(starts - offsets[:-1], sizes)
    padded[np.arange(len(raw)) + move] = raw
    h = _GEAR[padded]
    width = 1
    while width < WINDOW:
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    low = (h.astype(np.uint64) << np.uint64(32)) | np.arange(len(h) - 1, -1, -1, dtype=np.uint64)
    width = 1
    while width < SPAN:
        step = min(width, SPAN - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    at = len(h) - 1 - (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at = at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at
    text = np.searchsorted(starts, at, side="right") - 1
    ok = text >= 0
    ok[ok] = (at[ok] > starts[text[ok]]) & (at[ok] < starts[text[ok]] + sizes[text[ok]])
    at, text = at[ok], text[ok]
    place = np.concatenate((at - starts[text] + offsets[text], offsets[:-1], offsets[1:]))
    text = np.concatenate((text, np.arange(n), np.arange(n)))
    order = np.lexsort((place, text))
    place, text = place[order], text[order]
    keep = np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1]))) if len(place) else np.zeros(0, bool)
    return place[keep], text[keep]


def runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first byte, byte after the last, digest) of the shortest run of chunks with LEAST bytes from each cut on."""
    raw, offsets = textops.utf8(column)
    place, text = cuts(raw, offsets)
    end_of = offsets[1:][text]
    to = np.searchsorted(place, place + LEAST)
    ok = place + LEAST <= end_of
    first, last, text = place[ok], place[np.minimum(to, len(place) - 1)][ok], text[ok]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUE[raw] * _powers(_P, len(raw)), out=sums[1:])
    digest = textops.mix((sums[last] - sums[first]) * _powers(_P_INVERSE, len(raw) + 1)[first] + (last - first).astype(np.uint64))
    return text, first - offsets[text], last - offsets[text], digest


def _places(column: pa.Array, ids: pa.Array, hashes: pa.Array) -> tuple[np.ndarray, ...]:
    """(text, first, last, digest, 64-bit hash of the place) of the runs of a slice."""
    text, first, last, digest = runs(column)
    doc = ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) ^ hashes.to_numpy(zero_copy_only=False).astype(np.int64)
    return text, first, last, digest, textops.mix(textops.mix(doc[text].view(np.uint64)) + first.astype(np.uint64))


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in textops.slices(batches):
        *_, digest, place = _places(part.column(2), part.column(0), part.column(1))
        yield pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)), pa.array((place >> np.uint64(32)).astype(np.uint32).view(np.int32))], ["digest", "place"])


def _rows(batches: Iterator[pa.RecordBatch], filled: np.ndarray) -> Iterator[pa.RecordBatch]:
    for part in textops.slices(batches):
        text, first, last, digest, _ = _places(part.column(2), part.column(0), part.column(1))
        ok = bloom.known(digest, filled)
        text, first, last = text[ok], first[ok], last[ok]
        raw, offsets = textops.utf8(part.column(2))
        sums = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(offsets[text] + first, offsets[text] + last, strict=True)]
        of = pa.array(text)
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.binary()), part.column(0).take(of), part.column(1).take(of), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))], ["digest", "doc_id", "text_hash", "first", "last"])


def repeats(spark: SparkSession, documents: DataFrame, least: int = PASSAGE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Passages that occur more than once: ``doc_id, first_byte, last_byte, n_bytes, removed, keeper_doc_id``.

    Bytes are those of the text's UTF-8, the end is exclusive. Of equal stretches the one in the smallest document, at
    the smallest place, is kept (``removed`` false); all others are removed. Repeats inside a document count, if they don't
    overlap what is kept. Texts
    below LEAST bytes, null and empty texts have none. Rows with the same id and text are one document;
    different texts of one id are different documents, by order of a hash of the text; a null id is smaller than all
    others. Other columns are ignored.
    """
    scratch = Scratch(spark, "chunks")
    docs = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("text_hash"), F.col(text_column).alias("text"))
    seen = docs.mapInArrow(_seen, "digest long, place int").groupBy("digest").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    again = scratch.table(seen.where("low <> high").select("digest"), "again")
    held = spark.sparkContext.broadcast(bloom.build(again, again.count()))
    rows = scratch.table(docs.mapInArrow(lambda b: _rows(b, held.value), "digest binary, doc_id long, text_hash long, first int, last int"), "runs")
    held.destroy()
    place = F.struct("doc_id", "text_hash", "first", "last")
    within = lambda a, b: (F.col(f"{a}.first") < F.col(f"{b}.last")) & F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))
    known = rows.groupBy("digest").agg(F.min(place).alias("low"), F.max(place).alias("high")).where(~within("high", "low")).select("digest", "low")
    known = scratch.table(known, "repeated")  # a table of its own, so that the join below may split a digest with very many rows
    same = rows.withColumn("own", place).join(known, "digest").withColumn("removed", F.col("own") != F.col("low"))
    same = same.where(~(F.col("removed") & within("own", "low")))
    document = ["doc_id", "text_hash", "removed"]
    same = same.groupBy(*document, "first", "last").agg(F.min("low.doc_id").alias("keeper"))  # rows that repeat a document are one
    order = Window.partitionBy(*document).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    same = same.withColumn("opens", F.when(F.col("first") <= reach, 0).otherwise(1))
    same = same.withColumn("passage", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = same.groupBy(*document, "passage").agg(F.min("first").alias("first_byte"), F.max("last").alias("last_byte"), F.min("keeper").alias("keeper_doc_id"))
    out = out.withColumn("n_bytes", F.col("last_byte") - F.col("first_byte")).where(F.col("n_bytes") >= least)
    return out.select("doc_id", "first_byte", "last_byte", "n_bytes", "removed", "keeper_doc_id")


def without(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """A text without the given byte spans; what is cut inside a character is dropped with it."""
    if text is None:
        return None
    raw, out, at = text.encode(), [], 0
    for a, b in sorted(spans):
        out.append(raw[at : max(a, at)])
        at = max(at, b)
    return b"".join([*out, raw[at:]]).decode(errors="ignore")
