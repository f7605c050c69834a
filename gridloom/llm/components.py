"""Connected components of an edge table, with tables in the shared folder between rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Links that one task contracts at most: as many are left over, the last round takes them together.
LINKS = 200_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node) of each node but the smallest of what the links (a, b) connect."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    low = np.arange(len(nodes))
    while (low[x] != low[y]).any():
        np.minimum.at(low, np.maximum(low[x], low[y]), np.minimum(low[x], low[y]))
        while (low[low] != low).any():
            low = low[low]
    own = low != np.arange(len(nodes))
    return nodes[own], nodes[low[own]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same connections with fewer links: stars of the task's links, LINKS of them at a time."""
    a, b, held = [], [], 0

    def made() -> pa.RecordBatch:
        x, y = stars(np.concatenate(a), np.concatenate(b))
        a.clear(), b.clear()
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

    for batch in batches:
        a.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
        b.append(batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64))
        held += batch.num_rows
        if held >= LINKS:
            held = 0
            yield made()
    if a:
        yield made()


def components(edges: DataFrame, scratch: Scratch, longest: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; root is the smallest node reachable.

    Each task first contracts its own links. While more than LINKS are left, rounds alternate two star
    contractions (all larger neighbours to the smallest neighbour, then all smaller ones), which need about log2 of
    the diameter rounds and never gather a component in one task: a node's neighbours are reduced with partial
    minimums. LINKS or fewer are contracted in one task, of bounded size. Nulls, self-links and repeated links are ignored.
    """
    contract = lambda f: f.mapInArrow(_contracted, "a long, b long")
    read = edges.sparkSession.read.schema("a long, b long").parquet
    path = scratch.write(contract(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")), "contracted")
    before, n = None, read(path).count()
    for _ in range(longest):
        e = read(path)
        if n <= LINKS:
            new = scratch.write(contract(e.coalesce(1)), "contracted")
            scratch.drop(path)
            path = new
            break
        parts = 1 + n // LINKS
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        turned = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        small_low = turned.groupBy("a").agg(F.min("b").alias("m"))
        small = turned.join(small_low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        new = scratch.write(small.where("a <> b").distinct().coalesce(parts), "contracted")
        scratch.drop(path)
        path = new
        after = read(path).agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before, n = after, after[0]
    else:
        raise RuntimeError("components did not settle")
    e = read(path)
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
