"""Token counts: an exact histogram of encoded lengths, and what its suffix sums answer for every context limit.

Texts are encoded once, whole, by a public tokenizer; a task sends only (length, documents) pairs, so what
is shuffled grows with distinct lengths, not with documents. Suffix sums over lengths run in two levels (blocks of
lengths, then lengths in a block), so no task holds all lengths.
"""

from __future__ import annotations

import base64
import os
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops
from .scratch import Scratch

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Lengths to a block of the two-level sums.
BLOCK = 1024
#: How a text is split before merges; a fixed value of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded_length(text: str | None, tokenizer: str = TOKENIZER) -> int:
    """Tokens of a whole text; null and empty have none."""
    return len(_encoding(tokenizer).encode_ordinary(text)) if text else 0


def histogram(documents: DataFrame, tokenizer: str = TOKENIZER, text_column: str = "text") -> DataFrame:
    """``length, n_docs`` for each encoded length that occurs. Every row counts, null texts with length 0.

    The tokenizer's file is read by the driver, which sends it to the executors. The histogram is a table of its own, so
    that whoever reads it several times doesn't encode the texts again.
    """
    spark = documents.sparkSession
    spark.sparkContext.addFile(tokenizer)
    shipped = os.path.basename(tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(SparkFiles.get(shipped)).encode_ordinary
        seen: Counter[int] = Counter()
        for part in textops.slices(batches):
            seen.update(len(encode(t)) if t else 0 for t in part.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["length", "n_docs"])

    part = documents.select(F.col(text_column).alias("text")).mapInArrow(count, "length long, n_docs long")
    return Scratch(spark, "lengths").table(part.groupBy("length").agg(F.sum("n_docs").alias("n_docs")), "histogram")


def suffix_sums(lengths: DataFrame) -> DataFrame:
    """For each length L of a histogram: its documents and tokens, and

    ``docs_at_least``, ``tokens_at_least`` (documents of L tokens or more), ``truncated_tokens`` (all tokens left when
    every document is cut to L), ``docs_cut`` (longer than L) and ``share_at_most`` (the quantile of L).
    """
    h = lengths.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens")).withColumn("block", F.floor(F.col("length") / BLOCK))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    zero = F.lit(0).cast("long")
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(after), zero).alias("d_after"), F.coalesce(F.sum("t").over(after), zero).alias("t_after"), F.sum("d").over(every).alias("docs"), F.sum("t").over(every).alias("tokens"))
    within = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    out = h.withColumn("d_in", F.sum("n_docs").over(within)).withColumn("t_in", F.sum("n_tokens").over(within)).join(blocks, "block")
    out = out.withColumn("docs_at_least", F.col("d_in") + F.col("d_after")).withColumn("tokens_at_least", F.col("t_in") + F.col("t_after"))
    return out.select(
        "length", "n_docs", "n_tokens", "docs_at_least", "tokens_at_least",
        (F.col("tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"),
        (F.col("docs_at_least") - F.col("n_docs")).alias("docs_cut"),
        ((F.col("docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("docs")).alias("share_at_most"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Total tokens when documents are cut to each context limit, and the documents that are cut."""
    frame = sums.sparkSession.createDataFrame([(int(x),) for x in limits], "context_limit long")
    each = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("context_limit")
    cut = sums.select(each, "length", "n_docs").groupBy("context_limit").agg(F.sum(F.least("length", "context_limit") * F.col("n_docs")).alias("tokens"), F.sum(F.when(F.col("length") > F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("docs_cut"))
    return frame.join(cut, "context_limit", "left").na.fill(0, ["tokens", "docs_cut"])


def quantile(sums: DataFrame, share: float) -> int | None:
    """Smallest length that at least ``share`` of the documents don't exceed."""
    return sums.where(F.col("share_at_most") >= share).agg(F.min("length")).first()[0]
