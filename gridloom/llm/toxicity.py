"""Toxicity: cumulative-link ordinal regression over sparse text features.

P(grade >= k) = sigmoid(w . x - t_k) with one weight vector for all ordered thresholds t_1 < t_2 < t_3. The features are
words that mark the toxic class, each with its presence and its density in the text. Grade 0 is not toxic;
toxic training documents are graded 1 to 3 by thirds of the density of words that toxic labels mark. The result is the
expected grade, the sum of the three probabilities.

Training sees a bounded sample of labelled documents; scoring is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops
from .linear import labelled_sample, sigmoid
from .scratch import Scratch

#: Labelled rows of each class that training may see.
PER_CLASS = 3000
#: Words kept as features at most, training documents that a word needs, and its least standard score.
WORDS, LEAST_DOCUMENTS, LEAST_Z = 4096, 3, 3.5
GRADES = 3
#: Slope of the penalty on weights, which can't be negative: words that only come with telling words get 0.
PENALTY = 5e-4
_FILTER = 16


def word_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, word hash, count) of each distinct word without punctuation, and each row's words."""
    w = textops.words(column, inner=textops.LETTERS)
    h = textops.word_hash(w)
    order = np.lexsort((h, w.doc))
    h, doc = h[order], w.doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h))), w.counts


@dataclass
class Ordinal:
    words: np.ndarray
    presence: np.ndarray
    density: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, column: pa.Array) -> np.ndarray:
        """P(grade >= 1..3) of each text."""
        w = textops.words(column, inner=textops.LETTERS)
        total = np.zeros(len(column))
        if len(self.words) and len(w.start):
            h = textops.word_hash(w)
            known = np.zeros(1 << _FILTER, bool)
            known[(self.words & np.uint64((1 << _FILTER) - 1)).astype(np.int64)] = True
            maybe = np.flatnonzero(known[(h & np.uint64((1 << _FILTER) - 1)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.words, h[maybe]), len(self.words) - 1)
            hit = self.words[place] == h[maybe]
            key, n = np.unique(w.doc[maybe[hit]] * len(self.words) + place[hit], return_counts=True)
            row, word = key // len(self.words), key % len(self.words)
            total = np.bincount(row, weights=self.presence[word] + self.density[word] * _density(n, w.counts[row]), minlength=len(column))
        return sigmoid(total[:, None] - self.thresholds[None])


def _density(n: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.minimum(1.0, 25.0 * n / np.maximum(1, words))


def marking_words(words: DataFrame, good: int, bad: int, most: int = WORDS) -> DataFrame:
    """``word`` of the ``most`` words that mark toxic texts best, from ``word, label, texts`` (texts of that label that hold it).

    The score is the signed root of the likelihood ratio against a word that doesn't care for the label.
    """
    share = bad / (good + bad)
    sums = words.groupBy("word").agg(F.sum(F.when(F.col("label") == 1, F.col("texts")).otherwise(0)).alias("bad"), F.sum("texts").alias("both"))
    part = lambda n, expected: n * F.ln(F.greatest(n, F.lit(1)) / expected)
    b, n = F.col("bad"), F.col("both")
    ratio = part(b, n * share) + part(n - b, n * (1 - share))
    scored = sums.withColumn("z", F.signum(b - n * share) * F.sqrt(F.greatest(F.lit(0.0), 2 * ratio)))
    return scored.where((n >= LEAST_DOCUMENTS) & (F.col("z") >= LEAST_Z)).orderBy(F.desc("z"), "word").limit(most).select("word")


def fit(words: np.ndarray, row: np.ndarray, word: np.ndarray, n: np.ndarray, sizes: np.ndarray, toxic: np.ndarray) -> Ordinal:
    """From the feature words, sorted, and where they stand in labelled texts (row, word, n). Without both classes every text gets a low grade."""
    rows = len(sizes)
    low = np.array([4.0, 5.0, 6.0])
    if not rows or toxic.min() == toxic.max():
        return Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), low)
    a, b = toxic.sum(), (1 - toxic).sum()
    col = np.searchsorted(words, word)
    kept = words
    dense = _density(n, sizes[row])
    marked = np.bincount(row, weights=n, minlength=rows) / np.maximum(1, sizes)
    grade = np.zeros(rows, np.int64)
    grade[toxic == 1] = 1 + np.searchsorted(np.quantile(marked[toxic == 1], (1 / 3, 2 / 3)), marked[toxic == 1], side="left")
    over = (grade[:, None] >= np.arange(1, GRADES + 1)[None]).astype(np.float64)

    # thresholds as a first one and the logarithms of the gaps keep their order; Adam on the mean log loss
    theta = np.zeros(2 * len(kept) + GRADES)
    theta[-GRADES] = 2.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    balance = np.where(toxic == 1, 0.5 / a, 0.5 / b)
    for step in range(1, 501):
        presence, density, cut = theta[: len(kept)], theta[len(kept) : -GRADES], theta[-GRADES:]
        gaps = np.exp(np.clip(cut[1:], -5, 5))
        t = cut[0] + np.concatenate(([0.0], np.cumsum(gaps)))
        total = np.bincount(row, weights=presence[col] + density[col] * dense, minlength=rows)
        slope = balance[:, None] * (sigmoid(total[:, None] - t[None]) - over)
        by_row, by_cut = slope.sum(1), slope.sum(0)
        grad = np.concatenate((np.bincount(col, weights=by_row[row], minlength=len(kept)) + PENALTY, np.bincount(col, weights=by_row[row] * dense, minlength=len(kept)) + PENALTY, [-by_cut.sum()], [-by_cut[k + 1 :].sum() * gaps[k] for k in range(GRADES - 1)]))
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        theta -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        np.maximum(theta[:-GRADES], 0, out=theta[:-GRADES])
    cut = theta[-GRADES:]
    t = cut[0] + np.concatenate(([0.0], np.cumsum(np.exp(np.clip(cut[1:], -5, 5)))))
    return Ordinal(words, theta[: len(kept)], theta[len(kept) : -GRADES], t)


SAMPLE = "doc_id long, label int, size long, word array<long>, n array<long>"


def train(spark: SparkSession, documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most: int = WORDS) -> Ordinal:
    """From about ``per_class`` labelled documents of each class; texts that occur twice count once, as toxic if any is.

    Words are counted and chosen on the executors: the driver gets the ``most`` feature words and where they stand in the sample.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textops.slices(batches):
            row, word, n, sizes = word_counts(part.column(1))
            first = np.searchsorted(row, np.arange(part.num_rows + 1))
            pick = lambda x, t: pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, t))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(sizes, pa.int64()), pick(word.view(np.int64), pa.int64()), pick(n, pa.int64())], ["doc_id", "label", "size", "word", "n"])

    found = labelled_sample(spark, documents, ["text"], labels, "toxic", per_class)
    found = found.groupBy("text").agg(F.max(F.struct("label", -F.col("doc_id"))).alias("x")).select((-F.col("x.col2")).alias("doc_id"), "text", F.col("x.label").alias("label"))
    scratch = Scratch(spark, "toxicity")
    sample = scratch.table(found.mapInArrow(made, SAMPLE), "sample")
    count = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(count) < 2:
        return fit(*(np.zeros(0, np.uint64),) * 3, *(np.zeros(0, np.int64),) * 3)
    each = sample.select("label", F.explode("word").alias("word")).groupBy("word", "label").agg(F.count("*").alias("texts"))
    marks = scratch.table(marking_words(each, count[0], count[1], most), "words")
    words = np.sort(np.array([r["word"] for r in marks.collect()], np.int64).view(np.uint64))
    held = spark.sparkContext.broadcast(words)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, word, n = (batch.column(k) for k in (0, 3, 4))
            of = np.repeat(np.arange(len(row)), word.value_lengths().to_numpy(zero_copy_only=False))
            word, n = word.flatten().to_numpy(zero_copy_only=False).view(np.uint64), n.flatten().to_numpy(zero_copy_only=False)
            ok = np.isin(word, held.value)
            first = np.searchsorted(of[ok], np.arange(len(row) + 1))
            pick = lambda x: pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, pa.int64()))
            yield pa.RecordBatch.from_arrays([row, batch.column(1), batch.column(2), pick(word[ok].view(np.int64)), pick(n[ok])], ["doc_id", "label", "size", "word", "n"])

    got = sample.mapInArrow(marked, SAMPLE).orderBy("doc_id", "size").toArrow().combine_chunks()
    scratch.release("sample", "words")
    lists = got.column("word").combine_chunks() if len(got) else pa.array([], pa.list_(pa.int64()))
    row = np.repeat(np.arange(len(got)), lists.value_lengths().to_numpy(zero_copy_only=False))
    flat = lambda name: got.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return fit(words, row, flat("word").view(np.uint64), flat("n"), got.column("size").to_numpy(), got.column("label").to_numpy().astype(np.int64))


def score(documents: DataFrame, model: Ordinal) -> DataFrame:
    """``doc_id, p_1, p_2, p_3, severity, grade, toxic`` for each row.

    ``severity`` is the expected grade, ``grade`` the number of thresholds passed with probability one half, ``toxic``
    whether that is any. Null and empty texts have no words; repeated rows repeat; a null id stays null.
    """
    held = documents.sparkSession.sparkContext.broadcast(model)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textops.slices(batches):
            p = held.value.probabilities(part.column(1))
            grade = (p >= 0.5).sum(1)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(p[:, k]) for k in range(GRADES)), pa.array(p.sum(1)), pa.array(grade, pa.int32()), pa.array(grade > 0)], ["doc_id", "p_1", "p_2", "p_3", "severity", "grade", "toxic"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(made, "doc_id long, p_1 double, p_2 double, p_3 double, severity double, grade int, toxic boolean")
