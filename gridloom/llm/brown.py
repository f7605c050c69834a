"""Brown class-based bigram language model: exchange clustering, class transitions, word emissions, smoothed scores.

The model is P(word | class) * P(class | class before), with one end token a text, which is also what stands before
the first word. Counting is distributed and covers every training text:

* words with at least 2 ** -HEAD_BITS of all training tokens (at most 2 ** HEAD_BITS words, which bounds what is
  broadcast) are the head; each task counts them in one dense vector;
* all other words are the tail. A tail word is never frequent, so its tokens are shuffled by word without skew; its exact
  count is joined back and only a sum of logarithms a document remains;
* units of the clustering are the ``HEAD_UNITS`` most frequent words and ``TAIL_UNITS`` groups of the other words, by
  their ending. Counts of unit bigrams form one matrix of fixed size, added up over tasks.

Exchange clustering then moves each unit to the class that raises the likelihood of the class bigrams most, until a sweep
moves nothing, on that matrix. Every further word of the head is then exchanged on its own: one more pass counts
the classes on its left and right, and it goes to the class that raises the likelihood most. Words of the tail, less than one
token in a million each, stay with their group. A last pass counts the bigrams of the final classes. A class's emission
probability of a word is (c + 1) / (N + V + 1) with the class's tokens N and distinct words V, so every class keeps the
place of one unknown word; transitions are smoothed by Witten-Bell.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops
from .scratch import Scratch

HEAD_BITS = 20
HEAD_UNITS, TAIL_UNITS = 1535, 512
CLASSES = 64
SWEEPS = 12
#: Words that a task counts at a time before rare ones are dropped; only frequent ones matter there.
COUNTED = 2_000_000
_BLOCKS = 64

#: Unit 0 is the end of a text.
UNITS = 1 + HEAD_UNITS + TAIL_UNITS


def held_out(doc: int | None) -> bool:
    """crc32 of the id as text, modulo 7, is 2. A null id is never held out."""
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def tokens(text: str) -> list[bytes]:
    """Words of a text: A-Z lower-cased, split at 0x20 and 0x09-0x0D."""
    return text.encode().lower().split()


def tail_unit(word: bytes) -> int:
    return 1 + HEAD_UNITS + zlib.crc32(word[-3:] if word.isascii() else word[-3:] + b"\xff") % TAIL_UNITS


def _texts(batches: Iterator[pa.RecordBatch]):
    for part in textops.slices(batches):
        yield part.column(0).to_pylist(), [t or "" for t in part.column(1).to_pylist()]


def _frequent(batches):
    """Words that may belong to the head, with their counts in this task's training texts; a null word has all tokens."""
    counts: Counter[bytes] = Counter()
    total = dropped = 0
    for ids, texts in _texts(batches):
        for doc, text in zip(ids, texts, strict=True):
            if not held_out(doc):
                words = tokens(text)
                counts.update(words)
                total += len(words) + 1
        if len(counts) > COUNTED:
            low = 1 + (total >> (HEAD_BITS + 1))
            counts = Counter({w: c for w, c in counts.items() if c > low})
            dropped += low
    low = max(2, (total >> HEAD_BITS) - dropped)
    kept = [(w, c) for w, c in counts.items() if c >= low]
    yield pa.RecordBatch.from_arrays([pa.array([None, *(w for w, _ in kept)], pa.binary()), pa.array([total, *(c for _, c in kept)], pa.int64())], ["word", "n"])


class Head:
    """Words of the head by rank, with their exact training counts once those are known."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.rank = {w: k for k, w in enumerate(words)}

    def units(self) -> np.ndarray:
        own = np.arange(1, len(self.words) + 1)
        own[HEAD_UNITS:] = [tail_unit(w) for w in self.words[HEAD_UNITS:]]
        return own

    def path(self, words: list[bytes], of_rank: np.ndarray, of_unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the words of a text (the head's size for others) and the classes of the words, an end before and after them."""
        size = len(self.words)
        rank = np.fromiter(map(self.rank.get, words, repeat(size)), np.int64, len(words))
        classes = np.zeros(len(words) + 2, np.int64)
        known = rank < size
        classes[1:-1][known] = of_rank[rank[known]]
        rare = np.flatnonzero(~known)
        if len(rare):
            classes[1 + rare] = of_unit[[tail_unit(words[k]) for k in rare]]
        return rank, classes


def _survey(batches, head: Head):
    """Rows of tail words by document, then this task's counts of head words and of unit bigrams."""
    size = len(head.words)
    units = np.concatenate((head.units(), [0]))
    counts = np.zeros(size + 1, np.int64)
    bigrams = np.zeros(UNITS * UNITS, np.int32)
    pairs: list[np.ndarray] = []
    held = 0
    names = ["doc_id", "text_hash", "word", "tf", "train", "kind", "block", "blob"]
    get = head.rank.get

    def flush():
        nonlocal held
        if pairs:
            at, n = np.unique(np.concatenate(pairs), return_counts=True)
            bigrams[at] += n.astype(np.int32)
            pairs.clear()
        held = 0

    for ids, texts in _texts(batches):
        out: list[list] = [[], [], [], [], []]
        for doc, text in zip(ids, texts, strict=True):
            words = tokens(text)
            n = len(words)
            rank = np.fromiter(map(get, words, repeat(size)), np.int64, n)
            rare = np.flatnonzero(rank == size)
            train = not held_out(doc)
            if len(rare):
                tail = [words[k] for k in rare]
                seen = Counter(tail)
                key = xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)
                out[0] += [doc] * len(seen)
                out[1] += [key] * len(seen)
                out[2] += seen.keys()
                out[3] += seen.values()
                out[4] += [train] * len(seen)
            if train:
                counts += np.bincount(rank, minlength=size + 1) if n > size // 16 else 0
                if n <= size // 16:
                    np.add.at(counts, rank, 1)
                unit = np.zeros(n + 2, np.int64)
                unit[1:-1] = units[rank]
                if len(rare):
                    unit[1 + rare] = [tail_unit(w) for w in tail]
                pairs.append((unit[:-1] * UNITS + unit[1:]).astype(np.int32))
                held += n + 1
                if held > 2_000_000:
                    flush()
        k = len(out[0])
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.int32()), pa.array(out[4], pa.bool_()), pa.array([0] * k, pa.int32()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
    flush()
    if bigrams.any():
        rows = [(1, 0, zlib.compress(counts[:size].tobytes(), 1))]
        rows += [(2, b, zlib.compress(part.tobytes(), 1)) for b, part in enumerate(np.split(bigrams, _BLOCKS))]
        k = len(rows)
        yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.bool_()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names)


def _summed(batches):
    """Partial sums of the blobs of a partition, one row a (kind, block)."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for kind, block, blob, wide in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            raw = zlib.decompress(blob)
            own = np.frombuffer(raw, np.int64 if kind == 1 or wide else np.int32).astype(np.int64)
            sums[kind, block] = sums[kind, block] + own if (kind, block) in sums else own
    keys = list(sums)
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.int32()), pa.array([b for _, b in keys], pa.int32()), pa.array([zlib.compress(sums[k].tobytes(), 1) for k in keys], pa.binary()), pa.array([True] * len(keys), pa.bool_())], ["kind", "block", "blob", "wide"])


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit: exchange clustering of a matrix of bigram counts. Unit 0 keeps class 0 for itself.

    Units begin dealt out by frequency; each in turn goes to the class with the greatest gain, ties to the lowest,
    until a sweep moves nothing.
    """
    n = bigrams.astype(np.float64)
    size = len(n)
    weight = n.sum(0) + n.sum(1)
    order = np.argsort(-weight[1:], kind="stable") + 1
    of = np.zeros(size, np.int64)
    of[order] = 1 + np.arange(size - 1) % (classes - 1)
    member = np.zeros((size, classes))
    member[np.arange(size), of] = 1
    right, left = n @ member, n.T @ member
    table = member.T @ right
    xlogx = lambda x: x * np.log(np.maximum(x, 1e-300))
    out_of, into = n.sum(1), n.sum(0)
    for _ in range(sweeps):
        moved = 0
        for w in order:
            if not weight[w]:
                continue
            a, own = of[w], n[w, w]
            r, l = right[w].copy(), left[w].copy()
            r[a] -= own
            l[a] -= own
            table[a] -= r
            table[:, a] -= l
            table[a, a] -= own
            rows, columns = table.sum(1) + l, table.sum(0) + r  # whatever class w goes to, its neighbours keep these bigrams
            gain = (xlogx(table + r) - xlogx(table)).sum(1) + (xlogx(table + l[:, None]) - xlogx(table)).sum(0)
            d = np.diag(table)
            gain += xlogx(d + r + l + own) - xlogx(d + r) - xlogx(d + l) + xlogx(d)
            gain -= xlogx(rows + out_of[w]) - xlogx(rows) + xlogx(columns + into[w]) - xlogx(columns)
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            table[b] += r
            table[:, b] += l
            table[b, b] += own
            if b != a:
                of[w] = b
                moved += 1
                right[:, a] -= n[:, w]
                right[:, b] += n[:, w]
                left[:, a] -= n[w]
                left[:, b] += n[w]
        if not moved:
            break
    return of


def _contexts(batches, head: Head, of_rank: np.ndarray, of_unit: np.ndarray):
    """For head words that are no units: how often a class stands on the left (0 on) and right (CLASSES on) of them in training texts."""
    size, held = len(head.words), 0
    keys: list[np.ndarray] = []

    def rows():
        nonlocal held
        held = 0
        at, n = np.unique(np.concatenate(keys), return_counts=True)
        keys.clear()
        rank, side = np.divmod(at, 2 * CLASSES)
        first = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1])))
        ends = pa.array(np.append(first, len(rank)), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(rank[first].astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(side.astype(np.int16))), pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int32)))], ["rank", "side", "n"])

    for ids, texts in _texts(batches):
        for doc, text in zip(ids, texts, strict=True):
            if held_out(doc):
                continue
            rank, path = head.path(tokens(text), of_rank, of_unit)
            at = np.flatnonzero((rank >= HEAD_UNITS) & (rank < size))
            if len(at):
                keys += [rank[at] * (2 * CLASSES) + path[at], rank[at] * (2 * CLASSES) + CLASSES + path[at + 2]]
                held += 2 * len(at)
        if held > 2_000_000:
            yield rows()
    if held:
        yield rows()


def best_class(left: np.ndarray, right: np.ndarray, table: np.ndarray, own: int) -> int:
    """The class to which a word goes whose neighbours' classes were counted, out of class ``own``; ties to the lowest.

    ``table`` has the bigrams of all words by class. A word that follows itself counts like any neighbour of its class.
    """
    xlogx = lambda x: x * np.log(np.maximum(x, 1e-300))
    t = table.astype(np.float64)
    t[own] = np.maximum(0, t[own] - right)
    t[:, own] = np.maximum(0, t[:, own] - left)
    rows, columns = t.sum(1) + left, t.sum(0) + right  # whatever class the word goes to, its neighbours keep these bigrams
    l, r = np.flatnonzero(left), np.flatnonzero(right)
    gain = (xlogx(t[:, r] + right[r]) - xlogx(t[:, r])).sum(1) + (xlogx(t[l] + left[l, None]) - xlogx(t[l])).sum(0)
    d = np.diag(t)
    gain += xlogx(d + right + left) - xlogx(d + right) - xlogx(d + left) + xlogx(d)
    gain -= xlogx(rows + right.sum()) - xlogx(rows) + xlogx(columns + left.sum()) - xlogx(columns)
    gain[0] = -np.inf
    best = int(np.argmax(gain))
    return best if gain[best] > gain[own] + 1e-9 else own


def _assigned(batches, table: np.ndarray, of_rank: np.ndarray):
    """``rank, cls`` of the words whose contexts came to this task."""
    slot: dict[int, int] = {}
    counts = np.zeros((1024, 2 * CLASSES))
    for batch in batches:
        ranks, sides, n = batch.column(0).to_pylist(), batch.column(1), batch.column(2)
        at = np.array([slot.setdefault(k, len(slot)) for k in ranks], np.int64)
        while len(slot) > len(counts):
            counts = np.concatenate((counts, np.zeros_like(counts)))
        np.add.at(counts, (np.repeat(at, sides.value_lengths().to_numpy(zero_copy_only=False)), sides.flatten().to_numpy(zero_copy_only=False)), n.flatten().to_numpy(zero_copy_only=False))
    found = [best_class(counts[k, :CLASSES], counts[k, CLASSES:], table, int(of_rank[rank])) for rank, k in slot.items()]
    yield pa.RecordBatch.from_arrays([pa.array(list(slot), pa.int32()), pa.array(found, pa.int32())], ["rank", "cls"])


def _between(batches, head: Head, of_rank: np.ndarray, of_unit: np.ndarray):
    """Counts of the class bigrams of this task's training texts."""
    counts = np.zeros(CLASSES * CLASSES, np.int64)
    for ids, texts in _texts(batches):
        for doc, text in zip(ids, texts, strict=True):
            if not held_out(doc):
                _, path = head.path(tokens(text), of_rank, of_unit)
                counts += np.bincount(path[:-1] * CLASSES + path[1:], minlength=len(counts))
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["pair", "n"])


class BrownModel:
    """Learns from the training rows of a table and scores all of its rows.

    Null and empty texts are a lone end token. A null id is trained on and kept. Repeated rows count and are scored one
    by one. Without training tokens N and V are 0 and every token is unknown. Other columns are ignored.
    """

    def __init__(self, spark: SparkSession, documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
        self.spark, self.scratch = spark, Scratch(spark, "brown")
        self.docs = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
        frequent = self.scratch.table(self.docs.mapInArrow(_frequent, "word binary, n long"), "frequent")
        total = frequent.where("word is null").agg(F.sum("n")).first()[0] or 0
        words = frequent.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= max(2, total >> HEAD_BITS)).collect()
        self.head = Head([bytes(r["word"]) for r in sorted(words, key=lambda r: (-r["n"], bytes(r["word"])))])
        self._count()

    def _count(self) -> None:
        held = self.spark.sparkContext.broadcast(self.head)
        survey = self.scratch.table(self.docs.mapInArrow(lambda b: _survey(b, held.value), "doc_id long, text_hash long, word binary, tf int, train boolean, kind int, block int, blob binary"), "survey")
        blobs = survey.where("kind > 0").select("kind", "block", "blob", F.lit(False).alias("wide"))
        for _ in range(2):  # partial sums where the blobs are, then sums by block
            blobs = blobs.mapInArrow(_summed, "kind int, block int, blob binary, wide boolean").repartition(_BLOCKS, "kind", "block")
        counts = np.zeros(len(self.head.words), np.int64)
        bigrams = np.zeros(UNITS * UNITS, np.int64)
        step = len(bigrams) // _BLOCKS
        for row in blobs.collect():
            own = np.frombuffer(zlib.decompress(row["blob"]), np.int64)
            if row["kind"] == 1:
                counts += own
            else:
                bigrams[row["block"] * step : (row["block"] + 1) * step] += own
        bigrams = bigrams.reshape(UNITS, UNITS)
        self.tail = survey.where("kind = 0").select("doc_id", "text_hash", "word", "tf", "train")
        tail = self.tail.where("train").groupBy("word").agg(F.sum("tf").alias("c"))
        self.tail_counts = self.scratch.table(tail, "tail")
        distinct = np.zeros(UNITS, np.int64)
        for unit, n in self.tail_counts.mapInArrow(_distinct, "unit int, n long").groupBy("unit").agg(F.sum("n")).collect():
            distinct[unit] += n
        units = self.head.units()
        self.of_unit = exchange(bigrams)
        self.of_rank = self.of_unit[units] if len(units) else np.zeros(0, np.int64)
        self._exchange_words(bigrams)
        between = self._class_bigrams()
        kinds = np.bincount(self.of_rank, weights=counts > 0, minlength=CLASSES).astype(np.int64) if len(units) else np.zeros(CLASSES, np.int64)
        np.add.at(kinds, self.of_unit, distinct)
        in_class = between.sum(0)
        texts = int(between[:, 0].sum())
        self.total, self.vocabulary = int(between.sum()), int(kinds.sum()) + (texts > 0)
        alone = (in_class + 1) / (self.total + CLASSES)
        follows = (between > 0).sum(1, keepdims=True) + 1.0
        self.transition = np.log10((between + follows * alone) / (between.sum(1, keepdims=True) + follows))
        self.room = -np.log10(in_class + kinds + 1)
        self.room[0] = 0.0  # the end's class holds nothing else
        self.counts, self.texts, self.between = counts, texts, between

    def _exchange_words(self, bigrams: np.ndarray) -> None:
        """Moves each head word that is no unit of its own to the class that its neighbours speak for."""
        if len(self.head.words) <= HEAD_UNITS:
            return
        member = np.zeros((UNITS, CLASSES))
        member[np.arange(UNITS), self.of_unit] = 1
        table = member.T @ bigrams @ member
        held = self.spark.sparkContext.broadcast((self.head, self.of_rank, self.of_unit))
        seen = self.docs.mapInArrow(lambda b: _contexts(b, *held.value), "rank int, side array<smallint>, n array<int>")
        of_rank = self.of_rank
        found = seen.repartition(_BLOCKS, "rank").mapInArrow(lambda b: _assigned(b, table, of_rank), "rank int, cls int")
        new = self.of_rank.copy()
        for r in found.collect():  # one row a head word
            new[r["rank"]] = r["cls"]
        self.of_rank = new
        held.destroy()

    def _class_bigrams(self) -> np.ndarray:
        held = self.spark.sparkContext.broadcast((self.head, self.of_rank, self.of_unit))
        out = np.zeros(CLASSES * CLASSES, np.int64)
        for r in self.docs.mapInArrow(lambda b: _between(b, *held.value), "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
            out[r["pair"]] = r["n"]
        held.destroy()
        return out.reshape(CLASSES, CLASSES)

    def scores(self) -> DataFrame:
        """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` for every row."""
        held = self.spark.sparkContext.broadcast((self.head, self.of_rank, self.of_unit, np.log10(self.counts + 1.0), self.counts > 0, self.transition, self.room, self.texts))
        columns = "doc_id long, text_hash long, held_out boolean, n_tokens long, n_known long, known_log double, class_log double"
        own = self.docs.mapInArrow(lambda b: _scored(b, *held.value), columns)
        rows = self.tail.join(self.tail_counts, "word", "left")
        c = F.coalesce("c", F.lit(0))
        rare = rows.groupBy("doc_id", "text_hash").agg(F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("rare_known"), F.sum(F.col("tf") * F.log10(c + 1.0)).alias("rare_log"))
        # rows that repeat an id and its text share one sum
        copies = own.groupBy("doc_id", "text_hash", "held_out", "n_tokens", "n_known").agg(F.count("*").alias("copies"), F.min("known_log").alias("known_log"), F.min("class_log").alias("class_log"))
        rare = rare.withColumnsRenamed({"doc_id": "rare_doc", "text_hash": "rare_hash"})
        out = copies.join(rare, F.col("doc_id").eqNullSafe(F.col("rare_doc")) & (F.col("text_hash") == F.col("rare_hash")), "left")
        rare_log, rare_known = F.coalesce(F.col("rare_log") / F.col("copies"), F.lit(0.0)), F.coalesce(F.col("rare_known") / F.col("copies"), F.lit(0.0))
        end = float(np.log10(self.texts + 1.0))
        out = out.withColumn("score", F.col("known_log") + rare_log + F.col("class_log"))
        out = out.withColumn("base_score", F.col("known_log") + rare_log + F.lit(end) - F.col("n_tokens") * F.lit(float(np.log10(self.total + self.vocabulary + 1))))
        out = out.withColumn("n_known", F.col("n_known") + F.round(rare_known).cast("long"))
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(self.total).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def _distinct(batches):
    seen: Counter[int] = Counter()
    for batch in batches:
        seen.update(map(tail_unit, batch.column(batch.schema.get_field_index("word")).to_pylist()))
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], ["unit", "n"])


def _scored(batches, head: Head, of_rank: np.ndarray, of_unit: np.ndarray, logs: np.ndarray, known: np.ndarray, transition: np.ndarray, room: np.ndarray, texts: int):
    logs, known = np.concatenate((logs, [0.0])), np.concatenate((known, [False]))
    for ids, docs in _texts(batches):
        out: list[list] = [[] for _ in range(7)]
        for doc, text in zip(ids, docs, strict=True):
            words = tokens(text)
            rank, path = head.path(words, of_rank, of_unit)
            values = (doc, xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63), held_out(doc), len(words) + 1, int(known[rank].sum()) + (texts > 0), float(logs[rank].sum()), float(transition[path[:-1], path[1:]].sum() + room[path[1:]].sum()))
            for column, x in zip(out, values, strict=True):
                column.append(x)
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["doc_id", "text_hash", "held_out", "n_tokens", "n_known", "known_log", "class_log"])
