"""Exact n-gram Jaccard join by vertical partitioning.

The distinct five-word shingles of all texts are put in one global order (rare before frequent, then by hash).
That order is cut into fragments; a text's set falls into one segment a fragment. Overlaps of a candidate pair are
counted segment by segment, each fragment on its own, and summed per pair.

How it keeps to linear work:

* texts with the same set form one class (a 128-bit digest of the set, and its size); only classes are compared, and
  copies never become pairs;
* frequencies for the order come from a fixed-size count sketch over all texts (any global order is correct, a
  frequency order is fast), so passages that many texts share stand at the end of every set;
* candidates share a shingle of their prefixes (|x| - ceil(t|x|) + 1 first ones) and pass the length and position
  filters, which lose no pair with similarity >= t;
* segments are written once, for one text of each class that a pair may need, and joined by class;
* in a first round each prefix shingle pairs only neighbours by (size, class), a number of pairs linear in the
  index; links make components. In the next rounds a class outside its shingle's largest component meets a few random
  members of that component. The last round compares all classes whose components still differ, each
  shingle's minority against the rest. Pairs within one component need no look, so no group's square is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bloom, textops
from .components import components
from .scratch import Scratch

#: Buckets of the frequency sketch: 2 ** this many one-byte levels are broadcast (1 MB at any input size).
SKETCH_BITS = 20
FRAGMENTS = 4
#: Neighbours that a class is paired with in the first round, for each of its prefix shingles.
NEIGHBOURS = 3
#: Rounds in which classes meet members of a larger component: places around it that a token offers, and members that a class meets.
STAR_ROUNDS = ((8, 32), (48, 2048))
#: Pairs for each index row below which the last round may begin: more would rather be thinned by meetings first.
LAST_PAIRS = 64
#: Rows to a task of the small tables between rounds, and of segments; Spark would else cut them into as many tasks as large tables.
TASK_ROWS, TASK_SEGMENTS = 20_000, 2_000
#: A prefix shingle that may stand in more classes than this is salted.
SALT_ABOVE = 1 << 13

_U = np.uint64


def _need(n, percent: int):
    """Smallest overlap that a set of n needs with any set of similarity >= percent / 100."""
    return (percent * n + 99) // 100


def _sets(batches: Iterator[pa.RecordBatch]):
    """(row, sorted distinct shingle hashes) of each row of each slice; the slice comes with its first row."""
    for part in textops.slices(batches):
        s, first = textops.shingles(textops.words(part.column(part.schema.get_field_index("text"))))
        for k in range(part.num_rows):
            yield part, k, np.unique(s[first[k] : first[k + 1]])


def _class_of(u: np.ndarray) -> tuple[int, int]:
    """A 128-bit digest of a set as two signed numbers; the empty set has zeros."""
    if not len(u):
        return 0, 0
    h = xxhash.xxh3_128_intdigest(u.tobytes())
    return (h >> 64) - (1 << 63), (h & (2**64 - 1)) - (1 << 63)


SURVEY = "doc_id long, text_hash long, hi long, lo long, n int, marks binary, chunk int, blob binary"


def _survey(batches):
    """A row for each text, then this task's frequency sketch in compressed chunks."""
    names = [x.split()[0] for x in SURVEY.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary()]
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    out: list[list] = [[] for _ in range(6)]
    block: list[np.ndarray] = []

    def flush():
        if block:
            np.add(counts, np.bincount((np.concatenate(block) >> _U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts)), out=counts)
            block.clear()

    def rows():
        made = pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip(out, kinds, strict=False)), pa.nulls(len(out[0]), pa.int32()), pa.nulls(len(out[0]), pa.binary())], names)
        for x in out:
            x.clear()
        return made

    held, of = 0, None
    for part, k, u in _sets(batches):
        if part is not of:
            of, ids, keys = part, part.column(0).to_pylist(), part.column(2).to_pylist()
        marks = np.minimum(255, np.bincount((u >> _U(56)).astype(np.int64), minlength=256)).astype(np.uint8).tobytes() if len(u) else None
        for column, x in zip(out, (ids[k], keys[k], *_class_of(u), len(u), marks), strict=True):
            column.append(x)
        block.append(u)
        held += len(u)
        if held > 1 << 20:
            flush()
            held = 0
        if len(out[0]) >= 20000:
            yield rows()
    flush()
    if out[0]:
        yield rows()
    if counts.any():
        own = bloom.pieces(counts)
        yield pa.RecordBatch.from_arrays([*(pa.nulls(own.num_rows, t) for t in kinds[:6]), *own.columns], names)


def _levels(survey: DataFrame) -> np.ndarray:
    """One byte a bucket: the count's logarithm in quarters of a power of two."""
    counts = bloom.combined(survey.where("chunk is not null").select("chunk", "blob"), np.add, np.int64, 1 << SKETCH_BITS)
    return np.minimum(255, np.floor(4 * np.log2(np.maximum(counts, 1)))).astype(np.uint8)


def _order(u: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Place of each shingle in the global order; equal places fall back on the hash."""
    return (levels[(u >> _U(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << _U(56)) | (u >> _U(8))


def _pivots(levels: np.ndarray) -> np.ndarray:
    """Cuts of the global order into fragments of about equal weight, from the sketch alone."""
    weight = np.bincount(levels, weights=np.exp2(levels / 4.0), minlength=256)
    ends = np.cumsum(weight)
    cuts = []
    for k in range(1, FRAGMENTS):
        goal = ends[-1] * k / FRAGMENTS
        level = int(np.searchsorted(ends, goal))
        share = (goal - (ends[level] - weight[level])) / max(weight[level], 1e-9)
        cuts.append((level << 56) | min((1 << 56) - 1, int(share * (1 << 56))))
    return np.array(cuts, np.uint64)


def _prefixes(batches, levels: np.ndarray, percent: int, above: int):
    """The prefix of each class in this task: ``token, hi, lo, n, pos, salt, parts``."""
    names = ["token", "hi", "lo", "n", "pos", "salt", "parts"]
    seen: set[tuple[int, int]] = set()
    out: list[list] = [[] for _ in names]
    held = 0

    def rows():
        nonlocal held
        held = 0
        token, hi, lo, n, pos, salt, parts = (np.concatenate(x) for x in out)
        for x in out:
            x.clear()
        return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(hi), pa.array(lo), pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32)), pa.array(salt.astype(np.int32)), pa.array(parts)], names)

    for _, _, u in _sets(batches):
        n = len(u)
        if not n or (cls := _class_of(u)) in seen:
            continue
        seen.add(cls)
        place = _order(u, levels)
        take = n - _need(n, percent) + 1
        at = np.argsort(place, kind="stable")[:take]
        token = u[at]
        parts = np.exp2(np.maximum(0, np.ceil((place[at] >> _U(56)).astype(np.float64) / 4 - np.log2(above)))).astype(np.uint64)
        salt = np.where(parts > 1, textops.mix(token ^ _U(cls[1] & (2**64 - 1))) % parts, _U(0))
        for column, x in zip(out, (token, np.full(take, cls[0], np.int64), np.full(take, cls[1], np.int64), np.full(take, n), np.arange(take), salt, parts > 1), strict=True):
            column.append(x)
        held += take
        if held > 100_000:
            yield rows()
    if held:
        yield rows()


def _segments(batches, levels: np.ndarray, pivots: np.ndarray, filled: np.ndarray):
    """``hi, lo, n, fragment, segment`` of the texts whose hash the filter knows, each class once a task."""

    def wanted():
        for batch in batches:
            ok = bloom.known(batch.column(batch.schema.get_field_index("text_hash")).to_numpy(zero_copy_only=False).astype(np.int64), filled)
            if ok.any():
                yield batch.filter(pa.array(ok))

    out: list[list] = [[] for _ in range(5)]
    seen: set[tuple[int, int]] = set()
    held = 0

    def rows():
        nonlocal held
        held = 0
        made = pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32()), pa.array(out[4], pa.list_(pa.int64()))], ["hi", "lo", "n", "fragment", "segment"])
        for x in out:
            x.clear()
        return made

    for _, _, u in _sets(wanted()):
        if not len(u) or (cls := _class_of(u)) in seen:
            continue
        seen.add(cls)
        place = _order(u, levels)
        at = np.argsort(place, kind="stable")
        for k, seg in enumerate(np.split(u[at], np.searchsorted(place[at], pivots))):
            if len(seg):
                for column, x in zip(out, (*cls, len(u), k, seg.view(np.int64)), strict=True):
                    column.append(x)
                held += len(seg)
        if held > 100_000:
            yield rows()
    if held:
        yield rows()


def _of_classes(batches, filled: np.ndarray):
    for batch in batches:
        yield batch.filter(pa.array(bloom.known(batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64), filled)))


def _possible(batches, percent: int):
    """Pairs whose overlap can reach the threshold: at most the sum over 256 ranges of hashes of the smaller of both counts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch.to_pydict()
        counts = [np.frombuffer(b"".join(rows[c]), np.uint8).reshape(-1, 256).astype(np.int64) for c in ("a_marks", "b_marks")]
        for c in counts:
            c[c == 255] = 1 << 40  # 255 and more
        most = np.minimum(*counts).sum(1)
        size = np.array(rows["a_n"], np.int64) + np.array(rows["b_n"], np.int64)
        yield batch.filter(pa.array(most * (100 + percent) >= percent * size)).select(["a", "b", "a_n", "b_n"])


class JaccardJoin:
    """Links texts whose distinct five-word shingles overlap by ``percent`` of their union or more.

    Nulls and empty texts have the empty set and link with nothing. A text without an id links others like any text,
    but names no component; a component without any id has a null one. Rows that repeat an id with another text are texts of
    their own. Repeated rows and copies are one class. Other columns of the input are ignored.
    """

    def __init__(self, spark: SparkSession, documents: DataFrame, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"):
        if not 0 < percent <= 100:
            raise ValueError("percent must lie in 1..100")
        self.spark, self.percent = spark, percent
        self.scratch = Scratch(spark, "jaccard")
        self.docs = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), text_hash(F.col(text_column)).alias("text_hash"))
        survey = self.scratch.table(self.docs.mapInArrow(_survey, SURVEY), "survey")
        self.levels = _levels(survey)
        self.members = survey.where("chunk is null").select("doc_id", "text_hash", "hi", "lo", "n")
        #: One row a class: a number, its size, smallest document, the hash of one of its texts, and counts of its shingles by range of the hash.
        classes = survey.where("chunk is null and n > 0").groupBy("hi", "lo", "n").agg(F.min("doc_id").alias("rep"), F.min("text_hash").alias("text_hash"), F.min("marks").alias("marks"))
        self.classes = self.scratch.table(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")

    def _index(self) -> DataFrame:
        """Rows ``token, salt, parts, cls, n, pos`` of the prefixes whose token stands in several classes of like size."""
        held, percent, above = self.spark.sparkContext.broadcast(self.levels), self.percent, SALT_ABOVE
        rows = self.docs.select("text").mapInArrow(lambda b: _prefixes(b, held.value, percent, above), "token long, hi long, lo long, n int, pos int, salt int, parts boolean")
        run = Window.partitionBy("token", "salt").orderBy("n", "hi", "lo")
        # each task gives a class once, so copies in several tasks give equal rows
        rows = rows.withColumn("same", F.lag(F.struct("hi", "lo")).over(run)).where(F.col("same").isNull() | (F.col("same") != F.struct("hi", "lo"))).drop("same")
        # a class whose neighbours by size are all too far off has no partner here; one of a split token may have it elsewhere
        low = F.lit(100) * F.lag("n").over(run) >= F.lit(percent) * F.col("n")
        high = F.lit(100) * F.col("n") >= F.lit(percent) * F.lead("n").over(run)
        rows = rows.withColumn("near", F.coalesce(low, F.lit(False)) | F.coalesce(high, F.lit(False))).where("parts or near")
        rows = rows.join(self.classes.select("hi", "lo", "n", "cls"), ["hi", "lo", "n"])
        out = self.scratch.table(rows.select("token", "salt", "parts", "cls", "n", "pos"), "index")
        held.destroy()
        return out

    def _few(self, frame: DataFrame, rows: int, each: int = TASK_ROWS) -> DataFrame:
        """The frame in tasks of about ``each`` rows, in no more than it has."""
        return frame.coalesce(1 + rows // each)

    def _fetch(self, needed: DataFrame, most: int) -> None:
        """Writes the segments, by fragment, of one text of each class of ``needed (cls)``; a class may stand there once a task."""
        s, sc = self.scratch, self.spark.sparkContext
        keys = s.table(self._few(self.sides.join(needed.distinct(), "cls").select("text_hash"), most), "needed")
        held = sc.broadcast((self.levels, _pivots(self.levels), bloom.build(keys, s.rows("needed"))))
        cut = self.docs.select("text", "text_hash").mapInArrow(lambda b: _segments(b, *held.value), "hi long, lo long, n int, fragment int, segment array<long>")
        self.segments = s.table(cut, "segments")
        held.destroy()

    def _may_link(self, a_n, a_pos, b_n, b_pos):
        """Length and position filters."""
        p = self.percent
        low, high = F.least(a_n, b_n), F.greatest(a_n, b_n)
        need = F.ceil(F.lit(p) * (a_n + b_n) / F.lit(100 + p))
        return (F.lit(100) * low >= F.lit(p) * high) & (F.least(a_n - a_pos, b_n - b_pos) >= need)

    def _plausible(self, pairs: DataFrame, rows: int) -> tuple[DataFrame, int]:
        """Those of the ``pairs (a, b)`` of classes that may link by the counts of their shingles, with both sizes; and how many they are."""
        s, percent = self.scratch, self.percent
        side = lambda x: self.sides.select(F.col("cls").alias(x), F.col("n").alias(f"{x}_n"), F.col("marks").alias(f"{x}_marks"))
        both = self._few(self._few(pairs.join(side("a"), "a"), rows).join(side("b"), "b"), rows)
        s.release("pairs")
        found = s.table(both.mapInArrow(lambda r: _possible(r, percent), "a long, b long, a_n int, b_n int"), "pairs")
        return found, s.rows("pairs")

    def _linked(self, pairs: DataFrame, rows: int) -> DataFrame:
        """Links so far with those of the plausible pairs that link: their exact overlap is summed over the fragments."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        digests = self._few(self.sides.join(ends, "cls").select("cls", "hi", "lo", "n"), 2 * rows)
        # only segments of these pairs' classes are shuffled
        held = self.spark.sparkContext.broadcast(bloom.build(digests.select("lo"), 2 * rows))
        segments = self.segments.mapInArrow(lambda b: _of_classes(b, held.value), self.segments.schema)
        segments = segments.join(digests, ["hi", "lo", "n"]).groupBy("cls", "fragment").agg(F.first("segment").alias("segment"))
        segments = self._few(segments, 2 * FRAGMENTS * rows, TASK_SEGMENTS)
        seg = lambda x: segments.select(F.col("cls").alias(x), "fragment", F.col("segment").alias(f"{x}_seg"))
        partial = pairs
        for x, on in (("a", "a"), ("b", ["b", "fragment"])):
            partial = self._few(partial.join(seg(x), on), FRAGMENTS * rows, TASK_SEGMENTS)
        total = partial.withColumn("part", F.size(F.array_intersect("a_seg", "b_seg"))).groupBy("a", "b", "a_n", "b_n").agg(F.sum("part").alias("overlap"))
        links = total.where(F.lit(100) * F.col("overlap") >= F.lit(self.percent) * (F.col("a_n") + F.col("b_n") - F.col("overlap"))).select("a", "b")
        links = self.scratch.add(self._few(links, rows), "links")
        held.destroy()
        return links

    def components(self) -> DataFrame:
        """``(cls, root)`` of the classes that link with another class."""
        s = self.scratch
        index = self._index()
        n = s.rows("index")
        self.sides = s.table(self._few(self.classes.join(index.select("cls").distinct(), "cls").select("cls", "hi", "lo", "n", "text_hash", "marks"), n), "sides")
        run = Window.partitionBy("token", "salt").orderBy("n", "cls")
        back = F.array_compact(F.array(*[F.lag(F.struct("cls", "n", "pos"), k).over(run) for k in range(1, NEIGHBOURS + 1)]))
        near = index.withColumn("backs", back).withColumn("back", F.explode("backs")).where(self._may_link(F.col("back.n"), F.col("back.pos"), F.col("n"), F.col("pos")))
        near = self._few(near.select(F.least("cls", "back.cls").alias("a"), F.greatest("cls", "back.cls").alias("b")), n)
        seen = s.add(self._few(near.distinct(), n), "seen")
        # all pairs of a token with few classes have been seen, unless it is split: copies make it frequent, and few classes may lie apart
        parts = self._few(index.groupBy("token", "salt").agg(F.count("*").alias("k")), n)
        many = parts.groupBy("token").agg(F.sum("k").alias("k"), F.count("*").alias("salts")).where((F.col("k") > NEIGHBOURS + 1) | (F.col("salts") > 1)).select("token")
        salts = s.table(self._few(parts.select("token", "salt").join(many, "token"), n), "salts")  # joins by both split a token with very many rows
        index = s.table(self._few(index.join(salts, ["token", "salt"]), n), "mixed index")
        n = s.rows("mixed index")
        s.release("index")
        pairs, rows = self._plausible(seen, s.rows("seen"))
        self._fetch(pairs.select(F.explode(F.array("a", "b")).alias("cls")).union(index.select("cls")), 2 * rows + n)
        links = self._linked(pairs, rows)
        rooted = self._rooted(index, links, salts, n)
        for turn, (offered, met_most) in enumerate(STAR_ROUNDS):
            few = F.col("root") != F.col("main")
            each = rooted.groupBy("token").agg((F.count(F.when(few, 1)) * F.count("*")).alias("pairs"))
            if (self._few(each, n).agg(F.sum("pairs")).first()[0] or 0) <= LAST_PAIRS * n:
                break
            met = s.table(self._few(self._meetings(rooted, seen, turn, offered, met_most), n), "met")
            links = self._linked(*self._plausible(met, s.rows("met")))
            seen = s.add(met, "seen")
            s.release("met")
            rooted = self._rooted(index, links, salts, n)
        few = self._few(rooted.where("root <> main").drop("salt").join(salts, "token"), n).select("token", "salt", *(F.col(x).alias(f"f_{x}") for x in ("cls", "n", "pos", "root")))
        cross = few.join(rooted, ["token", "salt"]).where("f_root <> root").where(self._may_link(F.col("f_n"), F.col("f_pos"), F.col("n"), F.col("pos")))
        cross = cross.select(F.least("f_cls", "cls").alias("a"), F.greatest("f_cls", "cls").alias("b")).distinct().join(seen, ["a", "b"], "left_anti")
        cross = s.table(cross, "cross")
        return components(self._linked(*self._plausible(cross, s.rows("cross"))), s)

    def _rooted(self, index: DataFrame, links: DataFrame, salts: DataFrame, n: int) -> DataFrame:
        """Index rows of the tokens whose classes lie in several components, with ``root`` and the token's largest, ``main``."""
        roots = components(links, self.scratch).withColumnRenamed("node", "cls")
        rows = self._few(index.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")), n)
        per = self._few(rows.groupBy("token", "root").agg(F.count("*").alias("k")), n)
        mixed = self._few(per.groupBy("token").agg(F.max(F.struct("k", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1"), n)
        main = self._few(salts.join(mixed.select("token", F.col("top.root").alias("main")), "token"), n)
        self.scratch.release("mixed")
        return self.scratch.table(self._few(rows.join(main, ["token", "salt"]), n), "mixed")

    def _meetings(self, rows: DataFrame, seen: DataFrame, turn: int, offered: int, most: int) -> DataFrame:
        """New pairs (a, b): each class outside ``main`` with ``most`` members of it at most, random ones by token."""
        member = F.when(F.col("root") == F.col("main"), F.struct("cls", "n", "pos"))
        around = Window.partitionBy("token", "salt").orderBy(F.xxhash64("cls", "token", F.lit(turn)), "cls").rowsBetween(-offered, offered)
        met = rows.withColumn("others", F.collect_list(member).over(around)).where("root <> main").withColumn("other", F.explode("others"))
        met = met.where(self._may_link(F.col("other.n"), F.col("other.pos"), F.col("n"), F.col("pos")))
        met = met.select("cls", F.least("cls", "other.cls").alias("a"), F.greatest("cls", "other.cls").alias("b")).distinct()
        met = met.join(seen, ["a", "b"], "left_anti")
        chosen = Window.partitionBy("cls").orderBy(F.xxhash64("a", "b", F.lit(turn)), "a", "b")
        return met.withColumn("k", F.row_number().over(chosen)).where(F.col("k") <= most).select("a", "b").distinct()

    def _resolved(self) -> DataFrame:
        """Each row's ``doc_id, text_hash, n, root`` (null for an empty set) and ``component``, the smallest id that reaches it."""
        roots = self.components().select(F.col("node").alias("cls"), "root")
        classes = self.classes.select("cls", "hi", "lo", "n", "rep").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        smallest = classes.groupBy("root").agg(F.min("rep").alias("component"))
        classes = self.scratch.table(classes.join(smallest, "root").select("hi", "lo", "n", "root", "component"), "resolved")
        self.scratch.release("mixed index", "sides", "segments", "seen", "links", "mixed", "pairs", "salts", "needed", "cross")
        return self.members.join(classes, ["hi", "lo", "n"], "left")

    def run(self) -> DataFrame:
        """``doc_id, n_shingles, component_id`` for each row of the input."""
        return self._resolved().select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))

    def keepers(self) -> DataFrame:
        """``doc_id, text_hash`` of one document of each group: the smallest id, of equal ids the smallest hash; a null id comes last.

        Empty texts are groups of their own, so all of their rows are there (those that repeat an id once).
        """
        rows = self._resolved()
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
        groups = rows.where("root is not null").groupBy("root").agg(first.alias("top")).select("top.doc_id", "top.text_hash")
        return groups.union(rows.where("root is null").select("doc_id", "text_hash").distinct())


def text_hash(text: Column) -> Column:
    """A 64-bit hash of a text; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
