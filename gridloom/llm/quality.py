"""Quality by co-training: a classifier of text content and one of page metadata teach each other.

Both views start from a bounded sample of labelled documents. In each round either classifier labels a bounded pool
of unlabelled documents, and the ones it is most confident of join the other's training rows. Then both views are
calibrated on labelled rows that neither has seen, their calibrated log-odds are combined, and every document is scored
in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops
from .linear import Logistic, fit_logistic, labelled_sample, sigmoid, unlabelled_sample

#: Labelled rows of each class, and unlabelled rows, that training may see.
PER_CLASS, POOL = 2000, 3000
ROUNDS = 4
#: Ridge penalty of both views, against standardised features and classes that weigh one half each.
PENALTY = 0.03
#: A pseudo-label needs this probability; a view passes on at most this many of each class a round.
CONFIDENT, PASSED_ON = 0.97, 150
#: Share of the good labelled rows that the threshold may reject at most.
LOST = 0.001

_CLASS = np.zeros(256, np.int64)
_CLASS[[c for c in range(256) if chr(c).islower() and c < 128]] = 1
_CLASS[[c for c in range(65, 91)]] = 2
_CLASS[[c for c in range(48, 58)]] = 3
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 4
_CLASS[0x0A] = 5
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 6
_CLASS[ord("!")] = 7
_CLASS[[ord(c) for c in "$%&#*@^~=+<>{}[]_/\\`"]] = 8
_CLASS[ord("|")] = 9
_CLASS[0xC0:] = 10
_CLASS[0x80:0xC0] = 11
_KINDS = 12


def text_features(column: pa.Array) -> np.ndarray:
    """One row of features a text, from its bytes and words; null and empty texts have zeros for shares."""
    raw, off = textops.utf8(column)
    n = len(off) - 1
    size = np.diff(off)
    of = np.repeat(np.arange(n), size)
    kinds = np.bincount(of * _KINDS + _CLASS[raw], minlength=n * _KINDS).reshape(n, _KINDS).astype(np.float64)
    chars = np.maximum(1.0, kinds[:, :11].sum(1))
    w = textops.words(column)
    h = textops.word_hash(w)
    counts = w.counts
    several = np.maximum(1.0, counts)
    again = np.zeros((n, 3))
    for d in (1, 2, 3):
        if len(h) > d:
            same = (h[d:] == h[:-d]) & (w.doc[d:] == w.doc[:-d])
            again[:, d - 1] = np.bincount(w.doc[d:][same], minlength=n)
    s, first = textops.shingles(w, h)
    kinds_of_words = np.array([len(np.unique(h[w.first[k] : w.first[k + 1]])) for k in range(n)], np.float64)
    kinds_of_runs = np.array([len(np.unique(s[first[k] : first[k + 1]])) for k in range(n)], np.float64)
    letters = np.maximum(1.0, kinds[:, 1] + kinds[:, 2] + kinds[:, 10])
    share = np.stack((kinds[:, 2] / letters, kinds[:, 3] / chars, kinds[:, 5] / chars, kinds[:, 6] / chars, kinds[:, 7] / chars, kinds[:, 8] / chars, kinds[:, 9] / chars, kinds[:, 10] / chars), 1)
    runs = np.maximum(1.0, np.diff(first))
    return np.concatenate((share, np.log(share[:, [0, 4, 5, 6]] + 0.003), again / several[:, None], (kinds_of_words / several)[:, None], (kinds_of_runs / runs)[:, None], np.log1p(counts)[:, None], (chars / several)[:, None].clip(0, 40)), 1)


SOURCES, LANGS = 32, 16


def meta_features(lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """Hashed source and language, and powers of the logarithm of the declared length; nulls are values of their own."""
    n = len(lang)
    out = np.zeros((n, SOURCES + LANGS + 4))
    slot = lambda x, size: xxhash.xxh32_intdigest(b"\xff" if x is None else str(x).encode()) % size
    for k, (a, b) in enumerate(zip(source.to_pylist(), lang.to_pylist(), strict=True)):
        out[k, slot(a, SOURCES)] = 1
        out[k, SOURCES + slot(b, LANGS)] = 1
    declared = np.array([np.nan if x is None else float(x) for x in n_chars.to_pylist()], np.float64)
    size = np.log1p(np.maximum(0, np.nan_to_num(declared)))
    out[:, -4:] = np.stack((size, size**2, size**3, np.isnan(declared)), 1)
    return out


@dataclass
class CoTrained:
    text: Logistic
    meta: Logistic
    text_scale: Logistic
    meta_scale: Logistic
    joint: Logistic
    threshold: float

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of good quality: by text, by metadata, and combined."""
        a = self.text_scale.logit(self.text.logit(text)[:, None])
        b = self.meta_scale.logit(self.meta.logit(meta)[:, None])
        return sigmoid(a), sigmoid(b), sigmoid(self.joint.logit(np.stack((a, b), 1)))


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray) -> CoTrained:
    """Two views of labelled rows and of a pool. Every third row of a class is held back for calibration."""
    back = np.zeros(len(y), bool)
    for k in (0, 1):
        back[np.flatnonzero(y == k)[2::3]] = True
    if not len(y) or any((y[back] == k).sum() == 0 for k in (0, 1)):
        back[:] = False
    fit = ~back
    own = {"text": (text[fit], y[fit]), "meta": (meta[fit], y[fit])}
    pool = {"text": pool_text, "meta": pool_meta}
    free = {"text": np.ones(len(pool_text), bool), "meta": np.ones(len(pool_text), bool)}
    view = {k: fit_logistic(*own[k], penalty=PENALTY) for k in own}
    seen = {"text": text, "meta": meta}
    calibrated = lambda k, rows: fit_logistic(view[k].logit(seen[k][rows])[:, None], y[rows])
    for _ in range(ROUNDS if back.any() else 0):
        # confidence is that of held-back rows: a view that has only learnt its own rows by heart teaches nothing
        sure_of = {k: sigmoid(calibrated(k, back).logit(view[k].logit(pool[k])[:, None])) if len(pool[k]) else np.zeros(0) for k in view}
        for teacher, pupil in (("text", "meta"), ("meta", "text")):
            p = sure_of[teacher]
            for label, confidence in ((1, p), (0, 1 - p)):
                sure = np.flatnonzero(free[pupil] & (confidence >= CONFIDENT))
                sure = sure[np.argsort(-confidence[sure], kind="stable")][:PASSED_ON]
                free[pupil][sure] = False
                own[pupil] = (np.concatenate((own[pupil][0], pool[pupil][sure])), np.concatenate((own[pupil][1], np.full(len(sure), label))))
        view = {k: fit_logistic(*own[k], penalty=PENALTY) for k in own}
    held = back if back.any() else fit
    scales = {k: calibrated(k, held) for k in view}
    both = np.stack([scales[k].logit(view[k].logit(x[held])[:, None]) for k, x in (("text", text), ("meta", meta))], 1)
    joint = fit_logistic(both, y[held], penalty=1e-2)
    model = CoTrained(view["text"], view["meta"], scales["text"], scales["meta"], joint, 0.5)
    good = model.scores(text[y == 1], meta[y == 1])[2]
    model.threshold = float(min(0.5, np.quantile(good, LOST, method="lower"))) if len(good) else 0.0
    return model


_COLUMNS = ("text", "lang", "source", "n_chars")


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = lambda name: batch.column(batch.schema.get_field_index(name))
    return text_features(column("text")), meta_features(column("lang"), column("source"), column("n_chars"))


def _gather(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Views and labels of a bounded sample (doc_id, text, lang, source, n_chars, label), in the order of its ids."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textops.slices(batches):
            a, b = _views(part)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(part.schema.get_field_index("label")), pa.array(list(a), pa.list_(pa.float64())), pa.array(list(b), pa.list_(pa.float64()))], ["doc_id", "label", "a", "b"])

    got = rows.mapInArrow(made, "doc_id long, label int, a array<double>, b array<double>").orderBy("doc_id", "a", "b").collect()
    wide = len(text_features(pa.array(["x"]))[0]), SOURCES + LANGS + 4
    return np.array([r["a"] for r in got], np.float64).reshape(-1, wide[0]), np.array([r["b"] for r in got], np.float64).reshape(-1, wide[1]), np.array([r["label"] for r in got], np.int64)


def train(spark: SparkSession, documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, pool: int = POOL) -> CoTrained:
    """From about ``per_class`` labelled documents of each class and ``pool`` others; columns besides the views' own are ignored."""
    text, meta, y = _gather(labelled_sample(spark, documents, list(_COLUMNS), labels, "quality", per_class))
    pool_text, pool_meta, _ = _gather(unlabelled_sample(documents, list(_COLUMNS), pool).withColumn("label", F.lit(0)))
    return co_train(text, meta, y, pool_text, pool_meta)


def score(documents: DataFrame, model: CoTrained) -> DataFrame:
    """``documents`` with ``text_score, meta_score, score`` (probabilities of good quality) and ``keep``.

    Null columns have features of their own; empty texts are scored like others; repeated rows repeat. Input columns of
    these names are replaced; ``kept`` leaves all columns as they are.
    """
    held = documents.sparkSession.sparkContext.broadcast(model)
    documents = documents.drop("text_score", "meta_score", "score", "keep")
    names = [*documents.columns, "text_score", "meta_score", "score", "keep"]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textops.slices(batches):
            a, b, both = held.value.scores(*_views(part))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(a), pa.array(b), pa.array(both), pa.array(both >= held.value.threshold)], names)

    more = [T.StructField(name, T.DoubleType()) for name in ("text_score", "meta_score", "score")]
    return documents.mapInArrow(made, T.StructType([*documents.schema.fields, *more, T.StructField("keep", T.BooleanType())]))


def kept(documents: DataFrame, model: CoTrained) -> DataFrame:
    """The rows of ``documents`` that the model keeps, with all their columns."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textops.slices(batches):
            yield part.filter(pa.array(held.value.scores(*_views(part))[2] >= held.value.threshold))

    return documents.mapInArrow(made, documents.schema)
