import math
import zlib
from collections import Counter

import numpy as np
import pytest

from gridloom.llm import brown
from gridloom.llm.brown import CLASSES, BrownModel, exchange

from ..conftest import SF
from .common import awkward, frame, words


def brute(rows):
    counts, total = Counter(), 0
    for d, t, *_ in rows:
        if d is None or zlib.crc32(str(d).encode()) % 7 != 2:
            w = [*words(t), None]
            counts.update(w)
            total += len(w)
    out = []
    for d, t, *_ in rows:
        w = [*words(t), None]
        base = sum(math.log10((counts[x] + 1) / (total + len(counts) + 1)) for x in w)
        out.append((d, d is not None and zlib.crc32(str(d).encode()) % 7 == 2, len(w), sum(counts[x] > 0 for x in w), total, round(base, 6)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [20, 4])
def test_counts_and_base(spark, monkeypatch, bits):
    monkeypatch.setattr(brown, "HEAD_BITS", bits)  # 4: most words are of the tail
    rows = awkward()
    got = BrownModel(spark, frame(spark, rows)).scores().collect()
    assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=str) == brute(rows)
    assert all(r["score"] < 0 and r["perplexity"] > 1 for r in got)


def plain_scores(model, rows):
    """Scores by the definitions, given the class of each word."""

    def cls(w):
        w = w.encode()
        return int(model.of_rank[model.head.rank[w]] if w in model.head.rank else model.of_unit[brown.tail_unit(w)])

    train = [words(t) for d, t, *_ in rows if not brown.held_out(d)]
    between, in_class, counts = Counter(), Counter(), Counter()
    for w in train:
        path = [0, *map(cls, w), 0]
        between.update(zip(path, path[1:]))
        in_class.update(path[1:])
        counts.update(w)
    total, kinds = sum(in_class.values()), Counter(map(cls, counts))
    out = []
    for d, t, *_ in rows:
        w = words(t)
        path, logs = [0, *map(cls, w), 0], 0.0
        for a, b in zip(path, path[1:]):
            n, k = sum(between[a, x] for x in range(CLASSES)), sum(between[a, x] > 0 for x in range(CLASSES)) + 1
            logs += math.log10((between[a, b] + k * (in_class[b] + 1) / (total + CLASSES)) / (n + k))
        logs += sum(math.log10((counts[x] + 1) / (in_class[cls(x)] + kinds[cls(x)] + 1)) for x in w)
        out.append((d, round(logs, 5)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [20, 4])
def test_scores_against_a_plain_version(spark, monkeypatch, bits):
    monkeypatch.setattr(brown, "HEAD_BITS", bits)
    rows = awkward(2)
    model = BrownModel(spark, frame(spark, rows))
    got = sorted(((r["doc_id"], round(r["score"], 5)) for r in model.scores().collect()), key=str)
    assert got == plain_scores(model, rows)


def test_words_beyond_the_units_go_where_their_neighbours_say(spark):
    # pairs "<left><right>" of 900 + 900 words, more than there are units: the two sides never mix
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(f"{'LR'[j % 2]}{rng.integers(0, 900)}x" for j in range(200)), None, None, None) for k in range(400)]
    model = BrownModel(spark, frame(spark, rows))
    assert len(model.head.words) > brown.HEAD_UNITS
    side = {}
    for w, c in zip(model.head.words, model.of_rank, strict=True):
        side.setdefault(int(c), set()).add(w[:1])
    assert all(len(s) == 1 for s in side.values())
    got = {r["doc_id"]: r["score"] for r in model.scores().where("doc_id < 20").collect()}
    assert {(d, round(x, 5)) for d, x in got.items()} <= set(plain_scores(model, rows))


def test_best_class_has_the_greatest_likelihood():
    rng = np.random.default_rng(4)
    f = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
    for own in (1, 3, 5):
        table = rng.integers(0, 60, (6, 6)).astype(float)
        left, right = (np.minimum(table[:, own], rng.integers(0, 9, 6)), np.minimum(table[own], rng.integers(0, 9, 6)))
        left[own] = right[own] = 0
        value = []
        for b in range(1, 6):
            t = table.copy()
            t[own] -= right
            t[:, own] -= left
            t[b] += right
            t[:, b] += left
            value.append(f(t) - f(t.sum(0)) - f(t.sum(1)))
        assert brown.best_class(left, right, table, own) == 1 + int(np.argmax(value))


def test_empty_and_all_held_out(spark):
    assert BrownModel(spark, frame(spark, [])).scores().count() == 0
    held = [(d, "a b", None, None, None) for d in range(60) if brown.held_out(d)]
    got = BrownModel(spark, frame(spark, held)).scores().collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in got} == {(0, 0, 0.0)}


def test_exchange_finds_alternating_classes():
    rng = np.random.default_rng(0)
    n = np.zeros((41, 41), int)
    for _ in range(4000):  # units 1..20 are followed by 21..40 and the other way round
        a = rng.integers(1, 21)
        b = rng.integers(21, 41)
        n[a, b] += 1
        n[b, rng.integers(1, 21)] += 1
    of = exchange(n, classes=3)
    assert of[0] == 0 and len(set(of[1:21])) == 1 and len(set(of[21:])) == 1 and of[1] != of[21]


def test_exchange_never_lowers_the_likelihood():
    n = np.random.default_rng(1).poisson(0.3, (60, 60)) * np.random.default_rng(2).integers(1, 30, (60, 1))

    def likelihood(of):
        m = np.zeros((60, 6))
        m[np.arange(60), of] = 1
        t = m.T @ n @ m
        f = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
        return f(t) - f(t.sum(0)) - f(t.sum(1))

    steps = [likelihood(exchange(n, classes=6, sweeps=k)) for k in range(6)]
    assert all(b >= a - 1e-6 for a, b in zip(steps, steps[1:])) and steps[-1] > steps[0]


def test_model_is_a_distribution_and_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    m = BrownModel(spark, docs)
    assert (10**m.transition).sum(1) == pytest.approx(np.ones(CLASSES))
    r = m.scores().where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert r["s"] > r["b"]
