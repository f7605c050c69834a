import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridloom.llm import quality, textops, toxicity
from gridloom.llm.linear import fit_logistic, sigmoid
from gridloom.llm.queries import queries

from ..conftest import SF
from .common import awkward, frame, prose, shingles, words


def test_logistic_on_one_class_and_none():
    x = np.ones((3, 2))
    assert (sigmoid(fit_logistic(x, np.ones(3, int)).logit(x)) > 0.9).all()
    assert fit_logistic(np.zeros((0, 2)), np.zeros(0, int)).logit(x).shape == (3,)


def test_weak_view_learns_from_the_strong_one():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 900)
    text = np.stack((y + rng.normal(0, 0.2, 900), rng.normal(size=900)), 1)
    meta = np.stack((y + rng.normal(0, 0.8, 900), rng.normal(size=900)), 1)
    m = quality.co_train(text[:60], meta[:60], y[:60], text[60:600], meta[60:600])
    both = m.scores(text[600:], meta[600:])[2]
    assert ((both > 0.5) == y[600:]).mean() > 0.95


def test_quality_of_labelled_documents(spark):
    larger = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    got = queries()["op7_quality"](spark, larger).join(labels, "doc_id").cache()
    assert got.where("quality = 1 and not keep").count() == 0
    assert got.where("quality = 0 and keep").count() <= 1


def test_quality_of_awkward_rows(spark):
    rows = awkward()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(k, k % 2, None) for k in range(40)] + [(None, 1, 0), (3, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    model = quality.train(spark, docs, labels)
    assert quality.score(docs, model).count() == len(rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score(docs, quality.train(spark, docs, none)).where("keep").count() == len(rows)
    assert quality.score(frame(spark, []), model).count() == 0


def test_quality_of_documents_that_training_did_not_see(spark):
    larger = SF.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{larger}/documents.parquet"), spark.read.parquet(f"{larger}/labels.parquet")
    for pool in (0, quality.POOL):
        model = quality.train(spark, docs, labels.where("doc_id % 2 = 0"), pool=pool)
        got = quality.score(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").groupBy("quality", "keep").count().collect()
        n = {(r["quality"], r["keep"]): r["count"] for r in got}
        assert n.get((1, False), 0) <= 0.01 * n[1, True] and n.get((0, True), 0) <= 0.1 * n[0, False], n


def test_kept_rows_keep_their_columns(spark):
    docs = frame(spark, awkward())
    model = quality.train(spark, docs, spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int"))
    model.threshold = 0.5
    want = quality.score(docs, model).where("keep").count()
    got = quality.kept(docs, model)
    assert got.schema == docs.schema and got.count() == want and got.where("keep = 1 and score = 1").count() == want


def test_text_features_against_a_plain_count():
    for t in ("", "Ab, c! 12 $%\n| é é é", "one two one two one two", None):
        f = quality.text_features(pa.array([t], pa.string()))[0]
        s, w = t or "", words(t)
        chars, letters = max(1, len(s)), max(1, sum(c.isalpha() for c in s))
        assert np.isclose(f[0], sum(c.isupper() for c in s) / letters) and np.isclose(f[1], sum(c.isdigit() for c in s) / chars) and np.isclose(f[2], s.count("\n") / chars)
        assert np.isclose(f[15], len(set(w)) / max(1, len(w))) and np.isclose(f[16], len(shingles(t)) / max(1, len(w) - 4 if len(w) > 4 else min(1, len(w))))
        assert np.isclose(f[17], np.log1p(len(w)))


def marked(n, seed, words=("vile", "rotten", "filthy")):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        w = prose(rng, rng.randint(20, 300)).split()
        bad = k % 4 == 0
        for _ in range(rng.choice((1, 3, 12)) if bad else 0):
            w[rng.randrange(len(w))] = rng.choice(words) + rng.choice(("", "!", "..."))
        rows.append((k, " ".join(w), "en", "a", 1))
        labels.append((k, 1, int(bad)))
    return rows, labels


def test_severity_grows_with_the_marked_words(spark):
    rows, labels = marked(400, 1)
    docs = frame(spark, rows)
    model = toxicity.train(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert (np.diff(model.thresholds) > 0).all() and (model.presence >= 0).all()
    fresh, truth = marked(200, 2)
    got = {r["doc_id"]: r for r in toxicity.score(frame(spark, fresh), model).collect()}
    assert sum(got[k]["toxic"] != bool(t) for k, _, t in truth) <= 4
    assert all(abs(r["severity"] - r["p_1"] - r["p_2"] - r["p_3"]) < 1e-9 and r["p_1"] >= r["p_2"] >= r["p_3"] for r in got.values())
    p = model.probabilities(pa.array(["plain words only", "vile " + "plain " * 200, "vile rotten filthy vile"])).sum(1)
    assert p[0] < p[1] < p[2]


def test_marking_words_and_scores_against_a_plain_version(spark):
    rows, labels = marked(300, 5)
    sample = [([w.strip("!.") for w in words(t)], bad) for (_, t, *_), (_, _, bad) in zip(rows, labels, strict=True)]
    good, bad = (sum(b == k for _, b in sample) for k in (0, 1))
    texts = {}
    for w, b in sample:
        for x in set(w):
            texts.setdefault(x, [0, 0])[b] += 1
    z = {}
    for x, (g, b) in texts.items():
        n, share = g + b, bad / (good + bad)
        part = lambda k, e: k * np.log(k / e) if k else 0.0
        z[x] = np.sign(b - n * share) * np.sqrt(max(0, 2 * (part(b, n * share) + part(g, n * (1 - share))))) if n >= toxicity.LEAST_DOCUMENTS else 0
    want = {x for x, v in z.items() if v >= toxicity.LEAST_Z}
    flat = spark.createDataFrame([(x, k, n) for x, both in texts.items() for k, n in enumerate(both) if n], "word string, label int, texts long")
    assert {r["word"] for r in toxicity.marking_words(flat, good, bad).collect()} == want >= {"vile", "rotten", "filthy"}
    model = toxicity.train(spark, frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    name = {int(textops.word_hash(textops.words(pa.array([x])))[0]): x for x in texts}
    assert {name[int(h)] for h in model.words} == want
    weight = {name[int(h)]: (p, d) for h, p, d in zip(model.words, model.presence, model.density, strict=True)}
    fresh = [" ".join(w) for w, _ in sample[:40]]
    for t, p in zip(fresh, model.probabilities(pa.array(fresh)), strict=True):
        w = words(t)
        total = sum(weight[x][0] + weight[x][1] * min(1.0, 25.0 * w.count(x) / len(w)) for x in set(w) if x in weight)
        assert np.allclose(p, 1 / (1 + np.exp(model.thresholds - total)))


def test_toxicity_of_documents_that_training_did_not_see(spark):
    larger = SF.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{larger}/documents.parquet"), spark.read.parquet(f"{larger}/labels.parquet")
    model = toxicity.train(spark, docs, labels.where("doc_id % 2 = 0"))
    got = toxicity.score(docs, model).join(labels.where("doc_id % 2 = 1").select("doc_id", F.col("toxic").alias("truth")), "doc_id").groupBy("truth", "toxic").count().collect()
    n = {(r["truth"], r["toxic"]): r["count"] for r in got}
    assert n.get((0, True), 0) <= 0.005 * n[0, False] and n.get((1, False), 0) <= 0.2 * n[1, True], n


def test_long_texts(spark):
    t = prose(random.Random(2), 300_000)
    rows = [(1, t, "en", "a", len(t)), (2, "x" * 2_000_000, "en", "a", 1), (3, "vile " * 200_000, "en", "a", 1)]
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in (1, 2, 3)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    assert quality.score(docs, quality.train(spark, docs, labels)).count() == 3
    assert toxicity.score(docs, toxicity.train(spark, docs, labels)).count() == 3


def test_toxicity_of_awkward_rows(spark):
    rows = awkward()
    docs = frame(spark, rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(spark, docs, none)
    assert toxicity.score(docs, model).where("not toxic").count() == len(rows)
    assert toxicity.score(frame(spark, []), model).count() == 0


def test_toxicity_of_labelled_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("toxic").alias("truth"))
    got = queries()["op10_toxicity"](spark, SF).join(labels, "doc_id")
    assert got.where("truth = 0 and toxic").count() == 0
