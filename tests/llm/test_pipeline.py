"""Each stage of the pipeline against a plain version on its own input."""

import corpus_pipeline as P
from gridloom.llm import pii

from ..conftest import SF as SMALL
from .common import DOCS, awkward, frame, shingles, words

SF = SMALL.replace("0.001", "0.01")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    bench = [shingles(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seen = []
    for k, (_, stage) in enumerate(P.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns[:5] == COLUMNS and (k == 4 or docs.columns == COLUMNS)
        seen.append((before, {r["doc_id"]: r for r in docs.collect()}))
    (a, b), (_, c), (_, d), (_, e), (f, g) = seen
    assert all(labels[k]["quality"] == 0 for k in set(a) - set(b) if k in labels)
    assert sum(labels[k]["quality"] == 0 for k in b if k in labels) <= 1
    ids = sorted(b)
    sets = {k: shingles(b[k]["text"]) for k in ids}
    root = {k: k for k in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(ids):
        for y in ids[:i]:
            u, v = sets[x], sets[y]
            if u and v and min(len(u), len(v)) >= 0.8 * max(len(u), len(v)) and 100 * len(u & v) >= 80 * len(u | v):
                p, q = sorted((find(x), find(y)))
                root[q] = p
    assert set(c) == {k for k in ids if find(k) == k}
    leaks = {k for k in c if any(100 * len(q & sets[k]) >= 80 * len(q) for q in bench if q)}
    assert set(d) == set(c) - leaks
    for k, r in e.items():
        assert not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not pii.base_spans(d[k]["text"]):
            assert r["text"] == d[k]["text"]
    assert set(g) <= set(f) and all(r["taken"] == r["epochs"] * len(words(r["text"])) > 0 for r in g.values())


def test_stages_on_awkward_rows(spark, tmp_path):
    rows = [*awkward(4), (4, "another text of the fourth id " + "x y z " * 9, "en", "a", 5), (None, "alone without an id " + "u v w " * 9, None, None, None)]
    docs = frame(spark, rows)
    columns = docs.columns
    for k, (name, stage) in enumerate(P.STAGES):
        before = docs.collect()
        out = stage(spark, docs, SMALL)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        more = ["size", "source_size", "target", "taken", "epochs"]
        assert docs.columns == (columns if k < 4 else [c for c in columns if c not in more] + more), name
        if k == 1:
            # of each group the least id; different texts of an id are told apart, empty texts stay
            sets = [shingles(r["text"]) for r in before]
            root = list(range(len(before)))
            for i, a in enumerate(sets):
                for j, b in enumerate(sets[:i]):
                    if a and b and 100 * len(a & b) >= 80 * len(a | b):
                        p, q = root[i], root[j]
                        root = [q if x == p else x for x in root]
            groups = {}
            for i, r in enumerate(before):
                groups.setdefault(root[i] if sets[i] else ("empty", r["doc_id"]), []).append((r["doc_id"] is None, r["doc_id"] or 0))
            want = sorted(min(g) for g in groups.values())
            assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in docs.collect()) == want
        elif k == 3:
            assert docs.count() == len(before)
    assert docs.count() > 0


def test_run_and_empty(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
    assert P.run(spark, SMALL).count() > 0
