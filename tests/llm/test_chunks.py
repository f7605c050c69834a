import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridloom.llm import chunks, textops
from gridloom.llm.queries import queries

from ..conftest import SF
from .common import awkward, frame


def texts(n, seed=0):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices("abcdefghijklé", k=rng.randint(2, 9))) for _ in range(rng.randint(60, 400))) for _ in range(n)]


def test_cuts_do_not_depend_on_neighbours_and_survive_insertions():
    one, two = texts(2)
    moved = "inserted words here " + one
    cut = lambda *t: [(np.array(chunks.cuts(*textops.utf8(pa.array(t)))[0][chunks.cuts(*textops.utf8(pa.array(t)))[1] == k]) - textops.utf8(pa.array(t))[1][k]).tolist() for k in range(len(t))]
    alone, beside = cut(one)[0], cut(two, one, "", two)[1]
    assert alone == beside
    shifted = {c - 20 for c in cut(moved)[0]}
    assert set(alone[1:]) - shifted <= set(c for c in alone if c < chunks.SPAN + chunks.WINDOW)
    gaps = np.diff(alone)
    assert gaps.max() <= chunks.SPAN + chunks.WINDOW


def test_every_passage_is_found(spark):
    docs = texts(40)
    rng = random.Random(1)
    rows, planted = [], {}
    for k, t in enumerate(docs):
        w = t.split()
        if k % 2:
            source = docs[(k * 7) % 40].split()
            at = rng.randrange(max(1, len(source) - 55))
            w[len(w) // 2 : len(w) // 2] = (passage := source[at : at + 55])
            planted[k] = (" ".join(passage), (k * 7) % 40)
        rows.append((k, " ".join(w), None, None, None))
    got = {}
    for r in chunks.repeats(spark, frame(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
        raw = rows[r["doc_id"]][1].encode()[r["first_byte"] : r["last_byte"]]
        assert r["n_bytes"] == len(raw) >= chunks.PASSAGE
    for k in planted:
        assert k in got
    clean = set(range(40)) - set(planted) - {s for _, s in planted.values()}
    assert not clean & set(got)


def naive_runs(text):
    """Runs of a text by the definitions, byte by byte."""
    raw = (text or "").encode()
    gap = chunks.SPAN + chunks.WINDOW
    data = bytes(gap) + raw + bytes(gap)
    h = [sum(int(chunks._GEAR[data[p - k]]) << k for k in range(chunks.WINDOW) if p >= k) % 2**32 for p in range(len(data))]
    least = {min(range(q, q + chunks.SPAN), key=lambda p: (h[p], -p)) for q in range(len(data) - chunks.SPAN + 1)}
    cuts = sorted({0, len(raw)} | {p - gap for p in least if gap < p < gap + len(raw)})
    for c in cuts:
        if c + chunks.LEAST <= len(raw):
            end = next(e for e in cuts if e >= c + chunks.LEAST)
            yield c, end, raw[c:end]


def brute(rows):
    """``rows`` of (id, hash of the text, text)."""
    stands = {}
    for doc in {(i is not None, i or 0, h, t) for i, h, t in rows}:
        for first, last, raw in naive_runs(doc[3]):
            stands.setdefault(raw, []).append((doc[:3], first, last))
    spans = {}
    for places in stands.values():
        low = min(places)
        places = [p for p in places if p == low or p[0] != low[0] or p[1] >= low[2]]
        if len(places) > 1:
            for doc, first, last in places:
                spans.setdefault((doc, (doc, first) != low[:2]), []).append((first, last, low[0][1] if low[0][0] else None))
    out = []
    for (doc, removed), own in spans.items():
        passages = []
        for first, last, keeper in sorted(own, key=lambda s: s[:2]):
            if passages and first <= passages[-1][1]:
                passages[-1][1] = max(passages[-1][1], last)
                passages[-1][2].append(keeper)
            else:
                passages.append([first, last, [keeper]])
        for first, last, keepers in passages:
            if last - first >= chunks.PASSAGE:
                out.append((doc[1] if doc[0] else None, first, last, last - first, removed, min((k for k in keepers if k is not None), default=None)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    a, b, c, d, e, f = texts(6, seed=9)
    rows = [(7, a), (7, f"{b} {a[:400]}"), (None, f"{c} {b}"), (None, f"{c[:300]} {d}"), (None, d), (4, f"{e[100:600]} {f} {e[100:600]}"), (4, f"{e[100:600]} {f} {e[100:600]}"), (2, None), (3, ""), (8, f[:90]), (9, f[:87]), (1, "ab" * 400), (5, "z" * 500)]
    docs = frame(spark, [(*r, None, None, None) for r in rows]).repartition(5)
    hashes = dict(docs.select("text", F.xxhash64(F.coalesce("text", F.lit("")))).distinct().collect())
    got = sorted(map(tuple, chunks.repeats(spark, docs).collect()), key=str)
    want = brute([(i, hashes[t], t) for i, t in rows])
    assert got == want and len(want) > 8


def test_a_text_of_some_megabytes(spark):
    t = " ".join(texts(600, seed=4))
    rows = [(1, t, None, None, None), (2, "lead " + t[len(t) // 2 :], None, None, None)]
    got = chunks.repeats(spark, frame(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == {1, 2} and max(r["n_bytes"] for r in got) > len(t) // 2 - 500


def test_copies_keep_the_first(spark):
    t = texts(1)[0]
    rows = [(5, t, None, None, None), (3, t, None, None, None), (9, t, None, None, None), (9, t, None, None, None)]
    got = {(r["doc_id"], r["removed"], r["keeper_doc_id"]) for r in chunks.repeats(spark, frame(spark, rows)).collect()}
    assert got == {(3, False, 3), (5, True, 3), (9, True, 3)}
    span = [(r["first_byte"], r["last_byte"]) for r in chunks.repeats(spark, frame(spark, rows)).where("doc_id = 5").collect()]
    assert len(chunks.without(t, span)) < chunks.LEAST + chunks.SPAN and chunks.without(None, []) is None


def test_awkward_rows_and_empty_table(spark):
    assert chunks.repeats(spark, frame(spark, awkward())).count() > 0
    assert chunks.repeats(spark, frame(spark, [])).count() == 0


def test_query_spans_do_repeat(spark):
    raw = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries()["op5_substring_dedup"](spark, SF).collect()
    assert rows
    everything = b"\0".join(raw.values())
    for r in rows:
        if r["n_bytes"] < chunks.LEAST + chunks.SPAN:
            assert everything.count(raw[r["doc_id"]][r["first_byte"] : r["last_byte"]][: chunks.LEAST]) >= 2
