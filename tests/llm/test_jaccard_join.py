import random

import pytest

from gridloom.llm import components, jaccard_join
from gridloom.llm.jaccard_join import JaccardJoin
from gridloom.llm.queries import oracle_sql, queries
from gridloom.llm.scratch import Scratch

from ..conftest import SF
from ..test_queries import same_rows
from .common import DOCS, awkward, frame, shingles


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), low.get(find(i), r[0])) for i, r in enumerate(rows)), key=str)


def run(spark, rows):
    got = JaccardJoin(spark, frame(spark, rows)).run()
    return sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_awkward_rows(spark):
    rows = awkward()
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("salt", [False, True])
def test_a_large_group_of_near_copies(spark, monkeypatch, salt):
    if salt:
        monkeypatch.setattr(jaccard_join, "SALT_ABOVE", 16)
    rng = random.Random(5)
    base = [f"t{k}" for k in range(60)]
    rows = []
    for k in range(120):
        w = list(base)
        for _ in range(rng.choice((0, 1, 2, 3))):
            w[rng.randrange(60)] = f"e{rng.randrange(9)}"
        rows.append((1000 - k, " ".join(w), "en", "a", 1))
    rows += [(k, f"{' '.join(base[:30])} own{k} " + " ".join(f"u{k}x{j}" for j in range(8)), "en", "a", 1) for k in range(60)]
    assert run(spark, rows) == brute(rows)


def test_copies_in_several_tasks_leave_room_for_other_classes(spark):
    # a and c link; every prefix shingle that they share stands in b too, whose three copies lie between them by size
    p, q, r = ([f"{x}{k}" for k in range(n)] for x, n in (("p", 24), ("q", 70), ("r", 75)))
    a, b, c = p + q, p + r, p + q + [f"c{k}" for k in range(10)]
    frequent = [p[20:] + x + [f"f{k}x{j}" for j in range(200)] for x in (q, r) for k in range(10)]
    rows = [(k, " ".join(w), None, None, None) for k, w in enumerate([a, b, b, b, c, *frequent])]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), DOCS)
    got = JaccardJoin(spark, docs).run().select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    assert (4, 100, 0) in brute(rows)


def test_few_classes_of_a_split_shingle(spark, monkeypatch):
    # copies alone make these shingles frequent, so they are split, and the two classes of a pair may lie in different parts
    monkeypatch.setattr(jaccard_join, "SALT_ABOVE", 2)
    rows = []
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(100)]
        texts = [" ".join(base), " ".join([*base, *(f"g{g}e{k}" for k in range(23))])]
        rows += [(100 * g + k, texts[k % 2], None, None, None) for k in range(16)]
    assert run(spark, rows) == brute(rows)


def test_a_text_without_an_id_links_others(spark):
    a, b, c = ([*(f"x{k}" for k in range(100)), *(f"{x}{k}" for k in range(12 if x != "m" else 0))] for x in "amc")
    rows = [(10, " ".join(a), None, None, None), (None, " ".join(b), None, None, None), (11, " ".join(c), None, None, None)]
    assert run(spark, rows) == brute(rows)
    assert {r[2] for r in brute(rows)} == {10}


def test_one_id_with_several_texts(spark):
    w = [f"x{k}" for k in range(60)]
    other = [f"y{k}" for k in range(60)]
    rows = [(7, " ".join(w)), (7, " ".join(other)), (3, " ".join([*w, "end"])), (9, " ".join(["start", *other])), (None, " ".join(other)), (5, ""), (5, None)]
    rows = [(*r, None, None, None) for r in rows]
    got = run(spark, rows)
    assert got == sorted([(7, 56, 3), (7, 56, 7), (3, 57, 3), (9, 57, 7), (None, 56, 7), (5, 0, 5), (5, 0, 5)], key=str)
    kept = [r["doc_id"] for r in JaccardJoin(spark, frame(spark, rows)).keepers().collect()]
    assert sorted(kept) == [3, 5, 7]


def test_components_in_one_task_and_by_rounds(spark, monkeypatch):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(0, 40)] + [(100, rng.randrange(101, 400)) for _ in range(150)] + [(rng.randrange(500, 900), rng.randrange(500, 900)) for _ in range(200)] + [(5, 5), (None, 3), (4, None)]
    root = {x: x for p in links for x in p if x is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    linked = {x for a, b in links if a is not None and b is not None and a != b for x in (a, b)}
    want = sorted((x, find(x)) for x in linked)
    frame = spark.createDataFrame(links, "a long, b long").repartition(7)
    for most in (200_000, 50):
        monkeypatch.setattr(components, "LINKS", most)
        assert sorted(map(tuple, components.components(frame, Scratch(spark, "test")).collect())) == want


def test_exactly_at_the_threshold(spark):
    # sets of 9 and 9 that share 8 of 10: 80 * 10 == 100 * 8
    a = " ".join(f"x{k}" for k in range(13))
    b = " ".join(f"x{k}" for k in range(12)) + " other"
    rows = [(1, a, None, None, None), (2, b, None, None, None)]
    assert run(spark, rows) == brute(rows) == [(1, 9, 1), (2, 9, 1)]


def test_query_against_sql(spark, duck):
    assert same_rows(duck, queries()["op6_jaccard_join"](spark, SF), oracle_sql()["op6_jaccard_join"]) == spark.read.schema(DOCS).parquet(f"{SF}/documents.parquet").count()
