import random

import pytest

from gridloom.llm import decontaminate
from gridloom.llm.queries import oracle_sql, queries

from ..conftest import SF
from ..test_queries import same_rows
from .common import awkward, frame, prose, shingles, words


def brute(rows, items, percent=80):
    out = []
    for d, t, *_ in rows:
        x = shingles(t)
        for i, q in items:
            n, q = words(q), shingles(q)
            if 0 < len(n) < 5:
                w = words(t)
                out += [(d, i, 1, 1)] * any(w[k : k + len(n)] == n for k in range(len(w)))
            elif q and 100 * len(q & x) >= percent * len(q):
                out.append((d, i, len(q), len(q & x)))
    return sorted(out, key=str)


def corpus(seed=0):
    rng = random.Random(seed)
    items = [(k, prose(rng, n, 5000)) for k, n in enumerate([5, 6, 9, 14, 20, 33, 50, 70, 130, 400] * 3)]
    rows = [r for r in awkward(seed)]
    for k in range(120):
        w = prose(rng, rng.choice((5, 60, 900, 4000)), 5000).split()
        q = rng.choice(items)[1].split()
        if k % 3 == 0:
            if len(q) > 40:
                q[rng.randrange(len(q))] = "edited"
            at = rng.randrange(len(w) + 1)
            w[at:at] = q
        rows.append((500 + k, " ".join(w), None, None, None))
    return rows, items


def test_recall_and_precision_against_brute_force(spark):
    rows, items = corpus()
    items += [(900, None), (901, ""), (902, "one two")]
    want = brute(rows, items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, decontaminate.contaminated(spark, frame(spark, rows), bench).collect()), key=str)
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want) > 30
    kept = {r["doc_id"] for r in decontaminate.clean(frame(spark, rows), bench).collect()}
    assert kept == {r[0] for r in rows} - {g[0] for g in got}


def test_short_items_stand_inside_long_texts(spark, duck):
    long = " ".join(f"w{k}" for k in range(900))
    rows = [(1, f"{long} Rare Phrase {long}", None, None, None), (2, "rare phrase", None, None, None), (3, "rare", None, None, None), (None, f"{long} rare  phrase", None, None, None), (4, "phrase rare", None, None, None), (5, None, None, None, None), (6, f"one two three four {long}", None, None, None), (7, "one two three", None, None, None)]
    items = [(1, "rare phrase"), (-1, "w1 w2 w3 w4"), (None, "one two three four"), (8, None), (9, " ")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, decontaminate.contaminated(spark, frame(spark, rows), bench).collect()), key=str)
    assert got == brute(rows, items) and len(got) == 7
    duck.execute("create schema if not exists short; use short")
    duck.execute("create or replace table documents(doc_id bigint, text varchar); create or replace table benchmark(item_id bigint, text varchar)")
    duck.executemany("insert into documents values (?, ?)", [r[:2] for r in rows])
    duck.executemany("insert into benchmark values (?, ?)", items)
    try:
        assert sorted(duck.execute(oracle_sql()["op8_decontamination"]).fetchall(), key=str) == got
    finally:
        duck.execute("use main")


def test_a_minimum_that_many_items_share(spark):
    prompt = " ".join(f"p{k}" for k in range(40))
    items = [(k, f"{prompt} answer{k} {' '.join(f'a{k}x{j}' for j in range(20))}") for k in range(600)]
    rows = [(k, f"{'x ' * k}{items[k][1] if k % 2 else prompt} end", None, None, None) for k in range(40)]
    got = sorted(map(tuple, decontaminate.contaminated(spark, frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()), key=str)
    assert got == brute(rows, items) and len(got) == 20


def test_items_in_blocks(spark, monkeypatch):
    rows, items = corpus(3)
    rows.append((rows[0][0], "another text of the first id", None, None, None))
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, decontaminate.contaminated(spark, frame(spark, rows), bench).collect()), key=str)
    monkeypatch.setattr(decontaminate, "ITEMS", 7)
    assert sorted(map(tuple, decontaminate.contaminated(spark, frame(spark, rows), bench).collect()), key=str) == whole
    assert decontaminate.clean(frame(spark, rows), bench).count() == sum(not any(len(q) and 100 * len(q & shingles(r[1])) >= 80 * len(q) for q in map(shingles, dict(items).values())) for r in rows)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(spark, frame(spark, awkward()), none).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contaminated(spark, frame(spark, []), some).count() == 0


@pytest.mark.parametrize("name", ["op8_decontamination"])
def test_query_against_sql(spark, duck, name):
    assert same_rows(duck, queries()[name](spark, SF), oracle_sql()[name]) > 0
