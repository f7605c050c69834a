from collections import defaultdict

import pytest

from gridloom.llm.mixing import mix, mixed_documents, targets
from gridloom.llm.queries import oracle_sql, queries

from ..conftest import SF
from ..test_queries import same_rows
from .common import awkward, frame, words


def plain_targets(sizes, weights=(5, 2, 1)):
    """Shares what is left among the open sources until none is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    left, goal, open_ = float(sum(sizes.values())), {}, set(order)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > 3 * sizes[s]}
        if not over:
            return goal | {s: level * w[s] for s in open_}
        for s in over:
            goal[s] = 3.0 * sizes[s]
            left -= goal[s]
        open_ -= over
    return goal


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, "c": 7}, {None: 1, "z": 1000, "é": 3, "zz": 50, "b": 0}, {"a": 10}, {"a": 0, None: 0}])
def test_targets(spark, sizes):
    f = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    assert {r["source"]: r["target"] for r in targets(f).collect()} == pytest.approx(plain_targets(sizes))


def test_awkward_rows(spark):
    rows = awkward()
    got = mix(spark, frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None) == sorted((r[0], len(words(r[1]))) for r in rows if r[0] is not None)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    goal = plain_targets(sizes)
    by_size = {round(goal[s], 6): s for s in sizes}
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["epochs"] * r["size"]
        taken[by_size[round(r["target"], 6)]] += r["taken"]
    for s, t in goal.items():
        assert taken[s] <= t + 1e-6
    again = mix(spark, frame(spark, rows[::-1])).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_empty_and_documents(spark):
    assert mix(spark, frame(spark, [])).count() == 0
    rows = awkward()
    docs = frame(spark, rows)
    out = mixed_documents(spark, docs)
    assert out.columns == [*(c for c in docs.columns if c != "size"), "size", "source_size", "target", "taken", "epochs"]
    all_taken = sum(r["taken"] for r in mix(spark, frame(spark, rows)).collect())
    assert out.agg({"taken": "sum"}).first()[0] == all_taken


def test_query_against_sql(spark, duck):
    assert same_rows(duck, queries()["op2_source_mix"](spark, SF), oracle_sql()["op2_source_mix"]) > 0
