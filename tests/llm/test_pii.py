import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import pii
from gridloom.llm.queries import queries

from ..conftest import SF
from .common import awkward, frame


def plain(text):
    """The base patterns as they are defined."""
    out = []
    text = text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["a", "@", ".", "b.c", "1", "25", "255", "0256", "+", "+1", " ", "-", "(", ")", "é", "%", "_", "4785380592391139", "4111 1111 1111 1111", "555", "3824", "\n", "x@y.z", "٣"]), max_size=14).map("".join))
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


FIELD = pii.train([f"call +1 (743) 555-38{k:02} or mail a{k}@b.example.com from 10.0.0.{k} card 4111111111111111 not 12345 nor 1234567890123456 the 7 end" for k in range(40)])


def added(text):
    return [text[a:b] for _, a, b in pii.added_spans([text], [pii.base_spans(text)], FIELD)[0]]


def test_repeats_take_the_label_of_what_they_resemble():
    assert added("card 4111111111111111 later 4111111111111111 4111111111111111 end") == ["4111111111111111 4111111111111111"]
    assert added("ask +1 (743) 555-3824 or +1 (743) 555-3824 twice") == []
    assert added("nothing 12345 and 1234567890123456 here, mail x@y.com") == []


def test_long_runs_are_linear():
    for text in ("1" * 300_000, "a" * 300_000, "a@" * 100_000, "1 " * 100_000, "+" * 300_000, "1.2.3." * 50_000):
        pii.base_spans(text)


def test_masking():
    assert pii.masked_text("x a@b.co y", [(0, 2, 8)]) == "x [EMAIL] y"
    assert pii.masked_text("abcdef", [(1, 1, 4), (3, 2, 5)]) == "a[IP]f"


def test_frame(spark):
    rows = [*awkward(), (9001, "é mail a@b.example.com", None, None, 5), (9002, None, None, None, None)]
    f = frame(spark, rows).select("doc_id", "text", "n_chars", "size")
    got = {(r["doc_id"], r["base_sha256"], r["n_email"]) for r in pii.find(f, FIELD).collect()}
    written = lambda t: ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in plain(t))
    assert got == {(r[0], hashlib.sha256(written(r[1]).encode()).hexdigest(), sum(s[0] == 0 for s in plain(r[1]))) for r in rows}
    masked = {r["doc_id"]: r for r in pii.mask(f, FIELD).where("doc_id > 9000").collect()}
    assert masked[9001]["text"] == "é mail [EMAIL]" and masked[9001]["n_chars"] == 14 and masked[9002]["text"] is None
    assert pii.find_all(spark, frame(spark, [])).count() == 0


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries()["op4_personal_data"](spark, SF).collect():
        base = plain(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == i for s in base) for i in range(4)]
        got = set(filter(None, r["spans"].split(",")))
        assert {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base} <= got and len(got) == len(base) + r["n_added"]


def test_untrained_field_adds_nothing():
    field = pii.train(["no numbers here"])
    text = "a@b.co 555-1234567"
    assert pii.added_spans([text], [pii.base_spans(text)], field) == [[]]


def test_field_applies_to_documents_without_a_base_span(spark):
    node = np.zeros((pii.FEATURES, 5))
    node[15, 4] = 20.0  # both brackets: a telephone number
    field = pii.Field(node, np.zeros((5, 5)), np.zeros((5, 5)))
    f = frame(spark, [(1, "ask (743)5553824 now", None, None, 20), (2, "nothing", None, None, 7)])
    assert {(r["doc_id"], r["spans"], r["n_added"]) for r in pii.find(f, field).collect()} == {(1, "phone:4:16", 1), (2, "", 0)}
    assert {r["text"] for r in pii.mask(f, field).collect()} == {"ask [PHONE] now", "nothing"}


@pytest.mark.parametrize("n", [1, 5, 30, 200])
def test_a_trained_field_finds_every_repeat_of_a_number(n):
    for repeat in ("(743) 555-3824", "7435553824", "555-3824"):
        text = "call +1 (743) 555-3824 now" + f" or {repeat} then" * n
        assert added(text) == [repeat] * n


def test_training_takes_no_unmatched_repeat_as_a_negative(spark):
    texts = ["call +1 (743) 555-3824 or 555-3824 or 12345", None, "", "mail a@b.co a@b.co 9"]
    counts = pii.evidence([t for t in texts if t])
    assert sum(n for (kind, _, label), n in counts.items() if kind == 0 and label == 0) == 2  # 12345 and 9
    assert {k: n for k, n in counts.items() if k[0] == 2} == {(2, 1, 1): 1}
    a, b = pii.train_on(frame(spark, [(k, t, None, None, None) for k, t in enumerate(texts)])), pii.fit(counts)
    assert all(np.allclose(getattr(a, x), getattr(b, x)) for x in ("node", "chain", "skip"))


def exact(g, field):
    """Posteriors by enumeration of all labellings; a hub is a variable of its own."""
    n = len(g.fixed)
    fixed = [*g.fixed, *g.hubs]
    local = np.concatenate((g.features @ field.node, np.zeros((len(g.hubs), 5))))
    total = np.zeros((n, 5))
    for y in itertools.product(*(range(5) if f < 0 else [f] for f in fixed)):
        score = sum(local[k, v] for k, v in enumerate(y)) + sum(field.chain[y[a], y[b]] for a, b in g.chain) + sum(field.skip[y[a], y[b]] for a, b in g.links)
        total[range(n), y[:n]] += np.exp(score)
    return total / total.sum(1, keepdims=True)


def test_beliefs_against_enumeration():
    rng = np.random.default_rng(1)
    table = lambda: (lambda m: m + m.T)(rng.normal(size=(5, 5)) / 2)
    for text in ("7 8 9", "+1 (743) 555-3824 x 555-3824", "5553824 or 5553824 or 5553824 7", "a@b.co x 12 34 and 'a@b.co' 5"):
        g = pii.graph([text], [pii.base_spans(text)])
        field = pii.Field(rng.normal(size=(pii.FEATURES, 5)), table(), table())
        assert np.allclose(field.beliefs(g), exact(g, field), atol=5e-3)  # no loops here, so messages are exact
    text = "5553824 7 x 5553824 8 x 5553824 9 7"
    g = pii.graph([text], [[]])
    field = pii.Field(rng.normal(size=(pii.FEATURES, 5)), table(), table())
    assert np.abs(field.beliefs(g) - exact(g, field)).max() < 0.1


def test_labels_reach_far_repeats_and_far_neighbours():
    bias = np.zeros((pii.FEATURES, 5))
    bias[0, 0] = 3.0
    skip = pii.Field(bias, np.zeros((5, 5)), 6 * np.eye(5))
    text = "call +1 (743) 555-3824" + " or 555-3824" * 30
    assert len(pii.added_spans([text], [pii.base_spans(text)], skip)[0]) == 30
    chain = pii.Field(np.zeros((pii.FEATURES, 5)), 6 * np.eye(5), np.zeros((5, 5)))
    text = " ".join(["a@b.co", *(str(1000000 + k) for k in range(30))])
    assert pii.base_spans(text) == [(0, 0, 6)]
    assert pii.added_spans([text], [pii.base_spans(text)], chain)[0] == [(0, 7, len(text))]
