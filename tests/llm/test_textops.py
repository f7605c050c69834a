import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import textops

from .common import shingles, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbBzé ß\t\n\x0b\x1c ", max_size=40)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_and_shingles(texts):
    column = pa.array(texts, pa.string())
    w = textops.words(column)
    got = [[bytes(w.data[a:b]).decode() for a, b in zip(w.start[w.first[k] : w.first[k + 1]], w.end[w.first[k] : w.first[k + 1]])] for k in range(len(texts))]
    assert got == [words(t) for t in texts]
    assert got == [[x.decode() for x in (t or "").encode().lower().split()] for t in texts]
    s, first = textops.shingles(w)
    of = {}
    for k, t in enumerate(texts):
        own = set(s[first[k] : first[k + 1]].tolist())
        assert len(own) == len(shingles(t))
        assert of.setdefault(frozenset(shingles(t)), own) == own
    h = textops.word_hash(w)
    flat = [x for t in got for x in t]
    assert len(set(h.tolist())) == len(set(flat))


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 10, None, "b" * 100, "", "c" * 5, "d" * 9])], ["doc_id", "text"])
    parts = list(textops.slices(iter([batch]), limit=20))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(6)) and len(parts) > 2
    assert list(textops.slices(iter([batch.slice(0, 0)]))) == []


def test_sliced_columns_are_read_from_their_offset():
    column = pa.array(["x y", "Ab c", None, "d"]).slice(1)
    w = textops.words(column)
    assert w.counts.tolist() == [2, 0, 1] and bytes(w.data[w.start[0] : w.end[0]]) == b"ab"
    assert np.array_equal(textops.token_counts(column), [2, 0, 1])
