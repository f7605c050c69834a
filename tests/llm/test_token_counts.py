from collections import Counter

from gridloom.llm.token_counts import PATTERN, at_limits, encoded_length, histogram, quantile, suffix_sums

from .common import awkward, frame


def test_against_brute_force(spark):
    rows = awkward()
    lengths = [encoded_length(r[1]) for r in rows]
    h = histogram(frame(spark, rows))
    assert {r["length"]: r["n_docs"] for r in h.collect()} == Counter(lengths)
    sums = suffix_sums(h)
    for r in sums.collect():
        x = r["length"]
        assert r["docs_at_least"] == sum(v >= x for v in lengths) and r["tokens_at_least"] == sum(v for v in lengths if v >= x)
        assert r["truncated_tokens"] == sum(min(v, x) for v in lengths) and r["docs_cut"] == sum(v > x for v in lengths)
        assert abs(r["share_at_most"] - sum(v <= x for v in lengths) / len(lengths)) < 1e-12
    assert {r["context_limit"]: (r["tokens"], r["docs_cut"]) for r in at_limits(sums, [0, 10, 10**6]).collect()} == {c: (sum(min(v, c) for v in lengths), sum(v > c for v in lengths)) for c in (0, 10, 10**6)}
    assert quantile(sums, 0.5) == sorted(lengths)[(len(lengths) + 1) // 2 - 1]


def test_empty_table(spark):
    sums = suffix_sums(histogram(frame(spark, [])))
    assert sums.count() == 0 and quantile(sums, 0.5) is None
    assert at_limits(sums, [5]).first()["tokens"] == 0


def test_pattern_is_the_vocabularys_own():
    import public_tokenizers

    assert PATTERN == public_tokenizers.PATTERN
