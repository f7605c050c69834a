"""Small awkward tables, and plain versions of what several operators count."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    """Words with A-Z alone lower-cased."""
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text):
    w = words(text)
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.paretovariate(0.6)) % vocabulary}é" if rng.random() < 0.1 else f"W{int(rng.paretovariate(0.6)) % vocabulary}" for _ in range(n))


def awkward(seed=0):
    """Nulls, empty and blank texts, copies, near copies, ties, repeated rows, a long text, a null id."""
    rng = random.Random(seed)
    base = [prose(rng, rng.choice((3, 4, 5, 6, 12, 40, 120))) for _ in range(25)]
    near = []
    for t in base:
        w = t.split()
        for _ in range(3):
            v = list(w)
            for _ in range(rng.choice((1, 1, 2, 5))):
                v[rng.randrange(len(v))] = "changed"
            near.append(" ".join(v))
    texts = [*base, *near, base[3], base[3], base[7].upper(), None, "", " \t\n ", "one", "one", "one two three four", prose(rng, 3000), "x" * 5000]
    rng.shuffle(texts)
    rows = [(k, t, rng.choice(("en", "fr", None)), rng.choice(("a", "b", "c", None)), None if t is None else len(t)) for k, t in enumerate(texts)]
    return rows + [rows[4], rows[4], (None, base[0], None, None, None)]


def frame(spark, rows, **more):
    """The table, with columns whose names operators use inside."""
    f = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    for name in ("cls", "n", "token", "size", "key", "bucket", "score", "keep", "digest", "label"):
        f = f.withColumn(name, F.lit(1))
    return f
