"""The registered queries of this subpackage and the SQL that some of them have."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_brown_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .brown import BrownModel

    return BrownModel(spark, _table(spark, sf_dir, "documents")).scores()


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(spark, _table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import histogram, suffix_sums

    return suffix_sums(histogram(_table(spark, sf_dir, "documents")))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_all

    return find_all(spark, _table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chunks import repeats

    return repeats(spark, _table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import JaccardJoin

    return JaccardJoin(spark, _table(spark, sf_dir, "documents")).run()


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score, train

    docs = _table(spark, sf_dir, "documents")
    return score(docs, train(spark, docs, _table(spark, sf_dir, "labels"))).select("doc_id", "text_score", "meta_score", "score", "keep")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated

    return contaminated(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import text_media

    return text_media(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score, train

    docs = _table(spark, sf_dir, "documents")
    return score(docs, train(spark, docs, _table(spark, sf_dir, "labels")))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+')"

_OP6 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS doc_id, b FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT doc_id, min(b) AS low FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""


_OP2 = f"""
WITH z AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    len(regexp_extract_all(coalesce(text, ''), '[$%&#*!|<>{{}}=]')) AS symbols,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496 AS u
  FROM documents),
k AS (SELECT *, -ln(u) / CASE WHEN size + symbols = 0 THEN 1.0 ELSE greatest(0.01, size::DOUBLE / (size + symbols)) END AS key FROM z),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
t AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM s),
w AS (SELECT *, [5, 2, 1][turn % 3 + 1] AS weight, 3.0 * source_size / [5, 2, 1][turn % 3 + 1] AS cap_rate FROM t),
l AS (SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(3 * source_size) OVER (ORDER BY cap_rate, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(weight) OVER (ORDER BY cap_rate, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w),
v AS (SELECT level FROM l WHERE cap_rate >= level ORDER BY cap_rate, turn LIMIT 1),
g AS (SELECT source, source_size, least(3.0 * source_size, coalesce((SELECT level FROM v) * weight, 3.0 * source_size))::DOUBLE AS target FROM l),
p AS (SELECT k.doc_id, k.size, g.source_size, g.target,
    k.source, coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END::BIGINT AS whole
  FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source),
f AS (SELECT *, target - whole * source_size AS rest, before + size <= target - whole * source_size AS fits FROM p),
m AS (SELECT source, max(before + size) FILTER (WHERE fits) AS met FROM f GROUP BY source),
c AS (SELECT f.source, f.size, f.before, row_number() OVER (PARTITION BY f.source ORDER BY f.size DESC, f.before) AS turn
  FROM f JOIN m ON f.source IS NOT DISTINCT FROM m.source WHERE NOT fits AND size > 0 AND coalesce(m.met, 0) + f.size <= f.rest),
e AS (SELECT f.*, f.whole + CASE WHEN f.fits OR c.turn = 1 THEN 1 ELSE 0 END AS epochs
  FROM f LEFT JOIN c ON c.turn = 1 AND f.source IS NOT DISTINCT FROM c.source AND f.size = c.size AND f.before = c.before)
SELECT doc_id, size::BIGINT AS size, source_size, target, (epochs * size)::BIGINT AS taken, epochs FROM e
"""


_GRAMS = """unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END) AS g"""
_OP8 = f"""
WITH a AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
d AS (SELECT doc_id, {_GRAMS} FROM a),
q AS (SELECT item_id, {_GRAMS} FROM b WHERE len(w) >= 5),
n AS (SELECT item_id, count(*) AS n FROM q GROUP BY item_id),
o AS (SELECT d.doc_id, q.item_id, count(*) AS c FROM d JOIN q USING (g) GROUP BY 1, 2),
f AS (SELECT item_id, len(w) AS k, array_to_string(w, ' ') AS g FROM b WHERE len(w) BETWEEN 1 AND 4),
e AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) AS g FROM a, (SELECT DISTINCT k FROM f) WHERE len(w) >= k)
SELECT doc_id, item_id, n AS item_shingles, c AS found_shingles FROM o JOIN n USING (item_id) WHERE 100 * c >= 80 * n
UNION ALL SELECT doc_id, item_id, 1, 1 FROM e JOIN f USING (k, g)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_brown_scores": op1_brown_scores,
        "op2_source_mix": op2_source_mix,
        "op3_token_counts": op3_token_counts,
        "op4_personal_data": op4_personal_data,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_quality": op7_quality,
        "op8_decontamination": op8_decontamination,
        "op9_media": op9_media,
        "op10_toxicity": op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_source_mix": _OP2, "op6_jaccard_join": _OP6, "op8_decontamination": _OP8}
