"""Queries over objects, labels and samples."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import graph, joins, sampling, stats
from . import query, raster, table


@query("SELECT l_suppkey, count(*) AS nb_cells, round(avg(l_quantity), 6) AS mean_b0, round(var_samp(l_quantity), 6) AS var_b0, round(avg(l_discount), 6) AS mean_b1, round(var_samp(l_discount), 6) AS var_b1 FROM lineitem GROUP BY 1")
def seg_stats(spark, sf):
    s = stats.segment_stats(table(spark, sf, "lineitem"), "l_suppkey", ["l_quantity", "l_discount"])
    return s.select("l_suppkey", "nb_cells", *[F.round(c, 6).alias(c) for c in ("mean_b0", "var_b0", "mean_b1", "var_b1")])


@query("SELECT l_suppkey, min(l_partkey) AS minx, max(l_partkey) AS maxx, min(l_orderkey) AS miny, max(l_orderkey) AS maxy, count(*) AS area FROM lineitem GROUP BY 1")
def bbox_merge(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.min("l_partkey").alias("minx"), F.max("l_partkey").alias("maxx"), F.min("l_orderkey").alias("miny"), F.max("l_orderkey").alias("maxy"), F.count("*").alias("area"))


@query("SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 10 WHEN 3 THEN 13 ELSE n_regionkey END AS n_regionkey FROM nation")
def relabel_map(spark, sf):
    mapping = table(spark, sf, "region").where("r_regionkey in (0, 3)").select(F.col("r_regionkey").alias("old"), (F.col("r_regionkey") + 10).alias("new"))
    return joins.relabelled(table(spark, sf, "nation"), "n_regionkey", mapping).select("n_nationkey", "n_regionkey")


@query("SELECT n_nationkey, (CASE WHEN n_regionkey < 3 THEN 1 + n_regionkey * 0.5 ELSE 1.0 END)::DOUBLE AS gain FROM nation")
def calibration_lookup(spark, sf):
    lut = table(spark, sf, "region").where("r_regionkey < 3").select(F.col("r_regionkey").alias("n_regionkey"), (F.col("r_regionkey") * 0.5 + 1).alias("gain"))
    return joins.calibrated(table(spark, sf, "nation"), "n_regionkey", lut).select("n_nationkey", "gain")


@query("SELECT quality, sum((toxic = 0)::INTEGER)::BIGINT AS as_0, sum((toxic = 1)::INTEGER)::BIGINT AS as_1 FROM labels GROUP BY 1")
def confusion_matrix(spark, sf):
    return stats.confusion(table(spark, sf, "labels"), "quality", "toxic", [0, 1])


@query("""WITH p AS (SELECT quality AS r, 1 - toxic AS p, count(*) AS n FROM labels GROUP BY 1, 2), c AS (SELECT DISTINCT unnest([r, p]) AS class FROM p),
s AS (SELECT class, coalesce((SELECT sum(n) FROM p WHERE r = class), 0)::BIGINT AS ref, coalesce((SELECT sum(n) FROM p WHERE p.p = class), 0)::BIGINT AS got, coalesce((SELECT sum(n) FROM p WHERE r = class AND p.p = class), 0)::BIGINT AS hit FROM c),
t AS (SELECT sum(ref)::DOUBLE AS n, sum(hit)::DOUBLE AS h, sum(ref * got)::DOUBLE AS e FROM s)
SELECT class, ref, got, hit, round(CASE WHEN got = 0 THEN 0 ELSE hit / got::DOUBLE END, 6) AS precision, round(CASE WHEN ref = 0 THEN 0 ELSE hit / ref::DOUBLE END, 6) AS recall, round(CASE WHEN ref + got = 0 THEN 0 ELSE 2 * hit / (ref + got)::DOUBLE END, 6) AS f_score,
  round(h / n, 6) AS accuracy, round(CASE WHEN e / (n * n) = 1 THEN 0 ELSE (h / n - e / (n * n)) / (1 - e / (n * n)) END, 6) AS kappa FROM s, t""")
def classification_metrics(spark, sf):
    a = stats.agreement(table(spark, sf, "labels").withColumn("clean", 1 - F.col("toxic")), "quality", "clean")
    return a.select("class", "ref", "got", "hit", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f_score", "accuracy", "kappa")])


@query("""WITH v AS (SELECT doc_id, unnest([quality, toxic, doc_id % 2]) AS l FROM labels), n AS (SELECT doc_id, l, count(*) AS votes FROM v GROUP BY 1, 2)
SELECT doc_id, l AS fused, votes FROM n QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY votes DESC, l) = 1""")
def majority_fusion(spark, sf):
    v = table(spark, sf, "labels").select("doc_id", F.explode(F.array(F.col("quality").cast("long"), F.col("toxic").cast("long"), F.col("doc_id") % 2)).alias("l"))
    n = v.groupBy("doc_id", "l").agg(F.count("*").alias("votes"))
    best = n.groupBy("doc_id").agg(F.max(F.struct("votes", (-F.col("l")).alias("m"))).alias("x"))
    return best.select("doc_id", (-F.col("x.m")).alias("fused"), F.col("x.votes").alias("votes"))


@query("SELECT label, vec_id FROM embeddings QUALIFY row_number() OVER (PARTITION BY label ORDER BY (vec_id * 7919 + 17) % 104729, vec_id) <= 20")
def sample_per_class(spark, sf):
    key = F.struct((F.col("vec_id") * 7919 + 17) % 104729, "vec_id")
    return sampling.per_class(table(spark, sf, "embeddings").select("label", "vec_id"), "label", key, 20)


@query("WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1) SELECT label, n, least((SELECT min(n) FROM c), 25) AS needed, round(least((SELECT min(n) FROM c), 25) / n::DOUBLE, 6) AS rate FROM c")
def sampling_rates(spark, sf):
    return sampling.class_rates(table(spark, sf, "embeddings"), "label", 25).withColumn("rate", F.round("rate", 6)).select("label", "n", "needed", "rate")


@query("""WITH o AS (SELECT (l_orderkey % 12)::BIGINT AS a, (l_orderkey % 5)::BIGINT AS b, count(*) AS overlap FROM lineitem GROUP BY 1, 2)
SELECT a, b, overlap, (sum(overlap) OVER (PARTITION BY a))::BIGINT AS size_a, (sum(overlap) OVER (PARTITION BY b))::BIGINT AS size_b FROM o""")
def region_overlap(spark, sf):
    t = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 12).alias("a"), (F.col("l_orderkey") % 5).alias("b"))
    return stats.overlap_matrix(t, "a", "b")


_LABELLED = f"WITH RECURSIVE {raster._GRID}, k AS (SELECT r, c, r::BIGINT * {raster.COLS} + c AS id, n % 2 AS lab FROM g), e AS (SELECT x.id AS a, y.id AS b FROM k x JOIN k y ON x.lab = y.lab AND ((y.r = x.r AND abs(y.c - x.c) = 1) OR (y.c = x.c AND abs(y.r - x.r) = 1)))"


@query(f"""{_LABELLED}, w(id, low) USING KEY (id) AS (SELECT id, id FROM k UNION (SELECT e.b AS id, min(w.low) AS low FROM w JOIN e ON e.a = w.id JOIN recurring.w AS u ON u.id = e.b WHERE w.low < u.low GROUP BY e.b))
SELECT k.r AS "row", k.c AS col, w.low AS segment FROM w JOIN k ON k.id = w.id""")
def connected_components(spark, sf):
    c = raster.cells(spark, sf).withColumn("lab", F.col("n") % 2)
    nodes = graph.saved(c.select("row", "col", (F.col("row").cast("long") * raster.COLS + F.col("col")).alias("node"), "lab"))
    edges = graph.grid_edges(nodes, F.col("x.lab") == F.col("y.lab"), raster.COLS)
    return graph.components(nodes, edges).join(nodes, "node").select("row", "col", F.col("label").alias("segment"))


def _one_round(cost: str, threshold: float) -> str:
    """SQL of one round over single cells, of which two have a border of one side and, merged, six sides around them."""
    return f"""WITH {raster._GRID}, k AS (SELECT r::BIGINT * {raster.COLS} + c AS node, lo AS b0, n::DOUBLE AS b1 FROM g),
e AS (SELECT x.node AS a, y.node AS b FROM k x JOIN k y ON y.node = x.node + 1 AND y.node % {raster.COLS} <> 0 UNION ALL SELECT x.node, y.node FROM k x JOIN k y ON y.node = x.node + {raster.COLS}),
q AS (SELECT e.a, e.b, round({cost}, 9) AS cost FROM e JOIN k x ON x.node = e.a JOIN k y ON y.node = e.b),
s AS (SELECT a, b, cost FROM q UNION ALL SELECT b, a, cost FROM q), t AS (SELECT a, b, cost FROM s QUALIFY row_number() OVER (PARTITION BY a ORDER BY cost, b) = 1),
m AS (SELECT t.a, t.b FROM t JOIN t u ON u.a = t.b AND u.b = t.a WHERE t.a < t.b AND t.cost < {threshold})
SELECT coalesce(m.a, k.node) AS node, count(*) AS area, round(avg(b0), 6) AS b0, round(avg(b1), 6) AS b1 FROM k LEFT JOIN m ON m.b = k.node GROUP BY 1"""


@query(_one_round("sqrt((x.b0 - y.b0) ** 2 + (x.b1 - y.b1) ** 2)", 6.0))
def spring_merge_round(spark, sf):
    return _merged_once(spark, sf, graph.spring, 6.0)


def _merged_once(spark, sf, cost, threshold):
    nodes, edges = graph.cell_regions(raster.cells(spark, sf), ["lo", "n"], raster.COLS)
    merged, _ = graph.merge_round(nodes, edges, cost, threshold)
    return merged.select("node", "area", F.round(F.col("s0") / F.col("area"), 6).alias("b0"), F.round(F.col("s1") / F.col("area"), 6).alias("b1"))


@query(_one_round("0.7 * (abs(x.b0 - y.b0) + abs(x.b1 - y.b1)) + 0.3 * (0.3 * (6 * sqrt(2) - 8) + 0.7 * 0)", 4.0))
def baatz_merge_round(spark, sf):
    return _merged_once(spark, sf, graph.baatz, 4.0)


@query(_one_round("((x.b0 - y.b0) ** 2 + (x.b1 - y.b1) ** 2) / 2", 20.0))
def full_lambda_merge_round(spark, sf):
    return _merged_once(spark, sf, graph.full_lambda, 20.0)


@query()
def spring_segmentation(spark, sf):
    nodes, edges = graph.cell_regions(raster.cells(spark, sf), ["lo", "n"], raster.COLS)
    return graph.merge_regions(nodes, edges, graph.spring, 6.0)


_BLOCKS = f"{raster._GRID}, k AS (SELECT r, c, lo, ((r // 4) * 100 + c // 5 * 2 + CASE WHEN lo > 4 THEN 1 ELSE 0 END)::BIGINT AS l FROM g)"


def _blocks(spark, sf):
    """Cells with a label ``l``: blocks of 4 x 5 cells, each cut in two by value."""
    lab = F.expr("row div 4") * 100 + F.expr("col div 5") * 2 + F.when(F.col("lo") > 4, 1).otherwise(0)
    return raster.cells(spark, sf).select("row", "col", "lo", lab.cast("long").alias("l"))


@query(f"""WITH {_BLOCKS}, p AS (SELECT x.l, y.l AS m FROM k x JOIN k y ON y.r = x.r AND y.c = x.c + 1 UNION ALL SELECT x.l, y.l FROM k x JOIN k y ON y.c = x.c AND y.r = x.r + 1),
i AS (SELECT l, count(*) AS n FROM p WHERE l = m GROUP BY 1) SELECT l AS node, count(*) AS area, (4 * count(*) - 2 * coalesce(any_value(i.n), 0))::BIGINT AS perimeter, min(r)::BIGINT AS r0, max(r)::BIGINT AS r1, min(c)::BIGINT AS c0, max(c)::BIGINT AS c1 FROM k LEFT JOIN i USING (l) GROUP BY 1""")
def region_outlines(spark, sf):
    return graph.label_regions(_blocks(spark, sf), "l", ["lo"])[0].select("node", "area", "perimeter", "r0", "r1", "c0", "c1")


@query(f"""WITH {_BLOCKS}, p AS (SELECT x.l, y.l AS m FROM k x JOIN k y ON y.r = x.r AND y.c = x.c + 1 UNION ALL SELECT x.l, y.l FROM k x JOIN k y ON y.c = x.c AND y.r = x.r + 1)
SELECT least(l, m) AS a, greatest(l, m) AS b, count(*) AS boundary FROM p WHERE l <> m GROUP BY 1, 2""")
def region_borders(spark, sf):
    return graph.label_regions(_blocks(spark, sf), "l", ["lo"])[1]


@query()
def small_regions_converged(spark, sf):
    nodes, edges = (graph.saved(f) for f in graph.label_regions(_blocks(spark, sf), "l", ["lo"]))
    return graph.small_regions_absorbed(nodes, edges, 12)[1]


@query("""WITH e AS (SELECT l_suppkey AS segment, l_partkey AS neighbour, max(l_quantity) AS height FROM lineitem GROUP BY 1, 2), f AS (SELECT *, min(height) OVER (PARTITION BY segment) AS low FROM e),
p AS (SELECT *, coalesce(sum((height - low > 40)::INTEGER) OVER (PARTITION BY segment ORDER BY height, neighbour ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS over FROM f)
SELECT segment, neighbour, height, low FROM p WHERE p.over = 0""")
def watershed_prune(spark, sf):
    e = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("segment"), F.col("l_partkey").alias("neighbour")).agg(F.max("l_quantity").alias("height"))
    return graph.pruned_edges(e.withColumn("low", F.min("height").over(Window.partitionBy("segment"))), 40.0)


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_quantity), 6) AS mean, GROUPING_ID(l_returnflag, l_linestatus)::BIGINT AS gid FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def class_cube(spark, sf):
    t = table(spark, sf, "lineitem").cube("l_returnflag", "l_linestatus")
    return t.agg(F.count("*").alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean"), F.grouping_id().alias("gid"))
