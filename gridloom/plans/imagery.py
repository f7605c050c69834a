"""Queries of fusion, resampling, matching, change and vector operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import arrays, geometry
from ..operators import grid as G
from ..operators import imagery as I
from ..sources import names
from . import query, raster, table
from .raster import _GRID, _HOOD, COLS, TOP


@query(f"WITH {_HOOD}, m AS (SELECT r, c, avg(x) AS m, max(x) FILTER (WHERE k = 4) AS x FROM h GROUP BY 1, 2) SELECT r AS \"row\", c AS col, round(CASE WHEN m = 0 THEN NULL ELSE g.v * x / m END, 6) AS v FROM m JOIN g USING (r, c)")
def pansharpening(spark, sf):
    c = raster.cells(spark, sf)
    return I.pansharpened(c.select("row", "col", "lo"), c.select("row", "col", "v"), "lo", "v").withColumn("v", F.round("v", 6))


@query(f"""WITH {_GRID}, o AS (SELECT a.r, b.c FROM (SELECT unnest(range(top + 1)) AS r FROM z) a CROSS JOIN (SELECT unnest(range(20)) AS c) b)
SELECT o.r::INTEGER AS "row", o.c::INTEGER AS col, coalesce(g.lo, -1.0) AS lo FROM o LEFT JOIN g ON g.r = floor(0.5 * o.r + 0.1 * o.c + 2.5)::INTEGER AND g.c = floor(-0.1 * o.r + 0.75 * o.c - 0.5)::INTEGER""")
def affine_resample(spark, sf):
    return I.resampled(raster.cells(spark, sf), "lo", raster.n_rows(spark, sf), 20, (0.5, 0.1, 2.0, -0.1, 0.75, -1.0), -1.0)


@query(f"""WITH {_GRID}, x AS (SELECT * FROM (SELECT unnest(range(9)) AS k)), a AS (SELECT g.r, g.c, k, y.lo AS x FROM g CROSS JOIN x JOIN g y ON y.r = least({TOP}, greatest(0, g.r + k // 3 - 1)) AND y.c = least({COLS - 1}, greatest(0, g.c + k % 3 - 1))),
b AS (SELECT g.r, g.c, k, y.v AS x FROM g CROSS JOIN x JOIN g y ON y.r = least({TOP}, greatest(0, g.r + k // 3 - 1)) AND y.c = least({COLS - 1}, greatest(0, g.c + k % 3 - 1))),
d AS (SELECT a.r, a.c, s, sum((a.x - b.x) ** 2) AS cost FROM a CROSS JOIN (SELECT unnest([-2, -1, 0, 1, 2]) AS s) JOIN b ON b.r = a.r AND b.c = a.c + s AND b.k = a.k GROUP BY 1, 2, 3)
SELECT r AS "row", c AS col, s::INTEGER AS shift, cost FROM d QUALIFY row_number() OVER (PARTITION BY r, c ORDER BY cost, s) = 1""")
def block_matching(spark, sf):
    c = raster.cells(spark, sf)
    return I.disparity(c.select("row", "col", "lo"), c.select("row", "col", F.col("v").alias("lo")), "lo", 2)


@query(f"WITH {_GRID} SELECT r AS \"row\", c AS col, CASE WHEN lo = 1 THEN -9.0 ELSE lo END AS lo, CASE WHEN lo = 1 THEN 0 ELSE 1 END AS valid FROM g")
def manage_no_data(spark, sf):
    return I.with_no_data(raster.cells(spark, sf).select("row", "col", "lo"), "lo", 1.0, -9.0)


@query(f"""WITH {_GRID}, b AS (SELECT r, c, least(15, greatest(0, floor(lo / 51 * 16)))::INTEGER AS b FROM g), f AS (SELECT k, (SELECT count(*) FROM b WHERE b.b = k) AS f FROM (SELECT unnest(range(16)) AS k)),
u AS (SELECT k, round(sum(f) OVER (ORDER BY k) / (SELECT sum(f) FROM f)::DOUBLE * 255)::INTEGER AS e FROM f) SELECT r AS "row", c AS col, e AS equalised FROM b JOIN u ON k = b""")
def contrast_equalisation(spark, sf):
    return I.equalised(raster.cells(spark, sf), "lo", 0.0, 51.0, 16, 255).select("row", "col", "equalised")


#: Two end members, which must have as many bands as the vectors.
_ENDS = np.array([[1.0 if k % 2 else 0.2 for k in range(64)], [(k + 1) / 64 for k in range(64)]])
_INVERSE = np.linalg.pinv(_ENDS.T)


@query("SELECT vec_id, " + ", ".join(f"round({' + '.join(f'embedding[{i + 1}]::DOUBLE * {float(w)!r}' for i, w in enumerate(row))}, 5) AS a{k}" for k, row in enumerate(_INVERSE)) + " FROM embeddings")
def hyperspectral_unmixing(spark, sf):
    x = arrays.doubles(F.col("embedding"))
    return table(spark, sf, "embeddings").select("vec_id", *[F.round(c, 5).alias(f"a{k}") for k, c in enumerate(I.linear_unmixing(x, _ENDS))])


@query("""WITH c AS (SELECT l_orderkey, l_partkey, l_linenumber, l_tax AS h, l_discount AS i, l_quantity / 50 AS v FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber, round((h + v) ** 2 / 2 + i * i / 2, 6) AS single, round((h - v) ** 2 / 2 + i * i / 2, 6) AS double_, round(2 * (h * h + i * i), 6) AS volume FROM c""")
def pauli_decomposition(spark, sf):
    h, i, v = F.col("l_tax"), F.col("l_discount"), F.col("l_quantity") / 50
    a, b, c = I.pauli((h, i), (h, i), (v, F.lit(0.0)))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.round(a, 6).alias("single"), F.round(b, 6).alias("double_"), F.round(c, 6).alias("volume"))


@query(f"""WITH {_HOOD}, s AS (SELECT r, c, sum(x * [-1, 0, 1, -2, 0, 2, -1, 0, 1][k + 1]) / 80 AS gx, sum(x * [-1, -2, -1, 0, 0, 0, 1, 2, 1][k + 1]) / 80 AS gy,
  sum(x * [0, 0, 0, 1, -2, 1, 0, 0, 0][k + 1]) AS xx, sum(x * [0, 1, 0, 0, -2, 0, 0, 1, 0][k + 1]) AS yy, sum(x * [0.25, 0, -0.25, 0, 0, 0, -0.25, 0, 0.25][k + 1]) AS xy FROM h GROUP BY 1, 2)
SELECT r AS "row", c AS col, round(greatest(0, cos(radians(45)) * cos(atan(sqrt(gx * gx + gy * gy))) + sin(radians(45)) * sin(atan(sqrt(gx * gx + gy * gy))) * cos(pi() / 2 - radians(315) - atan2(gy, -gx))) * 255, 4) AS light,
  round(xx * yy - xy * xy - 0.05 * (xx + yy) ** 2, 6) AS corner FROM s""")
def terrain_and_corners(spark, sf):
    h = F.col("hood")
    x, y = G.convolve(h, G.SOBEL_X) / 80, G.convolve(h, G.SOBEL_Y) / 80
    xx, yy, xy = G.convolve(h, [0, 0, 0, 1, -2, 1, 0, 0, 0]), G.convolve(h, [0, 1, 0, 0, -2, 0, 0, 1, 0]), G.convolve(h, [0.25, 0, -0.25, 0, 0, 0, -0.25, 0, 0.25])
    return G.stencil(raster.cells(spark, sf), "lo").select("row", "col", F.round(I.shaded(x, y), 4).alias("light"), F.round(G.hessian_score(xx, yy, xy, 0.05), 6).alias("corner"))


_GABOR = G.gabor_weights(1, 0.5, 0.5, 30, 0.2, 0.1, 0)


@query(f"WITH {_HOOD} SELECT r AS \"row\", c AS col, round(sum(x * [{', '.join(map(repr, _GABOR))}][k + 1]), 6) AS response FROM h GROUP BY 1, 2")
def gabor_filter(spark, sf):
    return G.stencil(raster.cells(spark, sf), "lo").select("row", "col", F.round(G.convolve(F.col("hood"), _GABOR), 6).alias("response"))


@query("""WITH v AS (SELECT doc_id, unnest([quality, toxic, (doc_id % 2)::INTEGER]) AS l, unnest([0.6, 0.7, 0.5]) AS m FROM labels), p AS (SELECT doc_id, l, exp(sum(ln(1 - m))) AS own FROM v GROUP BY 1, 2),
a AS (SELECT *, exp(sum(ln(own)) OVER (PARTITION BY doc_id)) AS every FROM p), q AS (SELECT *, (1 - own) * every / own AS mass FROM a), b AS (SELECT doc_id, l, round(mass / (sum(mass) OVER (PARTITION BY doc_id) + every), 9) AS belief FROM q)
SELECT doc_id, l AS fused, round(belief, 6) AS belief FROM b QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY b.belief DESC, l) = 1""")
def dempster_shafer_fusion(spark, sf):
    votes = F.array(*[F.struct(l.cast("int").alias("l"), F.lit(m).alias("m")) for l, m in ((F.col("quality"), 0.6), (F.col("toxic"), 0.7), (F.col("doc_id") % 2, 0.5))])
    v = table(spark, sf, "labels").select("doc_id", F.explode(votes).alias("v")).select("doc_id", "v.l", "v.m")
    return I.dempster_shafer(v, "doc_id", "l", "m").select("doc_id", F.col("l").alias("fused"), F.round("belief", 6).alias("belief"))


def _diamonds(spark, sf):
    k = F.col("n_nationkey")
    x, y = k % 5 * 6.0, F.expr("n_nationkey div 5") * 5.0
    at = lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))
    return table(spark, sf, "nation").select((k + 1).alias("zone"), F.array(at(x + 3.25, y), at(x + 6.25, y + 3.0), at(x + 3.25, y + 6.0), at(x + 0.25, y + 3.0)).alias("ring"))


@query(f"""WITH {_GRID}, d AS (SELECT n_nationkey + 1 AS zone, (n_nationkey % 5) * 6.0 + 3.25 AS x, (n_nationkey // 5) * 5.0 + 3 AS y FROM nation)
SELECT g.r AS "row", g.c AS col, coalesce(min(zone), 0)::INTEGER AS zone FROM g LEFT JOIN d ON abs(g.c + 0.5 - x) + abs(g.r + 0.5 - y) < 3 GROUP BY 1, 2""")
def rasterization(spark, sf):
    return I.rasterised(raster.cells(spark, sf), _diamonds(spark, sf), 6.0)


@query(f"""WITH {_GRID}, d AS (SELECT n_nationkey + 1 AS zone, (n_nationkey % 5) * 6.0 + 3.25 AS x, (n_nationkey // 5) * 5.0 + 3 AS y FROM nation)
SELECT zone, count(*) AS nb_cells, round(avg(lo), 6) AS mean, round(var_samp(lo), 6) AS variance FROM g JOIN d ON abs(g.c + 0.5 - x) + abs(g.r + 0.5 - y) < 3 GROUP BY 1""")
def objects_radiometry(spark, sf):
    from ..operators import joins

    c = raster.cells(spark, sf).select("lo", (F.col("col") + 0.5).alias("x"), (F.col("row") + 0.5).alias("y"))
    return joins.points_in_rings(c, _diamonds(spark, sf), 6.0).groupBy("zone").agg(F.count("*").alias("nb_cells"), F.round(F.avg("lo"), 6).alias("mean"), F.round(F.var_samp("lo"), 6).alias("variance"))


@query("""WITH p AS (SELECT s_suppkey, unnest([0, 1, 2]) AS k, unnest([0.0, s_suppkey % 9 + 1.0, s_suppkey % 4 + 0.0])::DOUBLE AS x, unnest([0.0, 0.0, s_suppkey % 23 + 1.0])::DOUBLE AS y FROM supplier)
SELECT s_suppkey, k AS vertex, round(2 * (cos(radians(30)) * x - sin(radians(30)) * y) + 5, 6) AS x, round(2 * (sin(radians(30)) * x + cos(radians(30)) * y) - 1, 6) AS y FROM p""")
def vector_transform(spark, sf):
    k = F.col("s_suppkey")
    at = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    ring = F.array(at(F.lit(0), F.lit(0)), at(k % 9 + 1, F.lit(0)), at(k % 4, k % 23 + 1))
    out = table(spark, sf, "supplier").select("s_suppkey", F.posexplode(I.moved(ring, 30, 2, 5.0, -1.0)).alias("vertex", "p"))
    return out.select("s_suppkey", "vertex", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


@query("SELECT l_orderkey, l_partkey, l_linenumber, greatest(0, least(255, round(l_extendedprice / 300)))::SMALLINT AS cell FROM lineitem")
def convert_cells(spark, sf):
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", (F.col("l_extendedprice") / 300).alias("cell"))
    return names.cast_cells(t, "cell", "uint8")


@query(f"""WITH {_GRID}, s AS (SELECT r, c, lo, (r // 4) * 100 + c // 5 * 2 + CASE WHEN lo > 4 THEN 1 ELSE 0 END AS lab FROM g), st AS (SELECT lab, count(*) AS n, avg(lo) AS m FROM s GROUP BY 1),
p AS (SELECT DISTINCT x.lab AS a, y.lab AS b FROM s x JOIN s y ON abs(x.r - y.r) + abs(x.c - y.c) = 1 AND x.lab <> y.lab), q AS (SELECT a, b, round(abs(u.m - w.m), 9) AS d FROM p JOIN st u ON u.lab = a JOIN st w ON w.lab = b WHERE u.n < 6),
t AS (SELECT a, b FROM q QUALIFY row_number() OVER (PARTITION BY a ORDER BY d, b) = 1) SELECT s.r AS "row", s.c AS col, coalesce(t.b, s.lab)::BIGINT AS lab FROM s LEFT JOIN t ON t.a = s.lab""")
def small_regions(spark, sf):
    lab = F.expr("row div 4") * 100 + F.expr("col div 5") * 2 + F.when(F.col("lo") > 4, 1).otherwise(0)
    c = raster.cells(spark, sf).select("row", "col", "lo", lab.alias("lab"))
    return I.small_regions_merged(c, "lab", "lo", 6).select("row", "col", "lab")


@query()
def alteration_detector(spark, sf):
    c = raster.cells(spark, sf).select("row", "col", F.col("v").alias("a0"), F.col("n").cast("double").alias("a1"), F.col("lo").alias("b0"), (F.col("v") + F.col("lo")).alias("b1"))
    return I.alteration(c, ["a0", "a1"], ["b0", "b1"])


@query()
def mean_shift_smoothing(spark, sf):
    return I.mean_shift(raster.cells(spark, sf), "lo", 12, 1, 2.0, 4)


@query()
def fourier_transform(spark, sf):
    tiles = raster.cells(spark, sf).withColumn("image", F.expr("cast(row div 24 as int)")).withColumn("row", F.col("row") % 24)
    return I.spectrum(tiles, "image", "lo")


@query()
def simplified_paths(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.struct("event_id", (F.col("event_id") % 50).cast("double").alias("x"), (F.col("event_id") * 7 % 31).cast("double").alias("y")).alias("p"))
    paths = e.groupBy("user_id").agg(F.sort_array(F.collect_list("p")).alias("q")).select("user_id", F.transform("q", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"))
    return I.simplified(paths, "points", 5.0).select("user_id", geometry.well_known_text(F.col("points")).alias("wkt"))


@query()
def burned_paths(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("path"), F.col("event_id").alias("seq"), (F.col("event_id") % 50).cast("double").alias("x"), (F.col("event_id") * 7 % 31).cast("double").alias("y"))
    return I.drawn_paths(e)
