"""Queries of vector kernels, surfaces between nodes, histograms and matching."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import arrays
from ..operators import surfaces as S
from . import query, raster, table
from .raster import _GRID

_V = "e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), w AS (SELECT *, list_transform(v, lambda x: abs(x)) AS a, list_transform(range(64), lambda i: (i % 5) / 5 - 0.4) AS f FROM e), s AS (SELECT *, list_sum(a) AS n, list_max(v) AS top FROM w)"


@query(f"""WITH {_V} SELECT vec_id, round(list_dot_product(v, f), 5) AS dot, round(list_sum(list_transform(list_zip(v, f), lambda p: 2.5 * p[1] + p[2])), 5) AS axpy_sum, round(list_max(list_transform(v, lambda x: exp(x - top))) / list_sum(list_transform(v, lambda x: exp(x - top))), 6) AS softmax_top,
  round(-list_sum(list_transform(a, lambda x: CASE WHEN x > 0 THEN x / n * ln(x / n) ELSE 0 END)), 5) AS entropy, round(exp(-list_sum(list_transform(list_zip(v, f), lambda p: (p[1] - p[2]) ** 2)) / 8), 6) AS basis, round(list_sum(list_transform(v, lambda x: x * x)) / 64, 6) AS mse FROM s""")
def vector_kernels(spark, sf):
    v = arrays.doubles(F.col("embedding"))
    f = F.array(*[F.lit((i % 5) / 5 - 0.4) for i in range(64)])
    size = F.transform(v, lambda x: F.abs(x))
    total = F.aggregate(arrays.axpy(2.5, v, f), F.lit(0.0), lambda s, x: s + x)
    out = {"dot": (arrays.dot(v, f), 5), "axpy_sum": (total, 5), "softmax_top": (F.array_max(arrays.softmax(v)), 6), "entropy": (arrays.entropy(arrays.shares(size)), 5), "basis": (arrays.radial_basis(v, f, 2.0), 6), "mse": (arrays.mean_squared(v), 6)}
    return table(spark, sf, "embeddings").select("vec_id", *(F.round(c, n).alias(name) for name, (c, n) in out.items()))


@query("SELECT l_suppkey, count(*) AS n, round(sum(l_linenumber / 3 - l_quantity * ln(l_linenumber / 3)), 4) AS loss, (max(l_quantity)::INTEGER % 5)::INTEGER AS modulus FROM lineitem GROUP BY 1")
def poisson_scores(spark, sf):
    t = table(spark, sf, "lineitem")
    loss = arrays.poisson_loss(F.col("l_quantity"), F.col("l_linenumber") / 3)
    return t.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.round(F.sum(loss), 4).alias("loss"), (F.max("l_quantity").cast("int") % 5).alias("modulus"))


@query(f"""WITH {_GRID}, p AS (SELECT c_custkey, (c_custkey * 29 % 101) * 0.3::DOUBLE + 0.0625 AS x, (c_custkey * 31 % 97) * 0.7::DOUBLE + 0.03125 AS y FROM customer), q AS (SELECT *, floor(x)::INTEGER AS c0, floor(y)::INTEGER AS r0, x - floor(x) AS fu, y - floor(y) AS fv FROM p)
SELECT c_custkey, round((1 - fu) * (1 - fv) * a.lo + fu * (1 - fv) * b.lo + (1 - fu) * fv * c.lo + fu * fv * d.lo, 5) AS lo FROM q JOIN g a ON a.r = r0 AND a.c = c0 JOIN g b ON b.r = r0 AND b.c = c0 + 1 JOIN g c ON c.r = r0 + 1 AND c.c = c0 JOIN g d ON d.r = r0 + 1 AND d.c = c0 + 1""")
def surface_heights(spark, sf):
    k = F.col("c_custkey")
    p = table(spark, sf, "customer").select("c_custkey", (k * 29 % 101 * F.lit(0.3) + 0.0625).alias("x"), (k * 31 % 97 * F.lit(0.7) + 0.03125).alias("y"))
    return S.interpolated(p, raster.cells(spark, sf), "lo", "c_custkey").withColumn("lo", F.round("lo", 5))


@query(f"""WITH {_GRID}, s AS (SELECT r, c, r + ((n % 4) * sqrt(0.1::DOUBLE) + sqrt(0.02::DOUBLE)) AS y, c + (sqrt(0.003::DOUBLE) - (n % 3) * sqrt(0.4::DOUBLE)) AS x FROM g), q AS (SELECT *, floor(x)::INTEGER AS c0, floor(y)::INTEGER AS r0, x - floor(x) AS fu, y - floor(y) AS fv FROM s)
SELECT q.r AS "row", q.c AS col, round((1 - fu) * (1 - fv) * a.lo + fu * (1 - fv) * b.lo + (1 - fu) * fv * e.lo + fu * fv * d.lo, 5) AS lo FROM q JOIN g a ON a.r = r0 AND a.c = c0 JOIN g b ON b.r = r0 AND b.c = c0 + 1 JOIN g e ON e.r = r0 + 1 AND e.c = c0 JOIN g d ON d.r = r0 + 1 AND d.c = c0 + 1""")
def grid_resampling(spark, sf):
    g = raster.cells(spark, sf)
    shifts = g.select("row", "col", (F.col("n") % 4 * F.lit(math.sqrt(0.1)) + math.sqrt(0.02)).alias("dr"), (math.sqrt(0.003) - F.col("n") % 3 * F.lit(math.sqrt(0.4))).alias("dc"))
    return S.resampled_by_shifts(g, "lo", shifts).withColumn("lo", F.round("lo", 5))


_BANDS = ["l_quantity", "l_discount", "l_tax"]


@query(" UNION ALL ".join(f"SELECT '{b}' AS band, greatest(0, least(15, floor({b} / 50 * 16)))::INTEGER AS bin, count(*) AS freq FROM lineitem GROUP BY 2" for b in _BANDS))
def band_histograms(spark, sf):
    return S.band_histograms(table(spark, sf, "lineitem"), _BANDS, 0.0, 50.0, 16)


@query("WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem) SELECT l_orderkey, l_partkey, l_linenumber, round(100 + (l_extendedprice - m) * 20 / s, 4) AS v FROM lineitem, s")
def brightness_match(spark, sf):
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_extendedprice").alias("v"))
    return S.brightness_matched(t, "v", 100.0, 20.0).withColumn("v", F.round("v", 4))


@query("""SELECT event_id, round(CASE WHEN value < 10.3 OR value > 80.2 THEN 0 WHEN value < 30.4 THEN (value - 10.3) / 20.1 WHEN value <= 60.9 THEN 1 ELSE (80.2 - value) / 19.3 END, 5) AS membership FROM events""")
def fuzzy_membership(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round(S.membership(F.col("value"), 10.3, 30.4, 60.9, 80.2), 5).alias("membership"))


@query(f"""WITH RECURSIVE {_GRID}, k AS (SELECT r, c FROM g WHERE lo BETWEEN 1 AND 9), w AS (SELECT r, c FROM k WHERE (r, c) IN (SELECT (s_suppkey % 40)::INTEGER, (s_suppkey % 30)::INTEGER FROM supplier) UNION SELECT k.r, k.c FROM w JOIN k ON abs(k.r - w.r) + abs(k.c - w.c) = 1)
SELECT r AS "row", c AS col FROM w""")
def region_growing(spark, sf):
    k = F.col("s_suppkey")
    seeds = table(spark, sf, "supplier").select((k % 40).cast("int").alias("row"), (k % 30).cast("int").alias("col"))
    return S.grown(raster.cells(spark, sf), "lo", seeds, 1.0, 9.0, raster.COLS)


@query(f"WITH {_GRID}, s AS (SELECT r // 10 AS slice, r % 10 AS i, c, lo FROM g) SELECT i AS \"row\", c AS col, round(avg(lo), 6) AS lo, count(*) AS slices FROM s GROUP BY 1, 2")
def average_slice(spark, sf):
    """Mean over the slices of a stack, cell by cell."""
    g = raster.cells(spark, sf).withColumn("slice", F.expr("row div 10")).withColumn("row", F.col("row") % 10)
    return g.groupBy("row", "col").agg(F.round(F.avg("lo"), 6).alias("lo"), F.count("*").alias("slices"))
