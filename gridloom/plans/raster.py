"""Queries over a grid that grows with the table: a row of cells for every ROW order keys, columns by part key.

Its values are smallest and largest quantities and counts, which no order of summing can change.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid as G
from ..operators import sampling, stats
from . import query, table

#: Order keys to a row of cells, and columns.
ROW, COLS = 25, 30
#: The last row, in SQL.
TOP = "(SELECT top FROM z)"

_GRID = f"""z AS (SELECT coalesce(max(l_orderkey) // {ROW}, -1)::INTEGER AS top FROM lineitem),
c AS (SELECT (l_orderkey // {ROW})::INTEGER AS r, (l_partkey % {COLS})::INTEGER AS c, max(l_quantity) AS q, min(l_quantity) AS lo, count(*) AS n FROM lineitem GROUP BY 1, 2),
g AS (SELECT a.r, b.c, coalesce(c.q, 0.0) AS v, coalesce(c.lo, 0.0) AS lo, coalesce(c.n, 0) AS n FROM (SELECT unnest(range(top + 1))::INTEGER AS r FROM z) a CROSS JOIN (SELECT unnest(range({COLS}))::INTEGER AS c) b LEFT JOIN c ON c.r = a.r AND c.c = b.c)"""
_HOOD = f"""{_GRID},
o AS (SELECT unnest(range(9)) AS k),
h AS (SELECT g.r, g.c, o.k, x.lo AS x FROM g CROSS JOIN o JOIN g x ON x.r = least({TOP}, greatest(0, g.r + o.k // 3 - 1)) AND x.c = least({COLS - 1}, greatest(0, g.c + o.k % 3 - 1)))"""


def n_rows(spark, sf) -> int:
    """Rows of the grid; 0 for an empty table."""
    top = table(spark, sf, "lineitem").agg(F.max("l_orderkey")).first()[0]
    return 0 if top is None else top // ROW + 1


def cells(spark, sf):
    """(row, col, v, lo, n) of every cell."""
    t = table(spark, sf, "lineitem")
    made = t.groupBy(F.expr(f"cast(l_orderkey div {ROW} as int)").alias("row"), (F.col("l_partkey") % COLS).cast("int").alias("col")).agg(F.max("l_quantity").alias("v"), F.min("l_quantity").alias("lo"), F.count("*").alias("n"))
    return G.filled(made, n_rows(spark, sf), COLS, {"v": 0.0, "lo": 0.0, "n": 0})


@query(f"WITH {_HOOD} SELECT r AS \"row\", c AS col, round(avg(x), 6) AS mean, round(var_samp(x), 6) AS variance, list_sort(list(x))[5] AS median, sum(x * x) AS sum_of_squares, min(x) AS eroded, max(x) AS dilated FROM h GROUP BY 1, 2")
def neighbourhood(spark, sf):
    h = G.stencil(cells(spark, sf), "lo")
    x = F.col("hood")
    return h.select("row", "col", F.round(G.hood_mean(x), 6).alias("mean"), F.round(G.hood_variance(x), 6).alias("variance"), G.hood_median(x).alias("median"), G.hood_sum_of_squares(x).alias("sum_of_squares"), F.array_min(x).alias("eroded"), F.array_max(x).alias("dilated"))


@query(f"""WITH {_HOOD}, s AS (SELECT r, c, sum(x * [-1, 0, 1, -2, 0, 2, -1, 0, 1][k + 1]) AS gx, sum(x * [-1, -2, -1, 0, 0, 0, 1, 2, 1][k + 1]) AS gy FROM h GROUP BY 1, 2)
SELECT r AS "row", c AS col, round(sqrt(gx * gx + gy * gy), 6) AS gradient, round(degrees(atan(sqrt(gx * gx + gy * gy) / 8)), 6) AS slope FROM s""")
def edge_gradient(spark, sf):
    h = G.stencil(cells(spark, sf), "lo")
    gx, gy = G.convolve(F.col("hood"), G.SOBEL_X), G.convolve(F.col("hood"), G.SOBEL_Y)
    size = F.sqrt(gx * gx + gy * gy)
    return h.select("row", "col", F.round(size, 6).alias("gradient"), F.round(F.degrees(F.atan(size / 8)), 6).alias("slope"))


_WEIGHTS = ", ".join(repr(w) for w in G.gaussian_weights(1, 1.0))


@query(f"WITH {_HOOD} SELECT r AS \"row\", c AS col, round(sum(x * [{_WEIGHTS}][k + 1]), 6) AS smooth FROM h GROUP BY 1, 2")
def gaussian_smoothing(spark, sf):
    return G.stencil(cells(spark, sf), "lo").select("row", "col", F.round(G.convolve(F.col("hood"), G.gaussian_weights(1, 1.0)), 6).alias("smooth"))


@query(f"""WITH {_HOOD}, m AS (SELECT r, c, avg(x) AS m, var_samp(x) AS v, max(x) FILTER (WHERE k = 4) AS x FROM h GROUP BY 1, 2)
SELECT r AS "row", c AS col, round(m + CASE WHEN v <= 0 THEN 0 ELSE greatest(0, (v - m * m / 4) / (v * 1.25)) END * (x - m), 6) AS filtered FROM m""")
def despeckle(spark, sf):
    return G.stencil(cells(spark, sf), "lo").select("row", "col", F.round(G.despeckle_lee(F.col("hood"), 4.0), 6).alias("filtered"))


@query(f"""WITH {_HOOD}, n AS (SELECT r, c, x::INTEGER % 3 AS lab, count(*) AS n FROM h GROUP BY ALL)
SELECT r AS "row", c AS col, lab AS majority FROM n QUALIFY row_number() OVER (PARTITION BY r, c ORDER BY n DESC, lab) = 1""")
def majority_filter(spark, sf):
    g = cells(spark, sf).withColumn("lab", F.col("lo").cast("int") % 3)
    return G.stencil(g, "lab").select("row", "col", G.majority(F.col("hood")).alias("majority"))


@query(f"""WITH {_HOOD}, e AS (SELECT r, c, min(x) AS x FROM h GROUP BY 1, 2),
op AS (SELECT e.r, e.c, max(y.x) AS opened FROM e CROSS JOIN (SELECT unnest(range(9)) AS k) o JOIN e y ON y.r = least({TOP}, greatest(0, e.r + o.k // 3 - 1)) AND y.c = least({COLS - 1}, greatest(0, e.c + o.k % 3 - 1)) GROUP BY 1, 2),
d AS (SELECT r, c, max(x) AS x FROM h GROUP BY 1, 2),
q AS (SELECT d.r, d.c, min(y.x) AS closed FROM d CROSS JOIN (SELECT unnest(range(9)) AS k) o JOIN d y ON y.r = least({TOP}, greatest(0, d.r + o.k // 3 - 1)) AND y.c = least({COLS - 1}, greatest(0, d.c + o.k % 3 - 1)) GROUP BY 1, 2)
SELECT g.r AS "row", g.c AS col, opened, closed, CASE WHEN g.lo - opened > closed - g.lo THEN 'convex' WHEN g.lo - opened < closed - g.lo THEN 'concave' ELSE 'flat' END AS kind FROM g JOIN op USING (r, c) JOIN q USING (r, c)""")
def morphological_classes(spark, sf):
    a = G.stencil(cells(spark, sf), "lo")
    a = a.withColumn("low", F.array_min("hood")).withColumn("high", F.array_max("hood"))
    a = G.stencil(a.drop("hood"), "low", name="lows")
    a = G.stencil(a, "high", name="highs").withColumn("opened", F.array_max("lows")).withColumn("closed", F.array_min("highs"))
    up, down = F.col("lo") - F.col("opened"), F.col("closed") - F.col("lo")
    return a.select("row", "col", "opened", "closed", F.when(up > down, "convex").when(up < down, "concave").otherwise("flat").alias("kind"))


@query(f"""WITH {_GRID}, b AS (SELECT r, c, unnest([v, lo, n::DOUBLE]) AS x, unnest([0, 1, 2]) AS band FROM g UNION ALL SELECT r, c, unnest([lo, v, 1.0]), unnest([0, 1, 2]) FROM g)
SELECT r AS "row", c AS col, band, sum(x) AS v FROM b GROUP BY 1, 2, 3""")
def band_sum_stack(spark, sf):
    g = cells(spark, sf)
    one = g.select("row", "col", F.array("v", "lo", F.col("n").cast("double")).alias("bands"))
    return G.summed(one, g.select("row", "col", F.array("lo", "v", F.lit(1.0)).alias("bands")))


@query(f"""WITH {_GRID}, a AS (SELECT r, c, v FROM g WHERE c < 20), b AS (SELECT r, c, lo AS v FROM g WHERE c >= 10)
SELECT r AS "row", c AS col, round(avg(v), 6) AS v, count(*) AS n FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1, 2""")
def mosaic(spark, sf):
    g = cells(spark, sf)
    out = G.mosaic(g.where("col < 20").select("row", "col", "v"), g.where("col >= 10").select("row", "col", F.col("lo").alias("v")), value="v")
    return out.withColumn("v", F.round("v", 6))


@query(f"WITH {_GRID} SELECT l AS level, r // (2 ** l)::INTEGER AS \"row\", c // (2 ** l)::INTEGER AS col, round(avg(v), 6) AS v FROM g CROSS JOIN (SELECT unnest([1, 2, 3])::INTEGER AS l) GROUP BY 1, 2, 3")
def pyramid(spark, sf):
    return G.pyramid(cells(spark, sf), "v", 3).withColumn("v", F.round("v", 6))


@query(f"WITH {_GRID} SELECT r - 4 AS \"row\", c - 5 AS col, v, n FROM g WHERE r BETWEEN 4 AND 13 AND c BETWEEN 5 AND 16")
def extract_roi(spark, sf):
    return G.crop(cells(spark, sf), 4, 5, 10, 12).select("row", "col", "v", "n")


@query(f"WITH {_GRID} SELECT r // 3 AS \"row\", c // 3 AS col, v FROM g WHERE r % 3 = 0 AND c % 3 = 0")
def quicklook(spark, sf):
    return sampling.decimated(cells(spark, sf), 3).select("row", "col", "v")


@query(f"""WITH {_GRID}, t AS (SELECT r // 8 AS tr, c // 10 AS tc, r % 8 AS r, c % 10 AS c, v FROM g) SELECT tr * 8 + r AS "row", tc * 10 + c AS col, v FROM t""")
def tile_fusion(spark, sf):
    g = cells(spark, sf)
    tiles = g.select(F.expr("cast(row div 8 as int)").alias("tile_row"), F.expr("cast(col div 10 as int)").alias("tile_col"), (F.col("row") % 8).alias("row"), (F.col("col") % 10).alias("col"), "v")
    return G.fused_tiles(tiles, 8, 10)


@query(f"WITH {_GRID}, s AS (SELECT min(n) AS a, max(n) AS b FROM g) SELECT r AS \"row\", c AS col, round(CASE WHEN b = a THEN 0 ELSE (n - a) / (b - a)::DOUBLE * 255 END, 6) AS n FROM g, s")
def rescale(spark, sf):
    return G.rescaled(cells(spark, sf).select("row", "col", "n"), "n", 0.0, 255.0).withColumn("n", F.round("n", 6))


@query(f"WITH {_GRID} SELECT round(avg((v - lo) ** 2), 6) AS mse, round(avg(abs(v - lo)), 6) AS mae, round(CASE WHEN avg((v - lo) ** 2) > 0 THEN 10 * log10(max(v) * max(v) / avg((v - lo) ** 2)) END, 6) AS psnr, sum((v <> lo)::INTEGER)::BIGINT AS n_different FROM g")
def compare_images(spark, sf):
    d = stats.difference(cells(spark, sf), F.col("v"), F.col("lo"))
    return d.select(*[F.round(c, 6).alias(c) for c in ("mse", "mae", "psnr")], "n_different")


@query(f"WITH {_GRID} SELECT count(*) AS n_cells, max(r) + 1 AS n_rows, max(c) + 1 AS n_cols, round(avg(v), 6) AS mean_v, round(stddev_samp(v), 6) AS sd_v, round(avg(lo), 6) AS mean_lo, round(stddev_samp(lo), 6) AS sd_lo FROM g")
def image_info(spark, sf):
    return cells(spark, sf).agg(F.count("*").alias("n_cells"), (F.max("row") + 1).alias("n_rows"), (F.max("col") + 1).alias("n_cols"), F.round(F.avg("v"), 6).alias("mean_v"), F.round(F.stddev_samp("v"), 6).alias("sd_v"), F.round(F.avg("lo"), 6).alias("mean_lo"), F.round(F.stddev_samp("lo"), 6).alias("sd_lo"))


@query(f"""WITH {_GRID}, b AS (SELECT r, c, least(7, greatest(0, floor(lo / 51 * 8)))::INTEGER AS b FROM g), p AS (SELECT b AS i, lead(b) OVER (PARTITION BY r ORDER BY c) AS j FROM b),
q AS (SELECT i, j FROM p WHERE j IS NOT NULL UNION ALL SELECT j, i FROM p WHERE j IS NOT NULL), f AS (SELECT i, j, count(*) / (SELECT count(*) FROM q)::DOUBLE AS p FROM q GROUP BY 1, 2), m AS (SELECT sum(i * p) AS m, sum(i * i * p) AS q FROM f)
SELECT round(sum(p * p), 6) AS energy, round(-sum(p * log2(p)), 6) AS entropy, round(sum((i - j) ** 2 * p), 6) AS contrast, round(sum(p / (1 + (i - j) ** 2)), 6) AS homogeneity,
  round(CASE WHEN any_value(q - m * m) > 0 THEN sum((i - m) * (j - m) * p) / any_value(q - m * m) ELSE 0 END, 6) AS correlation FROM f, m""")
def haralick_texture(spark, sf):
    t = G.texture(G.cooccurrence(cells(spark, sf), "lo", 8, 0.0, 51.0))
    return t.select(*[F.round(c, 6).alias(c) for c in t.columns])


_HIST = "h AS (SELECT b, (SELECT count(*) FROM lineitem WHERE least(63, greatest(0, floor((l_extendedprice - 0) / 105000 * 64))) = b) AS f FROM (SELECT unnest(range(64)) AS b)), p AS (SELECT b, f / (SELECT sum(f) FROM h)::DOUBLE AS p FROM h)"
_RUN = f"{_HIST}, s AS (SELECT b, sum(p) OVER u AS p1, sum(p * p) OVER u AS s1, coalesce(sum(p * p) OVER (ORDER BY b ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS s2, sum(p * b) OVER u AS m1, sum(p * b) OVER () AS mt FROM p WINDOW u AS (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"


def _price_histogram(spark, sf):
    return stats.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 0.0, 105000.0, 64)


@query("WITH " + _HIST + " SELECT b::INTEGER AS bin, f AS freq FROM h")
def value_histogram(spark, sf):
    return _price_histogram(spark, sf)


@query(f"WITH {_RUN}, k AS (SELECT b, round(-(CASE WHEN s1 * s2 > 0 THEN ln(s1 * s2) ELSE 0 END) + 2 * CASE WHEN p1 * (1 - p1) > 0 THEN ln(p1 * (1 - p1)) ELSE 0 END, 9) AS k FROM s) SELECT b::INTEGER AS threshold_bin, round(k, 6) AS criterion FROM k ORDER BY k.k DESC, b LIMIT 1")
def yen_threshold(spark, sf):
    return stats.yen_threshold(_price_histogram(spark, sf)).withColumn("criterion", F.round("criterion", 6))


@query(f"WITH {_RUN}, k AS (SELECT b, round(CASE WHEN p1 * (1 - p1) > 1e-12 THEN (mt * p1 - m1) ** 2 / (p1 * (1 - p1)) ELSE 0 END, 9) AS k FROM s) SELECT b::INTEGER AS threshold_bin, round(k, 6) AS criterion FROM k ORDER BY k.k DESC, b LIMIT 1")
def otsu_threshold(spark, sf):
    return stats.otsu_threshold(_price_histogram(spark, sf)).withColumn("criterion", F.round("criterion", 6))


@query("WITH f AS (SELECT floor(l_quantity / 5) AS a, floor(l_discount * 100 / 2 + 1e-9) AS b, count(*)::DOUBLE AS f FROM lineitem GROUP BY 1, 2) SELECT round(-sum(f * f * ln(f)) / sum(f) + ln(sum(f)), 4) AS joint_entropy, sum(f)::BIGINT AS n_rows FROM f")
def joint_entropy(spark, sf):
    t = table(spark, sf, "lineitem").select(F.floor(F.col("l_quantity") / 5).alias("a"), F.floor(F.col("l_discount") * 100 / 2 + 1e-9).alias("b"))
    return stats.joint_entropy(t, "a", "b").withColumn("joint_entropy", F.round("joint_entropy", 4))
