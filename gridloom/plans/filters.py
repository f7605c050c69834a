"""Queries of filters, profiles and label rasters over the grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid as G
from . import query, raster, table
from .raster import _GRID, _HOOD, COLS, TOP


def _hood(grid: str, radius: int, value: str = "lo") -> str:
    """SQL of all neighbours (dr, dc, x) of each cell within a radius; the border's own cells are repeated."""
    return f"(SELECT g.r, g.c, i.d AS dr, j.d AS dc, y.{value} AS x FROM {grid} g CROSS JOIN (SELECT unnest(range(-{radius}, {radius + 1})) AS d) i CROSS JOIN (SELECT unnest(range(-{radius}, {radius + 1})) AS d) j JOIN {grid} y ON y.r = least({TOP}, greatest(0, g.r + i.d)) AND y.c = least({COLS - 1}, greatest(0, g.c + j.d)))"


@query(f"""WITH {_HOOD}, m AS (SELECT r, c, avg(x) AS m, CASE WHEN avg(x) = 0 THEN 0 ELSE var_samp(x) / avg(x) ** 2 END AS c2, max(x) FILTER (WHERE k = 4) AS x FROM h GROUP BY 1, 2),
f AS (SELECT h.r, h.c, sum(exp(-2 * c2 * sqrt((k // 3 - 1) ** 2 + (k % 3 - 1) ** 2)) * h.x) / sum(exp(-2 * c2 * sqrt((k // 3 - 1) ** 2 + (k % 3 - 1) ** 2))) AS frost FROM h JOIN m ON m.r = h.r AND m.c = h.c GROUP BY 1, 2),
a AS (SELECT *, CASE WHEN c2 <= 0.25 THEN 0 ELSE (1 - 0.25 / c2) / 1.25 END AS w, CASE WHEN c2 <= 0.25 THEN 1.25 ELSE 1.25 / (c2 - 0.25) END AS al FROM m), b AS (SELECT *, al - 5 AS b FROM a)
SELECT b.r AS "row", b.c AS col, round(m + w * (x - m), 5) AS kuan, round(CASE WHEN c2 <= 0.25 THEN m WHEN c2 >= 0.5 THEN x ELSE (b * m + sqrt(greatest(0, m * m * b * b + 16 * al * m * x))) / (2 * al) END, 5) AS gamma_map, round(frost, 5) AS frost FROM b JOIN f USING (r, c)""")
def despeckle_filters(spark, sf):
    h = G.stencil(raster.cells(spark, sf), "lo")
    x = F.col("hood")
    return h.select("row", "col", F.round(G.despeckle_kuan(x, 4.0), 5).alias("kuan"), F.round(G.despeckle_gamma_map(x, 4.0), 5).alias("gamma_map"), F.round(G.despeckle_frost(x, 1, 2.0), 5).alias("frost"))


@query(f"""WITH {_HOOD}, w AS (SELECT r, c, sum(x) FILTER (k IN (0, 1, 2)) AS a1, sum(x) FILTER (k IN (6, 7, 8)) AS b1, sum(x) FILTER (k IN (0, 3, 6)) AS a2, sum(x) FILTER (k IN (2, 5, 8)) AS b2, sum(x) FILTER (k IN (0, 1, 3)) AS a3, sum(x) FILTER (k IN (5, 7, 8)) AS b3,
  sum(x) FILTER (k IN (1, 2, 5)) AS a4, sum(x) FILTER (k IN (3, 6, 7)) AS b4, sum(x * [-1, -1, -1, -1, 9, -1, -1, -1, -1][k + 1]) AS sharp, sum(x * [0, -1, 0, -1, 4, -1, 0, -1, 0][k + 1]) AS hat FROM h GROUP BY 1, 2)
SELECT r AS "row", c AS col, round(1 - least({', '.join(f'CASE WHEN a{k} = b{k} THEN 1 WHEN a{k} = 0 OR b{k} = 0 THEN 0 ELSE least(a{k} / b{k}, b{k} / a{k}) END' for k in range(1, 5))}), 6) AS touzi, sharp, hat FROM w""")
def ratio_edges_and_kernels(spark, sf):
    h = G.stencil(raster.cells(spark, sf), "lo")
    return h.select("row", "col", F.round(G.touzi_edge(F.col("hood")), 6).alias("touzi"), G.convolve(F.col("hood"), G.SHARPEN).alias("sharp"), G.convolve(F.col("hood"), G.HAT).alias("hat"))


def _diffusion(source: str, name: str) -> str:
    return f"{name} AS (SELECT r, c, max(x0) + 0.2 * sum(exp(-(((x - x0) / 8) ** 2)) * (x - x0)) AS lo FROM (SELECT q.*, o.lo AS x0 FROM {_hood(source, 1)} q JOIN {source} o USING (r, c) WHERE abs(q.dr) + abs(q.dc) = 1) GROUP BY 1, 2)"


@query(f"""WITH {_GRID}, {_diffusion('g', 'd1')}, {_diffusion('d1', 'd2')} SELECT r AS "row", c AS col, round(lo, 5) AS lo FROM d2""")
def anisotropic_diffusion(spark, sf):
    return G.diffused(raster.cells(spark, sf).select("row", "col", "lo"), "lo", 2, 0.2, 8.0).withColumn("lo", F.round("lo", 5))


def _opening(radius: int) -> str:
    return f"e{radius} AS (SELECT r, c, min(x) AS lo FROM {_hood('g', radius)} GROUP BY 1, 2), o{radius} AS (SELECT r, c, max(x) AS opened FROM {_hood(f'e{radius}', radius)} GROUP BY 1, 2)"


@query(f"""WITH {_GRID}, {_opening(1)}, {_opening(2)}, d AS (SELECT g.r, g.c, lo, o1.opened AS one, o2.opened AS two FROM g JOIN o1 USING (r, c) JOIN o2 USING (r, c))
SELECT r AS "row", c AS col, one AS opened_1, two AS opened_2, lo - one AS step_1, one - two AS step_2, CASE WHEN greatest(lo - one, one - two) = 0 THEN 0 WHEN lo - one >= one - two THEN 1 ELSE 2 END AS characteristic FROM d""")
def morphological_profile(spark, sf):
    g = raster.cells(spark, sf).select("row", "col", "lo")
    g = G.opened(G.opened(g, "lo", 1, "opened_1"), "lo", 2, "opened_2")
    one, two = F.col("lo") - F.col("opened_1"), F.col("opened_1") - F.col("opened_2")
    kind = F.when(F.greatest(one, two) == 0, 0).when(one >= two, 1).otherwise(2)
    return g.select("row", "col", "opened_1", "opened_2", one.alias("step_1"), two.alias("step_2"), kind.alias("characteristic"))


@query(f"""WITH {_GRID}, q AS {_hood('g', 3)}, l AS (SELECT *, greatest(abs(dr), abs(dc)) AS s, CASE WHEN dr = 0 THEN 1 WHEN dc = 0 THEN 2 WHEN dr = dc THEN 3 ELSE 4 END AS line, CASE WHEN dr > 0 OR (dr = 0 AND dc > 0) THEN 1 ELSE 0 END AS way FROM q WHERE (dr <> 0 OR dc <> 0) AND (dr = 0 OR dc = 0 OR abs(dr) = abs(dc))),
u AS (SELECT l.r, l.c, line, way, coalesce(min(s) FILTER (abs(x - g.lo) > 4), 4) - 1 AS run FROM l JOIN g ON g.r = l.r AND g.c = l.c GROUP BY 1, 2, 3, 4), t AS (SELECT r, c, line, sum(run) AS run FROM u GROUP BY 1, 2, 3)
SELECT r AS "row", c AS col, max(run)::INTEGER AS longest, min(run)::INTEGER AS shortest, avg(run) AS mean FROM t GROUP BY 1, 2""")
def structural_features(spark, sf):
    h = G.stencil(raster.cells(spark, sf), "lo", 3)
    x = G.structural_features(F.col("hood"), 3, 4.0)
    return h.select("row", "col", x.alias("x")).select("row", "col", "x.longest", "x.shortest", "x.mean")


@query(f"""WITH {_GRID}, b AS (SELECT r // 2 AS br, c // 2 AS bc, r % 2 AS i, c % 2 AS j, lo FROM g) SELECT br AS "row", bc AS col, sum(lo) / 2 AS ll, sum(CASE WHEN j = 0 THEN lo ELSE -lo END) / 2 AS lh, sum(CASE WHEN i = 0 THEN lo ELSE -lo END) / 2 AS hl, sum(CASE WHEN i = j THEN lo ELSE -lo END) / 2 AS hh FROM b GROUP BY 1, 2 HAVING count(*) = 4""")
def haar_wavelet(spark, sf):
    return G.haar(raster.cells(spark, sf), "lo")


@query(f"""WITH {_GRID}, p AS (SELECT a.c + (10.5 - a.lo) / (b.lo - a.lo) AS x, a.r::DOUBLE AS y FROM g a JOIN g b ON b.r = a.r AND b.c = a.c + 1 WHERE (a.lo < 10.5) <> (b.lo < 10.5) UNION ALL SELECT a.c, a.r + (10.5 - a.lo) / (b.lo - a.lo) FROM g a JOIN g b ON b.c = a.c AND b.r = a.r + 1 WHERE (a.lo < 10.5) <> (b.lo < 10.5))
SELECT round(x::DOUBLE, 6) AS x, round(y::DOUBLE, 6) AS y FROM p""")
def contour_points(spark, sf):
    return G.contour_points(raster.cells(spark, sf), "lo", 10.5).select(F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(f"""WITH {_GRID}, l AS (SELECT r, c, (lo::INTEGER // 20)::BIGINT AS l FROM g), s AS (SELECT *, CASE WHEN lag(l) OVER (PARTITION BY r ORDER BY c) = l THEN 0 ELSE 1 END AS o FROM l), k AS (SELECT *, sum(o) OVER (PARTITION BY r ORDER BY c ROWS UNBOUNDED PRECEDING) AS k FROM s)
SELECT l, r AS "row", min(c) AS col, count(*) AS length FROM k GROUP BY r, k, l""")
def label_runs(spark, sf):
    return G.label_runs(raster.cells(spark, sf).withColumn("l", F.expr("cast(cast(lo as int) div 20 as bigint)")), "l")


@query(f"""WITH {_GRID}, o AS (SELECT r, c, (n % 3)::BIGINT AS l, lo AS a FROM g UNION ALL SELECT r, c, 5, v - 30 FROM g WHERE (r + c) % 2 = 0) SELECT r AS "row", c AS col, l FROM o QUALIFY row_number() OVER (PARTITION BY r, c ORDER BY a DESC, l) = 1""")
def unique_labels(spark, sf):
    g = raster.cells(spark, sf)
    one = g.select("row", "col", (F.col("n") % 3).alias("l"), F.col("lo").alias("a"))
    two = g.where("(row + col) % 2 = 0").select("row", "col", F.lit(5).cast("long").alias("l"), (F.col("v") - 30).alias("a"))
    return G.one_per_cell(one.unionByName(two), "l", "a")


@query(f"""WITH {_GRID}, l AS (SELECT r, c, lo, CASE WHEN lo < 8 THEN 0 WHEN lo < 25 THEN 1 ELSE 2 END AS l FROM g), m AS (SELECT * FROM (VALUES (0, 4.0), (1, 15.0), (2, 35.0)) AS t(k, m)), q AS {_hood('l', 1, 'l')},
e AS (SELECT l.r, l.c, k, (max(lo) - max(m)) ** 2 + 12 * count(*) FILTER ((dr <> 0 OR dc <> 0) AND x <> k) AS e FROM l CROSS JOIN m JOIN q ON q.r = l.r AND q.c = l.c GROUP BY 1, 2, 3) SELECT r AS "row", c AS col, k::INTEGER AS l FROM e QUALIFY row_number() OVER (PARTITION BY r, c ORDER BY e, k) = 1""")
def conditional_modes(spark, sf):
    g = raster.cells(spark, sf).select("row", "col", "lo", F.when(F.col("lo") < 8, 0).when(F.col("lo") < 25, 1).otherwise(2).alias("l"))
    return G.icm_round(g, "lo", "l", {0: 4.0, 1: 15.0, 2: 35.0}, 12.0).select("row", "col", "l")


@query("SELECT DISTINCT ((l_suppkey % 40) * 3 + 7)::BIGINT AS label, min(l_partkey) AS first_cell, count(*) AS cells FROM lineitem GROUP BY l_suppkey % 40")
def shifted_labels(spark, sf):
    """Labels scaled and shifted; objects whose labels fall together become one."""
    t = table(spark, sf, "lineitem").select(((F.col("l_suppkey") % 40) * 3 + 7).cast("long").alias("label"), "l_partkey")
    return t.groupBy("label").agg(F.min("l_partkey").alias("first_cell"), F.count("*").alias("cells"))
