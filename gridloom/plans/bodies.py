"""Queries of functions that other queries do not use: colours, indexes, pads, paths, distances, transforms, Hoover scores."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions import arrays, geometry, scalar
from ..operators import grid as G
from ..operators import learning, stats
from . import query, raster, table
from .raster import _GRID, COLS

_KEYS = ("l_orderkey", "l_partkey", "l_linenumber")


@query("""SELECT l_orderkey, l_partkey, l_linenumber, round(0.6 - (l_tax * 40 - 1.7 + pi()) * 0.6 / (2 * pi()), 6) AS hue, round(l_discount * 0.6 + 0.3, 6) AS saturation, round(greatest(0, least(1, (l_quantity - 5) / 37)), 6) AS value FROM lineitem""")
def interferogram_colours(spark, sf):
    hue, saturation, value = scalar.amplitude_phase(F.col("l_quantity"), F.col("l_tax") * 40 - 1.7, F.col("l_discount"), 5.0, 42.0)
    return table(spark, sf, "lineitem").select(*_KEYS, F.round(hue, 6).alias("hue"), F.round(saturation, 6).alias("saturation"), F.round(value, 6).alias("value"))


@query("""SELECT l_orderkey, l_partkey, l_linenumber, floor(0.3::DOUBLE * l_quantity + 0.7::DOUBLE * l_linenumber + 0.5)::BIGINT AS blended, ((l_partkey & 255) * 3) & 255 AS r, (((l_partkey & 255) + ((l_partkey >> 8) & 255)) * 5) & 255 AS g, ((l_partkey & 255) + ((l_partkey >> 16) & 255)) & 255 AS b,
  (l_orderkey % 37 + 18) % 37 AS shifted, (l_orderkey % 37 + 19) % 37 AS shifted_back, CASE WHEN (l_quantity - 20) ** 2 + (l_linenumber * 4 - 10) ** 2 <= 225 THEN 1 ELSE 0 END AS in_sphere FROM lineitem""")
def index_functions(spark, sf):
    k = F.col("l_partkey").cast("long")
    r, g, b = scalar.label_rgb(k)
    i = F.col("l_orderkey") % 37
    out = [scalar.blend(F.col("l_quantity"), F.col("l_linenumber"), 0.3).cast("long").alias("blended"), r.alias("r"), g.alias("g"), b.alias("b"), scalar.fft_shift(i, 37).alias("shifted"), scalar.fft_shift(i, 37, inverse=True).alias("shifted_back")]
    return table(spark, sf, "lineitem").select(*_KEYS, *out, scalar.in_sphere([F.col("l_quantity"), F.col("l_linenumber") * 4], [20.0, 10.0], 15.0).alias("in_sphere"))


@query("""SELECT vec_id, round(list_product(list_transform(embedding, lambda x: 1 + x::DOUBLE / 8)), 6) AS product, round(list_avg(list_transform(embedding, lambda x: x::DOUBLE)), 7) AS mean, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 5) AS total FROM embeddings""")
def vector_sums(spark, sf):
    v = arrays.doubles(F.col("embedding"))
    return table(spark, sf, "embeddings").select("vec_id", F.round(arrays.product(F.transform(v, lambda x: 1 + x / 8)), 6).alias("product"), F.round(arrays.mean(v), 7).alias("mean"), F.round(arrays.total(v), 5).alias("total"))


@query("""WITH s AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity / 53 AS a, l_tax AS b, l_discount AS c, l_linenumber / 7.3::DOUBLE AS d FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber, round((0.6 * a + 0.8 * c) ** 2 + (0.6 * b + 0.8 * d) ** 2, 5) AS power FROM s""")
def polarisation_synthesis(spark, sf):
    a, b, c, d = F.col("l_quantity") / 53, F.col("l_tax"), F.col("l_discount"), F.col("l_linenumber") / 7.3
    zero = (F.lit(0.0), F.lit(0.0))
    power = scalar.synthesis({"hh": (a, b), "hv": (c, d), "vh": zero, "vv": zero}, (0.6 + 0j, 0.8 + 0j), (1 + 0j, 0j))
    return table(spark, sf, "lineitem").select(*_KEYS, F.round(power, 5).alias("power"))


@query(f"""WITH {_GRID}, p AS (SELECT a.r, b.c FROM (SELECT unnest(range(top + 5)) AS r FROM z) a CROSS JOIN (SELECT unnest(range({COLS + 6})) AS c) b)
SELECT p.r::INTEGER AS "row", p.c::INTEGER AS col, coalesce(g.lo, 7.0) AS constant, w.lo AS wrapped FROM p LEFT JOIN g ON g.r = p.r AND g.c = p.c JOIN z ON true JOIN g w ON w.r = p.r % (z.top + 1) AND w.c = p.c % {COLS}""")
def padded_grids(spark, sf):
    g, rows = raster.cells(spark, sf).select("row", "col", "lo"), raster.n_rows(spark, sf)
    constant = G.filled(g, rows + 4, COLS + 6, {"lo": 7.0}).withColumnRenamed("lo", "constant")
    return constant.join(G.wrapped(g, rows, COLS, rows + 4, COLS + 6).withColumnRenamed("lo", "wrapped"), ["row", "col"])


@query("""WITH s AS (SELECT user_id AS path, (event_id % 50)::DOUBLE AS x, (event_id * 7 % 31)::DOUBLE AS y, lead((event_id % 50)::DOUBLE) OVER w AS x2, lead((event_id * 7 % 31)::DOUBLE) OVER w AS y2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
k AS (SELECT *, greatest(1, ceil(greatest(abs(x2 - x), abs(y2 - y)))) AS n FROM s WHERE x2 IS NOT NULL), t AS (SELECT *, unnest(range((n + 1)::BIGINT)) AS i FROM k)
SELECT DISTINCT floor(y + (y2 - y) * i / n + 0.5)::INTEGER AS "row", floor(x + (x2 - x) * i / n + 0.5)::INTEGER AS col, 255 AS value FROM t""")
def drawn_paths(spark, sf):
    from .imagery import burned_paths

    return burned_paths(spark, sf)


@query(f"""WITH {_GRID}, i AS (SELECT r // 24 AS image, r % 24 AS r, c, lo FROM g), h AS (SELECT image, max(r) + 1 AS h FROM i GROUP BY 1), u AS (SELECT DISTINCT image, r AS u, c AS v FROM i)
SELECT u.image::INTEGER AS image, u.u::INTEGER AS "row", u.v::INTEGER AS col, round(sum(lo * cos(2 * pi() * (u.u * i.r / h.h + u.v * i.c / {COLS}.0))), 4) + 0.0 AS re, round(-sum(lo * sin(2 * pi() * (u.u * i.r / h.h + u.v * i.c / {COLS}.0))), 4) + 0.0 AS im FROM u JOIN h USING (image) JOIN i USING (image) WHERE u.u < 3 AND u.v < 3 GROUP BY 1, 2, 3""")
def low_frequencies(spark, sf):
    """The nine lowest frequencies of each image's transform."""
    from .imagery import fourier_transform

    f = fourier_transform(spark, sf).where("row < 3 and col < 3")
    return f.select("image", "row", "col", (F.round("re", 4) + 0.0).alias("re"), (F.round("im", 4) + 0.0).alias("im"))


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS a, l_discount AS b, l_extendedprice AS y FROM lineitem), s AS (SELECT covar_pop(a, a) AS aa, covar_pop(b, b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS byy, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM t),
w AS (SELECT (ay * bb - byy * ab) / (aa * bb - ab * ab) AS p, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS q, * FROM s) SELECT l_orderkey, l_linenumber, l_partkey, round(my + p * (a - ma) + q * (b - mb), 2) AS predicted FROM t, w""")
def regression_predictions(spark, sf):
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_extendedprice")
    return learning.regressed(t, ["l_quantity", "l_discount"], "l_extendedprice").select("l_orderkey", "l_linenumber", "l_partkey", F.round("predicted", 2).alias("predicted"))


@query("""SELECT c_custkey, round(sqrt((px - ax - t * (bx - ax)) ** 2 + (py - ay - t * (bv - ay)) ** 2), 6) AS distance FROM (SELECT *, CASE WHEN ax = bx AND ay = bv THEN 0 ELSE greatest(0, least(1, ((px - ax) * (bx - ax) + (py - ay) * (bv - ay)) / ((bx - ax) ** 2 + (bv - ay) ** 2))) END AS t
FROM (SELECT c_custkey, (c_custkey % 23)::DOUBLE AS px, (c_custkey * 7 % 19)::DOUBLE AS py, (c_custkey % 5)::DOUBLE AS ax, 2.0::DOUBLE AS ay, (c_custkey % 7 * 2)::DOUBLE AS bx, (c_custkey % 3 + 2)::DOUBLE AS bv FROM customer))""")
def segment_distances(spark, sf):
    k = F.col("c_custkey")
    d = geometry.segment_distance((k % 23).cast("double"), (k * 7 % 19).cast("double"), (k % 5).cast("double"), F.lit(2.0), (k % 7 * 2).cast("double"), (k % 3 + 2).cast("double"))
    return table(spark, sf, "customer").select("c_custkey", F.round(d, 6).alias("distance"))


@query("""SELECT s_suppkey, 'LINESTRING (0.0 0.0, ' || (s_suppkey % 9)::DOUBLE || ' 0.5, 2.5 ' || (s_suppkey % 4)::DOUBLE || ')' AS line, 4::BIGINT AS corners, (s_suppkey % 9)::DOUBLE AS second_x, (s_suppkey % 4)::DOUBLE AS third_y FROM supplier""")
def texts_of_paths(spark, sf):
    k = F.col("s_suppkey")
    at = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    p = table(spark, sf, "supplier").select("s_suppkey", F.array(at(F.lit(0), F.lit(0)), at(k % 9, F.lit(0.5)), at(F.lit(2.5), k % 4)).alias("p"))
    p = p.withColumn("line", geometry.well_known_text(F.col("p"))).withColumn("back", geometry.points_of_text(F.col("line")))
    return p.select("s_suppkey", "line", F.size(geometry.closed(F.col("back"))).cast("long").alias("corners"), F.col("back")[1]["x"].alias("second_x"), F.col("back")[2]["y"].alias("third_y"))


_OVER = """o AS (SELECT (l_suppkey % 6)::BIGINT AS a, (CASE WHEN l_suppkey % 6 < 2 THEN 0 WHEN l_suppkey % 6 = 2 THEN 10 + l_linenumber % 2 WHEN l_suppkey % 6 = 5 AND l_linenumber = 1 THEN 4 ELSE l_suppkey % 6 END)::BIGINT AS b, count(*) AS n FROM lineitem GROUP BY 1, 2),
s AS (SELECT *, sum(n) OVER (PARTITION BY a)::DOUBLE AS p, sum(n) OVER (PARTITION BY b)::DOUBLE AS q FROM o)"""


@query(f"""WITH {_OVER}, k AS (SELECT *, n >= 0.8 * p AS ia, n >= 0.8 * q AS ib FROM s), c AS (SELECT a AS region, 'correct' AS kind FROM k WHERE ia AND ib),
v AS (SELECT a AS region, 'split' AS kind FROM k WHERE ib AND NOT ia GROUP BY a HAVING count(*) > 1 AND sum(n) >= 0.8 * max(p)),
u AS (SELECT a AS region, 'merged' AS kind FROM k JOIN (SELECT b FROM k WHERE ia AND NOT ib GROUP BY b HAVING count(*) > 1 AND sum(n) >= 0.8 * max(q)) USING (b) WHERE ia AND NOT ib),
w AS (SELECT * FROM c UNION ALL SELECT * FROM v UNION ALL SELECT * FROM u) SELECT region, kind FROM w UNION ALL SELECT DISTINCT a, 'missed' FROM s WHERE a NOT IN (SELECT region FROM w)""")
def hoover_instances(spark, sf):
    k, l = F.col("l_suppkey") % 6, F.col("l_linenumber")
    b = F.when(k < 2, 0).when(k == 2, 10 + l % 2).when((k == 5) & (l == 1), 4).otherwise(k)
    t = table(spark, sf, "lineitem").select(k.cast("long").alias("a"), b.cast("long").alias("b"))
    return stats.hoover(t, "a", "b", 0.8)
