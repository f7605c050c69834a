"""Queries of vector layers, planar geometry and polarimetry, over places made of keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry, radar
from ..operators import vectors as V
from . import query, raster, table
from .raster import _GRID


def _nations(spark, sf):
    k = F.col("n_nationkey")
    return table(spark, sf, "nation").select(k.cast("long").alias("fid"), F.col("n_name").alias("name"), (k * 3.0).alias("x"), (k * 2.0).alias("y"))


def _suppliers(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(k.cast("long").alias("fid"), (k * 37 % 101).cast("double").alias("x"), (k * 53 % 97).cast("double").alias("y"), F.col("s_acctbal").alias("weight"))


@query("""SELECT n_nationkey::BIGINT AS fid, n_name AS name, (n_nationkey * 3.0)::DOUBLE AS x, (n_nationkey * 2.0)::DOUBLE AS y, 0 AS layer, NULL::DOUBLE AS weight FROM nation UNION ALL SELECT s_suppkey, NULL, (s_suppkey * 37 % 101)::DOUBLE, (s_suppkey * 53 % 97)::DOUBLE, 1, s_acctbal FROM supplier""")
def vector_concatenation(spark, sf):
    return V.concatenated(_nations(spark, sf), _suppliers(spark, sf), source="layer")


@query("SELECT n_nationkey::BIGINT AS fid, CASE WHEN n_nationkey % 3 = 0 THEN 'third' ELSE n_name END AS name, CASE WHEN n_nationkey > 20 THEN 7 END AS grade, 'EPSG:4326' AS crs FROM nation")
def vector_set_field(spark, sf):
    f = V.with_field(_nations(spark, sf), "name", "third", F.col("fid") % 3 == 0)
    return V.with_field(V.with_field(f, "grade", 7, F.col("fid") > 20), "crs", "EPSG:4326").select("fid", "name", "grade", "crs")


_FIELDS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, count({c}) AS n, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS sd, min({c})::DOUBLE AS low, max({c})::DOUBLE AS high FROM lineitem" for c in _FIELDS))
def field_statistics(spark, sf):
    return V.field_statistics(table(spark, sf, "lineitem"), _FIELDS).withColumns({c: F.round(c, 5) for c in ("mean", "sd")})


@query(f"""WITH {_GRID}, b AS (SELECT min(c) * 10.0::DOUBLE + 500 AS x0, (max(c) + 1) * 10.0::DOUBLE + 500 AS x1, min(r) * 10.0::DOUBLE - 40 AS y0, (max(r) + 1) * 10.0::DOUBLE - 40 AS y1 FROM g)
SELECT x0 AS minx, x1 AS maxx, y0 AS miny, y1 AS maxy, 'POLYGON ((' || concat_ws(', ', x0 || ' ' || y0, x1 || ' ' || y0, x1 || ' ' || y1, x0 || ' ' || y1, x0 || ' ' || y0) || '))' AS wkt FROM b""")
def image_envelope(spark, sf):
    return V.envelope(raster.cells(spark, sf), 10.0, 500.0, -40.0)


_STEPS = """s AS (SELECT user_id AS path, event_id, (event_id % 30)::DOUBLE AS x, (event_id * 7 % 31)::DOUBLE AS y, lead((event_id % 30)::DOUBLE) OVER w AS x2, lead((event_id * 7 % 31)::DOUBLE) OVER w AS y2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
k AS (SELECT *, greatest(1, ceil(greatest(abs(x2 - x), abs(y2 - y)))) AS n FROM s WHERE x2 IS NOT NULL), t AS (SELECT *, unnest(range((n + 1)::BIGINT)) AS i FROM k), q AS (SELECT DISTINCT path, floor(y + (y2 - y) * i / n + 0.5)::INTEGER AS r, floor(x + (x2 - x) * i / n + 0.5)::INTEGER AS c FROM t)"""


def _paths(spark, sf):
    return table(spark, sf, "events").select(F.col("user_id").alias("path"), F.col("event_id").alias("seq"), (F.col("event_id") % 30).cast("double").alias("x"), (F.col("event_id") * 7 % 31).cast("double").alias("y"))


@query(f"WITH {_GRID}, {_STEPS} SELECT path, round(avg(lo), 6) AS lo, count(*) AS n FROM q JOIN g USING (r, c) GROUP BY 1")
def polyline_values(spark, sf):
    return V.values_along(_paths(spark, sf), raster.cells(spark, sf), "lo").withColumn("lo", F.round("lo", 6))


@query("""WITH g AS (SELECT s_suppkey AS seg, (s_suppkey * 37 % 101)::DOUBLE AS x0, (s_suppkey * 53 % 97)::DOUBLE AS y0, (s_suppkey * 37 % 101)::DOUBLE + s_suppkey % 7 + 1 AS x1, (s_suppkey * 53 % 97)::DOUBLE + s_suppkey % 5 - 2 AS y1, atan2(s_suppkey % 5 - 2, s_suppkey % 7 + 1) AS way FROM supplier),
p AS (SELECT a.seg AS a, b.seg AS b, sqrt((a.x1 - b.x0) ** 2 + (a.y1 - b.y0) ** 2) AS distance, abs(degrees(a.way - b.way)) AS off FROM g a JOIN g b ON a.seg <> b.seg AND (a.x1 - b.x0) ** 2 + (a.y1 - b.y0) ** 2 <= 3600)
SELECT a, b, round(distance, 6) AS distance FROM p WHERE least(off, 360 - off) <= 30.5""")
def filled_gaps(spark, sf):
    k = F.col("s_suppkey")
    x, y = (k * 37 % 101).cast("double"), (k * 53 % 97).cast("double")
    s = table(spark, sf, "supplier").select(k.alias("seg"), x.alias("x0"), y.alias("y0"), (x + k % 7 + 1).alias("x1"), (y + k % 5 - 2).alias("y1"))
    # squares of distances are whole numbers up to 3600 here, for whose roots this equals F.round, which goes through decimals row by row
    return V.gaps_filled(s, 60.0, 30.5).withColumn("distance", F.floor(F.col("distance") * 1e6 + 0.5) / F.lit(1e6))


@query("""SELECT s_suppkey, round(-5 + ('0x' || substr(md5('points:' || s_suppkey), 1, 13))::BIGINT::DOUBLE / 4503599627370496 * 15, 9) AS x, round(20 + ('0x' || substr(md5('points:' || s_suppkey), 14, 13))::BIGINT::DOUBLE / 4503599627370496 * 4, 9) AS y FROM supplier""")
def random_points(spark, sf):
    return V.random_points(table(spark, sf, "supplier"), "s_suppkey", (-5.0, 20.0), (10.0, 24.0)).select("s_suppkey", F.round("x", 9).alias("x"), F.round("y", 9).alias("y"))


@query("""WITH o AS (SELECT (l_suppkey % 6)::BIGINT AS a, (l_suppkey % 3 + CASE WHEN l_suppkey % 6 = 5 THEN l_linenumber % 2 * 10 ELSE 0 END)::BIGINT AS b, count(*) AS n FROM lineitem GROUP BY 1, 2), s AS (SELECT *, sum(n) OVER (PARTITION BY a) AS p, sum(n) OVER (PARTITION BY b) AS q FROM o)
SELECT a, b, CASE WHEN n = p AND n = q THEN 'EQ' WHEN n = p THEN 'PP' WHEN n = q THEN 'PPI' ELSE 'PO' END AS relation, n AS overlap FROM s""")
def region_relations(spark, sf):
    k = F.col("l_suppkey")
    t = table(spark, sf, "lineitem").select((k % 6).alias("a"), (k % 3 + F.when(k % 6 == 5, F.col("l_linenumber") % 2 * 10).otherwise(0)).cast("long").alias("b"))
    return V.region_relations(t, "a", "b")


def _point(x, y):
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _hull_points(spark, sf):
    c = F.col("c_custkey")
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(F.collect_list(_point(c * 29 % 101, c * 31 % 97)).alias("ps"))


@query("""WITH p AS (SELECT DISTINCT c_nationkey AS k, (c_custkey * 29 % 101)::DOUBLE AS x, (c_custkey * 31 % 97)::DOUBLE AS y FROM customer), e AS (SELECT a.k, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS bv FROM p a JOIN p b ON a.k = b.k AND (a.x <> b.x OR a.y <> b.y)),
o AS (SELECT DISTINCT e.* FROM e JOIN p ON p.k = e.k WHERE (bx - ax) * (p.y - ay) - (bv - ay) * (p.x - ax) < 0 OR ((bx - ax) * (p.y - ay) - (bv - ay) * (p.x - ax) = 0 AND ((p.x - ax) * (bx - ax) + (p.y - ay) * (bv - ay) < 0 OR (p.x - bx) * (ax - bx) + (p.y - bv) * (ay - bv) < 0))),
h AS (SELECT * FROM e EXCEPT SELECT * FROM o) SELECT k AS c_nationkey, count(*) AS corners, round(sum(ax * bv - bx * ay) / 2, 4) AS area FROM h GROUP BY 1 HAVING count(*) > 2""")
def convex_hulls(spark, sf):
    h = _hull_points(spark, sf).withColumn("h", geometry.convex_hull(F.col("ps"))).where(F.size("h") > 2)
    return h.select("c_nationkey", F.size("h").cast("long").alias("corners"), F.round(geometry.ring_area(F.col("h")), 4).alias("area"))


@query("""WITH p AS (SELECT s_suppkey, (s_suppkey % 9 + 1)::DOUBLE AS w, (s_suppkey % 23 + 1)::DOUBLE AS h, (s_suppkey % 4)::DOUBLE AS d FROM supplier), l AS (SELECT *, sqrt(d * d + h * h) AS e FROM p)
SELECT s_suppkey, round((w + d) / 2, 6) AS ring_x, round(h / 2, 6) AS ring_y, round((w * w / 2 + e * (2 * w + d) / 2 + w * (w + 2 * d) / 2) / (w + e + w), 6) AS line_x, round((e * h / 2 + w * h) / (w + e + w), 6) AS line_y, round(2 * w + e, 6) AS length FROM l""")
def centroids(spark, sf):
    k = F.col("s_suppkey")
    w, h, d, zero = k % 9 + 1, k % 23 + 1, k % 4, F.lit(0)
    p = table(spark, sf, "supplier").select("s_suppkey", F.array(_point(zero, zero), _point(w, zero), _point(w + d, h), _point(d, h)).alias("p"))
    ring, line = geometry.ring_centroid(F.col("p")), geometry.line_centroid(F.col("p"))
    return p.select("s_suppkey", *(F.round(c, 6).alias(n) for c, n in ((ring["x"], "ring_x"), (ring["y"], "ring_y"), (line["x"], "line_x"), (line["y"], "line_y"), (geometry.path_length(F.col("p")), "length"))))


_TRI = "t AS (SELECT s_suppkey, (s_suppkey % 9)::DOUBLE AS ax, 0.0::DOUBLE AS ay, (s_suppkey % 5 + 12)::DOUBLE AS bx, (s_suppkey % 3 + 1)::DOUBLE AS bv, (s_suppkey % 11)::DOUBLE AS cx, (s_suppkey % 23 + 9)::DOUBLE AS cy FROM supplier), s AS (SELECT *, sqrt((bx - cx) ** 2 + (bv - cy) ** 2) AS la, sqrt((cx - ax) ** 2 + (cy - ay) ** 2) AS lb, sqrt((ax - bx) ** 2 + (ay - bv) ** 2) AS lc, 2 * (ax * (bv - cy) + bx * (cy - ay) + cx * (ay - bv)) AS d FROM t)"


def _triangles(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select("s_suppkey", _point(k % 9, F.lit(0)).alias("a"), _point(k % 5 + 12, k % 3 + 1).alias("b"), _point(k % 11, k % 23 + 9).alias("c"))


@query(f"""WITH {_TRI} SELECT s_suppkey, round(abs(d) / 4, 6) AS area, round((ax + bx + cx) / 3, 6) AS cx, round((ay + bv + cy) / 3, 6) AS cy, round(((ax * ax + ay * ay) * (bv - cy) + (bx * bx + bv * bv) * (cy - ay) + (cx * cx + cy * cy) * (ay - bv)) / d, 6) AS ox, round(((ax * ax + ay * ay) * (cx - bx) + (bx * bx + bv * bv) * (ax - cx) + (cx * cx + cy * cy) * (bx - ax)) / d, 6) AS oy,
  round((la * ax + lb * bx + lc * cx) / (la + lb + lc), 6) AS ix, round((la * ay + lb * bv + lc * cy) / (la + lb + lc), 6) AS iy, greatest(la, lb, lc) ** 2 * 2 < la * la + lb * lb + lc * lc AS acute, sign(d)::INTEGER AS turn FROM s""")
def triangles(spark, sf):
    t = _triangles(spark, sf).select("s_suppkey", geometry.triangle(F.col("a"), F.col("b"), F.col("c")).alias("t"), geometry.turn(F.col("a"), F.col("b"), F.col("c")).alias("turn"))
    return t.select("s_suppkey", *(F.round(f"t.{c}", 6).alias(c) for c in ("area", "cx", "cy", "ox", "oy", "ix", "iy")), "t.acute", "turn")


@query(f"""WITH {_TRI}, w AS (SELECT s_suppkey, ay - bv AS x1, bx - ax AS y1, ax * bv - bx * ay AS w1, cy - 1.5 AS x2, 20 - cx AS y2, cx * 1.5 - 20 * cy AS w2 FROM s), v AS (SELECT *, x1 * y2 - x2 * y1 AS w FROM w)
SELECT s_suppkey, round(CASE WHEN w <> 0 THEN (y1 * w2 - y2 * w1) / w END, 5) AS x, round(CASE WHEN w <> 0 THEN (x2 * w1 - x1 * w2) / w END, 5) AS y, floor(CASE WHEN w <> 0 THEN (y1 * w2 - y2 * w1) / w END * 8 + 0.5) / 8 AS snapped FROM v""")
def line_crossings(spark, sf):
    x = geometry.lines_crossing(F.col("a"), F.col("b"), F.col("c"), _point(F.lit(20), F.lit(1.5)))
    t = _triangles(spark, sf).select("s_suppkey", x.alias("p"))
    return t.select("s_suppkey", F.round("p.x", 5).alias("x"), F.round("p.y", 5).alias("y"), geometry.precise(F.col("p.x"), 8.0).alias("snapped"))


@query("""SELECT c_custkey, CASE WHEN abs(c_custkey % 25 - 12) + abs(c_custkey * 3 % 25 - 12) < 10 THEN 0 WHEN abs(c_custkey % 25 - 12) + abs(c_custkey * 3 % 25 - 12) = 10 THEN 1 ELSE 2 END AS place FROM customer""")
def point_places(spark, sf):
    k = F.col("c_custkey")
    at = lambda x, y: _point(F.lit(x), F.lit(y))
    ring = F.array(at(12, 2), at(22, 12), at(12, 22), at(2, 12))
    return table(spark, sf, "customer").select("c_custkey", geometry.place_of((k % 25).cast("double"), (k * 3 % 25).cast("double"), ring).alias("place"))


@query("""WITH q AS (SELECT c_custkey, (c_custkey % 23)::DOUBLE AS px, (c_custkey * 7 % 19)::DOUBLE AS py FROM customer), s AS (SELECT * FROM (VALUES (0, 0.0, 0.0, 10.0, 0.0, 0.0), (1, 10.0, 0.0, 10.0, 8.0, 10.0), (2, 10.0, 8.0, 22.0, 17.0, 18.0)) AS t(i, ax, ay, bx, bv, way)),
u AS (SELECT q.*, s.*, greatest(0, least(1, ((px - ax) * (bx - ax) + (py - ay) * (bv - ay)) / ((bx - ax) ** 2 + (bv - ay) ** 2))) AS t FROM q CROSS JOIN s), d AS (SELECT *, round(sqrt((px - ax - t * (bx - ax)) ** 2 + (py - ay - t * (bv - ay)) ** 2), 9) AS d FROM u)
SELECT c_custkey, round(way + t * sqrt((bx - ax) ** 2 + (bv - ay) ** 2), 6) AS way, round(d, 6) AS distance FROM d QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY d.d, i) = 1""")
def linear_references(spark, sf):
    k = F.col("c_custkey")
    at = lambda x, y: _point(F.lit(x), F.lit(y))
    path = F.array(at(0, 0), at(10, 0), at(10, 8), at(22, 17))
    r = table(spark, sf, "customer").select("c_custkey", geometry.length_index((k % 23).cast("double"), (k * 7 % 19).cast("double"), path).alias("r"))
    return r.select("c_custkey", F.round("r.way", 6).alias("way"), F.round("r.distance", 6).alias("distance"))


@query("""WITH p AS (SELECT s_suppkey, unnest([0, 1]) AS k, unnest([s_suppkey % 9 + 1.0, s_suppkey % 4 - s_suppkey % 9 - 1.0])::DOUBLE AS dx, unnest([0.0, s_suppkey % 23 + 1.0])::DOUBLE AS dy FROM supplier),
a AS (SELECT s_suppkey, 'both' AS kind, k::BIGINT AS k, dx, dy FROM p UNION ALL SELECT s_suppkey, 'axis', row_number() OVER (PARTITION BY s_suppkey ORDER BY k, j) - 1, dx, dy FROM (SELECT s_suppkey, k, 0 AS j, dx, 0.0::DOUBLE AS dy FROM p WHERE dx <> 0 UNION ALL SELECT s_suppkey, k, 1, 0.0, dy FROM p WHERE dy <> 0)) SELECT s_suppkey, kind, k::INTEGER AS step, dx, dy FROM a""")
def chain_codes(spark, sf):
    k, zero = F.col("s_suppkey"), F.lit(0)
    p = table(spark, sf, "supplier").select("s_suppkey", F.array(_point(zero, zero), _point(k % 9 + 1, zero), _point(k % 4, k % 23 + 1)).alias("p"))
    one = lambda kind, axis: p.select("s_suppkey", F.lit(kind).alias("kind"), F.posexplode(geometry.chain_code(F.col("p"), axis)).alias("step", "s")).select("s_suppkey", "kind", "step", "s.dx", "s.dy")
    return one("both", False).unionByName(one("axis", True))


@query("SELECT DISTINCT (c_custkey * 29 % 101)::DOUBLE AS x, (c_custkey * 31 % 97)::DOUBLE AS y FROM customer UNION SELECT (s_suppkey * 37 % 101)::DOUBLE, (s_suppkey * 53 % 97)::DOUBLE FROM supplier")
def point_union(spark, sf):
    c = F.col("c_custkey")
    a = table(spark, sf, "customer").select((c * 29 % 101).cast("double").alias("x"), (c * 31 % 97).cast("double").alias("y"))
    return a.union(_suppliers(spark, sf).select("x", "y")).distinct()


def _scatterers(spark, sf):
    q = F.col("l_quantity") / 53
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", q.alias("ar"), F.col("l_tax").alias("ai"), F.col("l_discount").alias("br"), (F.col("l_linenumber") / 9).alias("bi"), (1 - q).alias("cr"), (F.col("l_linenumber") / 7.3).alias("ci"))


_SCATTER = "s AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity / 53 AS ar, l_tax AS ai, l_discount AS br, l_linenumber / 9 AS bi, 1 - l_quantity / 53 AS cr, l_linenumber / 7.3 AS ci FROM lineitem)"


def _hh_hv_vv():
    return tuple((F.col(f"{c}r"), F.col(f"{c}i")) for c in "abc")


@query(f"""WITH {_SCATTER} SELECT l_orderkey, l_partkey, l_linenumber, round(ar * ar + ai * ai, 6) AS c11, round(2 * (br * br + bi * bi), 6) AS c22, round(cr * cr + ci * ci, 6) AS c33, round(sqrt(2) * (ar * br + ai * bi), 6) AS c12r, round(sqrt(2) * (ai * br - ar * bi), 6) AS c12i, round(ar * cr + ai * ci, 6) AS c13r, round(ai * cr - ar * ci, 6) AS c13i,
  round(((ar + cr) ** 2 + (ai + ci) ** 2) / 2, 6) AS t11, round(((ar - cr) ** 2 + (ai - ci) ** 2) / 2, 6) AS t22, round(2 * (br * br + bi * bi), 6) AS t33, round(((ar + cr) * (ar - cr) + (ai + ci) * (ai - ci)) / 2, 6) AS t12r, round(((ai + ci) * (ar - cr) - (ar + cr) * (ai - ci)) / 2, 6) AS t12i FROM s""")
def polarimetric_matrices(spark, sf):
    c, t = radar.covariance(*_hh_hv_vv()), radar.coherency(*_hh_hv_vv())
    names = [*((c, "c", n) for n in ("11", "22", "33", "12r", "12i", "13r", "13i")), *((t, "t", n) for n in ("11", "22", "33", "12r", "12i"))]
    return _scatterers(spark, sf).select("l_orderkey", "l_partkey", "l_linenumber", *(F.round(m[f"m{n}"], 6).alias(p + n) for m, p, n in names))


@query(f"""WITH {_SCATTER}, t AS (SELECT l_orderkey, l_partkey, l_linenumber, ((ar + cr) ** 2 + (ai + ci) ** 2) / 2 AS t11, ((ar - cr) ** 2 + (ai - ci) ** 2) / 2 AS t22, 2 * (br * br + bi * bi) AS t33, ((ar + cr) * (ar - cr) + (ai + ci) * (ai - ci)) / 2 AS t12r, ((ai + ci) * (ar - cr) - (ar + cr) * (ai - ci)) / 2 AS t12i FROM s)
SELECT l_orderkey, l_partkey, l_linenumber, round(t11 / 2, 5) AS a0, round((t22 + t33) / 2, 5) AS b0, round((t22 - t33) / 2, 5) AS b, round(t12r, 5) AS c, round(-t12i, 5) AS d, round(CASE WHEN t11 > 0 THEN sqrt(t11) END, 5) AS barnes_1, round(CASE WHEN t11 > 0 THEN t12r / sqrt(t11) END, 5) AS barnes_2 FROM t""")
def huynen_and_barnes(spark, sf):
    t = radar.coherency(*_hh_hv_vv())
    h, k = radar.huynen(t), radar.barnes(t)
    return _scatterers(spark, sf).select("l_orderkey", "l_partkey", "l_linenumber", *(F.round(h[n], 5).alias(n) for n in ("a0", "b0", "b", "c", "d")), F.round(k[0][0], 5).alias("barnes_1"), F.round(k[1][0], 5).alias("barnes_2"))


@query()
def entropy_alpha(spark, sf):
    """Eigenvalues of coherency matrices that are averaged over the suppliers' line items."""
    t = radar.coherency(*_hh_hv_vv())
    m = _scatterers(spark, sf).withColumn("k", F.col("l_partkey") % 50).groupBy("k").agg(*(F.avg(c).alias(n) for n, c in t.items()))
    return m.select("k", radar.entropy_alpha_anisotropy({n: F.col(n) for n in t}).alias("x")).select("k", "x.*")


@query("WITH l AS (SELECT l_suppkey AS line, l_orderkey % 9 AS burst, l_orderkey // 9 AS n, max(l_quantity) AS v FROM lineitem WHERE l_suppkey = 1 OR l_linenumber = 1 GROUP BY 1, 2, 3) SELECT line, burst, n, v FROM l QUALIFY row_number() OVER (PARTITION BY line, n ORDER BY v DESC, burst) = 1")
def deburst(spark, sf):
    """Of the lines that several bursts hold, the one with the strongest signal stays."""
    t = table(spark, sf, "lineitem").where("l_suppkey = 1 or l_linenumber = 1")
    l = t.groupBy(F.col("l_suppkey").alias("line"), (F.col("l_orderkey") % 9).alias("burst"), F.expr("l_orderkey div 9").alias("n")).agg(F.max("l_quantity").alias("v"))
    best = l.groupBy("line", "n").agg(F.max(F.struct("v", (-F.col("burst")).alias("b"))).alias("x"))
    return best.select("line", (-F.col("x.b")).alias("burst"), "n", F.col("x.v").alias("v"))
