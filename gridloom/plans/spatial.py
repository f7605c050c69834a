"""Queries of radius, envelope, interval, ring and path operators, over places made of keys."""

from __future__ import annotations


from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry
from ..operators import joins
from . import query, table


def _suppliers(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(k.alias("lid"), (k * 37 % 101).cast("double").alias("lx"), (k * 53 % 97).cast("double").alias("ly"))


def _customers(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k.alias("rid"), (k * 29 % 101).cast("double").alias("rx"), (k * 31 % 97).cast("double").alias("ry"), "c_acctbal")


_PLACES = "s AS (SELECT s_suppkey AS lid, (s_suppkey * 37 % 101)::DOUBLE AS lx, (s_suppkey * 53 % 97)::DOUBLE AS ly FROM supplier), c AS (SELECT c_custkey AS rid, (c_custkey * 29 % 101)::DOUBLE AS rx, (c_custkey * 31 % 97)::DOUBLE AS ry, c_acctbal FROM customer)"


@query(f"WITH {_PLACES}, n AS (SELECT lid, count(*) AS n FROM s JOIN c ON (lx - rx) ** 2 + (ly - ry) ** 2 <= 25 GROUP BY 1) SELECT s.lid, coalesce(n, 0) AS n, round(coalesce(n, 0) / (pi() * 25), 8) AS density FROM s LEFT JOIN n USING (lid)")
def point_density(spark, sf):
    return joins.density(_suppliers(spark, sf), _customers(spark, sf), 5.0).withColumn("density", F.round("density", 8))


@query(f"WITH {_PLACES}, w AS (SELECT lid, 1 / greatest(sqrt((lx - rx) ** 2 + (ly - ry) ** 2), 1e-12) ** 2 AS w, c_acctbal AS v FROM s JOIN c ON (lx - rx) ** 2 + (ly - ry) ** 2 <= 25) SELECT lid, round(sum(w * v) / sum(w), 4) AS c_acctbal, count(*) AS n FROM w GROUP BY 1")
def inverse_distance_grid(spark, sf):
    return joins.inverse_distance(_suppliers(spark, sf), _customers(spark, sf), "c_acctbal", 5.0).withColumn("c_acctbal", F.round("c_acctbal", 4))


def _boxes(frame, key, a, b, w, prefix):
    k = F.col(key)
    x, y = (k * a % 1009).cast("double"), (k * b % 1013).cast("double")
    return frame.select(k.alias(f"{prefix}id"), F.struct(x.alias("minx"), (x + w - k % 7 * 5).alias("maxx"), y.alias("miny"), (y + w).alias("maxy")).alias(f"{prefix}box"))


@query("""WITH a AS (SELECT p_partkey AS lid, (p_partkey * 389 % 1009)::DOUBLE AS x0, (p_partkey * 389 % 1009)::DOUBLE + 12 - p_partkey % 7 * 5 AS x1, (p_partkey * 641 % 1013)::DOUBLE AS y0, (p_partkey * 641 % 1013)::DOUBLE + 12 AS y1 FROM part),
b AS (SELECT c_custkey AS rid, (c_custkey * 211 % 1009)::DOUBLE AS x0, (c_custkey * 211 % 1009)::DOUBLE + 20 - c_custkey % 7 * 5 AS x1, (c_custkey * 859 % 1013)::DOUBLE AS y0, (c_custkey * 859 % 1013)::DOUBLE + 20 AS y1 FROM customer)
SELECT lid, rid, CASE WHEN a.x0 = b.x0 AND a.x1 = b.x1 AND a.y0 = b.y0 AND a.y1 = b.y1 THEN 'EQ' WHEN a.x1 = b.x0 OR b.x1 = a.x0 OR a.y1 = b.y0 OR b.y1 = a.y0 THEN 'EC'
  WHEN a.x0 > b.x0 AND a.x1 < b.x1 AND a.y0 > b.y0 AND a.y1 < b.y1 THEN 'NTPP' WHEN b.x0 > a.x0 AND b.x1 < a.x1 AND b.y0 > a.y0 AND b.y1 < a.y1 THEN 'NTPPI'
  WHEN b.x0 <= a.x0 AND a.x1 <= b.x1 AND b.y0 <= a.y0 AND a.y1 <= b.y1 THEN 'TPP' WHEN a.x0 <= b.x0 AND b.x1 <= a.x1 AND a.y0 <= b.y0 AND b.y1 <= a.y1 THEN 'TPPI' ELSE 'PO' END AS relation
FROM a JOIN b ON a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1 WHERE a.x0 <= a.x1 AND b.x0 <= b.x1""")
def envelope_join(spark, sf):
    a = _boxes(table(spark, sf, "part"), "p_partkey", 389, 641, 12, "l")
    b = _boxes(table(spark, sf, "customer"), "c_custkey", 211, 859, 20, "r")
    met = joins.envelopes_meeting(a, b, 32.0)
    return met.select("lid", "rid", geometry.box_relation(F.col("lbox"), F.col("rbox")).alias("relation"))


@query("""WITH a AS (SELECT event_id AS lid, epoch(ts) AS l0, epoch(ts) + 5 AS l1 FROM events WHERE event_type = 'error'), b AS (SELECT event_id AS rid, epoch(ts) - 5 AS r0, epoch(ts) AS r1 FROM events WHERE event_type = 'purchase')
SELECT lid, rid FROM a JOIN b ON l0 <= r1 AND r0 <= l1""")
def interval_overlap(spark, sf):
    e = table(spark, sf, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    a = e.where("event_type = 'error'").select(F.col("event_id").alias("lid"), F.col("t").alias("l0"), (F.col("t") + 5).alias("l1"))
    b = e.where("event_type = 'purchase'").select(F.col("event_id").alias("rid"), (F.col("t") - 5).alias("r0"), F.col("t").alias("r1"))
    return joins.intervals_overlapping(a, b, 60.0).select("lid", "rid")


_PATH = "p AS (SELECT user_id, ts, event_id, (event_id % 50)::DOUBLE AS x, (event_id * 7 % 31)::DOUBLE AS y FROM events), d AS (SELECT user_id, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS d FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"


def _steps(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", (F.col("event_id") % 50).cast("double").alias("x"), (F.col("event_id") * 7 % 31).cast("double").alias("y"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return e.withColumn("dx", F.col("x") - F.lag("x").over(w)).withColumn("dy", F.col("y") - F.lag("y").over(w)).withColumn("d", F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")))


@query(f"WITH {_PATH} SELECT user_id, round(sum(d), 4) AS length, round(avg(d), 6) AS mean_distance, count(*) AS n_vertices FROM d GROUP BY 1 HAVING sum(d) > 10 AND avg(d) > 0.2")
def path_filters(spark, sf):
    s = _steps(spark, sf).groupBy("user_id").agg(F.sum("d").alias("s"), F.avg("d").alias("m"), F.count("*").alias("n_vertices"))
    return s.where((F.col("s") > 10) & (F.col("m") > 0.2)).select("user_id", F.round("s", 4).alias("length"), F.round("m", 6).alias("mean_distance"), "n_vertices")


@query("""WITH p AS (SELECT user_id, ts, event_id, (event_id % 50)::DOUBLE AS x, (event_id * 7 % 31)::DOUBLE AS y FROM events), s AS (SELECT event_id, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, dx, dy, round(atan2(dy, dx), 6) AS orientation FROM s WHERE dx IS NOT NULL""")
def path_orientation(spark, sf):
    return _steps(spark, sf).where("dx is not null").select("event_id", "dx", "dy", F.round(F.atan2("dy", "dx"), 6).alias("orientation"))


@query("""WITH p AS (SELECT s_suppkey, s_suppkey % 9 + 1.0 AS w, s_suppkey % 23 + 1.0 AS h, s_suppkey % 4 + 0.0 AS d FROM supplier), m AS (SELECT s_suppkey, w * h AS area, w + h + sqrt(d * d + h * h) + sqrt((w + d - d) ** 2) AS length FROM p)
SELECT s_suppkey, round(area::DOUBLE, 6) AS area, round(2 * w + 2 * sqrt(d * d + h * h), 6) AS length, round(4 * pi() * area / (2 * w + 2 * sqrt(d * d + h * h)) ** 2, 6) AS compactness FROM m JOIN p USING (s_suppkey) WHERE 4 * pi() * area / (2 * w + 2 * sqrt(d * d + h * h)) ** 2 > 0.2""")
def compactness_filter(spark, sf):
    k = F.col("s_suppkey")
    w, h, d = k % 9 + 1.0, k % 23 + 1.0, k % 4 + 0.0
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    zero = F.lit(0.0)
    p = table(spark, sf, "supplier").select("s_suppkey", F.array(at(zero, zero), at(w, zero), at(w + d, h), at(d, h)).alias("ring"))
    p = p.withColumn("area", geometry.ring_area(F.col("ring"))).withColumn("length", geometry.ring_length(F.col("ring")))
    c = geometry.compactness(F.col("area"), F.col("length"))
    return p.where(c > 0.2).select("s_suppkey", F.round("area", 6).alias("area"), F.round("length", 6).alias("length"), F.round(c, 6).alias("compactness"))


@query("""WITH c AS (SELECT c_custkey AS pid, c_custkey * 29 % 101 + 0.25 AS x, c_custkey * 31 % 97 + 0.5 AS y FROM customer), z AS (SELECT n_nationkey AS zone, (n_nationkey % 5) * 20.0 AS x0, (n_nationkey // 5) * 20.0 AS y0 FROM nation)
SELECT pid, zone FROM c JOIN z ON abs(x - (x0 + 10)) + abs(y - (y0 + 10)) < 10""")
def points_in_zones(spark, sf):
    k = F.col("n_nationkey")
    x, y = k % 5 * 20.0, F.expr("n_nationkey div 5") * 20.0
    at = lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))
    zones = table(spark, sf, "nation").select(k.alias("zone"), F.array(at(x + 10, y), at(x + 20, y + 10), at(x + 10, y + 20), at(x, y + 10)).alias("ring"))
    c = F.col("c_custkey")
    points = table(spark, sf, "customer").select(c.alias("pid"), (c * 29 % 101 + 0.25).alias("x"), (c * 31 % 97 + 0.5).alias("y"))
    return joins.points_in_rings(points, zones, 20.0).select("pid", "zone")


@query("""WITH a AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), b AS (SELECT user_id, ts, value FROM events WHERE event_type = 'click')
SELECT a.event_id, b.value AS r_value FROM a ASOF LEFT JOIN b ON a.user_id = b.user_id AND a.ts >= b.ts""")
def as_of_join(spark, sf):
    e = table(spark, sf, "events")
    out = joins.as_of(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.where("event_type = 'click'").select("user_id", F.col("ts").alias("t2"), "value"), "user_id", "ts", "t2", ["value"])
    return out.select("event_id", "r_value")


@query("""WITH z AS (SELECT l_suppkey, l_quantity AS x, l_discount * 100 AS y, l_extendedprice / 1000 AS z FROM lineitem), s AS (SELECT l_suppkey, count(*) AS n, covar_pop(x, x) AS xx, covar_pop(y, y) AS yy, covar_pop(x, y) AS xy, covar_pop(x, z) AS xz, covar_pop(y, z) AS yz, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM z GROUP BY 1),
p AS (SELECT *, (xz * yy - yz * xy) / (xx * yy - xy * xy) AS a, (yz * xx - xz * xy) / (xx * yy - xy * xy) AS b FROM s WHERE n >= 3) SELECT l_suppkey, n, round(a, 4) AS a, round(b, 4) AS b, round(mz - a * mx - b * my, 4) AS c FROM p""")
def plane_fit(spark, sf):
    from ..operators.stats import plane_fit as fit

    t = table(spark, sf, "lineitem").select("l_suppkey", F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"), (F.col("l_extendedprice") / 1000).alias("z"))
    return fit(t, "x", "y", "z", "l_suppkey").where("n >= 3").select("l_suppkey", "n", *[F.round(c, 4).alias(c) for c in "abc"])


