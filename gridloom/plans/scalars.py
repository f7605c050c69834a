"""Queries of scalar and vector functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import arrays, scalar
from ..functions.expressions import parse
from ..operators import stats
from . import query, table


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(-3 + 0.5 * l_quantity, 6) AS v FROM lineitem")
def affine_rescale(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(scalar.affine(F.col("l_quantity"), 0.5, -3), 6).alias("v"))


@query("SELECT event_id, round(1 + 2 * t + 3 * t * t, 4) AS v FROM (SELECT event_id, value / 100 AS t FROM events)")
def poly_series(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round(scalar.polynomial(F.col("value") / 100, [1, 2, 3]), 4).alias("v"))


@query("""SELECT event_id, round((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6, 6) AS delta_s,
  year(ts) AS y, month(ts) AS m, day(ts) AS d, hour(ts) AS h FROM events""")
def iso_delta_seconds(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    delta = F.round((us - F.lag(us).over(w)) / 1e6, 6).alias("delta_s")
    return table(spark, sf, "events").select("event_id", delta, F.year("ts").cast("long").alias("y"), F.month("ts").cast("long").alias("m"), F.dayofmonth("ts").cast("long").alias("d"), F.hour("ts").cast("long").alias("h"))


@query("""WITH j AS (SELECT o_orderkey, month(o_orderdate) AS m, day(o_orderdate) AS d FROM orders),
k AS (SELECT o_orderkey, CASE WHEN m <= 2 THEN (m - 1) * 31 + d WHEN m > 8 THEN (m - 1) * 31 - (m - 2) // 2 - 2 + d ELSE (m - 1) * 31 - (m - 1) // 2 - 2 + d END AS j FROM j)
SELECT o_orderkey, j AS day_index, round(1 / power(1 - 0.01673 * cos(radians(0.9856 * (j - 4))), 2), 8) AS var_sol FROM k""")
def solar_day_index(spark, sf):
    m, d = F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", scalar.day_of_season(d, m).cast("long").alias("day_index"), F.round(scalar.solar_variability(d, m), 8).alias("var_sol"))


@query("""SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_discount > 0.02 AND l_discount <= 0.06 THEN 1 ELSE 0 END AS cloud,
  CASE WHEN l_tax >= 0.02 AND l_tax <= 0.06 THEN 0 ELSE 1 END AS edge FROM lineitem""")
def cloud_mask(spark, sf):
    t = table(spark, sf, "lineitem")
    return t.select("l_orderkey", "l_partkey", "l_linenumber", scalar.half_open(F.col("l_discount"), 0.02, 0.06).alias("cloud"), scalar.outside(F.col("l_tax"), 0.02, 0.06).alias("edge"))


@query("""SELECT l_orderkey, l_partkey, l_linenumber, round(10 * log10(CASE WHEN b <= 0 THEN 1e-5 ELSE b END), 6) AS db
FROM (SELECT *, 0.001 * l_discount * l_discount AS b FROM lineitem)""")
def sar_brightness_db(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.round(scalar.brightness(F.col("l_discount"), 0.001), 6).alias("db"))


@query("""WITH m AS (SELECT l_suppkey, avg(CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN l_quantity END) AS a, avg(CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01' THEN l_quantity END) AS b FROM lineitem GROUP BY 1)
SELECT l_suppkey, round(CASE WHEN a = b THEN 0.0 WHEN greatest(a, b) = 0 THEN NULL ELSE 1 - least(a, b) / greatest(a, b) END, 6) AS mean_ratio, round(a - b, 6) AS mean_difference FROM m""")
def mean_ratio_change(spark, sf):
    early = F.col("l_shipdate") < "1998-01-01"
    m = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.avg(F.when(early, F.col("l_quantity"))).alias("a"), F.avg(F.when(~early, F.col("l_quantity"))).alias("b"))
    return m.select("l_suppkey", F.round(scalar.mean_ratio(F.col("a"), F.col("b")), 6).alias("mean_ratio"), F.round(F.col("a") - F.col("b"), 6).alias("mean_difference"))


@query("""WITH n AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity AS a, lead(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS b FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber, (CASE WHEN a = b THEN -1.0 ELSE 1.0 END)::DOUBLE AS potts, round((a - b) * (a - b) / (1 + (a - b) * (a - b)), 6) AS edge_fidelity, (a - b) * (a - b) AS gaussian FROM n WHERE b IS NOT NULL""")
def mrf_energy(spark, sf):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    n = table(spark, sf, "lineitem").withColumn("a", F.col("l_quantity")).withColumn("b", F.lead("l_quantity").over(w)).where("b is not null")
    a, b = F.col("a"), F.col("b")
    return n.select("l_orderkey", "l_partkey", "l_linenumber", scalar.potts(a, b).alias("potts"), F.round(scalar.edge_fidelity(a, b), 6).alias("edge_fidelity"), scalar.gaussian_energy(a, b).alias("gaussian"))


@query("""WITH s AS (SELECT l_returnflag, count(*) AS n, avg(l_quantity) AS m, var_samp(l_quantity) AS v, sum(l_quantity) AS s1, sum(l_quantity ** 2) AS s2, sum(l_quantity ** 3) AS s3, sum(l_quantity ** 4) AS s4 FROM lineitem GROUP BY 1)
SELECT l_returnflag, n, round(m, 6) AS mean, round(v, 6) AS variance,
  round(CASE WHEN v IS NULL OR abs(v) <= 1e-10 THEN 0 ELSE ((s3 - 3 * m * s2) / n + 2 * m ** 3) / (v * sqrt(v)) END, 6) AS skewness,
  round(CASE WHEN v IS NULL OR abs(v) <= 1e-10 THEN 0 ELSE ((s4 - 4 * m * s3 + 6 * m * m * s2) / n - 3 * m ** 4) / (v * v) - 3 END, 6) AS kurtosis FROM s""")
def radiometric_moments(spark, sf):
    m = stats.moments(table(spark, sf, "lineitem"), "l_quantity", "l_returnflag")
    return m.select("l_returnflag", "n", *[F.round(c, 6).alias(c) for c in ("mean", "variance", "skewness", "kurtosis")])


@query("""SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_samp(p_size) FROM part), 6) AS z_size,
  round((p_retailprice - (SELECT avg(p_retailprice) FROM part)) / (SELECT stddev_samp(p_retailprice) FROM part), 6) AS z_price FROM part""")
def normalize_vector(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("a"), F.col("p_retailprice").alias("b"))
    return stats.standardised(t, ["a", "b"]).select("p_partkey", F.round("a", 6).alias("z_size"), F.round("b", 6).alias("z_price"))


_VECTORS = "SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings"


@query(f"""WITH e AS ({_VECTORS}), r AS (SELECT v AS w FROM e ORDER BY vec_id LIMIT 1),
d AS (SELECT vec_id, v, list_dot_product(v, w) AS dot, sqrt(list_dot_product(v, v) * list_dot_product(w, w)) AS n FROM e, r)
SELECT vec_id, round(CASE WHEN n <= 1e-10 OR dot / n > 1 THEN 0 ELSE acos(dot / n) END, 5) AS angle, round(sqrt(CASE WHEN n <= 1e-10 OR dot / n > 1 THEN 0 ELSE acos(dot / n) END), 5) AS sqrt_angle,
  round(dot, 6) AS dot, round(list_sum(v) / len(v), 6) AS mean, round(list_sum(v), 6) AS total FROM d WHERE vec_id <> (SELECT min(vec_id) FROM embeddings)""")
def spectral_angle(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", arrays.doubles(F.col("embedding")).alias("v"))
    first = e.agg(F.min_by("v", "vec_id").alias("w"), F.min("vec_id").alias("own"))
    d = e.crossJoin(F.broadcast(first)).where("vec_id <> own")  # one row is broadcast
    angle = arrays.spectral_angle(F.col("v"), F.col("w"))
    return d.select("vec_id", F.round(angle, 5).alias("angle"), F.round(F.sqrt(angle), 5).alias("sqrt_angle"), F.round(arrays.dot(F.col("v"), F.col("w")), 6).alias("dot"), F.round(arrays.mean(F.col("v")), 6).alias("mean"), F.round(arrays.total(F.col("v")), 6).alias("total"))


@query(f"WITH e AS ({_VECTORS}) SELECT vec_id, list_position(v, list_max(v)) - 1 AS winner FROM e")
def max_decision(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", arrays.first_argmax(arrays.doubles(F.col("embedding"))).alias("winner"))


@query("""SELECT l_orderkey, l_partkey, l_linenumber, round(CASE WHEN l_discount > 0.05 THEN sqrt(l_extendedprice) * l_tax ELSE ln(l_quantity + 1) ** 2 END, 6) AS v,
  round((l_tax - l_discount) / CASE WHEN l_tax + l_discount = 0 THEN NULL ELSE l_tax + l_discount END, 6) AS ratio, (CASE WHEN l_quantity > 10 AND l_tax < 0.05 THEN 1.0 ELSE 0.0 END)::DOUBLE AS flag FROM lineitem""")
def band_math(spark, sf):
    t = table(spark, sf, "lineitem")
    b = {"im1": F.col("l_extendedprice"), "im2": F.col("l_tax"), "im3": F.col("l_quantity"), "im4": F.col("l_discount")}
    return t.select("l_orderkey", "l_partkey", "l_linenumber", F.round(parse("im4 > 0.05 ? sqrt(im1) * im2 : ln(im3 + 1) ^ 2", b), 6).alias("v"), F.round(parse("(im2 - im4) / (im2 + im4)", b), 6).alias("ratio"), parse("im3 > 10 && im2 < 0.05", b).alias("flag"))


@query("""WITH b AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity AS n, l_tax * 100 AS r, l_discount * 100 AS u FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber, round(CASE WHEN n + r = 0 THEN 0 ELSE (n - r) / (n + r) END, 6) AS ndvi, round(CASE WHEN n + r + 0.5 = 0 THEN 0 ELSE (n - r) * 1.5 / (n + r + 0.5) END, 6) AS savi,
  round(CASE WHEN n + 6 * r - 7.5 * u + 1 = 0 THEN 0 ELSE 2.5 * (n - r) / (n + 6 * r - 7.5 * u + 1) END, 4) AS evi FROM b WHERE abs(n + 6 * r - 7.5 * u + 1) > 0.001""")
def radiometric_indices(spark, sf):
    t = table(spark, sf, "lineitem")
    n, r, u = F.col("l_quantity"), F.col("l_tax") * 100, F.col("l_discount") * 100
    t = t.where(F.abs(n + 6 * r - 7.5 * u + 1) > 0.001)
    return t.select("l_orderkey", "l_partkey", "l_linenumber", F.round(scalar.normalised_difference(n, r), 6).alias("ndvi"), F.round(scalar.soil_adjusted(n, r), 6).alias("savi"), F.round(scalar.enhanced_vegetation(n, r, u), 4).alias("evi"))


@query("""WITH t AS (SELECT p_partkey, p_size / 50.0 AS v, p_size AS s FROM part)
SELECT p_partkey, round(1 / (1 + exp(-(v - 0.5) / 0.2)), 6) AS sigmoid, round(exp(-v * v), 6) AS gaussian, round(exp(-0.5 * v * v) / sqrt(2 * pi()), 6) AS kernel, (CASE WHEN v - 0.5 >= 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS step,
  CASE WHEN v * v - 0.25 <= 0 THEN 1 ELSE 0 END AS in_sphere, (s + 25) % 51 AS shifted, floor(0.3 * s + 0.7 * 10 + 0.5)::BIGINT AS blended,
  ((p_partkey & 255) * 3) & 255 AS r, (((p_partkey & 255) + ((p_partkey >> 8) & 255)) * 5) & 255 AS g, ((p_partkey & 255) + ((p_partkey >> 16) & 255)) & 255 AS b FROM t""")
def transfer_functions(spark, sf):
    v, s = F.col("p_size") / 50.0, F.col("p_size")
    r, g, b = scalar.label_rgb(F.col("p_partkey"))
    return table(spark, sf, "part").select("p_partkey", F.round(scalar.sigmoid_transfer(v, 0.2, 0.5, 0.0, 1.0), 6).alias("sigmoid"), F.round(scalar.gaussian_transfer(v), 6).alias("gaussian"), F.round(scalar.gaussian_kernel(v), 6).alias("kernel"), scalar.heaviside(v - 0.5).alias("step"), scalar.in_sphere([v], [0.0], 0.5).alias("in_sphere"), scalar.fft_shift(s, 51).alias("shifted"), scalar.blend(s, F.lit(10), 0.3).cast("long").alias("blended"), r.alias("r"), g.alias("g"), b.alias("b"))


@query("""WITH t AS (SELECT p_partkey, (p_size - 1) / 49.0 AS v FROM part), c AS (SELECT p_partkey, v,
  CASE WHEN v <= 0.00001 THEN [0.75 + v / 0.00001 * (0.64 - 0.75), 0.91 + v / 0.00001 * (0.84 - 0.91), 0.96 + v / 0.00001 * (0.59 - 0.96)]
    WHEN v <= 0.2 THEN [0.64 + (v - 0.00001) / (0.2 - 0.00001) * (0.47 - 0.64), 0.84 + (v - 0.00001) / (0.2 - 0.00001) * (0.76 - 0.84), 0.59 + (v - 0.00001) / (0.2 - 0.00001) * (0.40 - 0.59)]
    WHEN v <= 0.43 THEN [0.47 + (v - 0.2) / (0.43 - 0.2) * (0.89 - 0.47), 0.76 + (v - 0.2) / (0.43 - 0.2) * (0.90 - 0.76), 0.40 + (v - 0.2) / (0.43 - 0.2) * (0.57 - 0.40)]
    WHEN v <= 0.71 THEN [0.89 + (v - 0.43) / (0.71 - 0.43) * (0.58 - 0.89), 0.90 + (v - 0.43) / (0.71 - 0.43) * (0.32 - 0.90), 0.57 + (v - 0.43) / (0.71 - 0.43) * (0.00 - 0.57)]
    ELSE [0.58 + (v - 0.71) / (1.0 - 0.71) * (1.0 - 0.58), 0.32 + (v - 0.71) / (1.0 - 0.71) * (1.0 - 0.32), 0.00 + (v - 0.71) / (1.0 - 0.71) * (1.0 - 0.00)] END AS c FROM t)
SELECT p_partkey, floor(greatest(0, least(1, c[1])) * 255 + 0.5)::INTEGER AS r, floor(greatest(0, least(1, c[2])) * 255 + 0.5)::INTEGER AS g, floor(greatest(0, least(1, c[3])) * 255 + 0.5)::INTEGER AS b FROM c""")
def relief_colormap(spark, sf):
    r, g, b = scalar.relief((F.col("p_size") - 1) / 49.0)
    return table(spark, sf, "part").select("p_partkey", r.alias("r"), g.alias("g"), b.alias("b"))


@query("""SELECT l_orderkey, l_partkey, l_linenumber, round(sqrt(l_tax ** 2 + l_discount ** 2), 6) AS modulus, round(atan2(l_discount, l_tax), 6) AS phase,
  round(power(0.6 * l_tax + 0.8 * l_discount, 2) + power(0.6 * l_quantity / 50, 2), 6) AS power_hv FROM lineitem""")
def complex_cells(spark, sf):
    re, im, q = F.col("l_tax"), F.col("l_discount"), F.col("l_quantity") / 50
    zero = F.lit(0.0)
    s = {"hh": (re, q), "hv": (im, zero), "vh": (zero, zero), "vv": (zero, zero)}
    power = scalar.synthesis(s, (0.6 + 0j, 0.8 + 0j), (1 + 0j, 0j))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.round(scalar.modulus(re, im), 6).alias("modulus"), F.round(scalar.phase(re, im), 6).alias("phase"), F.round(power, 6).alias("power_hv"))


@query("""WITH c AS (SELECT s_suppkey, (s_suppkey * 37 % 360) - 180.0 AS lon, (s_suppkey * 17 % 160) - 80.0 AS lat FROM supplier)
SELECT s_suppkey, (floor((lon + 180) / 6) + 1)::INTEGER AS zone, CASE WHEN lat > 0 THEN 'N' ELSE 'S' END AS hemisphere FROM c""")
def utm_zones(spark, sf):
    lon, lat = F.col("s_suppkey") * 37 % 360 - 180.0, F.col("s_suppkey") * 17 % 160 - 80.0
    return table(spark, sf, "supplier").select("s_suppkey", scalar.utm_zone(lon).alias("zone"), scalar.hemisphere(lat).alias("hemisphere"))


@query("""WITH c AS (SELECT s_suppkey, (s_suppkey * 7 % 100) / 10.0 - 2 AS lon, 42 + (s_suppkey * 13 % 90) / 10.0 AS lat FROM supplier),
k AS (SELECT 0.0818191910428158 AS e, 6378137.0 AS a, pi() / 4 AS q),
m AS (SELECT *, cos(radians(44)) / sqrt(1 - (e * sin(radians(44))) ** 2) AS m1, cos(radians(49)) / sqrt(1 - (e * sin(radians(49))) ** 2) AS m2,
  tan(q - radians(44) / 2) / ((1 - e * sin(radians(44))) / (1 + e * sin(radians(44)))) ** (e / 2) AS t1, tan(q - radians(49) / 2) / ((1 - e * sin(radians(49))) / (1 + e * sin(radians(49)))) ** (e / 2) AS t2,
  tan(q - radians(46.5) / 2) / ((1 - e * sin(radians(46.5))) / (1 + e * sin(radians(46.5)))) ** (e / 2) AS t0 FROM k),
n AS (SELECT *, (ln(m1) - ln(m2)) / (ln(t1) - ln(t2)) AS n FROM m), f AS (SELECT *, a * m1 / (n * t1 ** n) AS f FROM n),
p AS (SELECT s_suppkey, lon, f.*, f * (tan(q - radians(lat) / 2) / ((1 - e * sin(radians(lat))) / (1 + e * sin(radians(lat)))) ** (e / 2)) ** n AS rho FROM c, f)
SELECT s_suppkey, round(700000 + rho * sin(n * radians(lon - 3)), 3) AS x, round(6600000 + f * t0 ** n - rho * cos(n * radians(lon - 3)), 3) AS y FROM p""")
def conic_projection(spark, sf):
    lon, lat = F.col("s_suppkey") * 7 % 100 / 10.0 - 2, F.col("s_suppkey") * 13 % 90 / 10.0 + 42
    x, y = scalar.mercator_lambert_secant(lon, lat, **scalar.LAMBERT93)
    return table(spark, sf, "supplier").select("s_suppkey", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("""WITH p AS (SELECT n_nationkey AS k, n_nationkey * 14.0 - 170 AS lon, n_nationkey * 6.0 - 75 AS lat FROM nation),
h AS (SELECT a.k AS from_key, b.k AS to_key, power(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * power(sin(radians(b.lon - a.lon) / 2), 2) AS h FROM p a JOIN p b ON a.k < b.k)
SELECT from_key, to_key, round(2 * 6371000 * atan2(sqrt(h), sqrt(1 - h)), 2) AS metres FROM h""")
def haversine_matrix(spark, sf):
    p = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), (F.col("n_nationkey") * 14.0 - 170).alias("lon"), (F.col("n_nationkey") * 6.0 - 75).alias("lat"))
    a, b = p.alias("a"), p.alias("b")
    d = scalar.haversine(F.col("a.lon"), F.col("a.lat"), F.col("b.lon"), F.col("b.lat"))
    return a.join(b, F.col("a.k") < F.col("b.k")).select(F.col("a.k").alias("from_key"), F.col("b.k").alias("to_key"), F.round(d, 2).alias("metres"))


@query("SELECT n_regionkey, string_agg(n_name, '-' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def concat_join(spark, sf):
    return table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list("n_name")), "-").alias("names"))
