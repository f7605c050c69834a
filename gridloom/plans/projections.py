"""Queries of map projections and plane transforms, over places made of keys."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import projections as P
from . import query, table

_PLACES = "p AS (SELECT c_custkey, ((c_custkey * 37 % 340) - 170 + 0.25)::DOUBLE AS lon, ((c_custkey * 53 % 160) - 80 + 0.5)::DOUBLE AS lat, (c_custkey % 900)::DOUBLE AS h FROM customer)"
_SAME = f"WITH {_PLACES} SELECT c_custkey, round(lon::DOUBLE, 6) AS lon, round(lat::DOUBLE, 6) AS lat FROM p"


def _places(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select("c_custkey", (k * 37 % 340 - 170 + 0.25).cast("double").alias("lon"), (k * 53 % 160 - 80 + 0.5).cast("double").alias("lat"), (k % 900).cast("double").alias("h"))


def _steps(name: str, start: str, step: str, rounds: int = 8) -> str:
    """Newton's rule as one table a round."""
    out = f"{name}0 AS (SELECT *, {start} AS t FROM p)"
    for k in range(rounds):
        out += f", {name}{k + 1} AS (SELECT c_custkey, lon, lat, {step} AS t FROM {name}{k})"
    return out


_R = P.MAJOR


@query(f"""WITH {_PLACES}, {_steps('m', 'radians(lat)', 't - (2 * t + sin(2 * t) - pi() * sin(radians(lat))) / (2 + 2 * cos(2 * t))')},
{_steps('e', 'radians(lat) / 2', 't - (t + sin(t) * cos(t) + 2 * sin(t) - (2 + pi() / 2) * sin(radians(lat))) / (2 * cos(t) * (1 + cos(t)))')}
SELECT p.c_custkey, round({_R} * radians(p.lon) * cos(radians(p.lat)), 3) AS sinus_x, round({_R} * radians(p.lat), 3) AS sinus_y, round({_R} * 2 * sqrt(2) / pi() * radians(p.lon) * cos(m8.t), 3) AS moll_x, round({_R} * sqrt(2) * sin(m8.t), 3) AS moll_y,
  round({_R} * 2 / sqrt(4 * pi() + pi() * pi()) * radians(p.lon) * (1 + cos(e8.t)), 3) AS eck_x, round({_R} * 2 * sqrt(pi() / (4 + pi())) * sin(e8.t), 3) AS eck_y, round({_R} * radians(p.lon), 3) AS web_x, round({_R} * ln(tan(pi() / 4 + radians(p.lat) / 2)), 3) AS web_y
FROM p JOIN m8 USING (c_custkey) JOIN e8 USING (c_custkey)""")
def world_projections(spark, sf):
    lon, lat = F.col("lon"), F.col("lat")
    both = {"sinus": P.sinusoidal(lon, lat), "moll": P.mollweide(lon, lat), "eck": P.eckert4(lon, lat), "web": P.web_mercator(lon, lat)}
    return _places(spark, sf).select("c_custkey", *(F.round(x, 3).alias(f"{n}_{c}") for n, xy in both.items() for x, c in zip(xy, "xy", strict=True)))


@query(f"WITH {_PLACES} SELECT c_custkey, " + ", ".join(f"round({c}::DOUBLE, 6) AS {n}_{c}" for n in ("sinus", "moll", "eck", "web") for c in ("lon", "lat")) + " FROM p")
def world_projections_back(spark, sf):
    lon, lat = F.col("lon"), F.col("lat")
    back = {"sinus": P.sinusoidal_back(*P.sinusoidal(lon, lat)), "moll": P.mollweide_back(*P.mollweide(lon, lat)), "eck": P.eckert4_back(*P.eckert4(lon, lat)), "web": P.web_mercator_back(*P.web_mercator(lon, lat))}
    return _places(spark, sf).select("c_custkey", *(F.round(x, 6).alias(f"{n}_{c}") for n, xy in back.items() for x, c in zip(xy, ("lon", "lat"), strict=True)))


_E2 = P.FLATTENING * (2 - P.FLATTENING)
_EP2 = _E2 / (1 - _E2)
_ARC = f"{_R} * ({1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256!r} * f - {3 * _E2 / 8 + 3 * _E2**2 / 32 + 45 * _E2**3 / 1024!r} * sin(2 * f) + {15 * _E2**2 / 256 + 45 * _E2**3 / 1024!r} * sin(4 * f) - {35 * _E2**3 / 3072!r} * sin(6 * f))"


def _zone(lon):
    """Central meridian of the six-degree zone."""
    return F.floor((lon + 180) / 6) * 6 - 177.0


@query(f"""WITH {_PLACES}, z AS (SELECT *, floor((lon + 180) / 6) * 6 - 177 AS lon0, radians(lat) AS f FROM p),
a AS (SELECT *, {_R} / sqrt(1 - {_E2!r} * sin(f) ** 2) AS n, tan(f) ** 2 AS t, {_EP2!r} * cos(f) ** 2 AS c, radians(lon - lon0) * cos(f) AS a FROM z)
SELECT c_custkey, round(500000 + 0.9996 * n * (a + (1 - t + c) * a ** 3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * {_EP2!r}) * a ** 5 / 120), 3) AS east,
  round(0.9996 * ({_ARC} + n * tan(f) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * a ** 4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * {_EP2!r}) * a ** 6 / 720)), 3) AS north FROM a""")
def transverse_mercator(spark, sf):
    x, y = P.transverse_mercator(F.col("lon"), F.col("lat"), _zone(F.col("lon")))
    return _places(spark, sf).select("c_custkey", F.round(x, 3).alias("east"), F.round(y, 3).alias("north"))


@query(_SAME)
def transverse_mercator_back(spark, sf):
    lon0 = _zone(F.col("lon"))
    placed = _places(spark, sf).withColumn("x", P.transverse_mercator(F.col("lon"), F.col("lat"), lon0)[0]).withColumn("y", P.transverse_mercator(F.col("lon"), F.col("lat"), lon0)[1])
    lon, lat = P.transverse_mercator_back(F.col("x"), F.col("y"), lon0)
    return placed.select("c_custkey", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query(f"""WITH {_PLACES}, a AS (SELECT c_custkey, h, radians(lon) AS l, radians(lat) AS f, {_R} / sqrt(1 - {_E2!r} * sin(radians(lat)) ** 2) AS n FROM p)
SELECT c_custkey, round((n + h) * cos(f) * cos(l), 3) AS x, round((n + h) * cos(f) * sin(l), 3) AS y, round((n * {1 - _E2!r} + h) * sin(f), 3) AS z FROM a""")
def geocentric(spark, sf):
    out = P.geocentric(F.col("lon"), F.col("lat"), F.col("h"))
    return _places(spark, sf).select("c_custkey", *(F.round(c, 3).alias(n) for c, n in zip(out, "xyz", strict=True)))


@query(f"WITH {_PLACES} SELECT c_custkey, round(lon::DOUBLE, 6) AS lon, round(lat::DOUBLE, 6) AS lat, round(h, 3) AS h FROM p")
def geocentric_back(spark, sf):
    x, y, z = P.geocentric(F.col("lon"), F.col("lat"), F.col("h"))
    placed = _places(spark, sf).select("c_custkey", x.alias("x"), y.alias("y"), z.alias("z"))
    lon, lat, h = P.geocentric_back(F.col("x"), F.col("y"), F.col("z"))
    return placed.select("c_custkey", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"), F.round(h, 3).alias("h"))


_E = math.sqrt(_E2)
_POLE = 2 * _R * 0.994 / math.sqrt((1 + _E) ** (1 + _E) * (1 - _E) ** (1 - _E))


@query(f"""WITH {_PLACES}, a AS (SELECT c_custkey, lat, radians(lon) AS l, {_POLE!r} * tan(pi() / 4 - radians(abs(lat)) / 2) * ((1 + {_E!r} * sin(radians(abs(lat)))) / (1 - {_E!r} * sin(radians(abs(lat))))) ** {_E / 2!r} AS rho FROM p)
SELECT c_custkey, round(2000000 + rho * sin(l), 3) AS x, round(2000000 + CASE WHEN lat < 0 THEN 1 ELSE -1 END * rho * cos(l), 3) AS y FROM a""")
def polar_stereographic(spark, sf):
    x, y = P.polar_stereographic(F.col("lon"), F.col("lat"))
    return _places(spark, sf).select("c_custkey", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query(_SAME)
def polar_stereographic_back(spark, sf):
    x, y = P.polar_stereographic(F.col("lon"), F.col("lat"))
    placed = _places(spark, sf).withColumn("x", x).withColumn("y", y)
    lon, lat = P.polar_stereographic_back(F.col("x"), F.col("y"), F.col("lat") < 0)
    return placed.select("c_custkey", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query(f"""WITH {_PLACES}, u AS (SELECT c_custkey, lon, lat, (lon + 180) / 360 AS u, (90 - lat) / 180 AS v, (lon - 3.1::DOUBLE) ** 2 + (lat + 2.7::DOUBLE) ** 2 AS r2 FROM p)
SELECT c_custkey, round(0.5::DOUBLE * lon + 0.25 * lat + 7, 6) AS affine_x, round(-0.125::DOUBLE * lon + 2 * lat - 1, 6) AS affine_y, round(u * (1 - v) * 100.7::DOUBLE + u * v * 90.9::DOUBLE + (1 - u) * v * -5.3::DOUBLE, 4) AS quad_x, round(u * (1 - v) * 4.1::DOUBLE + u * v * 60.3::DOUBLE + (1 - u) * v * 49.7::DOUBLE, 4) AS quad_y,
  round(3.1::DOUBLE + (lon - 3.1::DOUBLE) * (1 + 1.03e-4 * r2 - 1.07e-9 * r2 * r2), 4) AS lens_x, round(-2.7::DOUBLE + (lat + 2.7::DOUBLE) * (1 + 1.03e-4 * r2 - 1.07e-9 * r2 * r2), 4) AS lens_y FROM u""")
def plane_transforms(spark, sf):
    lon, lat = F.col("lon"), F.col("lat")
    both = {"affine": P.affine_plane(lon, lat, (0.5, 0.25, 7, -0.125, 2, -1)), "quad": P.quad((lon + 180) / 360, (90 - lat) / 180, [(0, 0), (100.7, 4.1), (90.9, 60.3), (-5.3, 49.7)]), "lens": P.lens(lon, lat, (3.1, -2.7), 1.03e-4, -1.07e-9)}
    return _places(spark, sf).select("c_custkey", *(F.round(x, 6 if n == "affine" else 4).alias(f"{n}_{c}") for n, xy in both.items() for x, c in zip(xy, "xy", strict=True)))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(q * (x - 1) * (x - 3) / 3 + d * x * (x - 3) / -2 + t * x * (x - 1) / 6, 5) AS v
FROM (SELECT *, l_quantity AS q, l_discount AS d, l_tax AS t, (l_linenumber / 2) AS x FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax FROM lineitem))""")
def lagrange_interpolation(spark, sf):
    v = P.lagrange(F.col("l_linenumber") / 2, [0.0, 1.0, 3.0], [F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")])
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(v, 5).alias("v"))


@query("SELECT l_suppkey, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem GROUP BY 1")
def linear_fit(spark, sf):
    t = table(spark, sf, "lineitem").groupBy("l_suppkey")
    return t.agg(F.count("*").alias("n"), F.round(F.regr_slope("l_extendedprice", "l_quantity"), 4).alias("slope"), F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 4).alias("intercept"))
