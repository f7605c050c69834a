"""Map projections and datums: each a pair of functions, degrees to metres and back, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The world ellipsoid, the scale of the universal grids, and the national grid of one city state.
MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
UTM_SCALE, UPS_SCALE = 0.9996, 0.994
SVY21 = {"lon0": 103.83333333333333, "lat0": 1.3666666666666667, "x0": 28001.642, "y0": 38744.572, "scale": 1.0}
_E2 = FLATTENING * (2 - FLATTENING)
XY = tuple[Column, Column]


def sinusoidal(lon: Column, lat: Column, radius: float = MAJOR) -> XY:
    return F.lit(radius) * F.radians(lon) * F.cos(F.radians(lat)), F.lit(radius) * F.radians(lat)


def sinusoidal_back(x: Column, y: Column, radius: float = MAJOR) -> XY:
    lat = y / radius
    return F.degrees(x / (F.lit(radius) * F.cos(lat))), F.degrees(lat)


def _newton(start: Column, step, rounds: int) -> Column:
    """``rounds`` steps; a fold, since steps put into one another would double the expression each time."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda t, _: step(t))


def mollweide(lon: Column, lat: Column, radius: float = MAJOR, rounds: int = 8) -> XY:
    """The auxiliary angle by Newton's rule; up to 80 degrees eight rounds are exact to the millimetre."""
    goal = F.lit(math.pi) * F.sin(F.radians(lat))
    t = _newton(F.radians(lat), lambda t: t - (2 * t + F.sin(2 * t) - goal) / (2 + 2 * F.cos(2 * t)), rounds)
    return F.lit(radius * 2 * math.sqrt(2) / math.pi) * F.radians(lon) * F.cos(t), F.lit(radius * math.sqrt(2)) * F.sin(t)


def mollweide_back(x: Column, y: Column, radius: float = MAJOR) -> XY:
    t = F.asin(y / F.lit(radius * math.sqrt(2)))
    return F.degrees(F.lit(math.pi / (2 * math.sqrt(2) * radius)) * x / F.cos(t)), F.degrees(F.asin((2 * t + F.sin(2 * t)) / math.pi))


def eckert4(lon: Column, lat: Column, radius: float = MAJOR, rounds: int = 8) -> XY:
    goal = F.lit(2 + math.pi / 2) * F.sin(F.radians(lat))
    t = _newton(F.radians(lat) / 2, lambda t: t - (t + F.sin(t) * F.cos(t) + 2 * F.sin(t) - goal) / (2 * F.cos(t) * (1 + F.cos(t))), rounds)
    return F.lit(radius * 2 / math.sqrt(4 * math.pi + math.pi**2)) * F.radians(lon) * (1 + F.cos(t)), F.lit(radius * 2 * math.sqrt(math.pi / (4 + math.pi))) * F.sin(t)


def eckert4_back(x: Column, y: Column, radius: float = MAJOR) -> XY:
    t = F.asin(y / F.lit(radius * 2 * math.sqrt(math.pi / (4 + math.pi))))
    lat = F.asin((t + F.sin(t) * F.cos(t) + 2 * F.sin(t)) / F.lit(2 + math.pi / 2))
    return F.degrees(x * F.lit(math.sqrt(4 * math.pi + math.pi**2) / (2 * radius)) / (1 + F.cos(t))), F.degrees(lat)


def web_mercator(lon: Column, lat: Column) -> XY:
    return F.lit(MAJOR) * F.radians(lon), F.lit(MAJOR) * F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def web_mercator_back(x: Column, y: Column) -> XY:
    return F.degrees(x / MAJOR), F.degrees(2 * F.atan(F.exp(y / MAJOR)) - F.lit(math.pi / 2))


def _arc(lat: Column) -> Column:
    """Length of the meridian from the equator, to the sixth power of the eccentricity."""
    e2, e4, e6 = _E2, _E2**2, _E2**3
    return F.lit(MAJOR) * (F.lit(1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * lat - F.lit(3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * lat) + F.lit(15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * lat) - F.lit(35 * e6 / 3072) * F.sin(6 * lat))


def transverse_mercator(lon: Column, lat: Column, lon0: Column | float, lat0: float = 0.0, x0: float = 500000.0, y0: float = 0.0, scale: float = UTM_SCALE) -> XY:
    """The series of the ellipsoid about the central meridian, good to millimetres within some degrees of it."""
    lon0 = lon0 if isinstance(lon0, Column) else F.lit(lon0)
    p, ep2 = F.radians(lat), _E2 / (1 - _E2)
    n = F.lit(MAJOR) / F.sqrt(1 - F.lit(_E2) * F.sin(p) * F.sin(p))
    t, c, a = F.tan(p) * F.tan(p), F.lit(ep2) * F.cos(p) * F.cos(p), F.radians(lon - lon0) * F.cos(p)
    x = a + (1 - t + c) * F.pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * F.pow(a, 5) / 120
    y = a * a / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * F.pow(a, 6) / 720
    return F.lit(x0) + F.lit(scale) * n * x, F.lit(y0) + F.lit(scale) * (_arc(p) - _arc(F.lit(math.radians(lat0))) + n * F.tan(p) * y)


def transverse_mercator_back(x: Column, y: Column, lon0: Column | float, lat0: float = 0.0, x0: float = 500000.0, y0: float = 0.0, scale: float = UTM_SCALE) -> XY:
    lon0 = lon0 if isinstance(lon0, Column) else F.lit(lon0)
    e2, e4, e6, ep2 = _E2, _E2**2, _E2**3, _E2 / (1 - _E2)
    mu = (_arc(F.lit(math.radians(lat0))) + (y - y0) / scale) / F.lit(MAJOR * (1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256))
    q = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    p = mu + F.lit(3 * q / 2 - 27 * q**3 / 32) * F.sin(2 * mu) + F.lit(21 * q**2 / 16 - 55 * q**4 / 32) * F.sin(4 * mu) + F.lit(151 * q**3 / 96) * F.sin(6 * mu) + F.lit(1097 * q**4 / 512) * F.sin(8 * mu)
    c, t = F.lit(ep2) * F.cos(p) * F.cos(p), F.tan(p) * F.tan(p)
    w = 1 - F.lit(e2) * F.sin(p) * F.sin(p)
    n, r = F.lit(MAJOR) / F.sqrt(w), F.lit(MAJOR * (1 - e2)) / F.pow(w, 1.5)
    d = (x - x0) / (n * scale)
    lat = p - n * F.tan(p) / r * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep2) * F.pow(d, 4) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep2 - 3 * c * c) * F.pow(d, 6) / 720)
    lon = (d - (1 + 2 * t + c) * F.pow(d, 3) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep2 + 24 * t * t) * F.pow(d, 5) / 120) / F.cos(p)
    return lon0 + F.degrees(lon), F.degrees(lat)


def geocentric(lon: Column, lat: Column, height: Column) -> tuple[Column, Column, Column]:
    """Earth-centred coordinates of a place on the ellipsoid or above it."""
    l, p = F.radians(lon), F.radians(lat)
    n = F.lit(MAJOR) / F.sqrt(1 - F.lit(_E2) * F.sin(p) * F.sin(p))
    return (n + height) * F.cos(p) * F.cos(l), (n + height) * F.cos(p) * F.sin(l), (n * (1 - _E2) + height) * F.sin(p)


def geocentric_back(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Longitude, latitude and height by Bowring's closed form."""
    minor = MAJOR * (1 - FLATTENING)
    r = F.sqrt(x * x + y * y)
    t = F.atan2(z * MAJOR, r * minor)
    p = F.atan2(z + F.lit(_E2 / (1 - _E2) * minor) * F.pow(F.sin(t), 3), r - F.lit(_E2 * MAJOR) * F.pow(F.cos(t), 3))
    n = F.lit(MAJOR) / F.sqrt(1 - F.lit(_E2) * F.sin(p) * F.sin(p))
    return F.degrees(F.atan2(y, x)), F.degrees(p), r * F.cos(p) + z * F.sin(p) - F.lit(MAJOR * MAJOR) / n


_E = math.sqrt(_E2)
_POLE = 2 * MAJOR * UPS_SCALE / math.sqrt((1 + _E) ** (1 + _E) * (1 - _E) ** (1 - _E))


def polar_stereographic(lon: Column, lat: Column) -> XY:
    """The universal grid of the poles; the sign of the latitude picks the pole."""
    south = lat < 0
    p, l = F.radians(F.abs(lat)), F.radians(lon)
    s = F.lit(_E) * F.sin(p)
    rho = F.lit(_POLE) * F.tan(F.lit(math.pi / 4) - p / 2) * F.pow((1 + s) / (1 - s), F.lit(_E / 2))
    return 2000000 + rho * F.sin(l), 2000000 + F.when(south, 1).otherwise(-1) * rho * F.cos(l)


def polar_stereographic_back(x: Column, y: Column, south: Column, rounds: int = 6) -> XY:
    dx, dy = x - 2000000, F.when(south, 1).otherwise(-1) * (y - 2000000)
    t = F.sqrt(dx * dx + dy * dy) / F.lit(_POLE)
    half = F.lit(math.pi / 2)
    p = _newton(half - 2 * F.atan(t), lambda p: half - 2 * F.atan(t * F.pow((1 - F.lit(_E) * F.sin(p)) / (1 + F.lit(_E) * F.sin(p)), F.lit(_E / 2))), rounds)
    return F.degrees(F.atan2(dx, dy)), F.when(south, -1).otherwise(1) * F.degrees(p)


def affine_plane(x: Column, y: Column, m: tuple[float, float, float, float, float, float]) -> XY:
    return F.lit(m[0]) * x + F.lit(m[1]) * y + F.lit(m[2]), F.lit(m[3]) * x + F.lit(m[4]) * y + F.lit(m[5])


def quad(u: Column, v: Column, corners: list[tuple[float, float]]) -> XY:
    """Bilinear map of the unit square onto four corners: upper left, upper right, lower right, lower left."""
    weights = ((1 - u) * (1 - v), u * (1 - v), u * v, (1 - u) * v)
    return tuple(sum((w * F.lit(float(c[k])) for w, c in zip(weights, corners, strict=True)), F.lit(0.0)) for k in (0, 1))


def lens(x: Column, y: Column, centre: tuple[float, float], k1: float, k2: float) -> XY:
    """Radial distortion to the fourth power about a centre."""
    dx, dy = x - centre[0], y - centre[1]
    r2 = dx * dx + dy * dy
    f = 1 + F.lit(k1) * r2 + F.lit(k2) * r2 * r2
    return F.lit(centre[0]) + dx * f, F.lit(centre[1]) + dy * f


def lagrange(x: Column, knots: list[float], values: list[Column]) -> Column:
    """The polynomial through the knots, at x."""
    out = F.lit(0.0)
    for i, a in enumerate(knots):
        term = values[i]
        for j, b in enumerate(knots):
            if i != j:
                term = term * (x - b) / (a - b)
        out = out + term
    return out

# Shift along the axis (metres), turn about it (seconds of arc) and scale from the world system of 1972 to that of 1984.
WGS72 = (4.5, 0.554, 0.2263e-6)


def from_wgs72(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Earth-centred coordinates of the older world system in the newer one."""
    dz, turn, scale = WGS72[0], math.radians(WGS72[1] / 3600), 1 + WGS72[2]
    return F.lit(scale) * (x - F.lit(turn) * y), F.lit(scale) * (F.lit(turn) * x + y), F.lit(scale) * z + F.lit(dz)


def elevation_tile(lon: Column, lat: Column) -> Column:
    """Name of the one-degree elevation tile that holds a place, after its south-western corner."""
    part = lambda v, plus, minus, width: F.concat(F.when(v >= 0, F.lit(plus)).otherwise(F.lit(minus)), F.lpad(F.abs(F.floor(v)).cast("string"), width, "0"))
    return F.concat(part(lat, "N", "S", 2), part(lon, "E", "W", 3))
