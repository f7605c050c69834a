"""Scalar functions of cells, angles, dates, labels and colours. None of them calls Python for a row."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371000.0
#: Below this a variance or a product of norms counts as none.
EPSILON = 1e-10


def affine(x: Column, a: float, b: float) -> Column:
    return F.lit(float(b)) + F.lit(float(a)) * x


def half_open(x: Column, low: float, high: float) -> Column:
    """1 for low < x <= high, else 0."""
    return F.when((x > low) & (x <= high), 1).otherwise(0)


def outside(x: Column, low: float, high: float) -> Column:
    """0 for low <= x <= high, else 1."""
    return F.when((x >= low) & (x <= high), 0).otherwise(1)


def brightness(dn: Column, scale: float, decibel: bool = True) -> Column:
    """Radar brightness of an amplitude; what isn't positive is 1e-5 before the logarithm."""
    beta = F.lit(scale) * dn * dn
    beta = F.when(beta <= 0, F.lit(1e-5)).otherwise(beta)
    return 10 * F.log10(beta) if decibel else beta


def polynomial(t: Column, coefficients: list[float]) -> Column:
    """Value at t, by Horner's rule; coefficients from the constant upwards."""
    out = F.lit(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        out = out * t + F.lit(float(c))
    return out


def mean_ratio(a: Column, b: Column) -> Column:
    """0 where the means are equal, else 1 - smaller / larger; null over a zero."""
    top = F.greatest(a, b)
    return F.when(a == b, 0.0).when(top == 0, None).otherwise(1 - F.least(a, b) / top)


def blend(a: Column, b: Column, alpha: float) -> Column:
    """Two values in the ratio alpha (clamped to 0..1), rounded half up towards plus infinity."""
    share = max(0.0, min(1.0, alpha))
    return F.floor(F.lit(share) * a + F.lit(1 - share) * b + 0.5)


def potts(a: Column, b: Column, beta: float = 1.0) -> Column:
    return F.when(a == b, -beta).otherwise(beta)


def edge_fidelity(a: Column, b: Column) -> Column:
    u = (a - b) * (a - b)
    return u / (1 + u)


def gaussian_energy(a: Column, b: Column) -> Column:
    return (a - b) * (a - b)


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres on a sphere."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def day_of_season(day: Column, month: Column) -> Column:
    """Day index of the solar formula, in integer arithmetic."""
    start = (month - 1) * 31 + day
    late = F.floor((month - 2) / 2) + 2
    middle = F.floor((month - 1) / 2) + 2
    return F.when(month <= 2, start).when(month > 8, start - late).otherwise(start - middle)


def solar_variability(day: Column, month: Column) -> Column:
    d = 1 - F.cos((day_of_season(day, month) - 4) * F.lit(0.9856 * math.pi / 180)) * 0.01673
    return 1 / (d * d)


def sigmoid_transfer(x: Column, alpha: float, beta: float, low: float, high: float) -> Column:
    return F.lit(high - low) / (1 + F.exp(-(x - beta) / alpha)) + F.lit(low)


def gaussian_transfer(x: Column) -> Column:
    return F.exp(-x * x)


def gaussian_kernel(u: Column) -> Column:
    return F.exp(-0.5 * u * u) / math.sqrt(2 * math.pi)


def heaviside(x: Column) -> Column:
    return F.when(x >= 0, 1.0).otherwise(0.0)


def in_sphere(coordinates: list[Column], centre: list[float], radius: float = 1.0) -> Column:
    d2 = sum(((x - c) * (x - c) for x, c in zip(coordinates, centre, strict=True)), F.lit(0.0))
    return F.when(d2 - radius * radius <= 0, 1).otherwise(0)


def fft_shift(index: Column, size: int, inverse: bool = False) -> Column:
    """Index after a cyclic shift by half the size."""
    half = size // 2
    return F.pmod(index + (-half if inverse else half), F.lit(size))


def label_rgb(label: Column) -> tuple[Column, Column, Column]:
    """Three colour bytes of an integer label."""
    b0, b1, b2 = label.bitwiseAND(255), F.shiftright(label, 8).bitwiseAND(255), F.shiftright(label, 16).bitwiseAND(255)
    return (b0 * 3).bitwiseAND(255), ((b0 + b1) * 5).bitwiseAND(255), (b0 + b2).bitwiseAND(255)


# Knots and colours of the relief ramp.
RELIEF = [
    (0.0, 0.75, 0.91, 0.96),
    (0.00001, 0.64, 0.84, 0.59),
    (0.2, 0.47, 0.76, 0.40),
    (0.43, 0.89, 0.90, 0.57),
    (0.71, 0.58, 0.32, 0.00),
    (1.0, 1.0, 1.0, 1.0),
]


def relief(value: Column) -> tuple[Column, Column, Column]:
    """Colour of a height in 0..1, linear between the knots, as bytes."""

    def channel(k: int) -> Column:
        out = None
        for (a, *low), (b, *high) in zip(RELIEF, RELIEF[1:], strict=False):
            at = F.lit(low[k]) + (value - a) / (b - a) * (high[k] - low[k])
            out = F.when(value <= b, at) if out is None else out.when(value <= b, at)
        return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), out.otherwise(F.lit(RELIEF[-1][1 + k])))) * 255 + 0.5).cast("int")

    return channel(0), channel(1), channel(2)


def amplitude_phase(amplitude: Column, phase: Column, coherence: Column, low: float, high: float) -> tuple[Column, Column, Column]:
    """Hue, saturation and value of an interferogram cell."""
    hue = 0.6 - (phase + math.pi) * 0.6 / (2 * math.pi)
    value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (amplitude - low) / (high - low)))
    return hue, coherence * 0.6 + 0.3, value


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def hemisphere(lat: Column) -> Column:
    return F.when(lat > 0, "N").otherwise("S")


def normalised_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b), 0 where both cancel."""
    return F.when(a + b == 0, 0.0).otherwise((a - b) / (a + b))


def soil_adjusted(nir: Column, red: Column, soil: float = 0.5) -> Column:
    d = nir + red + soil
    return F.when(d == 0, 0.0).otherwise((nir - red) * (1 + soil) / d)


def enhanced_vegetation(nir: Column, red: Column, blue: Column) -> Column:
    d = nir + 6 * red - 7.5 * blue + 1
    return F.when(d == 0, 0.0).otherwise(2.5 * (nir - red) / d)


def modulus(re: Column, im: Column) -> Column:
    return F.sqrt(re * re + im * im)


def phase(re: Column, im: Column) -> Column:
    return F.atan2(im, re)


def synthesis(s: dict[str, tuple[Column, Column]], incident: tuple[complex, complex], received: tuple[complex, complex]) -> Column:
    """Power of a scattering matrix (hh, hv, vh, vv as real and imaginary part) seen under two polarisations."""
    er = (received[0].conjugate(), received[1].conjugate())
    factor = {"hh": er[0] * incident[0], "hv": er[0] * incident[1], "vh": er[1] * incident[0], "vv": er[1] * incident[1]}
    re = sum((F.lit(f.real) * s[k][0] - F.lit(f.imag) * s[k][1] for k, f in factor.items()), F.lit(0.0))
    im = sum((F.lit(f.real) * s[k][1] + F.lit(f.imag) * s[k][0] for k, f in factor.items()), F.lit(0.0))
    return re * re + im * im


def mercator_lambert_secant(lon: Column, lat: Column, lon0: float, lat0: float, x0: float, y0: float, lat1: float, lat2: float, major: float, eccentricity: float) -> tuple[Column, Column]:
    """Lambert conformal conic with two standard parallels on an ellipsoid: metres east and north."""
    rad = math.radians

    def m(p: float) -> float:
        return math.cos(p) / math.sqrt(1 - (eccentricity * math.sin(p)) ** 2)

    def t(p: float) -> float:
        e = eccentricity * math.sin(p)
        return math.tan(math.pi / 4 - p / 2) / ((1 - e) / (1 + e)) ** (eccentricity / 2)

    n = (math.log(m(rad(lat1))) - math.log(m(rad(lat2)))) / (math.log(t(rad(lat1))) - math.log(t(rad(lat2))))
    scale = major * m(rad(lat1)) / (n * t(rad(lat1)) ** n)
    rho0 = scale * t(rad(lat0)) ** n
    e = F.lit(eccentricity) * F.sin(F.radians(lat))
    tt = F.tan(F.lit(math.pi / 4) - F.radians(lat) / 2) / F.pow((1 - e) / (1 + e), F.lit(eccentricity / 2))
    rho, theta = F.lit(scale) * F.pow(tt, F.lit(n)), F.lit(n) * F.radians(lon - lon0)
    return F.lit(x0) + rho * F.sin(theta), F.lit(y0 + rho0) - rho * F.cos(theta)


# Parameters of a national grid (degrees and metres) and its ellipsoid.
LAMBERT93 = {"lon0": 3.0, "lat0": 46.5, "x0": 700000.0, "y0": 6600000.0, "lat1": 44.0, "lat2": 49.0, "major": 6378137.0, "eccentricity": 0.0818191910428158}
