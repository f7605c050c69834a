"""Functions of vectors held in array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import EPSILON


def doubles(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double"))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def product(a: Column) -> Column:
    return F.aggregate(a, F.lit(1.0), lambda s, x: s * x)


def mean(a: Column) -> Column:
    """0 for an empty vector."""
    return F.when(F.size(a) == 0, 0.0).otherwise(total(a) / F.size(a))


def same_size(a: Column, b: Column, value: Column) -> Column:
    """``value``, or an error where two vectors differ in length."""
    return F.when(F.size(a) != F.size(b), F.raise_error(F.lit("vectors of different length"))).otherwise(value)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def euclidean(a: Column, b: Column) -> Column:
    return same_size(a, b, F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))))


def manhattan(a: Column, b: Column) -> Column:
    return same_size(a, b, total(F.zip_with(a, b, lambda x, y: F.abs(x - y))))


def spectral_angle(a: Column, b: Column) -> Column:
    """Angle over the shorter length; 0 where a norm vanishes or rounding takes the cosine above 1."""
    n = F.least(F.size(a), F.size(b))
    a, b = F.slice(a, 1, n), F.slice(b, 1, n)
    norms = F.sqrt(dot(a, a) * dot(b, b))
    cosine = dot(a, b) / norms
    return F.when(norms <= EPSILON, 0.0).when(cosine > 1, 0.0).otherwise(F.acos(cosine))


def last_argmin(values: Column) -> Column:
    """0-based place of the smallest component, the last of equal ones."""
    keyed = F.transform(values, lambda x, i: F.struct(x.alias("x"), (-i).alias("i")))
    return -F.array_min(keyed)["i"]


def first_argmax(values: Column) -> Column:
    """0-based place of the largest component, the first of equal ones."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def axpy(alpha: float, x: Column, y: Column) -> Column:
    """alpha x + y, element by element."""
    return F.zip_with(x, y, lambda p, q: F.lit(float(alpha)) * p + q)


def matrix_times(rows: list[list[float]], x: Column) -> Column:
    """Product of a fixed matrix and a vector."""
    return F.array(*[dot(F.array(*[F.lit(float(v)) for v in r]), x) for r in rows])


def softmax(x: Column) -> Column:
    """Exponentials over their sum; the largest is taken off first."""
    top = F.array_max(x)
    e = F.transform(x, lambda v: F.exp(v - top))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda s, w: s + w))


def shares(x: Column) -> Column:
    """A vector over the sum of its elements' sizes; a zero vector stays."""
    n = F.aggregate(x, F.lit(0.0), lambda s, v: s + F.abs(v))
    return F.transform(x, lambda v: F.when(n > 0, v / n).otherwise(0.0))


def entropy(p: Column) -> Column:
    """-sum p ln p; zeros count nothing."""
    return -F.aggregate(p, F.lit(0.0), lambda s, v: s + F.when(v > 0, v * F.ln(F.when(v > 0, v))).otherwise(0.0))


def radial_basis(x: Column, centre: Column, radius: float) -> Column:
    """Gaussian of the distance from a centre."""
    return F.exp(-F.aggregate(F.zip_with(x, centre, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v) / F.lit(2.0 * radius * radius))


def mean_squared(errors: Column) -> Column:
    return F.aggregate(errors, F.lit(0.0), lambda s, v: s + v * v) / F.size(errors)


def poisson_loss(count: Column, rate: Column) -> Column:
    """Negative log-likelihood of a count under a rate, without the term of the count alone."""
    return rate - count * F.ln(rate)
