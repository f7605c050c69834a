import math

import pytest
from pyspark.sql import functions as F

from gridloom.functions import arrays, geometry, scalar
from gridloom.functions.expressions import ExpressionError, parse


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def vector(*x):
    return F.array(*[F.lit(float(v)) for v in x])


@pytest.mark.parametrize("x, want", [(0.0, 0), (0.5, 1), (1.0, 1), (1.1, 0)])
def test_half_open(spark, x, want):
    assert value(spark, scalar.half_open(F.lit(x), 0, 1)) == want


def test_brightness_guards_before_the_logarithm(spark):
    assert value(spark, scalar.brightness(F.lit(0.0), 2.0)) == pytest.approx(-50)
    assert value(spark, scalar.brightness(F.lit(3.0), 2.0, decibel=False)) == 18


def test_blend_clamps_and_rounds_half_up(spark):
    assert value(spark, scalar.blend(F.lit(3), F.lit(-4), 2.0)) == 3
    assert value(spark, scalar.blend(F.lit(-1), F.lit(-2), 0.5)) == -1


def test_mean_ratio(spark):
    assert value(spark, scalar.mean_ratio(F.lit(0.0), F.lit(0.0))) == 0
    assert value(spark, scalar.mean_ratio(F.lit(1.0), F.lit(4.0))) == 0.75
    assert value(spark, scalar.mean_ratio(F.lit(-1.0), F.lit(0.0))) is None


@pytest.mark.parametrize("day, month, want", [(1, 1, 1), (28, 2, 59), (1, 3, 60), (1, 9, 244), (31, 12, 365)])
def test_day_of_season(spark, day, month, want):
    def plain(d, m):
        if m <= 2:
            return (m - 1) * 31 + d
        return (m - 1) * 31 - ((m - 2) // 2 if m > 8 else (m - 1) // 2) - 2 + d

    assert value(spark, scalar.day_of_season(F.lit(day), F.lit(month))) == plain(day, month)
    assert plain(day, month) == want


def test_haversine_quarter_of_the_equator(spark):
    assert value(spark, scalar.haversine(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(0.0))) == pytest.approx(6371000 * math.pi / 2)


def test_spectral_angle_guards(spark):
    assert value(spark, arrays.spectral_angle(vector(0, 0), vector(1, 2))) == 0
    assert value(spark, arrays.spectral_angle(vector(1, 1), vector(2, 2))) == pytest.approx(0, abs=1e-7)
    assert value(spark, arrays.spectral_angle(vector(1, 0, 5), vector(0, 1))) == pytest.approx(math.pi / 2)


def test_distances(spark):
    assert value(spark, arrays.euclidean(vector(0, 3), vector(4, 0))) == 5
    assert value(spark, arrays.manhattan(vector(0, 3), vector(4, 0))) == 7
    with pytest.raises(Exception, match="different length"):
        value(spark, arrays.euclidean(vector(1), vector(1, 2)))


def test_ties(spark):
    assert value(spark, arrays.last_argmin(vector(2, 1, 1))) == 2
    assert value(spark, arrays.first_argmax(vector(2, 5, 5))) == 1
    assert value(spark, arrays.mean(F.array().cast("array<double>"))) == 0


def square(x, y, side):
    at = lambda a, b: F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y"))
    return F.array(at(x, y), at(x + side, y), at(x + side, y + side), at(x, y + side))


def test_rings(spark):
    ring = square(0, 0, 2)
    assert value(spark, geometry.ring_area(ring)) == 4 and value(spark, geometry.ring_length(ring)) == 8
    assert value(spark, geometry.in_ring(F.lit(1.0), F.lit(1.0), ring)) and not value(spark, geometry.in_ring(F.lit(3.0), F.lit(1.0), ring))
    text = geometry.well_known_text(ring, "POLYGON")
    assert value(spark, F.size(geometry.points_of_text(text))) == 5


def test_box_relations(spark):
    box = lambda a, b, c, d: F.struct(F.lit(float(a)).alias("minx"), F.lit(float(b)).alias("maxx"), F.lit(float(c)).alias("miny"), F.lit(float(d)).alias("maxy"))
    rel = lambda p, q: value(spark, geometry.box_relation(box(*p), box(*q)))
    a = (0, 4, 0, 4)
    assert [rel(a, b) for b in ((5, 6, 0, 1), (4, 6, 0, 1), (0, 4, 0, 4), (1, 2, 1, 2), (-1, 5, -1, 5), (2, 6, 2, 6), (0, 2, 1, 2), (0, 9, -1, 9))] == ["DC", "EC", "EQ", "NTPPI", "NTPP", "PO", "TPPI", "TPP"]


def test_segment_distance(spark):
    args = [F.lit(float(v)) for v in (1, 1, 0, 0, 0, 0)]
    assert value(spark, geometry.segment_distance(*args)) == pytest.approx(math.sqrt(2))


@pytest.mark.parametrize(
    "text, want",
    [("1 + 2 * 3", 7), ("-2 ^ 2", -4), ("2 ^ 3 ^ 2", 512), ("(a - b) / (a + b)", -1 / 3), ("a > b ? 1 : 2", 2), ("a == 1 && b == 2", 1), ("!(a == 1) || b < 0", 0), ("3!", 6), ("50%", 0.5), ("7 % 4", 3), ("max(a, b, 5)", 5), ("avg(a, b)", 1.5), ("sqrt(pi ^ 2)", math.pi), ("a / 0", None)],
)
def test_expressions(spark, text, want):
    got = value(spark, parse(text, {"a": F.lit(1), "b": F.lit(2)}))
    assert got is None if want is None else got == pytest.approx(want)


@pytest.mark.parametrize("text", ["1 +", "(1", "nothing", "exec(1)", "a $ b", "sqrt()", "1 2"])
def test_bad_expressions(text):
    with pytest.raises(ExpressionError):
        parse(text, ["a", "b"])
