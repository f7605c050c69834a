import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import imagery as I

from .test_operators import image


def test_mean_shift_tiles_agree_at_their_seams(spark):
    cells = np.random.default_rng(0).integers(0, 9, (13, 17))
    rows = lambda side: np.array(sorted(map(tuple, I.mean_shift(image(spark, cells), "v", side, 1, 3.0, 3).collect())))
    assert len(rows(5)) == 13 * 17 and np.allclose(rows(5), rows(100))
    flat = I.mean_shift(image(spark, np.full((4, 4), 7)), "v", 2, 1, 1.0).select("v").distinct().collect()
    assert [r[0] for r in flat] == [7.0]


def test_spectrum(spark):
    cells = np.arange(20.0).reshape(4, 5)
    got = I.spectrum(image(spark, cells).withColumn("k", F.lit(1)), "k", "v").collect()
    f = np.fft.fft2(cells)
    assert all(abs(f[r["row"], r["col"]] - complex(r["re"], r["im"])) < 1e-9 for r in got) and len(got) == 20


def test_simplified_paths(spark):
    at = lambda *p: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in p])
    one = lambda pts, t: [tuple(p) for p in I.simplified(spark.range(1).select(at(*pts).alias("p")), "p", t).first()[0]]
    assert one([(0, 0), (1, 0.1), (2, 0), (3, 5), (4, 0)], 0.5) == [(0, 0), (2, 0), (3, 5), (4, 0)]
    assert one([(0, 0), (0, 0), (0, 0)], 1.0) == [(0, 0), (0, 0)]
    with pytest.raises(ValueError):
        I.simplified(spark.range(1), "p", -1)


def test_unmixing_gives_back_the_shares():
    ends = np.array([[1.0, 0, 0], [0, 1, 1]])
    assert np.linalg.pinv(ends.T) @ (0.3 * ends[0] + 0.7 * ends[1]) == pytest.approx([0.3, 0.7])


def test_alteration_of_equal_dates_is_nothing(spark):
    rng = np.random.default_rng(1)
    f = spark.createDataFrame([tuple(map(float, r)) for r in rng.normal(size=(200, 2))], "a double, b double").withColumn("c", F.col("a") * 2 + 1).withColumn("d", F.col("b") - F.col("a"))
    out = I.alteration(f, ["a", "b"], ["c", "d"])
    assert out.agg(F.max(F.abs("mad_0")), F.max(F.abs("mad_1"))).first() == pytest.approx((0, 0), abs=1e-5)


def test_drawn_path(spark):
    p = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 3.0, 0.0), (1, 2, 3.0, 2.0)], "path int, seq int, x double, y double")
    assert {(r["row"], r["col"]) for r in I.drawn_paths(p).collect()} == {(0, 0), (0, 1), (0, 2), (0, 3), (1, 3), (2, 3)}


def test_no_data_and_dempster_shafer(spark):
    f = spark.createDataFrame([(1, -1.0), (2, float("nan")), (3, 5.0), (4, None)], "k int, v double")
    assert [(r["v"], r["valid"]) for r in I.with_no_data(f, "v", -1.0).orderBy("k").collect()] == [(None, 0), (None, 0), (5.0, 1), (None, 0)]
    v = spark.createDataFrame([(1, 0, 0.6), (1, 1, 0.5), (1, 1, 0.5)], "k int, l int, m double")
    r = I.dempster_shafer(v, "k", "l", "m").first()
    a, b, rest = 0.6 * 0.25, 0.75 * 0.4, 0.4 * 0.25  # conflict is left out
    assert r["l"] == 1 and r["belief"] == pytest.approx(b / (a + b + rest), abs=1e-6)
