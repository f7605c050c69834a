"""Projections, hulls, polarimetry and models against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import geometry, radar
from gridloom.functions import projections as P
from gridloom.operators import imagery, learning
from gridloom.plans import learning as queries
from gridloom.plans import vectors

from .conftest import SF


def test_projections_come_back(spark):
    places = spark.createDataFrame([(float(lon), float(lat)) for lon in (-170, -3, 0, 12.5, 179) for lat in (-79.5, -10, 0, 45, 80)], "lon double, lat double")
    lon, lat = F.col("lon"), F.col("lat")
    pairs = {"sinusoidal": {}, "mollweide": {}, "eckert4": {}, "web_mercator": {}}
    for name in pairs:
        x, y = getattr(P, name)(lon, lat)
        a, b = getattr(P, f"{name}_back")(F.col("x"), F.col("y"))
        off = places.withColumn("x", x).withColumn("y", y).select(F.max(F.abs(a - lon)), F.max(F.abs(b - lat))).first()
        assert max(off) < 1e-7, name


def test_svy21_and_utm(spark):
    one = spark.range(1)
    e, n = P.transverse_mercator(F.lit(103.83333333333333), F.lit(1.3666666666666667), **P.SVY21)
    assert one.select(F.round(e, 3), F.round(n, 3)).first() == (28001.642, 38744.572)
    e, n = P.transverse_mercator(F.lit(9.0), F.lit(0.0), 9.0)
    assert one.select(F.round(e, 6), F.round(n, 6)).first() == (500000.0, 0.0)


def hull(points):
    ps = sorted(set(points))
    if len(ps) <= 2:
        return ps
    cross = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    edges = {}
    for a in ps:
        for b in ps:
            if a != b and all(cross(a, b, c) > 0 or (cross(a, b, c) == 0 and (c[0] - a[0]) * (c[0] - b[0]) + (c[1] - a[1]) * (c[1] - b[1]) <= 0) for c in ps):
                edges[a] = b
    out = [ps[0]]
    while edges.get(out[-1], ps[0]) != ps[0]:
        out.append(edges[out[-1]])
    return out


def test_convex_hull(spark):
    rng = np.random.default_rng(0)
    sets = [[(float(x), float(y)) for x, y in rng.integers(0, 9, (n, 2))] for n in (1, 2, 3, 5, 12, 40)] + [[(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)], [(0.0, 0.0)] * 4]
    f = spark.createDataFrame([(k, p) for k, p in enumerate(sets)], "k int, p array<struct<x: double, y: double>>")
    got = {r["k"]: [tuple(p) for p in r["h"]] for r in f.select("k", geometry.convex_hull(F.col("p")).alias("h")).collect()}
    for k, p in enumerate(sets):
        want = hull(p) if k != 6 else [(0.0, 0.0), (2.0, 2.0)]
        assert got[k] == want, k


def test_entropy_and_alpha(spark):
    zero, one = F.lit(0.0), F.lit(1.0)
    t = {f"m{i}{j}{p}": zero for i in range(1, 4) for j in range(i + 1, 4) for p in "ri"}
    even, alone = t | {"m11": one, "m22": one, "m33": one}, t | {"m11": one, "m22": zero, "m33": zero}
    a, b = spark.range(1).select(radar.entropy_alpha_anisotropy(even), radar.entropy_alpha_anisotropy(alone)).first()
    assert a["entropy"] == pytest.approx(1) and b["entropy"] == pytest.approx(0) and b["alpha"] == pytest.approx(0) and a["anisotropy"] == pytest.approx(0)


def embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    return np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float), np.array([r["label"] for r in rows])


def test_components_against_numpy(spark):
    ids, x, _ = embeddings(spark)
    _, vectors = np.linalg.eigh(np.cov(x.T))
    want = x @ vectors[:, ::-1][:, :3]
    got = {r["vec_id"]: r["components"] for r in queries.pca_components(spark, SF).collect()}
    assert np.allclose(np.abs([got[k] for k in ids]), np.abs(want), atol=1e-6)


def test_regression_against_numpy(spark):
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").collect()
    a = np.array([[1.0, r["l_quantity"], r["l_discount"]] for r in rows])
    y = np.array([r["l_extendedprice"] for r in rows])
    w = np.linalg.lstsq(a, y, rcond=None)[0]
    got = queries.price_regression(spark, SF).agg(F.sum("predicted"), F.max("predicted"), F.min("predicted")).first()
    assert list(got) == pytest.approx([(a @ w).sum(), (a @ w).max(), (a @ w).min()], rel=1e-4)


def test_alteration_is_uncorrelated_with_unit_scale(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 2))
    y = np.stack((x[:, 0] + rng.normal(0, 0.2, 400), rng.normal(size=400)), 1)
    f = spark.createDataFrame([tuple(map(float, (*p, *q))) for p, q in zip(x, y, strict=True)], "a0 double, a1 double, b0 double, b1 double")
    m = np.array([[r["mad_0"], r["mad_1"]] for r in imagery.alteration(f, ["a0", "a1"], ["b0", "b1"]).collect()])
    c = np.cov(m.T)
    assert abs(c[0, 1]) < 1e-9 and c[0, 0] > c[1, 1]
    qx, qy = (np.linalg.qr(z - z.mean(0))[0] for z in (x, y))
    s = np.sort(np.linalg.svd(qx.T @ qy)[1])
    assert np.diag(c) == pytest.approx(2 * (1 - s), rel=1e-6)


def test_fourier_against_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(5, 7))
    f = spark.createDataFrame([(1, r, c, float(x[r, c])) for r in range(5) for c in range(7)], "image int, row int, col int, v double")
    got = np.zeros((5, 7), complex)
    for r in imagery.spectrum(f, "image", "v").collect():
        got[r["row"], r["col"]] = r["re"] + 1j * r["im"]
    assert np.allclose(got, np.fft.fft2(x))


@pytest.mark.parametrize("kind", ["logistic", "forest", "tree", "bayes", "perceptron", "vote"])
def test_models_are_trained_saved_and_applied(spark, tmp_path, kind):
    rng = np.random.default_rng(3)
    rows = [([float(abs(a + 5 * k)), float(abs(b + 3 * (k == 2)))], 10 * k) for k in range(3) for a, b in rng.normal(size=(50, 2))]
    f = spark.createDataFrame(rows, "f array<double>, lab int").repartition(3)
    model = learning.train(f, "f", "lab", kind)
    learning.save(model, f"{tmp_path}/{kind}")
    again = learning.load(f"{tmp_path}/{kind}")
    got = learning.apply(again, f, "f")
    assert set(got.columns) == {"f", "lab", "predicted", "confidence"}
    right = got.where("predicted = lab").count()
    assert right >= 130 and got.schema["predicted"].dataType.simpleString() == "int"
    assert sorted(map(str, learning.apply(model, f, "f").collect())) == sorted(map(str, got.collect()))
    per = {r["class"]: r for r in learning.validated(again, f, "f", "lab").collect()}
    assert set(per) == {0, 10, 20} and sum(r["hit"] for r in per.values()) == right


def test_feature_selection_finds_what_tells_classes_apart(spark):
    rng = np.random.default_rng(4)
    rows = [([float(n[0]), float(n[1] + 4 * k), float(n[2]), float(n[3] - 3 * k)], k) for k in (0, 1) for n in rng.normal(size=(80, 4))]
    f = spark.createDataFrame(rows, "f array<double>, lab int")
    assert learning.selected_features(f, "f", "lab", 2)[0] == 1 and set(learning.selected_features(f, "f", "lab", 2)) == {1, 3}


def test_filled_gaps_are_made_on_all_cores(spark):
    d = vectors.filled_gaps(spark, SF)
    assert d.rdd.getNumPartitions() >= 32


def test_rounding_of_gaps_equals_round(spark):
    d = F.sqrt(F.col("id").cast("double"))
    assert spark.range(3601).where(F.round(d, 6) != F.floor(d * 1e6 + 0.5) / F.lit(1e6)).count() == 0
