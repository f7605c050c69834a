import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import graph, joins, learning, sampling, stats
from gridloom.operators import grid as G

from .conftest import SF


def image(spark, cells):
    rows = [(r, c, float(v)) for r, line in enumerate(cells) for c, v in enumerate(line)]
    return spark.createDataFrame(rows, "row int, col int, v double")


def test_stencil_repeats_the_border(spark):
    cells = np.arange(12.0).reshape(3, 4)
    padded = np.pad(cells, 2, mode="edge")
    for radius in (1, 2):
        for r in G.stencil(image(spark, cells), "v", radius).collect():
            want = padded[r["row"] + 2 - radius : r["row"] + 3 + radius, r["col"] + 2 - radius : r["col"] + 3 + radius]
            assert r["hood"] == want.ravel().tolist()


def test_neighbourhood_functions(spark):
    h = F.array(*[F.lit(float(x)) for x in (9, 1, 1, 2, 2, 3, 5, 8, 4)])
    row = spark.range(1).select(G.hood_mean(h), G.hood_variance(h), G.hood_median(h), G.majority(h), G.hood_sum_of_squares(h)).first()
    x = np.array([9, 1, 1, 2, 2, 3, 5, 8, 4.0])
    assert list(row) == pytest.approx([x.mean(), x.var(ddof=1), np.sort(x)[4], 1, (x * x).sum()])


def test_kernels():
    assert sum(G.gaussian_weights(2, 1.0)) == pytest.approx(1)
    assert G.gabor_weights(1, 1, 1, 0, 0, 0, 0)[4] == 1


def test_fill_crop_pyramid(spark):
    g = G.filled(image(spark, [[1, 2]]), 2, 3, {"v": 0.0})
    assert g.count() == 6 and g.agg(F.sum("v")).first()[0] == 3
    assert {(r["row"], r["col"]) for r in G.crop(g, 1, 1, 1, 2).collect()} == {(0, 0), (0, 1)}
    assert G.pyramid(image(spark, [[1, 3], [5, 7]]), "v", 1).first()["v"] == 4


def test_mosaic_of_parts_is_the_whole(spark):
    g = image(spark, np.arange(16).reshape(4, 4))
    out = G.mosaic(g.where("col < 3"), g.where("col >= 2"), value="v")
    assert sorted(map(tuple, out.select("row", "col", "v").collect())) == sorted(map(tuple, g.collect()))


def test_moments_divide_by_the_sample_variance(spark):
    x = np.array([1.0, 2, 2, 3, 9])
    f = spark.createDataFrame([("a", v) for v in x.tolist()] + [("b", 5.0), ("b", 5.0), ("c", 1.0)], "k string, v double")
    got = {r["k"]: r for r in stats.moments(f, "v", "k").collect()}
    n, m, s1, s2, s3, s4 = len(x), x.mean(), x.sum(), (x**2).sum(), (x**3).sum(), (x**4).sum()
    var = (s2 - s1 * m) / (n - 1)
    assert got["a"]["skewness"] == pytest.approx(((s3 - 3 * m * s2) / n + 2 * m**3) / (var * np.sqrt(var)))
    assert got["a"]["kurtosis"] == pytest.approx(((s4 - 4 * m * s3 + 6 * m * m * s2) / n - 3 * m**4) / var**2 - 3)
    assert got["b"]["skewness"] == 0 and got["c"]["variance"] is None


def test_joint_entropy_counts_each_row(spark):
    f = spark.createDataFrame([(0, 0)] * 3 + [(1, 0)], "a int, b int")
    want = -(3 * 3 * np.log(3)) / 4 + np.log(4)
    assert stats.joint_entropy(f, "a", "b").first()["joint_entropy"] == pytest.approx(want)


def test_radius_join_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 40, (60, 2)) / 2, rng.integers(0, 40, (80, 2)) / 2
    left = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(a)], "lid int, lx double, ly double")
    right = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(b)], "rid int, rx double, ry double")
    got = {(r["lid"], r["rid"]) for r in joins.within_radius(left, right, 2.5).collect()}
    assert got == {(i, j) for i in range(60) for j in range(80) if ((a[i] - b[j]) ** 2).sum() <= 6.25}


def test_envelope_join_gives_each_pair_once(spark):
    rng = np.random.default_rng(1)
    box = lambda n: [(i, (float(x), float(x + w), float(y), float(y + abs(h)))) for i, (x, y, w, h) in enumerate(rng.integers(-3, 20, (n, 4)))]
    a, b = box(40), box(40)
    kind = "minx double, maxx double, miny double, maxy double"
    got = [(r["lid"], r["rid"]) for r in joins.envelopes_meeting(spark.createDataFrame(a, f"lid int, lbox struct<{kind}>".replace(" double", ": double")), spark.createDataFrame(b, f"rid int, rbox struct<{kind}>".replace(" double", ": double")), 4.0).collect()]
    ok = lambda p: p[0] <= p[1]
    want = {(i, j) for i, p in a for j, q in b if ok(p) and ok(q) and p[0] <= q[1] and q[0] <= p[1] and max(p[2], q[2]) <= min(p[3], q[3])}
    assert len(got) == len(set(got)) and set(got) == want


def test_components_against_union_find(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2)) if a != b] + [(k, k + 1) for k in range(100, 140)]
    nodes = sorted({x for e in edges for x in e} | {999})
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        parent[q] = p
    got = graph.components(spark.createDataFrame([(x,) for x in nodes], "node long"), spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["label"] for r in got.collect()} == {x: find(x) for x in nodes}


def test_components_contracted_in_ranges(spark, monkeypatch):
    cells = np.random.default_rng(6).integers(0, 2, (30, 8))
    links = [(8 * r + c, 8 * i + j) for r in range(30) for c in range(8) for i, j in ((r, c + 1), (r + 1, c)) if i < 30 and j < 8 and cells[r, c] == cells[i, j]]
    links = [p if k % 2 else p[::-1] for k, p in enumerate(links)] + [(1000, 3000), (3000, 2000), (2000, 1001), (5, 5)]
    want = {x: x for x in [*range(240), 1000, 1001, 2000, 3000, 9999]}
    for _ in range(len(want)):
        before = dict(want)
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
        if before == want:
            break
    nodes, edges = spark.createDataFrame([(x,) for x in want], "node long"), spark.createDataFrame(links, "a long, b long")
    for most in (1_000_000, 70, 5):
        monkeypatch.setattr(graph, "LINKS", most)
        got = graph.components(nodes, edges).collect()
        assert len(got) == len(want) and {r["node"]: r["label"] for r in got} == want


def regions(spark, rows, edges):
    """Regions (node, area, mean) without outlines."""
    made = [(n, a, 4, 0, 0, 0, 0, float(a * m), float(a * m * m)) for n, a, m in rows]
    return spark.createDataFrame(made, "node long, area long, perimeter long, r0 long, r1 long, c0 long, c1 long, s0 double, q0 double"), spark.createDataFrame([(*e, 1) for e in edges], "a long, b long, boundary long")


def test_region_merging_is_area_weighted(spark):
    nodes, edges = regions(spark, [(1, 1, 0.0), (2, 3, 1.0), (3, 1, 50.0)], [(1, 2), (2, 3)])
    got = graph.merge_regions(nodes, edges, graph.spring, 5.0).select("node", "area", F.col("s0") / F.col("area"))
    assert sorted(map(tuple, got.collect())) == [(1, 4, 0.75), (3, 1, 50.0)]


def test_unfinished_merging_raises(spark):
    values = np.cumsum(np.arange(14.0)) / 50
    nodes, edges = regions(spark, [(k, 1, v) for k, v in enumerate(values)], [(k, k + 1) for k in range(13)])
    with pytest.raises(RuntimeError):
        graph.merge_regions(nodes, edges, graph.spring, 5.0, rounds=3)
    assert graph.merge_regions(nodes, edges, graph.spring, 5.0).count() == 1


def test_merging_in_strips_equals_rounds_over_the_whole_table(spark, monkeypatch):
    cells = np.random.default_rng(8).integers(0, 30, (40, 6)).astype(float)
    nodes, edges = graph.cell_regions(image(spark, cells), ["v"], 6)
    rows = lambda: sorted(map(tuple, graph.merge_regions(nodes, edges, graph.spring, 4.0).collect()))
    mutual = graph._mutual
    monkeypatch.setattr(graph, "_mutual", lambda *a: pytest.fail("a joined round"))
    whole = rows()
    monkeypatch.setattr(graph, "STRIP", 60)
    monkeypatch.setattr(graph, "MARGIN", 42)
    in_strips = rows()
    monkeypatch.setattr(graph, "_mutual", mutual)
    monkeypatch.setattr(graph, "_IN_STRIPS", {})
    assert rows() == whole == in_strips and 20 < len(whole) < 200


def outline(mask):
    """Sides of a region's cells that no other cell of it shares."""
    p = np.pad(mask, 1)
    return sum((p & ~np.roll(p, k, axis)).sum() for axis in (0, 1) for k in (1, -1))


@pytest.mark.parametrize("cost", ["spring", "baatz", "full_lambda"])
def test_merging_keeps_outlines_and_follows_the_costs(spark, cost):
    rng = np.random.default_rng(4)
    cells = rng.integers(0, 9, (7, 9)).astype(float)
    label, lab = np.arange(63).reshape(7, 9), np.arange(63).reshape(7, 9)
    nodes, edges = graph.cell_regions(image(spark, cells), ["v"], 9)

    def price(p, q):
        m, n = label == p, label == q
        a, b, u = cells[m], cells[n], cells[m | n]
        if cost == "spring":
            return abs(a.mean() - b.mean())
        border = (outline(m) + outline(n) - outline(m | n)) / 2
        if cost == "full_lambda":
            return len(a) * len(b) / len(u) * (a.mean() - b.mean()) ** 2 / border
        box = lambda x: 2 * sum(np.ptp(np.nonzero(x)[k]) + 1 for k in (0, 1))
        colour = len(u) * u.std() - len(a) * a.std() - len(b) * b.std()
        compact = sum(s * outline(x) * np.sqrt(x.sum()) for s, x in ((1, m | n), (-1, m), (-1, n)))
        smooth = sum(s * outline(x) * x.sum() / box(x) for s, x in ((1, m | n), (-1, m), (-1, n)))
        return 0.7 * colour + 0.3 * (0.3 * compact + 0.7 * smooth)

    for _ in range(3):
        near = {tuple(sorted((int(x), int(y)))) for s, t in ((label[1:], label[:-1]), (label[:, 1:], label[:, :-1])) for x, y in zip(s.ravel(), t.ravel(), strict=True) if x != y}
        best = {}
        for a, b in near:
            c = round(float(price(a, b)), 9)
            for x, y in ((a, b), (b, a)):
                best[x] = min(best.get(x, (9e9, 0)), (c, y))
        lab = label.copy()
        for x, (c, y) in best.items():
            if x < y and best[y][1] == x and c < 5.0:
                lab[label == y] = x
        label = lab
        nodes, edges = (graph.saved(f) for f in graph.merge_round(nodes, edges, getattr(graph, cost), 5.0))
        got = {r["node"]: (r["area"], r["perimeter"], round(r["s0"], 6)) for r in nodes.collect()}
        assert got == {int(k): (int((label == k).sum()), int(outline(label == k)), round(float(cells[label == k].sum()), 6)) for k in np.unique(label)}


def test_small_regions_are_absorbed(spark):
    rng = np.random.default_rng(6)
    cells, label = rng.integers(0, 50, (12, 12)).astype(float), np.repeat(np.repeat(rng.integers(0, 40, (4, 6)), 3, 0), 2, 1) * 7 + rng.integers(0, 2, (12, 12))
    f = spark.createDataFrame([(r, c, float(cells[r, c]), int(label[r, c])) for r in range(12) for c in range(12)], "row int, col int, v double, l int")
    nodes, names = graph.small_regions_absorbed(*(graph.saved(x) for x in graph.label_regions(f, "l", ["v"])), 10)
    want = label.copy()
    while True:
        near = {(int(x), int(y)) for s, t in ((want[1:], want[:-1]), (want[:, 1:], want[:, :-1])) for x, y in [*zip(s.ravel(), t.ravel(), strict=True), *zip(t.ravel(), s.ravel(), strict=True)] if x != y}
        mean = {int(k): cells[want == k].mean() for k in np.unique(want)}
        choice = {}
        for x, y in near:
            if (want == x).sum() < 10:
                choice[x] = min(choice.get(x, (9e9, 0)), (round(abs(mean[x] - mean[y]), 9), y))
        if not choice:
            break
        root = {k: k for k in mean}
        for x, (_, y) in choice.items():
            p, q = sorted((root[x], root[y]))
            root = {k: p if v == q else v for k, v in root.items()}
        want = np.vectorize(root.get)(want)
    of = {r["node"]: r["label"] for r in names.collect()}
    assert np.array_equal(np.vectorize(of.get)(label), want) and nodes.count() == len(np.unique(want))


def test_stencil_in_blocks(spark, monkeypatch):
    cells = np.random.default_rng(5).integers(0, 99, (11, 14)).astype(float)
    want = {(r["row"], r["col"]): r["hood"] for r in G.stencil(image(spark, cells), "v", 2).collect()}
    monkeypatch.setattr(G, "BLOCK", 4)
    got = G.stencil(image(spark, cells), "v", 2).collect()
    assert len(got) == len(want) and {(r["row"], r["col"]): r["hood"] for r in got} == want


def test_mean_shift_does_not_depend_on_tiles(spark):
    cells = np.random.default_rng(7).integers(0, 9, (13, 17)).astype(float)
    from gridloom.operators import imagery

    one, *others = ({(r["row"], r["col"]): r["v"] for r in imagery.mean_shift(image(spark, cells), "v", side, 2, 3.0, 4).collect()} for side in (100, 3, 5))
    assert len(one) == cells.size and all(o == pytest.approx(one) for o in others)


def test_boxes_and_intervals_of_very_different_sizes(spark):
    rng = np.random.default_rng(8)
    size = lambda: 2.0 ** float(rng.integers(-3, 22))
    a, b = ([(k, float(x), float(x) + size()) for k, x in enumerate(rng.integers(-1000, 1000, 40))] for _ in range(2))
    got = [tuple(r) for r in joins.intervals_overlapping(spark.createDataFrame(a, "lid int, l0 double, l1 double"), spark.createDataFrame(b, "rid int, r0 double, r1 double"), 1.0).select("lid", "rid").collect()]
    assert sorted(got) == sorted((i, j) for i, p, q in a for j, u, v in b if p <= v and u <= q)
    box = lambda rows, n: spark.createDataFrame([(k, (p, q, p / 2, p / 2 + size())) for k, p, q in rows], f"{n}id int, {n}box struct<minx: double, maxx: double, miny: double, maxy: double>")
    f, g = box(a, "l"), box(b, "r")
    got = [tuple(r) for r in joins.envelopes_meeting(f, g, 1.0).select("lid", "rid").collect()]
    want = [(x["lid"], y["rid"]) for x in f.collect() for y in g.collect() if x["lbox"]["minx"] <= y["rbox"]["maxx"] and y["rbox"]["minx"] <= x["lbox"]["maxx"] and x["lbox"]["miny"] <= y["rbox"]["maxy"] and y["rbox"]["miny"] <= x["lbox"]["maxy"]]
    assert sorted(got) == sorted(want)


def test_nearest_model_in_blocks(spark, monkeypatch):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    models = learning.centroids(e, "label", "embedding")
    want = sorted(map(tuple, learning.nearest(e, "embedding", models, "label").select("vec_id", "nearest", "distance").collect()))
    monkeypatch.setattr(learning, "MODELS", 3)
    assert sorted(map(tuple, learning.nearest(e, "embedding", models, "label").select("vec_id", "nearest", "distance").collect())) == want


def test_watershed_keeps_the_first_edge_beyond(spark):
    e = spark.createDataFrame([(1, k, float(h), 0.0) for k, h in enumerate((1, 5, 6, 7))], "segment int, neighbour int, height double, low double")
    assert [r["height"] for r in graph.pruned_edges(e, 4.0).orderBy("height").collect()] == [1.0, 5.0]


def test_relabel_identity_and_sampling(spark):
    f = spark.createDataFrame([(k % 3, k) for k in range(30)], "lab int, k int")
    none = spark.createDataFrame([], "old int, new int")
    assert sorted(map(tuple, joins.relabelled(f, "lab", none).select("lab", "k").collect())) == sorted(map(tuple, f.collect()))
    assert [r["count"] for r in sampling.per_class(f, "lab", F.col("k"), 4).groupBy("lab").count().collect()] == [4, 4, 4]


def test_gaussian_classes_are_told_apart(spark):
    rng = np.random.default_rng(3)
    rows = [([float(a + 6 * k), float(b)], k) for k in (0, 1) for a, b in rng.normal(size=(60, 2))]
    f = spark.createDataFrame(rows, "f array<double>, lab int")
    assert learning.normal_bayes(f, "f", "lab").where("predicted <> lab").count() <= 2
    assert learning.virtual_dimension(f, "f") >= 1
    assert learning.train_som(np.array([r[0] for r in rows]), 2, 2).shape == (4, 2)


def test_normal_bayes_query_uses_whole_vectors(spark):
    import numpy as np

    from gridloom.plans import learning

    from .conftest import SF

    rows = spark.read.parquet(f"{SF}/embeddings.parquet").where("label is not null").collect()
    x, y = np.array([r["embedding"] for r in rows], float), np.array([r["label"] for r in rows])
    scores = []
    for k in sorted(set(y)):
        own = x[y == k]
        c, d = np.cov(own.T, bias=True) + 1e-6 * np.eye(x.shape[1]), x - own.mean(0)
        scores.append(np.log(len(own) / len(x)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ni,ij,nj->n", d, np.linalg.inv(c), d))
    want = np.array(sorted(set(y)))[np.argmax(scores, 0)]
    got = {r["vec_id"]: r["predicted"] for r in learning.normal_bayes_classifier(spark, SF).collect()}
    assert got == {r["vec_id"]: int(k) for r, k in zip(rows, want, strict=True)}
