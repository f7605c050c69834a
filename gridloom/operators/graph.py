"""Region graphs: connected components, merging of adjacent regions, and pruning of edge lists."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _folder(frame: DataFrame) -> str:
    spark = frame.sparkSession
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(base or 'file://' + tempfile.mkdtemp(prefix='gridloom-')).rstrip('/')}/graph-{uuid.uuid4().hex}"


def dropped(*frames: DataFrame) -> None:
    """Deletes tables that ``saved`` has written and nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            if "/graph-" in path:
                _delete(spark, path)


def _delete(spark, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the context has ended; the cluster's own cleaning takes the folder
        pass


def saved(frame: DataFrame) -> DataFrame:
    """A table in the session's shared checkpoint folder, which cuts the lineage of a loop; it goes when the process ends."""
    path = _folder(frame)
    frame.write.parquet(path)
    atexit.register(_delete, frame.sparkSession, path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def grid_edges(cells: DataFrame, same: Column, width: int, eight: bool = False) -> DataFrame:
    """Links (a, b), a < b, of neighbouring cells for which ``same`` holds, with cells named row * width + col.

    ``same`` speaks of columns ``x.*`` and ``y.*`` of the two cells. Neighbours are met by equality on shifted places.
    """
    steps = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if eight else [])
    move = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in steps]))
    y = cells.alias("y")
    x = cells.withColumn("_m", move).withColumn("_row", F.col("row") + F.col("_m.r")).withColumn("_col", F.col("col") + F.col("_m.c")).alias("x")
    pairs = x.join(y, (F.col("x._row") == F.col("y.row")) & (F.col("x._col") == F.col("y.col"))).where(same)
    at = lambda s: F.col(f"{s}.row").cast("long") * width + F.col(f"{s}.col")
    return pairs.select(F.least(at("x"), at("y")).alias("a"), F.greatest(at("x"), at("y")).alias("b"))


#: Links that a task contracts at a time.
LINKS = 1_000_000


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links (a, b) with the smallest node that they connect it to."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    low = np.arange(len(nodes))
    while len(x):
        np.minimum.at(low, np.maximum(low[x], low[y]), np.minimum(low[x], low[y]))
        while (low[low] != low).any():
            low = low[low]
        apart = low[x] != low[y]
        x, y = x[apart], y[apart]
    return nodes, nodes[low]


def _contracted(batches):
    """``node, root`` of the links (a, b) of a task, LINKS of them at a time."""
    held: list[pa.RecordBatch] = []

    def made():
        a, b = (np.concatenate([x.column(k).to_numpy(zero_copy_only=False) for x in held]).astype(np.int64) for k in (0, 1))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _stars(a, b)], ["node", "root"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(x.num_rows for x in held) >= LINKS:
            yield made()
    if held:
        yield made()


def components(nodes: DataFrame, edges: DataFrame, longest: int = 100) -> DataFrame:
    """``node, label``: the smallest node that links reach.

    Each task first contracts a range of the links. Only roots that a node has from several of them are linked further: few where
    links join near names, as on a grid. Those hop along links and along labels (see ``_hopped``).
    """
    links = saved(edges.where("a is not null and b is not null").select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b")).where("a < b"))
    n = links.count()
    if not n:
        return nodes.select("node", F.col("node").alias("label"))
    sorted_ = links.repartitionByRange(1 + n // LINKS, "a", "b").sortWithinPartitions("a", "b") if n > LINKS else links.coalesce(1)
    roots = saved(sorted_.mapInArrow(_contracted, "node long, root long"))
    dropped(links)
    own = roots.groupBy("node").agg(F.min("root").alias("root"), F.max("root").alias("_most"))
    if n > LINKS:
        twice = own.where("root <> _most").select("node", F.col("root").alias("a"))
        across = saved(roots.join(twice, "node").where("root <> a").select("a", F.col("root").alias("b")).distinct())
        top = _hopped(across, longest)
        own = own.join(top.select(F.col("node").alias("root"), "label"), "root", "left").select("node", F.coalesce("label", "root").alias("root"))
        out = saved(nodes.select("node").join(own, "node", "left").select("node", F.coalesce("root", "node").alias("label")))
        dropped(across, top, roots)
        return out
    out = saved(nodes.select("node").join(own, "node", "left").select("node", F.coalesce("root", "node").alias("label")))
    dropped(roots)
    return out


def _hopped(edges: DataFrame, longest: int) -> DataFrame:
    """``node, label`` of the nodes of ``edges``. Labels hop along links and along labels, so the rounds grow with the logarithm of
    a component's diameter; each round is a table in the shared folder, and the round before it goes. LINKS or fewer are taken at once."""
    if edges.count() <= LINKS:
        return saved(edges.coalesce(1).mapInArrow(_contracted, "node long, root long").withColumnRenamed("root", "label"))
    both = saved(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = saved(both.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("label")))
    for _ in range(longest):
        low = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        new = labels.join(low, "node", "left").select("node", F.least("label", F.coalesce("low", "label")).alias("label"), F.col("label").alias("before"))
        of = new.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = saved(new.join(of, "label", "left").select("node", F.coalesce("next", "label").alias("label"), "before"))
        changed = new.where("label <> before").limit(1).count()
        dropped(labels)
        labels = new.drop("before")
        if not changed:
            dropped(both)
            return labels
    raise RuntimeError("components did not settle")


def pruned_edges(edges: DataFrame, saliency: float) -> DataFrame:
    """Of each segment's (segment, neighbour, height, low) edges, those up to and with the first that rises above low by more than the saliency."""
    w = Window.partitionBy("segment").orderBy("height", "neighbour")
    over = (F.col("height") - F.col("low") > saliency).cast("int")
    earlier = F.coalesce(F.sum(over).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return edges.withColumn("_n", earlier).where("_n = 0").drop("_n")


# Regions. A region has a ``node`` (its first cell), ``area``, ``perimeter``, the box ``r0, r1, c0, c1`` of its cells, and for each
# band k the sum ``s<k>`` and the sum of squares ``q<k>``. An edge (a, b), a < b, has the length ``boundary`` of the common border.


def cell_regions(cells: DataFrame, bands: list[str], width: int) -> tuple[DataFrame, DataFrame]:
    """Every cell as a region of its own, and the edges of cells that share a side."""
    one = lambda x: F.lit(x).cast("long")
    node = F.col("row").cast("long") * width + F.col("col")
    x = [F.col(b).cast("double") for b in bands]
    nodes = cells.select(node.alias("node"), one(1).alias("area"), one(4).alias("perimeter"), *(F.col(c).cast("long").alias(n) for c, n in (("row", "r0"), ("row", "r1"), ("col", "c0"), ("col", "c1"))), *(v.alias(f"s{k}") for k, v in enumerate(x)), *((v * v).alias(f"q{k}") for k, v in enumerate(x)))
    return nodes, grid_edges(cells, F.lit(True), width).withColumn("boundary", one(1))


def label_regions(cells: DataFrame, label: str, bands: list[str]) -> tuple[DataFrame, DataFrame]:
    """The regions of a labelled grid (``node`` is the label, a number) with their edges; perimeters include the grid's border."""
    x = [F.col(b).cast("double") for b in bands]
    nodes = cells.groupBy(F.col(label).cast("long").alias("node")).agg(F.count("*").alias("area"), *(f(F.col(c).cast("long")).alias(n) for f, c, n in ((F.min, "row", "r0"), (F.max, "row", "r1"), (F.min, "col", "c0"), (F.max, "col", "c1"))), *(F.sum(v).alias(f"s{k}") for k, v in enumerate(x)), *(F.sum(v * v).alias(f"q{k}") for k, v in enumerate(x)))
    side = cells.select("row", "col", F.col(label).cast("long").alias("l"))
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 1), (1, 0))]))
    other = side.select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.col("l").alias("m"))
    met = side.withColumn("_s", step).select("l", (F.col("row") + F.col("_s.i")).alias("_r"), (F.col("col") + F.col("_s.j")).alias("_c")).join(other, ["_r", "_c"])
    edges = met.where("l <> m").groupBy(F.least("l", "m").alias("a"), F.greatest("l", "m").alias("b")).agg(F.count("*").alias("boundary"))
    inner = met.where("l = m").groupBy(F.col("l").alias("node")).agg(F.count("*").alias("_inner"))
    nodes = nodes.join(inner, "node", "left").withColumn("perimeter", 4 * F.col("area") - 2 * F.coalesce("_inner", F.lit(0))).drop("_inner")
    return nodes, edges


def _bands(nodes: DataFrame) -> list[int]:
    return [k for k in range(len(nodes.columns)) if f"s{k}" in nodes.columns]


def _spread(s: Column, q: Column, n: Column) -> Column:
    """Standard deviation over n from a sum and a sum of squares."""
    return F.sqrt(F.greatest(F.lit(0.0), q / n - (s / n) * (s / n)))


def spring(bands: list[int]) -> Column:
    """Euclidean distance of two regions' means (columns ``x.*`` and ``y.*``)."""
    mean = lambda r, k: F.col(f"{r}.s{k}") / F.col(f"{r}.area")
    return F.sqrt(sum(((mean("x", k) - mean("y", k)) * (mean("x", k) - mean("y", k)) for k in bands), F.lit(0.0)))


def baatz(bands: list[int], colour_weight: float = 0.7, compactness_weight: float = 0.3) -> Column:
    """Growth of heterogeneity by Baatz and Schaepe: of the bands' deviations, and of compactness and smoothness of the outline."""
    n1, n2 = F.col("x.area"), F.col("y.area")
    n = n1 + n2
    colour = F.lit(0.0)
    for k in bands:
        (s1, q1), (s2, q2) = ((F.col(f"{r}.s{k}"), F.col(f"{r}.q{k}")) for r in "xy")
        colour = colour + n * _spread(s1 + s2, q1 + q2, n) - n1 * _spread(s1, q1, n1) - n2 * _spread(s2, q2, n2)
    l1, l2 = F.col("x.perimeter"), F.col("y.perimeter")
    l = l1 + l2 - 2 * F.col("boundary")
    box = lambda r0, r1, c0, c1: 2 * (r1 - r0 + 1 + c1 - c0 + 1)
    sides = [[F.col(f"{r}.{c}") for c in ("r0", "r1", "c0", "c1")] for r in "xy"]
    b1, b2 = (box(*s) for s in sides)
    b = box(*(f(p, q) for f, p, q in zip((F.least, F.greatest) * 2, *sides, strict=True)))
    compact = l * F.sqrt(n) - l1 * F.sqrt(n1) - l2 * F.sqrt(n2)
    smooth = n * l / b - n1 * l1 / b1 - n2 * l2 / b2
    return F.lit(colour_weight) * colour + F.lit(1 - colour_weight) * (F.lit(compactness_weight) * compact + F.lit(1 - compactness_weight) * smooth)


def full_lambda(bands: list[int]) -> Column:
    """The full lambda schedule: squared distance of means, weighted by the areas, over the length of the common border."""
    d = spring(bands)
    return F.col("x.area") * F.col("y.area") / (F.col("x.area") + F.col("y.area")) * d * d / F.col("boundary")


def _merged(nodes: DataFrame, edges: DataFrame, to: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Regions and edges after the regions ``old`` have become ``new``; borders inside a region go."""
    ks = _bands(nodes)
    at = lambda f, c: f.join(to.select(F.col("old").alias(c), F.col("new").alias("_new")), c, "left").withColumn(c, F.coalesce("_new", c)).drop("_new")
    inside = at(at(edges, "a"), "b")
    gone = inside.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("boundary").alias("_gone"))
    grown = at(nodes, "node").groupBy("node").agg(F.sum("area").alias("area"), F.sum("perimeter").alias("perimeter"), F.min("r0").alias("r0"), F.max("r1").alias("r1"), F.min("c0").alias("c0"), F.max("c1").alias("c1"), *(F.sum(f"{p}{k}").alias(f"{p}{k}") for p in "sq" for k in ks))
    grown = grown.join(gone, "node", "left").withColumn("perimeter", F.col("perimeter") - 2 * F.coalesce("_gone", F.lit(0))).drop("_gone")
    left = inside.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("boundary").alias("boundary"))
    return grown, left


def _mutual(nodes: DataFrame, edges: DataFrame, cost, threshold: float) -> DataFrame:
    """``old, new`` of the regions that are each other's cheapest neighbour below the threshold; the smaller name stays."""
    priced = edges.join(nodes.alias("x"), F.col("a") == F.col("x.node")).join(nodes.alias("y"), F.col("b") == F.col("y.node")).select("a", "b", F.round(cost(_bands(nodes)), 9).alias("cost"))
    both = priced.union(priced.select(F.col("b").alias("a"), F.col("a").alias("b"), "cost"))
    best = both.groupBy("a").agg(F.min(F.struct("cost", "b")).alias("m")).select("a", F.col("m.b").alias("b"), F.col("m.cost").alias("cost"))
    back = best.select(F.col("a").alias("b"), F.col("b").alias("a"))
    pairs = best.join(back, ["a", "b"]).where((F.col("a") < F.col("b")) & (F.col("cost") < threshold))
    return pairs.select(F.col("b").alias("old"), F.col("a").alias("new"))


def merge_round(nodes: DataFrame, edges: DataFrame, cost, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Merges every pair of regions that are each other's cheapest neighbour below the threshold.

    ``cost`` is one of ``spring``, ``baatz`` and ``full_lambda``. A merged region keeps the smaller name. Costs are compared
    to nine places and ties go to the smaller neighbour, so the round has one outcome.
    """
    return _merged(nodes, edges, _mutual(nodes, edges, cost, threshold))


#: Regions to a strip, and of the neighbouring strips that are simulated with it.
STRIP, MARGIN = 200_000, 150_000


def _nine_places(cost: np.ndarray) -> np.ndarray:
    """Rounded half up to nine places of the shortest decimal form, as Spark rounds."""
    v = cost * 1e9
    out = np.where(np.abs(v) < 2.0**52, np.rint(v) / 1e9, cost)
    for k in np.flatnonzero(np.abs(v - np.floor(v) - 0.5) < 1e-4 + np.abs(v) * 1e-15):
        out[k] = float(Decimal(repr(float(cost[k]))).quantize(Decimal("1e-9"), ROUND_HALF_UP))
    return out


def _spring_of(sums: list[np.ndarray], area: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros(len(a))
    for s in sums:
        d = s[a] / area[a] - s[b] / area[b]
        total = total + d * d
    return np.sqrt(total)


#: Costs that a strip can price itself, from the bands' sums and the areas.
_IN_STRIPS = {spring: _spring_of}


def _strip_rounds(left: pa.Table, right: pa.Table, own: tuple[int, int], price, threshold: float, most: int, names: list[str]) -> tuple[tuple[pa.Table, pa.Table], int, int]:
    """Rounds of mutual merging among a strip's regions and those of its margins, at most ``most``, while all of its own are certain.

    Regions whose edges lead out of what is here are unknown. A region that may choose or be chosen by an unknown one, or whose
    choice may, is unknown after that round; so what is known equals the whole grid's state. Returns the strip's own regions and
    edges, the number of rounds, and the last that merged any of its own.
    """
    left = left.sort_by("node")
    node = left["node"].to_numpy()
    v = {c: left[c].to_numpy().copy() for c in names}
    sums = [v[c] for c in names if c[0] == "s"]
    a, b, border = (right[c].to_numpy() for c in ("a", "b", "boundary"))
    ends = []
    known = np.ones(len(a), bool)
    for x in (a, b):
        at = np.minimum(np.searchsorted(node, x), len(node) - 1)
        ok = node[at] == x
        known &= ok
        ends.append((at, ok))
    bad = np.zeros(len(node), bool)
    for (at, ok), (_, other) in (ends, ends[::-1]):
        bad[at[ok & ~other]] = True
    a, b, border = ends[0][0][known], ends[1][0][known], border[known]
    n = len(node)
    core, alive = (node >= own[0]) & (node < own[1]), np.ones(n, bool)
    cost = _nine_places(price(sums, v["area"], a, b))

    def beside(bad):
        out = bad.copy()
        out[a[bad[b]]] = True
        out[b[bad[a]]] = True
        return out

    t = last = 0
    unsure = beside(bad)
    if (unsure & core).any():
        return _strip_tables(node, v, alive & core, a, b, border, names), -1, 0
    while t < most:
        # each region's cheapest known neighbour
        ok = ~(bad[a] | bad[b])
        src, dst, c = np.concatenate((a[ok], b[ok])), np.concatenate((b[ok], a[ok])), np.concatenate((cost[ok], cost[ok]))
        least = np.full(n, np.inf)
        np.minimum.at(least, src, c)
        tie = c == least[src]
        best = np.full(n, n)
        np.minimum.at(best, src[tie], dst[tie])
        cheap = np.flatnonzero((best < n) & (least < threshold))
        mutual = cheap[best[best[cheap]] == cheap]
        sure = ~unsure[mutual] & ~unsure[best[mutual]]
        open_ = unsure.copy()
        open_[mutual[~sure]] = True
        i = mutual[sure]
        i = i[i < best[i]]
        j = best[i]
        if not len(i) and not open_.any():
            t = most  # nothing is unknown and nothing merges any more
            break
        to = np.arange(n)
        to[j] = i
        hit = np.zeros(n, bool)
        hit[i] = hit[j] = True
        na, nb = to[a], to[b]
        after = open_.copy()
        after[na[open_[nb]]] = True
        after[nb[open_[na]]] = True
        live = alive.copy()
        live[j] = False
        if (after & core & live).any():
            break
        # the round holds: regions grow, edges of those that grew are joined and priced again
        if len(i):
            moved = hit[a] | hit[b]
            ma, mb, mm = np.minimum(na, nb)[moved], np.maximum(na, nb)[moved], border[moved]
            inside = ma == mb
            for c_ in names:
                if c_ in ("r0", "c0"):
                    v[c_][i] = np.minimum(v[c_][i], v[c_][j])
                elif c_ in ("r1", "c1"):
                    v[c_][i] = np.maximum(v[c_][i], v[c_][j])
                else:
                    v[c_][i] += v[c_][j]
            np.subtract.at(v["perimeter"], ma[inside], 2 * mm[inside])
            code, back = np.unique(ma[~inside] * n + mb[~inside], return_inverse=True)
            summed = np.zeros(len(code), border.dtype)
            np.add.at(summed, back, mm[~inside])
            fa, fb = code // n, code % n
            a, b, border = np.concatenate((a[~moved], fa)), np.concatenate((b[~moved], fb)), np.concatenate((border[~moved], summed))
            cost = np.concatenate((cost[~moved], _nine_places(price(sums, v["area"], fa, fb))))
            alive = live
        t += 1
        if core[i].any():
            last = t
        bad, unsure = open_, after
    return _strip_tables(node, v, alive & core, a, b, border, names), t, last


def _strip_tables(node, v, own, a, b, border, names) -> tuple[pa.Table, pa.Table]:
    kept = own[a]
    return pa.table({"node": node[own], **{c: v[c][own] for c in names}}), pa.table({"a": node[a[kept]], "b": node[b[kept]], "boundary": border[kept]})


def _in_strips(nodes: DataFrame, edges: DataFrame, price, threshold: float, most: int, states: bool) -> DataFrame:
    """Each strip's rows: its regions, its edges where ``states``, and one with the rounds it is certain of and the last that merged."""
    names = [c for c in nodes.columns if c != "node"]
    low, high, n = nodes.agg(F.min("node"), F.max("node"), F.count("*")).first()
    strips = -(-n // STRIP)
    width = -(-(high - low + 1) // strips)
    margin = min(width, -(-(high - low + 1) * MARGIN // n))
    strip = lambda x: F.expr(f"({x} - {low}) div {width}")

    def touched(x: str):
        at, within = strip(x), F.expr(f"({x} - {low}) % {width}")
        return F.array_compact(F.array(at, F.when((within < margin) & (at > 0), at - 1), F.when((within >= width - margin) & (at < strips - 1), at + 1)))

    kinds = {c: "double" if c[0] in "sq" else "long" for c in names}
    schema = ", ".join(["kind int", "node long", *(f"{c} {k}" for c, k in kinds.items()), "a long", "b long", "boundary long", "rounds long", "last long"])

    def one(key, left: pa.Table, right: pa.Table) -> pa.Table:
        s = key[0].as_py()
        (own, links), t, last = _strip_rounds(left, right, (low + s * width, low + (s + 1) * width), price, threshold, most, names)
        parts = [own.append_column("kind", pa.array(np.zeros(own.num_rows, np.int32))), pa.table({"kind": pa.array([2], pa.int32()), "rounds": [t], "last": [last]})]
        if states:
            parts.append(links.append_column("kind", pa.array(np.ones(links.num_rows, np.int32))))
        whole = pa.concat_tables(parts, promote_options="default")
        fields = [("kind", pa.int32()), ("node", pa.int64()), *((c, pa.float64() if k == "double" else pa.int64()) for c, k in kinds.items()), *((c, pa.int64()) for c in ("a", "b", "boundary", "rounds", "last"))]
        return pa.table({c: whole[c].cast(k) if c in whole.column_names else pa.nulls(whole.num_rows, k) for c, k in fields})

    left = nodes.withColumn("strip", F.explode(touched("node")))
    right = edges.withColumn("strip", F.explode(F.array_union(touched("a"), touched("b"))))
    return left.repartition(strips, "strip").groupBy("strip").cogroup(right.repartition(strips, "strip").groupBy("strip")).applyInArrow(one, schema)


def _even(nodes: DataFrame) -> bool:
    """Whether strips of names can be held by one task each, and no sum is unknown."""
    low, high, n = nodes.agg(F.min("node"), F.max("node"), F.count("*")).first()
    if not n:
        return False
    width = -(-(high - low + 1) // -(-n // STRIP))
    if nodes.groupBy(F.expr(f"(node - {low}) div {width}")).count().agg(F.max("count")).first()[0] > 4 * STRIP:
        return False
    odd = [F.col(c).isNull() for c in nodes.columns] + [F.isnan(c) | (F.abs(c) == float("inf")) for c in nodes.columns if c[0] in "sq"]
    return not nodes.where(reduce(Column.__or__, odd)).limit(1).count()


def merge_regions(nodes: DataFrame, edges: DataFrame, cost, threshold: float, rounds: int = 1000) -> DataFrame:
    """Rounds of mutual merging until no edge is cheap enough; raises if ``rounds`` don't suffice.

    Where the cost can be priced in strips of names with margins, each task goes as many rounds as its own regions can't feel what
    lies beyond; the result is that of rounds over the whole table. What doesn't settle so is carried on from the rounds that all
    strips are certain of, and a round that no strip is certain of is made by joins.
    """
    nodes, edges = saved(nodes), saved(edges)
    price, done = _IN_STRIPS.get(cost), 0
    while done < rounds:
        if price is not None and _even(nodes):
            kept = nodes.columns
            got = saved(_in_strips(nodes, edges, price, threshold, rounds - done, False))
            sure, last = got.where("kind = 2").agg(F.min("rounds"), F.max("last")).first()
            if sure > last:
                dropped(nodes, edges)
                return got.where("kind = 0").select(*kept)
            dropped(got)
            if sure > 0:
                got = saved(_in_strips(nodes, edges, price, threshold, sure, True))
                dropped(nodes, edges)
                nodes, edges = got.where("kind = 0").select(*kept), got.where("kind = 1").select("a", "b", "boundary")
                done += sure
                continue
        to = saved(_mutual(nodes, edges, cost, threshold))
        if not to.limit(1).count():
            return nodes
        before = nodes, edges, to
        nodes, edges = (saved(f) for f in _merged(nodes, edges, to))
        dropped(*before)
        done += 1
    raise RuntimeError(f"regions still merge after {rounds} rounds")


def small_regions_absorbed(nodes: DataFrame, edges: DataFrame, least: int, rounds: int = 100) -> tuple[DataFrame, DataFrame]:
    """``(nodes, names)`` when no region below ``least`` cells has a neighbour left; ``names (node, label)`` of all first regions.

    In each round every such region goes with the neighbour whose means are nearest (to nine places, ties to the smallest
    name); regions that choose each other in a ring or a row become one, with the smallest name.
    """
    names = nodes.select("node", F.col("node").alias("label"))
    for _ in range(rounds):
        small = nodes.where(F.col("area") < least)
        priced = edges.join(nodes.alias("x"), F.col("a") == F.col("x.node")).join(nodes.alias("y"), F.col("b") == F.col("y.node")).select("a", "b", F.round(spring(_bands(nodes)), 9).alias("cost"))
        both = priced.union(priced.select(F.col("b").alias("a"), F.col("a").alias("b"), "cost")).join(small.select(F.col("node").alias("a")), "a")
        links = saved(both.groupBy("a").agg(F.min(F.struct("cost", "b")).alias("m")).select("a", F.col("m.b").alias("b")))
        if not links.limit(1).count():
            return nodes, names
        ends = links.select("a").union(links.select("b")).distinct().withColumnRenamed("a", "node")
        to = components(ends, links).select(F.col("node").alias("old"), F.col("label").alias("new"))
        nodes, edges = (saved(f) for f in _merged(nodes, edges, to))
        names = saved(names.join(to, F.col("label") == F.col("old"), "left").select("node", F.coalesce("new", "label").alias("label")))
    raise RuntimeError(f"small regions are left after {rounds} rounds")
