"""Gridded observations: tables (row, col, value columns) and what their neighbourhoods give.

Neighbourhoods are built by two window passes, along rows and then along columns, so that a stencil of any radius costs two
shuffles of the grid and no join. Rows and columns are cut into blocks that hold a margin of their neighbours, so a grid
of any height or width is worked on in pieces of bounded length. Beyond the border the border's own cell is repeated.
Grids are dense; ``filled`` makes them so.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import arrays


#: Cells of a row or column that one window sorts, besides the margins.
BLOCK = 1024


def along(grid: DataFrame, place: str, radius: int, columns, *key: str) -> DataFrame:
    """``grid`` with what ``columns(window)`` (a dict) makes of each cell's line, block by block with a margin of ``radius`` cells.

    The window runs along ``place`` within ``key``; what it makes of a cell must not depend on cells further off than the radius.
    """
    if not 0 <= radius <= BLOCK:
        raise ValueError(f"radius must lie in 0..{BLOCK}")
    block = lambda d: F.floor((F.col(place) + F.lit(d)) / F.lit(BLOCK))
    spread = grid.withColumn("_block", F.explode(F.array_distinct(F.array(block(0), block(-radius), block(radius)))))
    w = Window.partitionBy(*key, "_block").orderBy(place)
    return spread.withColumns(columns(w)).where(F.col("_block") == block(0)).drop("_block")


def stencil(grid: DataFrame, value: str, radius: int = 1, name: str = "hood", key: tuple[str, ...] = ()) -> DataFrame:
    """``grid`` with an array of the (2 radius + 1)^2 cells around each cell, row by row from the upper left."""
    whole = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def line(x: Column, w) -> list[Column]:
        first, last = F.first(x).over(whole(w)), F.last(x).over(whole(w))
        back = [F.coalesce(F.lag(x, k).over(w), first) for k in range(radius, 0, -1)]
        return [*back, x, *(F.coalesce(F.lead(x, k).over(w), last) for k in range(1, radius + 1))]

    one = along(grid, "col", radius, lambda w: {"_line": F.array(*line(F.col(value), w))}, *key, "row")
    return along(one, "row", radius, lambda w: {name: F.concat(*line(F.col("_line"), w))}, *key, "col").drop("_line")


def hood_mean(hood: Column) -> Column:
    return arrays.total(hood) / F.size(hood)


def hood_variance(hood: Column) -> Column:
    """Sample variance."""
    n, s = F.size(hood), arrays.total(hood)
    return (F.aggregate(hood, F.lit(0.0), lambda a, x: a + x * x) - s * s / n) / (n - 1)


def hood_median(hood: Column) -> Column:
    """The element in the middle of the sorted neighbourhood."""
    return F.element_at(F.sort_array(hood), (F.floor(F.size(hood) / 2) + 1).cast("int"))


def hood_sum_of_squares(hood: Column) -> Column:
    return F.aggregate(hood, F.lit(0.0), lambda a, x: a + x * x)


def convolve(hood: Column, kernel: list[float]) -> Column:
    """Weighted sum of a neighbourhood; unrolled, zero weights cost nothing."""
    terms = [hood[k] * F.lit(float(w)) for k, w in enumerate(kernel) if w]
    out = terms[0] if terms else F.lit(0.0)
    for t in terms[1:]:
        out = out + t
    return out


# Kernels of the two Sobel derivatives.
SOBEL_X = [-1, 0, 1, -2, 0, 2, -1, 0, 1]
SOBEL_Y = [-1, -2, -1, 0, 0, 0, 1, 2, 1]


def gaussian_weights(radius: int, sigma: float) -> list[float]:
    raw = [math.exp(-(i * i + j * j) / (2 * sigma * sigma)) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1)]
    return [w / sum(raw) for w in raw]


def gabor_weights(radius: int, a: float, b: float, theta: float, u0: float, v0: float, phi: float) -> list[float]:
    """A rotated Gaussian envelope times a cosine wave; angles in degrees."""
    t, out = math.radians(theta), []
    for y in range(-radius, radius + 1):
        for x in range(-radius, radius + 1):
            xr, yr = x * math.cos(t) + y * math.sin(t), y * math.cos(t) - x * math.sin(t)
            out.append(math.exp(-math.pi * ((a * xr) ** 2 + (b * yr) ** 2)) * math.cos(2 * math.pi * (u0 * x + v0 * y) + math.radians(phi)))
    return out


def majority(hood: Column) -> Column:
    """The commonest value of a neighbourhood, the smallest of equally common ones."""
    counted = F.transform(F.array_distinct(hood), lambda v: F.struct((-F.size(F.filter(hood, lambda x: x == v))).alias("n"), v.alias("v")))
    return F.array_min(counted)["v"]


def despeckle_lee(hood: Column, looks: float) -> Column:
    """Local statistics filter: the nearer the local variation is to that of speckle alone, the nearer to the local mean."""
    m, v, centre = hood_mean(hood), hood_variance(hood), hood[F.floor(F.size(hood) / 2).cast("int")]
    speckle = m * m / looks
    gain = F.when(v <= 0, 0.0).otherwise(F.greatest(F.lit(0.0), (v - speckle) / (v * (1 + 1 / looks))))
    return m + gain * (centre - m)


def _local(hood: Column, looks: float) -> tuple[Column, Column, Column, Column]:
    """Mean, centre, squared local variation and that of speckle alone."""
    m, v = hood_mean(hood), hood_variance(hood)
    return m, hood[F.floor(F.size(hood) / 2).cast("int")], F.when(m == 0, 0.0).otherwise(v / F.when(m == 0, 1.0).otherwise(m * m)), F.lit(1.0 / looks)


def despeckle_kuan(hood: Column, looks: float) -> Column:
    """Linear mix of centre and local mean for multiplicative noise."""
    m, x, c, u = _local(hood, looks)
    w = F.when(c <= u, 0.0).otherwise((1 - u / F.when(c <= u, 1.0).otherwise(c)) / (1 + u))
    return m + w * (x - m)


def despeckle_gamma_map(hood: Column, looks: float) -> Column:
    """The likeliest reflectivity under gamma statistics; flat places give the mean, strong scatterers stay."""
    m, x, c, u = _local(hood, looks)
    a = (1 + u) / F.when(c <= u, 1.0).otherwise(c - u)
    b = a - looks - 1
    best = (b * m + F.sqrt(F.greatest(F.lit(0.0), m * m * b * b + 4 * a * looks * m * x))) / (2 * a)
    return F.when(c <= u, m).when(c >= 2 * u, x).otherwise(best)


def despeckle_frost(hood: Column, radius: int, damping: float) -> Column:
    """Mean with weights that fall with the distance, the faster the more the place varies."""
    m, _, c, _ = _local(hood, 1.0)
    far = [math.hypot(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1)]
    w = [F.exp(F.lit(-damping * d) * c) for d in far]
    total, sums = w[0], w[0] * hood[0]
    for k in range(1, len(w)):
        total, sums = total + w[k], sums + w[k] * hood[k]
    return sums / total


def touzi_edge(hood: Column) -> Column:
    """One minus the least ratio of means on both sides of the centre, over the four directions of a 3 x 3 neighbourhood."""
    sides = [((0, 1, 2), (6, 7, 8)), ((0, 3, 6), (2, 5, 8)), ((0, 1, 3), (5, 7, 8)), ((1, 2, 5), (3, 6, 7))]

    def ratio(a: tuple[int, ...], b: tuple[int, ...]) -> Column:
        p, q = (sum((hood[k] for k in x), F.lit(0.0)) for x in (a, b))
        return F.when((p == 0) | (q == 0), F.when(p == q, 1.0).otherwise(0.0)).otherwise(F.least(p / F.when(q == 0, 1.0).otherwise(q), q / F.when(p == 0, 1.0).otherwise(p)))

    return 1 - F.least(*(ratio(a, b) for a, b in sides))


# A sharpening kernel and a hat.
SHARPEN = [-1, -1, -1, -1, 9, -1, -1, -1, -1]
HAT = [0, -1, 0, -1, 4, -1, 0, -1, 0]


def diffused(grid: DataFrame, value: str, rounds: int, step: float, conductance: float) -> DataFrame:
    """Anisotropic diffusion: each round moves a cell to its four neighbours, the less the more they differ."""
    for _ in range(rounds):
        h = F.col("_hood")
        flow = F.lit(0.0)
        for k in (1, 3, 5, 7):
            d = h[k] - h[4]
            flow = flow + F.exp(-(d / conductance) * (d / conductance)) * d
        grid = stencil(grid, value, name="_hood").withColumn(value, h[4] + F.lit(step) * flow).drop("_hood")
    return grid


def opened(grid: DataFrame, value: str, radius: int, name: str) -> DataFrame:
    """Grey opening by a square: the largest of the smallest values around."""
    low = stencil(grid, value, radius, "_hood").withColumn("_low", F.array_min("_hood")).drop("_hood")
    return stencil(low, "_low", radius, "_hood").withColumn(name, F.array_max("_hood")).drop("_hood", "_low")


def structural_features(hood: Column, radius: int, threshold: float) -> Column:
    """How far cells stay within the threshold of the centre along four lines: longest, shortest, and mean length."""
    side = 2 * radius + 1
    at = lambda i, j: hood[(radius + i) * side + radius + j]
    lengths = []
    for i, j in ((0, 1), (1, 0), (1, 1), (1, -1)):
        reach = F.lit(0)
        for sign in (1, -1):
            run = F.lit(radius)
            for k in range(radius, 0, -1):
                run = F.when(F.abs(at(sign * i * k, sign * j * k) - at(0, 0)) > threshold, k - 1).otherwise(run)
            reach = reach + run
        lengths.append(reach)
    return F.struct(F.greatest(*lengths).alias("longest"), F.least(*lengths).alias("shortest"), (sum(lengths, F.lit(0)) / 4).alias("mean"))


def haar(grid: DataFrame, value: str) -> DataFrame:
    """One level of the Haar transform: mean and three differences of each 2 x 2 block; odd last rows and columns go without."""
    r, c = F.col("row") % 2, F.col("col") % 2
    sign = lambda *odd: F.sum(F.when(sum(odd, F.lit(0)) % 2 == 0, F.col(value)).otherwise(-F.col(value))) / 2
    block = grid.groupBy(F.expr("cast(row div 2 as int)").alias("row"), F.expr("cast(col div 2 as int)").alias("col"))
    return block.agg(F.count("*").alias("_n"), sign().alias("ll"), sign(c).alias("lh"), sign(r).alias("hl"), sign(r, c).alias("hh")).where("_n = 4").drop("_n")


def contour_points(grid: DataFrame, value: str, level: float) -> DataFrame:
    """Where a level crosses between neighbouring cells: (x, y) by linear interpolation, x along columns."""
    v = F.col(value)

    def crossing(place: str, key: str) -> DataFrame:
        nxt = along(grid, place, 1, lambda w: {"_next": F.lead(value).over(w)}, key)
        hit = nxt.where((v < level) != (F.col("_next") < level))
        at = F.col(place) + (F.lit(level) - v) / (F.col("_next") - v)
        return hit.select((at if place == "col" else F.col("col").cast("double")).alias("x"), (at if place == "row" else F.col("row").cast("double")).alias("y"))

    return crossing("col", "row").unionByName(crossing("row", "col"))


def label_runs(grid: DataFrame, label: str) -> DataFrame:
    """Runs of equal labels along rows: (label, row, col, length). Runs that a block's border cuts are joined by their ends."""
    step = along(grid, "col", 1, lambda w: {"_opens": F.when(F.lag(label).over(w) == F.col(label), 0).otherwise(1)}, "row")
    starts = step.where("_opens = 1").select(F.col(label), "row", "col")
    ends = along(step, "col", 1, lambda w: {"_closes": F.when(F.lead(label).over(w) == F.col(label), 0).otherwise(1)}, "row").where("_closes = 1").select(F.col(label), "row", F.col("col").alias("_end"))
    # the k-th run of a label in a row has the k-th start and the k-th end
    order = lambda c: F.row_number().over(Window.partitionBy(label, "row").orderBy(c))
    both = starts.withColumn("_k", order("col")).join(ends.withColumn("_k", order("_end")), [label, "row", "_k"])
    return both.select(label, "row", "col", (F.col("_end") - F.col("col") + 1).cast("long").alias("length"))


def one_per_cell(objects: DataFrame, label: str, attribute: str, largest: bool = True) -> DataFrame:
    """Where several objects (label, row, col, attribute) hold a cell, the one with the greatest (or least) attribute, then the least label."""
    key = F.col(attribute) if largest else -F.col(attribute)
    best = objects.groupBy("row", "col").agg(F.max(F.struct(key.alias("a"), (-F.col(label)).alias("l"))).alias("_x"))
    return best.select("row", "col", (-F.col("_x.l")).alias(label))


def icm_round(grid: DataFrame, value: str, label: str, means: dict[int, float], beta: float) -> DataFrame:
    """One round of iterated conditional modes: each cell takes the label with the least squared error plus ``beta`` for every
    neighbour of another label, the least of equal ones."""
    h = stencil(grid, label, name="_hood")
    options = []
    differs = lambda k: lambda x: x != k
    for k, m in sorted(means.items()):
        other = F.size(F.filter(F.col("_hood"), differs(k))) - F.when(F.col(label) != k, 1).otherwise(0)
        options.append(F.struct((F.pow(F.col(value) - F.lit(float(m)), 2) + F.lit(beta) * other).alias("e"), F.lit(k).alias("k")))
    return h.withColumn(label, F.array_min(F.array(*options))["k"]).drop("_hood")


def hessian_score(xx: Column, yy: Column, xy: Column, alpha: float) -> Column:
    """Determinant less alpha times the squared trace."""
    return xx * yy - xy * xy - F.lit(alpha) * (xx + yy) * (xx + yy)


def filled(grid: DataFrame, rows: int, cols: int, value: dict[str, float]) -> DataFrame:
    """All cells of rows x cols, missing ones with the given values; also pads a smaller grid."""
    spark: SparkSession = grid.sparkSession
    every = spark.range(rows * cols).select(F.expr(f"cast(id div {cols} as int)").alias("row"), (F.col("id") % cols).cast("int").alias("col"))
    return every.join(grid, ["row", "col"], "left").na.fill(value)


def wrapped(grid: DataFrame, rows: int, cols: int, to_rows: int, to_cols: int) -> DataFrame:
    """A larger grid that repeats the rows x cols one: every place takes the cell of its remainders."""
    spark: SparkSession = grid.sparkSession
    every = spark.range(to_rows * to_cols).select(F.expr(f"cast(id div {to_cols} as int)").alias("_row"), (F.col("id") % to_cols).cast("int").alias("_col"))
    every = every.withColumn("row", F.col("_row") % max(1, rows)).withColumn("col", F.col("_col") % max(1, cols))
    return every.join(grid, ["row", "col"]).drop("row", "col").withColumnsRenamed({"_row": "row", "_col": "col"})


def crop(grid: DataFrame, top: int, left: int, rows: int, cols: int) -> DataFrame:
    """The region, with places counted from its corner."""
    inside = F.col("row").between(top, top + rows - 1) & F.col("col").between(left, left + cols - 1)
    return grid.where(inside).withColumn("row", F.col("row") - top).withColumn("col", F.col("col") - left)


def pyramid(grid: DataFrame, value: str, levels: int) -> DataFrame:
    """Means of 2^k x 2^k cells for each level k: (level, row, col, value), in one pass over exploded levels."""
    each = grid.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(levels))))
    side = F.pow(F.lit(2), F.col("level"))
    return each.groupBy("level", F.floor(F.col("row") / side).cast("int").alias("row"), F.floor(F.col("col") / side).cast("int").alias("col")).agg(F.avg(value).alias(value))


def stacked(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Grids side by side on equal cells; column names must differ."""
    for o in others:
        first = first.join(o, ["row", "col"])
    return first


def summed(*grids: DataFrame) -> DataFrame:
    """Sum of grids (row, col, bands array), band by band, by cell; a cell may lack some of the grids."""
    out = grids[0]
    for g in grids[1:]:
        out = out.unionByName(g)
    return out.select("row", "col", F.posexplode("bands").alias("band", "v")).groupBy("row", "col", "band").agg(F.sum("v").alias("v"))


def mosaic(*grids: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """Overlapping grids as one: the mean by cell, weighted where a weight is named; the first grid's cell otherwise counts alike."""
    out = grids[0]
    for g in grids[1:]:
        out = out.unionByName(g)
    if weight is None:
        return out.groupBy("row", "col").agg(F.avg(value).alias(value), F.count(value).alias("n"))
    w = F.sum(weight)
    return out.groupBy("row", "col").agg(F.when(w != 0, F.sum(F.col(value) * F.col(weight)) / w).alias(value), F.count(value).alias("n"))


def fused_tiles(tiles: DataFrame, tile_rows: int, tile_cols: int) -> DataFrame:
    """Tiles (tile_row, tile_col, row, col, ...) laid side by side."""
    out = tiles.withColumn("row", F.col("tile_row") * tile_rows + F.col("row")).withColumn("col", F.col("tile_col") * tile_cols + F.col("col"))
    return out.drop("tile_row", "tile_col")


def rescaled(grid: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Linear from the column's own range to low..high; a constant column becomes low."""
    span = grid.agg(F.min(value).alias("_a"), F.max(value).alias("_b"))
    x = F.when(F.col("_b") == F.col("_a"), F.lit(low)).otherwise((F.col(value) - F.col("_a")) / (F.col("_b") - F.col("_a")) * (high - low) + low)
    return grid.crossJoin(F.broadcast(span)).withColumn(value, x).drop("_a", "_b")  # one row is broadcast


def cooccurrence(grid: DataFrame, value: str, bins: int, low: float, high: float, d_row: int = 0, d_col: int = 1) -> DataFrame:
    """Symmetric grey-level co-occurrence ``(i, j, n)`` at an offset along a row (d_row 0) or column."""
    binned = grid.withColumn("b", F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((F.col(value) - low) / (high - low) * bins))).cast("int"))
    w = Window.partitionBy("row").orderBy("col") if d_row == 0 else Window.partitionBy("col").orderBy("row")
    pairs = binned.withColumn("c", F.lead("b", d_col if d_row == 0 else d_row).over(w)).where("c is not null")
    both = pairs.select(F.explode(F.array(F.struct(F.col("b").alias("i"), F.col("c").alias("j")), F.struct(F.col("c").alias("i"), F.col("b").alias("j")))).alias("p"))
    return both.groupBy("p.i", "p.j").agg(F.count("*").alias("n"))


def texture(pairs: DataFrame) -> DataFrame:
    """Energy, entropy, contrast, homogeneity and correlation of a co-occurrence table."""
    total = pairs.agg(F.sum("n").alias("t"))
    p = pairs.crossJoin(F.broadcast(total)).select("i", "j", (F.col("n") / F.col("t")).alias("p"))  # one row is broadcast
    m = p.agg(F.sum(F.col("i") * F.col("p")).alias("m"), F.sum(F.col("i") * F.col("i") * F.col("p")).alias("q"))
    p = p.crossJoin(F.broadcast(m))
    d = F.col("i") - F.col("j")
    spread = F.first(F.col("q") - F.col("m") * F.col("m"))
    return p.agg(
        F.sum(F.col("p") * F.col("p")).alias("energy"),
        (-F.sum(F.col("p") * F.log2("p"))).alias("entropy"),
        F.sum(d * d * F.col("p")).alias("contrast"),
        F.sum(F.col("p") / (1 + d * d)).alias("homogeneity"),
        F.when(spread > 0, F.sum((F.col("i") - F.col("m")) * (F.col("j") - F.col("m")) * F.col("p")) / spread).otherwise(0.0).alias("correlation"),
    )
