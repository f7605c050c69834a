"""Operators on grids beyond single neighbourhoods: fusion, resampling, matching, filters over tiles, changes, vectors."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrays
from . import grid as G


def pansharpened(pan: DataFrame, colour: DataFrame, value: str, band: str, radius: int = 1) -> DataFrame:
    """A coarse band on the fine grid, scaled by the fine value over its local mean; null over a zero mean."""
    m = G.hood_mean(F.col("hood"))
    sharp = G.stencil(pan, value, radius).withColumn("_m", m).join(colour.select("row", "col", band), ["row", "col"])
    return sharp.select("row", "col", F.when(F.col("_m") == 0, None).otherwise(F.col(band) * F.col(value) / F.col("_m")).alias(band))


def resampled(grid: DataFrame, value: str, rows: int, cols: int, affine: tuple[float, float, float, float, float, float], missing: float = 0.0) -> DataFrame:
    """Nearest cells under an affine map: out (row, col) takes (a row + b col + c, d row + e col + f); beyond the grid, ``missing``."""
    a, b, c, d, e, f = affine
    out = grid.sparkSession.range(rows * cols).select(F.expr(f"cast(id div {cols} as int)").alias("row"), (F.col("id") % cols).cast("int").alias("col"))
    near = lambda p, q, r: F.floor(F.lit(float(p)) * F.col("row") + F.lit(float(q)) * F.col("col") + F.lit(float(r)) + 0.5).cast("int")
    out = out.withColumn("_r", near(a, b, c)).withColumn("_c", near(d, e, f))
    source = grid.select(F.col("row").alias("_r"), F.col("col").alias("_c"), value)
    return out.join(source, ["_r", "_c"], "left").select("row", "col", F.coalesce(value, F.lit(missing)).alias(value))


def disparity(left: DataFrame, right: DataFrame, value: str, reach: int) -> DataFrame:
    """Column shift of the best matching 3 x 3 block by summed squares, ties to the smallest shift: (row, col, shift, cost).

    One stencil a grid; the candidates are neighbours along the row, so no join is made. Shifts that leave the grid don't count.
    """
    both = left.select("row", "col", F.col(value).alias("_a")).join(right.select("row", "col", F.col(value).alias("_b")), ["row", "col"])
    both = G.stencil(G.stencil(both, "_a", name="_ha"), "_b", name="_hb")
    cost = lambda other: arrays.total(F.zip_with("_ha", other, lambda x, y: (x - y) * (x - y)))

    def best(w):
        options = []
        for k in range(-reach, reach + 1):
            other = F.lead("_hb", k).over(w) if k > 0 else F.lag("_hb", -k).over(w) if k < 0 else F.col("_hb")
            options.append(F.struct(cost(other).alias("cost"), F.lit(k).alias("shift")))
        return {"_o": F.array_min(F.filter(F.array(*options), lambda x: x["cost"].isNotNull()))}

    return G.along(both, "col", reach, best, "row").select("row", "col", F.col("_o.shift").alias("shift"), F.col("_o.cost").alias("cost"))


def with_no_data(frame: DataFrame, value: str, marker: float, new: float | None = None) -> DataFrame:
    """``valid`` (1 or 0) beside a value; markers and NaN become null, or ``new``."""
    bad = (F.col(value) == marker) | F.isnan(F.col(value).cast("double")) | F.col(value).isNull()
    return frame.withColumn("valid", F.when(bad, 0).otherwise(1)).withColumn(value, F.when(bad, F.lit(new)).otherwise(F.col(value)))


def equalised(frame: DataFrame, value: str, low: float, high: float, bins: int, most: int) -> DataFrame:
    """Histogram equalisation to 0..most; the table of bins is what is joined."""
    from .stats import histogram

    b = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((F.col(value) - low) / (high - low) * bins))).cast("int")
    up = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    cdf = histogram(frame, value, low, high, bins).withColumn("_c", F.sum("freq").over(up) / F.sum("freq").over(Window.partitionBy()))
    lut = F.broadcast(cdf.select(F.col("bin").alias("_bin"), F.round(F.col("_c") * most).cast("int").alias("equalised")))  # ``bins`` rows
    return frame.withColumn("_bin", b).join(lut, "_bin").drop("_bin")


def linear_unmixing(features: Column, endmembers: np.ndarray) -> list[Column]:
    """Least-squares abundances of (members, dimensions) spectra: dot products with the pseudo-inverse."""
    return [arrays.dot(features, F.array(*[F.lit(float(x)) for x in row])) for row in np.linalg.pinv(endmembers.T)]


def alteration(frame: DataFrame, a: list[str], b: list[str]) -> DataFrame:
    """Differences of canonical variates of two dates, the least correlated first (``mad_0`` ...), and their summed squares.

    Covariances are sums over all rows; only their (bands x bands) matrices reach the driver.
    """
    names = [*a, *b]
    n = len(names)
    row = frame.agg(*[F.covar_samp(x, y).alias(f"c{i}_{j}") for i, x in enumerate(names) for j, y in enumerate(names) if i <= j], *[F.avg(x).alias(f"m{i}") for i, x in enumerate(names)]).first()
    c = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(n)] for i in range(n)])
    k = len(a)
    root = lambda m: np.linalg.inv(np.linalg.cholesky(m + 1e-12 * np.eye(len(m))))
    ra, rb = root(c[:k, :k]), root(c[k:, k:])
    u, s, vt = np.linalg.svd(ra @ c[:k, k:] @ rb.T)
    order = np.argsort(s)
    wa, wb = (u.T @ ra)[order], (vt @ rb)[order]
    flip = np.sign(wa[np.arange(len(wa)), np.abs(wa).argmax(1)])
    wa, wb = wa * flip[:, None], wb * flip[:, None]
    centred = [F.col(x) - F.lit(float(row[f"m{i}"])) for i, x in enumerate(names)]
    mix = lambda w, cs: sum((F.lit(float(x)) * y for x, y in zip(w, cs, strict=True)), F.lit(0.0))
    out = frame
    for i in range(len(wa)):
        out = out.withColumn(f"mad_{i}", mix(wa[i], centred[:k]) - mix(wb[i], centred[k:]))
    spread = [max(2 * (1 - x), 1e-12) for x in s[order]]
    return out.withColumn("chi2", sum((F.col(f"mad_{i}") * F.col(f"mad_{i}") / F.lit(float(v)) for i, v in enumerate(spread)), F.lit(0.0)))


def pauli(hh: tuple[Column, Column], hv: tuple[Column, Column], vv: tuple[Column, Column]) -> tuple[Column, Column, Column]:
    """Powers of the single-bounce, double-bounce and volume terms of a scattering matrix."""
    power = lambda re, im: re * re + im * im
    return power(hh[0] + vv[0], hh[1] + vv[1]) / 2, power(hh[0] - vv[0], hh[1] - vv[1]) / 2, 2 * power(*hv)


def shaded(gx: Column, gy: Column, azimuth: float = 315.0, altitude: float = 45.0) -> Column:
    """Light of a slope in 0..255 from its two derivatives."""
    zenith, a = np.radians(90 - altitude), np.radians(azimuth)
    slope, aspect = F.atan(F.sqrt(gx * gx + gy * gy)), F.atan2(gy, -gx)
    light = F.lit(float(np.cos(zenith))) * F.cos(slope) + F.lit(float(np.sin(zenith))) * F.sin(slope) * F.cos(F.lit(float(np.pi / 2 - a)) - aspect)
    return F.greatest(F.lit(0.0), light) * 255


def dempster_shafer(votes: DataFrame, key: str, label: str, mass: str) -> DataFrame:
    """Fused label of each key: a vote gives its mass to its label and the rest to all; the label with the greatest belief wins.

    For simple support functions the combined mass of a label alone is (1 - prod(1 - m of its votes)) * prod(1 - m of all others), so
    products by label and by key are enough. Masses must lie in [0, 1).
    """
    doubt = F.exp(F.sum(F.ln(1 - F.col(mass))))
    per = votes.groupBy(key, label).agg(doubt.alias("_own"))
    every = Window.partitionBy(key)
    all_of = F.exp(F.sum(F.ln("_own")).over(every))
    per = per.withColumn("_mass", (1 - F.col("_own")) * all_of / F.col("_own")).withColumn("_rest", all_of)
    per = per.withColumn("belief", F.col("_mass") / (F.sum("_mass").over(every) + F.col("_rest")))
    best = per.groupBy(key).agg(F.max(F.struct(F.round("belief", 9).alias("belief"), (-F.col(label)).alias("l"))).alias("_x"))
    return best.select(key, (-F.col("_x.l")).alias(label), F.col("_x.belief").alias("belief"))


def rasterised(cells: DataFrame, rings: DataFrame, side: float, background: int = 0) -> DataFrame:
    """The smallest zone whose ring holds a cell's centre, ``background`` elsewhere."""
    from .joins import points_in_rings

    points = cells.select("row", "col", (F.col("col") + 0.5).alias("x"), (F.col("row") + 0.5).alias("y"))
    inside = points_in_rings(points, rings, side).groupBy("row", "col").agg(F.min("zone").alias("zone"))
    return cells.select("row", "col").join(inside, ["row", "col"], "left").withColumn("zone", F.coalesce("zone", F.lit(background)))


def drawn_paths(paths: DataFrame, value: int = 255) -> DataFrame:
    """Cells that the segments of (path, seq, x, y) cross, burned with a value: each segment is walked in unit steps."""
    w = Window.partitionBy("path").orderBy("seq")
    s = paths.withColumn("_x", F.lead("x").over(w)).withColumn("_y", F.lead("y").over(w)).where("_x is not null")
    steps = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(F.col("_x") - F.col("x")), F.abs(F.col("_y") - F.col("y")))))
    s = s.withColumn("_n", steps).withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), steps.cast("long"))))
    at = lambda a, b: F.floor(F.col(a) + (F.col(b) - F.col(a)) * F.col("_k") / F.col("_n") + 0.5).cast("int")
    return s.select(at("y", "_y").alias("row"), at("x", "_x").alias("col")).distinct().withColumn("value", F.lit(value))


def moved(points: Column, angle: float, scale: float, dx: float, dy: float) -> Column:
    """A path or ring turned by degrees about the origin, scaled, and shifted."""
    c, s = float(np.cos(np.radians(angle)) * scale), float(np.sin(np.radians(angle)) * scale)
    return F.transform(points, lambda p: F.struct((F.lit(c) * p["x"] - F.lit(s) * p["y"] + F.lit(dx)).alias("x"), (F.lit(s) * p["x"] + F.lit(c) * p["y"] + F.lit(dy)).alias("y")))


def _kept(xy: np.ndarray, tolerance: float) -> np.ndarray:
    keep = np.zeros(len(xy), bool)
    keep[[0, -1]] = True
    stack = [(0, len(xy) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        d = xy[b] - xy[a]
        size = float(d @ d)
        t = np.clip(((xy[a + 1 : b] - xy[a]) @ d) / size, 0, 1) if size else np.zeros(b - a - 1)
        off = np.hypot(*(xy[a + 1 : b] - xy[a] - t[:, None] * d).T)
        k = int(off.argmax())
        if off[k] > tolerance:
            keep[a + 1 + k] = True
            stack += [(a, a + 1 + k), (a + 1 + k, b)]
    return keep


def simplified(paths: DataFrame, points: str, tolerance: float) -> DataFrame:
    """Douglas-Peucker on an array of points, path by path."""
    if tolerance < 0:
        raise ValueError("tolerance is negative")

    @F.pandas_udf("array<struct<x: double, y: double>>")
    def cut(column: pd.Series) -> pd.Series:
        def one(ps):
            xy = np.array([[p["x"], p["y"]] for p in ps], float).reshape(-1, 2)
            return [{"x": float(x), "y": float(y)} for x, y in (xy[_kept(xy, tolerance)] if len(xy) > 2 else xy)]

        return column.map(one)

    return paths.withColumn(points, cut(F.col(points)))


def mean_shift(cells: DataFrame, value: str, side: int, radius: int, bandwidth: float, rounds: int = 10) -> DataFrame:
    """Joint spatial-range smoothing: each cell's window moves to the mean place and value of the cells within ``radius``
    and ``bandwidth`` of it, ``rounds`` times, and the cell takes the value it ends at.

    Tiles of ``side`` cells have a margin that no window leaves, so the result doesn't depend on the tiles.
    """
    margin = radius * (rounds + 1)
    tiles = lambda c: F.sequence(F.floor((F.col(c) - margin) / side), F.floor((F.col(c) + margin) / side))
    spread = cells.select("row", "col", F.col(value).cast("double").alias(value)).withColumn("_tr", F.explode(tiles("row"))).withColumn("_tc", F.explode(tiles("col")))
    spread = spread.withColumn("_tr", F.col("_tr").cast("int")).withColumn("_tc", F.col("_tc").cast("int"))

    def smooth(pdf: pd.DataFrame) -> pd.DataFrame:
        r, c, v = pdf["row"].to_numpy(), pdf["col"].to_numpy(), pdf[value].to_numpy()
        own = (r // side == pdf["_tr"].iloc[0]) & (c // side == pdf["_tc"].iloc[0])
        if not own.any():
            return pd.DataFrame({"row": r[:0], "col": c[:0], value: v[:0]})
        top, left = r.min() - radius, c.min() - radius
        image = np.full((r.max() - top + 1 + radius, c.max() - left + 1 + radius), np.nan)
        image[r - top, c - left] = v
        y, x, mode = (r[own] - top).astype(float), (c[own] - left).astype(float), v[own].copy()
        for _ in range(rounds):
            at_y, at_x = np.floor(y + 0.5).astype(int), np.floor(x + 0.5).astype(int)
            sums, n = np.zeros((3, len(mode))), np.zeros(len(mode))
            for i in range(-radius, radius + 1):
                for j in range(-radius, radius + 1):
                    near = image[at_y + i, at_x + j]
                    ok = np.abs(near - mode) <= bandwidth
                    sums += np.where(ok, (at_y + i, at_x + j, np.nan_to_num(near)), 0)
                    n += ok
            y, x, mode = (np.where(n > 0, s / np.maximum(n, 1), old) for s, old in zip(sums, (y, x, mode), strict=True))
        return pd.DataFrame({"row": r[own], "col": c[own], value: mode})

    return spread.groupBy("_tr", "_tc").applyInPandas(smooth, f"row int, col int, {value} double")


def spectrum(cells: DataFrame, key: str, value: str) -> DataFrame:
    """Discrete Fourier transform of each image: (key, row, col, re, im). An image is one task's work."""

    def transform(pdf: pd.DataFrame) -> pd.DataFrame:
        image = np.zeros((pdf["row"].max() + 1, pdf["col"].max() + 1))
        image[pdf["row"], pdf["col"]] = pdf[value]
        f = np.fft.fft2(image)
        r, c = np.indices(f.shape)
        return pd.DataFrame({key: pdf[key].iloc[0], "row": r.ravel().astype("int32"), "col": c.ravel().astype("int32"), "re": f.real.ravel(), "im": f.imag.ravel()})

    return cells.select(key, "row", "col", value).groupBy(key).applyInPandas(transform, f"{key} {dict(cells.dtypes)[key]}, row int, col int, re double, im double")


def small_regions_merged(cells: DataFrame, label: str, value: str, least: int) -> DataFrame:
    """One round: regions below ``least`` cells take the label of the adjacent region with the nearest mean, ties to the smallest label."""
    stats = cells.groupBy(label).agg(F.count("*").alias("n"), F.avg(value).alias("m"))
    along, across = Window.partitionBy("row").orderBy("col"), Window.partitionBy("col").orderBy("row")
    pairs = cells.withColumn("_r", F.lead(label).over(along)).withColumn("_d", F.lead(label).over(across)).select(F.col(label).alias("a"), F.explode(F.array("_r", "_d")).alias("b")).where("b is not null and a <> b").distinct()
    pairs = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    side = lambda x: stats.select(F.col(label).alias(x), F.col("n").alias(f"{x}_n"), F.col("m").alias(f"{x}_m"))
    best = pairs.join(side("a"), "a").where(F.col("a_n") < least).join(side("b"), "b").groupBy("a").agg(F.min(F.struct(F.round(F.abs(F.col("a_m") - F.col("b_m")), 9).alias("d"), "b")).alias("_x"))
    to = best.select(F.col("a").alias(label), F.col("_x.b").alias("_new"))
    return cells.join(to, label, "left").withColumn(label, F.coalesce("_new", label)).drop("_new")
