"""Values between the nodes of a grid, histograms and matching of bands, membership of fuzzy classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interpolated(points: DataFrame, grid: DataFrame, value: str, key: str, spacing: float = 1.0, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """Bilinear value of ``grid (row, col, value)`` at each point (key, x, y): heights of a geoid, shifts of a datum.

    A point meets the four nodes around it by equality; points beyond the outer nodes are left out, and so are those by a missing node.
    """
    u, v = (F.col("x") - x0) / spacing, (F.col("y") - y0) / spacing
    at = points.select(key, (u - F.floor(u)).alias("_u"), (v - F.floor(v)).alias("_v"), F.floor(u).cast("int").alias("_c"), F.floor(v).cast("int").alias("_r"))
    corner = lambda i, j: F.struct((F.col("_r") + i).alias("row"), (F.col("_c") + j).alias("col"), ((F.col("_v") if i else 1 - F.col("_v")) * (F.col("_u") if j else 1 - F.col("_u"))).alias("w"))
    each = at.withColumn("_k", F.explode(F.array(corner(0, 0), corner(0, 1), corner(1, 0), corner(1, 1)))).select(key, "_k.*").where("w > 0")
    met = each.join(grid.select("row", "col", value), ["row", "col"], "left").groupBy(key).agg(F.sum(F.col("w") * F.col(value)).alias(value), F.sum(F.when(F.col(value).isNotNull(), F.col("w")).otherwise(0.0)).alias("_w"))
    return met.where(F.col("_w") > 1 - 1e-9).select(key, value)


def resampled_by_shifts(grid: DataFrame, value: str, shifts: DataFrame) -> DataFrame:
    """Each cell of ``shifts (row, col, dr, dc)`` takes the bilinear value of the grid at its shifted place."""
    points = shifts.select(F.struct("row", "col").alias("_at"), (F.col("col") + F.col("dc")).alias("x"), (F.col("row") + F.col("dr")).alias("y"))
    return interpolated(points, grid, value, "_at").select("_at.row", "_at.col", value)


def band_histograms(frame: DataFrame, bands: list[str], low: float, high: float, bins: int) -> DataFrame:
    """``band, bin, freq`` of all bands in one pass; values beyond the range count in the outer bins, empty bins have no row."""
    place = lambda c: F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((F.col(c) - low) / (high - low) * bins))).cast("int")
    each = frame.select(F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.when(F.col(b).isNotNull(), place(b)).alias("bin")) for b in bands])).alias("x"))
    return each.where("x.bin is not null").groupBy("x.band", "x.bin").agg(F.count("*").alias("freq"))


def brightness_matched(frame: DataFrame, value: str, mean: float, deviation: float) -> DataFrame:
    """A band scaled and shifted to a mean and deviation; a constant band becomes the mean."""
    s = frame.agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    out = F.when(F.coalesce(F.col("_s"), F.lit(0.0)) > 0, F.lit(mean) + (F.col(value) - F.col("_m")) * deviation / F.when(F.col("_s") > 0, F.col("_s"))).otherwise(F.lit(mean))
    return frame.crossJoin(F.broadcast(s)).withColumn(value, F.when(F.col(value).isNotNull(), out)).drop("_m", "_s")  # one row is broadcast


def membership(x: Column, a: float, b: float, c: float, d: float) -> Column:
    """Trapezoid: 0 up to a, rising to 1 at b, 1 up to c, falling to 0 at d."""
    up = F.when(F.lit(b > a), (x - a) / (b - a if b > a else 1)).otherwise(1.0)
    down = F.when(F.lit(d > c), (d - x) / (d - c if d > c else 1)).otherwise(1.0)
    return F.when((x < a) | (x > d), 0.0).when(x < b, up).when(x <= c, 1.0).otherwise(down)


def grown(cells: DataFrame, value: str, seeds: DataFrame, low: float, high: float, width: int) -> DataFrame:
    """Cells (row, col) with values in a range that neighbours in the range connect to a seed (row, col)."""
    from . import graph

    inside = cells.where(F.col(value).between(low, high)).select("row", "col", (F.col("row").cast("long") * width + F.col("col")).alias("node"))
    inside = graph.saved(inside)
    labels = graph.components(inside, graph.grid_edges(inside, F.lit(True), width))
    of = labels.join(inside, "node")
    chosen = of.join(seeds.select("row", "col"), ["row", "col"], "left_semi").select("label").distinct()
    return of.join(chosen, "label", "left_semi").select("row", "col")
