"""Queries of colour spaces and value remaps, over colours made of part keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import colour
from . import query, table

_RGB = "c AS (SELECT p_partkey, (p_partkey * 37 % 256)::DOUBLE AS r, (p_partkey * 59 % 256)::DOUBLE AS g, (p_partkey * 83 % 256)::DOUBLE AS b FROM part), m AS (SELECT *, greatest(r, g, b) AS hi, least(r, g, b) AS lo, r + g + b AS t, sqrt((r - g) ** 2 + (r - b) * (g - b)) AS w FROM c)"


def _colours(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select("p_partkey", *((k * f % 256).alias(c) for c, f in (("r", 37), ("g", 59), ("b", 83))))


def _rgb():
    return tuple(F.col(c) for c in "rgb")


@query(f"""WITH {_RGB}, h AS (SELECT *, 60 * CASE WHEN hi = lo THEN 0 WHEN hi = r THEN (g - b) / (hi - lo) + CASE WHEN g < b THEN 6 ELSE 0 END WHEN hi = g THEN (b - r) / (hi - lo) + 2 ELSE (r - g) / (hi - lo) + 4 END AS h,
  CASE WHEN w = 0 THEN 0 ELSE degrees(acos(greatest(-1, least(1, ((r - g) + (r - b)) / 2 / w)))) END AS q FROM m)
SELECT p_partkey, round(h, 4) AS h, round(CASE WHEN hi = 0 THEN 0 ELSE (hi - lo) / hi END, 6) AS s, round(hi / 255, 6) AS v, round(CASE WHEN w <> 0 AND b > g THEN 360 - q ELSE q END, 4) AS hue, round(CASE WHEN t = 0 THEN 0 ELSE 1 - 3 * lo / t END, 6) AS sat, round(t / 3, 6) AS intensity,
  round(0.299 * r + 0.587 * g + 0.114 * b, 4) AS y, round(128 - 0.168736 * r - 0.331264 * g + 0.5 * b, 4) AS cb, round(128 + 0.5 * r - 0.418688 * g - 0.081312 * b, 4) AS cr, round((r + g + b) / 3, 4) AS grey FROM h""")
def colour_spaces(spark, sf):
    rgb = _rgb()
    columns = [*zip(colour.rgb_to_hsv(rgb), ("h", "s", "v"), (4, 6, 6), strict=True), *zip(colour.rgb_to_hsi(rgb), ("hue", "sat", "intensity"), (4, 6, 6), strict=True), *zip(colour.rgb_to_ycbcr(rgb), ("y", "cb", "cr"), (4, 4, 4), strict=True), (colour.grey(rgb), "grey", 4)]
    return _colours(spark, sf).select("p_partkey", *(F.round(c, n).alias(name) for c, name, n in columns))


@query(f"WITH {_RGB} SELECT p_partkey, " + ", ".join(f"{c}::BIGINT AS {s}_{c}" for s in ("hsv", "hsi", "ycc") for c in "rgb") + " FROM c")
def colour_round_trips(spark, sf):
    rgb = _rgb()
    back = {"hsv": colour.hsv_to_rgb(colour.rgb_to_hsv(rgb)), "hsi": colour.hsi_to_rgb(colour.rgb_to_hsi(rgb)), "ycc": colour.ycbcr_to_rgb(colour.rgb_to_ycbcr(rgb))}
    return _colours(spark, sf).select("p_partkey", *(F.round(x).cast("long").alias(f"{s}_{c}") for s, xs in back.items() for x, c in zip(xs, "rgb", strict=True)))


@query(f"""WITH {_RGB} SELECT p_partkey, round(255 * (r / 255) ** 0.45, 4) AS gamma, round(10 + (g - 20) * 190 / 200, 6) AS shifted, greatest(30.0, least(200.0, b))::DOUBLE AS clipped, CASE WHEN r = 0 THEN 1.0 ELSE r END AS flipped,
  round(g / 4 + 1.5, 6) AS luminance, round(g, 6) AS back FROM c""")
def pixel_remaps(spark, sf):
    r, g, b = (F.col(c).cast("double") for c in "rgb")
    light = colour.to_luminance(g, 4.0, 1.5)
    out = [F.round(colour.gamma(r, 0.45), 4).alias("gamma"), F.round(colour.shifted(g, 20, 220, 10, 200), 6).alias("shifted"), colour.clipped(b, 30.0, 200.0).alias("clipped"), colour.null_flipped(r, 0.0, 1.0).alias("flipped"), F.round(light, 6).alias("luminance"), F.round(colour.from_luminance(light, 4.0, 1.5), 6).alias("back")]
    return _colours(spark, sf).select("p_partkey", *out)


_TABLE = [(0, 0, 0), (255, 255, 255), (200, 30, 30), (30, 200, 30), (30, 30, 200), (128, 128, 128)]


@query(f"WITH {_RGB}, t AS (SELECT * FROM (VALUES " + ", ".join(f"({k}, {r}, {g}, {b})" for k, (r, g, b) in enumerate(_TABLE)) + ") AS x(k, tr, tg, tb)) SELECT p_partkey, k::INTEGER AS colour_index FROM c CROSS JOIN t QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY (r - tr) ** 2 + (g - tg) ** 2 + (b - tb) ** 2, k) = 1")
def colour_index(spark, sf):
    return _colours(spark, sf).select("p_partkey", colour.nearest_index(_rgb(), _TABLE).alias("colour_index"))
