"""Planar geometry on coordinate columns: envelopes, rings, paths and relations."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Well-known codes of geometry kinds, of places against a geometry, and of region relations.
GEOMETRY_KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}
PLACES = {0: "interior", 1: "boundary", 2: "exterior"}
RELATIONS = ("DC", "EC", "PO", "TPP", "TPPI", "NTPP", "NTPPI", "EQ")


def envelope_null(box: Column) -> Column:
    return box["maxx"] < box["minx"]


def envelopes_meet(a: Column, b: Column) -> Column:
    """Closed boxes share a point; a null box meets none."""
    some = ~(envelope_null(a) | envelope_null(b))
    return some & (a["minx"] <= b["maxx"]) & (b["minx"] <= a["maxx"]) & (a["miny"] <= b["maxy"]) & (b["miny"] <= a["maxy"])


def envelope_covers(a: Column, b: Column) -> Column:
    some = ~(envelope_null(a) | envelope_null(b))
    return some & (a["minx"] <= b["minx"]) & (b["maxx"] <= a["maxx"]) & (a["miny"] <= b["miny"]) & (b["maxy"] <= a["maxy"])


def box_relation(a: Column, b: Column) -> Column:
    """Which of the eight region relations two non-empty boxes are in."""
    equal = (a["minx"] == b["minx"]) & (a["maxx"] == b["maxx"]) & (a["miny"] == b["miny"]) & (a["maxy"] == b["maxy"])
    strictly = lambda p, q: (p["minx"] > q["minx"]) & (p["maxx"] < q["maxx"]) & (p["miny"] > q["miny"]) & (p["maxy"] < q["maxy"])
    touch = (a["maxx"] == b["minx"]) | (b["maxx"] == a["minx"]) | (a["maxy"] == b["miny"]) | (b["maxy"] == a["miny"])
    return (
        F.when(~envelopes_meet(a, b), "DC").when(equal, "EQ").when(touch, "EC").when(strictly(a, b), "NTPP").when(strictly(b, a), "NTPPI")
        .when(envelope_covers(b, a), "TPP").when(envelope_covers(a, b), "TPPI").otherwise("PO")
    )


def closed(points: Column) -> Column:
    """A ring that ends where it begins."""
    first, last = F.element_at(points, 1), F.element_at(points, -1)
    return F.when((F.size(points) == 0) | (first == last), points).otherwise(F.concat(points, F.array(first)))


def _edges(ring: Column) -> Column:
    ring = closed(ring)
    return F.arrays_zip(F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b"))


def ring_area(ring: Column) -> Column:
    """Area by the shoelace formula."""
    return F.abs(F.aggregate(_edges(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])) / 2


def ring_length(ring: Column) -> Column:
    return F.aggregate(_edges(ring), F.lit(0.0), lambda s, e: s + F.sqrt(F.pow(e["a"]["x"] - e["b"]["x"], 2) + F.pow(e["a"]["y"] - e["b"]["y"], 2)))


def compactness(area: Column, length: Column) -> Column:
    return F.when(length == 0, 0.0).otherwise(4 * math.pi * area / (length * length))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Ray crossing; the boundary belongs to one side only."""

    def crossed(inside: Column, e: Column) -> Column:
        a, b = e["a"], e["b"]
        spans = (a["y"] > y) != (b["y"] > y)
        cut = a["x"] + (y - a["y"]) / F.when(spans, b["y"] - a["y"]).otherwise(1.0) * (b["x"] - a["x"])
        return F.when(spans & (x < cut), ~inside).otherwise(inside)

    return F.aggregate(_edges(ring), F.lit(False), crossed)


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """From a point to a segment; a segment of no length is a point."""
    size = (bx - ax) * (bx - ax) + (by - ay) * (by - ay)
    t = F.when(size == 0, 0.0).otherwise(((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / F.when(size == 0, 1.0).otherwise(size))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return F.sqrt(F.pow(px - ax - t * (bx - ax), 2) + F.pow(py - ay - t * (by - ay), 2))


def well_known_text(points: Column, kind: str = "LINESTRING") -> Column:
    """WKT of a path or, with ``POLYGON``, of one closed ring."""
    body = F.array_join(F.transform(closed(points) if kind == "POLYGON" else points, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", ")
    return F.concat(F.lit(f"{kind} (("), body, F.lit("))")) if kind == "POLYGON" else F.concat(F.lit(f"{kind} ("), body, F.lit(")"))


def points_of_text(text: Column) -> Column:
    """Points of the first coordinate list of a WKT."""
    body = F.regexp_extract(text, r"\(+([^()]*)\)", 1)
    pairs = F.filter(F.split(body, r"\s*,\s*"), lambda p: p != "")
    return F.transform(pairs, lambda p: F.struct(F.split(F.trim(p), r"\s+")[0].cast("double").alias("x"), F.split(F.trim(p), r"\s+")[1].cast("double").alias("y")))


def path_length(path: Column) -> Column:
    """Length of an open path."""
    pairs = F.zip_with(F.slice(path, 1, F.size(path) - 1), F.slice(path, 2, F.greatest(F.size(path) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.when(F.size(path) < 2, 0.0).otherwise(F.aggregate(pairs, F.lit(0.0), lambda s, e: s + F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"])))


def line_centroid(path: Column) -> Column:
    """Mean of the segments' middles weighted by their lengths; null without length."""
    edges = F.arrays_zip(F.slice(path, 1, F.size(path) - 1).alias("a"), F.slice(path, 2, F.size(path) - 1).alias("b"))
    zero = F.struct(F.lit(0.0).alias("l"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(s: Column, e: Column) -> Column:
        l = F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"])
        return F.struct((s["l"] + l).alias("l"), (s["x"] + l * (e["a"]["x"] + e["b"]["x"]) / 2).alias("x"), (s["y"] + l * (e["a"]["y"] + e["b"]["y"]) / 2).alias("y"))

    return F.aggregate(edges, zero, add, lambda s: F.when(s["l"] > 0, F.struct((s["x"] / s["l"]).alias("x"), (s["y"] / s["l"]).alias("y"))))


def ring_centroid(ring: Column) -> Column:
    """Centre of gravity of a ring's area; null without area."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(s: Column, e: Column) -> Column:
        a, b = e["a"], e["b"]
        w = a["x"] * b["y"] - b["x"] * a["y"]
        return F.struct((s["a"] + w).alias("a"), (s["x"] + w * (a["x"] + b["x"])).alias("x"), (s["y"] + w * (a["y"] + b["y"])).alias("y"))

    return F.aggregate(_edges(ring), zero, add, lambda s: F.when(s["a"] != 0, F.struct((s["x"] / (3 * s["a"])).alias("x"), (s["y"] / (3 * s["a"])).alias("y"))))


def turn(a: Column, b: Column, c: Column) -> Column:
    """1 where the way a, b, c turns left, -1 right, 0 straight on."""
    return F.signum((b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])).cast("int")


def lines_crossing(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Where the lines through a, b and through c, d meet, by homogeneous coordinates; null where they are parallel."""
    line = lambda p, q: (p["y"] - q["y"], q["x"] - p["x"], p["x"] * q["y"] - q["x"] * p["y"])
    (x1, y1, w1), (x2, y2, w2) = line(a, b), line(c, d)
    w = x1 * y2 - x2 * y1
    return F.when(w != 0, F.struct(((y1 * w2 - y2 * w1) / w).alias("x"), ((x2 * w1 - x1 * w2) / w).alias("y")))


def triangle(a: Column, b: Column, c: Column) -> Column:
    """Area, centroid, centres of the circles around and within, and whether every corner is acute."""
    side = lambda p, q: F.hypot(p["x"] - q["x"], p["y"] - q["y"])
    la, lb, lc = side(b, c), side(c, a), side(a, b)
    area = F.abs((b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])) / 2
    around = la + lb + lc
    d = 2 * (a["x"] * (b["y"] - c["y"]) + b["x"] * (c["y"] - a["y"]) + c["x"] * (a["y"] - b["y"]))
    sq = lambda p: p["x"] * p["x"] + p["y"] * p["y"]
    flat = F.when(d != 0, d)
    longest = F.greatest(la, lb, lc)
    return F.struct(
        area.alias("area"), ((a["x"] + b["x"] + c["x"]) / 3).alias("cx"), ((a["y"] + b["y"] + c["y"]) / 3).alias("cy"),
        ((sq(a) * (b["y"] - c["y"]) + sq(b) * (c["y"] - a["y"]) + sq(c) * (a["y"] - b["y"])) / flat).alias("ox"), ((sq(a) * (c["x"] - b["x"]) + sq(b) * (a["x"] - c["x"]) + sq(c) * (b["x"] - a["x"])) / flat).alias("oy"),
        ((la * a["x"] + lb * b["x"] + lc * c["x"]) / around).alias("ix"), ((la * a["y"] + lb * b["y"] + lc * c["y"]) / around).alias("iy"), (2 * longest * longest < la * la + lb * lb + lc * lc).alias("acute"),
    )


def precise(value: Column, scale: float) -> Column:
    """The nearest coordinate of a fixed grid of 1 / scale, halves upwards."""
    return F.floor(value * F.lit(float(scale)) + F.lit(0.5)) / F.lit(float(scale))


def place_of(x: Column, y: Column, ring: Column) -> Column:
    """0 inside a ring, 1 on its boundary, 2 outside."""
    on = F.exists(_edges(ring), lambda e: ((e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) == (e["b"]["y"] - e["a"]["y"]) * (x - e["a"]["x"])) & x.between(F.least(e["a"]["x"], e["b"]["x"]), F.greatest(e["a"]["x"], e["b"]["x"])) & y.between(F.least(e["a"]["y"], e["b"]["y"]), F.greatest(e["a"]["y"], e["b"]["y"])))
    return F.when(on, 1).when(in_ring(x, y, ring), 0).otherwise(2)


def length_index(px: Column, py: Column, path: Column) -> Column:
    """Way along a path to its point nearest to (px, py), the first of equally near ones; and the distance (to nine places)."""
    edges = F.arrays_zip(F.slice(path, 1, F.size(path) - 1).alias("a"), F.slice(path, 2, F.size(path) - 1).alias("b"))
    zero = F.struct(F.lit(0.0).alias("way"), F.lit(None).cast("double").alias("d"), F.lit(None).cast("double").alias("at"))

    def step(s: Column, e: Column) -> Column:
        ax, ay, bx, by = e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]
        l2 = (bx - ax) * (bx - ax) + (by - ay) * (by - ay)
        t = F.when(l2 == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / F.when(l2 == 0, 1.0).otherwise(l2))))
        d = F.round(F.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay)), 9)
        better = s["d"].isNull() | (d < s["d"])
        return F.struct((s["way"] + F.sqrt(l2)).alias("way"), F.when(better, d).otherwise(s["d"]).alias("d"), F.when(better, s["way"] + t * F.sqrt(l2)).otherwise(s["at"]).alias("at"))

    return F.aggregate(edges, zero, step, lambda s: F.struct(s["at"].alias("way"), s["d"].alias("distance")))


def chain_code(path: Column, one_axis: bool = False) -> Column:
    """Steps from each point of a path to the next, or, one axis at a time, two for each."""
    steps = F.zip_with(F.slice(path, 1, F.size(path) - 1), F.slice(path, 2, F.size(path) - 1), lambda a, b: F.struct((b["x"] - a["x"]).alias("dx"), (b["y"] - a["y"]).alias("dy")))
    if not one_axis:
        return steps
    zero = F.lit(0.0)
    halves = F.flatten(F.transform(steps, lambda s: F.array(F.struct(s["dx"].alias("dx"), zero.alias("dy")), F.struct(zero.alias("dx"), s["dy"].alias("dy")))))
    return F.filter(halves, lambda s: (s["dx"] != 0) | (s["dy"] != 0))


def convex_hull(points: Column) -> Column:
    """Corners of the hull, counter-clockwise from the leftmost, as a ring that isn't closed; two points or fewer are their own hull.

    Points are sorted and the lower and upper chains are built by dropping what turns right, in one fold each.
    """

    def chain(ps: Column) -> Column:
        empty = F.slice(ps, 1, 0)

        def push(kept: Column, p: Column) -> Column:
            # a corner goes while the way over it doesn't turn left
            stays = lambda s: (F.size(s) >= 2) & (turn(F.element_at(s, -2), F.element_at(s, -1), p) <= 0)
            drop = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(kept), F.lit(1))), kept, lambda s, _: F.when(stays(s), F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0)))).otherwise(s))
            return F.concat(drop, F.array(p))

        return F.aggregate(ps, empty, push)

    ps = F.array_sort(F.array_distinct(points))
    lower, upper = chain(ps), chain(F.reverse(ps))
    body = lambda c: F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0)))
    return F.when(F.size(ps) <= 2, ps).otherwise(F.concat(body(lower), body(upper)))


def quad_key(box: Column) -> Column:
    """Level and corner of the smallest power-of-two square of the plane's grid that holds a box: what a quadtree files it under.

    The level is the exponent of a side. It starts at the box's own extent and rises until one square holds both corners.
    """
    extent = F.greatest(box["maxx"] - box["minx"], box["maxy"] - box["miny"])
    start = F.when(extent > 0, F.ceil(F.log2(F.when(extent > 0, extent)))).otherwise(F.lit(-1)).cast("int")
    side = lambda k: F.pow(F.lit(2.0), k)
    whole = lambda k: (F.floor(box["minx"] / side(k)) == F.floor(box["maxx"] / side(k))) & (F.floor(box["miny"] / side(k)) == F.floor(box["maxy"] / side(k)))
    level = F.aggregate(F.sequence(F.lit(1), F.lit(64)), start, lambda k, _: F.when(whole(k), k).otherwise(k + 1))
    held = F.transform(F.array(level), lambda k: F.struct(k.alias("level"), (F.floor(box["minx"] / side(k)) * side(k)).alias("x"), (F.floor(box["miny"] / side(k)) * side(k)).alias("y")))
    return held[0]


def part_of_path(path: Column, start: float, end: float) -> Column:
    """The path between two lengths along it, with the points where it is cut."""
    zero = F.struct(F.lit(0.0).alias("way"), F.slice(path, 1, 0).alias("out"))
    edges = F.arrays_zip(F.slice(path, 1, F.size(path) - 1).alias("a"), F.slice(path, 2, F.size(path) - 1).alias("b"))

    def step(s: Column, e: Column) -> Column:
        a, b = e["a"], e["b"]
        l = F.hypot(b["x"] - a["x"], b["y"] - a["y"])
        at = lambda w: F.struct((a["x"] + (b["x"] - a["x"]) * (w - s["way"]) / l).alias("x"), (a["y"] + (b["y"] - a["y"]) * (w - s["way"]) / l).alias("y"))
        low, high = F.greatest(F.lit(float(start)), s["way"]), F.least(F.lit(float(end)), s["way"] + l)
        some = F.array(at(low), at(high))
        first = F.size(s["out"]) == 0
        return F.struct((s["way"] + l).alias("way"), F.when((l == 0) | (low > high), s["out"]).otherwise(F.concat(s["out"], F.when(first, some).otherwise(F.slice(some, 2, 1)))).alias("out"))

    return F.aggregate(edges, zero, step, lambda s: s["out"])


def minimum_clearance(path: Column) -> Column:
    """Least distance of a corner to another corner or to a segment that doesn't end at it; null below two corners."""
    edges = F.arrays_zip(F.slice(path, 1, F.size(path) - 1).alias("a"), F.slice(path, 2, F.size(path) - 1).alias("b"))

    def from_corner(p: Column) -> Column:
        same = lambda q: (p["x"] == q["x"]) & (p["y"] == q["y"])
        points = F.transform(F.filter(path, lambda q: ~same(q)), lambda q: F.hypot(p["x"] - q["x"], p["y"] - q["y"]))
        lines = F.transform(F.filter(edges, lambda e: ~same(e["a"]) & ~same(e["b"])), lambda e: segment_distance(p["x"], p["y"], e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]))
        return F.array_min(F.concat(points, lines))

    return F.array_min(F.transform(path, from_corner))
