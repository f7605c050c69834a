"""Vector sources: rings of KML files, coordinate systems of .prj files, well-known binary, and feature schemas."""

from __future__ import annotations

import re
import struct
import xml.etree.ElementTree as ET

from pyspark.sql import types as T

# Field types of feature schemas.
FIELD_TYPES = {"String": T.StringType(), "Integer": T.LongType(), "Real": T.DoubleType(), "StringList": T.ArrayType(T.StringType())}


def kml_rings(text: str) -> list[tuple[str | None, list[tuple[float, float]]]]:
    """(name, closed lon/lat ring) of each polygon's outer boundary."""
    out = []
    tag = lambda e: e.tag.rpartition("}")[2]
    for place in (e for e in ET.fromstring(text).iter() if tag(e) == "Placemark"):
        name = next((e.text for e in place.iter() if tag(e) == "name"), None)
        for outer in (e for e in place.iter() if tag(e) == "outerBoundaryIs"):
            for c in (e for e in outer.iter() if tag(e) == "coordinates"):
                ring = [tuple(float(v) for v in p.split(",")[:2]) for p in (c.text or "").split()]
                if ring:
                    out.append((name, ring if ring[0] == ring[-1] else [*ring, ring[0]]))
    return out


def coordinate_system(wkt: str) -> dict:
    """Kind, name and parameters of a coordinate system in WKT."""
    m = re.match(r'\s*(PROJCS|GEOGCS)\["([^"]*)"', wkt)
    if not m:
        raise ValueError("no coordinate system")
    numbers = {k.lower(): float(v) for k, v in re.findall(r'PARAMETER\["([^"]*)",\s*([-+.\deE]+)\]', wkt)}
    ellipsoid = re.search(r'SPHEROID\["([^"]*)",\s*([-+.\deE]+),\s*([-+.\deE]+)', wkt)
    projection = re.search(r'PROJECTION\["([^"]*)"', wkt)
    return {
        "kind": "projected" if m[1] == "PROJCS" else "geographic", "name": m[2], "projection": projection[1] if projection else None, "parameters": numbers,
        "ellipsoid": (ellipsoid[1], float(ellipsoid[2]), float(ellipsoid[3])) if ellipsoid else None,
    }


def read_wkb(data: bytes) -> tuple[str, list]:
    """Kind and coordinates of a point, line, polygon or a collection of them, in either byte order."""
    from ..functions.geometry import GEOMETRY_KINDS

    def at(p: int) -> tuple[str, list, int]:
        order = "<" if data[p] == 1 else ">"
        kind = struct.unpack_from(order + "I", data, p + 1)[0] & 0xFF
        p += 5
        number = lambda q: struct.unpack_from(order + "I", data, q)[0]

        def points(q: int, n: int) -> tuple[list, int]:
            flat = struct.unpack_from(f"{order}{2 * n}d", data, q)
            return list(zip(flat[::2], flat[1::2], strict=True)), q + 16 * n

        if kind == 1:
            got, p = points(p, 1)
        elif kind == 2:
            got, p = points(p + 4, number(p))
        elif kind == 3:
            n, p, got = number(p), p + 4, []
            for _ in range(n):
                ring, p = points(p + 4, number(p))
                got.append(ring)
        elif kind in (4, 5, 6, 7):
            n, p, got = number(p), p + 4, []
            for _ in range(n):
                name, part, p = at(p)
                got.append((name, part))
        else:
            raise ValueError(f"geometry kind {kind}")
        return GEOMETRY_KINDS[kind], got, p

    name, coordinates, _ = at(0)
    return name, coordinates


def write_wkb(kind: int, coordinates: list, little: bool = True) -> bytes:
    """A point, line or polygon."""
    order = "<" if little else ">"
    pack = lambda pts: b"".join(struct.pack(order + "2d", *p) for p in pts)
    head = bytes([1 if little else 0]) + struct.pack(order + "I", kind)
    if kind == 1:
        return head + pack(coordinates)
    if kind == 2:
        return head + struct.pack(order + "I", len(coordinates)) + pack(coordinates)
    if kind == 3:
        return head + struct.pack(order + "I", len(coordinates)) + b"".join(struct.pack(order + "I", len(r)) + pack(r) for r in coordinates)
    raise ValueError(f"geometry kind {kind}")


def feature_schema(gfs: str) -> T.StructType:
    """Fields and geometries of the first feature class of a feature schema file."""
    root = ET.fromstring(gfs)
    cls = root if root.tag == "GMLFeatureClass" else next(root.iter("GMLFeatureClass"))
    fields = [T.StructField(p.findtext("Name"), FIELD_TYPES.get(p.findtext("Type", "String"), T.StringType())) for p in cls.iter("PropertyDefn")]
    shapes = [T.StructField(g.findtext("Name") or "geometry", T.StringType()) for g in cls.iter("GeomPropertyDefn")]
    return T.StructType(fields + shapes)
