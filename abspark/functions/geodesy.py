"""Great-circle geometry as column expressions.

The gnomonic projection about a point maps every great circle to a straight
line.  So a zone whose edges are great-circle arcs is, in the plane about its own
centre, an ordinary polygon: the planar tests hold there, across the 180th
meridian and around a pole too.  It needs the zone to lie within
``MAX_ANGLE`` of its centre (a zone nearly as large as a hemisphere has no frame
and contains nothing); points further away than that are outside.

A frame is ``struct<c, e, n>``: the unit vectors of the centre and of the plane's
east and north axes, each ``struct<x, y, z>``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_ANGLE = 85.0
_NEAREST = math.cos(math.radians(MAX_ANGLE))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, whatever the number of its uses."""
    return F.get(F.transform(F.array(value), body), 0)


def _vector(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def _dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def unit_vector(lon: Column, lat: Column) -> Column:
    """The point of the unit sphere at longitude and latitude in degrees."""
    lam, phi = F.radians(lon), F.radians(lat)
    return _vector(F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi))


def centre(rings: Column) -> Column:
    """Unit vector of the mean of all vertices (NULL where they cancel out)."""
    zero = _vector(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    vectors = F.transform(F.flatten(rings), lambda p: unit_vector(p["x"], p["y"]))
    total = F.aggregate(vectors, zero, lambda s, v: _vector(s["x"] + v["x"], s["y"] + v["y"], s["z"] + v["z"]))

    def unit(t: Column, size: Column) -> Column:
        return F.when(size > 1e-9, _vector(t["x"] / size, t["y"] / size, t["z"] / size))

    return let(total, lambda t: let(F.sqrt(_dot(t, t)), lambda size: unit(t, size)))


def frame(centre_vector: Column) -> Column:
    """The frame about a unit vector; at a pole the axis of longitude 0 takes the place of east."""
    def east(c: Column) -> Column:
        flat = F.sqrt(c["x"] * c["x"] + c["y"] * c["y"])
        return _vector(F.when(flat > 1e-9, -c["y"] / flat).otherwise(1.0), F.when(flat > 1e-9, c["x"] / flat).otherwise(0.0), F.lit(0.0))

    def axes(c: Column, e: Column) -> Column:
        north = _vector(-c["z"] * e["y"], c["z"] * e["x"], c["x"] * e["y"] - c["y"] * e["x"])
        return F.when(c.isNotNull(), F.struct(c.alias("c"), e.alias("e"), north.alias("n")))

    return let(centre_vector, lambda c: let(east(c), lambda e: axes(c, e)))


def in_plane(p: Column, f: Column) -> tuple[Column, Column]:
    """(x, y) of a unit vector in the frame's plane; NULL for points that are too far from its centre."""
    depth = _dot(p, f["c"])
    on = lambda axis: F.when(depth > _NEAREST, _dot(p, f[axis]) / depth)
    return on("e"), on("n")


def projected_rings(rings: Column, f: Column) -> Column:
    """The rings in the frame's plane; NULL if a vertex is too far from its centre."""
    def point(v: Column) -> Column:
        x, y = in_plane(v, f)
        return F.struct(x.alias("x"), y.alias("y"))

    flat = F.transform(rings, lambda r: F.transform(F.transform(r, lambda p: unit_vector(p["x"], p["y"])), point))
    return let(flat, lambda rs: F.when(~F.exists(F.flatten(rs), lambda p: p["x"].isNull()), rs))
