"""Zone containment by a cell index instead of a polygon per order.

Every distinct zone shape gets a grid of ``COARSE`` x ``COARSE`` cells over its
box, each of ``FINE`` x ``FINE`` subcells.  A cover row (shape, cell) says of each
subcell whether it is inside, outside or on the border, as bits of two numbers;
cells that are wholly outside have no row.  An order finds its zone's grid by the zone key (numbers
only), computes its cell and meets the cover by an equi-join on (shape, cell): the
bits decide, and only border subcells cast the ray, over those edges that a ray
from that cell can meet.  No polygon travels with the orders, and the work per
order does not grow with a zone's outline.

The ray test is the one of :func:`abspark.functions.columns.point_in_rings`, so
both give the same answer for every point.  With ``geodesic`` the edges are
great-circle arcs: shapes and points are projected gnomonically about the shape's
centre (:mod:`abspark.functions.geodesy`) and everything else stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abspark.functions.geodesy import centre, frame, in_plane, projected_rings, unit_vector
from abspark.operators.relational import NULL_KEY_BUCKETS, broadcast_if_small

COARSE = 8
FINE = 4
SIDE = COARSE * FINE  # subcells along a side of the box; a row of them is the bits of one number
# An edge that climbs less than this part of a subcell is taken with its whole width.
LEVEL = 0.01
# Cells are looked at a little enlarged, so that a point that rounding puts into
# the next cell is still decided rightly.
MARGIN = 1e-6

ZONE_KEY = ["entity_id", "country_code", "zone_id", "test_id"]


def shape_id(shape: Column) -> Column:
    return F.xxhash64(shape)


def ring_edges(rings: Column) -> Column:
    """All edges of all rings with three points or more, as ``array<struct<ax, ay, bx, by>>``."""
    def edges(r: Column) -> Column:
        def edge(i: Column) -> Column:
            a, b = F.get(r, i), F.get(r, (i + 1) % F.size(r))
            return F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by"))

        return F.transform(F.sequence(F.lit(0), F.size(r) - 1), edge)

    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) >= 3), edges))


def odd_crossings(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd rule: does the ray from (x, y) towards +x cross an odd number of edges?"""
    def crosses(e: Column) -> Column:
        across = (e["ay"] > y) != (e["by"] > y)
        return across & (x < F.when(across, (e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"]))

    return F.aggregate(edges, F.lit(False), lambda odd, e: odd != crosses(e))


def zone_shapes(geo: DataFrame, geodesic: bool = False) -> DataFrame:
    """One row per distinct shape: shape_id, its grid (x0, y0, x1, y1, dx, dy), its frame if geodesic, and its edges."""
    shapes = geo.where(F.col("zone_shape").isNotNull()).groupBy(shape_id(F.col("zone_shape")).alias("shape_id")).agg(
        F.first("zone_shape").alias("rings"))
    if geodesic:
        shapes = shapes.withColumn("frame", frame(centre(F.col("rings"))))
        shapes = shapes.withColumn("rings", projected_rings(F.col("rings"), F.col("frame"))).where("rings is not null")
    else:
        shapes = shapes.withColumn("frame", F.lit(None).cast("boolean"))
    shapes = shapes.withColumn("edges", ring_edges(F.col("rings"))).drop("rings").where(F.size("edges") > 0)
    xs, ys = F.transform("edges", lambda e: e["ax"]), F.transform("edges", lambda e: e["ay"])
    shapes = shapes.select("*", F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"), F.array_min(ys).alias("y0"),
                           F.array_max(ys).alias("y1"))
    return shapes.select("*", ((F.col("x1") - F.col("x0")) / COARSE).alias("dx"), ((F.col("y1") - F.col("y0")) / COARSE).alias("dy"))


def zone_grid(geo: DataFrame, geodesic: bool = False) -> DataFrame:
    """The grid of every (entity, country, zone, test): numbers only, no outline."""
    keys = geo.select(*ZONE_KEY, shape_id(F.col("zone_shape")).alias("shape_id"), F.col("zone_shape").isNotNull().alias("has_shape"))
    return keys.join(zone_shapes(geo, geodesic).drop("edges"), "shape_id", "left")


def _edge_rows(shapes: DataFrame) -> DataFrame:
    """(shape_id, j, border, toggled): what each edge does to each row ``j`` of subcells that it reaches.

    Bit ``i`` of ``border``: the edge meets subcell (i, j), a little enlarged.
    ``toggled``: the subcells whose ray from the centre towards +x crosses it.
    """
    e = shapes.select("shape_id", "x0", "y0", (F.col("dx") / FINE).alias("width"), (F.col("dy") / FINE).alias("height"),
                      (F.col("dx") * MARGIN).alias("mx"), (F.col("dy") * MARGIN).alias("my"), F.explode("edges").alias("e"))
    e = e.select(*[c for c in e.columns if c != "e"], "e.*").withColumns({
        "low": F.least("ay", "by"), "high": F.greatest("ay", "by"), "left": F.least("ax", "bx"), "right": F.greatest("ax", "bx")})
    at = lambda v, start, step: F.least(F.greatest(F.floor((v - F.col(start)) / F.col(step)), F.lit(0)), F.lit(SIDE - 1)).cast("int")
    rows = F.sequence(at(F.col("low") - F.col("my"), "y0", "height"), at(F.col("high") + F.col("my"), "y0", "height"))
    e = e.select("*", F.explode(rows).alias("j"))
    bottom = F.col("y0") + F.col("j") * F.col("height")
    # The part of the edge within the row; of a nearly level edge all of it, whose slope says too little.
    along = lambda y: F.col("ax") + (F.col("bx") - F.col("ax")) * (y - F.col("ay")) / F.nullif(F.col("by") - F.col("ay"), F.lit(0.0))
    e = e.withColumns({"enter": along(F.greatest("low", bottom - F.col("my"))),
                       "leave": along(F.least("high", bottom + F.col("height") + F.col("my"))),
                       "steep": F.col("high") - F.col("low") > F.col("height") * LEVEL,
                       "middle": bottom + F.col("height") / 2})
    e = e.withColumns({"first": at(F.when(F.col("steep"), F.least("enter", "leave")).otherwise(F.col("left")) - F.col("mx"), "x0", "width"),
                       "last": at(F.when(F.col("steep"), F.greatest("enter", "leave")).otherwise(F.col("right")) + F.col("mx"), "x0", "width")})
    across = (F.col("ay") > F.col("middle")) != (F.col("by") > F.col("middle"))
    before = F.ceil((along(F.col("middle")) - F.col("x0")) / F.col("width") - 0.5)
    e = e.withColumn("before", F.when(across, F.least(F.greatest(before, F.lit(0)), F.lit(SIDE)).cast("int")).otherwise(0))
    return e.select("shape_id", "j", F.expr("shiftleft(1L, last + 1) - shiftleft(1L, first)").alias("border"),
                    F.expr("shiftleft(1L, before) - 1L").alias("toggled"))


def zone_cover(geo: DataFrame, geodesic: bool = False) -> DataFrame:
    """(shape_id, cell, border, inside, edges): the cells that are not wholly outside; bit ``j * FINE + i`` of a mark is a subcell's.

    An edge is dealt to the rows of subcells that it reaches, where it is a span
    of border bits and a prefix of crossed rays.  OR and XOR over the edges of a row
    give all of its marks at once, so a shape costs its edges, not cells x edges.
    """
    # Few bytes but much arithmetic: dealt to every core, whatever the adaptive planner makes of the size.
    shapes = zone_shapes(geo, geodesic).where("dx > 0 and dy > 0").select("shape_id", "x0", "y0", "dx", "dy", "edges").repartition(
        geo.sparkSession.sparkContext.defaultParallelism, "shape_id")
    marks = []
    for r in range(FINE):
        own = F.col("j") % FINE == r
        marks += [F.coalesce(F.bit_or(F.when(own, F.col("border"))), F.lit(0)).alias(f"b{r}"),
                  F.coalesce(F.bit_xor(F.when(own, F.col("toggled"))), F.lit(0)).alias(f"t{r}")]
    bands = _edge_rows(shapes).groupBy("shape_id", F.expr(f"j div {FINE}").cast("int").alias("band")).agg(*marks)
    bands = bands.join(shapes, "shape_id").withColumn("cy", F.col("y0") + F.col("band") * F.col("dy"))
    mx, my = F.col("dx") * MARGIN, F.col("dy") * MARGIN
    # Edges that a ray from the cell towards +x can meet: first those of the band, then those of the cell.
    level = F.filter("edges", lambda e: (F.greatest(e["ay"], e["by"]) >= F.col("cy") - my) & (
        F.least(e["ay"], e["by"]) <= F.col("cy") + F.col("dy") + my))
    bands = bands.withColumn("level", level)
    cells = bands.select("*", F.explode(F.sequence(F.lit(0), F.lit(COARSE - 1))).alias("i"))
    part = lambda c, r: f"shiftleft(shiftright({c}{r}, i * {FINE}) & {2**FINE - 1}L, {r * FINE})"
    joined = lambda c: F.expr(" | ".join(part(c, r) for r in range(FINE))).cast("int")
    cells = cells.withColumns({"border": joined("b"), "toggled": joined("t")}).withColumn("inside", F.expr("toggled & ~border"))
    near = F.filter("level", lambda e: F.greatest(e["ax"], e["bx"]) >= F.col("x0") + F.col("i") * F.col("dx") - mx)
    return cells.where("(border | inside) != 0").select(
        "shape_id", (F.col("i") * COARSE + F.col("band")).cast("int").alias("cell"), "border", "inside",
        F.when(F.col("border") != 0, near).otherwise(F.slice("level", 1, 0)).alias("edges"))


def locate(orders: DataFrame, grid: DataFrame, cover: DataFrame, on: dict[str, str], lon: str, lat: str,
           geodesic: bool = False, keep_outside: bool = False) -> DataFrame:
    """``orders`` in their zone: inner-joined to the zone's grid, with column ``in_zone``.

    ``on`` maps the zone key's columns to those of ``orders``.  Only contained
    orders stay, unless ``keep_outside``: then all that have a zone do, and
    ``in_zone`` is NULL where the point or the shape is.
    """
    names = {c: f"__g_{c}" for c in grid.columns}
    g = broadcast_if_small(grid.select(*(F.col(c).alias(a) for c, a in names.items())))
    cond = None
    for zone_column, column in on.items():
        c = orders[column] == g[names[zone_column]]
        cond = c if cond is None else cond & c
    col = lambda c: F.col(names[c])
    met, x, y = orders.join(g, cond, "inner"), F.col(lon), F.col(lat)
    if geodesic:
        met = met.withColumn("__p", unit_vector(x, y))
        x, y = in_plane(F.col("__p"), col("frame"))
    met = met.withColumns({"__x": x, "__y": y})
    in_box = F.col("__x").between(col("x0"), col("x1")) & F.col("__y").between(col("y0"), col("y1"))
    at = lambda v, low, step, n: F.when(in_box, F.least(F.floor((F.col(v) - col(low)) / F.nullif(col(step), F.lit(0.0)) * n), F.lit(COARSE * n - 1)))
    met = met.withColumns({"__i": at("__x", "x0", "dx", FINE), "__j": at("__y", "y0", "dy", FINE)})
    met = met.withColumns({
        "__cell": (F.expr(f"__i div {FINE}") * COARSE + F.expr(f"__j div {FINE}")).cast("int"),
        "__sub": (F.col("__j") % FINE * FINE + F.col("__i") % FINE).cast("int")})
    if keep_outside:
        # No cell, no match: such rows get numbers that no cell has instead of meeting in one task.
        spread = -1 - F.pmod(F.xxhash64(*(F.col(c) for c in orders.columns)), F.lit(NULL_KEY_BUCKETS))
        met = met.withColumn("__cell", F.coalesce("__cell", spread.cast("int")))
    c = broadcast_if_small(cover.select(F.col("shape_id").alias("__c_shape"), F.col("cell").alias("__c_cell"),
                                           F.col("border").alias("__border"), F.col("inside").alias("__inside"), F.col("edges").alias("__edges")))
    met = met.join(c, (met[names["shape_id"]] == c["__c_shape"]) & (met["__cell"] == c["__c_cell"]), "left" if keep_outside else "inner")
    on_border, inside = (F.expr(f"coalesce(shiftright({m}, __sub) & 1, 0) = 1") for m in ("__border", "__inside"))
    found = F.when(on_border, odd_crossings(F.col("__edges"), F.col("__x"), F.col("__y"))).otherwise(inside)
    if keep_outside:
        out = met.withColumn("in_zone", F.when(col("has_shape") & F.col(lon).isNotNull() & F.col(lat).isNotNull(), found))
    else:
        out = met.where(found).withColumn("in_zone", F.lit(True))
    return out.select(*orders.columns, "in_zone", on_border.alias("ring_tested"))
