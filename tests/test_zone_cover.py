"""The cell index against a ray per order, and great-circle zones against vectors in space."""

import math
import random

import pytest
from pyspark.sql import functions as F

from abspark.functions.columns import point_in_rings
from abspark.operators import zone_cover as zc
from abspark.sources.tables import globe_sources

SHAPE = "array<array<struct<x:double,y:double>>>"
GEO = f"entity_id string, country_code string, zone_id long, test_id long, zone_shape {SHAPE}"
KEY = {c: c for c in zc.ZONE_KEY}


def star(rng, x, y, n, size):
    """A ring of n points around (x, y), concave as chance has it."""
    turns = sorted(rng.random() * 2 * math.pi for _ in range(n))
    return [(x + size * rng.uniform(0.3, 1) * math.cos(t), y + size * rng.uniform(0.3, 1) * math.sin(t)) for t in turns]


def zones(seed, count=25):
    rng = random.Random(seed)
    rows = []
    for z in range(count):
        x, y = rng.uniform(-50, 50), rng.uniform(-50, 50)
        rings = [star(rng, x, y, rng.randint(3, 60), 3)]
        if z % 3 == 0:
            rings.append(star(rng, x, y, 7, 0.8))  # a hole
        if z % 4 == 0:
            rings.append(star(rng, x + 8, y, 9, 2))  # a second polygon
        rows.append(("e", "c", z, z % 2, rings))
    rows.append(("e", "c", 900, 0, None))
    rows.append(("e", "c", 901, 0, [[(0.0, 0.0), (1.0, 1.0)]]))  # no area
    rows.append(("e", "c", 902, 0, [[(0.0, 0.0), (0.0, 1.0), (0.0, 2.0)]]))  # no width
    rows.append(("e", "c", 0, 0, rows[0][4]))  # a zone listed twice
    return rows


def points(rows, seed, each=300):
    rng = random.Random(seed)
    out, n = [], 0
    for e, c, z, t, rings in rows:
        flat = [p for r in rings or [] for p in r] or [(0.0, 0.0)]
        xs, ys = zip(*flat, strict=True)
        for _ in range(each):
            out.append((e, c, z, t, n, rng.uniform(min(xs) - 0.5, max(xs) + 0.5), rng.uniform(min(ys) - 0.5, max(ys) + 0.5)))
            n += 1
        out.append((e, c, z, t, n, None, 0.0))
        out.append((e, c, z, t, n + 1, flat[0][0], flat[0][1] + 1e-12))
        n += 2
    return out


ORDERS = "entity_id string, country_code string, zone_id long, test_id long, order_id long, lon double, lat double"


@pytest.mark.parametrize("keep", [True, False])
def test_same_answer_as_a_ray_for_every_order(spark, keep):
    rows = zones(3)
    geo, orders = spark.createDataFrame(rows, GEO), spark.createDataFrame(points(rows, 4), ORDERS)
    got = zc.locate(orders, zc.zone_grid(geo), zc.zone_cover(geo), KEY, "lon", "lat", keep_outside=keep)
    ray = orders.join(geo, zc.ZONE_KEY).select("order_id", "zone_id", point_in_rings("zone_shape", "lon", "lat").alias("in_zone"))
    want = ray if keep else ray.where("in_zone")
    columns = ["order_id", "zone_id", "in_zone"]
    key = lambda r: (r[0], r[1], str(r[2]))
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_few_orders_cast_a_ray(spark):
    """Over zones of smooth outline, an eighth of the orders or less; none of the cells is wholly outside."""
    ring = [(math.cos(t) * 2, math.sin(t)) for t in (2 * math.pi * i / 90 for i in range(90))]
    geo = spark.createDataFrame([("e", "c", 1, 0, [ring])], GEO)
    rng = random.Random(1)
    rows = [("e", "c", 1, 0, i, rng.uniform(-2, 2), rng.uniform(-1, 1)) for i in range(5000)]
    cover = zc.zone_cover(geo)
    got = zc.locate(spark.createDataFrame(rows, ORDERS), zc.zone_grid(geo), cover, KEY, "lon", "lat", keep_outside=True)
    share, inside = got.agg(F.avg(F.col("ring_tested").cast("int")), F.avg(F.col("in_zone").cast("int"))).first()
    assert share <= 0.125 and abs(inside - math.pi / 4) < 0.03
    assert cover.count() < zc.COARSE**2
    # A border cell keeps the edges that matter to it, not the outline.
    assert cover.agg(F.max(F.size("edges"))).first()[0] < 45


def sphere(lon, lat):
    a, b = math.radians(lon), math.radians(lat)
    return (math.cos(b) * math.cos(a), math.cos(b) * math.sin(a), math.sin(b))


def winds_around(ring, lon, lat):
    """Sum of the signed angles under which the point sees the ring's edges: a full turn if it is inside."""
    p, turn = sphere(lon, lat), 0.0
    east = (-math.sin(math.radians(lon)), math.cos(math.radians(lon)), 0.0)
    north = (p[1] * east[2] - p[2] * east[1], p[2] * east[0] - p[0] * east[2], p[0] * east[1] - p[1] * east[0])
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    bearing = [math.atan2(dot(v, east), dot(v, north)) for v in (sphere(*q) for q in ring)]
    for a, b in zip(bearing, bearing[1:] + bearing[:1], strict=True):
        turn += (b - a + math.pi) % (2 * math.pi) - math.pi
    return abs(turn) > math.pi


def test_great_circle_zones(spark):
    """Bulging edges, the 180th meridian, both poles, a hole, two polygons: on the sphere as seen from each point."""
    zones, sessions, warehouse = globe_sources(spark, "/root/testdata/sf0.001")
    shapes = {r.zone_id: [[(p.x, p.y) for p in ring] for ring in r.zone_shape] for r in zones.collect()}
    orders = sessions.join(warehouse.withColumnRenamed("order_id", "platform_order_code"), ["platform_order_code"]).select(
        "entity_id", "country_code", "zone_id", F.col("experiment_id").alias("test_id"), "order_id",
        F.col("delivery_location.longitude").alias("lon"), F.col("delivery_location.latitude").alias("lat"))
    got = zc.locate(orders, zc.zone_grid(zones, True), zc.zone_cover(zones, True), KEY, "lon", "lat", True, True).collect()
    flat = {r.order_id: r.in_zone for r in zc.locate(orders, zc.zone_grid(zones), zc.zone_cover(zones), KEY, "lon", "lat", keep_outside=True).collect()}
    assert len(got) > 5000
    differ = {z: 0 for z in shapes}
    for r in got:
        # A point far away sees a small zone's edges from behind: no turn, or the zone's antipode; both are outside.
        near = sum(a * b for a, b in zip(sphere(r.lon, r.lat), sphere(*shapes[r.zone_id][0][0]), strict=True)) > -0.5
        assert r.in_zone == (near and sum(winds_around(ring, r.lon, r.lat) for ring in shapes[r.zone_id]) % 2 == 1), r
        differ[r.zone_id] += r.in_zone != flat[r.order_id]
    assert all(differ[200000 + z] > 0 for z in (0, 1, 2, 3))


def test_zone_of_a_hemisphere_contains_nothing(spark):
    ring = [(0.0, -4.0), (120.0, -4.0), (-120.0, -4.0)]
    geo = spark.createDataFrame([("e", "c", 1, 0, [ring])], GEO)
    orders = spark.createDataFrame([("e", "c", 1, 0, 1, 0.0, 80.0)], ORDERS)
    assert [r.in_zone for r in zc.locate(orders, zc.zone_grid(geo, True), zc.zone_cover(geo, True), KEY, "lon", "lat", True, True).collect()] == [False]


def test_cover_is_made_per_edge_and_its_bits_are_right(spark):
    """A subcell without border bit is inside as a whole or outside as a whole; no lambda runs per cell and edge."""
    rows = [r for r in zones(11, 8) if r[2] < 900]
    geo = spark.createDataFrame(rows, GEO)
    cover = zc.zone_cover(geo)
    plan = cover._jdf.queryExecution().optimizedPlan().toString()
    assert "exists(" not in plan and "aggregate(" not in plan
    marks = {(r.shape_id, r.cell): (r.border, r.inside) for r in cover.collect()}
    rng, pts = random.Random(5), []
    for g in zc.zone_grid(geo).distinct().collect():
        for cell in range(zc.COARSE**2):
            border, inside = marks.get((g.shape_id, cell), (0, 0))
            for sub in range(zc.FINE**2):
                if not border >> sub & 1:
                    i, j = cell // zc.COARSE * zc.FINE + sub % zc.FINE, cell % zc.COARSE * zc.FINE + sub // zc.FINE
                    x, y = (low + (k + rng.random()) * step / zc.FINE for low, k, step in ((g.x0, i, g.dx), (g.y0, j, g.dy)))
                    pts.append((g.zone_id, g.test_id, x, y, bool(inside >> sub & 1)))
    at = spark.createDataFrame(pts, "zone_id long, test_id long, x double, y double, want boolean")
    wrong = at.join(geo.distinct(), ["zone_id", "test_id"]).where(point_in_rings("zone_shape", "x", "y") != F.col("want"))
    assert len(pts) > 3000 and wrong.count() == 0


def test_orders_without_a_cell_do_not_meet_in_one_task(spark, monkeypatch):
    geo = spark.createDataFrame([("e", "c", 1, 0, [[(0.0, 0.0), (1.0, 0.0), (0.5, 1.0)]])], GEO)
    far = [("e", "c", 1, 0, i, 5.0, 5.0 + i) for i in range(500)] + [("e", "c", 1, 0, 500 + i, None, None) for i in range(500)]
    monkeypatch.setattr(zc, "broadcast_if_small", lambda df: df)
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in plain}
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        got = zc.locate(spark.createDataFrame(far, ORDERS), zc.zone_grid(geo), zc.zone_cover(geo), KEY, "lon", "lat", keep_outside=True)
        rows = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in rows) == 1000 and max(r["count"] for r in rows) < 500
