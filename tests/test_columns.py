"""Column functions against plain-Python statements of the same rules."""

import math

import numpy as np
from pyspark.sql import functions as F

from abspark.functions import columns as C


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_normalize_vertical(spark):
    vals = ["Restaurant", "restaurants", "RESTAURANT", "Shop", "darkstores", "Darkstores", "groceries", None]
    got = _one(spark, C.normalize_vertical("v"), [(v,) for v in vals], "v string")
    assert got == ["restaurant", "restaurant", "restaurant", "shop", "darkstores", "darkstores", None, None]


def test_split_parent_verticals(spark):
    cases = {
        "Restaurant": ("restaurant", None),
        "restaurants, shop": ("restaurant", "shop"),
        "Shop, darkstores": ("shop", "darkstores"),
        "darkstores, restaurant, shop": (None, None),  # greedy split: 'darkstores, restaurant' / 'restaurant, shop'
        "": (None, None),
        "unknown": (None, None),
        None: (None, None),
    }
    first, second = C.split_parent_verticals("s")
    df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", first.alias("a"), second.alias("b"))
    for r in df.collect():
        assert (r.a, r.b) == cases[r.s], r


def test_round_half_even_matches_numpy(spark):
    xs = [0.03125, 0.00625, 2.675, -1.23455, 1234.56785, 0.5, 1.5, 2.5, -2.5, 1 / 3, 12.34565]
    got = _one(spark, C.round_half_even("x", 4), [(x,) for x in xs], "x double")
    assert got == [float(np.round(np.float64(x), 4)) for x in xs]


def test_round_half_away(spark):
    xs = [2.5, -2.5, 0.125, 1.005, 12.3449999, 0.0]
    got = _one(spark, C.round_half_away("x", 2), [(x,) for x in xs], "x double")
    expect = [math.copysign(math.floor(abs(x) * 100 + 0.5) / 100, x) if x else 0.0 for x in xs]
    assert got == expect


def test_erfc_accuracy(spark):
    xs = [i / 10 for i in range(-60, 61)]
    got = _one(spark, C.erfc("x"), [(x,) for x in xs], "x double")
    for x, g in zip(xs, got):
        assert abs(g - math.erfc(x)) <= 1.3e-7 * max(math.erfc(x), 1e-300) + 1e-12, x


def _ray_cast(ring, x, y):
    inside = False
    n = len(ring)
    for i in range(n):
        (ax, ay), (bx, by) = ring[i], ring[(i + 1) % n]
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            inside = not inside
    return inside


def test_point_in_ring_matches_ray_casting(spark):
    concave = [(0, 0), (4, 0), (4, 4), (2, 1.5), (0, 4), (0, 0)]
    triangle = [(10, 10), (14, 10), (12, 13)]  # not closed
    rng = np.random.default_rng(7)
    rows = []
    for ring in (concave, triangle):
        for _ in range(150):
            x, y = float(rng.uniform(-1, 15)), float(rng.uniform(-1, 14))
            rows.append(([{"x": float(a), "y": float(b)} for a, b in ring], x, y, _ray_cast(ring, x, y)))
    df = spark.createDataFrame(rows, "ring array<struct<x:double,y:double>>, x double, y double, want boolean")
    out = df.select(C.point_in_ring("ring", "x", "y").alias("got"), "want").collect()
    assert all(r.got == r.want for r in out)


def test_point_in_rings_hole(spark):
    outer = [{"x": 0.0, "y": 0.0}, {"x": 10.0, "y": 0.0}, {"x": 10.0, "y": 10.0}, {"x": 0.0, "y": 10.0}]
    hole = [{"x": 4.0, "y": 4.0}, {"x": 6.0, "y": 4.0}, {"x": 6.0, "y": 6.0}, {"x": 4.0, "y": 6.0}]
    rows = [([outer, hole], 1.0, 1.0), ([outer, hole], 5.0, 5.0), ([outer, hole], 11.0, 5.0), (None, 1.0, 1.0)]
    got = _one(spark, C.point_in_rings("r", "x", "y"), rows,
               "r array<array<struct<x:double,y:double>>>, x double, y double")
    assert got == [True, False, False, None]


def test_equal_width_bin_matches_searchsorted(spark):
    edges = np.arange(0, 1.05, 0.05)
    xs = [0.0, 0.05, 0.0500001, 0.15, 0.15000000000000002, 0.2, 0.999, 1.0, 1.0000001, 0.3, 0.35, 0.7, -0.1]
    got = _one(spark, C.equal_width_bin("x", 0.05, 20), [(x,) for x in xs], "x double")
    for x, g in zip(xs, got):
        i = int(np.searchsorted(edges, x, side="left"))  # pd.cut, right-closed
        want = i if 1 <= i <= 20 else None
        assert g == want, (x, g, want)


def test_length_bins(spark):
    xs = [0, 1, 7, 8, 70, 77, 78, 100]
    got = _one(spark, C.equal_width_bin(F.col("x").cast("double"), 7, 11), [(x,) for x in xs], "x int")
    assert got == [None, 1, 1, 2, 10, 11, None, None]
