"""Column functions shared by the operators.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage code generation; nothing calls back into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the results depend on.
# Parent-vertical spellings folded to one name (any other value -> NULL).
VERTICAL_SPELLINGS = {
    "restaurant": "restaurant",
    "restaurants": "restaurant",
    "shop": "shop",
    "darkstores": "darkstores",
}
# Patterns that split "a, b" into its first and second parent vertical.
FIRST_OF_PAIR = r"(.*),\s"
SECOND_OF_PAIR = r",\s(.*)"
# Target-group tags.
NON_TG = "Non_TG"
UNKNOWN_TG = "Unknown"
CONTROL = "Control"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_vertical(c) -> Column:
    """restaurant/restaurants (any case) -> restaurant, shop, darkstores; else NULL."""
    low = F.lower(_col(c))
    out = None
    for spelling, name in VERTICAL_SPELLINGS.items():
        out = F.when(low == spelling, name) if out is None else out.when(low == spelling, name)
    return out


def regexp_group(c, pattern: str) -> Column:
    """First capture group of ``pattern`` in ``c``; NULL when it does not match."""
    c = _col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))


def split_parent_verticals(concat) -> tuple[Column, Column]:
    """(first, second) parent vertical of a ", "-joined list of parent verticals.

    Empty list -> NULL/NULL.  With a comma the greedy patterns split at the
    last ", " and each side is normalised (three values match neither side).
    Without a comma the single value is normalised and the second is NULL.
    """
    s = _col(concat)
    has_comma = s.like("%,%")
    low = F.lower(s)
    first = (
        F.when(s == "", F.lit(None).cast("string"))
        .when(has_comma, normalize_vertical(regexp_group(low, FIRST_OF_PAIR)))
        .otherwise(F.coalesce(normalize_vertical(low), regexp_group(s, FIRST_OF_PAIR)))
    )
    second = F.when(s == "", F.lit(None).cast("string")).when(
        has_comma, normalize_vertical(regexp_group(low, SECOND_OF_PAIR)))
    return first, second


def round_half_even(c, digits: int) -> Column:
    """numpy ``round(x, digits)``: scale, round half to even, unscale (all in double)."""
    scale = float(10 ** digits)
    return F.bround(_col(c) * F.lit(scale), 0) / F.lit(scale)


def round_half_away(c, digits: int) -> Column:
    """SQL ``ROUND(x, digits)`` on a double: halves go away from zero."""
    scale = float(10 ** digits)
    x = _col(c)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


# Chebyshev fit of erfc (Numerical Recipes, fractional error < 1.2e-7).
_ERFC_COEFFS = (
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
)


def erfc(c) -> Column:
    x = _col(c)
    z = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * z)
    poly = F.lit(_ERFC_COEFFS[-1])
    for coef in reversed(_ERFC_COEFFS[:-1]):
        poly = F.lit(coef) + t * poly
    ans = t * F.exp(-z * z + poly)
    return F.when(x >= 0, ans).otherwise(F.lit(2.0) - ans)


def norm_sf(c) -> Column:
    """Upper tail of the standard normal, 1 - Phi(z)."""
    return F.lit(0.5) * erfc(_col(c) / F.lit(2.0 ** 0.5))


def _edge_crosses(a: Column, b: Column, x: Column, y: Column) -> Column:
    """Even-odd rule: does the ray from (x, y) towards +x cross edge a-b?"""
    ay, by, ax, bx = a["y"], b["y"], a["x"], b["x"]
    return ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)


def point_in_ring(ring, x, y) -> Column:
    """Planar point-in-polygon for one ring ``array<struct<x,y>>`` (closed or not).

    Ray casting over the ring's edges with ``aggregate``; NULL ring or point
    gives NULL.  Points on an edge are not defined (the fixtures avoid them).
    """
    ring, x, y = _col(ring), _col(x), _col(y)
    n = F.size(ring)
    edges = F.sequence(F.lit(0), n - 1)
    inside = F.aggregate(
        edges, F.lit(False),
        lambda acc, i: acc != _edge_crosses(F.get(ring, i), F.get(ring, (i + 1) % n), x, y),
    )
    return F.when(ring.isNotNull() & x.isNotNull() & y.isNotNull() & (n >= 3), inside)


def point_in_rings(rings, x, y) -> Column:
    """Even-odd containment over several rings (outer ring plus holes)."""
    rings, x, y = _col(rings), _col(x), _col(y)
    inside = F.aggregate(rings, F.lit(False), lambda acc, r: acc != F.coalesce(point_in_ring(r, x, y), F.lit(False)))
    return F.when(rings.isNotNull() & x.isNotNull() & y.isNotNull(), inside)


def point_wkt(x, y) -> Column:
    return F.concat(F.lit("POINT("), _col(x).cast("string"), F.lit(" "), _col(y).cast("string"), F.lit(")"))


def equal_width_bin(c, width: float, n_bins: int) -> Column:
    """Index k of the right-closed bin ((k-1)*width, k*width], 1 <= k <= n_bins.

    Edges are the doubles k*width (what ``np.arange(0, stop, width)`` yields);
    a value on an edge goes to the lower bin, 0 and values beyond the last
    edge get NULL, like ``pd.cut``.
    """
    v = _col(c)
    w = F.lit(float(width))
    guess = F.ceil(v / w).cast("bigint")
    k = (
        F.when((guess - 1).cast("double") * w >= v, guess - 1)
        .when(guess.cast("double") * w < v, guess + 1)
        .otherwise(guess)
    )
    return F.when((k >= 1) & (k <= n_bins) & (v <= F.lit(float(n_bins)) * w), k)


def bin_edge(k, width: float) -> Column:
    return _col(k).cast("double") * F.lit(float(width))


def rings_box(rings, f, axis: str) -> Column:
    """``f`` (``F.array_min`` or ``F.array_max``) of one coordinate over all rings."""
    return f(F.transform(_col(rings), lambda r: f(F.transform(r, lambda p: p[axis]))))


def rings_wkt(rings) -> Column:
    """WKT text of a polygon of several rings ``array<array<struct<x,y>>>``."""
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(
        r, lambda p: F.concat(p["x"].cast("string"), F.lit(" "), p["y"].cast("string"))), ", "), F.lit(")"))
    return F.concat(F.lit("POLYGON("), F.array_join(F.transform(_col(rings), ring), ", "), F.lit(")"))
