"""Rank-test aggregate against a plain-Python statement of the library's default method."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from abspark.config import PipelineConfig
from abspark.operators import stats


def _ranks(values):
    order = sorted(values)
    first = {}
    for i, v in enumerate(order):
        first.setdefault(v, i)
    counts = {v: order.count(v) for v in set(order)}
    return {v: first[v] + (counts[v] + 1) / 2 for v in counts}, counts


def reference_p(x, y):
    """Two-sided Mann-Whitney p: exact (by enumeration) when min size <= 8 and no ties, else normal approx."""
    n1, n2 = len(x), len(y)
    rank, counts = _ranks(list(x) + list(y))
    r1 = sum(rank[v] for v in x)
    u1 = r1 - n1 * (n1 + 1) / 2
    u = max(u1, n1 * n2 - u1)
    ties = any(c > 1 for c in counts.values())
    if min(n1, n2) <= 8 and not ties:
        pooled = list(range(n1 + n2))
        ge = total = 0
        for comb in itertools.combinations(pooled, n1):
            s = sum(comb) + n1  # ranks are 1-based
            uu = s - n1 * (n1 + 1) / 2
            total += 1
            ge += uu >= u
        return min(1.0, 2 * ge / total)
    t = sum(c ** 3 - c for c in counts.values())
    n = n1 + n2
    s = math.sqrt(n1 * n2 / 12 * ((n + 1) - t / (n * (n - 1))))
    if s == 0:
        return 1.0
    z = (u - n1 * n2 / 2 - 0.5) / s
    return min(1.0, max(0.0, math.erfc(z / math.sqrt(2))))


def _frame(spark, groups):
    rows = []
    for test_id, (x, y) in enumerate(groups):
        rows += [("E", test_id, "Variation1", float(v)) for v in x]
        rows += [("E", test_id, "Control", float(v)) for v in y]
    return spark.createDataFrame(rows, "entity_id string, test_id long, variant string, m double")


def test_against_reference(spark):
    rng = np.random.default_rng(3)
    groups = [
        ([1, 2, 3], [4, 5, 6, 7]),                        # exact, complete separation
        ([1.5, 9, 3.25], [2, 8, 4, 7, 6]),                # exact, interleaved
        ([0, 0, 1, 2], [0, 1, 1, 3, 3]),                  # ties -> normal approximation
        ([5, 5, 5], [5, 5]),                              # all tied -> p = 1
        (list(rng.integers(0, 5, 40)), list(rng.integers(0, 6, 55))),
        (list(np.round(rng.normal(10, 3, 30), 2)), list(np.round(rng.normal(11, 3, 25), 2))),
        (list(range(9)), list(range(4, 14))),             # sizes > 8 without ties
    ]
    df = _frame(spark, groups)
    out = {r.test_id: r for r in stats.mann_whitney(df, "m", PipelineConfig()).collect()}
    for i, (x, y) in enumerate(groups):
        want = reference_p([float(v) for v in x], [float(v) for v in y])
        got = out[i].p_value
        assert abs(got - want) < 1e-4 + 1e-9, (i, got, want, out[i].method)


def test_symmetry_and_shift(spark):
    x, y = [1.0, 4.0, 2.5, 8.0, 3.0, 9.5, 7.25, 6.0, 11.0], [2.0, 5.0, 6.5, 10.0, 12.0, 13.0, 3.5, 0.5, 4.5, 7.0]
    a = stats.mann_whitney(_frame(spark, [(x, y)]), "m", PipelineConfig()).collect()[0]
    b = stats.mann_whitney(_frame(spark, [(y, x)]), "m", PipelineConfig()).collect()[0]
    shifted = [v + 100 for v in x]
    c = stats.mann_whitney(_frame(spark, [(shifted, [v + 100 for v in y])]), "m", PipelineConfig()).collect()[0]
    assert a.p_value == b.p_value == c.p_value
    assert a.u_statistic + b.u_statistic == len(x) * len(y)


def test_missing_control_gives_null(spark):
    df = spark.createDataFrame([("E", 1, "Variation1", 1.0), ("E", 1, "Variation1", 2.0)],
                               "entity_id string, test_id long, variant string, m double")
    out = stats.mann_whitney(df, "m", PipelineConfig()).collect()
    assert len(out) == 1 and out[0].p_value is None and out[0].n2 == 0


@pytest.mark.parametrize("m,n", [(1, 1), (2, 3), (3, 8), (8, 8), (4, 20)])
def test_u_distribution_by_enumeration(spark, m, n):
    sizes = spark.createDataFrame([(m, n), (1, 4)], "m long, n long")
    got = {r.u: r.p_upper for r in stats.u_distribution(sizes, 8).where((F.col("m") == m) & (F.col("n") == n)).collect()}
    counts = [0] * (m * n + 1)
    for chosen in itertools.combinations(range(m + n), m):
        counts[sum(chosen) - m * (m - 1) // 2] += 1
    total = math.comb(m + n, m)
    assert len(got) == m * n + 1
    for u in range(m * n + 1):
        assert abs(got[u] - sum(counts[u:]) / total) < 1e-12


@pytest.mark.parametrize("power", [1, 6])
def test_ranges_are_even_however_values_are_spread(spark, power):
    """Heavy tails: equal widths would put nearly all values into one range."""
    rows = spark.range(60_000).select(
        F.lit("E").alias("g"), F.pow(F.rand(3), F.lit(-power)).alias("value"), F.lit(1).alias("n"))
    sizes = stats.rank_ranges(rows, ["g"]).groupBy("__range").count()
    most, ranges = sizes.agg(F.max("count"), F.count("*")).first()
    assert most <= 4 * 60_000 / stats.RANK_RANGES and ranges == stats.RANK_RANGES
    # Ranges follow the values' order.
    ends = stats.rank_ranges(rows, ["g"]).groupBy("__range").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).orderBy("__range").collect()
    assert all(a.hi < b.lo for a, b in zip(ends, ends[1:]))


def test_many_values_in_many_ranges(spark):
    """Ties within and across variants, spread over all ranges."""
    rng = np.random.default_rng(8)
    groups = [(list(np.round(rng.pareto(1, 700), 1)), list(np.round(rng.pareto(1, 900), 1))),
              (list(np.round(rng.normal(0, 1, 500), 3)), list(np.round(rng.normal(0.2, 1, 400), 3)))]
    out = {r.test_id: r for r in stats.mann_whitney(_frame(spark, groups), "m", PipelineConfig()).collect()}
    for i, (x, y) in enumerate(groups):
        assert abs(out[i].p_value - reference_p([float(v) for v in x], [float(v) for v in y])) < 1e-4 + 1e-9
        assert out[i].u_statistic == sum((a > b) + (a == b) / 2 for a in x for b in y)
