"""Per-variant means, deltas and two-sided Mann-Whitney U tests as Spark aggregations.

The study slices a frame per test and variant in a Python loop and calls a
library test on two arrays.  Here one plan does every test at once:

1. one histogram per (granularity, test variant, metric, converted?, value):
   the only pass over the KPI table, a partial aggregate, so the data shrinks
   to distinct values before any shuffle; everything below reads it;
2. means are sums of value x count; deltas compare them with Control's;
3. for the rank test a test's values are dealt into RANK_RANGES ranges of
   even size by a quantile sketch; Control's totals give every range its
   offset, and a running sum inside a range tells of each value how many
   Control users are below and beside it (its mid rank among Control), for
   all variants at once, so no task sorts a whole test;
4. one aggregate per variant sums those placements (that is U), the sizes and
   the tie term sum(t^3 - t);
5. the tie- and continuity-corrected normal approximation and its two-sided
   p-value are column expressions.

The exact distribution is used, like the library default, when one sample
has at most ``exact_max_n`` values and nothing is tied: a table (m, n, u,
P(U >= u)) of the sizes that occur, joined.  No Python runs in any task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abspark.config import PipelineConfig
from abspark.functions.columns import CONTROL, norm_sf, round_half_even
from abspark.operators.relational import broadcast_if_small

GROUP = ["entity_id", "test_id"]
SIG_KEYS = ["entity_id", "country_code", "test_id", "test_name", "test_start_date", "test_end_date", "test_length",
            "first_parent_vertical", "second_parent_vertical", "variant"]
METRICS = ("order_count_per_user", "profit_per_user")
RANK_RANGES = 256  # a square


def value_histogram(df: DataFrame, keys: list[str], metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """(keys, metric, conv, value, n): rows of ``df`` counted by metric value; conv: revenue > 0."""
    conv = F.coalesce(F.col("revenue_per_user") > 0, F.lit(False)) if "revenue_per_user" in df.columns else F.lit(False)
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
    stacked = df.select(*keys, conv.alias("conv"), pairs.alias("mv")).select(*keys, "conv", "mv.metric", "mv.value")
    return stacked.groupBy(*keys, "metric", "conv", "value").agg(F.count(F.lit(1)).alias("n"))


def _means_of(hist: DataFrame, group: list[str]) -> DataFrame:
    """Means per (group, variant) from exact decimal sums (cent values): the order of summation does not matter."""
    total = F.col("value").cast("decimal(38,2)") * F.col("n")
    aggs = []
    for m in METRICS:
        for name, cond in ((f"__conv_{m}", F.col("conv")), (f"__mean_{m}", F.lit(True))):
            own = (F.col("metric") == m) & cond & F.col("value").isNotNull()
            mean = F.sum(F.when(own, total)).cast("double") / F.nullif(F.sum(F.when(own, F.col("n"))), F.lit(0)).cast("double")
            aggs.append(mean.alias(name))
    out = hist.groupBy(*group, "variant").agg(*aggs)
    return out.select(
        *group, "variant",
        *[c for m in METRICS for c in (
            round_half_even(f"__conv_{m}", 4).alias(f"avg_{m}_conv_only"),
            round_half_even(f"__mean_{m}", 4).alias(f"avg_{m}"),
            F.col(f"__mean_{m}"),
        )],
    )


def variant_means(df: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Means per (entity, test, variant): all users and converted users (revenue > 0), 4 decimals."""
    return _means_of(value_histogram(df, [*group, "variant"]), group)


def variant_deltas(means: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Relative delta of each variant's mean against its test's Control mean (NULL if that mean is 0)."""
    ctrl = means.where(F.col("variant") == CONTROL).select(
        *group, *[F.col(f"__mean_{m}").alias(f"__ctrl_{m}") for m in METRICS])
    j = means.join(ctrl, group, "left")
    cols = []
    for m in METRICS:
        delta = (F.col(f"__mean_{m}") - F.col(f"__ctrl_{m}")) / F.nullif(F.abs(F.col(f"__ctrl_{m}")), F.lit(0.0))
        cols.append(F.when(F.col("variant") != CONTROL, round_half_even(delta, 4)).alias(f"avg_{m}_delta"))
    return j.select(*group, "variant", *cols)


def u_distribution(sizes: DataFrame, most: int) -> DataFrame:
    """(m, n, u, p_upper): P(U >= u) of the Mann-Whitney statistic without ties, for every row (m, n) of ``sizes``.

    ``m`` is the smaller sample, at most ``most``.  The number of ways to reach
    U = k is the coefficient of q^k in the product over i = 1..m of
    (1 - q^(n+i)) / (1 - q^i).  Each factor is one step over rows (m, n, k, c):
    the numerator adds every row once more, shifted and negative, the
    denominator is a running sum along k modulo i.
    """
    span = F.sequence(F.lit(0).cast("bigint"), F.col("m") * F.col("n"))
    rows = sizes.select("m", "n", F.explode(span).alias("k")).withColumn("c", F.when(F.col("k") == 0, 1.0).otherwise(0.0))
    for i in range(1, most + 1):
        own = F.struct("k", "c", F.lit(True).alias("own"))
        shifted = F.struct((F.col("k") + F.col("n") + i).alias("k"), (-F.col("c")).alias("c"), F.lit(False).alias("own"))
        parts = rows.select("m", "n", F.explode(F.when(F.col("m") >= i, F.array(own, shifted)).otherwise(F.array(own))).alias("r"))
        parts = parts.select("m", "n", "r.*").where(F.col("k") <= F.col("m") * F.col("n"))
        along = Window.partitionBy("m", "n", F.pmod("k", F.lit(i))).orderBy("k").rangeBetween(Window.unboundedPreceding, 0)
        summed = F.when(F.col("m") >= i, F.sum("c").over(along)).otherwise(F.col("c"))
        rows = parts.select("m", "n", "k", summed.alias("c"), "own").where("own").drop("own")
    upper = Window.partitionBy("m", "n").orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("m", "n", F.col("k").alias("u"), (F.sum("c").over(upper) / F.sum("c").over(Window.partitionBy("m", "n"))).alias("p_upper"))


def rank_ranges(counts: DataFrame, g: list[str]) -> DataFrame:
    """``counts`` with ``__range``: its group's values dealt into RANK_RANGES ranges of about equal numbers of rows.

    The splitters come from one quantile sketch a group (combined map-side), so
    the ranges are even however the values are distributed.  A value finds its
    range in two steps over some 2 * sqrt(RANK_RANGES) splitters; equal values
    share a range.
    """
    step = math.isqrt(RANK_RANGES)
    shares = [i / RANK_RANGES for i in range(1, RANK_RANGES)]
    cuts = counts.groupBy(*g).agg(F.percentile_approx("value", shares, 8 * RANK_RANGES).alias("__cuts"))
    below = lambda part: F.size(F.filter(part, lambda x: x < F.col("value")))
    coarse = F.transform(F.sequence(F.lit(step), F.lit(RANK_RANGES - 1), F.lit(step)), lambda i: F.element_at("__cuts", i))
    cuts = cuts.withColumn("__coarse", coarse)
    dealt = counts.join(cuts, g).withColumn("__at", below(F.col("__coarse")) * step)
    dealt = dealt.withColumn("__range", F.col("__at") + below(F.slice("__cuts", F.col("__at") + 1, F.lit(step - 1))))
    return dealt.drop("__cuts", "__coarse", "__at")


def _placements(counts: DataFrame, g: list[str]) -> DataFrame:
    """``counts`` (g, variant, value, n) with the Control rows of the same value (``n_c``) and below it (``below``)."""
    dealt = rank_ranges(counts, g)
    control = F.when(F.col("variant") == CONTROL, F.col("n")).otherwise(0)
    sums = dealt.groupBy(*g, "__range").agg(F.sum(control).alias("__in"))  # RANK_RANGES rows a group at most
    before = Window.partitionBy(*g).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offset = sums.select(*g, "__range", F.coalesce(F.sum("__in").over(before), F.lit(0)).alias("__offset"))
    in_order = Window.partitionBy(*g, "__range").orderBy("value")
    same = F.sum(control).over(in_order.rangeBetween(Window.currentRow, Window.currentRow))
    up_to = F.sum(control).over(in_order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    placed = dealt.withColumns({"n_c": same, "__upto": up_to})
    return placed.join(offset, [*g, "__range"]).select(
        *g, "variant", "value", "n", "n_c", (F.col("__offset") + F.col("__upto") - F.col("n_c")).alias("below"))


def _rank_tests(hist: DataFrame, group: list[str], cfg: PipelineConfig) -> DataFrame:
    """Two-sided Mann-Whitney U test of each non-Control variant against Control, per group and metric."""
    g = [*group, "metric"]
    counts = hist.where(F.col("value").isNotNull() & ~F.isnan(F.col("value"))).groupBy(*g, "variant", "value").agg(
        F.sum("n").alias("n"))
    cubed = lambda t: t.cast("double") * t.cast("double") * t.cast("double") - t.cast("double")
    control = counts.where(F.col("variant") == CONTROL).groupBy(*g).agg(
        F.sum("n").cast("double").alias("__n2"), F.sum(cubed(F.col("n"))).alias("__ties"))
    # A value's mid rank among Control is its placement; U is the sum of a variant's placements.
    placement = F.col("below").cast("double") + F.col("n_c").cast("double") / 2.0
    tests = _placements(counts, g).where(F.col("variant") != CONTROL).groupBy(*g, "variant").agg(
        F.sum("n").cast("double").alias("n1"), F.sum(F.col("n").cast("double") * placement).alias("u1"),
        F.sum(cubed(F.col("n") + F.col("n_c")) - cubed(F.col("n_c"))).alias("__more"))
    tests = tests.join(control, g, "left").select(
        *g, "variant", "n1", F.coalesce("__n2", F.lit(0.0)).alias("n2"), "u1",
        (F.coalesce("__ties", F.lit(0.0)) + F.col("__more")).alias("tie_term"))
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    u = F.greatest(F.col("u1"), n1 * n2 - F.col("u1"))
    s = F.sqrt(n1 * n2 / 12.0 * ((n + 1.0) - F.try_divide("tie_term", n * (n - 1.0))))
    z = (u - n1 * n2 / 2.0 - 0.5) / F.nullif(s, F.lit(0.0))
    p_asym = F.when(s == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * norm_sf(z))))
    exact = (F.least(n1, n2) <= cfg.exact_max_n) & (F.col("tie_term") == 0)
    valid = (n1 > 0) & (n2 > 0)
    of_exact = lambda c: F.when(valid & exact, c.cast("bigint"))
    found = tests.select(
        *g, "variant", F.col("u1").alias("u_statistic"), "n1", "n2", "tie_term",
        F.when(valid, F.when(exact, F.lit("exact")).otherwise(F.lit("asymptotic"))).alias("method"),
        F.when(valid & ~exact, p_asym).alias("__p_asym"),
        of_exact(F.least(n1, n2)).alias("__m"), of_exact(F.greatest(n1, n2)).alias("__n"), of_exact(u).alias("__u"))
    # Few sizes need the distribution; where none does, the adaptive planner drops these steps.
    sizes = found.where("__m is not null").select(F.col("__m").alias("m"), F.col("__n").alias("n")).distinct()
    dist = u_distribution(sizes, cfg.exact_max_n)
    joined = found.join(dist, (found["__m"] == dist["m"]) & (found["__n"] == dist["n"]) & (found["__u"] == dist["u"]), "left")
    p = F.when(F.col("__m").isNotNull(), F.least(F.lit(1.0), 2.0 * F.col("p_upper"))).otherwise(F.col("__p_asym"))
    return joined.select(
        *g, "variant", F.col("n1").cast("bigint").alias("n1"), F.col("n2").cast("bigint").alias("n2"),
        "u_statistic", "tie_term", "method", round_half_even(p, 4).alias("p_value"))


def mann_whitney_stacked(df: DataFrame, metrics: tuple[str, ...], cfg: PipelineConfig,
                         group: list[str] = GROUP) -> DataFrame:
    """The rank test of several metrics in one pass (column ``metric``)."""
    return _rank_tests(value_histogram(df, [*group, "variant"], metrics), group, cfg)


def mann_whitney(df: DataFrame, metric: str, cfg: PipelineConfig) -> DataFrame:
    """Two-sided Mann-Whitney U test of each non-Control variant against Control, per (entity, test)."""
    return mann_whitney_stacked(df, (metric,), cfg).drop("metric")


def _significance(hist: DataFrame, group: list[str], cfg: PipelineConfig) -> DataFrame:
    """Means, deltas and p-values of both KPIs per distinct test-variant key (``group`` adds granularity)."""
    extra = [c for c in group if c not in GROUP]
    keys = [*group, "variant"]
    # Every table joined here is an aggregate with one row per test variant;
    # measuring one would compute it twice, so the adaptive planner decides.
    rows = hist.select(*extra, *SIG_KEYS).distinct()
    means = _means_of(hist, group)
    deltas = variant_deltas(means, group)
    tests = _rank_tests(hist, group, cfg)
    p_vals = tests.groupBy(*keys).agg(*[
        F.max(F.when(F.col("metric") == m, F.col("p_value"))).alias(f"{m}_p_val") for m in METRICS])
    out = (rows.join(means.drop(*[f"__mean_{m}" for m in METRICS]), keys, "left")
           .join(deltas, keys, "left")
           .join(p_vals, keys, "left"))
    return out.select(
        *SIG_KEYS,
        "avg_order_count_per_user_conv_only", "avg_order_count_per_user", "avg_order_count_per_user_delta",
        "order_count_per_user_p_val",
        "avg_profit_per_user_conv_only", "avg_profit_per_user", "avg_profit_per_user_delta", "profit_per_user_p_val",
        *extra,
    )


def significance(df: DataFrame, granularity: str, cfg: PipelineConfig) -> DataFrame:
    """One row per distinct test variant key: means, deltas and p-values of both KPIs at one granularity."""
    hist = value_histogram(df.withColumn("granularity", F.lit(granularity)), ["granularity", *SIG_KEYS])
    return _significance(hist, ["granularity", *GROUP], cfg)


def kpi_histogram(kpis: DataFrame) -> DataFrame:
    """Both granularities' histograms: experiment level (all rows), treatment scope (rows with flag 'Y').

    Each row is tagged 'exp', and also 'ts' when it is in treatment (one
    explode, no second scan); every statistic then groups by granularity.
    """
    tagged = kpis.withColumn("granularity", F.explode(
        F.when(F.col("session_in_treatment_flag") == "Y", F.array(F.lit("exp"), F.lit("ts")))
        .otherwise(F.array(F.lit("exp")))))
    return value_histogram(tagged, ["granularity", *SIG_KEYS])


def significance_both(hist: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The statistics of :func:`kpi_histogram`'s table, both granularities."""
    return _significance(hist, ["granularity", *GROUP], cfg)


def sig_flag(p_col: str, alpha: float):
    return F.when(F.col(p_col) <= F.lit(alpha), "Sig").otherwise("Not Sig")


def combine(both: DataFrame, share: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Significance flags at level ``alpha`` (a missing p-value is 'Not Sig'), and the share gate."""
    both = both.select(
        "*",
        sig_flag("order_count_per_user_p_val", cfg.alpha).alias("order_count_per_user_sig_flag"),
        sig_flag("profit_per_user_p_val", cfg.alpha).alias("profit_per_user_sig_flag"),
    )
    return both.join(broadcast_if_small(share), ["entity_id", "country_code", "test_id"], "inner")
