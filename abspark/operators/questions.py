"""Questions asked of the combined significance table, as small DataFrames.

The inputs are at test-variant grain (a few rows per test), so every result
here is tiny; they are still plain aggregations and joins, never a collect.
Grids of "all bins x all flags" are built by exploding the observed values
(at most two granularities and two flags) and a bin sequence from one
aggregate row, then left-joining the counts, which is how empty cells get 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abspark.functions.columns import CONTROL, bin_edge, equal_width_bin, round_half_even

# Labels the study uses.
OPPOSITE = "Delta - Opposite Direction"
SAME = "Delta - Same Direction"
ALL_TESTS = "All Experiments"
OPPOSITE_TESTS = "Opposite Deltas"
KPIS = ("order_count", "profit")
SHARE_BIN_WIDTH = 0.05   # np.arange(0, 1.05, 0.05): 20 right-closed bins on (0, 1]
SHARE_BINS = 20
LENGTH_BIN_WIDTH = 7     # np.arange(0, 7 * 12, 7): 11 right-closed bins on (0, 77]
LENGTH_BINS = 11
TS_EXP_KEYS = ["entity_id", "country_code", "test_id", "test_name", "test_start_date", "test_end_date",
               "test_length", "first_parent_vertical", "second_parent_vertical", "variant"]


# Presentation order of the written tables (columns, descending where marked).
ORDER = {
    "tests_per_entity": ["-n_tests", "entity_id"],
    "tests_per_entity_vertical": ["entity_id", "-n_tests", "first_parent_vertical"],
    "ts_exp_comparison": ["entity_id", "test_name", "variant"],
    "direction_agreement": ["kpi", "-freq"],
    "significance_agreement": ["kpi", "data_cut"],
    "records_in_treatment": ["-perc_in_treatment", "entity_id", "test_name"],
    "records_in_treatment_bins": ["bin"],
    "treatment_share_bins": ["bin"],
    "significance_by_length": ["kpi", "granularity", "test_length_bin", "sig_flag"],
    "significance_by_length_wide": ["kpi", "test_length_bin"],
    "significance_by_share": ["kpi", "granularity", "share_bin", "sig_flag"],
}


def presented(name: str, df: DataFrame) -> DataFrame:
    """Question table ``name`` in its presentation order (a few rows per test: one sorted file)."""
    keys = ORDER.get(name)
    if not keys:
        return df
    return df.orderBy(*[F.col(k[1:]).desc() if k.startswith("-") else F.col(k) for k in keys]).coalesce(1)


def analysis_rows(sig: DataFrame) -> DataFrame:
    return sig.where(F.col("variant") != CONTROL)


# ---- Q0: overview -------------------------------------------------------------
def overview_stats(p) -> DataFrame:
    a = p.analysis
    key_cols = TS_EXP_KEYS[:7]
    complete = None
    for c in key_cols:
        cond = F.col(c).isNotNull()
        complete = cond if complete is None else complete & cond
    return a.agg(
        (F.count_distinct("test_name") + F.max(F.when(F.col("test_name").isNull(), 1).otherwise(0)))
        .cast("bigint").alias("n_tests"),
        F.floor(F.count(F.when(complete, 1)) / 2).cast("bigint").alias("n_data_points"),
    )


def tests_per_entity(p) -> DataFrame:
    return p.analysis.where(F.col("entity_id").isNotNull()).groupBy("entity_id").agg(
        F.count_distinct("test_name").alias("n_tests"))


def tests_per_entity_vertical(p) -> DataFrame:
    return (p.analysis.where(F.col("entity_id").isNotNull() & F.col("first_parent_vertical").isNotNull())
            .groupBy("entity_id", "first_parent_vertical").agg(F.count_distinct("test_name").alias("n_tests")))


# ---- Q1: ts vs exp ---------------------------------------------------------------
def ts_exp_comparison(p) -> DataFrame:
    """ts and exp result rows of the same test variant side by side (keyed, NULL-safe full outer join)."""
    a = p.analysis
    measures = ["avg_order_count_per_user_delta", "avg_profit_per_user_delta", "order_count_per_user_p_val",
                "profit_per_user_p_val", "order_count_per_user_sig_flag", "profit_per_user_sig_flag"]
    # One row per key and granularity: grouping by the keys (NULLs are equal) pairs them in one aggregate.
    of = lambda m, g: F.max(F.when(F.col("granularity") == g, F.col(m))).alias(f"{m}_{g}")
    out = a.groupBy(*TS_EXP_KEYS).agg(*[of(m, g) for m in measures for g in ("ts", "exp")])
    for kpi in KPIS:
        d_exp, d_ts = F.col(f"avg_{kpi}_per_user_delta_exp"), F.col(f"avg_{kpi}_per_user_delta_ts")
        opposite = ((d_exp < 0) & (d_ts > 0)) | ((d_exp > 0) & (d_ts < 0))
        out = out.withColumn(f"{kpi}_delta_same_dir_flag",
                             F.when(F.coalesce(opposite, F.lit(False)), OPPOSITE).otherwise(SAME))
    return out


def _by_kpi(comparison: DataFrame) -> DataFrame:
    """The comparison with its KPIs as rows: (kpi, delta_direction, ts, exp), the flags at both granularities."""
    rows = [F.struct(F.lit(k).alias("kpi"), F.col(f"{k}_delta_same_dir_flag").alias("delta_direction"),
                     F.col(f"{k}_per_user_sig_flag_ts").alias("ts"), F.col(f"{k}_per_user_sig_flag_exp").alias("exp"))
            for k in KPIS]
    return comparison.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def direction_agreement(p, threshold: float | None = None) -> DataFrame:
    """Per KPI: how often the ts and exp deltas point in opposite directions, and the verdict."""
    threshold = p.cfg.opposite_threshold if threshold is None else threshold
    count = lambda d: F.count_if(F.col("delta_direction") == d)
    per_kpi = _by_kpi(p.ts_exp_comparison).groupBy("kpi").agg(
        F.count(F.lit(1)).alias("__total"), count(OPPOSITE).alias("__opp"),
        F.array(*[F.struct(F.lit(d).alias("delta_direction"), count(d).alias("freq")) for d in (OPPOSITE, SAME)]).alias("__rows"))
    counts = per_kpi.select("kpi", "__total", "__opp", F.explode("__rows").alias("r")).select("*", "r.*").where("freq > 0")
    return counts.select(
        "kpi", "delta_direction", "freq",
        round_half_even(F.col("freq") / F.col("__total"), 4).alias("share"),
        (round_half_even(F.col("__opp") / F.col("__total"), 4) > F.lit(threshold)).alias("many_opposite"),
    )


def significance_agreement(p) -> DataFrame:
    """2x2 Sig/Not Sig matrix of ts vs exp per KPI, over all tests and over opposite-delta tests.

    One pass: grouping sets count every KPI as a whole and by direction, the
    join adds the cuts that no test is in.
    """
    flags = ("Not Sig", "Sig")
    name = lambda a, b: f"ts_{a.lower().replace(' ', '_')}_exp_{b.lower().replace(' ', '_')}"
    cells = [F.count_if((F.col("ts") == a) & (F.col("exp") == b)).alias(name(a, b)) for a in flags for b in flags]
    rows = _by_kpi(p.ts_exp_comparison)
    counted = rows.groupingSets([["kpi"], ["kpi", "delta_direction"]], "kpi", "delta_direction").agg(
        F.grouping("delta_direction").alias("__all"), *cells)
    cut = F.when(F.col("__all") == 1, ALL_TESTS).when(F.col("delta_direction") == OPPOSITE, OPPOSITE_TESTS)
    counted = counted.withColumn("data_cut", cut).where("data_cut is not null")
    kpis = F.explode(F.array(*[F.lit(k) for k in KPIS])).alias("kpi")
    grid = p.ts_exp_comparison.sparkSession.range(1).select(kpis).select(
        "kpi", F.explode(F.array(F.lit(ALL_TESTS), F.lit(OPPOSITE_TESTS))).alias("data_cut"))
    return grid.join(counted, ["kpi", "data_cut"], "left").select(
        "kpi", "data_cut", *[F.coalesce(name(a, b), F.lit(0)).alias(name(a, b)) for a in flags for b in flags])


# ---- Q1': share of records / orders in treatment ---------------------------------
def records_in_treatment(p) -> DataFrame:
    # As in the study, which turns client ids and flags into text before it
    # counts: a NULL id counts, a NULL flag belongs to no counted column but
    # keeps its test in the table.
    raw = p.gated_kpis_exp.where(F.col("entity_id").isNotNull() & F.col("test_name").isNotNull())
    flag = lambda f: F.nullif(F.count_if(F.col("session_in_treatment_flag") == f), F.lit(0)).alias(f)
    piv = raw.groupBy("entity_id", "test_name").agg(flag("N"), flag("Unknown"), flag("Y"))
    n_n, n_y = F.col("N").cast("bigint"), F.col("Y").cast("bigint")
    perc = F.when(n_n.isNotNull() & n_y.isNotNull() & ((n_n + n_y) > 0),
                  round_half_even(n_y / (n_y + n_n), 4)).otherwise(F.lit(1.0))
    return piv.select("entity_id", "test_name", n_n.alias("n_n"), F.col("Unknown").cast("bigint").alias("n_unknown"),
                      n_y.alias("n_y"), perc.alias("perc_in_treatment"))


def _describe(df: DataFrame, c: str) -> DataFrame:
    """count, mean, std, min, quartiles (linear interpolation), max; 6 decimals like a display."""
    q = F.percentile(F.col(c), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                 F.min(c).alias("min"), q.alias("__q"), F.max(c).alias("max"))
    return out.select(
        "count", round_half_even("mean", 6).alias("mean"), round_half_even("std", 6).alias("std"),
        F.col("min").cast("double").alias("min"),
        round_half_even(F.col("__q")[0], 6).alias("p25"), round_half_even(F.col("__q")[1], 6).alias("p50"),
        round_half_even(F.col("__q")[2], 6).alias("p75"), F.col("max").cast("double").alias("max"))


def _share_bins(df: DataFrame, c: str) -> DataFrame:
    counts = df.select(equal_width_bin(c, SHARE_BIN_WIDTH, SHARE_BINS).alias("bin")).where("bin IS NOT NULL") \
        .groupBy("bin").agg(F.count(F.lit(1)).alias("freq"))
    grid = df.sparkSession.range(1, SHARE_BINS + 1).select(F.col("id").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin", bin_edge(F.col("bin") - 1, SHARE_BIN_WIDTH).alias("bin_lo"),
        bin_edge("bin", SHARE_BIN_WIDTH).alias("bin_hi"), F.coalesce("freq", F.lit(0)).alias("freq"))


def records_in_treatment_summary(p) -> DataFrame:
    return _describe(records_in_treatment(p), "perc_in_treatment")


def records_in_treatment_bins(p) -> DataFrame:
    return _share_bins(records_in_treatment(p), "perc_in_treatment")


def treatment_share_tests(p) -> DataFrame:
    return p.analysis.where(F.col("granularity") == "exp").select(
        "entity_id", "test_name", "perc_treatment_orders").distinct()


def treatment_share_summary(p) -> DataFrame:
    return _describe(treatment_share_tests(p), "perc_treatment_orders")


def treatment_share_bins(p) -> DataFrame:
    return _share_bins(treatment_share_tests(p), "perc_treatment_orders")


# ---- Q2 / Q3: significance by test length and by treatment share --------------------
def _grid(a: DataFrame, flag: str, bins: list) -> DataFrame:
    """Observed granularities x all bins x observed flags, from one aggregate row (no join)."""
    seen = a.agg(F.collect_set("granularity").alias("g"), F.collect_set(flag).alias("f"))
    return (seen.select(F.explode("g").alias("granularity"), "f")
            .select("granularity", F.explode(F.array(*[F.lit(b) for b in bins])).alias("bin"), "f")
            .select("granularity", "bin", F.explode("f").alias("sig_flag")))


def significance_by_length(p) -> DataFrame:
    a = p.analysis
    parts = []
    for kpi in KPIS:
        flag, pval = f"{kpi}_per_user_sig_flag", f"{kpi}_per_user_p_val"
        binned = a.select("granularity", F.col(flag).alias("sig_flag"), pval,
                          equal_width_bin("test_length", LENGTH_BIN_WIDTH, LENGTH_BINS).alias("bin"))
        counts = binned.where("bin IS NOT NULL").groupBy("granularity", "bin", "sig_flag").agg(
            F.count(pval).alias("freq"))
        cells = _grid(a, flag, list(range(1, LENGTH_BINS + 1))).join(
            counts, ["granularity", "bin", "sig_flag"], "left").withColumn(
            "freq", F.coalesce("freq", F.lit(0)).cast("bigint"))
        odds = cells.groupBy("granularity", "bin").agg(
            F.sum(F.when(F.col("sig_flag") == "Sig", F.col("freq")).otherwise(0)).alias("__sig"),
            F.sum(F.when(F.col("sig_flag") == "Not Sig", F.col("freq")).otherwise(0)).alias("__not"))
        # Sig count over Not-Sig count (odds, as the study computes it): n/0 -> inf, 0/0 -> 0.
        sig_pct = (F.when(F.col("__not") > 0, round_half_even(F.col("__sig") / F.col("__not"), 3))
                   .when(F.col("__sig") > 0, F.lit(float("inf"))).otherwise(F.lit(0.0)))
        # The share of Sig among all, which the study's column name suggests.
        both = F.col("__sig") + F.col("__not")
        share = F.when(both > 0, round_half_even(F.col("__sig") / both, 3))
        res = cells.join(odds.select("granularity", "bin", sig_pct.alias("sig_pct"), share.alias("sig_share")),
                         ["granularity", "bin"])
        parts.append(res.select(
            F.lit(kpi).alias("kpi"), "granularity", F.col("bin").cast("bigint").alias("test_length_bin"),
            (F.col("bin") * LENGTH_BIN_WIDTH - LENGTH_BIN_WIDTH).cast("bigint").alias("length_lo"),
            (F.col("bin") * LENGTH_BIN_WIDTH).cast("bigint").alias("length_hi"), "sig_flag", "freq", "sig_pct",
            "sig_share"))
    return parts[0].unionByName(parts[1])


def significance_by_length_wide(p) -> DataFrame:
    """The length table as the study shows it: a row per KPI and length bin, columns per granularity and flag.

    The pivot's values are declared, so its columns do not depend on the data
    and no job runs to find them; what never occurs is NULL.
    """
    long = significance_by_length(p)
    cell = F.concat_ws("_", "granularity", F.lower(F.replace("sig_flag", F.lit(" "), F.lit("_"))))
    cells = [f"{g}_{f}" for g in ("exp", "ts") for f in ("not_sig", "sig")]
    return long.withColumn("cell", cell).groupBy("kpi", "test_length_bin", "length_lo", "length_hi").pivot("cell", cells).agg(
        F.sum("freq").alias("freq"), F.sum("sig_pct").alias("sig_pct"))


SHARE_LEVELS = ("(0, 0.2]", "(0.2, 0.5]", "(0.5, 1]")


def significance_by_share(p) -> DataFrame:
    a = p.analysis
    lo, hi = p.cfg.share_low, p.cfg.share_high
    v = F.col("perc_treatment_orders")
    share_bin = (F.when((v > 0) & (v <= lo), SHARE_LEVELS[0]).when((v > lo) & (v <= hi), SHARE_LEVELS[1])
                 .when((v > hi) & (v <= 1), SHARE_LEVELS[2]))
    parts = []
    for kpi in KPIS:
        flag = f"{kpi}_per_user_sig_flag"
        counts = a.select("granularity", F.col(flag).alias("sig_flag"), "variant", share_bin.alias("bin")) \
            .where("bin IS NOT NULL").groupBy("granularity", "bin", "sig_flag").agg(F.count("variant").alias("freq"))
        cells = _grid(a, flag, list(SHARE_LEVELS)).join(counts, ["granularity", "bin", "sig_flag"], "left") \
            .withColumn("freq", F.coalesce("freq", F.lit(0)).cast("bigint"))
        totals = cells.groupBy("granularity", "bin").agg(F.sum("freq").alias("__total"))
        res = cells.join(totals, ["granularity", "bin"]).select(
            F.lit(kpi).alias("kpi"), "granularity", F.col("bin").alias("share_bin"), "sig_flag", "freq",
            F.when(F.col("__total") > 0, round_half_even(F.col("freq") / F.col("__total"), 4)).alias("prop"))
        parts.append(res)
    return parts[0].unionByName(parts[1])
