"""Experiment-setup operators: valid tests, target groups, zones, schemes, geography.

All inputs here are dimension-sized (tests x variants x vendor lists), so the
plans are cheap; the point is to emit small, de-duplicated key tables that
the fact-side operators can semi-join or broadcast against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abspark.config import PipelineConfig
from abspark.functions.columns import split_parent_verticals
from abspark.operators.relational import first_row_per_key, ordered_concat

TEST_COLS = ["entity_id", "country_code", "test_start_date", "test_end_date", "test_name", "test_id"]


def _setup_level_filter(setups: DataFrame, cfg: PipelineConfig) -> DataFrame:
    start = F.to_date("test_start_date")
    end = F.to_date("test_end_date")
    return setups.where(
        (start >= F.lit(cfg.start_floor).cast("date"))
        & (F.datediff(end, start) >= cfg.min_days)
        & (F.col("is_active") == F.lit(False))
        & (F.col("misconfigured") == F.lit(False))
        & F.col("schedule.id").isNull()
        & F.col("customer_condition.id").isNull()
    )


def eligible_setups(setups: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Setup rows of ended, well-configured, unconditioned tests of >= min_days.

    The study also requires a matching vendor and a parent vertical of the
    setup row itself, written on the unnested lists (``CROSS JOIN UNNEST`` +
    ``IS NOT NULL``).  ``exists`` over the row's own arrays says the same and
    keeps one row per setup instead of the vendor x vertical product.
    """
    return _setup_level_filter(setups, cfg).where(
        F.exists("matching_vendor_ids", lambda v: v.isNotNull())
        & F.exists("test_vertical_parents", lambda p: p.isNotNull()))


def valid_experiments(setups: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return eligible_setups(setups, cfg).select("entity_id", "country_code", "test_id", "test_name").distinct()


def experiment_zones(setups: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return eligible_setups(setups, cfg).select(*TEST_COLS, F.explode("zone_ids").alias("zone_id")).distinct()


def variant_schemes(setups: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Distinct (test, target group TG<priority>, variant, price scheme)."""
    return (
        eligible_setups(setups, cfg)
        .select(
            *TEST_COLS,
            F.concat(F.lit("TG"), F.col("priority")).alias("target_group"),
            F.col("variation_group").alias("variant"),
            "price_scheme_id",
        )
        .distinct()
    )


def variant_scheme_concat(schemes: DataFrame) -> DataFrame:
    """Per test: "TGn | variant | scheme" strings joined by ", " (sorted, deterministic)."""
    item = F.concat(F.col("target_group"), F.lit(" | "), F.col("variant"), F.lit(" | "), F.col("price_scheme_id"))
    return schemes.groupBy("entity_id", "country_code", "test_name", "test_id").agg(
        ordered_concat(item).alias("tg_var_scheme_concat"))


def target_groups(setups: DataFrame, vendors: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """One row per test x vendor: its target group TGn, parent verticals and vertical type.

    TGn is the dense rank of vendor_group_id within (entity, test_name),
    computed on the distinct group ids only.  A vendor listed in several
    groups keeps the lowest vendor_group_id; ties are broken by parent
    vertical, then test id and dates.  That first-row choice runs before the
    parent verticals are listed, so one parent vertical per vendor remains
    (the study's behaviour); ``cfg.multi_vertical`` keeps every parent
    vertical of the winning group instead.
    """
    rows = (
        eligible_setups(setups, cfg)
        .select(*TEST_COLS, "vendor_group_id", "test_vertical_parents",
                F.explode("matching_vendor_ids").alias("vendor_code"))
        .where(F.col("vendor_code").isNotNull())
        .select(*TEST_COLS, "vendor_group_id", "vendor_code",
                F.explode("test_vertical_parents").alias("parent_vertical"))
        .where(F.col("parent_vertical").isNotNull())
    )
    ranks = (
        rows.select("entity_id", "test_name", "vendor_group_id").distinct()
        .select(
            F.col("entity_id").alias("__r_entity"), F.col("test_name").alias("__r_test"),
            F.col("vendor_group_id").alias("__r_group"),
            F.concat(F.lit("TG"), F.dense_rank().over(
                Window.partitionBy("entity_id", "test_name").orderBy(F.col("vendor_group_id").asc_nulls_first())))
            .alias("tg_name"))
    )
    vendor_key = ["entity_id", "country_code", "test_name", "vendor_code"]
    if cfg.multi_vertical:
        # The winning group is the first one, a NULL group before all others.
        best = rows.groupBy(*vendor_key).agg(
            F.min(F.struct(F.col("vendor_group_id").isNotNull().alias("known"), "vendor_group_id")).alias("__best"))
        best = best.select(*[F.col(k).alias(f"__b_{k}") for k in vendor_key], "__best.vendor_group_id")
        same = rows["vendor_group_id"].eqNullSafe(best["vendor_group_id"])
        for k in vendor_key:
            same = same & rows[k].eqNullSafe(best[f"__b_{k}"])
        kept = rows.join(best, same, "left_semi").distinct()
    else:
        kept = first_row_per_key(
            rows, vendor_key,
            ["vendor_group_id", "parent_vertical", "test_id", "test_start_date", "test_end_date"])
    kept = kept.join(
        ranks, kept.entity_id.eqNullSafe(ranks["__r_entity"]) & kept.test_name.eqNullSafe(ranks["__r_test"])
        & kept.vendor_group_id.eqNullSafe(ranks["__r_group"]), "left").drop("__r_entity", "__r_test", "__r_group")
    group_cols = TEST_COLS + ["vendor_group_id", "vendor_code", "tg_name"]
    agg = kept.groupBy(*group_cols).agg(ordered_concat("parent_vertical").alias("parent_vertical_concat"))
    first, second = split_parent_verticals("parent_vertical_concat")
    v = vendors.select(
        F.col("global_entity_id").alias("__v_entity"), F.col("vendor_id").alias("__v_vendor"), "vertical_type")
    out = agg.select(*group_cols, "parent_vertical_concat",
                     first.alias("first_parent_vertical"), second.alias("second_parent_vertical"))
    return (
        out.join(v, (out.entity_id == v.__v_entity) & (out.vendor_code == v.__v_vendor), "left")
        .drop("__v_entity", "__v_vendor")
    )


def zone_geography(countries: DataFrame, zones: DataFrame) -> DataFrame:
    """Active zones (in active cities) of each test, with their polygon rings."""
    geo = (
        countries
        .select("country_code", F.explode_outer("platforms").alias("p"), "cities")
        .select("country_code", F.col("p.entity_id").alias("entity_id"), F.explode_outer("cities").alias("ci"))
        # The city's fields apart from its zones, so that no zone's row carries the whole list.
        .select("country_code", "entity_id", F.col("ci.name").alias("city_name"), F.col("ci.id").alias("city_id"),
                F.col("ci.is_active").alias("city_active"), F.col("ci.zones").alias("zones"))
        .select("country_code", "entity_id", "city_name", "city_id", "city_active", F.explode_outer("zones").alias("zo"))
        .where(F.col("zo.is_active") & F.col("city_active"))
        .select(
            "entity_id", "country_code", "city_name", "city_id",
            F.col("zo.shape").alias("zone_shape"), F.col("zo.name").alias("zone_name"),
            F.col("zo.id").alias("zone_id"),
        )
    )
    return geo.join(
        zones.select("entity_id", "country_code", "zone_id", "test_name", "test_id", "test_start_date",
                     "test_end_date"),
        ["entity_id", "country_code", "zone_id"], "inner",
    ).select("entity_id", "country_code", "city_name", "city_id", "zone_shape", "zone_name", "zone_id",
             "test_name", "test_id", "test_start_date", "test_end_date")
